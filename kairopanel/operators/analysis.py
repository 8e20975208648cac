"""Cross-sectional factor evaluation and event studies, for any number of factors in one job.

Frames are long: a row per (factor, ts_code, trade_date) with ``value``. Cross-sections are windows over
(factor, trade_date), time series windows over (factor, ts_code); both are short however much history there is, so
work is spread by key. Per-date holdings are arrays of one group of one day.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CROSS, SERIES = ["factor", "trade_date"], ["factor", "ts_code"]


@dataclass(frozen=True)
class AnalysisRules:
    horizons: tuple[int, ...] = (1, 5, 10, 20)
    groups: int = 5
    min_sample: int = 20
    winsor: float = 0.01
    commission: float = 0.003
    stamp_tax: float = 0.001
    slippage: float = 0.001


def long_form(factors: DataFrame, names: list[str]) -> DataFrame:
    """Wide factor columns to (ts_code, trade_date, factor, value)."""
    return factors.select("ts_code", "trade_date", F.explode(F.array(*[F.struct(F.lit(n).alias("factor"), F.col(n).cast("double").alias("value")) for n in names])).alias("x")).select("ts_code", "trade_date", "x.factor", "x.value")


def sample(factors: DataFrame, names: list[str] | tuple[str, ...], source: DataFrame, active: DataFrame, industry: DataFrame | None = None) -> DataFrame:
    """Rows of the active universe for every named factor, with close, market value and industry; the universe sets the rows."""
    keys = ["ts_code", "trade_date"]
    rows = active.select(*keys, "amount_20d_avg", "turnover_rate_20d_avg").join(source.select(*keys, "close_hfq", "circ_mv"), keys, "left")
    rows = rows.withColumn("factor", F.explode(F.array(*[F.lit(n) for n in names]))).join(factors, [*keys, "factor"], "left")
    if industry is None:
        return rows.withColumn("industry", F.lit(None).cast("string"))
    return rows.join(industry.select("ts_code", "industry"), "ts_code", "left")


def winsorize(frame: DataFrame, q: float = 0.01) -> DataFrame:
    """Clips to the sorted values at int(n*q) and int(n*(1-q))-1 of each cross-section; under two values nothing changes.

    The two values are found by rank within the cross-section: one sort of it, and no list of values in any row.
    """
    day = W.partitionBy(*CROSS)
    f = frame.withColumns({"_n": F.count("value").over(day), "_r": F.row_number().over(day.orderBy(F.col("value").asc_nulls_last())) - 1})
    low = F.least(F.floor(F.col("_n") * q), F.col("_n") - 1)
    high = F.greatest(F.floor(F.col("_n") * (1 - q)) - 1, F.lit(0))
    f = f.withColumns({"_lo": F.max(F.when(F.col("_r") == low, F.col("value"))).over(day), "_hi": F.max(F.when(F.col("_r") == high, F.col("value"))).over(day)})
    clipped = F.when((F.col("_n") < 2) | F.col("value").isNull(), F.col("value")).otherwise(F.least(F.greatest("value", "_lo"), "_hi"))
    return f.withColumn("value", clipped).drop("_n", "_r", "_lo", "_hi")


def neutralize_industry(frame: DataFrame) -> DataFrame:
    """Value minus the mean of its industry that day; unknown industries are one."""
    group = W.partitionBy(*CROSS, F.coalesce("industry", F.lit("_UNKNOWN")))
    return frame.withColumn("value", F.col("value") - F.avg("value").over(group))


def neutralize(frame: DataFrame, exposure: str, log: bool) -> DataFrame:
    """Residual of value on 1 and the exposure, per cross-section; each mean over its own non-null rows."""
    x = F.col(exposure).cast("double")
    x = F.when(x > 0, F.ln(x)) if log else x
    day = W.partitionBy(*CROSS)
    f = frame.withColumn("_x", x).withColumns({"_y0": F.col("value") - F.avg("value").over(day), "_x0": F.col("_x") - F.avg("_x").over(day)})
    f = f.withColumns({"_cov": F.avg(F.col("_y0") * F.col("_x0")).over(day), "_var": F.avg(F.col("_x0") * F.col("_x0")).over(day)})
    flat = F.col("_var").isNull() | (F.col("_var") == 0)
    residual = F.when(flat, F.col("_y0")).otherwise(F.col("_y0") - F.try_divide("_cov", "_var") * F.col("_x0"))
    return f.withColumn("value", residual).drop("_x", "_y0", "_x0", "_cov", "_var")


def neutralize_size(frame: DataFrame) -> DataFrame:
    return neutralize(frame, "circ_mv", log=True)


def neutralize_liquidity(frame: DataFrame) -> DataFrame:
    return neutralize(neutralize(frame, "amount_20d_avg", log=True), "turnover_rate_20d_avg", log=False)


def standardize(frame: DataFrame) -> DataFrame:
    """Z-scores by population deviation; null where it is null or 0."""
    day = W.partitionBy(*CROSS)
    f = frame.withColumns({"_m": F.avg("value").over(day), "_s": F.stddev_pop("value").over(day)})
    return f.withColumn("value", F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))).drop("_m", "_s")


def forward_returns(frame: DataFrame, horizons: tuple[int, ...] = (1, 5, 10, 20)) -> DataFrame:
    """forward_return_h = close h rows ahead / close - 1, counted in the symbol's rows of this frame."""
    w = W.partitionBy(*SERIES).orderBy("trade_date")
    return frame.withColumns({f"forward_return_{h}": F.try_divide(F.lead("close_hfq", h).over(w), F.col("close_hfq")) - 1 for h in horizons})


def monitor(frame: DataFrame) -> DataFrame:
    """Per factor and day: rows, nulls, mean, population deviation, coverage."""
    n, miss = F.count(F.lit(1)), F.count_if(F.col("value").isNull())
    return frame.groupBy(*CROSS).agg(n.alias("sample_count"), miss.alias("null_count"), F.avg("value").alias("factor_mean"), F.stddev_pop("value").alias("factor_std"), (1 - miss / n).alias("coverage_ratio"))


def prepare(frame: DataFrame, rules: AnalysisRules = AnalysisRules()) -> DataFrame:  # noqa: B008
    """Winsorized, neutralized, standardized values with forward returns."""
    out = neutralize_liquidity(neutralize_size(neutralize_industry(winsorize(frame, rules.winsor))))
    return forward_returns(standardize(out), rules.horizons)


def _by_horizon(frame: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"forward_return_{h}").alias("label")) for h in horizons])).alias("x")
    return frame.select("factor", "ts_code", "trade_date", "value", each).select("factor", "ts_code", "trade_date", "value", "x.horizon", "x.label").where("value is not null and label is not null")


def ranked(frame: DataFrame, rules: AnalysisRules) -> DataFrame:
    """Rows of dates with enough values, with ordinal ranks and the group by value; ties by symbol, of labels by value."""
    day = W.partitionBy("factor", "horizon", "trade_date")
    rows = _by_horizon(frame, rules.horizons).withColumn("n", F.count(F.lit(1)).over(day)).where(F.col("n") >= max(rules.groups, rules.min_sample))
    rows = rows.withColumn("r", F.row_number().over(day.orderBy("value", "ts_code"))).withColumn("rl", F.row_number().over(day.orderBy("label", "r")))
    group = F.floor((F.col("r") - 1) * rules.groups / F.col("n")).cast("int") + 1
    return rows.withColumn("group", F.greatest(F.lit(1), F.least(group, F.lit(rules.groups))))


def information_coefficients(ranks: DataFrame) -> DataFrame:
    """Rank correlation of value and forward return, per factor, horizon and day; 0 without variance.

    Ordinal ranks are permutations of 1..n, for which Pearson's correlation is 1 - 6 sum(d^2) / (n (n^2 - 1)): sums of
    integers, so the result doesn't depend on the order of the rows.
    """
    n, gap = F.count(F.lit(1)), F.col("r").cast("long") - F.col("rl")
    ic = F.coalesce(1 - F.try_divide(6.0 * F.sum(gap * gap), (n * (n * n - 1)).cast("double")), F.lit(0.0))
    return ranks.groupBy("factor", "horizon", "trade_date").agg(ic.alias("ic"), n.alias("sample_count"))


def group_returns(ranks: DataFrame, rules: AnalysisRules) -> DataFrame:
    """Mean forward return of each group, long-short return, turnover of both legs and cost, per evaluated day.

    A leg's member stays if it was in the leg on the evaluated day before: every member's last day in the leg is counted
    by day, so no leg is ever gathered.
    """
    g, keys = rules.groups, ["factor", "horizon", "trade_date"]
    own = lambda k: F.col("group") == k
    legs = {"long": g, "short": 1}
    days = ranks.groupBy(*keys).agg(*[F.avg(F.when(own(k), F.col("label"))).alias(f"group_{k}") for k in range(1, g + 1)], *[F.count_if(own(k)).alias(leg) for leg, k in legs.items()])
    w = W.partitionBy("factor", "horizon").orderBy("trade_date")  # a row a day
    days = days.withColumns({"before": F.lag("trade_date", 1).over(w), "first_day": F.row_number().over(w) == 1, **{f"{leg}_before": F.lag(leg, 1).over(w) for leg in legs}})
    was = F.lag("trade_date", 1).over(W.partitionBy("factor", "horizon", "group", "ts_code").orderBy("trade_date"))
    stays = ranks.where(own(g) | own(1)).select(*keys, "group", was.alias("was")).where("was is not null")
    stays = stays.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], "was").agg(*[F.count_if(own(k)).alias(f"{leg}_stays") for leg, k in legs.items()])
    days = days.join(stays, [*[F.col(k) == F.col(f"_{k}") for k in keys], F.col("before") == F.col("was")], "left")

    def turnover(leg: str) -> Column:
        before = F.col(f"{leg}_before")
        return F.when(before.isNull() | (before == 0), 0.0).otherwise(1 - F.coalesce(F.col(f"{leg}_stays"), F.lit(0)) / before)

    rate = 2 * rules.commission + rules.stamp_tax + 2 * rules.slippage
    days = days.withColumns({f"{leg}_turnover": turnover(leg) for leg in legs})
    days = days.withColumns({"long_short_gross": F.col(f"group_{g}") - F.col("group_1"), "transaction_cost": F.col("long_turnover") * rate + F.col("short_turnover") * rate})
    days = days.withColumn("long_short", F.col("long_short_gross") - F.col("transaction_cost"))
    return days.select(*keys, *[f"group_{k}" for k in range(1, g + 1)], "long_turnover", "short_turnover", "first_day", "long_short_gross", "transaction_cost", "long_short")


def summary(ics: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per factor and horizon; days are few, so a factor's daily returns are one array for the drawdown."""
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    n = F.count(F.lit(1))
    a = ics.groupBy("factor", "horizon").agg(
        F.avg("ic").alias("ic_mean"), div(F.avg("ic"), F.stddev_pop("ic")).alias("ic_ir"),
        (F.count_if(F.abs("ic") > 0.02) / n).alias("ic_abs_gt_002_ratio"), (F.count_if(F.col("ic") > 0) / n).alias("ic_positive_ratio"),
        n.alias("ic_observations"), F.avg("sample_count").alias("avg_daily_sample_count"),
        F.min("sample_count").alias("min_daily_sample_count"), F.max("sample_count").alias("max_daily_sample_count"),
    )
    later = lambda c: F.coalesce(F.avg(F.when(~F.col("first_day"), F.col(c))), F.lit(0.0))
    path = F.transform(F.array_sort(F.collect_list(F.struct("trade_date", "long_short"))), lambda x: x["long_short"])
    b = groups.groupBy("factor", "horizon").agg(
        F.avg("long_short_gross").alias("long_short_gross_mean"), F.avg("long_short").alias("long_short_mean"),
        div(F.avg("long_short"), F.stddev_pop("long_short")).alias("_sharpe"), F.avg("transaction_cost").alias("transaction_cost_mean"),
        (F.count_if(F.col("long_short") > 0) / n).alias("win_rate"), later("long_turnover").alias("long_group_turnover"),
        later("short_turnover").alias("short_group_turnover"), path.alias("_path"),
    )
    start = F.struct(F.lit(1.0).alias("nav"), F.lit(1.0).alias("peak"), F.lit(0.0).alias("worst"))

    def step(s: Column, r: Column) -> Column:
        nav = s["nav"] * (1 + r)
        peak = F.greatest(s["peak"], nav)
        return F.struct(nav.alias("nav"), peak.alias("peak"), F.greatest(s["worst"], (peak - nav) / peak).alias("worst"))

    b = b.withColumns({
        "long_short_sharpe": F.col("_sharpe") * F.sqrt(252 / F.greatest("horizon", F.lit(1))),
        "long_short_max_drawdown": F.aggregate("_path", start, step, lambda s: s["worst"]),
        "long_short_turnover": (F.col("long_group_turnover") + F.col("short_group_turnover")) / 2,
    }).drop("_sharpe", "_path")
    return a.join(b, ["factor", "horizon"])


def picked_ranks(events: DataFrame, keys: list[str], value: str, whole: int = 10_000) -> DataFrame:
    """keys, n and the values at ranks round((n-1)/20), the middle (mean of two if even) and round(19(n-1)/20).

    Exact, and no key's values meet in one task: a sketch gives a narrow band of values around each rank, rows below a
    band are counted, and only a band's rows (under one in a hundred; all, where a key has at most ``whole``) are ranked.
    """
    gap, shares = 0.004, {"lo": 0.05, "mid": 0.5, "hi": 0.95}
    edges = [x for s in shares.values() for x in (s - gap, s + gap)]
    bands = events.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("_min"), F.max(value).alias("_max"), F.percentile_approx(value, F.array(*[F.lit(x) for x in edges]), F.lit(1000)).alias("_b"))
    few = F.col("n") <= whole
    bands = bands.select(*keys, "n", *[F.when(few, F.col("_min")).otherwise(F.get("_b", F.lit(2 * i))).alias(f"_{s}_l") for i, s in enumerate(shares)], *[F.when(few, F.col("_max")).otherwise(F.get("_b", F.lit(2 * i + 1))).alias(f"_{s}_h") for i, s in enumerate(shares)])
    rows = events.where(F.col(value).isNotNull()).select(*keys, value).join(bands, keys)
    below = rows.groupBy(*keys).agg(*[F.count_if(F.col(value) < F.col(f"_{s}_l")).alias(f"_{s}") for s in shares])
    within = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), (F.col(value).between(F.col(f"_{s}_l"), F.col(f"_{s}_h"))).alias("ok")) for s in shares])).alias("_at")
    inside = rows.select(*keys, "n", value, within).where("_at.ok").select(*keys, "n", value, F.col("_at.s").alias("s"))
    inside = inside.withColumn("r", F.row_number().over(W.partitionBy(*keys, "s").orderBy(value)) - 1).join(below, keys)
    rank = F.col("r") + F.coalesce(*[F.when(F.col("s") == s, F.col(f"_{s}")) for s in shares])
    last = F.col("n") - 1
    at = lambda s, k: F.when((F.col("s") == s) & (F.col("rank") == k), F.col(value))
    return inside.withColumn("rank", rank).groupBy(*keys).agg(
        F.max(at("lo", F.round(last * 0.05))).alias("q05"), F.max(at("hi", F.round(last * 0.95))).alias("q95"),
        ((F.max(at("mid", F.floor(last / 2))) + F.max(at("mid", F.floor(F.col("n") / 2)))) / 2).alias("median"),
    )


def event_summary(frame: DataFrame, horizons: tuple[int, ...] = (1, 5, 10, 20)) -> DataFrame:
    """Event study of signals (value in -1, 0, 1) against forward returns, one row per factor and horizon."""
    rows = _by_horizon(frame, horizons)
    rows = rows.withColumn("market", F.avg("label").over(W.partitionBy("factor", "horizon", "trade_date")))
    sign = F.signum("value")
    rows = rows.withColumns({
        "event": F.col("value") != 0,
        "ret": F.when(F.col("value") != 0, F.col("label") * sign),
        "excess": F.when(F.col("value") != 0, (F.col("label") - F.col("market")) * sign),
    })
    win = F.when(F.col("event"), (F.col("ret") > 0).cast("double"))
    keys = ["factor", "horizon"]
    up, down = F.col("value") > 0, F.col("value") < 0
    a = rows.groupBy(*keys).agg(
        F.count_if("event").alias("event_count"), F.count(F.lit(1)).alias("_eligible"),
        F.count_if(up).alias("bullish_event_count"), F.count_if(down).alias("bearish_event_count"),
        F.avg(F.when(up, F.col("ret"))).alias("bullish_avg_signal_return"), F.avg(F.when(up, win)).alias("bullish_win_rate"),
        F.avg(F.when(down, F.col("ret"))).alias("bearish_avg_signal_return"), F.avg(F.when(down, win)).alias("bearish_win_rate"),
        F.avg("excess").alias("avg_excess_signal_return"), F.avg("ret").alias("avg_signal_return"),
        F.avg(F.when(F.col("ret") > 0, F.col("ret"))).alias("positive_mean_signal_return"), F.avg(F.when(F.col("ret") < 0, F.col("ret"))).alias("negative_mean_signal_return"),
        F.min("ret").alias("max_loss_signal_return"), F.stddev_samp("ret").alias("_std"), F.avg(win).alias("win_rate"),
    )
    events = rows.where("event")
    ranks = picked_ranks(events, keys, "ret").select(*keys, F.col("median").alias("median_signal_return"), F.col("q05").alias("q05_signal_return"), F.col("q95").alias("q95_signal_return"))
    daily = events.groupBy(*keys, "trade_date").count().groupBy(*keys).agg(F.avg("count").alias("avg_daily_event_count"), F.max("count").alias("max_daily_event_count"))
    yearly = events.groupBy(*keys, F.year("trade_date").alias("y")).agg(F.avg("ret").alias("m"), F.avg(win).alias("w"))
    yearly = yearly.groupBy(*keys).agg(F.count(F.lit(1)).alias("active_years"), F.stddev_samp("m").alias("yearly_avg_signal_return_std"), F.stddev_samp("w").alias("yearly_win_rate_std"))
    out = a.join(ranks, keys, "left").join(daily, keys, "left").join(yearly, keys, "left")
    some = F.col("event_count") > 0
    t = F.when(F.col("event_count") >= 2, F.try_divide("avg_signal_return", F.try_divide(F.col("_std"), F.sqrt("event_count"))))
    return out.withColumns({
        "event_coverage_ratio": F.when(some, F.col("event_count") / F.col("_eligible")),
        "profit_loss_ratio": F.try_divide("positive_mean_signal_return", F.abs("negative_mean_signal_return")),
        "t_stat": t, "p_value": two_sided_p(t),
        "active_years": F.coalesce("active_years", F.lit(0)),
    }).drop("_eligible", "_std")


def two_sided_p(t: Column, terms: int = 80) -> Column:
    """erfc(|t| / sqrt 2), the normal two-sided p-value: erf's power series up to 2.5, the continued fraction beyond it."""
    x = F.abs(t) / math.sqrt(2)
    small = F.least(x, F.lit(2.5))
    start = F.struct(small.alias("term"), small.alias("sum"))

    def more(s: Column, k: Column) -> Column:
        term = s["term"] * 2 * small * small / (2 * k + 1)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    near = 1 - 2 / math.sqrt(math.pi) * F.exp(-small * small) * F.aggregate(F.sequence(F.lit(1), F.lit(terms)), start, more, lambda s: s["sum"])
    large = F.greatest(x, F.lit(2.5))
    tail = F.aggregate(F.sequence(F.lit(terms), F.lit(1)), large, lambda s, k: large + k / 2 / s)
    return F.when(t.isNull() | F.isnan(t), None).when(x <= 2.5, near).otherwise(F.exp(-large * large) / math.sqrt(math.pi) / tail)


def event_monitor(frame: DataFrame) -> DataFrame:
    """Per factor and day: rows, nulls, events by direction, coverage."""
    n, miss = F.count(F.lit(1)), F.count_if(F.col("value").isNull())
    return frame.groupBy(*CROSS).agg(
        n.alias("sample_count"), miss.alias("null_count"), F.count_if(F.coalesce("value", F.lit(0)) != 0).alias("event_count"),
        F.count_if(F.col("value") > 0).alias("bullish_event_count"), F.count_if(F.col("value") < 0).alias("bearish_event_count"),
        (1 - miss / n).alias("coverage_ratio"),
    )


def is_fresh(summaries: DataFrame, end: object, horizons: tuple[int, ...], days: int = 25) -> bool:
    """Whether every horizon has a summary and the oldest newest one is at most ``days`` before end."""
    got = {r.horizon: r.at for r in summaries.groupBy("horizon").agg(F.max("updated_at").alias("at")).collect()}  # a row a horizon
    return set(horizons) <= set(got) and all(got[h] is not None and (end - got[h]).days <= days for h in horizons)
