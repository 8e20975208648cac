"""Queries for the calendar, universe and analysis operators on tables derived from the test data, with SQL twins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairopanel.functions.series import evaluate, rounded, rounded_sql, to_sql
from kairopanel.operators import analysis as A
from kairopanel.operators import universe as U
from kairopanel.operators.factors import REGISTRY
from kairopanel.operators.ingest import keep_one
from kairopanel.operators.patterns import PATTERNS
from kairopanel.sources.panel import PANEL_SQL, derived_panel
from kairopanel.sources.shared import stored

#: Parameters for the test data, whose symbols are fewer and smaller than a market's.
RULES = U.UniverseRules(new_days=120, window=20, min_amount=30_000.0, min_turnover=1.0, min_circ_mv=10_000.0, prefixes=("7",), suffixes=("3",))
STUDY = A.AnalysisRules(min_sample=6)
FACTORS = ("momentum_12", "rate_of_change_6", "bias_ratio_6")
SIGNALS = ("cdlengulfing", "cdlharami", "cdllongline")


# --- derived tables ------------------------------------------------------------------------------------------------


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_panel(spark, sf_dir)


def _price(p: DataFrame) -> DataFrame:
    raw = [(F.col(f"{c}_hfq") / F.col("adj_factor")).alias(c) for c in ("open", "high", "low", "close")]
    return p.select("ts_code", "trade_date", *raw, (F.col("open_hfq") / F.col("adj_factor")).alias("pre_close"), "vol", "amount")


def _calendar(p: DataFrame) -> DataFrame:
    """Two exchanges, open on the panel's days; the second is shut on the 13th of a month."""
    days = p.select(F.col("trade_date").alias("cal_date")).distinct()
    one = days.select(F.lit("A").alias("exchange"), "cal_date", F.lit(1).alias("is_open"))
    two = days.select(F.lit("B").alias("exchange"), "cal_date", F.when(F.dayofmonth("cal_date") == 13, 0).otherwise(1).alias("is_open"))
    return one.union(two).withColumn("pretrade_date", F.date_sub("cal_date", 1))


def _listing(p: DataFrame) -> DataFrame:
    return p.groupBy("ts_code").agg(F.min("trade_date").alias("list_date"))


def _flags(p: DataFrame) -> DataFrame:
    """Flagged symbols by day."""
    return p.where("is_st").select("ts_code", "trade_date")


def _universe(p: DataFrame) -> DataFrame:
    return U.universe(p, _listing(p), p, _flags(p), RULES)


def _sample(p: DataFrame, wide: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return A.sample(A.long_form(wide, list(names)), names, p, _universe(p), p.select("ts_code", "industry").distinct())


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _panel(spark, sf_dir)
    wide = evaluate(p, {n: REGISTRY[n].series for n in FACTORS})
    return A.prepare(_sample(p, wide, FACTORS), STUDY)


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _panel(spark, sf_dir)
    wide = evaluate(p, {n: PATTERNS[n] for n in SIGNALS})
    return A.forward_returns(_sample(p, wide, SIGNALS), STUDY.horizons)


P_SQL = f"p AS ({PANEL_SQL})"
UNIVERSE_SQL = """
listing AS (SELECT ts_code, min(trade_date) AS list_date FROM p GROUP BY 1),
flags AS (SELECT ts_code, trade_date FROM p WHERE is_st),
seasoned AS (
  SELECT p.ts_code, p.trade_date, amount, turnover_rate, circ_mv FROM p JOIN listing USING (ts_code)
  WHERE trade_date >= list_date + 120),
liquid AS (
  SELECT *, CASE WHEN count(amount) OVER w = 20 THEN avg(amount) OVER w END AS amount_20d_avg,
         CASE WHEN count(turnover_rate) OVER w = 20 THEN avg(turnover_rate) OVER w END AS turnover_rate_20d_avg
  FROM seasoned
  WINDOW w AS (PARTITION BY ts_code, year(trade_date) ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
active AS (
  SELECT l.ts_code, l.trade_date, amount_20d_avg, turnover_rate_20d_avg FROM liquid l
  WHERE amount_20d_avg > 30000 AND turnover_rate_20d_avg > 1 AND circ_mv > 10000
    AND NOT EXISTS (SELECT 1 FROM flags f WHERE f.ts_code = l.ts_code AND f.trade_date = l.trade_date)
    AND NOT (CAST(l.ts_code AS VARCHAR) LIKE '7%' OR CAST(l.ts_code AS VARCHAR) LIKE '%3'))"""


def _long_sql(series: dict, names: tuple[str, ...]) -> str:
    parts = " UNION ALL ".join(f"SELECT ts_code, trade_date, '{n}' AS factor, CAST({n} AS DOUBLE) AS value FROM wide" for n in names)
    return f"""{P_SQL}, wide AS ({to_sql(PANEL_SQL, {n: series[n] for n in names})}), factors AS ({parts}), {UNIVERSE_SQL},
sample AS (
  SELECT a.ts_code, a.trade_date, n.factor, f.value, s.close_hfq, s.circ_mv, a.amount_20d_avg, a.turnover_rate_20d_avg, i.industry
  FROM active a CROSS JOIN (SELECT DISTINCT factor FROM factors) n
  LEFT JOIN p s ON s.ts_code = a.ts_code AND s.trade_date = a.trade_date
  LEFT JOIN factors f ON f.ts_code = a.ts_code AND f.trade_date = a.trade_date AND f.factor = n.factor
  LEFT JOIN (SELECT DISTINCT ts_code, industry FROM p) i ON i.ts_code = a.ts_code)"""


def _residual_sql(name: str, before: str, x: str) -> str:
    return f"""
{name}_x AS (SELECT *, {x} AS x FROM {before}),
{name}_c AS (SELECT *, value - avg(value) OVER d AS y0, x - avg(x) OVER d AS x0 FROM {name}_x WINDOW d AS (PARTITION BY factor, trade_date)),
{name}_m AS (SELECT *, avg(y0 * x0) OVER d AS cov, avg(x0 * x0) OVER d AS var FROM {name}_c WINDOW d AS (PARTITION BY factor, trade_date)),
{name} AS (SELECT * EXCLUDE (value, x, y0, x0, cov, var), CASE WHEN var IS NULL OR var = 0 THEN y0 ELSE y0 - cov / var * x0 END AS value FROM {name}_m)"""


_HORIZONS = STUDY.horizons
LABEL_SQL = ", ".join(f"lead(close_hfq, {h}) OVER (PARTITION BY factor, ts_code ORDER BY trade_date) / nullif(close_hfq, 0) - 1 AS forward_return_{h}" for h in _HORIZONS)
PREPARED_SQL = f"""{_long_sql({n: REGISTRY[n].series for n in FACTORS}, FACTORS)},
sorted AS (SELECT factor, trade_date, list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS v, count(value) AS n FROM sample GROUP BY 1, 2),
winsor AS (
  SELECT s.* EXCLUDE (value), CASE WHEN o.n < 2 OR value IS NULL THEN value ELSE least(greatest(value,
      v[1 + CAST(least(floor(o.n * 0.01::DOUBLE), o.n - 1) AS INT)]), v[1 + CAST(greatest(floor(o.n * (1 - 0.01::DOUBLE)) - 1, 0) AS INT)]) END AS value
  FROM sample s JOIN sorted o ON s.factor = o.factor AND s.trade_date = o.trade_date),
industry AS (
  SELECT * EXCLUDE (value), value - avg(value) OVER (PARTITION BY factor, trade_date, coalesce(industry, '_UNKNOWN')) AS value FROM winsor),
{_residual_sql('size', 'industry', 'CASE WHEN circ_mv > 0 THEN ln(circ_mv) END')},
{_residual_sql('liquid1', 'size', 'CASE WHEN amount_20d_avg > 0 THEN ln(amount_20d_avg) END')},
{_residual_sql('liquid2', 'liquid1', 'turnover_rate_20d_avg')},
prepared AS (
  SELECT * EXCLUDE (value), (value - avg(value) OVER d) / nullif(stddev_pop(value) OVER d, 0) AS value, {LABEL_SQL}
  FROM liquid2 WINDOW d AS (PARTITION BY factor, trade_date))"""
_LONG_LABELS = " UNION ALL ".join(f"SELECT factor, ts_code, trade_date, value, {h} AS horizon, forward_return_{h} AS label FROM {{0}}" for h in _HORIZONS)
RANKED_SQL = f"""
labelled AS (SELECT * FROM ({_LONG_LABELS.format('prepared')}) WHERE value IS NOT NULL AND label IS NOT NULL),
counted AS (SELECT *, count(*) OVER (PARTITION BY factor, horizon, trade_date) AS n FROM labelled),
r1 AS (SELECT *, row_number() OVER (PARTITION BY factor, horizon, trade_date ORDER BY value, ts_code) AS r FROM counted WHERE n >= 6),
r2 AS (
  SELECT *, row_number() OVER (PARTITION BY factor, horizon, trade_date ORDER BY label, r) AS rl,
         greatest(1, least(5, CAST(floor((r - 1) * 5 / CAST(n AS DOUBLE)) AS INT) + 1)) AS grp FROM r1)"""
IC_SQL = "ic AS (SELECT factor, horizon, trade_date, coalesce(1 - 6.0::DOUBLE * sum((r - rl) * (r - rl)) / nullif(CAST(count(*) * (count(*) * count(*) - 1) AS DOUBLE), 0), 0) AS ic, count(*) AS sample_count FROM r2 GROUP BY 1, 2, 3)"
GROUPS_SQL = """
g1 AS (
  SELECT factor, horizon, trade_date, """ + ", ".join(f"avg(label) FILTER (WHERE grp = {k}) AS group_{k}" for k in range(1, 6)) + """,
         list(ts_code) FILTER (WHERE grp = 5) AS l, list(ts_code) FILTER (WHERE grp = 1) AS s
  FROM r2 GROUP BY 1, 2, 3),
g2 AS (
  SELECT *, lag(l) OVER w AS pl, lag(s) OVER w AS ps, row_number() OVER w = 1 AS first_day
  FROM g1 WINDOW w AS (PARTITION BY factor, horizon ORDER BY trade_date)),
g3 AS (
  SELECT *, CASE WHEN pl IS NULL OR len(pl) = 0 THEN 0 ELSE 1 - len(list_intersect(pl, l)) / CAST(len(pl) AS DOUBLE) END AS long_turnover,
         CASE WHEN ps IS NULL OR len(ps) = 0 THEN 0 ELSE 1 - len(list_intersect(ps, s)) / CAST(len(ps) AS DOUBLE) END AS short_turnover
  FROM g2),
grp AS (
  SELECT *, group_5 - group_1 AS long_short_gross, (long_turnover + short_turnover) * 0.009::DOUBLE AS transaction_cost,
         group_5 - group_1 - (long_turnover + short_turnover) * 0.009::DOUBLE AS long_short
  FROM g3)"""
SUMMARY_COLUMNS = ["ic_mean", "ic_ir", "ic_abs_gt_002_ratio", "ic_positive_ratio", "long_short_gross_mean", "long_short_mean", "long_short_sharpe", "long_short_max_drawdown", "transaction_cost_mean", "win_rate", "long_group_turnover", "short_group_turnover", "long_short_turnover", "ic_observations", "avg_daily_sample_count", "min_daily_sample_count", "max_daily_sample_count"]
SUMMARY_SQL = """
a AS (
  SELECT factor, horizon, avg(ic) AS ic_mean, coalesce(avg(ic) / nullif(stddev_pop(ic), 0), 0) AS ic_ir,
         count(*) FILTER (WHERE abs(ic) > 0.02) / CAST(count(*) AS DOUBLE) AS ic_abs_gt_002_ratio,
         count(*) FILTER (WHERE ic > 0) / CAST(count(*) AS DOUBLE) AS ic_positive_ratio, count(*) AS ic_observations,
         avg(sample_count) AS avg_daily_sample_count, min(sample_count) AS min_daily_sample_count, max(sample_count) AS max_daily_sample_count
  FROM ic GROUP BY 1, 2),
nav AS (
  SELECT factor, horizon, trade_date, product(1 + long_short) OVER (PARTITION BY factor, horizon ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS nav FROM grp),
peaks AS (SELECT *, greatest(1, max(nav) OVER (PARTITION BY factor, horizon ORDER BY trade_date ROWS UNBOUNDED PRECEDING)) AS peak FROM nav),
dd AS (SELECT factor, horizon, greatest(0, max((peak - nav) / peak)) AS long_short_max_drawdown FROM peaks GROUP BY 1, 2),
b AS (
  SELECT factor, horizon, avg(long_short_gross) AS long_short_gross_mean, avg(long_short) AS long_short_mean,
         coalesce(avg(long_short) / nullif(stddev_pop(long_short), 0), 0) * sqrt(252 / CAST(horizon AS DOUBLE)) AS long_short_sharpe,
         avg(transaction_cost) AS transaction_cost_mean, count(*) FILTER (WHERE long_short > 0) / CAST(count(*) AS DOUBLE) AS win_rate,
         coalesce(avg(long_turnover) FILTER (WHERE NOT first_day), 0) AS long_group_turnover,
         coalesce(avg(short_turnover) FILTER (WHERE NOT first_day), 0) AS short_group_turnover
  FROM grp GROUP BY 1, 2),
summary AS (
  SELECT *, (long_group_turnover + short_group_turnover) / 2 AS long_short_turnover
  FROM a JOIN b USING (factor, horizon) JOIN dd USING (factor, horizon))"""
SIGNAL_SQL = f"{_long_sql({n: PATTERNS[n] for n in SIGNALS}, SIGNALS)}, prepared AS (SELECT *, {LABEL_SQL} FROM sample)"
EVENT_COLUMNS = ["event_count", "event_coverage_ratio", "avg_daily_event_count", "max_daily_event_count", "bullish_event_count", "bearish_event_count", "bullish_avg_signal_return", "bullish_win_rate", "bearish_avg_signal_return", "bearish_win_rate", "avg_excess_signal_return", "avg_signal_return", "median_signal_return", "positive_mean_signal_return", "negative_mean_signal_return", "profit_loss_ratio", "max_loss_signal_return", "q05_signal_return", "q95_signal_return", "t_stat", "active_years", "yearly_avg_signal_return_std", "yearly_win_rate_std", "win_rate"]
EVENT_SQL = f"""
labelled AS (SELECT * FROM ({_LONG_LABELS.format('prepared')}) WHERE value IS NOT NULL AND label IS NOT NULL),
e AS (
  SELECT *, value <> 0 AS event, CASE WHEN value <> 0 THEN label * value END AS ret,
         CASE WHEN value <> 0 THEN (label - avg(label) OVER (PARTITION BY factor, horizon, trade_date)) * value END AS excess
  FROM labelled),
w AS (SELECT *, CASE WHEN event THEN CAST(ret > 0 AS INT)::DOUBLE END AS win FROM e),
a AS (
  SELECT factor, horizon, count(*) FILTER (WHERE event) AS event_count, count(*) AS eligible,
         count(*) FILTER (WHERE value > 0) AS bullish_event_count, count(*) FILTER (WHERE value < 0) AS bearish_event_count,
         avg(ret) FILTER (WHERE value > 0) AS bullish_avg_signal_return, avg(win) FILTER (WHERE value > 0) AS bullish_win_rate,
         avg(ret) FILTER (WHERE value < 0) AS bearish_avg_signal_return, avg(win) FILTER (WHERE value < 0) AS bearish_win_rate,
         avg(excess) AS avg_excess_signal_return, avg(ret) AS avg_signal_return, median(ret) AS median_signal_return,
         avg(ret) FILTER (WHERE ret > 0) AS positive_mean_signal_return, avg(ret) FILTER (WHERE ret < 0) AS negative_mean_signal_return,
         min(ret) AS max_loss_signal_return, stddev_samp(ret) AS sd, avg(win) AS win_rate,
         list_sort(list(ret) FILTER (WHERE ret IS NOT NULL)) AS v
  FROM w GROUP BY 1, 2),
d AS (SELECT factor, horizon, avg(c) AS avg_daily_event_count, max(c) AS max_daily_event_count FROM
      (SELECT factor, horizon, trade_date, count(*) AS c FROM w WHERE event GROUP BY 1, 2, 3) GROUP BY 1, 2),
y AS (SELECT factor, horizon, count(*) AS active_years, stddev_samp(m) AS yearly_avg_signal_return_std, stddev_samp(q) AS yearly_win_rate_std FROM
      (SELECT factor, horizon, year(trade_date) AS yr, avg(ret) AS m, avg(win) AS q FROM w WHERE event GROUP BY 1, 2, 3) GROUP BY 1, 2),
summary AS (
  SELECT *, CASE WHEN event_count > 0 THEN event_count / CAST(eligible AS DOUBLE) END AS event_coverage_ratio,
         positive_mean_signal_return / nullif(abs(negative_mean_signal_return), 0) AS profit_loss_ratio,
         v[1 + CAST(round((len(v) - 1) * 0.05::DOUBLE) AS INT)] AS q05_signal_return, v[1 + CAST(round((len(v) - 1) * 0.95::DOUBLE) AS INT)] AS q95_signal_return,
         CASE WHEN event_count >= 2 THEN avg_signal_return / nullif(sd / sqrt(event_count), 0) END AS t_stat
  FROM a LEFT JOIN d USING (factor, horizon) LEFT JOIN y USING (factor, horizon)),
tested AS (
  SELECT *, 1 - 2 * list_sum(list_transform(range(20000), lambda i: exp(-power((i + 0.5::DOUBLE) * abs(t_stat) / 20000, 2) / 2))) * abs(t_stat) / 20000 / sqrt(2 * pi()) AS p_value
  FROM summary)"""


# --- queries -------------------------------------------------------------------------------------------------------

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _show(df: DataFrame, exact: list[str], doubles: list[str]) -> DataFrame:
    return df.select(*exact, *[rounded(F.col(c)).alias(c) for c in doubles])


def _show_sql(exact: list[str], doubles: list[str]) -> str:
    return ", ".join([*exact, *[f"{rounded_sql(c)} AS {c}" for c in doubles]])


def query(name: str, sql: str):
    def take(f):
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f

    return take


@query("calendar_open_days", f"WITH {P_SQL} SELECT DISTINCT trade_date FROM p WHERE day(trade_date) <> 13")
def calendar_open_days(spark, sf_dir):
    return U.open_days(_calendar(_panel(spark, sf_dir)))


@query("calendar_range", f"WITH {P_SQL} SELECT DISTINCT trade_date FROM p WHERE day(trade_date) <> 13 AND trade_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-30'")
def calendar_range(spark, sf_dir):
    return U.trading_days(_calendar(_panel(spark, sf_dir)), dt.date(1995, 1, 1), dt.date(1996, 12, 31), dt.datetime(1996, 12, 31, 9))


@query("source_completeness", f"""WITH {P_SQL}, t AS (SELECT DISTINCT trade_date FROM p)
SELECT 'busy' AS source, trade_date FROM t WHERE trade_date NOT IN (SELECT trade_date FROM p WHERE vol > 60)
UNION ALL SELECT 'flags' AS source, trade_date FROM t WHERE trade_date NOT IN (SELECT trade_date FROM p WHERE is_st)""")  # fmt: skip
def source_completeness(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return U.missing_days(p, {"busy": p.where("vol > 60"), "flags": _flags(p)})


@query("adjusted_close", f"WITH {P_SQL} SELECT ts_code, trade_date, {rounded_sql('close_hfq / adj_factor * adj_factor')} AS hfq_factor FROM p")
def adjusted_close(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return _show(U.adjusted_close(_price(p), p), U.KEYS, ["hfq_factor"])


_SOURCE = [*[f"{c}_{k}" for k in ("bfq", "hfq") for c in ("open", "high", "low", "close", "pre_close")], "adj_factor", "vol", "amount", "turnover_rate", "circ_mv"]


@query("factor_source", f"""WITH {P_SQL}, q AS (SELECT ts_code, trade_date, {', '.join(f'{c}_hfq / adj_factor AS {c}_bfq, {c}_hfq / adj_factor * adj_factor AS {c}_hfq' for c in ('open', 'high', 'low', 'close'))},
open_hfq / adj_factor AS pre_close_bfq, open_hfq / adj_factor * adj_factor AS pre_close_hfq, adj_factor, vol, amount, turnover_rate, circ_mv FROM p)
SELECT {_show_sql(['ts_code', 'trade_date'], _SOURCE)} FROM q""")  # fmt: skip
def factor_source(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return _show(U.factor_source(_price(p), p, p), U.KEYS, _SOURCE)


@query("flag_list_filled", f"""WITH {P_SQL}, f AS (SELECT trade_date, list(DISTINCT ts_code) AS own FROM p WHERE is_st GROUP BY 1),
d AS (SELECT DISTINCT trade_date FROM p), j AS (SELECT trade_date, own FROM d LEFT JOIN f USING (trade_date)),
n AS (SELECT *, last_value(own IGNORE NULLS) OVER (ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
             first_value(own IGNORE NULLS) OVER (ORDER BY trade_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM j)
SELECT unnest(coalesce(own, CASE WHEN b IS NULL THEN a WHEN a IS NULL THEN b ELSE list_distinct(list_concat(b, a)) END)) AS ts_code, trade_date FROM n""")  # fmt: skip
def flag_list_filled(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return U.filled_list(_flags(p), p)


_AVG = ["amount_20d_avg", "turnover_rate_20d_avg"]


@query("active_universe", f"WITH {P_SQL}, {UNIVERSE_SQL} SELECT {_show_sql(['ts_code', 'trade_date'], _AVG)} FROM active")
def active_universe(spark, sf_dir):
    return _show(_universe(_panel(spark, sf_dir)), U.KEYS, _AVG)


_KEY = ["factor", "ts_code", "trade_date"]


@query("analysis_prepared", f"WITH {PREPARED_SQL} SELECT {_show_sql(_KEY, ['value', *[f'forward_return_{h}' for h in _HORIZONS]])} FROM prepared")
def analysis_prepared(spark, sf_dir):
    return _show(_prepared(spark, sf_dir), _KEY, ["value", *[f"forward_return_{h}" for h in _HORIZONS]])


def _stage(name: str, table: str, step):
    @query(f"analysis_{name}", f"WITH {PREPARED_SQL} SELECT {_show_sql(_KEY, ['value'])} FROM {table}")
    def run(spark, sf_dir):
        p = _panel(spark, sf_dir)
        return _show(step(_sample(p, evaluate(p, {n: REGISTRY[n].series for n in FACTORS}), FACTORS)), _KEY, ["value"])


_w, _i, _s = A.winsorize, A.neutralize_industry, A.neutralize_size
_stage("sample", "sample", lambda f: f)
_stage("winsorize", "winsor", _w)
_stage("neutralize_industry", "industry", lambda f: _i(_w(f)))
_stage("neutralize_size", "size", lambda f: _s(_i(_w(f))))
_stage("neutralize_liquidity", "liquid2", lambda f: A.neutralize_liquidity(_s(_i(_w(f)))))

_DAY = ["factor", "horizon", "trade_date"]


@query("analysis_ic", f"WITH {PREPARED_SQL}, {RANKED_SQL}, {IC_SQL} SELECT {_show_sql([*_DAY, 'sample_count'], ['ic'])} FROM ic")
def analysis_ic(spark, sf_dir):
    return _show(A.information_coefficients(A.ranked(_prepared(spark, sf_dir), STUDY)), [*_DAY, "sample_count"], ["ic"])


_GROUP = [*[f"group_{k}" for k in range(1, 6)], "long_short_gross", "transaction_cost", "long_short"]


@query("analysis_group_returns", f"WITH {PREPARED_SQL}, {RANKED_SQL}, {GROUPS_SQL} SELECT {_show_sql(_DAY, _GROUP)} FROM grp")
def analysis_group_returns(spark, sf_dir):
    return _show(A.group_returns(stored(A.ranked(_prepared(spark, sf_dir), STUDY), "ranks"), STUDY), _DAY, _GROUP)


_COUNTS = ["ic_observations", "min_daily_sample_count", "max_daily_sample_count"]
_RATES = [c for c in SUMMARY_COLUMNS if c not in _COUNTS]


@query("analysis_summary", f"WITH {PREPARED_SQL}, {RANKED_SQL}, {IC_SQL}, {GROUPS_SQL}, {SUMMARY_SQL} SELECT {_show_sql(['factor', 'horizon', *_COUNTS], _RATES)} FROM summary")
def analysis_summary(spark, sf_dir):
    ranks = stored(A.ranked(_prepared(spark, sf_dir), STUDY).drop("value", "n"), "ranks")  # three branches read it
    return _show(A.summary(A.information_coefficients(ranks), A.group_returns(ranks, STUDY)), ["factor", "horizon", *_COUNTS], _RATES)


_MON, _MOND = ["factor", "trade_date", "sample_count", "null_count"], ["factor_mean", "factor_std", "coverage_ratio"]
_MON_SQL = "mon AS (SELECT factor, trade_date, count(*) AS sample_count, count(*) - count(value) AS null_count, avg(value) AS factor_mean, stddev_pop(value) AS factor_std, 1 - (count(*) - count(value)) / CAST(count(*) AS DOUBLE) AS coverage_ratio FROM {0} GROUP BY 1, 2)"


@query("analysis_raw_monitor", f"WITH {PREPARED_SQL}, {_MON_SQL.format('sample')} SELECT {_show_sql(_MON, _MOND)} FROM mon")
def analysis_raw_monitor(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return _show(A.monitor(_sample(p, evaluate(p, {n: REGISTRY[n].series for n in FACTORS}), FACTORS)), _MON, _MOND)


@query("analysis_monitor", f"WITH {PREPARED_SQL}, {_MON_SQL.format('prepared')} SELECT {_show_sql(_MON, _MOND)} FROM mon")
def analysis_monitor(spark, sf_dir):
    return _show(A.monitor(_prepared(spark, sf_dir)), _MON, _MOND)


_ECOUNTS = ["event_count", "max_daily_event_count", "bullish_event_count", "bearish_event_count", "active_years"]
_ERATES = [*[c for c in EVENT_COLUMNS if c not in _ECOUNTS], "p_value"]


@query("event_study", f"WITH {SIGNAL_SQL}, {EVENT_SQL} SELECT {_show_sql(['factor', 'horizon', *_ECOUNTS], _ERATES)} FROM tested")
def event_study(spark, sf_dir):
    return _show(A.event_summary(stored(_signals(spark, sf_dir), "signals")), ["factor", "horizon", *_ECOUNTS], _ERATES)


_EM = ["factor", "trade_date", "sample_count", "null_count", "event_count", "bullish_event_count", "bearish_event_count"]


@query("event_monitor", f"""WITH {SIGNAL_SQL}, mon AS (SELECT factor, trade_date, count(*) AS sample_count, count(*) - count(value) AS null_count,
count(*) FILTER (WHERE coalesce(value, 0) <> 0) AS event_count, count(*) FILTER (WHERE value > 0) AS bullish_event_count, count(*) FILTER (WHERE value < 0) AS bearish_event_count,
1 - (count(*) - count(value)) / CAST(count(*) AS DOUBLE) AS coverage_ratio FROM prepared GROUP BY 1, 2) SELECT {_show_sql(_EM, ['coverage_ratio'])} FROM mon""")  # fmt: skip
def event_monitor(spark, sf_dir):
    return _show(A.event_monitor(_signals(spark, sf_dir)), _EM, ["coverage_ratio"])


@query("high_water_mark", f"WITH {P_SQL} SELECT ts_code, CAST(max(trade_date) + 1 AS DATE) AS next_start, count(DISTINCT trade_date) AS days FROM p GROUP BY 1")
def high_water_mark(spark, sf_dir):
    return _panel(spark, sf_dir).groupBy("ts_code").agg(F.date_add(F.max("trade_date"), 1).alias("next_start"), F.countDistinct("trade_date").alias("days"))


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey"]


@query("keys_kept", f"SELECT l_orderkey, l_linenumber, {', '.join(_LINE)} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(f'{c} DESC' for c in _LINE)}) = 1")
def keys_kept(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", *_LINE)
    return keep_one(rows, ["l_orderkey", "l_linenumber"], [F.col(c) for c in _LINE])
