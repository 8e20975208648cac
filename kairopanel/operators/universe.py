"""From market tables to factor input: calendar, adjusted prices, risk-flag list, investable universe."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEYS = ["ts_code", "trade_date"]


def open_days(calendar: DataFrame, exchanges: int = 2) -> DataFrame:
    """Days on which every exchange has a row and is open."""
    days = calendar.groupBy("cal_date").agg(F.min("is_open").alias("open"), F.countDistinct("exchange").alias("n"))
    return days.where((F.col("open") == 1) & (F.col("n") == exchanges)).select(F.col("cal_date").alias("trade_date"))


def calendar_end(calendar: DataFrame, today: dt.date) -> dt.date:
    """today if all exchanges are open or unknown, else the open day before; exchanges that disagree are an error."""
    row = calendar.where(F.col("cal_date") == F.lit(today)).agg(F.min("is_open").alias("lo"), F.max("is_open").alias("hi"), F.max("pretrade_date").alias("before")).first()
    if row.lo is None or row.lo == 1:
        return today
    if row.hi == 1:
        raise ValueError(f"exchanges disagree whether {today} is a trading day")
    return row.before


def trading_days(calendar: DataFrame, start: dt.date, end: dt.date, now: dt.datetime | None = None, close_hour: int = 17) -> DataFrame:
    """Open days in [start, end]; the last day doesn't count before ``close_hour`` of ``now``."""
    if now is not None and now.hour < close_hour:
        end = end - dt.timedelta(days=1)
    return open_days(calendar).where(F.col("trade_date").between(F.lit(start), F.lit(end)))


def next_start(stored: DataFrame, default: dt.date = dt.date(2016, 9, 1), day: str = "trade_date") -> dt.date:
    """The day after the last stored one (high-water mark); a maximum that Parquet's statistics answer."""
    last = stored.agg(F.max(day)).first()[0]
    return default if last is None else last + dt.timedelta(days=1)


def missing_days(targets: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """(source, trade_date) for every target day that a source lacks."""
    parts = [targets.select("trade_date").distinct().join(s.select("trade_date").distinct(), "trade_date", "left_anti").select(F.lit(n).alias("source"), "trade_date") for n, s in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def adjusted_close(price: DataFrame, factor: DataFrame) -> DataFrame:
    """close times adj_factor, for rows in both."""
    return price.select(*KEYS, "close").join(factor.select(*KEYS, "adj_factor"), KEYS).select(*KEYS, (F.col("close") * F.col("adj_factor")).alias("hfq_factor"))


def factor_source(price: DataFrame, factor: DataFrame, metric: DataFrame, prices: tuple[str, ...] = ("open", "high", "low", "close", "pre_close")) -> DataFrame:
    """Raw (_bfq) and back-adjusted (_hfq) prices with volume, amount, turnover and market value.

    A missing adj_factor is an error, raised by the rows themselves when they are computed.
    """
    rows = price.select(*KEYS, *prices, "vol", "amount").join(factor.select(*KEYS, "adj_factor"), KEYS, "left").join(metric.select(*KEYS, "turnover_rate", "circ_mv"), KEYS, "left")
    adj = F.coalesce(F.col("adj_factor").cast("double"), F.raise_error(F.concat(F.lit("no adj_factor for "), F.col("ts_code").cast("string"), F.lit(" on "), F.col("trade_date").cast("string"))).cast("double"))
    raw = [F.col(p).cast("double").alias(f"{p}_bfq") for p in prices]
    adjusted = [(F.col(p).cast("double") * adj).alias(f"{p}_hfq") for p in prices]
    return rows.select(*KEYS, *raw, *adjusted, adj.alias("adj_factor"), *[F.col(c).cast("double").alias(c) for c in ("vol", "amount", "turnover_rate", "circ_mv")])


def filled_list(flags: DataFrame, days: DataFrame, block_days: int = 256) -> DataFrame:
    """flags(ts_code, trade_date) with empty days of days(trade_date) filled from the nearest days that aren't.

    With only one side the day takes that side's symbols; with both, those of the day before and of the day after. Days
    without either side stay empty. Only days are carried, not their symbols: inside blocks of ``block_days``, and over
    the blocks' borders by their first and last day that isn't empty; the symbols come from a join with those days.
    """
    own = flags.select("ts_code", F.col("trade_date").alias("_from")).distinct()
    there = own.select(F.col("_from").alias("_own")).distinct()
    by_day = days.select("trade_date").distinct().join(there, F.col("trade_date") == F.col("_own"), "left")
    by_day = by_day.withColumn("_block", F.floor(F.unix_date(F.col("trade_date").cast("date")) / block_days))
    past = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("_block")
    near = by_day.withColumns({"_before": F.max("_own").over(past(inside.orderBy("trade_date"))), "_after": F.min("_own").over(past(inside.orderBy(F.desc("trade_date"))))})
    borders, every = by_day.groupBy("_block").agg(F.min("_own").alias("_first"), F.max("_own").alias("_last")), W.partitionBy(F.lit(0))  # a row a block
    borders = borders.select(F.col("_block").alias("_b"), F.max("_last").over(past(every.orderBy("_block"))).alias("_back"), F.min("_first").over(past(every.orderBy(F.desc("_block")))).alias("_ahead"))
    near = near.join(borders, F.col("_block") == F.col("_b"))
    sources = F.when(F.col("_own").isNotNull(), F.array("_own")).otherwise(F.array(F.coalesce("_before", "_back"), F.coalesce("_after", "_ahead")))
    wanted = near.select("trade_date", F.explode(F.array_distinct(F.array_compact(sources))).alias("_day"))
    return own.join(wanted, F.col("_from") == F.col("_day")).select("ts_code", "trade_date").distinct()


@dataclass(frozen=True)
class UniverseRules:
    new_days: int = 120
    window: int = 20
    min_amount: float = 50_000.0
    min_turnover: float = 1.0
    min_circ_mv: float = 200_000.0
    #: Boards that are left out.
    suffixes: tuple[str, ...] = (".BJ",)
    prefixes: tuple[str, ...] = ("688", "689", "300")
    #: "year": the windows start anew each year, as a yearly batch has it; "all": they don't.
    history: str = "year"


def universe(price: DataFrame, listing: DataFrame, metric: DataFrame, flags: DataFrame, rules: UniverseRules = UniverseRules()) -> DataFrame:  # noqa: B008
    """(ts_code, trade_date, amount_20d_avg, turnover_rate_20d_avg) of seasoned, liquid, large, unflagged symbols.

    A mean that is its bound but for the rounding of its sum doesn't exceed it, in whatever order the sum was taken.
    """
    rows = price.select(*KEYS, "amount").join(listing.select("ts_code", "list_date"), "ts_code", "left")
    rows = rows.where(F.col("trade_date") >= F.date_add("list_date", rules.new_days)).drop("list_date")
    rows = rows.join(metric.select(*KEYS, "turnover_rate", "circ_mv"), KEYS, "left")
    by = ["ts_code", F.year("trade_date")] if rules.history == "year" else ["ts_code"]
    w = W.partitionBy(*by).orderBy("trade_date").rowsBetween(1 - rules.window, 0)
    mean = lambda c: F.when(F.count(c).over(w) == rules.window, F.avg(c).over(w))
    rows = rows.withColumns({"amount_20d_avg": mean("amount"), "turnover_rate_20d_avg": mean("turnover_rate")})
    above = lambda c, bound: F.col(c) > bound + abs(bound) * 1e-12
    rows = rows.where(above("amount_20d_avg", rules.min_amount) & above("turnover_rate_20d_avg", rules.min_turnover) & (F.col("circ_mv") > rules.min_circ_mv))
    code = F.col("ts_code").cast("string")
    board: Column = F.lit(False)
    for s in rules.suffixes:
        board = board | code.endswith(s)
    for p in rules.prefixes:
        board = board | code.startswith(p)
    return rows.join(flags.select(*KEYS), KEYS, "left_anti").where(~board).select(*KEYS, "amount_20d_avg", "turnover_rate_20d_avg")
