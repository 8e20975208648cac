"""The symbol-by-day panel: from market tables, or derived from the trade tables of the test data.

The derived panel aggregates line items by supplier (symbol) and ship date (day): open and close are the first and
last line of the day in a total order, high and low widen the extremes by volume, and the other market columns follow
from them. Everything is one map-side-combined aggregation over lineitem plus one join with a small dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close", "pre_close")


def bars(lineitem: DataFrame) -> DataFrame:
    """Daily bars by symbol: open/high/low/close (back-adjusted), vol, amount."""
    px = F.col("l_extendedprice") / F.col("l_quantity") / 100.0
    k = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    day = (
        lineitem.where("l_quantity > 0")
        .groupBy(F.col("l_suppkey").alias("ts_code"), F.to_date("l_shipdate").alias("trade_date"))
        .agg(
            F.min_by(px * (1.05 - F.col("l_discount")), k).alias("open_hfq"),
            F.max_by(px * (0.96 + F.col("l_tax")), k).alias("close_hfq"),
            F.min_by((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45), k).alias("is_st"),
            F.sum("l_quantity").alias("vol"),
            F.sum("l_extendedprice").alias("amount"),
            F.max(px).alias("_hi"),
            F.min(px).alias("_lo"),
        )
    )
    high = F.greatest("open_hfq", "close_hfq", "_hi") * (1.0 + 0.01 * (F.col("vol") % 5.0))
    low = F.least("open_hfq", "close_hfq", "_lo") * (1.0 - 0.01 * (F.col("vol") % 4.0))
    return day.withColumns({"high_hfq": high, "low_hfq": low}).drop("_hi", "_lo")


def market(bars: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Bars with turnover_rate, circ_mv, adj_factor and industry (null for some symbols)."""
    shares = 1000.0 + 10.0 * (F.col("ts_code") % 50)
    names = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(F.col("s_suppkey").alias("ts_code"), F.when(F.col("s_suppkey") % 17 != 0, F.col("n_name")).alias("industry"))
    out = bars.withColumns({
        "turnover_rate": 100.0 * F.col("vol") / shares,
        "circ_mv": F.col("close_hfq") * shares,
        "adj_factor": 1.0 + 0.02 * (F.year("trade_date") - 1995),
    })
    return out.join(names, "ts_code", "left")


BARS_SQL = """
SELECT l_suppkey AS ts_code, CAST(l_shipdate AS DATE) AS trade_date,
       arg_min(px * (1.05::DOUBLE - l_discount), k) AS open_hfq, arg_max(px * (0.96::DOUBLE + l_tax), k) AS close_hfq,
       arg_min(l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 45, k) AS is_st,
       sum(l_quantity) AS vol, sum(l_extendedprice) AS amount, max(px) AS hi, min(px) AS lo
FROM (SELECT *, l_extendedprice / l_quantity / 100.0::DOUBLE AS px,
             row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) AS k
      FROM lineitem WHERE l_quantity > 0)
GROUP BY 1, 2"""

PANEL_SQL = f"""
SELECT b.ts_code, trade_date, open_hfq, close_hfq, is_st, vol, amount,
       greatest(open_hfq, close_hfq, hi) * (1.0::DOUBLE + 0.01::DOUBLE * (vol % 5.0::DOUBLE)) AS high_hfq,
       least(open_hfq, close_hfq, lo) * (1.0::DOUBLE - 0.01::DOUBLE * (vol % 4.0::DOUBLE)) AS low_hfq,
       100.0::DOUBLE * vol / (1000.0::DOUBLE + 10.0::DOUBLE * (b.ts_code % 50)) AS turnover_rate,
       close_hfq * (1000.0::DOUBLE + 10.0::DOUBLE * (b.ts_code % 50)) AS circ_mv,
       1.0::DOUBLE + 0.02::DOUBLE * (year(trade_date) - 1995) AS adj_factor,
       CASE WHEN b.ts_code % 17 <> 0 THEN n_name END AS industry
FROM ({BARS_SQL}) b LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) s ON s_suppkey = b.ts_code"""


def derived_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return market(bars(read("lineitem")), read("supplier"), read("nation"))
