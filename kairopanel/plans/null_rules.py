"""Factors over a panel with nulls, flat bars and gaps, held against SQL written by hand from the rules, not from the trees.

Closes, volumes and turnovers are missing on days that a remainder of symbol and day picks; on others the bar is flat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairopanel.functions.series import DAY, SYMBOL, evaluate, rounded, rounded_sql
from kairopanel.operators.factors import REGISTRY
from kairopanel.sources.panel import PANEL_SQL, derived_panel

NAMES = [
    "simple_moving_average_20", "bollinger_upper_band_20_2", "williams_percent_range_10", "balance_of_power", "on_balance_volume",
    "accumulation_distribution_line", "market_energy_21", "kaufman_adaptive_moving_average_10_2_30", "relative_strength_index_6",
    "stochastic_k_line_9_3_3", "stochastic_relative_strength_index_fast_k_14_5_3", "stochastic_relative_strength_index_fast_d_14_5_3",
    "consecutive_up_days", "market_cost", "volume_ratio_26", "annual_price_rank_position_250",
]


def gappy(panel: DataFrame) -> DataFrame:
    """The panel with missing values and flat bars."""
    at = F.col(SYMBOL) * 31 + F.dayofyear(DAY)
    close = F.when(at % 29 != 0, F.col("close_hfq"))
    flat = lambda c: F.when(at % 17 == 0, close).otherwise(F.col(c))
    return panel.select(SYMBOL, DAY, *[flat(c).alias(c) for c in ("open_hfq", "high_hfq", "low_hfq")], close.alias("close_hfq"), F.when(at % 23 != 0, F.col("vol")).alias("vol"), "amount", F.when(at % 19 != 0, F.col("turnover_rate")).alias("turnover_rate"))


def null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = evaluate(gappy(derived_panel(spark, sf_dir)), {n: REGISTRY[n].series for n in NAMES})
    return got.select(SYMBOL, DAY, *[rounded(F.col(n)).alias(n) for n in NAMES])


_FADE = "power(1 - 2.0::DOUBLE / 22, r.gap + 1)"
NULL_RULES_SQL = f"""
WITH RECURSIVE p AS ({PANEL_SQL}),
q AS (
  SELECT ts_code, trade_date, row_number() OVER (PARTITION BY ts_code ORDER BY trade_date) AS rn,
         CASE WHEN k % 29 <> 0 THEN close_hfq END AS c,
         CASE WHEN k % 17 = 0 THEN CASE WHEN k % 29 <> 0 THEN close_hfq END ELSE open_hfq END AS o,
         CASE WHEN k % 17 = 0 THEN CASE WHEN k % 29 <> 0 THEN close_hfq END ELSE high_hfq END AS h,
         CASE WHEN k % 17 = 0 THEN CASE WHEN k % 29 <> 0 THEN close_hfq END ELSE low_hfq END AS l,
         CASE WHEN k % 23 <> 0 THEN vol END AS v, amount, CASE WHEN k % 19 <> 0 THEN turnover_rate END AS t
  FROM (SELECT *, ts_code * 31 + dayofyear(trade_date) AS k FROM p)),
d AS (SELECT *, lag(c) OVER s AS c1, c - lag(c) OVER s AS move, lag(c, 10) OVER s AS c10 FROM q WINDOW s AS (PARTITION BY ts_code ORDER BY trade_date)),
w AS MATERIALIZED (
  SELECT *, CASE WHEN count(c) OVER n20 = 20 THEN avg(c) OVER n20 END AS sma, CASE WHEN count(c) OVER n20 = 20 THEN stddev_samp(c) OVER n20 END AS sd,
         CASE WHEN count(h) OVER n10 = 10 THEN max(h) OVER n10 END AS top10, CASE WHEN count(l) OVER n10 = 10 THEN min(l) OVER n10 END AS low10,
         CASE WHEN count(h) OVER n9 = 9 THEN max(h) OVER n9 END AS top9, CASE WHEN count(l) OVER n9 = 9 THEN min(l) OVER n9 END AS low9,
         CASE WHEN count(c) OVER n10 = 10 AND rn >= 11 THEN avg(c) OVER n10 END AS seed, count(c) OVER n11 = 11 AS whole,
         sum(abs(move)) OVER n10 AS path
  FROM d WINDOW n9 AS (PARTITION BY ts_code ORDER BY trade_date ROWS 8 PRECEDING), n10 AS (PARTITION BY ts_code ORDER BY trade_date ROWS 9 PRECEDING),
       n11 AS (PARTITION BY ts_code ORDER BY trade_date ROWS 10 PRECEDING), n20 AS (PARTITION BY ts_code ORDER BY trade_date ROWS 19 PRECEDING)),
x AS MATERIALIZED (
  SELECT *, CASE WHEN top9 > low9 THEN (c - low9) / (top9 - low9) * 100 END AS rsv,
         power(CASE WHEN path = 0 THEN 0 ELSE abs(c - c10) / path END * (2.0::DOUBLE / 3 - 2.0::DOUBLE / 31) + 2.0::DOUBLE / 31, 2) AS pace,
         CASE WHEN v > 0 THEN amount / v END AS price, greatest(0, least(t / 100, 1)) AS share
  FROM w),
r AS (
  SELECT ts_code, rn, t AS energy, 0 AS gap, CAST(NULL AS DOUBLE) AS kama, CAST(NULL AS DOUBLE) AS kama_out,
         CAST(NULL AS DOUBLE) AS up6, CAST(NULL AS DOUBLE) AS all6, CAST(NULL AS DOUBLE) AS up14, CAST(NULL AS DOUBLE) AS all14,
         50.0::DOUBLE AS kdj, CASE WHEN t IS NOT NULL THEN price END AS cost
  FROM x WHERE rn = 1
  UNION ALL
  SELECT x.ts_code, x.rn,
         CASE WHEN t IS NULL THEN energy WHEN energy IS NULL THEN t ELSE (2.0::DOUBLE / 22 * t + {_FADE} * energy) / (2.0::DOUBLE / 22 + {_FADE}) END,
         CASE WHEN t IS NULL THEN gap + 1 ELSE 0 END,
         CASE WHEN c IS NULL OR x.rn < 11 THEN kama WHEN kama IS NULL THEN seed WHEN whole THEN kama + pace * (c - kama) ELSE kama END,
         CASE WHEN c IS NULL OR x.rn < 11 THEN NULL WHEN kama IS NULL THEN seed WHEN whole THEN kama + pace * (c - kama) END,
         CASE WHEN move IS NULL THEN up6 WHEN up6 IS NULL THEN greatest(move, 0) ELSE greatest(move, 0) / 6 + up6 * 5 / 6 END,
         CASE WHEN move IS NULL THEN all6 WHEN all6 IS NULL THEN abs(move) ELSE abs(move) / 6 + all6 * 5 / 6 END,
         CASE WHEN move IS NULL THEN up14 WHEN up14 IS NULL THEN greatest(move, 0) ELSE greatest(move, 0) / 14 + up14 * 13 / 14 END,
         CASE WHEN move IS NULL THEN all14 WHEN all14 IS NULL THEN abs(move) ELSE abs(move) / 14 + all14 * 13 / 14 END,
         CASE WHEN rsv IS NULL THEN kdj ELSE rsv / 3 + kdj * 2 / 3 END,
         CASE WHEN price IS NULL OR t IS NULL THEN cost WHEN cost IS NULL THEN price ELSE share * price + (1 - share) * cost END
  FROM r JOIN x ON x.ts_code = r.ts_code AND x.rn = r.rn + 1),
y AS (
  SELECT x.*, kama_out, energy, CASE WHEN rsv IS NOT NULL THEN CASE WHEN x.rn = 1 THEN rsv / 3 + 50.0::DOUBLE * 2 / 3 ELSE kdj END END AS kdj, cost,
         CASE WHEN move IS NOT NULL THEN CASE WHEN all6 = 0 THEN 100 ELSE up6 / all6 * 100 END END AS rsi6,
         CASE WHEN move IS NOT NULL THEN CASE WHEN all14 = 0 THEN 100 ELSE up14 / all14 * 100 END END AS rsi14,
         CASE WHEN h = l THEN 0 ELSE ((c - l) - (h - c)) / (h - l) END * v AS flow,
         CASE WHEN c > c1 THEN v WHEN c < c1 THEN 0 - v ELSE 0 END AS signed_vol,
         CASE WHEN c > c1 THEN 0 ELSE 1 END AS stop
  FROM x JOIN r USING (ts_code, rn)),
z AS (
  SELECT *, CASE WHEN count(rsi14) OVER n5 = 5 THEN max(rsi14) OVER n5 END AS top5, CASE WHEN count(rsi14) OVER n5 = 5 THEN min(rsi14) OVER n5 END AS low5,
         max(CASE WHEN stop = 1 THEN rn END) OVER (PARTITION BY ts_code ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS stopped,
         CASE WHEN count(CASE WHEN c1 IS NOT NULL THEN CASE WHEN c > c1 THEN v ELSE 0 END END) OVER n26 = 26 THEN sum(CASE WHEN c > c1 THEN v ELSE 0 END) OVER n26 END AS a,
         CASE WHEN count(CASE WHEN c1 IS NOT NULL THEN CASE WHEN c < c1 THEN v ELSE 0 END END) OVER n26 = 26 THEN sum(CASE WHEN c < c1 THEN v ELSE 0 END) OVER n26 END AS b,
         CASE WHEN count(CASE WHEN c1 IS NOT NULL THEN CASE WHEN c = c1 THEN v ELSE 0 END END) OVER n26 = 26 THEN sum(CASE WHEN c = c1 THEN v ELSE 0 END) OVER n26 END AS e
  FROM y WINDOW n5 AS (PARTITION BY ts_code ORDER BY trade_date ROWS 4 PRECEDING), n26 AS (PARTITION BY ts_code ORDER BY trade_date ROWS 25 PRECEDING)),
f AS (SELECT *, CASE WHEN top5 > low5 THEN (rsi14 - low5) / (top5 - low5) * 100 END AS fast FROM z),
g AS (
  SELECT *, CASE WHEN fast IS NOT NULL AND count(fast) OVER n3 = 3 THEN avg(fast) OVER n3 END AS slow
  FROM f WINDOW n3 AS (PARTITION BY ts_code, fast IS NULL ORDER BY trade_date ROWS 2 PRECEDING)),
shown AS (
  SELECT ts_code, trade_date, sma AS simple_moving_average_20, sma + 2 * sd AS bollinger_upper_band_20_2,
         CASE WHEN top10 = low10 THEN 0 ELSE (top10 - c) / (top10 - low10) * 100 END AS williams_percent_range_10,
         CASE WHEN h <> l THEN (c - o) / (h - l) END AS balance_of_power,
         CASE WHEN signed_vol IS NOT NULL THEN sum(signed_vol) OVER upto END AS on_balance_volume,
         CASE WHEN flow IS NOT NULL THEN sum(flow) OVER upto END AS accumulation_distribution_line,
         CASE WHEN t IS NOT NULL THEN 100 - 100 / (1 + energy) END AS market_energy_21, kama_out AS kaufman_adaptive_moving_average_10_2_30,
         rsi6 AS relative_strength_index_6, kdj AS stochastic_k_line_9_3_3, fast AS stochastic_relative_strength_index_fast_k_14_5_3,
         slow AS stochastic_relative_strength_index_fast_d_14_5_3, CAST(rn - stopped AS DOUBLE) AS consecutive_up_days,
         CASE WHEN t IS NOT NULL THEN cost END AS market_cost,
         CASE WHEN b + 0.5 * e = 0 THEN 100 ELSE (a + 0.5 * e) / (b + 0.5 * e) * 100 END AS volume_ratio_26,
         CASE WHEN count(c) OVER n250 = 250 THEN 1 + len(list_filter(list(c) OVER n250, lambda s: s > c)) END AS annual_price_rank_position_250
  FROM g WINDOW upto AS (PARTITION BY ts_code ORDER BY trade_date ROWS UNBOUNDED PRECEDING), n250 AS (PARTITION BY ts_code ORDER BY trade_date ROWS 249 PRECEDING))
SELECT ts_code, trade_date, {', '.join(f'{rounded_sql(n)} AS {n}' for n in NAMES)} FROM shown"""

#: More kinds of factors: weighted sums, moments, deviations, regressions, ranks across symbols, ratios of sums.
KINDS = [
    "high_moving_average_120", "cost_moving_average_20", "turnover_rate_ratio_5_120", "return_variance_60", "return_skewness_60", "return_kurtosis_20", "volume_standard_deviation_20",
    "turnover_value_standard_deviation_20", "price_linear_regression_coefficient_12", "acceleration_rate_8", "momentum_average_12_6", "rate_of_change_120", "monthly_return_rank_score_20",
    "commodity_channel_index_14", "money_flow_20", "average_true_range_14", "detrended_price_oscillator_20_10", "tapi",
]


def factor_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = evaluate(gappy(derived_panel(spark, sf_dir)), {n: REGISTRY[n].series for n in KINDS})
    return got.select(SYMBOL, DAY, *[rounded(F.col(n)).alias(n) for n in KINDS])


_FULL = lambda x, n, got: f"CASE WHEN count({x}) OVER n{n} = {n} THEN {got} END"
_SPANS = (5, 6, 8, 12, 14, 20, 60, 120)
_WINDOWS = ", ".join(f"n{n} AS (PARTITION BY ts_code ORDER BY trade_date ROWS {n - 1} PRECEDING)" for n in _SPANS)
#: Moments from the values themselves about their mean, window by window.
_SUM = lambda k: f"list_sum(list_transform(ret_list, lambda v: power(v - list_avg(ret_list), {k})))"
FACTOR_KINDS_SQL = f"""
WITH p AS ({PANEL_SQL}),
q AS (
  SELECT ts_code, trade_date, row_number() OVER (PARTITION BY ts_code ORDER BY trade_date) AS rn,
         CASE WHEN k % 29 <> 0 THEN close_hfq END AS c,
         CASE WHEN k % 17 = 0 THEN CASE WHEN k % 29 <> 0 THEN close_hfq END ELSE open_hfq END AS o,
         CASE WHEN k % 17 = 0 THEN CASE WHEN k % 29 <> 0 THEN close_hfq END ELSE high_hfq END AS h,
         CASE WHEN k % 17 = 0 THEN CASE WHEN k % 29 <> 0 THEN close_hfq END ELSE low_hfq END AS l,
         CASE WHEN k % 23 <> 0 THEN vol END AS v, amount, CASE WHEN k % 19 <> 0 THEN turnover_rate END AS t
  FROM (SELECT *, ts_code * 31 + dayofyear(trade_date) AS k FROM p)),
d AS (
  SELECT *, c / lag(c) OVER s - 1 AS ret, c - lag(c, 12) OVER s AS mtm, c / lag(c, 20) OVER s - 1 AS month, (c - lag(c, 120) OVER s) / lag(c, 120) OVER s * 100 AS roc120,
         (h + l + c) / 3 AS typical, v * (o + c) / 2 AS paid, greatest(h - l, abs(h - lag(c) OVER s), abs(l - lag(c) OVER s)) AS range
  FROM q WINDOW s AS (PARTITION BY ts_code ORDER BY trade_date)),
w AS MATERIALIZED (
  SELECT *, {_FULL("h", 120, "avg(h) OVER n120")} AS high_moving_average_120,
         {_FULL("paid", 20, "sum(paid) OVER n20")} / nullif({_FULL("v", 20, "sum(v) OVER n20")}, 0) AS cost_moving_average_20,
         {_FULL("t", 5, "avg(t) OVER n5")} / nullif({_FULL("t", 120, "avg(t) OVER n120")}, 0) AS turnover_rate_ratio_5_120,
         {_FULL("ret", 60, "list(ret) OVER n60")} AS long_list, {_FULL("ret", 20, "list(ret) OVER n20")} AS short_list,
         {_FULL("v", 20, "stddev_samp(v) OVER n20")} AS volume_standard_deviation_20, {_FULL("amount", 20, "stddev_samp(amount) OVER n20")} AS turnover_value_standard_deviation_20,
         {_FULL("c", 12, "regr_slope(c, rn) OVER n12")} / {_FULL("c", 12, "avg(c) OVER n12")} AS price_linear_regression_coefficient_12,
         {_FULL("c", 8, "regr_slope(c, rn) OVER n8")} / c AS acceleration_rate_8, {_FULL("mtm", 6, "avg(mtm) OVER n6")} AS momentum_average_12_6, roc120 AS rate_of_change_120,
         CASE WHEN month IS NOT NULL THEN 1 - (rank() OVER (PARTITION BY trade_date ORDER BY month DESC NULLS LAST) + (count(*) OVER (PARTITION BY trade_date, month) - 1) / 2.0::DOUBLE) / count(month) OVER (PARTITION BY trade_date) END AS monthly_return_rank_score_20,
         {_FULL("typical", 14, "list(typical) OVER n14")} AS typical_list, {_FULL("typical", 20, "CASE WHEN count(v) OVER n20 = 20 THEN sum(typical * v) OVER n20 END")} AS money_flow_20,
         {_FULL("range", 14, "avg(range) OVER n14")} AS average_true_range_14, {_FULL("c", 20, "avg(c) OVER n20")} AS mean20, amount / c AS tapi
  FROM d WINDOW {_WINDOWS}),
m AS (SELECT *, short_list AS ret_list FROM w),
k AS (SELECT *, CASE WHEN {_SUM(2)} > 0 THEN 20 * {_SUM(4)} / power({_SUM(2)}, 2) END AS return_kurtosis_20 FROM m),
n AS (SELECT * REPLACE (long_list AS ret_list) FROM k),
shown AS (
  SELECT *, {_SUM(2)} / 60 AS return_variance_60, CASE WHEN {_SUM(2)} > 0 THEN sqrt(60) * {_SUM(3)} / power({_SUM(2)}, 1.5) END AS return_skewness_60,
         (typical - list_avg(typical_list)) / nullif(0.015 * list_avg(list_transform(typical_list, lambda x: abs(x - list_avg(typical_list)))), 0) AS commodity_channel_index_14,
         c - lag(mean20, 10) OVER (PARTITION BY ts_code ORDER BY trade_date) AS detrended_price_oscillator_20_10
  FROM n)
SELECT ts_code, trade_date, {', '.join(f'{rounded_sql(n)} AS {n}' for n in KINDS)} FROM shown"""

QUERIES = {"null_rules": null_rules, "factor_kinds": factor_kinds}
ORACLE_SQL = {"null_rules": NULL_RULES_SQL, "factor_kinds": FACTOR_KINDS_SQL}
