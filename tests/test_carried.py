"""Daily batches from carried state against one evaluation over all rows."""

import datetime as dt
import math
import random

import pytest

from kairopanel.functions.carried import carry
from kairopanel.functions.series import col, cumulative, ema, evaluate, first_row, kurtosis, lag, lead, rank_desc, recur, row_number, rows_since_high, running_max, skip_avg, total, when
from kairopanel.operators.factors import REGISTRY, families

DAY0 = dt.date(2021, 3, 1)
SCHEMA = "ts_code long, trade_date date, open_hfq double, high_hfq double, low_hfq double, close_hfq double, vol double, amount double, turnover_rate double"


def panel(spark, days=60, seed=1, gaps=0.08):
    g, rows = random.Random(seed), []
    for s in range(1, 6):
        price = 10.0 * s
        for i in range(days):
            if (s == 2 and i < 25) or (s == 3 and 20 <= i < 45) or (s == 4 and i > 30):  # begins late, pauses, ends
                continue
            price = max(1.0, price + g.uniform(-1, 1))
            o = price + g.uniform(-0.5, 0.5)
            gap = lambda v: None if g.random() < gaps else v  # noqa: E731, B023
            rows.append((s, DAY0 + dt.timedelta(days=i), gap(o), gap(max(o, price) + 0.5), gap(min(o, price) - 0.5), gap(price), gap(float(g.randint(0, 9))), 5.0 * i, gap(g.random() * 5)))
    return spark.createDataFrame(rows, SCHEMA)


C = col("close_hfq")
OUTPUTS = {
    "ema": ema(C, 5), "macd": ema(ema(C, 3) - ema(C, 6), 4), "carried": recur(C, 1 / 3, 50.0, True), "moving": recur(C, col("turnover_rate") / 10), "sum": cumulative(C), "row": row_number(), "high": running_max(C),
    "first": first_row(col("vol")), "since": rows_since_high(C, 7), "skip": skip_avg(C, 4), "total": total(col("vol"), 12), "kurt": kurtosis(C, 11), "rank": rank_desc(C / lag(C, 2)), "mean_of_ema": total(ema(C, 3), 10), "nested": lag(cumulative(when(C > lag(C, 1), 1.0, 0.0)), 3),
}


def rows_of(df, names):
    return {(r.ts_code, r.trade_date): [r[n] for n in names] for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == [None if v is None else pytest.approx(v, rel=1e-11, abs=1e-11) if not math.isnan(v) else pytest.approx(v, nan_ok=True) for v in want[k]], k


def in_batches(spark, df, outputs, cuts, tmp_path):
    """Results of consecutive batches; the state goes through files."""
    state, got, seen = None, {}, 0
    for k, (lo, hi) in enumerate(zip([-1, *cuts], [*cuts, 10_000], strict=True)):
        new = df.where(f"datediff(trade_date, date'{DAY0}') > {lo} and datediff(trade_date, date'{DAY0}') <= {hi}")
        if k:  # a batch that brings rows again: they are left out
            new = new.union(df.where(f"datediff(trade_date, date'{DAY0}') = {lo} and ts_code = 1"))
        results, following = carry(new, state, outputs)
        got |= rows_of(results, list(outputs))
        following.write.parquet(str(tmp_path / f"s{k}"))
        state = spark.read.parquet(str(tmp_path / f"s{k}"))
        seen = max(seen, state.groupBy("ts_code").count().agg({"count": "max"}).first()[0])
    return got, seen


def test_ten_batches_equal_one_evaluation(spark, tmp_path):
    df = panel(spark).cache()
    got, seen = in_batches(spark, df, OUTPUTS, [20, 21, 22, 24, 29, 30, 40, 41, 52], tmp_path)
    same(got, rows_of(evaluate(df, OUTPUTS), list(OUTPUTS)))
    assert seen <= 25  # the state doesn't grow with the history


def test_recursive_factors_in_batches(spark, tmp_path):
    df = panel(spark, 48, 5, 0.0).cache()
    uses = lambda e, op: e.op == op or any(uses(c, op) for c in e.children)
    names = ["relative_strength_index_6", "consecutive_up_days", "on_balance_volume", "kaufman_adaptive_moving_average_10_2_30"]
    # one of each family with a recurrence that the short panel reaches
    names += [min(f.name for f in some) for some in families().values() if any(uses(f.series, "recur") for f in some)]
    outputs = {n: REGISTRY[n].series for n in dict.fromkeys(names)}
    got, _ = in_batches(spark, df, outputs, [15, 16, 33], tmp_path)
    same(got, rows_of(evaluate(df, outputs), list(outputs)))


def test_what_can_not_be_carried(spark):
    df = panel(spark, 5)
    with pytest.raises(ValueError, match="looks ahead"):
        carry(df, None, {"x": lead(C, 1)})
    _, state = carry(df, None, {"x": ema(C, 3)})
    with pytest.raises(ValueError, match="other outputs"):
        carry(df, state, {"x": ema(C, 4)})
    _, state = carry(df, None, {"x": lag(C, 1)})
    with pytest.raises(ValueError, match="other outputs"):  # the same columns, but fewer rows than it takes
        carry(df, state, {"x": lag(C, 4)})
    with pytest.raises(ValueError, match="other outputs"):
        carry(df, state, {"x": skip_avg(C, 2)})
    results, state = carry(df.limit(0), None, {"x": ema(C, 3)})
    assert results.count() == state.count() == 0
