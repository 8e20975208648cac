"""Primitives and factors against plain Python on small series, and against SQL on the test tables."""

import datetime as dt
import math
import random

import duckdb
import pytest

from kairopanel.functions.series import avg, coalesce, col, ema, evaluate, highest, kurtosis, lag, lowest, recur, rows_since_high, skewness, skip_avg, std, to_sql, total, var0, weighted
from kairopanel.operators.factors import REGISTRY, families, register
from kairopanel.operators.patterns import PATTERNS

DAY0 = dt.date(2020, 1, 1)
SCHEMA = "ts_code long, trade_date date, open_hfq double, high_hfq double, low_hfq double, close_hfq double, vol double, amount double, turnover_rate double"


def panel(spark, closes, symbol=1, **cols):
    rows = []
    for i, c in enumerate(closes):
        got = {k: v[i] for k, v in cols.items()}
        o, h, low = got.get("o", c), got.get("h", c), got.get("l", c)
        rows.append((symbol, DAY0 + dt.timedelta(days=i), o, h, low, c, got.get("v", 1.0), got.get("a", 1.0), got.get("t", 1.0)))
    return spark.createDataFrame(rows, SCHEMA)


def values(df, name="x"):
    return [r[name] for r in df.orderBy("ts_code", "trade_date").collect()]


def test_window_needs_all_its_rows(spark):
    x = [0.0, 1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0]
    assert values(evaluate(panel(spark, x), {"x": avg(col("close_hfq"), 3)})) == [None, None, 1.0, None, None, None, 5.0, 6.0]
    assert values(evaluate(panel(spark, x[4:]), {"x": weighted(col("close_hfq"), [1, 0, 2])})) == [None, None, 4 + 12.0, 5 + 14.0]


def test_nested_windows_and_recurrence(spark):
    c = [1.0, 4.0, 2.0, 8.0, 5.0, 7.0]
    got = values(evaluate(panel(spark, c), {"x": ema(ema(col("close_hfq"), 3), 3)}))
    e1 = e2 = None
    for v, g in zip(c, got):
        e1 = v if e1 is None else 0.5 * v + 0.5 * e1
        e2 = e1 if e2 is None else 0.5 * e1 + 0.5 * e2
        assert g == pytest.approx(e2, rel=1e-14)
    assert values(evaluate(panel(spark, c), {"x": avg(col("close_hfq") - lag(col("close_hfq"), 1), 2)}))[:4] == [None, None, 0.5, 2.0]


def test_recurrence_keeps_its_state_over_nulls(spark):
    c = [10.0, None, 20.0]
    assert values(evaluate(panel(spark, c), {"x": recur(col("close_hfq"), 0.5)})) == [10.0, None, 15.0]
    assert values(evaluate(panel(spark, c), {"x": recur(col("close_hfq"), 0.5, carry=True)})) == [10.0, 10.0, 15.0]
    assert values(evaluate(panel(spark, c), {"x": recur(col("close_hfq"), 0.5, init=50.0)})) == [30.0, None, 25.0]


def test_newest_extreme_and_gaps(spark):
    got = values(evaluate(panel(spark, [1.0, 5.0, 5.0, 2.0]), {"x": rows_since_high(col("close_hfq"), 3)}))
    assert got == [None, None, 0.0, 1.0]
    assert values(evaluate(panel(spark, [1.0, None, 3.0, 5.0]), {"x": skip_avg(col("close_hfq"), 2)})) == [None, None, 2.0, 4.0]


def test_symbols_do_not_mix(spark):
    two = panel(spark, [1.0, 2.0, 3.0]).union(panel(spark, [10.0, 20.0, 30.0], symbol=2))
    assert values(evaluate(two, {"x": avg(col("close_hfq"), 2)})) == [None, 1.5, 2.5, None, 15.0, 25.0]


def test_edge_cases_of_factors(spark):
    flat = panel(spark, [5.0] * 30)
    got = evaluate(flat, {n: REGISTRY[n].series for n in ("balance_of_power", "williams_percent_range_6", "relative_strength_index_6", "chande_momentum_oscillator_14", "stochastic_k_line_9_3_3", "udl", "bull_and_bear_index_3_6_12_21", "bull_and_bear_index_3_6_12_24", "return_kurtosis_20")}).orderBy("trade_date").collect()
    first, last = got[0], got[-1]
    assert last.balance_of_power is None and last.williams_percent_range_6 == 0.0 and last.relative_strength_index_6 == 100.0
    assert last.chande_momentum_oscillator_14 == 0.0 and last.stochastic_k_line_9_3_3 is None and last.return_kurtosis_20 is None
    assert first.udl == 0.0 and first.bull_and_bear_index_3_6_12_24 == 0.0 and first.bull_and_bear_index_3_6_12_21 is None


def test_plan_has_one_shuffle_for_many_factors(spark):
    names = ["simple_moving_average_5", "bollinger_upper_band_20_2", "average_true_range_14", "money_flow_index_14", "directional_movement_index_14"]
    plan = evaluate(panel(spark, [1.0, 2.0]), {n: REGISTRY[n].series for n in names})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_patterns_are_never_null(spark):
    c = [10.0, 9.0, 9.5, 12.0, 8.0]
    got = evaluate(panel(spark, c, o=[9.0, 10.0, 8.5, 9.0, 12.5], h=[11.0, 10.5, 10.0, 12.5, 13.0], l=[8.5, 8.5, 8.0, 8.9, 7.5]), PATTERNS)
    for r in got.collect():
        assert all(r[n] in (-1.0, 0.0, 1.0) for n in PATTERNS)
    rows = got.orderBy("trade_date").collect()
    assert rows[1].cdlengulfing == -1.0 or rows[2].cdlengulfing == 1.0
    assert rows[4].cdlengulfing == -1.0


def test_registry():
    assert sum(f.registered for f in REGISTRY.values()) == 225 and len(PATTERNS) == 60
    assert REGISTRY["plus_directional_movement_14"].fields == ["close_hfq", "high_hfq", "low_hfq"] or "high_hfq" in REGISTRY["plus_directional_movement_14"].fields
    with pytest.raises(ValueError):
        register("momentum_12", "mine", avg(col("close_hfq"), 2))
    assert "simple_moving_average" in families()


def test_sql_twin(spark):
    outputs = {"a": coalesce(avg(col("close_hfq"), 2), 0) + 1, "b": ema(col("close_hfq"), 4)}
    df = panel(spark, [1.0, 2.0, 4.0])
    got = [(r.a, r.b) for r in evaluate(df, outputs).orderBy("trade_date").collect()]
    want = duckdb.sql(to_sql("SELECT * FROM (VALUES (1, DATE '2020-01-01', 1.0::DOUBLE), (1, DATE '2020-01-02', 2.0::DOUBLE), (1, DATE '2020-01-03', 4.0::DOUBLE)) t(ts_code, trade_date, close_hfq)", outputs) + " ORDER BY trade_date").fetchall()
    assert got == [tuple(w[2:]) for w in want] and not any(math.isnan(x) for g in got for x in g)


AGGREGATES = {"avg": avg, "sum": total, "std": std, "var0": var0, "max": highest, "min": lowest, "skew": skewness, "kurt": kurtosis}


def plain_window(kind, v):
    n, m = len(v), math.fsum(v) / len(v)
    m2, m3, m4 = (math.fsum((x - m) ** k for x in v) for k in (2, 3, 4))
    return {"avg": m, "sum": math.fsum(v), "std": math.sqrt(m2 / (n - 1)), "var0": m2 / n, "max": max(v), "min": min(v), "skew": m3 * n**0.5 / m2**1.5 if m2 else None, "kurt": m4 * n / m2**2 if m2 else None}[kind]


@pytest.mark.parametrize("n", [5, 16, 119])
def test_aggregates_against_plain_windows(spark, n):
    g = random.Random(n)
    x = [None if i in (40, 41) else 3.25 if 60 <= i < 60 + n + 5 else g.uniform(-1, 5) for i in range(330)]
    df = panel(spark, x).union(panel(spark, x[::-1], 2))
    got = evaluate(df, {k: f(col("close_hfq"), n) for k, f in AGGREGATES.items()}).orderBy("ts_code", "trade_date").collect()
    for side, rows in ((x, got[:330]), (x[::-1], got[330:])):
        for i, r in enumerate(rows):
            v = side[max(0, i - n + 1) : i + 1]
            for k in AGGREGATES:
                want = plain_window(k, v) if len(v) == n and None not in v else None
                assert r[k] == (None if want is None else pytest.approx(want, rel=1e-12, abs=1e-13)), (k, i)


def test_aggregates_forget_what_has_left_the_window(spark):
    big = [1e12] * 30 + [0.01] * 80
    got = evaluate(panel(spark, big), {k: f(col("close_hfq"), 20) for k, f in AGGREGATES.items()}).orderBy("trade_date").collect()[50:]
    assert all(r.avg == pytest.approx(0.01, rel=1e-12) and r.sum == pytest.approx(0.2, rel=1e-12) and r.std == r.var0 == 0 and r.max == r.min == 0.01 and r.skew is None for r in got)
    nan = [1.0, 2.0, math.nan] + [float(i % 7) for i in range(80)]
    got = evaluate(panel(spark, nan), {k: f(col("close_hfq"), 20) for k, f in AGGREGATES.items()}).orderBy("trade_date").collect()
    assert math.isnan(got[20].avg) and math.isnan(got[21].std)
    for i in range(22, 83):
        for k in AGGREGATES:
            assert got[i][k] == pytest.approx(plain_window(k, nan[i - 19 : i + 1]), rel=1e-12)


def plain_fold(x, alpha, init, carry, fade):
    """Row after row, as the rule reads."""
    out, s, gap = [], init, 0
    for v, a in zip(x, alpha):
        if v is None or a is None:
            out.append(s if carry and a is not None else None)
            gap += 1
            continue
        if s is None:
            s = v
        elif fade and gap:
            w = (1 - a) ** (gap + 1)
            s = (a * v + w * s) / (a + w)
        else:
            s = a * v + (1 - a) * s
        gap = 0
        out.append(s)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_scan_against_plain_recurrence(spark, seed):
    g = random.Random(seed)
    n = [1, 2, 5, 200, 700, 3000][seed]
    x = [None if g.random() < 0.2 * (seed % 3) or 300 < i < 420 else g.uniform(-5, 50) for i in range(n)]
    t = [None if g.random() < 0.1 * (seed % 2) else g.choice([0.0, 1.0, g.random(), g.random() / 100]) for i in range(n)]
    df = panel(spark, x, t=t).union(panel(spark, [None] * n, 2, t=t)).union(panel(spark, x[::-1], 3, t=t[::-1]))
    c, a = col("close_hfq"), col("turnover_rate")
    rules = {"plain": (0.1, None, False, False), "seeded": (1 / 3, 50.0, False, False), "carried": (0.5, None, True, False), "both": (0.02, 7.0, True, False), "faded": (2 / 13, None, False, True), "moving": (a, None, False, False), "moving_carried": (a, 1.0, True, False)}
    trees = {k: recur(c, al, init, carry, fade) for k, (al, init, carry, fade) in rules.items()}
    for chunk_days in (None, 37):
        got = evaluate(df, trees, chunk_days=chunk_days).orderBy("ts_code", "trade_date").collect()
        for s, (xs, ts) in enumerate([(x, t), ([None] * n, t), (x[::-1], t[::-1])]):
            for k, (al, *rule) in rules.items():
                want = plain_fold(xs, ts if al is a else [al] * n, *rule)
                assert [r[k] for r in got[s * n : (s + 1) * n]] == [None if w is None else pytest.approx(w, rel=1e-12, abs=1e-12) for w in want], (k, s, chunk_days)
