"""Kernels: order statistics against plain windows, user kernels beside built-in series, in batches and in SQL."""

import datetime as dt
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from kairopanel.functions import order
from kairopanel.functions.carried import carry
from kairopanel.functions.series import Kernel, avg, col, ema, evaluate, greater_count, kernel, lag, mean_deviation, to_sql, total
from tests.test_series import panel, values

C = col("close_hfq")


def plain(x, n):
    """Count of greater values and mean deviation of each window of n, row after row."""
    for i in range(len(x)):
        v = x[max(0, i - n + 1) : i + 1]
        if len(v) < n or None in v:
            yield None, None
        else:
            m = math.fsum(v) / n
            yield float(sum(a > v[-1] for a in v)), math.fsum(abs(a - m) for a in v) / n


@pytest.mark.parametrize("n", [1, 2, 7, 33, 64, 250])
def test_order_statistics_against_plain_windows(n):
    g = random.Random(n)
    x = [None if i in (0, 300, 301) else 4.0 if 400 <= i < 410 + n else float(g.randrange(9)) if i % 3 else g.uniform(-2, 9) for i in range(1200)]
    got = zip(order.count_greater(pa.array(x, pa.float64()), n).to_pylist(), order.mean_deviation(pa.array(x, pa.float64()), n).to_pylist(), strict=True)
    for i, (have, want) in enumerate(zip(got, plain(x, n), strict=True)):
        assert have[0] == want[0], i
        assert have[1] == (None if want[1] is None else pytest.approx(want[1], rel=1e-12, abs=1e-13)), i


def test_order_statistics_of_little_data_and_odd_values():
    for x in ([], [None], [None] * 40, [1.0] * 5):
        assert order.count_greater(pa.array(x, pa.float64()), 40).to_pylist() == order.mean_deviation(pa.array(x, pa.float64()), 40).to_pylist() == [None] * len(x)
    big = [1e12] * 40 + [0.1] * 100
    got = order.mean_deviation(pa.array(big), 40).to_pylist()
    assert got[39] == 0.0 and got[79:] == [0.0] * 61 and got[60] > 1e11
    nan = [math.nan, *[float(i % 5) for i in range(99)]]
    assert order.count_greater(pa.array(nan), 40).to_pylist()[39] == 1 + sum(i % 5 > 38 % 5 for i in range(39))
    assert math.isnan(order.mean_deviation(pa.array(nan), 40).to_pylist()[39]) and order.mean_deviation(pa.array(nan), 40).to_pylist()[40] == pytest.approx(1.2)


def test_long_windows_run_as_kernels_and_give_the_same(spark):
    g = random.Random(4)
    x = [None if i == 150 else round(g.uniform(0, 40), 1) for i in range(500)]
    df = panel(spark, x).union(panel(spark, x[::-1], 2))
    got = evaluate(df, {"g20": greater_count(C, 20), "g120": greater_count(C, 120), "d20": mean_deviation(C, 20), "d120": mean_deviation(C, 120), "nested": greater_count(avg(C, 3), 50)})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    rows = got.orderBy("ts_code", "trade_date").collect()
    for s, xs in enumerate((x, x[::-1])):
        means = [None if i < 2 or None in xs[i - 2 : i + 1] else math.fsum(xs[i - 2 : i + 1]) / 3 for i in range(500)]
        for n in (20, 120):
            for r, (count, dev) in zip(rows[s * 500 :], plain(xs, n)):
                assert r[f"g{n}"] == count and r[f"d{n}"] == (None if dev is None else pytest.approx(dev, rel=1e-12))
        at = rows[s * 500 + 499]
        assert at.nested is not None and at.nested == pytest.approx(sum(m > means[-1] + 1e-12 for m in means[-50:]), abs=1)


def moving_median(n):
    """A kernel's function: the median of the newest n rows, nulls as NaN."""

    def median(x):
        v = x.to_numpy(zero_copy_only=False)
        return np.array([np.nan if i < n - 1 else np.median(v[i - n + 1 : i + 1]) for i in range(len(v))])

    return median


MEDIAN = Kernel("median_3", moving_median(3), 3)


def test_user_kernels_compose_with_series(spark):
    x = [5.0, 1.0, 3.0, 9.0, 2.0, 2.5]
    want = [1.0 * v for v in (3, 3, 3, 2.5)]
    got = evaluate(panel(spark, x), {"m": kernel(MEDIAN, C), "twice": kernel(MEDIAN, C) * 2 + lag(C, 1), "e": ema(kernel(MEDIAN, C * 1), 3), "const": kernel(Kernel("plus", lambda a, b: a.to_numpy() + b.to_numpy(), 1), C, 2)})
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # the mean of a kernel is a second pass
    assert values(got, "m")[2:] == want and values(got, "twice")[2:] == [2 * m + c for m, c in zip(want, x[1:])]
    assert values(got, "const") == [v + 2 for v in x]


def test_kernels_are_checked(spark):
    short = Kernel("short", lambda a: a.slice(1))
    with pytest.raises(Exception, match="values for"):
        evaluate(panel(spark, [1.0, 2.0]), {"x": kernel(short, C)}).collect()
    with pytest.raises(ValueError, match="two kernels"):
        evaluate(panel(spark, [1.0]), {"x": kernel(MEDIAN, C), "y": kernel(Kernel("median_3", lambda a: a, 3), C)})
    with pytest.raises(ValueError, match="no SQL form"):
        to_sql("SELECT 1", {"x": kernel(MEDIAN, C)})
    with pytest.raises(ValueError, match="can't be carried"):
        carry(panel(spark, [1.0]), None, {"x": kernel(short, C)})
    assert evaluate(panel(spark, []), {"x": kernel(MEDIAN, C), "g": greater_count(C, 40)}).count() == 0


def test_kernels_in_batches_equal_one_evaluation(spark):
    g = random.Random(9)
    x = [None if i == 70 else g.uniform(1, 9) for i in range(160)]
    df = panel(spark, x).union(panel(spark, x[::-1], 2))
    outputs = {"g": greater_count(C, 40), "d": mean_deviation(avg(C, 2), 40), "m": kernel(MEDIAN, C) + total(C, 3), "e": ema(kernel(MEDIAN, C), 5)}
    whole = {(r.ts_code, r.trade_date): r for r in evaluate(df, outputs).collect()}
    state, n = None, 0
    keep = lambda f: spark.createDataFrame(f.collect(), f.schema)
    for lo, hi in ((0, 50), (50, 60), (60, 61), (61, 160)):
        day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
        got, state = carry(df.where((df.trade_date >= day(lo)) & (df.trade_date < day(hi))), state, outputs)
        state = keep(state)
        for r in got.collect():
            n += 1
            for k in outputs:
                want = whole[r.ts_code, r.trade_date][k]
                assert r[k] == (want if want is None or math.isnan(want) and math.isnan(r[k]) else pytest.approx(want, rel=1e-11)) or math.isnan(r[k]), (k, lo)
    assert n == 320
