"""Universe, cross-section and event-study operators on hand-made frames; catalog and incremental upkeep."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from kairopanel.functions.series import avg, col
from kairopanel.operators import analysis as A
from kairopanel.operators import universe as U
from kairopanel.sources.catalog import Catalog
from kairopanel.streaming.incremental import upkeep

D = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(40)]


def frame(spark, values, day=D[0], **extra):
    names = list(extra)
    rows = [("f", i, day, v, *(extra[n][i] for n in names)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "factor string, ts_code int, trade_date date, value double" + "".join(f", {n} {'string' if n == 'industry' else 'double'}" for n in names))


def by_code(df):
    return [r.value for r in df.orderBy("ts_code").collect()]


def test_winsor(spark):
    assert by_code(A.winsorize(frame(spark, [7.0]))) == [7.0]
    got = by_code(A.winsorize(frame(spark, [float(i) for i in range(100)])))
    assert got[0] == 1.0 and got[99] == 98.0 and got[50] == 50.0
    assert by_code(A.winsorize(frame(spark, [1.0, None, 3.0]))) == [1.0, None, 1.0]


def test_neutral_and_standard(spark):
    got = by_code(A.neutralize_industry(frame(spark, [1.0, 3.0, 10.0, 20.0], industry=["a", "a", None, None])))
    assert got == [-1.0, 1.0, -5.0, 5.0]
    got = by_code(A.neutralize(frame(spark, [2.0, 4.0, 6.0], circ_mv=[1.0, 2.0, 3.0]), "circ_mv", log=False))
    assert got == pytest.approx([0.0, 0.0, 0.0])
    assert by_code(A.neutralize(frame(spark, [2.0, 4.0], circ_mv=[5.0, 5.0]), "circ_mv", log=False)) == [-1.0, 1.0]
    assert by_code(A.standardize(frame(spark, [3.0, 3.0]))) == [None, None]
    assert by_code(A.standardize(frame(spark, [1.0, 3.0]))) == [-1.0, 1.0]


def test_groups_and_ic(spark):
    rules = A.AnalysisRules(horizons=(1,), groups=5, min_sample=7)
    ranks = A.ranked(frame(spark, [float(i) for i in range(7)], forward_return_1=[0.1 * i for i in range(7)]), rules)
    assert [r["group"] for r in ranks.orderBy("ts_code").collect()] == [1, 1, 2, 3, 3, 4, 5]
    assert A.information_coefficients(ranks).first().ic == 1.0
    g = A.group_returns(ranks, rules).first()
    assert g.long_turnover == 0.0 and g.long_short == pytest.approx(0.6 - 0.05)
    assert A.ranked(frame(spark, [1.0] * 6, forward_return_1=[0.0] * 6), rules).count() == 0


def test_events(spark):
    f = frame(spark, [1.0, -1.0, 0.0], forward_return_1=[0.2, 0.1, 0.3])
    r = A.event_summary(f, (1,)).first()
    assert (r.event_count, r.bullish_event_count, r.bearish_event_count) == (2, 1, 1)
    assert r.avg_signal_return == pytest.approx(0.05) and r.win_rate == 0.5 and 0 <= r.p_value <= 1
    none = A.event_summary(frame(spark, [0.0], forward_return_1=[0.2]), (1,)).first()
    assert none.event_count == 0 and none.avg_signal_return is None and none.active_years == 0


def test_p_values(spark):
    t = [0.0, 0.3, -1.0, 1.96, 3.5, 3.6, -8.0, 30.0, None, float("nan")]
    got = [r.p for r in spark.createDataFrame([(x,) for x in t], "t double").select(A.two_sided_p(F.col("t")).alias("p")).collect()]
    for x, p in zip(t[:-2], got, strict=False):
        assert p == pytest.approx(math.erfc(abs(x) / math.sqrt(2)), rel=1e-11)
    assert got[-2:] == [None, None]


@pytest.mark.parametrize("whole", [10_000, 100])
def test_picked_ranks(spark, whole):
    g = random.Random(3)
    values = {"a": [g.gauss(0, 1) for _ in range(20_001)], "b": [float(g.randrange(7)) for _ in range(5_000)], "c": [2.0], "d": [3.0, 1.0], "e": [1.5] * 3_000}
    df = spark.createDataFrame([(k, x) for k, v in values.items() for x in v], "k string, x double")
    got = {r.k: r for r in A.picked_ranks(df, ["k"], "x", whole).collect()}
    for k, v in values.items():
        v, n = sorted(v), len(v)
        assert (got[k].q05, got[k].q95) == (v[int((n - 1) * 0.05 + 0.5)], v[int((n - 1) * 0.95 + 0.5)])
        assert got[k]["median"] == (v[(n - 1) // 2] + v[n // 2]) / 2


def test_flag_list(spark):
    days = spark.createDataFrame([(d,) for d in D[:4]], "trade_date date")
    flags = spark.createDataFrame([("A", D[0]), ("B", D[0]), ("B", D[2]), ("C", D[2])], "ts_code string, trade_date date")
    got = {}
    for r in U.filled_list(flags, days).collect():
        got.setdefault(r.trade_date, set()).add(r.ts_code)
    assert got == {D[0]: {"A", "B"}, D[1]: {"A", "B", "C"}, D[2]: {"B", "C"}, D[3]: {"B", "C"}}
    assert U.filled_list(flags.limit(0), days).count() == 0


def test_calendar(spark):
    cal = spark.createDataFrame([("A", D[0], 1, D[0]), ("B", D[0], 1, D[0]), ("A", D[1], 0, D[0]), ("B", D[1], 0, D[0]), ("A", D[2], 1, D[0]), ("B", D[2], 0, D[0])], "exchange string, cal_date date, is_open int, pretrade_date date")
    assert [r[0] for r in U.open_days(cal).collect()] == [D[0]]
    assert U.calendar_end(cal, D[0]) == D[0] and U.calendar_end(cal, D[1]) == D[0] and U.calendar_end(cal, D[9]) == D[9]
    with pytest.raises(ValueError):
        U.calendar_end(cal, D[2])
    assert U.trading_days(cal, D[0], D[0], dt.datetime(2020, 1, 1, 9)).count() == 0


def test_missing_adjustment_is_an_error(spark):
    price = spark.createDataFrame([("A", D[0], 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], "ts_code string, trade_date date, open double, high double, low double, close double, pre_close double, vol double, amount double")
    metric = spark.createDataFrame([("A", D[0], 1.0, 1.0)], "ts_code string, trade_date date, turnover_rate double, circ_mv double")
    none = spark.createDataFrame([], "ts_code string, trade_date date, adj_factor double")
    with pytest.raises(Exception, match="no adj_factor"):
        U.factor_source(price, none, metric).collect()


def test_catalog_and_upkeep(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path / "tables"))
    schema = "ts_code long, trade_date date, close_hfq double"
    assert cat.read("none", spark.createDataFrame([], schema).schema).count() == 0
    rows = spark.createDataFrame([(1, d, float(i)) for i, d in enumerate(D[:6])], schema)
    cat.write(rows, "t")
    cat.append(rows.select("close_hfq", "trade_date", "ts_code"), "t")
    assert cat.read("t").count() == 12 and cat.read("t", columns=["close_hfq", "x"]).columns == ["close_hfq"]
    with pytest.raises(ValueError):
        cat.append(rows.drop("close_hfq"), "t")
    for _ in range(2):
        cat.replace_days(rows, "days")
    assert cat.read("days").count() == 6 and cat.read_years("days", [2020]).count() == 6
    assert cat.sql("SELECT count(*) AS n FROM v WHERE close_hfq > :x", {"x": 3.0}, v="t").first().n == 4

    src = tmp_path / "in"
    run = lambda: upkeep(spark, str(src), rows.schema, cat, "bars", "means", {"m": avg(col("close_hfq"), 3)}, str(tmp_path / "cp")).start().awaitTermination()
    rows.where(F.col("trade_date") < D[4]).coalesce(1).write.parquet(str(src), mode="append")
    run()
    rows.where(F.col("trade_date") >= D[4]).coalesce(1).write.parquet(str(src), mode="append")
    run()
    got = [r.m for r in cat.read("means").orderBy("trade_date").collect()]
    assert got == [None, None, 1.0, 2.0, 3.0, 4.0]
    assert cat.delete("means") and not cat.exists("means")
