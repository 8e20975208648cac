"""Landing of vendor files and the batch jobs, from tables to tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kairopanel.functions.series import Series, avg, col, cumulative, ema, evaluate
from kairopanel.operators import analysis as A
from kairopanel.operators import ingest as I
from kairopanel.operators.universe import filled_list
from kairopanel.plans import jobs
from kairopanel.sources.catalog import Catalog

D = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(60)]


def test_dates(spark):
    df = spark.createDataFrame([("20200131",), ("2020131",), ("20201341",), ("x",), ("",), (None,)], "d string")
    assert [r[0] for r in df.select(I.parse_day(F.col("d"))).collect()] == [dt.date(2020, 1, 31), *[None] * 5]
    assert df.where("d is null or d = '20200131'").select(I.parse_day(F.col("d"), strict=True).alias("d")).where("d is null").count() == 1
    with pytest.raises(Exception, match="not a date"):
        df.select(I.parse_day(F.col("d"), strict=True)).collect()


def test_keep_one(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, None), (None, 5, "z"), (None, 4, "w"), ("b", None, "n")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    got = lambda last: sorted(((r.k or "", r.at, r.v) for r in I.keep_one(df, ["k"], [F.col("at")], last).collect()), key=str)
    assert got(True) == sorted([("a", 3, "y"), ("", 5, "z"), ("b", None, "n")], key=str)
    assert got(False) == sorted([("a", 1, "x"), ("", 4, "w"), ("b", None, "n")], key=str)
    assert I.keep_one(df.limit(0), ["k"], [F.col("at")]).count() == 0


def test_calendar_and_dimension(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    raw = lambda rows: spark.createDataFrame(rows, "exchange string, cal_date string, is_open string, pretrade_date string")
    I.ingest_calendar(cat, raw([("A", "20200101", "0", "20191231"), ("A", "20200102", "1", "20191231")]))
    got = I.ingest_calendar(cat, raw([("A", "20200102", "0", "20191231"), ("A", "20200103", "1", "bad")])).orderBy("cal_date").collect()
    assert [(r.cal_date.day, r.is_open, r.pretrade_date) for r in got] == [(1, 0, dt.date(2019, 12, 31)), (2, 0, dt.date(2019, 12, 31)), (3, 1, None)]
    stocks = spark.createDataFrame([("s1", "1", "20200101"), ("s1", "1", "20200301"), ("s2", "2", None)], "ts_code string, symbol string, list_date string")
    got = {r.symbol: (r.list_date, r.last_update) for r in I.ingest_dimension(cat, stocks, "stocks", "symbol", D[0]).collect()}
    assert got == {"1": (dt.date(2020, 3, 1), D[0]), "2": (None, D[0])}


def bars(spark, days, symbols=12):
    g = random.Random(1)
    rows = [(s, d, 10 + s + g.random(), 1000.0 * (s + 1), f"i{s % 3}") for s in range(symbols) for d in days]
    return spark.createDataFrame(rows, "ts_code int, trade_date date, close_hfq double, circ_mv double, industry string")


def test_batch_equals_one_evaluation(spark, tmp_path):
    cat, every = Catalog(spark, str(tmp_path)), bars(spark, D[:30], 3)
    c = col("close_hfq")
    outputs = {"m": avg(c, 10), "s": cumulative(c), "e": ema(c, 5)}
    for end in (D[9], D[9], D[20], D[29]):
        jobs.series_batch(cat, every, "factors", outputs, end)
    written = jobs.series_batch(cat, every, "again", outputs, D[29], start=D[25])
    assert written.count() == 15
    shown = lambda df: sorted((r.ts_code, r.trade_date, *(None if r[n] is None else round(r[n], 9) for n in outputs)) for r in df.collect())
    assert shown(cat.read("factors")) == shown(evaluate(every, outputs))
    assert jobs.series_batch(cat, every, "factors", outputs, D[29]).count() == 0
    with pytest.raises(ValueError, match="vol"):
        jobs.series_batch(cat, every, "other", {"x": avg(col("vol"), 2)}, D[29])
    with pytest.raises(ValueError, match="more than once"):
        I.validate_result(every.select("ts_code", "trade_date", F.lit(1).alias("x")).union(every.limit(1).select("ts_code", "trade_date", F.lit(1))), ["x"])
    with pytest.raises(ValueError, match="outputs"):
        I.validate_result(every, ["close_hfq"])


def test_daily_batches_read_new_days_only(spark, tmp_path):
    cat, every = Catalog(spark, str(tmp_path)), bars(spark, D[:30], 3).cache()
    c = col("close_hfq")
    outputs = {"m": avg(c, 10), "s": cumulative(c), "e": ema(c, 5)}
    broken = {"no_column": avg(col("vol"), 3), "no_rule": Series("no such rule", (c,)), **outputs}
    at = -1
    for k, end in enumerate([14, 15, 16, 16, 20, 29]):
        # older rows aren't even there any more
        got = jobs.daily_batch(cat, every.where(F.col("trade_date") > D[max(at, 0)]) if k else every, "factors", broken, D[end])
        assert got.status["m"] == got.status["s"] == got.status["e"] == "done"
        assert "vol" in got.status["no_column"] and (end == at or "KeyError" in got.status["no_rule"])
        assert (got.written is None) == (end == at) and (got.written is None or got.written.count() == 3 * (end - at))
        assert len(cat.list("factors_state")) == 1
        at = end
    shown = lambda df: sorted((r.ts_code, r.trade_date, *(None if r[n] is None else round(r[n], 9) for n in outputs)) for r in df.collect())
    table = cat.read("factors")
    assert shown(table) == shown(evaluate(every, outputs)) and table.where("no_column is not null or no_rule is not null").count() == 0
    # other outputs: everything is computed once more, and the state goes on from there
    more = jobs.daily_batch(cat, every, "factors", {**outputs, "t": avg(c, 2)}, D[29])
    assert more.written is None  # no new day
    later = bars(spark, D[:32], 3)
    more = jobs.daily_batch(cat, later, "factors", {**outputs, "t": avg(c, 2)}, D[31])
    assert more.written.count() == 32 * 3 and more.written.where("t is null").count() == 3


def test_filled_list_over_block_borders(spark):
    g = random.Random(3)
    for block_days in (1, 4, 256):
        flagged = {d: g.sample("abcdef", g.randint(1, 3)) for d in D if g.random() < 0.3}
        days = [d for d in D if g.random() < 0.9]
        rows = [(x, d) for d, some in flagged.items() if d in days for x in some * 2]
        got = {}
        for r in filled_list(spark.createDataFrame(rows, "ts_code string, trade_date date"), spark.createDataFrame([(d,) for d in days * 2], "trade_date date"), block_days).collect():
            got.setdefault(r.trade_date, []).append(r.ts_code)
        full = [d for d in days if d in flagged]
        for d in days:
            near = [d] if d in flagged else [*[x for x in full if x < d][-1:], *[x for x in full if x > d][:1]]
            assert sorted(got.get(d, [])) == sorted({x for n in near for x in flagged[n]})


def test_landing_keeps_bad_rows_apart(spark, tmp_path):
    cat, fields = Catalog(spark, str(tmp_path / "t")), {"ts_code": "string", "trade_date": "date", "close": "double", "vol": "bigint"}
    lines = [f"s{i % 10},202001{1 + i // 10:02d},{i / 4},{i}" for i in range(100)]
    lines[3], lines[50], lines[99] = "s3,2020131,1.0,1", "s0,20200106,much,7", ",20200110,1.5,"
    one, two, none = (str(tmp_path / n) for n in ("one.csv", "two.csv", "none.csv"))
    for path, some in ((one, lines), (two, ["s1,2020-01-01,77.5,", "s1,20200301,1,1", "s1,20200301,1,1"]), (none, [])):
        with open(path, "w") as f:
            f.write("\n".join(["ts_code,trade_date,close,vol", *some]) + "\n")
    shown = lambda rows: sorted(tuple(r) for r in rows.collect())
    assert shown(I.land_files(cat, [one], "daily", fields)) == [(one, 97, 3)]
    first = shown(cat.read("daily"))
    assert len(first) == 97
    why = {r.reason: r.text for r in cat.read("daily_quarantine").collect()}
    assert set(why) == {"trade_date is no date: 2020131", "close is no double: much", "ts_code is missing"} and "much" in why["close is no double: much"]
    assert shown(I.land_files(cat, [one], "daily", fields)) == [(one, 97, 3)] and shown(cat.read("daily")) == first
    assert cat.read("daily_ledger").count() == 1 and cat.read("daily_quarantine").count() == 3
    # broken off before the ledger: done again, nothing is there twice; a later file corrects a row
    cat.delete("daily_ledger")
    assert shown(I.land_files(cat, [one, two, none], "daily", fields)) == sorted([(one, 97, 3), (two, 3, 0), (none, 0, 0)])
    table = cat.read("daily")
    assert table.count() == 98 and cat.read("daily_quarantine").count() == 3
    assert [(r.close, r.vol) for r in table.where("ts_code = 's1' and trade_date = date'2020-01-01'").collect()] == [(77.5, None)]


def test_analysis_tables(spark, tmp_path):
    cat, p = Catalog(spark, str(tmp_path)), bars(spark, D)
    rules = A.AnalysisRules(horizons=(1, 5), min_sample=6)
    active = p.select("ts_code", "trade_date", (F.col("circ_mv") * 2).alias("amount_20d_avg"), (F.col("ts_code") + 1.0).alias("turnover_rate_20d_avg"))
    values = p.select("ts_code", "trade_date", F.lit("f").alias("factor"), (F.col("close_hfq") % 1).alias("value"))
    industry = p.select("ts_code", "industry").distinct()
    assert jobs.stale(cat, ["f", "none"], "factor_analysis/summary", D[0], rules) == ["f", "none"]
    for _ in range(2):
        status = {r.factor: r.status for r in jobs.factor_analysis(cat, values, ["f", "none"], p, active, industry, D[50], rules).collect()}
    assert status == {"f": "done", "none": "empty"}
    summary = cat.read("factor_analysis/summary")
    assert sorted((r.factor, r.horizon, r.updated_at) for r in summary.collect()) == [("f", 1, D[50]), ("f", 5, D[50])]
    ranks = A.ranked(A.prepare(A.sample(values, ["f"], p, active, industry), rules), rules)
    want = {(r.horizon, r.trade_date): r.ic for r in A.information_coefficients(ranks).collect()}
    assert {(r.horizon, r.trade_date): r.ic for r in cat.read("factor_analysis/ic").collect()} == want and len(want) > 100
    assert cat.read("factor_analysis/raw_monitor").where("factor = 'f'").count() == 60 == cat.read("factor_analysis/monitor").where("factor = 'none'").count()
    assert jobs.stale(cat, ["f", "none"], "factor_analysis/summary", D[59], rules) == ["none"]
    assert jobs.stale(cat, ["f"], "factor_analysis/summary", D[50] + dt.timedelta(days=26), rules) == ["f"]
    signals = values.withColumn("value", F.when(F.col("value") > 0.8, 1.0).when(F.col("value") < 0.1, -1.0).otherwise(0.0))
    assert jobs.event_study(cat, signals, ["f"], p, active, D[50], rules).first().status == "done"
    row = cat.read("event_study/summary").where("horizon = 1").first()
    assert row.event_count == row.bullish_event_count + row.bearish_event_count > 0 and 0 <= row.p_value <= 1
    empty = jobs.factor_analysis(cat, values.limit(0), ["g"], p.limit(0), active.limit(0), industry, D[50], rules, folder="nothing")
    assert [tuple(r) for r in empty.collect()] == [("g", "empty")]
