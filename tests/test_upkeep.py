"""Incremental upkeep against one evaluation over all bars."""

import datetime as dt

from kairopanel.functions.series import avg, col, cumulative, ema, evaluate, lag, rank_desc
from kairopanel.sources.catalog import Catalog
from kairopanel.streaming.incremental import upkeep

D = [dt.date(2015, 1, 1) + dt.timedelta(days=150 * i) for i in range(8)]


def test_upkeep_equals_one_evaluation(spark, tmp_path):
    c = col("close_hfq")
    outputs = {"mean": avg(c, 3), "sum": cumulative(c), "ema": ema(c, 5), "rank": rank_desc(c / lag(c, 1) - 1)}
    alone = {k: v for k, v in outputs.items() if k != "rank"}
    schema = "ts_code long, trade_date date, close_hfq double"
    bar = lambda s, i, x=0.0: (s, D[i], 10.0 * s + (7 * s * i) % 5 + x)
    files = [[bar(s, i) for s in (1, 2, 3) for i in range(5)], [bar(1, 5), bar(1, 6)], [bar(2, 5), bar(3, 5)], [bar(2, 2, 4.5)]]  # a day in two files; a corrected bar
    want = spark.createDataFrame(list({r[:2]: r for f in files for r in f}.values()), schema)
    cat = Catalog(spark, str(tmp_path / "tables"))
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
        for name, some in (("all", outputs), ("own", alone)):
            upkeep(spark, str(tmp_path / "in"), want.schema, cat, f"bars_{name}", name, some, str(tmp_path / f"cp_{name}")).start().awaitTermination()
    shown = lambda df, some: sorted((r.ts_code, r.trade_date, *(None if r[n] is None else round(r[n], 9) for n in some)) for r in df.collect())
    for name, some in (("all", outputs), ("own", alone)):
        assert cat.read(f"bars_{name}").count() == want.count()
        assert shown(cat.read(name), some) == shown(evaluate(want, some), some)


def test_merge_reads_only_touched_days(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    rows = spark.createDataFrame([(s, d, 1.0) for s in (1, 2) for d in D], "ts_code long, trade_date date, x double")
    cat.replace_days(rows, "bars")
    got = cat.touched("bars", rows.where(f"ts_code = 1 and trade_date >= date'{D[6]}'"))
    assert sorted((r.ts_code, r.trade_date) for r in got.collect()) == [(s, d) for s in (1, 2) for d in D[6:]]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan or "PartitionFilters: [_day" in plan
    assert len(got.inputFiles()) <= 2 * len(D) and got._jdf.queryExecution().toString().count("PartitionFilters: []") == 0
