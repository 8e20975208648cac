"""Factors by SQL over views, and over bars stored by symbol."""

import datetime as dt

import pytest

from kairopanel.functions.series import Kernel, avg, col, ema, evaluate, kernel
from kairopanel.operators.factors import REGISTRY, register
from kairopanel.plans.views import publish
from kairopanel.sources.catalog import Catalog
from tests.test_series import panel, values

C = col("close_hfq")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sql_gives_what_evaluate_gives(spark):
    df = panel(spark, [float(i % 7) for i in range(40)]).union(panel(spark, [1.0, 2.0, 3.0], 2))
    views = publish(df, ["factor_simple_moving_average", "patterns"], "t_")
    assert views == ["t_factor_simple_moving_average", "t_patterns"]
    got = spark.sql("SELECT ts_code, trade_date, simple_moving_average_5 AS x, cdldoji AS d FROM t_factor_simple_moving_average JOIN t_patterns USING (ts_code, trade_date)")
    assert values(got) == values(evaluate(df, {"x": avg(C, 5)}))
    with pytest.raises(ValueError, match="no view"):
        publish(df, ["nothing"])


def test_views_compute_what_is_selected(spark):
    publish(panel(spark, [1.0, 2.0]), ["factor_simple_moving_average"], "u_")
    one = plan(spark.sql("SELECT ts_code, simple_moving_average_3 FROM u_factor_simple_moving_average WHERE ts_code = 2"))
    every = plan(spark.table("u_factor_simple_moving_average"))
    assert one.count("windowspec") < every.count("windowspec") / 3
    assert one.index("Filter") > one.rindex("Window ")  # the condition lies below the windows


def test_user_kernels_reach_sql(spark):
    def plus_one(x):
        return x.to_numpy(zero_copy_only=False) + 1

    register("own_plus_one", "own", kernel(Kernel("plus_one", plus_one, 1), C))
    try:
        publish(panel(spark, [1.0, 2.0, 4.0]), ["factor_own"])
        assert [r[0] for r in spark.sql("SELECT own_plus_one FROM factor_own ORDER BY trade_date").collect()] == [2.0, 3.0, 5.0]
    finally:
        del REGISTRY["own_plus_one"]


def test_clustered_bars(spark, tmp_path):
    x = [float(i * 7 % 11) for i in range(400)]  # 2020 and the start of 2021
    df = panel(spark, x).union(panel(spark, x[::-1], 2)).union(panel(spark, x[5:], 3))
    catalog = Catalog(spark, f"file://{tmp_path}")
    catalog.write_clustered(df, "bars", buckets=3)
    stored = catalog.read_clustered("bars")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    trees = {"m": avg(C, 20), "e": ema(C, 5)}
    got = evaluate(stored, {"m": trees["m"]}, chunk_days=None)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in evaluate(stored, {"e": trees["e"]})._jdf.queryExecution().executedPlan().toString()
    for n in trees:
        assert values(evaluate(stored, trees), n) == values(evaluate(df, trees), n)
    # a later year again, with other prices: the first year stays
    later = panel(spark, [v + 1 for v in x]).where("trade_date >= '2021-01-01'")
    for _ in range(2):
        catalog.replace_years(later, "bars")
        now = catalog.read_clustered("bars")
        assert now.where("trade_date < '2021-01-01'").count() == df.where("trade_date < '2021-01-01'").count()
        assert sorted(map(tuple, now.where("trade_date >= '2021-01-01'").collect())) == sorted(map(tuple, later.collect()))
    # another session knows the layout from the folder
    for t in spark.catalog.listTables():
        if t.name.startswith("clustered_"):
            spark.sql(f"DROP TABLE {t.name}")
    again = catalog.read_clustered("bars", [2021])
    assert again.agg({"trade_date": "min"}).first()[0] == dt.date(2021, 1, 1)
    assert "Exchange" not in evaluate(again, {"m": trees["m"]})._jdf.queryExecution().executedPlan().toString()
    assert catalog.exists("bars")
    with pytest.raises(FileNotFoundError):
        catalog.read_clustered("nothing")


def test_clustered_empty_table(spark, tmp_path):
    catalog = Catalog(spark, f"file://{tmp_path}")
    catalog.write_clustered(panel(spark, []), "bars", buckets=2)
    assert catalog.read_clustered("bars").count() == 0
