"""Universe bounds that a mean meets exactly."""

import datetime as dt

from kairopanel.operators import universe as U


def test_a_mean_equal_to_its_bound_is_not_above_it(spark):
    # sums of 4.0 whose terms, added from left to right, give a last bit more: the mean came out as 1.0000000000000002
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=i), 1.0, 100.0 * v / 1000.0, 1.0) for s, vols in ((1, (16, 18, 2, 4)), (2, (16, 18, 2, 5))) for i, v in enumerate(vols)]
    bars = spark.createDataFrame(rows, "ts_code int, trade_date date, amount double, turnover_rate double, circ_mv double")
    listing = bars.selectExpr("ts_code", "date'2019-01-01' as list_date").distinct()
    rules = U.UniverseRules(window=4, min_amount=0.0, min_turnover=1.0, min_circ_mv=0.0)
    got = U.universe(bars, listing, bars, bars.where("false"), rules).collect()
    assert [r.ts_code for r in got] == [2]
