"""Factors and patterns in SQL: a temporary view per family over a panel.

A view is a plan, not a result: a query pays for the columns that it selects (windows that nobody reads are dropped) and a
condition on symbols reaches the scan. Joins of views over one panel by symbol and day need no further shuffle where the
panel is stored clustered by symbol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairopanel.functions.series import DAY, SYMBOL, Series, evaluate, to_sql
from kairopanel.operators.factors import families
from kairopanel.operators.patterns import PATTERNS
from kairopanel.sources.catalog import Catalog
from kairopanel.sources.panel import PANEL_SQL, derived_panel
from kairopanel.sources.shared import work_folder


def outputs() -> dict[str, dict[str, Series]]:
    """Views and their columns: factor_<family> for every family, users' factors included, and patterns."""
    return {f"factor_{family}": {f.name: f.series for f in some} for family, some in families().items()} | {"patterns": dict(PATTERNS)}


def publish(panel: DataFrame, only: list[str] | None = None, prefix: str = "") -> list[str]:
    """Makes the views (only: those of these names) and returns their names; prefix keeps those of several panels apart.

    A view has the symbol, the day and a column per output, for every row of the panel; an empty panel gives empty views.
    """
    known = outputs()
    if unknown := set(only or ()) - set(known):
        raise ValueError(f"no view {', '.join(sorted(unknown))}")
    names = [prefix + n for n in (known if only is None else only)]
    for n in names:
        evaluate(panel, known[n.removeprefix(prefix)]).createOrReplaceTempView(n)
    return names


# --- queries -------------------------------------------------------------------------------------------------------

_VIEWS = ["factor_simple_moving_average", "factor_relative_strength_index"]
_DAILY = """
SELECT trade_date, count(*) AS n_rows, count(simple_moving_average_20) AS n_mean, count(relative_strength_index_6) AS n_strength,
       count(CASE WHEN relative_strength_index_6 = 100 THEN 1 END) AS n_highest
FROM {mean} m JOIN {strength} s USING (ts_code, trade_date) GROUP BY trade_date"""


def _sql_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean, strength = publish(derived_panel(spark, sf_dir), _VIEWS, "derived_")
    return spark.sql(_DAILY.format(mean=mean, strength=strength))


def _clustered_outputs() -> dict[str, Series]:
    return {f.name: f.series for family in ("simple_moving_average", "momentum") for f in families().get(family, [])}


def _clustered_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = Catalog(spark, work_folder(spark, "bars"))
    catalog.write_clustered(derived_panel(spark, sf_dir), "bars")
    made = evaluate(catalog.read_clustered("bars"), _clustered_outputs())
    return made.groupBy(SYMBOL).agg(F.count(DAY).alias("n_days"), *[F.count(n).alias(n) for n in _clustered_outputs()])


def _sum_sql(names: list[str]) -> str:
    return f"SELECT {SYMBOL}, count({DAY}) AS n_days, {', '.join(f'count({n}) AS {n}' for n in names)}"


QUERIES = {"sql_factors": _sql_factors, "clustered_factors": _clustered_factors}
ORACLE_SQL = {
    "sql_factors": _DAILY.format(mean=f"({to_sql(PANEL_SQL, outputs()[_VIEWS[0]])})", strength=f"({to_sql(PANEL_SQL, outputs()[_VIEWS[1]])})"),
    "clustered_factors": f"{_sum_sql(list(_clustered_outputs()))} FROM ({to_sql(PANEL_SQL, _clustered_outputs())}) GROUP BY {SYMBOL}",
}
