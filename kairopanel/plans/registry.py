"""Named queries over the test tables, and the same results as SQL for another engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairopanel.functions.series import DAY, SYMBOL, Series, evaluate, rounded, rounded_sql, to_sql
from kairopanel.operators.factors import families
from kairopanel.operators.patterns import PATTERNS
from kairopanel.plans import analysis_queries, null_rules, views
from kairopanel.sources.panel import PANEL_SQL, derived_panel

def _series_query(outputs: dict[str, Series], whole: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        got = evaluate(derived_panel(spark, sf_dir), outputs)
        show = lambda c: F.col(c).cast("int") if whole else rounded(F.col(c))
        return got.select(SYMBOL, DAY, *[show(c).alias(c) for c in outputs])

    return query


def _series_sql(outputs: dict[str, Series], whole: bool = False) -> str:
    show = lambda c: f"CAST({c} AS INT)" if whole else rounded_sql(c)
    return f"SELECT {SYMBOL}, {DAY}, {', '.join(f'{show(c)} AS {c}' for c in outputs)} FROM ({to_sql(PANEL_SQL, outputs)})"


QUERIES, ORACLE_SQL = analysis_queries.QUERIES | null_rules.QUERIES | views.QUERIES, analysis_queries.ORACLE_SQL | null_rules.ORACLE_SQL | views.ORACLE_SQL
for _family, _factors in families().items():
    _outputs = {f.name: f.series for f in _factors}
    QUERIES[f"factor_{_family}"], ORACLE_SQL[f"factor_{_family}"] = _series_query(_outputs), _series_sql(_outputs)
_names = sorted(PATTERNS)
for _i in range(0, len(_names), 10):
    _outputs = {n: PATTERNS[n] for n in _names[_i : _i + 10]}
    _key = f"patterns_{_i + 1:02d}_{_i + len(_outputs):02d}"
    QUERIES[_key], ORACLE_SQL[_key] = _series_query(_outputs, whole=True), _series_sql(_outputs, whole=True)
