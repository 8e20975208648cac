"""Daily batches and analyses from tables to tables: factor upkeep, factor analysis and event studies.

Every table is written by partition (day, or factor and horizon), so a rerun replaces what it has made before.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairopanel.functions.carried import carry, holds
from kairopanel.functions.series import DAY, SYMBOL, Series, evaluate
from kairopanel.operators import analysis as A
from kairopanel.operators.ingest import lacking_fields, validate_result
from kairopanel.operators.universe import next_start
from kairopanel.sources.catalog import Catalog


def series_batch(catalog: Catalog, source: DataFrame, target: str, outputs: dict[str, Series], end: dt.date, start: dt.date | None = None, history_days: int | None = None) -> DataFrame:
    """Computes outputs for the days from ``start`` (default: after the last stored one) to ``end`` into the table ``target``.

    The whole history up to ``end`` is read, as sums and recurrences begin with a symbol's first row; history_days
    shortens that for outputs of short windows. Returns the rows written; none if the table is up to date.
    """
    fields = {c for e in outputs.values() for c in _fields(e)}
    if missing := lacking_fields(source.columns, [SYMBOL, DAY, *sorted(fields)]):
        raise ValueError(f"the source has no {', '.join(missing)}")
    if start is None and catalog.exists(target):
        start = next_start(catalog.read(target))
    rows = source.where(F.col(DAY) <= F.lit(end))
    if history_days is not None and start is not None:
        rows = rows.where(F.col(DAY) >= F.date_sub(F.lit(start), history_days))
    new = evaluate(rows, outputs)
    if start is not None:
        new = new.where(F.col(DAY) >= F.lit(start))
    catalog.write(validate_result(new, list(outputs), check_keys=False), f"{target}_batch")
    written = validate_result(catalog.read(f"{target}_batch"), list(outputs))  # read from what is written: computed once
    if not written.isEmpty():
        catalog.replace_days(written, target)
    return written


@dataclass
class Batch:
    """What a daily batch wrote (None: nothing new), and for every output "done" or why it failed."""

    written: DataFrame | None
    status: dict[str, str]


def daily_batch(catalog: Catalog, source: DataFrame, target: str, outputs: dict[str, Series], end: dt.date, state: str | None = None) -> Batch:
    """Adds the days after the last batch, up to ``end``, to the table ``target`` from carried state.

    Only the new days of ``source`` and the table ``state`` (default: target + "_state") are read, whatever the history;
    without a state, or one of other outputs, everything up to ``end`` is computed once and the state begins there. An
    output that can't be computed (a column that isn't there, an error while it runs) doesn't stop the others: it is null
    in the rows written and named in the status. Outputs that look ahead need series_batch.

    Results are written before the state moves on, and the state before the old one goes, so a run that broke off
    anywhere is simply run again.
    """
    state, status = state or f"{target}_state", {}
    for n, e in outputs.items():
        if missing := lacking_fields(source.columns, [SYMBOL, DAY, *sorted(_fields(e))]):
            status[n] = f"the source has no {', '.join(missing)}"
    good = {n: e for n, e in outputs.items() if n not in status}
    versions = [v for v in catalog.list(state) if catalog.exists(f"{state}/{v}/_SUCCESS")]
    newest = max(versions, key=lambda v: int(v[1:]), default=None)
    held = catalog.read(f"{state}/{newest}") if newest else None
    known = catalog.exists(target) and not lacking_fields(catalog.read(target).columns, list(outputs))
    new = source.where(F.col(DAY) <= F.lit(end))
    if held is not None:
        through = held.agg(F.max(DAY)).first()[0]
        if through is not None:
            new = new.where(F.col(DAY) > F.lit(through))
        if new.isEmpty():
            return Batch(None, status | dict.fromkeys(good, "done"))

    def computed(some: dict[str, Series]) -> tuple[DataFrame, DataFrame]:
        if held is not None and known and holds(held, some):
            return carry(new, held, some, stored=aside)
        return carry(source.where(F.col(DAY) <= F.lit(end)), None, some, stored=aside)

    def aside(df: DataFrame) -> DataFrame:
        catalog.write(df, f"{target}_batch")
        return catalog.read(f"{target}_batch")

    def failing(some: dict[str, Series]) -> dict[str, str]:
        """The outputs of some that fail, by halves."""
        try:
            computed(some)
        except Exception as e:  # any kind: user outputs may raise what they like
            if len(some) == 1:
                return dict.fromkeys(some, f"{type(e).__name__}: {str(e).strip().splitlines()[0] if str(e).strip() else ''}"[:300])
            names = list(some)
            half = len(names) // 2
            return failing({n: some[n] for n in names[:half]}) | failing({n: some[n] for n in names[half:]})
        return {}

    try:
        results, following = computed(good)
    except Exception:
        bad = failing(good)
        if not bad:
            raise
        status |= bad
        good = {n: e for n, e in good.items() if n not in bad}
        results, following = computed(good)
    results = results.select(SYMBOL, DAY, *[F.col(n) if n in good else F.lit(None).cast("double").alias(n) for n in outputs])
    results = validate_result(results, list(outputs))
    catalog.replace_days(results, target)
    number = int(newest[1:]) + 1 if newest else 0
    catalog.write(following, f"{state}/v{number}")
    for v in versions:
        catalog.delete(f"{state}/{v}")
    days = results.select(DAY).distinct()  # the batch's own rows, not what else is stored
    return Batch(catalog.read(target).drop("_day").join(days, DAY, "left_semi"), status | dict.fromkeys(good, "done"))


def _fields(e: Series) -> set[str]:
    own = {e.args[0]} if e.op == "col" else set()
    return own.union(*[_fields(c) for c in e.children])


def stale(catalog: Catalog, names: list[str], summary: str, end: dt.date, rules: A.AnalysisRules, days: int = 25) -> list[str]:
    """The names without a summary of every horizon that is at most ``days`` old at ``end``."""
    if not catalog.exists(summary):
        return list(names)
    rows = catalog.read(summary).where(F.col("factor").isin(list(names)) & F.col("horizon").isin(list(rules.horizons)))
    newest = rows.groupBy("factor", "horizon").agg(F.max("updated_at").alias("at"))
    # fresh: every horizon is there, and none is older
    fresh = newest.where(F.date_diff(F.lit(end), F.col("at")) <= days).groupBy("factor").count().where(F.col("count") == len(set(rules.horizons)))
    known = {r.factor for r in fresh.collect()}  # at most one row a name
    return [n for n in names if n not in known]


def factor_analysis(catalog: Catalog, factors: DataFrame, names: list[str], source: DataFrame, active: DataFrame, industry: DataFrame, now: dt.date, rules: A.AnalysisRules = A.AnalysisRules(), folder: str = "factor_analysis", prepared: bool = False) -> DataFrame:  # noqa: B008
    """From factors(ts_code, trade_date, factor, value) to the tables ic, group_returns, summary, monitor, raw_monitor.

    All names in one job. Returns (factor, status): ``empty`` where the sample has no value of the factor. The prepared
    sample is written first and read by every later step, so nothing is computed twice.
    """
    keep = f"{folder}/prepared"
    raw = A.sample(factors, names, source, active, industry)
    catalog.replace_parts(A.prepare(raw, rules), keep, ["factor"])
    ready = catalog.read(keep).where(F.col("factor").isin(list(names)))
    catalog.replace_parts(A.ranked(ready, rules), f"{folder}/ranks", ["factor"])
    ranks = catalog.read(f"{folder}/ranks").where(F.col("factor").isin(list(names)))
    stamp = F.lit(now).alias("updated_at")
    parts = {"ic": A.information_coefficients(ranks), "group_returns": A.group_returns(ranks, rules)}
    for name, frame in parts.items():
        catalog.replace_parts(frame.select("*", stamp), f"{folder}/{name}", ["factor", "horizon"])
    own = lambda t: catalog.read(f"{folder}/{t}").where(F.col("factor").isin(list(names))).drop("updated_at")
    catalog.replace_parts(A.summary(own("ic"), own("group_returns")).select("*", stamp), f"{folder}/summary", ["factor", "horizon"])
    for name, frame in (("monitor", A.monitor(ready)), ("raw_monitor", A.monitor(raw))):
        catalog.replace_parts(frame.select("*", stamp), f"{folder}/{name}", ["factor"])
    catalog.delete(f"{folder}/ranks")
    status = _status(catalog, names, f"{folder}/summary")
    if not prepared:
        catalog.delete(keep)
    return status


def event_study(catalog: Catalog, signals: DataFrame, names: list[str], source: DataFrame, active: DataFrame, now: dt.date, rules: A.AnalysisRules = A.AnalysisRules(), folder: str = "event_study") -> DataFrame:  # noqa: B008
    """From signals(ts_code, trade_date, factor, value in -1, 0, 1) to the tables summary and monitor; returns (factor, status)."""
    catalog.replace_parts(A.forward_returns(A.sample(signals, names, source, active), rules.horizons), f"{folder}/prepared", ["factor"])
    ready = catalog.read(f"{folder}/prepared").where(F.col("factor").isin(list(names)))
    stamp = F.lit(now).alias("updated_at")
    catalog.replace_parts(A.event_summary(ready, rules.horizons).select("*", stamp), f"{folder}/summary", ["factor", "horizon"])
    catalog.replace_parts(A.event_monitor(ready).select("*", stamp), f"{folder}/monitor", ["factor"])
    status = _status(catalog, names, f"{folder}/summary")
    catalog.delete(f"{folder}/prepared")
    return status


def _status(catalog: Catalog, names: list[str], summary: str) -> DataFrame:
    got = {r.factor for r in catalog.read(summary).select("factor").distinct().collect()}  # at most one row a name
    return catalog.spark.createDataFrame([(n, "done" if n in got else "empty") for n in names], "factor string, status string")
