"""Series over new days from carried state: what ``evaluate`` gives over all history, reading new rows and the state only.

The state holds, per symbol, the newest rows that later windows can still reach, with every intermediate column that a
window reads, and beside them what running values and recurrences leave after each row (total, extreme, row number, the
recurrence's state and the rows since its last value). A batch puts the new rows behind these: windows run over both,
running values and recurrences go on from the last carried row, and the result's newest rows are the next state. A
row's look-back is known from the trees, so the state is some window lengths a symbol, whatever the history. Kernels are carried by the rows that they say they need.

New rows must be later than the carried rows of their symbol; rows of days that are carried already are left out, so a
batch that is run again changes nothing. Outputs that look ahead (lead) have no carried form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kairopanel.functions.series import _WINDOWS, DAY, SYMBOL, Series, _cuts, _lowered, _spark, checked, fold, inputs, recur_step, turn

_RUNNING = {"row", "cumsum", "cummax", "cummin"}


def column(e: Series) -> str:
    """The state's column for a piece: the same for the same tree, whatever else is asked for."""
    return "s_" + hashlib.md5(e.key.encode()).hexdigest()[:16]


def _every(trees: list[Series]) -> dict[str, Series]:
    out: dict[str, Series] = {}

    def visit(e: Series) -> None:
        if e.key not in out:
            out[e.key] = e
            for c in e.children:
                visit(c)

    for t in trees:
        visit(t)
    return out


def reach(e: Series) -> int:
    """Rows before its own that a window reads."""
    if e.op == "kernel":
        if e.args[0].rows is None:
            raise ValueError(f"kernel {e.args[0].name} reads all rows and can't be carried")
        return e.args[0].rows - 1
    if e.op not in _WINDOWS or e.op in _RUNNING or e.op == "rank_desc" or e.op.startswith("skip_"):
        return 0
    if e.op == "lead":
        raise ValueError("an output that looks ahead can't be carried")
    n = len(e.args[1]) if e.op == "wavg" else int(e.args[1])
    return n if e.op == "lag" else n - 1


def prepared(outputs: dict[str, Series]) -> tuple[dict[str, Series], dict[tuple[int, int], list[Series]]]:
    """Trees as they are computed, and their pieces by turn; running values are always pieces."""
    checked(list(outputs.values()))
    lowered: dict[str, Series] = {}
    trees = {n: _lowered(e, done=lowered) for n, e in outputs.items()}
    every = _every(list(trees.values()))
    by = _cuts([*trees.values(), *(Series("abs", (e,)) for e in every.values() if e.op in _RUNNING)], early=False)  # few pieces: all are carried
    known = {e.key for pieces in by.values() for e in pieces}
    for e in every.values():
        if e.op in _RUNNING and e.key not in known:
            by.setdefault(turn(e), []).append(e)
    return trees, dict(sorted(by.items()))


def state_columns(outputs: dict[str, Series]) -> list[str]:
    """Columns of the state of these outputs."""
    trees, by = prepared(outputs)
    pieces = [e for some in by.values() for e in some]
    used = {e.args[0] for e in _every(list(trees.values())).values() if e.op == "col"}
    more = [f"{column(e)}_{k}" for e in pieces for k in (("s", "g") if e.op == "recur" else ("r",) if e.op in _RUNNING else ())]
    return [SYMBOL, DAY, *sorted(used - {SYMBOL, DAY}), *dict.fromkeys(column(e) for e in pieces), *dict.fromkeys(more), "s_rows", *(c for c, *_ in _skips(trees))]


def _skips(trees: dict[str, Series]) -> list[tuple[str, Series, int]]:
    """Windows over rows with a value: (a column that marks a state which holds such rows, their value, how many)."""
    found = dict.fromkeys((e.args[0], e.args[1]) for e in _every(list(trees.values())).values() if e.op.startswith("skip_"))
    return [(f"{column(x)}_last{n}", x, n) for x, n in found]


def _rows(trees: dict[str, Series]) -> int:
    return max([1, *(reach(e) for e in _every(list(trees.values())).values())])


def holds(state: DataFrame, outputs: dict[str, Series]) -> bool:
    """Whether a state has all that these outputs go on from."""
    if any(c not in state.columns for c in state_columns(outputs)):
        return False
    first = state.select("s_rows").first()
    return first is None or first[0] >= _rows(prepared(outputs)[0])


def carry(new: DataFrame, state: DataFrame | None, outputs: dict[str, Series], keep: tuple[str, ...] = (SYMBOL, DAY), stored: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(keep columns and outputs of the new rows, the next state). state: None begins with no history.

    Both results read one frame; stored may write it and read it back, so that it is computed once.
    """
    trees, by = prepared(outputs)
    names = state_columns(outputs)
    numbers = [c for c in names if c.startswith("s_") and c.endswith(("_s", "_g", "_r"))] + [column(e) for some in by.values() for e in some if e.op == "recur"]
    fresh = new.select(*dict.fromkeys([*(c for c in names if not c.startswith("s_")), *keep])).withColumn("_old", F.lit(False))
    marks = {"s_rows": F.lit(_rows(trees)), **{c: F.lit(True) for c, *_ in _skips(trees)}}
    if state is None:
        df = fresh.withColumns({c: F.lit(None).cast("double") for c in numbers})
    else:
        if not holds(state, outputs):
            raise ValueError("the state is of other outputs")
        through = state.groupBy(F.col(SYMBOL).alias("_symbol")).agg(F.max(DAY).alias("_through"))
        fresh = fresh.join(through, F.col(SYMBOL) == F.col("_symbol"), "left").where(F.col("_through").isNull() | (F.col(DAY) > F.col("_through"))).drop("_symbol", "_through")
        df = fresh.unionByName(state.select(*names).withColumn("_old", F.lit(True)), allowMissingColumns=True)
    old, done = F.col("_old"), {}
    own = lambda c, made: made if state is None else F.when(old, F.col(c)).otherwise(made)
    for pieces in by.values():
        for e in (e for e in pieces if e.op in _RUNNING):
            df = _run(df, e, _spark(e.args[0], done), own)
        done |= {e.key: column(e) for e in pieces if e.op in _RUNNING}
        if folds := [e for e in pieces if e.op == "recur"]:
            ref = lambda a: a.args[0] if a.op in ("lit", "col") else done[a.key]
            df = _fold(df, [(column(e), ref(e.args[0]), ref(e.args[1]), *e.args[2:]) for e in folds])
            done |= {e.key: column(e) for e in folds}
        if calls := [e for e in pieces if e.op == "kernel"]:
            ref = lambda a: a.args[0] if a.op in ("lit", "col") else done[a.key]
            df = recur_step(df, [], kernels=[(f"{column(e)}_k", e.args[0].fn, *(ref(a) for a in e.args[1:])) for e in calls])
            df = df.withColumns({column(e): own(column(e), F.col(f"{column(e)}_k")) for e in calls}).drop(*[f"{column(e)}_k" for e in calls])
            done |= {e.key: column(e) for e in calls}
        if plain := [e for e in pieces if e.op not in ("recur", "kernel", *_RUNNING)]:
            df = df.withColumns({column(e): own(column(e), _spark(e, done)) for e in plain})
            done |= {e.key: column(e) for e in plain}
    # the outputs' own windows still read carried rows: computed before these are left out
    shown = {n: f"_o{k}" for k, n in enumerate(trees)}
    df = stored(df.withColumns({shown[n]: _spark(e, done) for n, e in trees.items()}))
    results = df.where(~old).select(*keep, *[F.col(c).alias(n) for n, c in shown.items()])
    kept = df.withColumn("_place", F.row_number().over(W.partitionBy(SYMBOL).orderBy(F.col(DAY).desc())))
    wanted = F.col("_place") <= _rows(trees)
    for c, x, n in _skips(trees):
        value = _spark(x, done)
        kept = kept.withColumn(f"_{c}", F.row_number().over(W.partitionBy(SYMBOL, value.isNull()).orderBy(F.col(DAY).desc())))
        wanted = wanted | (value.isNotNull() & (F.col(f"_{c}") < n))
    return results, kept.where(wanted).withColumns(marks).select(*names)


def _run(df: DataFrame, e: Series, x: Column, own: Callable[[str, Column], Column]) -> DataFrame:
    """A running value: on from the one that the last carried row left."""
    w, old, run = W.partitionBy(SYMBOL).orderBy(DAY).rowsBetween(W.unboundedPreceding, 0), F.col("_old"), f"{column(e)}_r"
    if e.op in ("cummax", "cummin"):
        made = getattr(F, e.op[3:])(F.when(old, F.col(run)).otherwise(x)).over(w)
    else:
        before = F.last(F.when(old, F.col(run)), ignorenulls=True).over(w)
        more = F.sum(F.when(~old, F.lit(1.0) if e.op == "row" else x)).over(w)
        made = F.coalesce(before, F.lit(0.0)) + F.coalesce(more, F.lit(0.0))
    df = df.withColumn("_made", made)
    value = F.when(x.isNotNull(), F.col("_made")) if e.op == "cumsum" else F.col("_made")
    return df.withColumns({column(e): own(column(e), value), run: own(run, F.col("_made"))}).drop("_made")


def _fold(df: DataFrame, jobs: list[tuple]) -> DataFrame:
    """Recurrences, from the state that a symbol's last carried row left."""
    import pyarrow as pa

    def step(t: pa.Table) -> pa.Table:
        t = t.sort_by(DAY)
        k = sum(t.column("_old").to_pylist())
        rest = t.slice(k)
        for name, x, alpha, *rule in jobs:
            seed = [t.column(f"{name}_{c}")[k - 1].as_py() if k else None for c in "sg"]
            states, null, empty, gaps = fold(*inputs(rest, x, alpha), *rule, seed[0], int(seed[1] or 0))
            for c, made in ((name, pa.array(states, mask=null)), (f"{name}_s", pa.array(states, mask=empty)), (f"{name}_g", pa.array(gaps.astype(float)))):
                t = t.set_column(t.schema.get_field_index(c), t.schema.field(c), pa.chunked_array([*t.column(c).slice(0, k).chunks, made]))
        return t

    return df.groupBy(SYMBOL).applyInArrow(step, df.schema)
