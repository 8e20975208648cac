"""Series expressions over a panel: rolling, lagged and recursive primitives that compose freely.

A panel has one row per (symbol, day). An expression is a small tree; ``evaluate`` turns trees into DataFrame columns.
Window functions can't contain window functions, so a tree is cut where one reads another's result and the pieces
become columns level by level; all pieces of all requested trees share one shuffle and sort by symbol and day, equal
pieces are computed once, and expressions stay in Spark's built-in operators. Aggregates over many rows are put
together from aggregates over 2, 4, 8, ... rows, each made of two of the size before by ``lag``: a row costs the
logarithm of the window, all windows of a value share the parts, and nothing is ever subtracted, so values that
have left a window (large ones, or NaN) leave nothing behind. The one thing Spark has no built-in
for is the recurrence s = a*x + (1-a)*s, which runs once per level for all recurrences together, symbol by symbol (or
chunk by chunk of long symbols), as a scan of affine steps. Kernels, order statistics of long windows and functions of
the user's, run in the same pass over a symbol's Arrow columns. Everything that no such pass feeds is computed before it,
so that it shares the first shuffle.

``to_sql`` writes the same trees as portable SQL, used to check the results on another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kairopanel.functions import order

SYMBOL, DAY = "ts_code", "trade_date"


@dataclass(frozen=True)
class Series:
    op: str
    args: tuple = ()

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Series) and self.key == other.key

    @property
    def key(self) -> str:
        got = self.__dict__.get("_key")
        if got is None:
            got = f"{self.op}({','.join(a.key if isinstance(a, Series) else repr(a) for a in self.args)})"
            object.__setattr__(self, "_key", got)
        return got

    @property
    def children(self) -> list[Series]:
        return [a for a in self.args if isinstance(a, Series)]

    @property
    def level(self) -> int:
        got = self.__dict__.get("_level")
        if got is None:
            got = max((c.level for c in self.children), default=0) + (self.op in _WINDOWS or self.op in ("recur", "merge", "kernel"))
            object.__setattr__(self, "_level", got)
        return got

    @property
    def stage(self) -> int:
        """Passes over whole symbols (recurrences, kernels) on the way to this value."""
        got = self.__dict__.get("_stage")
        if got is None:
            got = max((c.stage for c in self.children), default=0) + (self.op in ("recur", "kernel"))
            object.__setattr__(self, "_stage", got)
        return got

    def __add__(self, o): return _op("+", self, o)
    def __radd__(self, o): return _op("+", o, self)
    def __sub__(self, o): return _op("-", self, o)
    def __rsub__(self, o): return _op("-", o, self)
    def __mul__(self, o): return _op("*", self, o)
    def __rmul__(self, o): return _op("*", o, self)
    def __truediv__(self, o): return _op("/", self, o)
    def __rtruediv__(self, o): return _op("/", o, self)
    def __lt__(self, o): return _op("<", self, o)
    def __le__(self, o): return _op("<=", self, o)
    def __gt__(self, o): return _op(">", self, o)
    def __ge__(self, o): return _op(">=", self, o)
    def __and__(self, o): return _op("AND", self, o)
    def __or__(self, o): return _op("OR", self, o)
    def same(self, o): return _op("=", self, o)
    def is_null(self): return Series("null?", (self,))


#: Window primitives; all but the first two take a number of rows and give null unless that many are not null.
_WINDOWS = {"lag", "lead", "avg", "sum", "std", "var0", "max", "min", "newest_max", "newest_min", "greater", "meandev", "wavg", "cumsum", "row", "skip_avg", "skip_max", "skip_min", "cummax", "rank_desc", "cummin", "skew", "kurt"}


def wrap(x) -> Series:
    return x if isinstance(x, Series) else Series("lit", (float(x) if x is not None else None,))


def _op(o: str, a, b) -> Series:
    return Series(o, (wrap(a), wrap(b)))


def col(name: str) -> Series:
    return Series("col", (name,))


def fn(name: str):
    return lambda *a: Series(name, tuple(wrap(x) for x in a))


def window(name: str):
    return lambda x, n=None: Series(name, (x, n))


greatest, least, absolute, coalesce, ln, sqrt = (fn(n) for n in ("greatest", "least", "abs", "coalesce", "ln", "sqrt"))
lag, lead, avg, total, std, var0, highest, lowest = (window(n) for n in ("lag", "lead", "avg", "sum", "std", "var0", "max", "min"))
skewness, kurtosis = window("skew"), window("kurt")
greater_count, mean_deviation, cumulative, running_max, skip_avg, skip_max, skip_min, rank_desc = (window(n) for n in ("greater", "meandev", "cumsum", "cummax", "skip_avg", "skip_max", "skip_min", "rank_desc"))


def rows_since_high(x: Series, n: int) -> Series:
    """Rows since the newest of the highest values of a full window."""
    return Series("newest_max", (x, n, row_number()))


def rows_since_low(x: Series, n: int) -> Series:
    return Series("newest_min", (x, n, row_number()))


def weighted(x: Series, weights: list[float]) -> Series:
    """Sum of weights times the newest values, weights from oldest to newest."""
    return Series("wavg", (x, tuple(float(w) for w in weights)))


def row_number() -> Series:
    return Series("row", (col(DAY), None))


def when(condition: Series, then, otherwise=None) -> Series:
    return Series("case", (condition, wrap(then), wrap(otherwise)))


def recur(x: Series, alpha, init: float | None = None, carry: bool = False, fade: bool = False) -> Series:
    """s = alpha*x + (1-alpha)*s by day; seeded with init or the first x. Null where x or alpha is, and s is kept
    (carry: where only x is null, s is given; fade: s loses weight on every row, (1-alpha)^2 after one null row)."""
    return Series("recur", (x, wrap(alpha), init, carry, fade))


def ema(x: Series, span: int) -> Series:
    """Exponential mean with weights by position: over a null row the state's weight fades on, so 10, null, 20 is 16.67 at span 3."""
    return recur(x, 2.0 / (span + 1), fade=True)


def first_row(x: Series) -> Series:
    """The number of the first row, up to this one, on which x isn't null; null before it."""
    return Series("cummin", (when(x.is_null(), None, row_number()), None))


@dataclass(frozen=True, repr=False)
class Kernel:
    """A function of a symbol's columns. fn takes one Arrow array of doubles per input, in day order, and gives an Arrow or
    numpy array of as many doubles (NaN stays NaN; nulls of an Arrow array are nulls). It is sent to the tasks.

    rows: how many rows up to its own a value depends on; None: all of them, which can't be carried between batches.
    name tells kernels apart: one name, one function.
    """

    name: str
    fn: Callable
    rows: int | None = None

    def __repr__(self) -> str:
        return f"{self.name}:{self.rows}"


def kernel(k: Kernel, *inputs) -> Series:
    """The kernel's values over these inputs (series or numbers); composes with everything else."""
    return Series("kernel", (k, *(wrap(x) for x in inputs)))


# --- Spark ---------------------------------------------------------------------------------------------------------


def _spark(e: Series, done: dict[str, str]) -> Column:
    if e.key in done:
        return F.col(done[e.key])
    w = W.partitionBy(SYMBOL).orderBy(DAY)
    if e.op == "col":
        return F.col(e.args[0])
    if e.op == "lit":
        return F.lit(e.args[0]).cast("double")
    if e.op == "unit":
        x = _spark(e.args[0], done)
        return F.when(x.isNotNull(), F.struct(x.alias("mean"), *[F.lit(0.0).alias(f"m{k}") for k in range(2, e.args[1] + 1)]))
    if e.op == "merge":
        return _merged(_spark(e.args[0], done), _spark(e.args[1], done), *e.args[2:])
    if e.op == "moment":
        return _moment(_spark(e.args[0], done), *e.args[1:])
    if e.op in _WINDOWS:
        x, n = _spark(e.args[0], done), e.args[1]
        if e.op in ("lag", "lead"):
            return getattr(F, e.op)(x, n).over(w)
        if e.op == "row":
            return F.row_number().over(w).cast("double")
        if e.op == "cumsum":
            return F.when(x.isNotNull(), F.sum(x).over(w.rowsBetween(W.unboundedPreceding, 0)))
        if e.op == "cummin":
            return F.min(x).over(w.rowsBetween(W.unboundedPreceding, 0))
        if e.op == "cummax":
            return F.max(x).over(w.rowsBetween(W.unboundedPreceding, 0))
        if e.op == "rank_desc":
            day = W.partitionBy(DAY)
            r = F.rank().over(day.orderBy(x.desc_nulls_last())) + (F.count(F.lit(1)).over(W.partitionBy(DAY, x)) - 1) / 2
            return F.when(x.isNotNull(), 1 - r / F.count(x).over(day))
        if e.op.startswith("skip_"):  # only rows where x isn't null count as rows
            own = W.partitionBy(SYMBOL, x.isNull()).orderBy(DAY).rowsBetween(-(n - 1), 0)
            return F.when(x.isNotNull() & (F.count(x).over(own) == n), getattr(F, e.op[5:])(x).over(own))
        rows = len(n) if e.op == "wavg" else n
        wn = w.rowsBetween(-(rows - 1), 0)
        # full: the window's first row exists and no null has come since; running values, unlike a count over the window
        first, null = F.lag(DAY, rows - 1).over(w), F.max(F.when(x.isNull(), F.col(DAY))).over(w.rowsBetween(W.unboundedPreceding, 0))
        full = first.isNotNull() & (null.isNull() | (null < first))
        if e.op in ("newest_max", "newest_min"):
            rn = _spark(e.args[2], done)
            pick = F.max_by(rn, F.struct(x, rn)) if e.op == "newest_max" else F.min_by(rn, F.struct(x, -rn))
            return F.when(full, rn - pick.over(wn))
        if e.op == "greater":
            return F.when(full, F.size(F.filter(F.collect_list(x).over(wn), lambda v: v > x)).cast("double"))
        if e.op == "meandev":
            m = F.avg(x).over(wn)
            return F.when(full, F.aggregate(F.collect_list(x).over(wn), F.lit(0.0), lambda a, v: a + F.abs(v - m)) / n)
        if e.op == "wavg":
            weights = F.array(*[F.lit(v) for v in n])
            return F.when(full, F.aggregate(F.zip_with(F.collect_list(x).over(wn), weights, lambda v, k: v * k), F.lit(0.0), lambda a, v: a + v))
        if e.op == "kurt":
            return F.when(full, F.kurtosis(x).over(wn) + 3)
        name = {"std": "stddev_samp", "var0": "var_pop", "skew": "skewness"}.get(e.op, e.op)
        return F.when(full, getattr(F, name)(x).over(wn))
    a = [_spark(c, done) for c in e.children]
    if e.op == "/":
        return F.try_divide(*a)
    if e.op == "case":
        return F.when(a[0], a[1]).otherwise(a[2])
    if e.op == "null?":
        return a[0].isNull()
    if e.op in ("greatest", "least", "coalesce"):
        return getattr(F, e.op)(*a)
    if e.op in ("abs", "ln", "sqrt"):
        return getattr(F, e.op)(*a)
    return {"+": a[0].__add__, "-": a[0].__sub__, "*": a[0].__mul__, "<": a[0].__lt__, "<=": a[0].__le__, ">": a[0].__gt__, ">=": a[0].__ge__, "=": a[0].__eq__, "AND": a[0].__and__, "OR": a[0].__or__}[e.op](a[1])


def _merged(a: Column, b: Column, na: int, nb: int, top: int) -> Column:
    """Mean and moments about it, up to ``top``, of na rows and of the nb rows after them; null unless both are there."""
    n, d = na + nb, b["mean"] - a["mean"]
    m = {2: a["m2"] + b["m2"] + d * d * (na * nb / n)}
    if top >= 3:
        m[3] = a["m3"] + b["m3"] + d * d * d * (na * nb * (na - nb) / n**2) + d * (b["m2"] * na - a["m2"] * nb) * (3 / n)
    if top >= 4:
        m[4] = a["m4"] + b["m4"] + d * d * d * d * (na * nb * (na**2 - na * nb + nb**2) / n**3) + d * d * (b["m2"] * na**2 + a["m2"] * nb**2) * (6 / n**2) + d * (b["m3"] * na - a["m3"] * nb) * (4 / n)
    return F.when(a.isNotNull() & b.isNotNull(), F.struct((a["mean"] + d * (nb / n)).alias("mean"), *[v.alias(f"m{k}") for k, v in m.items()]))


def _moment(x: Column, op: str, n: int) -> Column:
    if op in ("std", "var0"):
        return F.sqrt(x["m2"] / (n - 1)) if op == "std" else x["m2"] / n
    return F.when(x["m2"] > 0, x["m3"] * n**0.5 / F.pow(x["m2"], 1.5) if op == "skew" else x["m4"] * n / (x["m2"] * x["m2"]))


_MOMENTS = {"std": 2, "var0": 2, "skew": 3, "kurt": 4}


def _doubled(x: Series, n: int, join) -> Series:
    """An aggregate over n rows from aggregates over 1, 2, 4, ... rows, the newest the largest."""
    parts = {1: x}
    while 2 * max(parts) <= n:
        k = max(parts)
        parts[2 * k] = join(lag(parts[k], k), parts[k], k, k)
    size = max(parts)
    out = parts[size]
    for k in sorted((k for k in parts if n & k and k < size), reverse=True):
        out = join(lag(parts[k], size), out, k, size)
        size += k
    return out


def _lowered(e: Series, most: int = 8, done: dict[str, Series] | None = None) -> Series:
    """The same with sums, means and moments over more than ``most`` rows put together from parts, and order statistics over
    more than 4 * ``most`` rows as kernels."""
    done = {} if done is None else done
    if e.key not in done:
        args = tuple(_lowered(a, most, done) if isinstance(a, Series) else a for a in e.args)
        out = Series(e.op, args)
        if e.op in ("avg", "sum") and args[1] > most:
            out = _doubled(args[0], args[1], lambda a, b, na, nb: a + b)
            out = out / args[1] if e.op == "avg" else out
        elif e.op in _MOMENTS and args[1] > most:
            top = _MOMENTS[e.op]
            got = _doubled(Series("unit", (args[0], top)), args[1], lambda a, b, na, nb: Series("merge", (a, b, na, nb, top)))
            out = Series("moment", (got, e.op, args[1]))
        elif e.op in ("greater", "meandev") and args[1] > 4 * most:
            fn = order.count_greater if e.op == "greater" else order.mean_deviation
            out = kernel(Kernel(e.op, partial(fn, n=args[1]), args[1]), args[0])
        done[e.key] = out
    return done[e.key]


def checked(trees: list[Series]) -> None:
    """An error if one name stands for two kernels: equal trees are computed once."""
    named: dict[str, Callable] = {}

    def visit(e: Series) -> None:
        if e.op == "kernel" and named.setdefault(e.args[0].name, e.args[0].fn) is not e.args[0].fn:
            raise ValueError(f"two kernels are named {e.args[0].name}")
        for c in e.children:
            visit(c)

    for t in trees:
        if t.stage:
            visit(t)


def turn(e: Series) -> tuple[int, int]:
    """When a piece is computed: what no recurrence or kernel feeds comes first, so that it shares the first shuffle; then all
    recurrences and kernels that read only that, in one pass; and so on."""
    return e.stage, 0 if e.op in ("recur", "kernel") else e.level


def _cuts(trees: list[Series], by_turn: bool = True, early: bool = True) -> dict:
    """Pieces that become columns: what windows and recurrences read, recurrences, and windows used twice.

    early: also windows that would otherwise wait until a later pass has lost the rows' grouping. Ordered by turn or by level.
    """
    last = max((t.stage for t in trees), default=0)
    cut: dict[str, Series] = {}
    seen: set[str] = set()

    def visit(e: Series) -> None:
        for c in e.children:
            if c.op in _WINDOWS and c.key in seen:  # wanted again: computed once
                cut.setdefault(c.key, c)
            if early and c.op in _WINDOWS and c.stage < last:
                cut.setdefault(c.key, c)
            needs = (e.op in _WINDOWS and c.level > 0) or e.op in ("recur", "kernel", "merge", "moment", "rank_desc", "cummax", "cummin") or e.op.startswith("skip_")
            if needs and c.op not in ("col", "lit"):
                cut.setdefault(c.key, c)
            if c.key not in seen:
                seen.add(c.key)
                visit(c)
        if e.op in ("recur", "kernel"):
            cut.setdefault(e.key, e)

    for t in trees:
        if early and t.op in _WINDOWS and t.stage < last:
            cut.setdefault(t.key, t)
        visit(t)
    by: dict = {}
    for e in cut.values():
        by.setdefault(turn(e) if by_turn else e.level, []).append(e)
    return dict(sorted(by.items()))


def fold(x: np.ndarray, x_null: np.ndarray, alpha: np.ndarray, alpha_null: np.ndarray, init: float | None, carry: bool, fade: bool, state: float | None = None, gap: int = 0):
    """The recurrence over one symbol's rows in day order as a scan of affine steps s -> m*s + c, without a loop over rows.

    Steps that enlarge the state (alpha above 2) are taken row by row: a scan would enlarge its rounding with them.

    state and gap: what earlier rows left (None: nothing yet). Returns after each row the state, whether its value is null
    and whether there is no state yet, and the null rows since the last value.
    """
    n, known = len(x), state if state is not None else init
    at = np.flatnonzero(~(x_null | alpha_null))
    last = np.zeros(n, np.int64)
    last[at] = 1
    last = np.cumsum(last)  # values so far
    states = np.full(n + 1, np.nan if known is None else known)
    gaps = np.arange(1, n + 1) + gap
    if len(at):
        a, v = alpha[at], x[at]
        m, c = 1 - a, a * v
        before = np.diff(at, prepend=-1) - 1
        before[0] += gap
        if fade and (far := np.flatnonzero(before > 0)).size:
            w = (1 - a[far]) ** (before[far] + 1)
            m[far], c[far] = w / (a[far] + w), a[far] * v[far] / (a[far] + w)
        c[0] = v[0] if known is None else m[0] * known + c[0]
        m[0] = 0.0
        if (np.abs(m) > 1).any():
            last_state, grown = 0.0, []
            for step, add in zip(m.tolist(), c.tolist(), strict=True):
                last_state = add + step * last_state
                grown.append(last_state)
            c, m = np.array(grown), np.zeros(len(at))
        k = 1
        while k < len(at) and m.any():  # each step now stands for the k before it too
            c[k:], m[k:] = c[k:] + m[k:] * c[:-k], m[k:] * m[:-k]
            k *= 2
        states[1 : len(at) + 1] = c
        gaps = np.where(last > 0, np.arange(n) - at[np.maximum(last, 1) - 1], gaps)
    states = states[last]
    empty = (last == 0) & (known is None)
    return states, (x_null & (not carry)) | alpha_null | empty, empty, gaps


KernelJob = tuple  # (name, function, *inputs); inputs are columns or numbers


def kernel_column(t, fn: Callable, *refs: str | float):
    """What a kernel gives for the rows of t, which are one symbol's in day order."""
    import pyarrow as pa

    columns = [pa.array(np.full(len(t), r)) if isinstance(r, float) else pa.nulls(len(t), pa.float64()) if r is None else t.column(r).combine_chunks().cast(pa.float64()) for r in refs]
    made = fn(*columns)
    made = made.combine_chunks() if isinstance(made, pa.ChunkedArray) else pa.array(made, pa.float64())
    if len(made) != len(t):
        raise ValueError(f"a kernel gave {len(made)} values for {len(t)} rows")
    return made.cast(pa.float64())


def inputs(t, x: str | float, alpha: str | float):
    """Values (0 where null) and nulls of two columns or numbers."""
    out = []
    for c in (x, alpha):
        if isinstance(c, float):
            out += [np.full(len(t), c), np.zeros(len(t), bool)]
        else:
            column = t.column(c)
            out += [column.fill_null(0.0).to_numpy().astype(float), column.is_null().to_numpy()]
    return out


RecurJob = tuple  # (name, x, alpha, init, carry, fade); x and alpha are columns or numbers


def recur_step(df: DataFrame, jobs: list[RecurJob], seeded: bool = False, with_state: bool = False, by: list[str] | None = None, kernels: list[KernelJob] | None = None) -> DataFrame:
    """Adds columns name = recurrence(x, alpha, init, carry, fade) for jobs, and of kernels, a symbol at a time in day order.

    seeded: columns name_s0 and name_g0 hold the state and the gap before each group's first row; with_state: columns
    name_s and name_g are added, what each row leaves. by: groups, default the symbols.
    """
    import pyarrow as pa

    kernels = kernels or []
    more = [StructField(f"{name}{end}", DoubleType()) for name, *_ in jobs for end in (("", "_s", "_g") if with_state else ("",))]
    more += [StructField(name, DoubleType()) for name, *_ in kernels]
    schema = StructType([*df.schema.fields, *more])

    def step(t: pa.Table) -> pa.Table:
        t = t.sort_by(DAY)
        for name, x, alpha, *rule in jobs:
            seed = [t.column(f"{name}_{c}")[0].as_py() for c in ("s0", "g0")] if seeded else [None, None]
            states, null, empty, gaps = fold(*inputs(t, x, alpha), *rule, seed[0], int(seed[1] or 0))
            made = [("", pa.array(states, mask=null))]
            if with_state:
                made += [("_s", pa.array(states, mask=empty)), ("_g", pa.array(gaps.astype(float)))]
            for end, column in made:
                t = t.append_column(pa.field(name + end, pa.float64()), column)
        rows = t
        for name, fn, *refs in kernels:
            t = t.append_column(pa.field(name, pa.float64()), kernel_column(rows, fn, *refs))
        return t

    return df.groupBy(*(by or [SYMBOL])).applyInArrow(step, schema)


def recur_in_chunks(df: DataFrame, jobs: list[RecurJob], chunk: Column) -> DataFrame:
    """The same with a symbol's rows cut into chunks (a rising function of the day), which are worked on apart.

    A chunk is a step too: each is reduced to what it does to any state (its first value, the product of its steps, what
    they leave of a zero state), a symbol's few chunks are chained, and each chunk is folded from the state before it.
    """
    import pyarrow as pa

    parts = ("lead", "v", "a", "m", "c", "trail")
    kinds = dict(df.dtypes)
    own = df.withColumn("_chunk", chunk.cast("long"))

    def reduce(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by(DAY)
        out = {SYMBOL: [key[0].as_py()], "_chunk": [key[1].as_py()]}
        for name, x, alpha, _, _, fade in jobs:
            v, v_null, a, a_null = inputs(t, x, alpha)
            at = np.flatnonzero(~(v_null | a_null))
            got = (float(len(t)), None, None, 1.0, 0.0, 0.0)
            if len(at):
                rest = slice(at[0] + 1, None)
                zero = fold(v[rest], v_null[rest], a[rest], a_null[rest], None, False, fade, 0.0)[0]
                c, m = float(zero[-1]) if len(zero) else 0.0, float(np.prod(_weights(at, a, fade)))
                got = (float(at[0]), float(v[at[0]]), float(a[at[0]]), m, c, float(len(t) - 1 - at[-1]))
            out |= {f"{name}_{p}": [g] for p, g in zip(parts, got, strict=True)}
        return pa.table(out, schema=pa.schema([(SYMBOL, t.schema.field(SYMBOL).type), ("_chunk", pa.int64()), *((f"{name}_{p}", pa.float64()) for name, *_ in jobs for p in parts)]))

    def chain(t: pa.Table) -> pa.Table:
        t = t.sort_by("_chunk")
        out = t.select([SYMBOL, "_chunk"])
        for name, _, _, init, _, fade in jobs:
            s, gap, states, gaps = init, 0.0, [], []
            for r in zip(*(t.column(f"{name}_{p}").to_pylist() for p in parts), strict=True):  # a row a chunk
                states.append(s)
                gaps.append(gap)
                lead, v, a, m, c, trail = r
                gap += lead
                if v is not None:
                    if s is None:
                        s = v
                    else:
                        w = (1 - a) ** (gap + 1) if fade else 1 - a
                        s = (a * v + w * s) / (a + w) if fade and gap else a * v + (1 - a) * s
                    s, gap = m * s + c, trail
            out = out.append_column(f"{name}_s0", pa.array(states, pa.float64())).append_column(f"{name}_g0", pa.array(gaps, pa.float64()))
        return out

    key = f"{SYMBOL} {kinds[SYMBOL]}, _chunk long"
    ends = own.groupBy(SYMBOL, "_chunk").applyInArrow(reduce, f"{key}, " + ", ".join(f"{name}_{p} double" for name, *_ in jobs for p in parts))
    seeds = ends.groupBy(SYMBOL).applyInArrow(chain, f"{key}, " + ", ".join(f"{name}_{p} double" for name, *_ in jobs for p in ("s0", "g0")))
    done = recur_step(own.join(seeds, [SYMBOL, "_chunk"]), jobs, seeded=True, by=[SYMBOL, "_chunk"])
    return done.select(*df.columns, *[name for name, *_ in jobs])


def _weights(at: np.ndarray, a: np.ndarray, fade: bool) -> np.ndarray:
    """What each value after the first leaves of the state before it."""
    gap, own = np.diff(at) - 1, a[at[1:]]
    if not fade:
        return 1 - own
    w = (1 - own) ** (gap + 1)
    return np.where(gap > 0, w / (own + w), 1 - own)


def evaluate(panel: DataFrame, outputs: dict[str, Series], keep: tuple[str, ...] = (SYMBOL, DAY), chunk_days: int | None = None) -> DataFrame:
    """keep columns and one column per output, for every row of the panel.

    chunk_days: recurrences over very long symbols are cut into chunks of so many days, which are worked on apart; kernels
    still see a whole symbol.
    """
    checked(list(outputs.values()))
    lowered: dict[str, Series] = {}
    outputs = {n: _lowered(e, done=lowered) for n, e in outputs.items()}
    used = {SYMBOL, DAY, *keep}

    def columns(e: Series) -> None:
        if e.op == "col":
            used.add(e.args[0])
        for c in e.children:
            columns(c)

    for e in outputs.values():
        columns(e)
    df, done = panel.select(*[c for c in panel.columns if c in used]), {}
    for _, pieces in _cuts(list(outputs.values())).items():
        plain = [e for e in pieces if e.op not in ("recur", "kernel")]
        folds = [e for e in pieces if e.op == "recur"]
        calls = [e for e in pieces if e.op == "kernel"]
        if folds or calls:
            ref = lambda a: a.args[0] if a.op in ("lit", "col") else done[a.key]
            names = {e.key: f"_s{len(done) + i}" for i, e in enumerate([*folds, *calls])}
            jobs = [(names[e.key], ref(e.args[0]), ref(e.args[1]), *e.args[2:]) for e in folds]
            kernels = [(names[e.key], e.args[0].fn, *(ref(a) for a in e.args[1:])) for e in calls]
            if chunk_days and jobs:
                df = recur_in_chunks(df, jobs, F.floor(F.unix_date(F.col(DAY).cast("date")) / chunk_days))
                df = recur_step(df, [], kernels=kernels) if kernels else df
            else:
                df = recur_step(df, jobs, kernels=kernels)
            done |= names
        new = {}
        for e in plain:
            new[f"_s{len(done) + len(new)}"] = (e, _spark(e, done))
        df = df.withColumns({n: c for n, (_, c) in new.items()})
        done |= {e.key: n for n, (e, _) in new.items()}
    return df.select(*keep, *[_spark(e, done).alias(n) for n, e in outputs.items()])


# --- SQL -----------------------------------------------------------------------------------------------------------


def _sql(e: Series, done: dict[str, str]) -> str:
    if e.key in done:
        return done[e.key]
    w = f"PARTITION BY {SYMBOL} ORDER BY {DAY}"
    if e.op == "col":
        return e.args[0]
    if e.op == "lit":
        return "CAST(NULL AS DOUBLE)" if e.args[0] is None else f"CAST({e.args[0]!r} AS DOUBLE)"
    if e.op == "kernel":
        raise ValueError(f"kernel {e.args[0].name} has no SQL form")
    if e.op in _WINDOWS:
        x, n = _sql(e.args[0], done), e.args[1]
        if e.op in ("lag", "lead"):
            return f"{e.op}({x}, {n}) OVER ({w})"
        if e.op == "row":
            return f"CAST(row_number() OVER ({w}) AS DOUBLE)"
        if e.op == "cumsum":
            return f"CASE WHEN ({x}) IS NOT NULL THEN sum({x}) OVER ({w} ROWS UNBOUNDED PRECEDING) END"
        if e.op == "cummin":
            return f"min({x}) OVER ({w} ROWS UNBOUNDED PRECEDING)"
        if e.op == "cummax":
            return f"max({x}) OVER ({w} ROWS UNBOUNDED PRECEDING)"
        if e.op == "rank_desc":
            return f"CASE WHEN {x} IS NOT NULL THEN 1 - (rank() OVER (PARTITION BY {DAY} ORDER BY {x} DESC NULLS LAST) + (count(*) OVER (PARTITION BY {DAY}, {x}) - 1) / CAST(2 AS DOUBLE)) / count({x}) OVER (PARTITION BY {DAY}) END"
        if e.op.startswith("skip_"):
            own = f"(PARTITION BY {SYMBOL}, {x} IS NULL ORDER BY {DAY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            return f"CASE WHEN {x} IS NOT NULL AND count({x}) OVER {own} = {n} THEN {e.op[5:]}({x}) OVER {own} END"
        rows = len(n) if e.op == "wavg" else n
        own = f"({w} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
        full = f"count({x}) OVER {own} = {rows}"
        if e.op in ("newest_max", "newest_min"):
            rn = _sql(e.args[2], done)
            pick = f"arg_max({rn}, struct_pack(a := {x}, b := {rn}))" if e.op == "newest_max" else f"arg_min({rn}, struct_pack(a := {x}, b := -{rn}))"
            return f"CASE WHEN {full} THEN {rn} - {pick} OVER {own} END"
        if e.op == "greater":
            return f"CASE WHEN {full} THEN CAST(len(list_filter(list({x}) OVER {own}, lambda v: v > {x})) AS DOUBLE) END"
        if e.op == "meandev":
            return f"CASE WHEN {full} THEN list_sum(list_transform(list({x}) OVER {own}, lambda v: abs(v - avg({x}) OVER {own}))) / {n} END"
        if e.op == "wavg":
            return f"CASE WHEN {full} THEN list_dot_product(list({x}) OVER {own}, [{', '.join(f'CAST({v!r} AS DOUBLE)' for v in n)}]) END"
        if e.op in ("skew", "kurt"):
            m1, m2, m3, m4 = (f"avg(power({x}, {k})) OVER {own}" for k in (1, 2, 3, 4))
            v, third = f"({m2} - power({m1}, 2))", f"({m3} - 3 * {m1} * {m2} + 2 * power({m1}, 3))"
            fourth = f"({m4} - 4 * {m1} * {m3} + 6 * power({m1}, 2) * {m2} - 3 * power({m1}, 4))"
            return f"CASE WHEN {full} AND {v} > 0 THEN {third} / power({v}, 1.5) END" if e.op == "skew" else f"CASE WHEN {full} AND {v} > 0 THEN {fourth} / power({v}, 2) END"
        name = {"std": "stddev_samp", "var0": "var_pop"}.get(e.op, e.op)
        return f"CASE WHEN {full} THEN {name}({x}) OVER {own} END"
    a = [_sql(c, done) for c in e.children]
    if e.op == "/":
        return f"(({a[0]}) / nullif({a[1]}, 0))"
    if e.op == "case":
        return f"(CASE WHEN {a[0]} THEN {a[1]} ELSE {a[2]} END)"
    if e.op == "null?":
        return f"(({a[0]}) IS NULL)"
    if e.op in ("greatest", "least", "coalesce", "abs", "ln", "sqrt"):
        return f"{e.op}({', '.join(a)})"
    return f"(({a[0]}) {e.op} ({a[1]}))"


#: Below each bound, the factor that is kept before cutting to whole numbers (some 6 digits; of values below
#: 1e-3 nine decimals). For comparison with another engine only: evaluate() returns exact values.
#: A little under a half: exact halves, common among ratios, then never hang on an engine's last bit.
_UP = 0.49973
_CUTS = ((1e-3, 1e9), (0.1, 1e6), (1e2, 1e5), (1e4, 1e3), (1e6, 1e1), (1e12, 1.0))


def rounded(x: Column) -> Column:
    """To some six digits in plain double arithmetic that other engines share, for queries that are compared with one."""
    out = F.lit(None).cast("double")
    for k, (bound, scale) in enumerate(_CUTS):
        cut = F.floor(x * scale + _UP) / scale
        out = F.when(F.abs(x) < bound, cut) if not k else out.when(F.abs(x) < bound, cut)
    return out.otherwise(x)


def rounded_sql(x: str) -> str:
    cut = lambda k: f"floor(({x}) * CAST({k} AS DOUBLE) + CAST({_UP} AS DOUBLE)) / CAST({k} AS DOUBLE)"
    return f"CASE {' '.join(f'WHEN abs({x}) < {bound} THEN {cut(scale)}' for bound, scale in _CUTS)} ELSE {x} END"


def to_sql(panel_sql: str, outputs: dict[str, Series], keep: tuple[str, ...] = (SYMBOL, DAY)) -> str:
    """The same as evaluate, as one SELECT over panel_sql."""
    steps, done, last = [f"p0 AS ({panel_sql})"], {}, "p0"
    n = 0

    def step(items: dict[str, str]) -> None:
        nonlocal last, n
        n += 1
        steps.append(f"p{n} AS (SELECT *, {', '.join(f'{x} AS {c}' for c, x in items.items())} FROM {last})")
        last = f"p{n}"

    for _, pieces in _cuts(list(outputs.values()), by_turn=False, early=False).items():
        folds = [e for e in pieces if e.op == "recur"]
        if folds:
            lists, folded = {}, {}
            for e in folds:
                c = f"_s{len(done) + len(folded)}"
                x, a = (_sql(k, done) for k in e.args[:2])
                init = "CAST(NULL AS DOUBLE)" if e.args[2] is None else f"CAST({e.args[2]!r} AS DOUBLE)"
                lists[f"{c}_l"] = f"list(struct_pack(s := {x}, a := {a}, g := CAST(0.0 AS DOUBLE))) OVER (PARTITION BY {SYMBOL} ORDER BY {DAY} ROWS UNBOUNDED PRECEDING)"
                new = "v.a * v.s + (1 - v.a) * q.s"
                if e.args[4]:  # g: rows since the last value
                    new = f"CASE WHEN q.g = 0 THEN {new} ELSE (v.a * v.s + power(1 - v.a, q.g + 1) * q.s) / (v.a + power(1 - v.a, q.g + 1)) END"
                rule = f"struct_pack(s := CASE WHEN v.s IS NULL OR v.a IS NULL THEN q.s WHEN q.s IS NULL THEN v.s ELSE {new} END, a := v.a, g := CASE WHEN v.s IS NULL OR v.a IS NULL THEN q.g + 1 ELSE 0.0::DOUBLE END)"
                got = f"list_reduce({c}_l, lambda q, v: {rule}, struct_pack(s := {init}, a := CAST(0.0 AS DOUBLE), g := CAST(0.0 AS DOUBLE))).s"
                miss = f"({a}) IS NULL" if e.args[3] else f"({x}) IS NULL OR ({a}) IS NULL"
                folded[c] = (e, f"CASE WHEN {miss} THEN NULL ELSE {got} END")
            step(lists)
            step({c: x for c, (_, x) in folded.items()})
            steps[-1] = steps[-1].replace("SELECT *,", f"SELECT * EXCLUDE ({', '.join(lists)}),")
            done |= {e.key: c for c, (e, _) in folded.items()}
        plain = [e for e in pieces if e.op != "recur"]
        if plain:
            names = {f"_s{len(done) + i}": e for i, e in enumerate(plain)}
            step({c: _sql(e, done) for c, e in names.items()})
            done |= {e.key: c for c, e in names.items()}
    return f"WITH {', '.join(steps)} SELECT {', '.join(keep)}, {', '.join(f'{_sql(e, done)} AS {c}' for c, e in outputs.items())} FROM {last}"
