"""Embedding near-duplicates by E8 lattice hashing.

Per table a random projection takes the unit vector to 8 dimensions, where it is decoded to the nearest point of the
E8 lattice: its cell. A vector is filed in its own cell and looks into the ``probes`` neighbouring cells (of the 240
at the least distance) that are nearest to it. Vectors that meet in a cell are compared in double precision; links
are those with cosine >= ``threshold``. With the default scale, tables and probes a pair at cosine 0.95 meets with a
probability above 0.999, a closer pair with a higher one.

Equal vectors are one node with a count and are never paired with each other. A pair may meet several times; it is
counted where the two vectors' cells say it meets first, so no pairs are shuffled: a task returns, per cell and
vector, a number of links and the root of a spanning forest. Cells of more than ``most`` rows are cut into chunks,
and each pair of chunks is compared by itself.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing
(n_links 0, component_id their own id, kept). Vectors of different lengths never link. A null vec_id takes part, but
isn't a component_id unless there is none. Rows with one id and different vectors are different vectors. Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairopanel.llm import vectors as V
from kairopanel.llm.common import stored
from kairopanel.llm.components import connected_components
from kairopanel.llm.simhash import folded, forest


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two components of +-1, or all of +-1/2 with an even number of minus signs."""
    eye = np.eye(8)
    whole = [s * eye[i] + t * eye[j] for i in range(8) for j in range(i) for s in (1, -1) for t in (1, -1)]
    signs = 1 - 2.0 * ((np.arange(256)[:, None] >> np.arange(8)) & 1)
    return np.array([*whole, *(signs[signs.prod(1) > 0] / 2)])


ROOTS = _roots()


def decode(y: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer of D8 (integers with an even sum) and D8 shifted by a half."""

    def d8(y: np.ndarray) -> np.ndarray:
        f = np.rint(y)
        off = y - f
        odd = np.nonzero(f.sum(1).astype(np.int64) & 1)[0]
        k = np.abs(off[odd]).argmax(1)
        f[odd, k] += np.where(off[odd, k] >= 0, 1.0, -1.0)
        return f

    a, b = d8(y), d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def cells(x: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (rows, tables) and probed cells (rows, tables, probes) of unit vectors, as hashes."""
    own, near = np.empty((len(x), tables), np.int64), np.empty((len(x), tables, probes), np.int64)
    for t in range(tables):
        g = np.random.default_rng((seed, t, x.shape[1]))
        y = x @ (g.normal(size=(x.shape[1], 8)) * scale) + g.random(8)
        point = decode(y)
        best = np.argpartition((point - y) @ ROOTS.T, probes, axis=1)[:, :probes]
        salt = [np.array(t), np.array(x.shape[1])]
        name = lambda p, salt=salt: V.mix(*salt, *np.moveaxis(np.rint(2 * p).astype(np.int64), -1, 0))
        own[:, t], near[:, t] = name(point), name(point[:, None] + ROOTS[best])
    return own, near


def _filed(nodes: DataFrame, tables: int, probes: int, scale: float, seed: int) -> DataFrame:
    """A row per node and cell it is filed in or looks into: cell, place (table and role), node, n, v, own, near."""
    per = tables * (1 + probes)
    place = np.concatenate([np.arange(tables) * 2, np.repeat(np.arange(tables) * 2 + 1, probes)]).astype(np.int32)

    def each(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                for at, x in V.by_length(part.column("v")):
                    own, near = cells(V.unit(x), tables, probes, scale, seed)
                    near = near.reshape(len(at), -1)
                    rows = part.take(pa.array(np.repeat(at, per)))
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, (len(at) * per + 1) * k.shape[1], k.shape[1], dtype=np.int32)), pa.array(np.repeat(k, per, axis=0).reshape(-1))) for k in (own, near)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own, near], axis=1).reshape(-1)), pa.array(np.tile(place, len(at))), rows.column("node"), rows.column("n"), rows.column("v"), *lists], names=["cell", "place", "node", "n", "v", "own", "near"])

    v = nodes.schema["v"].dataType.simpleString()
    return nodes.select("node", "n", "v").mapInArrow(each, f"cell bigint, place int, node bigint, n bigint, v {v}, own array<bigint>, near array<bigint>")


def _pairs(x, node, place, side, own, near, paired: bool, threshold: float, rows: int = 128, slab: int = 4096):
    """Linked pairs (i, j) of one group that meet here first, in parts: some ``slab`` pairs of vectors are held at once."""
    u = V.unit(x)
    filed = np.nonzero(place % 2 == 0)[0]
    look = near.reshape(len(node), own.shape[1], -1)
    for at in range(0, len(filed), rows):
        i, j = np.nonzero(u[filed[at : at + rows]] @ u.T >= threshold - 1e-9)
        i = filed[at + i]
        # filed with filed once; filed with looking; across the two chunks only
        keep = (node[i] != node[j]) & ((place[j] % 2 == 1) | (node[i] < node[j]))
        if paired:
            keep &= side[i] != side[j]
        i, j = i[keep], j[keep]
        for lo in range(0, len(i), slab):
            p, q = i[lo : lo + slab], j[lo : lo + slab]
            close = V.cosines(x[p], x[q]) >= threshold
            p, q = p[close], q[close]
            low = node[p] < node[q]
            a, b = np.where(low, p, q), np.where(low, q, p)
            ways = np.stack([own[a] == own[b], (own[a][:, :, None] == look[b]).any(2), (own[b][:, :, None] == look[a]).any(2)], axis=2).reshape(len(a), -1)
            here = (place[p] // 2) * 3 + np.where(place[q] % 2 == 0, 0, np.where(low, 1, 2))
            first = ways.argmax(1) == here
            yield p[first], q[first]


def _linked(x, node, n, place, side, own, near, paired: bool, threshold: float):
    """Links of one group: (node, root, links) rows. side: the chunk's place if the group is a pair of chunks."""
    links = np.zeros(len(node))

    def counted():
        for i, j in _pairs(x, node, place, side, own, near, paired, threshold):
            links[:] += np.bincount(i, n[j], len(node)) + np.bincount(j, n[i], len(node))
            yield i, j

    root = forest(len(node), *folded(len(node), counted(), 1 << 18))
    at = np.nonzero(links)[0]
    return (node[at], node[root[at]], links[at].astype(np.int64)) if len(at) else None


def pair_links(nodes: DataFrame, threshold: float = 0.95, tables: int = 4, probes: int = 4, scale: float = 0.6, seed: int = 11, most: int = 2048) -> DataFrame:
    """(node, root, links): partial link counts and forest edges of nodes(node, n, v)."""
    rows = _filed(nodes, tables, probes, scale, seed)
    # the counts need no vectors, but the same cells: both come from one pass over few columns
    sizes = rows.select("cell").groupBy("cell").count().where(F.col("count") > most)
    hot = stored(sizes.select(F.col("cell").alias("_cell"), F.ceil(F.col("count") / (most // 2)).cast("int").alias("chunks")), "hot_cells")
    cut = rows.join(hot, F.col("cell") == F.col("_cell"), "left").withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("node"), F.col("chunks")), F.lit(0)).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    dealt = dealt.select("cell", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"), (F.col("chunk") > F.col("other")).cast("int").alias("side"), "place", "node", "n", "v", "own", "near")
    keys = ["cell", "c1", "c2"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches):
        held: list[pa.RecordBatch] = []
        for b in chain(batches, [None]):
            if b is not None:
                if not b.num_rows:
                    continue
                held.append(b)
            if not held:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            k = np.stack([t.column(c).to_numpy().astype(np.int64) for c in keys])
            turns = np.concatenate([[0], np.nonzero((k[:, 1:] != k[:, :-1]).any(0))[0] + 1, [len(t)]])
            last = len(turns) - 1 if b is None else len(turns) - 2  # the last group may go on
            out = []
            if last:
                done = t.slice(0, int(turns[last]))
                node, n, place, side = (done.column(c).to_numpy() for c in ("node", "n", "place", "side"))
                own, near = (done.column(c).combine_chunks().flatten().to_numpy().reshape(len(done), -1) for c in ("own", "near"))
                for at, x in V.by_length(done.column("v")):
                    spot = np.searchsorted(at, turns[: last + 1])
                    for lo, hi in zip(spot[:-1], spot[1:], strict=True):
                        if hi - lo > 1:
                            r = at[lo:hi]
                            got = _linked(x[lo:hi], node[r], n[r], place[r], side[r], own[r], near[r], k[1][r[0]] != k[2][r[0]], threshold)
                            if got:
                                out.append(got)
            held = t.slice(int(turns[last])).to_batches() if turns[last] < len(t) else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["node", "root", "links"])

    return dealt.mapInArrow(compare, "node bigint, root bigint, links bigint")


def near_duplicates(docs: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95, **kw) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = docs.select(docs[vec_id].alias("vec_id"), docs[embedding].alias("v"))
    nodes = stored(V.distinct(rows), "nodes")
    found = stored(pair_links(nodes, threshold, **kw), "links")
    roots = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))).select(F.col("node").alias("_n"), F.col("root").alias("class"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links")).select(F.col("node").alias("_m"), "links")
    whole = nodes.join(roots, F.col("node") == F.col("_n"), "left").join(counts, F.col("node") == F.col("_m"), "left")
    whole = stored(whole.select("v", "least", "n", "links", F.coalesce("class", "node").alias("class")), "classes")
    least = whole.groupBy("class").agg(F.min("least").alias("component")).withColumnRenamed("class", "_c")
    whole = whole.join(stored(least, "least"), F.col("class") == F.col("_c"))
    whole = stored(whole.select(F.col("v").alias("_v"), V.key(F.col("v")).alias("_k"), "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")), "vectors")
    # equal copies meet here: a join of two tables, which Spark splits where one vector is very common
    out = rows.withColumn("k", F.when(V.usable(F.col("v")), V.key(F.col("v")))).join(whole.hint("merge"), (F.col("k") == F.col("_k")) & (F.col("v") == F.col("_v")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
