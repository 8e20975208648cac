"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, where the nearest by cosine are the nearest by distance. A table has ``functions``
hashes floor((a.x + b) / width) with Gaussian (2-stable) a. For a query the probability that a neighbour at the
expected distance lies ``o`` buckets away is known for every hash and offset (a normal distribution around the
query's own projection); the buckets' products, in falling order, are visited until the tables together find such a neighbour
with probability ``success``. The expected distance is a high quantile of the distance to the k-th neighbour, measured
for a fixed number of vectors against all of them in one pass.

Every distinct vector is in the index; equal copies are one entry with the k + 1 smallest ids, which is all that a
result can show. Buckets are dealt to shards of some ``per_shard`` entries by hash, and a bucket with more than that
is split over several. A query goes once to each shard that has buckets it visits. A shard compares blocks; what can be
among a query's k + 1 best, with all that ties within rounding, is measured again on the original vectors, each pair
alone, and every cut is by that measure and then by id. So ties are never cut by chance, however many there are.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without id, take
no part. Equal scores go to the smaller id. With fewer candidates than k all that are found are returned. Vectors of
different lengths are never compared. Rows with the same id: each is a query and a candidate for others. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kairopanel.llm import vectors as V
from kairopanel.llm.common import stored

_REACH = 4  # offsets -4..4 of a hash
_erf = np.vectorize(math.erf, otypes=[float])


class Hashes:
    """The hash functions of all tables for vectors of one length."""

    def __init__(self, dim: int, tables: int, functions: int, width: float, seed: int):
        g = np.random.default_rng((seed, dim))
        self.dim, self.tables, self.width = dim, tables, width
        self.a = g.normal(size=(tables, dim, functions))
        self.a *= math.sqrt(dim) / np.sqrt((self.a**2).sum(1, keepdims=True))  # projections of unit vectors have variance near 1
        self.b = g.random((tables, functions)) * width

    def places(self, u: np.ndarray, t: int) -> np.ndarray:
        return (u @ self.a[t] + self.b[t]) / self.width

    def name(self, t: int, bucket: np.ndarray) -> np.ndarray:
        return V.mix(np.array(t), np.array(self.dim), *np.moveaxis(bucket.astype(np.int64), -1, 0))

    def own(self, u: np.ndarray) -> np.ndarray:
        return np.stack([self.name(t, np.floor(self.places(u, t))) for t in range(self.tables)], axis=1)

    def probes(self, u: np.ndarray, t: int, distance: float, success: float):
        """(query, bucket) pairs: per query the buckets in falling order of estimated success, up to the given sum."""
        y = self.places(u, t)
        home = np.floor(y)
        rho = 1 - distance**2 / 2
        mid = (y * self.width - self.b[t]) * rho
        sd = max(1e-3, math.sqrt(max(0.0, 1 - rho * rho)))
        edges = (home[:, :, None] + np.arange(-_REACH, _REACH + 2)) * self.width - self.b[t][:, None]
        cdf = 0.5 * (1 + _erf((edges - mid[:, :, None]) / (sd * math.sqrt(2))))
        p = np.diff(cdf, axis=2)
        offsets = np.array(list(product(range(2 * _REACH + 1), repeat=p.shape[1])))
        for q in range(len(u)):
            mass = np.ones(1)
            for f in range(p.shape[1]):
                mass = (mass[:, None] * p[q, f]).reshape(-1)
            order = np.argsort(-mass, kind="stable")
            upto = int(np.searchsorted(np.cumsum(mass[order]), success * mass.sum())) + 1
            yield q, self.name(t, home[q] + offsets[order[:upto]] - _REACH)


def expected_distance(nodes: DataFrame, k: int, probes: int = 64, quantile: float = 0.9) -> float:
    """Distance within which most of ``probes`` vectors, those whose hashes come first, have k neighbours among all vectors."""
    rows = nodes.select("node", "v", F.xxhash64("v").alias("h")).orderBy("h", "node").limit(probes).collect()
    asks = {x.shape[1]: (at, np.array([r.node for r in rows])[at], V.unit(x)) for at, x in V.by_length(pa.array([r.v for r in rows], pa.list_(pa.float64())))} if rows else {}

    def each(batches):
        for b in batches:
            node = b.column(0).to_numpy()
            for at, x in V.by_length(b.column(1)):
                if x.shape[1] in asks:
                    q, own, u = asks[x.shape[1]]
                    s = u @ V.unit(x).T
                    s[own[:, None] == node[at]] = -2.0
                    best = -np.partition(-s, k - 1, axis=1)[:, :k] if s.shape[1] > k else s
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, best.shape[1])), pa.array(best.reshape(-1))], names=["q", "s"])

    near = nodes.select("node", "v").mapInArrow(each, "q bigint, s double").where("s > -2")
    near = near.withColumn("rn", F.row_number().over(W.partitionBy("q").orderBy(F.desc("s")))).where(F.col("rn") == k)
    far = [r.s for r in near.select("s").collect()]  # one row a probe
    return math.sqrt(max(0.0, 2 - 2 * float(np.quantile(far, 1 - quantile)))) if far else math.sqrt(2)


def _best(owner: np.ndarray, score: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best per owner: by score, then by id."""
    order = np.lexsort((least, -score, owner))
    owner = owner[order]
    start = np.concatenate([[0], np.nonzero(np.diff(owner))[0] + 1]) if len(owner) else np.zeros(0, int)
    rank = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    return order[rank < k]


def _nearest(uq: np.ndarray, xq: np.ndarray, ux: np.ndarray, xs: np.ndarray, least: np.ndarray, k: int, slab: int = 1 << 15):
    """(query, candidate, score) of the k best candidates of each query; unit vectors to choose by, originals to measure."""
    s = uq @ ux.T
    bar = np.partition(s, -k, axis=1)[:, [-k]] if s.shape[1] > k else -2.0
    q, c = np.nonzero(s >= bar - 1e-9)
    exact = np.concatenate([V.cosines(xq[q[lo : lo + slab]], xs[c[lo : lo + slab]]) for lo in range(0, len(q), slab)]) if len(q) else np.zeros(0)
    at = _best(q, exact, least[c], k)
    return q[at], c[at], exact[at]


def search(docs: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", tables: int = 2, functions: int = 4, width: float = 1.0, success: float = 0.96, per_shard: int = 8192, seed: int = 5) -> DataFrame:
    """The k nearest found of every row with is_query (a condition on docs): query_id, rank, vec_id, score."""
    spark = docs.sparkSession
    rows = docs.select(docs[vec_id].alias("vec_id"), docs[embedding].alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & V.usable(F.col("v")))
    nodes = stored(V.distinct(rows), "nodes")
    named = rows.join(nodes.select("node", F.col("v").alias("_v")).hint("merge"), F.col("v") == F.col("_v")).select("vec_id", "node", "asks")
    named = stored(named, "named")
    first = named.withColumn("rn", F.row_number().over(W.partitionBy("node").orderBy("vec_id"))).where(F.col("rn") <= k + 1)
    members = stored(first.groupBy("node").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "members")
    asked = stored(named.where("asks").select("node").distinct().join(nodes.select("node", "least", "v"), "node"), "asked")

    distance = expected_distance(nodes, k)
    v_type, id_type, kept = nodes.schema["v"].dataType.simpleString(), nodes.schema["least"].dataType.simpleString(), k + 1
    hashes = lambda d: Hashes(d, tables, functions, width, seed)

    def filed(batches):
        for b in batches:
            for at, x in V.by_length(b.column("v")):
                own = hashes(x.shape[1]).own(V.unit(x))
                part = b.take(pa.array(np.repeat(at, tables)))
                yield pa.RecordBatch.from_arrays([pa.array(own.reshape(-1)), part.column("node"), part.column("least"), part.column("v")], names=["bucket", "node", "least", "v"])

    entries = nodes.select("node", "least", "v").mapInArrow(filed, f"bucket bigint, node bigint, least {id_type}, v {v_type}")
    sizes = stored(entries.groupBy("bucket").count(), "buckets")
    total = sizes.agg(F.sum("count")).first()[0] or 0
    shards = max(16, -(-total // per_shard))
    share = max(1, per_shard // 4)
    # at most total / share <= 4 * shards buckets, 16 bytes each
    split = {r.bucket: -(-r["count"] // share) for r in sizes.where(F.col("count") > share).collect()}

    def parts(bucket: np.ndarray) -> np.ndarray:
        return np.array([split.get(x, 1) for x in bucket.tolist()], np.int64)

    def shard_of(bucket: np.ndarray, sub: np.ndarray) -> np.ndarray:
        return (V.mix(bucket, sub).view(np.uint64) % np.uint64(shards)).astype(np.int32)

    def dealt(batches):
        for b in batches:
            bucket, node = b.column(0).to_numpy(), b.column(1).to_numpy()
            sub = V.mix(node).view(np.uint64) % parts(bucket).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(bucket, sub)), *b.columns], names=["shard", *b.schema.names])

    def asking(batches):
        for b in batches:
            for at, x in V.by_length(b.column("v")):
                h, u = hashes(x.shape[1]), V.unit(x)
                q_of, buckets, shard = [], [], []
                for t in range(tables):
                    for q, bucket in h.probes(u, t, distance, 1 - (1 - success) ** (1 / tables)):
                        n = parts(bucket)
                        each = np.repeat(bucket, n)
                        sub = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                        q_of.append(np.full(len(each), q))
                        buckets.append(each)
                        shard.append(shard_of(each, sub))
                q, bucket, s = (np.concatenate(c) for c in (q_of, buckets, shard))
                order = np.lexsort((bucket, q, s))
                q, bucket, s = q[order], bucket[order], s[order]
                fresh = np.concatenate([[True], (np.diff(q) != 0) | (np.diff(s) != 0) | (np.diff(bucket) != 0)])
                q, bucket, s = q[fresh], bucket[fresh], s[fresh]
                turn = np.concatenate([[0], np.nonzero((np.diff(q) != 0) | (np.diff(s) != 0))[0] + 1])
                part = b.take(pa.array(at[q[turn]]))
                lists = pa.ListArray.from_arrays(pa.array(np.append(turn, len(q)).astype(np.int32)), pa.array(bucket))
                yield pa.RecordBatch.from_arrays([pa.array(s[turn]), part.column("node"), part.column("v"), lists], names=["shard", "node", "v", "buckets"])

    index = entries.mapInArrow(dealt, f"shard int, bucket bigint, node bigint, least {id_type}, v {v_type}")
    wanted = asked.mapInArrow(asking, f"shard int, node bigint, v {v_type}, buckets array<bigint>")

    from pyspark.sql.pandas.types import to_arrow_type

    empty = [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], to_arrow_type(nodes.schema["least"].dataType)), pa.array([], pa.float64())]
    none = pa.table(empty, names=["q", "c", "least", "score"])

    def compare(have: pa.Table, ask: pa.Table) -> pa.Table:
        out = []
        if len(have) and len(ask):
            lists = ask.column("buckets").combine_chunks()
            spots = np.asarray(lists.offsets)
            bucket_q, owner = lists.values.to_numpy(), np.repeat(np.arange(len(ask)), np.diff(spots))
            order = np.argsort(bucket_q, kind="stable")
            bucket_q, owner = bucket_q[order], owner[order]
            node_q, node_x, bucket_x = (t.column(c).to_numpy() for t, c in ((ask, "node"), (have, "node"), (have, "bucket")))
            ids = pa.compute.rank(have.column("least"), sort_keys="ascending", tiebreaker="min").to_numpy() if len(have) else np.zeros(0)
            by_q = {x.shape[1]: (at, x, V.unit(x)) for at, x in V.by_length(ask.column("v"))}
            for at_x, x in V.by_length(have.column("v")):
                if x.shape[1] not in by_q:
                    continue
                at_q, xq, uq = by_q[x.shape[1]]
                place = np.full(len(ask), -1)
                place[at_q] = np.arange(len(at_q))
                order = np.argsort(bucket_x[at_x], kind="stable")
                at_x, x = at_x[order], x[order]
                ux, bx = V.unit(x), bucket_x[at_x]
                turns = np.concatenate([[0], np.nonzero(np.diff(bx))[0] + 1, [len(bx)]])
                for lo, hi in zip(turns[:-1], turns[1:], strict=True):
                    qs = place[owner[np.searchsorted(bucket_q, bx[lo], "left") : np.searchsorted(bucket_q, bx[lo], "right")]]
                    qs = qs[qs >= 0]
                    for some in range(0, len(qs), 512):
                        of = qs[some : some + 512]
                        q, c, s = _nearest(uq[of], xq[of], ux[lo:hi], x[lo:hi], ids[at_x[lo:hi]], kept)
                        out.append((at_q[of[q]], at_x[lo + c], s))
        if not out:
            return none
        q, c, s = (np.concatenate(x) for x in zip(*out, strict=True))
        at = _best(q, s, ids[c], kept)
        return pa.table({"q": node_q[q[at]], "c": node_x[c[at]], "least": have.column("least").take(pa.array(c[at])), "score": s[at]})

    def own(batches):
        for b in batches:
            score = np.zeros(b.num_rows)
            for at, x in V.by_length(b.column("v")):
                score[at] = V.cosines(x, x)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("node"), b.column("least"), pa.array(score)], names=["q", "c", "least", "score"])

    schema = f"q bigint, c bigint, least {id_type}, score double"
    pairs = index.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(compare, schema).union(asked.select("node", "least", "v").mapInArrow(own, schema))
    merged = pairs.groupBy("q", "c").agg(F.max("least").alias("least"), F.max("score").alias("score"))  # tables and shards may find the same vector
    scored = merged.withColumn("rn", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "least", "c"))).where(F.col("rn") <= kept)
    scored = stored(scored.select("q", "c", "score"), "found")
    near = scored.join(members.withColumnRenamed("node", "_c"), F.col("c") == F.col("_c")).select("q", "c", "score", F.explode("ids").alias("id"))
    # at most (k + 1)^2 rows a query; one more than k, as the query itself may be among them
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("m"), "id", "c"))), 1, k + 1)
    lists = stored(near.groupBy("q").agg(best.alias("near")), "lists")
    found = named.where("asks").join(lists.hint("merge"), F.col("node") == F.col("q"))
    # the query's own row goes once; another row with its id is a candidate like any other
    at = F.array_position(F.transform("near", lambda x: (x["id"] == F.col("vec_id")) & (x["c"] == F.col("node"))), True)
    others = F.filter("near", lambda x, i: (F.col("at") == 0) | (i != F.col("at") - 1))
    found = found.withColumn("at", at).select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("i", "x"))
    return found.select("query_id", (F.col("i") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.m")).alias("score"))
