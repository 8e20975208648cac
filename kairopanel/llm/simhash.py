"""SimHash near-duplicates by a binary trie self-join.

Fingerprint (``near_duplicates``): 64 bits from the XXH64 (seed 42) of every ``shingle``-word shingle of the whole text,
repeats included; a bit is 1 if more than half of the hashes have it. Texts without words get fingerprint zero and
link like any other; a text with fewer words than a shingle is one shingle.

Join: of ``budget`` + 1 equal blocks of bits, two fingerprints within the budget agree in one at least. Every
*distinct* fingerprint is dealt once per block by (block, its bits there). A task holds the binary trie of each
of its groups as ranges of a sorted array and walks pairs of nodes down together, adding the bits in which they
differ and dropping a pair as soon as the budget is exceeded. Groups of more than ``most`` fingerprints are cut
into chunks, and each pair of chunks is a group of its own, so that no task ever holds a whole hot group; no
pair is lost. A task returns only a spanning forest of the links it finds (as many rows as fingerprints at most).

Deduplication (``deduplicate``): links are texts whose sets of ``shingle``-word shingles have a Jaccard similarity of
``similarity`` or more. At 0.8 some 15 of 100 SimHash bits differ, more than one trie of whole fingerprints can be
searched for, so the fingerprint has 512 bits and the trie join runs on several tables of 32 of them, each dealt by its
first bits and joined within a budget of 3 on the rest. The number of tables follows from the share of pairs at the very
similarity that one table finds, so that ``success`` of them are found (closer pairs more surely), and the first bits
grow with the number of texts, so that groups don't. What is found goes on if 192 bits differ as little as such pairs
do. So that a group of copies isn't expanded into pairs, a task returns the spanning forest of least differences of what
it finds, and each of its edges is verified on the whole texts.

What the tries leave out (pairs that no table brings together, whose bits differ more than expected, or whose part's
one edge was refused) is made up for exactly (``missed``): only links between two of the classes found so far are
wanted. Sets of n shingles in any one order have one of their first n - ceil(similarity * n) + 1 shingles in common if
they reach the similarity. Those prefixes are grouped by shingle; of groups with several classes, pairs across classes
stay whose sizes, places and parities of the sets allow a link (none of these bounds refuses one) and are verified
like the others. Frequent shingles come last in the order, so that groups stay small; which they are is counted on a
sample, as the order changes the number of pairs tried but never the links found.

Null doc_id: the row takes part; its component_id is the smallest id reachable, null if there is none. Copies
and repeated rows meet in one fingerprint or set and are never paired with each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairopanel.llm import vectors as V
from kairopanel.llm.common import clustered, key_of, let_go, stored, word_hashes, words
from kairopanel.llm.components import connected_components

BITS = 64


def fingerprint_texts(texts: list[str | None], shingle: int = 3, piece: int = 1 << 16) -> np.ndarray:
    """Fingerprints as int64 (the unsigned value's bit pattern); ``piece`` hashes are held at once."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        w = words(text)
        if not w:
            continue
        n = max(1, len(w) - shingle + 1)
        ones = np.zeros(BITS, np.int64)
        for lo in range(0, n, piece):
            part = w[lo : lo + piece + shingle - 1]
            grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False)) if len(part) >= shingle else (b" ".join(part),)
            h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0]
    return out.view(np.int64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, k, fp bigint) for every row; k hashes id and text."""

    def each(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fingerprint_texts(b.column(2).to_pylist(), shingle))], names=["doc_id", "k", "fp"])

    src = docs.select(docs[doc_id].alias("doc_id"), row_key(docs, doc_id, text).alias("k"), docs[text].alias("text"))
    return src.mapInArrow(each, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, k binary, fp bigint")


def row_key(docs: DataFrame, doc_id: str, text: str) -> Column:
    return key_of(docs[doc_id], docs[text])


def trie_pairs(x: np.ndarray, starts: np.ndarray, side: np.ndarray, budget: int, low: int = 0, cap: int = 1 << 18):
    """Yields index pairs (i < j or across sides) within ``budget`` differing bits from bit ``low`` up, for many groups at once.

    x: uint64, sorted within every run of equal (group, side). starts: bounds of the runs. side: for each run -1
    (join it with itself), or 0, directly followed by its partner run 1 (join the two). Some ``cap`` pairs of nodes are
    walked down at once; the others wait.
    """
    ones: dict[int, np.ndarray] = {}

    def cut(lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        """For ranges [lo, hi) whose members agree above bit ``depth``: where the bit turns from 0 to 1."""
        if depth not in ones:
            ones[depth] = np.cumsum(np.concatenate([[0], (x >> np.uint64(depth)) & np.uint64(1)]), dtype=np.int32)
        return hi - (ones[depth][hi] - ones[depth][lo])

    lo, hi = starts[:-1], starts[1:]
    own, left = np.nonzero(side < 0)[0], np.nonzero(side == 0)[0]
    a_lo, a_hi = np.concatenate([lo[own], lo[left]]), np.concatenate([hi[own], hi[left]])
    b_lo, b_hi = np.concatenate([lo[own], lo[left + 1]]), np.concatenate([hi[own], hi[left + 1]])
    todo = [(BITS - 1, a_lo, a_hi, b_lo, b_hi, np.zeros(len(a_lo), np.int64))]
    while todo:
        depth, *nodes = todo.pop()
        if len(nodes[0]) > cap:
            half = len(nodes[0]) // 2
            todo += [(depth, *(v[half:] for v in nodes)), (depth, *(v[:half] for v in nodes))]
            continue
        a_lo, a_hi, b_lo, b_hi, diff = nodes
        same = a_lo == b_lo
        live = (a_hi > a_lo) & (b_hi > b_lo) & ~(same & (a_hi - a_lo < 2))
        leaf = live & (a_hi - a_lo == 1) & (b_hi - b_lo == 1)  # both paths are single: compare what is left at once
        if leaf.any():
            i, j = a_lo[leaf], b_lo[leaf]
            ok = np.bitwise_count((x[i] ^ x[j]) >> np.uint64(low)) <= budget
            yield i[ok], j[ok]
        live &= ~leaf
        a_lo, a_hi, b_lo, b_hi, diff, same = a_lo[live], a_hi[live], b_lo[live], b_hi[live], diff[live], same[live]
        if not len(a_lo):
            continue
        if depth < low:  # what is left is equal in all bits looked at but those counted
            yield from _across(a_lo, a_hi, b_lo, b_hi, cap)
            continue
        a_cut, b_cut = cut(a_lo, a_hi, depth), cut(b_lo, b_hi, depth)
        more = diff < budget
        cross = more & ~same
        todo.append(
            (
                depth - 1,
                *(
                    np.concatenate(v)
                    for v in (
                        (a_lo, a_cut, a_lo[more], a_cut[cross]),
                        (a_cut, a_hi, a_cut[more], a_hi[cross]),
                        (b_lo, b_cut, b_cut[more], b_lo[cross]),
                        (b_cut, b_hi, b_hi[more], b_cut[cross]),
                        (diff, diff, diff[more] + 1, diff[cross] + 1),
                    )
                ),
            )
        )


def _across(a_lo: np.ndarray, a_hi: np.ndarray, b_lo: np.ndarray, b_hi: np.ndarray, cap: int):
    """All index pairs of range pairs, some ``cap`` at a time; of a range with itself i < j."""
    owner = np.repeat(np.arange(len(a_lo)), a_hi - a_lo)
    i = np.arange(len(owner)) - np.repeat(np.cumsum(a_hi - a_lo) - (a_hi - a_lo), a_hi - a_lo) + a_lo[owner]
    at = np.where(a_lo[owner] == b_lo[owner], i + 1, b_lo[owner])
    n = b_hi[owner] - at
    upto = np.cumsum(n)
    turn = np.unique(np.concatenate([[0], np.searchsorted(upto, np.arange(cap, upto[-1], cap)) + 1, [len(n)]]))
    for lo, hi in zip(turn[:-1], turn[1:], strict=True):
        m = n[lo:hi]
        yield np.repeat(i[lo:hi], m), np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(at[lo:hi], m)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index reachable from each of n nodes, by label passing and pointer jumping."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def spanning(n: int, i: np.ndarray, j: np.ndarray, cost: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Edges out of (i, j) that connect whatever all of them do, without circles, of least cost; then near neighbours first."""
    order = np.argsort(np.abs(j - i), kind="stable") if cost is None else np.lexsort((np.abs(j - i), cost))
    i, j, label, out = i[order], j[order], np.arange(n), []
    rest = [] if cost is None else [cost[order]]
    while True:
        a, b = label[i], label[j]
        live = a != b
        i, j, a, b, rest = i[live], j[live], a[live], b[live], [c[live] for c in rest]
        if not len(i):
            break
        first, turn = np.full(n, len(i)), np.arange(len(i))
        np.minimum.at(first, a, turn)
        np.minimum.at(first, b, turn)
        pick = np.unique(first[first < len(i)])  # of each part its first edge: unequal places, so no circle
        out.append((i[pick], j[pick], *(c[pick] for c in rest)))
        label = forest(n, a[pick], b[pick])[label]
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (i, j, *rest)


def folded(n: int, found, most: int = 1 << 21) -> tuple[np.ndarray, ...]:
    """A spanning forest of the pairs that come in parts, with bounded memory."""
    held, size = [], 0
    for part in found:
        held.append(part)
        size += len(part[0])
        if size > most:
            held = [spanning(n, *(np.concatenate(c) for c in zip(*held, strict=True)))]
            size = len(held[0][0])
    return spanning(n, *(np.concatenate(c) for c in zip(*held, strict=True))) if held else (np.zeros(0, np.int64),) * 2


def _chunked(rows: DataFrame, keys: list[str], by: Column, most: int) -> DataFrame:
    """Adds c1, c2 and side: groups of more than ``most`` rows are cut into chunks, and each pair of chunks is a group."""
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    hot = hot.select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("_n") / max(1, most // 2)).cast("int").alias("_chunks"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    cut = rows.join(hot, on, "left").withColumn("_chunk", F.when(F.col("_chunks").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), F.col("_chunks")).cast("int")))
    other = F.explode(F.when(F.col("_chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_chunks") - 1))).alias("_other")
    rows = cut.select(*rows.columns, "_chunk", other)
    return rows.withColumns({"c1": F.least("_chunk", "_other"), "c2": F.greatest("_chunk", "_other"), "side": (F.col("_chunk") > F.col("_other")).cast("int")}).drop("_chunk", "_other")


def _by_group(rows: DataFrame, keys: list[str], each, schema: str, slab: int = 1 << 16) -> DataFrame:
    """Calls each(table, keys of its rows, starts and roles of its runs) for whole groups of keys, some ``slab`` rows at once.

    rows have s (the fingerprint, the sign bit turned) and, from _chunked, c1, c2 and side.
    """
    keys = [*keys, "c1", "c2"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "side", "s")

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for b in chain(batches, [None]):
            if b is not None and b.num_rows:
                held.append(b)
                size += b.num_rows
            if not held or (b is not None and size < slab):
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            k = np.stack([t.column(c).to_numpy().astype(np.int64) for c in keys])
            turns = np.nonzero((k[:, 1:] != k[:, :-1]).any(0))[0] + 1
            end = len(t) if b is None else (int(turns[-1]) if len(turns) else 0)  # the last group may go on
            if end:
                yield from each(t.slice(0, end), *_runs(t.slice(0, end), k[:, :end]))
            held = t.slice(end).to_batches() if end < len(t) else []
            size = len(t) - end

    return rows.mapInArrow(run, schema)


def _runs(t: pa.Table, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, bounds of the runs and their roles for trie_pairs."""
    x = t.column("s").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
    side = t.column("side").to_numpy().astype(np.int64)
    new_group = np.concatenate([[True], (k[:, 1:] != k[:, :-1]).any(0)])
    new_run = new_group | np.concatenate([[True], side[1:] != side[:-1]])
    starts = np.nonzero(new_run)[0]
    kind = side[starts]
    opens = new_group[starts]
    paired = k[-2][starts] != k[-1][starts]
    has_next = np.concatenate([~opens[1:], [False]])
    # a run joins itself in the group (chunk, chunk), or its follower in the group of two chunks; one alone there is done
    role = np.where(~paired, -1, np.where((kind == 0) & has_next, 0, 1))
    return x, np.append(starts, len(x)), role


def links(fps: DataFrame, budget: int = 3, most: int = 1024) -> DataFrame:
    """Forest edges (u, v) of the graph on the distinct values of fps(fp) whose links differ in <= budget bits."""
    width = BITS // (budget + 1)
    blocks = F.posexplode(F.array(*[F.shiftrightunsigned("fp", width * k).bitwiseAND((1 << width) - 1) for k in range(budget + 1)])).alias("block", "key")
    dealt = fps.select("fp").distinct().select(F.col("fp").bitwiseXOR(F.lit(-(1 << 63))).alias("s"), blocks)

    def join(t: pa.Table, x: np.ndarray, starts: np.ndarray, role: np.ndarray):
        i, j = folded(len(x), trie_pairs(x, starts, role, budget))
        if len(i):
            fp = x.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j])], names=["u", "v"])

    keys = ["block", "key"]
    return _by_group(_chunked(dealt, keys, F.col("s"), most), keys, join, "u bigint, v bigint")


def components(prints: DataFrame, budget: int = 3) -> DataFrame:
    """Adds root (the class of a row) and component_id (the smallest doc_id reachable by links) to prints(doc_id, fp)."""
    prints = stored(prints, "fingerprints")
    roots = connected_components(links(prints, budget)).withColumnRenamed("node", "fp")
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = firsts.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(firsts.select("fp", "root").join(least, "root").select(F.col("fp").alias("of"), "root", "component_id"), "classes")
    return prints.join(classes.hint("merge"), F.col("fp") == F.col("of")).drop("of")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, budget: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    out = components(fingerprints(docs, doc_id, text, shingle), budget)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- deduplication at a similarity of shingle sets ---

_WORDS = 8  # 64-bit words of a wide fingerprint
_ZONE, _ZONE_BUDGET, _CHECK = 32, 3, 192
_SALT = np.random.default_rng(64).integers(1 << 63, size=_WORDS, dtype=np.uint64)


def shingle_sets(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text; a text with fewer words is one shingle."""
    h, n = word_hashes(texts)
    out, at = [], 0
    for size in n.tolist():
        ids, at = h[at : at + size], at + size
        k = min(shingle, size)
        out.append(np.unique(V.mix(*(ids[i : size - k + 1 + i] for i in range(k)))) if size else np.zeros(0, np.int64))
    return out


def wide_fingerprint(s: np.ndarray, piece: int = 1 << 12) -> np.ndarray:
    """The 512 bits (8 words) of a set: a bit is 1 if more than half of the members' hashes have it."""
    ones = np.zeros(_WORDS * BITS, np.int64)
    for lo in range(0, len(s), piece):
        x = s[lo : lo + piece].view(np.uint64)[:, None] ^ _SALT
        with np.errstate(over="ignore"):
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
        ones += np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return np.packbits(ones * 2 > len(s), bitorder="little").view(np.uint64)


def parities(s: np.ndarray) -> np.ndarray:
    """A bit for each of 512 places, or of the next power of two if there are more members: whether an odd number of members falls on it.

    The bits of two sets differ in no more places than the sets do in members, also if the longer bits are folded.
    """
    size = 1 << max(9, (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s.view(np.uint64) >> np.uint64(20)) & np.uint64(size - 1), minlength=size) & 1, bitorder="little").view(np.uint64)


def parities_differ(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n)) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _batches(texts: pa.Array, most: int = 1 << 18):
    """Lists of neighbouring texts, some ``most`` characters together (or one text)."""
    held, size = [], 0
    for lo in range(0, len(texts), 64):
        for t in texts.slice(lo, 64).to_pylist():
            held.append(t)
            size += len(t or "")
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def wide_fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, k, node, fp, odd): node names the row's shingle set (128 bits), fp is its wide fingerprint, odd its parities."""

    def each(batches):
        let_go()
        for b in batches:
            node, fp, odd = [], [], []
            for some in _batches(b.column(2)):
                for s in shingle_sets(some, shingle):
                    node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    fp.append(wide_fingerprint(s).tobytes())
                    odd.append(parities(s).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.binary()) for c in (node, fp, odd))], names=["doc_id", "k", "node", "fp", "odd"])

    src = docs.select(docs[doc_id].alias("doc_id"), row_key(docs, doc_id, text).alias("k"), docs[text].alias("text"))
    return src.mapInArrow(each, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, k binary, node binary, fp binary, odd binary")


def differing(similarity: float) -> float:
    """The share of SimHash bits in which two sets of equal size and this Jaccard similarity differ on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def table_plan(n: int, similarity: float, success: float) -> tuple[int, int]:
    """First bits and number of tables for n fingerprints: some 2,048 a group, pairs at the similarity found with ``success``."""
    first = min(16, max(6, math.ceil(math.log2(max(2, n))) - 11))
    p, rest = differing(similarity), _ZONE - first
    share = (1 - p) ** first * sum(math.comb(rest, k) * p**k * (1 - p) ** (rest - k) for k in range(_ZONE_BUDGET + 1))
    return first, math.ceil(math.log(1 - success) / math.log(1 - share))


def _tables(nodes: DataFrame, first: int, tables: int) -> DataFrame:
    """A row per node and table: place (table and first bits), s (the zone), y0 to y2 (the same 192 bits in all tables), node.

    A fingerprint is 32 quarters of 16 bits; table t's zone is quarter t with the one t // 32 + 1 after it.
    """
    t = np.arange(tables)
    zone = np.stack([t % 32, (t + t // 32 + 1) % 32], axis=1)

    def each(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                raw = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, 32)
                q = raw[:, zone].astype(np.uint64)
                x = q[:, :, 0] << np.uint64(48) | q[:, :, 1] << np.uint64(32)
                place = (t << first) | (x >> np.uint64(64 - first)).astype(np.int64)
                at = pa.array(np.repeat(np.arange(part.num_rows), tables))
                y = raw.view(np.int64)[:, :3]
                cols = [pa.array(place.reshape(-1)), pa.array((x ^ np.uint64(1 << 63)).view(np.int64).reshape(-1)), *(pa.array(y[:, k].copy()).take(at) for k in range(3)), part.column(0).take(at)]
                yield pa.RecordBatch.from_arrays(cols, names=["place", "s", "y0", "y1", "y2", "node"])

    return nodes.select("node", "fp").mapInArrow(each, "place bigint, s bigint, y0 bigint, y1 bigint, y2 bigint, node binary")


def _found(dealt: DataFrame, similarity: float, most: int) -> DataFrame:
    """Candidate pairs (u, v), u < v: each group's spanning forest of least differences."""
    p = differing(similarity)
    allowed = math.ceil(_CHECK * p + 3 * math.sqrt(_CHECK * p * (1 - p)))

    def join(t: pa.Table, x: np.ndarray, starts: np.ndarray, role: np.ndarray):
        y, node = [t.column(f"y{k}").to_numpy().view(np.uint64) for k in range(3)], t.column("node").combine_chunks()

        def near():
            for i, j in trie_pairs(x, starts, role, _ZONE_BUDGET, BITS - _ZONE):
                cost = sum(np.bitwise_count(c[i] ^ c[j]).astype(np.int16) for c in y)
                ok = cost <= allowed
                yield i[ok], j[ok], cost[ok]

        i, j, *_ = folded(len(x), near())
        if len(i):
            yield pa.RecordBatch.from_arrays([node.take(pa.array(i)), node.take(pa.array(j))], names=["u", "v"])

    pairs = _by_group(_chunked(dealt, ["place"], F.col("node"), most), ["place"], join, "u binary, v binary")
    return pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, text: str, keys: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(u, v, ok) for pairs: whether the sets' similarity is reached, by the whole texts. keys(node, k): a row of each node."""

    def deflated(batches):
        for b in batches:
            z = [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for lo in range(0, b.num_rows, 64) for t in b.column(1).slice(lo, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(z, pa.binary())], names=["node", "z"])

    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().join(keys, "node")
    wanted = stored(wanted.select(F.col("k").alias("_k"), "node"), "wanted")
    # the keys move, the texts stay where they are
    texts = docs.join(wanted, F.col("k") == F.col("_k")).select("node", "text")
    texts = stored(texts.mapInArrow(deflated, "node binary, z binary"), "texts")
    side = lambda c, z: texts.select(F.col("node").alias(f"_{c}"), F.col("z").alias(z))
    both = pairs.join(side("u", "z1").hint("merge"), F.col("u") == F.col("_u")).join(side("v", "z2").hint("merge"), F.col("v") == F.col("_v")).select("u", "v", "z1", "z2")

    def verify(batches):
        for b in batches:
            ok = []
            for lo in range(0, b.num_rows, 16):
                z = [x for c in (2, 3) for x in b.column(c).slice(lo, 16).to_pylist()]
                sets = shingle_sets([zlib.decompress(x).decode("utf-8", "surrogatepass") for x in z], shingle)
                for x, y in zip(sets[: len(sets) // 2], sets[len(sets) // 2 :], strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(common >= similarity * (len(x) + len(y) - common) * (1 - 1e-12))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["u", "v", "ok"])

    return both.mapInArrow(verify, "u binary, v binary, ok boolean")


def similar(docs: DataFrame, keys: DataFrame, fps: DataFrame, text: str, shingle: int, similarity: float, success: float, most: int = 2048) -> DataFrame:
    """Verified links (u, v) that connect the nodes of every class. docs(k, text), a row a key; keys(node, k); fps(node, fp)."""
    first, tables = table_plan(fps.count(), similarity, success)
    pairs = stored(_found(_tables(fps, first, tables), similarity, most), "candidates")
    return stored(_verified(pairs, docs, text, keys, shingle, similarity), "verified").where("ok").select("u", "v")


def _frequent(reps: DataFrame, n: int, shingle: int, sample: int = 8192, least: int = 3, most: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of frequent shingles and their ranks, the most frequent last: found in ``least`` of some ``sample`` of n reps(node, text)."""

    def each(batches):
        for b in batches:
            for some in _batches(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(some, shingle)))], names=["h"])

    some = reps.where(F.pmod(F.xxhash64("node"), F.lit(max(1, n // sample))) == 0).select("text")
    counted = some.mapInArrow(each, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    h = np.array([r.h for r in counted.orderBy(F.desc("n"), "h").limit(most).collect()], np.int64)  # at most ``most`` rows
    order = np.argsort(h)
    return h[order], -order


def prefix(s: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first members of a set: one of them is in the prefix of every set that is as similar."""
    hot, rank = frequent
    at = np.minimum(np.searchsorted(hot, s), max(0, len(hot) - 1))
    known = hot[at] == s if len(hot) else np.zeros(len(s), bool)
    last = s[known][np.argsort(rank[at[known]], kind="stable")] if known.any() else s[:0]
    return np.concatenate([s[~known], last])[: len(s) - math.ceil(similarity * len(s) - 1e-9) + 1] if len(s) else s


def _prefixes(docs: DataFrame, frequent, shingle: int, similarity: float) -> DataFrame:
    """(h, id, cls, n, p) of docs(id, cls, text): a row per member h of the prefix, at place p of a set of n."""

    def each(batches):
        for b in batches:
            at = 0
            for some in _batches(b.column(2)):
                sets = shingle_sets(some, shingle)
                first = [prefix(s, frequent.value, similarity) for s in sets]
                size = np.array([len(x) for x in first])
                of = pa.array(np.repeat(np.arange(at, at + len(some)), size))
                n, p = np.repeat([len(s) for s in sets], size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                at += len(some)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(first)), b.column(0).take(of), b.column(1).take(of), pa.array(n.astype(np.int32)), pa.array(p.astype(np.int32))], names=["h", "id", "cls", "n", "p"])

    return docs.select("id", "cls", "text").mapInArrow(each, "h bigint, id bigint, cls bigint, n int, p int")


def _across_classes(shared: DataFrame, similarity: float, most: int) -> DataFrame:
    """(a, b, differ): ids of different classes that share a member of their prefixes and may be linked; differ bounds the members of one only."""

    def join(t: pa.Table, x: np.ndarray, starts: np.ndarray, role: np.ndarray):
        ids, cls, n, p = (t.column(c).to_numpy().astype(np.int64) for c in ("id", "cls", "n", "p"))
        lo, hi = starts[:-1], starts[1:]
        own, left = np.nonzero(role < 0)[0], np.nonzero(role == 0)[0]
        ranges = [np.concatenate([v[own], v[left + k]]) for k in (0, 1) for v in (lo, hi)]
        if not len(ranges[0]):
            return
        for i, j in _across(*ranges, 1 << 18):
            need = np.ceil(similarity / (1 + similarity) * (n[i] + n[j]) - 1e-9).astype(np.int64)
            # by the first shared member in the order all that follow it at most are shared, too
            ok = (cls[i] != cls[j]) & (need <= np.minimum(n[i] - p[i], n[j] - p[j]))
            if ok.any():
                i, j, need = i[ok], j[ok], need[ok]
                a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n[i] + n[j] - 2 * need)], names=["a", "b", "differ"])

    rows = shared.withColumn("s", F.col("id"))
    return _by_group(_chunked(rows, ["h"], F.col("id"), most), ["h"], join, "a bigint, b bigint, differ bigint").distinct()


def missed(docs: DataFrame, known: DataFrame, nodes: DataFrame, text: str, shingle: int, similarity: float, most: int) -> DataFrame:
    """Verified links (u, v) between nodes of different classes, all there are. docs(k, text); known(id, k, node, cls); nodes(id, k, node, odd)."""
    spark, t = docs.sparkSession, similarity * (1 - 1e-12)
    src = docs.join(known.select(F.col("k").alias("_k"), "id", "cls", "node"), F.col("k") == F.col("_k"))
    reps = src.where("id = cls")
    frequent = spark.sparkContext.broadcast(_frequent(reps, known.where("id = cls").count(), shingle))
    group = Window.partitionBy("h")
    dealt = _prefixes(src, frequent, shingle, t).withColumns({"_lo": F.min("cls").over(group), "_hi": F.max("cls").over(group)})
    shared = stored(dealt.where("_lo <> _hi").drop("_lo", "_hi"), "shared")
    side = lambda c, names: nodes.select(F.col("id").alias(f"_{c}"), *[F.col(k).alias(v) for k, v in names.items()])
    both = _across_classes(shared, t, most).join(side("a", {"node": "u", "odd": "o1"}), F.col("a") == F.col("_a")).join(side("b", {"node": "v", "odd": "o2"}), F.col("b") == F.col("_b"))

    def near(batches):
        for b in batches:
            ok = []
            for most, *sides in zip(*(b.column(c).to_pylist() for c in (2, 3, 4)), strict=True):
                ok.append(parities_differ(*(np.frombuffer(x, np.uint64) for x in sides)) <= most)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(ok, pa.bool_()))

    pairs = stored(both.select("u", "v", "differ", "o1", "o2").mapInArrow(near, "u binary, v binary"), "missed")
    if pairs.isEmpty():
        return pairs
    return stored(_verified(pairs, docs, text, nodes.select("node", "k"), shingle, similarity), "verified").where("ok").select("u", "v")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, success: float = 0.99, most: int = 2048) -> DataFrame:
    """docs with one document of each class of linked ones, the one with the smallest id (null last); same columns.

    Of rows equal in id and text one stays.
    """
    rows = stored(wide_fingerprints(docs, doc_id, text, shingle), "fingerprints")
    nodes = rows.groupBy("node").agg(F.min("k").alias("k"), F.first("fp").alias("fp"), F.first("odd").alias("odd"))  # of one node all are equal
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    # the one shuffle of whole rows: equal ones collapse before it, and the joins below are by k
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_key(docs, doc_id, text).alias("k"))
    held = clustered(whole.groupBy("k").agg(F.first("row").alias("row")), "held", "k")
    src = held.select("k", F.col("row").getField(text).alias("text"))
    edges = similar(src, nodes.select("node", "k"), nodes.select("node", "fp"), text, shingle, similarity, success, most)
    roots = connected_components(edges).select(F.col("node").alias("of"), "root")
    known = nodes.join(roots, F.col("node") == F.col("of"), "left").select("id", "k", "node", F.coalesce("root", "node").alias("_root"))
    known = stored(known.join(nodes.select(F.col("node").alias("_of"), F.col("id").alias("cls")), F.col("_root") == F.col("_of")).select("id", "k", "node", "cls"), "known")
    more = missed(src, known, nodes, "text", shingle, similarity, most)
    side = lambda c: known.select(F.col("node").alias(f"_{c}"), F.col("cls").alias(f"c{c}"))
    more = more.join(side("u"), F.col("u") == F.col("_u")).join(side("v"), F.col("v") == F.col("_v")).select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    joined = stored(connected_components(more), "joined").select(F.col("node").alias("_cls"), "root")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")
    firsts = rows.groupBy("node").agg(F.min(order).alias("x"))  # a class may hold very many copies: they collapse before the join
    classes = known.select(F.col("node").alias("of"), "cls").join(joined, F.col("cls") == F.col("_cls"), "left").select("of", F.coalesce("root", "cls").alias("root"))
    kept = firsts.join(classes, F.col("node") == F.col("of")).groupBy("root").agg(F.min("x").alias("x"))
    kept = kept.select(F.col("x.k").alias("_k"))
    return held.join(kept, F.col("k") == F.col("_k"), "left_semi").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
