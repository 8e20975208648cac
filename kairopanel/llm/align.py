"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes, and how often corpus-wide.

Both tokenizers encode a text; token A and token B are linked where their byte ranges overlap, and byte offsets where
both end cut the text into groups. A first pass writes the ids of every text and, for each task, how many of its
documents hold a linked id pair. The pairs, spread over ``slots`` by hash, get a minimal perfect hash a slot: bit
arrays of falling size, in each of which a key that meets no other takes its place (as in BBHash), so the hash of a
pair is the number of set bits before its own. Counts then are dense vectors indexed by that hash, made from the tasks'
counts and summed in a tree of ``fan`` inputs a node; the key kept at each place verifies a lookup. A second pass
aligns the written ids again and looks the counts up.

No slot can grow without bound: there are at most V_A * V_B pairs. The table is broadcast in rounds of whole slots, at
most ``round_bytes`` together (or one slot); with several rounds a text's sums over the rounds are added up.

Defined results: texts that are null, empty, or whose tokens' bytes in either vocabulary don't join to space + text
have no tokens: zeros and the empty string. Special tokens' strings in texts are plain text. Repeated rows and null ids
are documents of their own. With no documents there are no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairopanel.llm.common import work_dir
from kairopanel.llm.packing import Encoder, _odd

_PIECE = 1 << 20  # characters that are aligned together (or one text)
_ALIGNERS: dict = {}  # of this worker process, for its later tasks


def byte_level(token: str) -> bytes:
    """Bytes of an entry of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes for 256, 257, ..."""
    return bytes(_BYTE_OF[c] for c in token)


_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _OWN} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _OWN)}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a sentence piece: U+2581 is a space, <0xHH> the byte HH."""
    if m := re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace("▁", " ").encode("utf-8", "surrogatepass")


class Ragged:
    """Growing runs of numbers, one run an entry."""

    def __init__(self, kind):
        self.data, self.first, self.size, self.n, self.end = np.empty(1 << 16, kind), np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64), 0, 0

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        while self.end + len(flat) > len(self.data):
            self.data = np.concatenate([self.data, np.empty_like(self.data)])
        while self.n + len(size) > len(self.first):
            self.first, self.size = (np.concatenate([x, np.empty_like(x)]) for x in (self.first, self.size))
        self.data[self.end : self.end + len(flat)] = flat
        self.size[self.n : self.n + len(size)] = size
        self.first[self.n : self.n + len(size)] = self.end + np.cumsum(size) - size
        self.n, self.end = self.n + len(size), self.end + len(flat)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of these entries one after another, and their sizes."""
        n = self.size[at]
        return self.data[np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n


def _sums(values: np.ndarray, per: np.ndarray) -> np.ndarray:
    """Sums of the first per[0] values, of the next per[1], ..."""
    run, upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)]), np.cumsum(per)
    return run[upto] - run[upto - per]


class Aligner:
    """Two vocabularies: encodes texts with both and aligns them.

    Where neither tokenizer lets words influence each other, a word with the space before it is a run of groups of its
    own: it is encoded and aligned once and kept in a bounded dictionary. Texts with unusual white space, or all if a
    vocabulary has entries across words, are encoded whole.
    """

    def __init__(self, path_a: str, path_b: str, most: int = 200_000):
        import sentencepiece

        self.a, self.b, self.most = Encoder(path_a, 1 << 16), sentencepiece.SentencePieceProcessor(model_file=path_b), most
        self.a.tokenizer.encode_special_tokens = True
        vocab = self.a.tokenizer.get_vocab()
        entries = [b""] * (max(vocab.values()) + 1)
        special = {t.content for t in self.a.tokenizer.get_added_tokens_decoder().values()}
        for x, i in vocab.items():
            entries[i] = x.encode() if x in special else byte_level(x)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.n_a, self.n_b = len(entries), len(pieces)
        self.bytes_a, self.bytes_b = (self._table(x) for x in (entries, [piece_bytes(x) for x in pieces]))
        self.shown = self._table([b"%d%s" % (i, e) for i in range(self.n_a) for e in (b",", b"|")] + [b"%d%s" % (i, e) for i in range(self.n_b) for e in (b",", b";")], np.uint8)
        #: how ids are written: both vocabularies' fit into 16 bits, if they are small enough
        self.written_as = "<u2" if max(self.n_a, self.n_b) <= 1 << 16 else "<u4"
        self.apart = self.a.plain and all("▁" not in x.lstrip("▁") for x in pieces)
        self._clear()

    def _clear(self) -> None:
        #: by word: ids by A and by B and the written groups, each closed by ";"; size of the last 0 if the bytes aren't the text's
        self.code: dict[str, int] = {}
        self.of_a, self.of_b, self.written = Ragged(np.uint32), Ragged(np.uint32), Ragged(np.uint8)

    def forget(self) -> None:
        """Drops what the dictionaries hold: a worker that has encoded goes on without encoding."""
        self._clear()
        for known in self.a.known.values():
            known.clear()

    @staticmethod
    def _table(entries: list[bytes], kind=np.uint8) -> Ragged:
        out = Ragged(kind)
        out.add(np.frombuffer(b"".join(entries), kind), np.array([len(x) for x in entries], np.int64))
        return out

    def whole(self, texts: list[str], a: list[bytes]) -> tuple[tuple, tuple, tuple]:
        """(flat, sizes) of the ids by A (as given) and by B of texts, and of their written groups: none where the bytes aren't those of space + text."""
        got = self.b.encode(texts, num_threads=1)
        per_a, per_b = np.array([len(x) // 4 for x in a], np.int64), np.array(list(map(len, got)), np.int64)
        flat_a, flat_b = np.frombuffer(b"".join(a), "<u4"), np.fromiter(chain.from_iterable(got), np.uint32, int(per_b.sum()))
        want = (" " + " ".join(texts)).encode("utf-8", "surrogatepass")
        sides = [table.take(flat) for flat, table in ((flat_a, self.bytes_a), (flat_b, self.bytes_b))]
        good = np.ones(len(texts), bool)
        if any(x.tobytes() != want for x, _ in sides):  # then text by text
            size = np.array([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts], np.int64)
            for (x, n), per in zip(sides, (per_a, per_b), strict=True):
                own = _sums(n, per)
                for k, (end, m, w) in enumerate(zip(np.cumsum(own).tolist(), own.tolist(), np.cumsum(size).tolist(), strict=True)):
                    good[k] &= m == size[k] and x[end - m : end].tobytes() == want[w - m : w]
        keep = [flat[np.repeat(good, per)] for flat, per in ((flat_a, per_a), (flat_b, per_b))]
        written = Aligned(self, keep[0], keep[1], per_a * good, per_b * good).groups()
        return (flat_a, per_a), (flat_b, per_b), written

    def learn(self, words: list[str]) -> None:
        for lo in range(0, len(words), 1 << 14):
            some = words[lo : lo + (1 << 14)]
            self.a.learn(" ", set(some))
            for store, (flat, size) in zip((self.of_a, self.of_b, self.written), self.whole(some, list(map(self.a.known[" "].__getitem__, some))), strict=True):
                store.add(flat, size)
            self.code.update(zip(some, range(len(self.code), len(self.code) + len(some)), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes], list[str]]:
        """For each text the ids (uint32) by A and by B and the SHA-256 of its written groups; nothing where the bytes of
        either don't join to space + text."""
        cut = [t.split(" ") if t and self.apart and "▁" not in t and not _odd(" " + t) else [] for t in texts]
        words, per = list(chain.from_iterable(cut)), np.array(list(map(len, cut)), np.int64)
        found = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        new = dict.fromkeys(words[i] for i in np.flatnonzero(found < 0).tolist())
        if new:
            if len(self.code) + len(new) > self.most:
                self._clear()
                new = dict.fromkeys(words)
            self.learn(list(new))
            found = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        good = _sums(self.written.size[found] == 0, per) == 0
        out: list[list] = [[], [], []]
        for values, store in zip(out, (self.of_a, self.of_b, self.written), strict=True):
            flat, size = store.take(found)
            raw, upto = memoryview(flat).cast("B"), np.cumsum(_sums(size, per)) * flat.itemsize
            values += [bytes(raw[lo:hi]) if g else b"" for lo, hi, g in zip([0, *upto[:-1].tolist()], upto.tolist(), good.tolist(), strict=True)]
        for k, (t, c) in enumerate(zip(texts, cut, strict=True)):
            if t and not c:
                (a, _), (b, _), (w, _) = self.whole([t], [self.a.whole(" " + t)])
                for values, x in zip(out, (a, b, w), strict=True):
                    values[k] = x.tobytes() if len(w) else b""
        return out[0], out[1], [hashlib.sha256(w[:-1]).hexdigest() if w else "" for w in out[2]]


class Aligned:
    """Texts side by side in one run of bytes; all marks are arrays over its byte offsets."""

    def __init__(self, of: Aligner, a: np.ndarray, b: np.ndarray, per_a: np.ndarray, per_b: np.ndarray):
        """Ids of all texts one after another, and how many there are of each."""
        self.of, self.docs, self.per_a, self.per_b = of, len(per_a), per_a, per_b
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        self.end_a, self.end_b = np.cumsum(of.bytes_a.size[self.a]), np.cumsum(of.bytes_b.size[self.b])
        n = int(self.end_a[-1]) if len(self.end_a) else 0
        self.is_a, self.is_b = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        self.is_a[self.end_a] = True
        self.is_b[self.end_b] = True
        self.common = self.is_a & self.is_b
        # where either ends, one pair of overlapping tokens ends: each pair shares one run of bytes without an end within
        self.links = np.flatnonzero(self.is_a | self.is_b)
        self.ended_a, self.ended_b = np.cumsum(self.is_a, dtype=np.int32), np.cumsum(self.is_b, dtype=np.int32)
        self.upto = np.concatenate([[0], self.end_a])[np.cumsum(self.per_a)]  # the bytes of the texts so far
        self.per_link = np.diff(np.searchsorted(self.links, self.upto, side="right"), prepend=0)

    @classmethod
    def of_bytes(cls, of: Aligner, a: list[bytes], b: list[bytes], kind: str = "<u4") -> Aligned:
        ids = [np.frombuffer(b"".join(side), kind) for side in (a, b)]
        return cls(of, *ids, *(np.array([len(x) // np.dtype(kind).itemsize for x in side], np.int64) for side in (a, b)))

    def ids(self) -> list[pa.Array]:
        """The ids by A and by B of each text as they are written."""
        out = []
        for flat, per in ((self.a, self.per_a), (self.b, self.per_b)):
            raw, upto = flat.astype(self.of.written_as).tobytes(), np.cumsum(per) * np.dtype(self.of.written_as).itemsize
            out.append(pa.array([raw[lo:hi] for lo, hi in zip([0, *upto[:-1].tolist()], upto.tolist(), strict=True)], pa.binary()))
        return out

    def n_groups(self) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(self.common), self.upto, side="right"), prepend=0)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and of B of every link, text by text."""
        return self.a[self.ended_a[self.links] - self.is_a[self.links]], self.b[self.ended_b[self.links] - self.is_b[self.links]]

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The written groups of all texts, each closed by ";", and their sizes by text."""
        at = np.flatnonzero(self.common)
        before = np.cumsum(self.common, dtype=np.int32)
        last_a, last_b = self.is_b[self.end_a], self.is_a[self.end_b]
        of_a, of_b = before[self.end_a] - last_a, before[self.end_b] - last_b
        upto_a, upto_b = self.ended_a[at], np.concatenate([[0], self.ended_b[at]])
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + upto_b[of_a]] = 2 * self.a + last_a
        codes[np.arange(len(self.b)) + (upto_a[of_b] if len(at) else 0)] = 2 * (self.of.n_a + self.b) + last_b
        flat, size = self.of.shown.take(codes)
        return flat, _sums(size, self.per_a + self.per_b)


def aligner(path_a: str, path_b: str) -> Aligner:
    return _ALIGNERS.get((path_a, path_b)) or _ALIGNERS.setdefault((path_a, path_b), Aligner(path_a, path_b))


# --- minimal perfect hash -----------------------------------------------------------------------------------------


def _mixed(key: np.ndarray, salt) -> np.ndarray:
    """A bijection of 64-bit keys for every salt."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.asarray(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


def slot_of(key: np.ndarray, slots: int) -> np.ndarray:
    return (_mixed(key, 1 << 20) % np.uint64(slots)).astype(np.int64)


def mph_levels(keys: np.ndarray, gamma: float = 2.0) -> list[np.ndarray]:
    """Bit arrays (uint64 words) of distinct keys: in each those keys of the rest that share their place with no other."""
    levels, rest = [], keys
    while len(rest):
        words = max(1, -(-int(gamma * len(rest)) // 64))
        at = (_mixed(rest, len(levels)) % np.uint64(64 * words)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * words) == 1
        levels.append(np.packbits(alone, bitorder="little").view("<u8"))
        rest = rest[~alone[at]]
    return levels


def _narrow(parts: list[np.ndarray]) -> np.ndarray:
    kind = np.uint32 if max((int(x.max(initial=0)) for x in parts), default=0) < 1 << 32 else np.int64
    return np.concatenate([x.astype(kind) for x in parts]) if parts else np.zeros(0, kind)


class Table:
    """Minimal perfect hashes of slots one after another, with the verified key and the value at each place."""

    def __init__(self, rows: list[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]], slots: int):
        """rows: (slot, levels, keys in hash order, values); slots that aren't given hold nothing."""
        deep = max((len(levels) for _, levels, _, _ in rows), default=0)
        self.slots, self.size, self.at = slots, np.zeros((slots, deep), np.uint64), np.zeros((slots, deep), np.int64)
        at, words = 0, []
        for s, levels, _, _ in rows:
            for k, w in enumerate(levels):
                self.size[s, k], self.at[s, k] = 64 * len(w), 64 * at
                words.append(w)
                at += len(w)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        # all set bits before a word; within a slot that is the hash, over slots their places follow each other
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.keys, self.values = (_narrow([r[k] for r in rows]) for k in (2, 3))

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Hashes, right for keys of the table and arbitrary for others (-1 or another key's)."""
        slot, out = slot_of(keys, self.slots), np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for k in range(self.size.shape[1]):
            size = self.size[slot[todo], k]
            todo, size = todo[size > 0], size[size > 0]
            if not len(todo):
                break
            at = self.at[slot[todo], k] + (_mixed(keys[todo], k) % size).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[todo[hit]] = self.before[at[hit] >> 6] + below
            todo = todo[~hit]
        return out

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values; 0 for keys that aren't in the table."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = self.place(keys)
        return np.where((at >= 0) & (self.keys[at] == keys), self.values[at], 0).astype(np.int64)


# --- passes -------------------------------------------------------------------------------------------------------

_SLOT = "slot int, part long, keys binary, counts binary"


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Like common.stored with zstd: ids are as large as the texts."""
    path = f"{work_dir(df.sparkSession, name)}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _runs(texts):
    """Slices (from, to) of a column of texts, some _PIECE characters together."""
    lo, held = 0, 0
    for i, n in enumerate(texts):
        held += n or 0
        if held >= _PIECE:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(np.concatenate(keys), return_inverse=True)
    return u, np.bincount(at, np.concatenate(counts), len(u)).astype(np.int64)


def _first_pass(path_a: str, path_b: str, slots: int, id_type: pa.DataType, flush: int):
    import pyarrow.compute as pc

    names = ["doc_row", "doc_id", "a", "b", "n_groups", "groups_sha256", "slot", "part", "keys", "counts"]

    def by_slot(part: int, keys: np.ndarray, counts: np.ndarray):
        s = slot_of(keys, slots)
        order = np.argsort(s, kind="stable")
        keys, counts, s = keys[order], counts[order], s[order]
        turn = np.concatenate([[0], np.flatnonzero(np.diff(s)) + 1, [len(s)]])
        rows = [(int(s[i]), keys[i:j].astype("<i8").tobytes(), counts[i:j].astype("<i8").tobytes()) for i, j in zip(turn[:-1], turn[1:], strict=True) if j > i]
        for lo in range(0, len(rows), 256):
            some = rows[lo : lo + 256]
            none = [pa.nulls(len(some), t) for t in (pa.int64(), id_type, pa.binary(), pa.binary(), pa.int64(), pa.string())]
            slot, k, c = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([*none, pa.array(slot, pa.int32()), pa.array([part] * len(some), pa.int64()), pa.array(k, pa.binary()), pa.array(c, pa.binary())], names=names)

    def run(batches):
        from pyspark import TaskContext

        part, of, row = TaskContext.get().partitionId(), aligner(path_a, path_b), 0
        held: tuple[list, list] = ([], [])
        wait = 0
        for batch in batches:
            for lo, hi in _runs(pc.utf8_length(batch.column(1)).to_pylist()):
                a, b, digests = of.encode(batch.column(1).slice(lo, hi - lo).to_pylist())
                got = Aligned.of_bytes(of, a, b)
                x, y = got.pairs()
                text = np.repeat(np.arange(got.docs), got.per_link)
                own = np.unique((text << 40) | (x * of.n_b + y)) & ((1 << 40) - 1)  # a text's pairs, once each
                u, n = np.unique(own, return_counts=True)
                held[0].append(u)
                held[1].append(n)
                wait += len(u)
                ids = got.ids()
                rows = pa.array(np.arange(row, row + hi - lo) + (part << 40))
                row += hi - lo
                none = [pa.nulls(hi - lo, t) for t in (pa.int32(), pa.int64(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([rows, batch.column(0).slice(lo, hi - lo), *ids, pa.array(got.n_groups(), pa.int64()), pa.array(digests, pa.string()), *none], names=names)
                if wait >= flush:
                    u, n = _summed(*held)
                    if 2 * len(u) >= flush:
                        yield from by_slot(part, u, n)
                        held, wait = ([], []), 0
                    else:
                        held, wait = ([u], [n]), len(u)
        if wait:
            yield from by_slot(part, *_summed(*held))

    return run


def _joined(t: pa.Table, column: str) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in t.column(column).to_pylist() if x is not None), "<i8")


def _hashes(parts: DataFrame, last: int, fan: int, slots: int) -> DataFrame:
    """(slot, sizes, words, keys): the levels of each slot's perfect hash and its keys in hash order."""

    def union(key: tuple, t: pa.Table) -> pa.Table:
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "keys": pa.array([np.unique(_joined(t, "keys")).tobytes()], pa.binary())})

    def build(key: tuple, t: pa.Table) -> pa.Table:
        s, keys = key[0].as_py(), np.unique(_joined(t, "keys"))
        levels = mph_levels(keys)
        placed = np.empty_like(keys)
        placed[Table([(s, levels, keys, keys)], slots).place(keys)] = keys
        return pa.table({"slot": pa.array([s], pa.int32()), "sizes": pa.array([[len(w) for w in levels]], pa.list_(pa.int64())), "words": pa.array([b"".join(w.tobytes() for w in levels)], pa.binary()), "keys": pa.array([placed.tobytes()], pa.binary())})

    keys = parts.select("slot", "part", "keys")
    while last >= fan:
        keys = keys.withColumn("part", F.floor(F.col("part") / fan)).groupBy("slot", "part").applyInArrow(union, "slot int, part long, keys binary")
        last //= fan
    return keys.groupBy("slot").applyInArrow(build, "slot int, sizes array<bigint>, words binary, keys binary")


def _counts(parts: DataFrame, hashes: DataFrame, last: int, fan: int, slots: int) -> DataFrame:
    """(slot, counts): each slot's documents per pair as a dense vector over the hash, summed in a tree."""
    schema = "slot int, part long, counts binary"

    def dense(key: tuple, some: pa.Table, hashed: pa.Table) -> pa.Table:
        if not len(some):
            return pa.table({"slot": pa.array([], pa.int32()), "part": pa.array([], pa.int64()), "counts": pa.array([], pa.binary())})
        table = Table([_entry(r, "keys") for r in hashed.to_pylist()], slots)
        total = np.bincount(table.place(_joined(some, "keys")), _joined(some, "counts"), len(table.keys)).astype("<i8")
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    def add(key: tuple, t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i8") for x in t.column("counts").to_pylist())
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    leaves = parts.select("slot", F.floor(F.col("part") / fan).alias("part"), "keys", "counts")
    nodes = leaves.select(F.col("slot").alias("_s"), F.col("part").alias("node")).distinct()
    tables = hashes.join(nodes, F.col("slot") == F.col("_s")).drop("_s")
    out = leaves.groupBy("slot", "part").cogroup(tables.groupBy("slot", "node")).applyInArrow(dense, schema)
    last //= fan
    while last:
        out = out.withColumn("part", F.floor(F.col("part") / fan)).groupBy("slot", "part").applyInArrow(add, schema)
        last //= fan
    return out.select("slot", "counts")


def _entry(r: dict, value: str) -> tuple[int, list[np.ndarray], np.ndarray, np.ndarray]:
    words = np.frombuffer(r["words"], "<u8")
    return r["slot"], np.split(words, np.cumsum(r["sizes"])[:-1]), np.frombuffer(r["keys"], "<i8"), np.frombuffer(r[value], "<i8")


def _second_pass(path_a: str, path_b: str, table, best):
    import pyarrow.compute as pc

    names = ["doc_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches):
        of = aligner(path_a, path_b)
        of.forget()
        for batch in batches:
            for lo, hi in _runs(pc.binary_length(batch.column(2)).to_pylist()):
                some = batch.slice(lo, hi - lo)
                got = Aligned.of_bytes(of, *(some.column(k).to_pylist() for k in (2, 3)), of.written_as)
                x, y = got.pairs()
                count = table.value.get(x * of.n_b + y)
                sums = [pa.array(_sums(v, got.per_link), pa.int64()) for v in ((count > 0) & (count == best.value[x]), count)]
                own = [pa.array(c, pa.int64()) for c in (got.per_a, got.per_b, got.per_link)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *own[:2], some.column(4), own[2], *sums, some.column(5)], names=names)

    return run


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", slots: int = 512, fan: int = 64, flush: int = 1 << 22, round_bytes: int = 64 << 20) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; doc_row tells repeated ids apart."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark: SparkSession = docs.sparkSession
    src = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = src.schema["doc_id"].dataType
    first = _first_pass(path_a, path_b, slots, to_arrow_type(kind), flush)
    passed = _kept(src.mapInArrow(first, f"doc_row long, doc_id {kind.simpleString()}, a binary, b binary, n_groups long, groups_sha256 string, {_SLOT}"), "aligned")
    ids, parts = passed.where("slot is null").select("doc_row", "doc_id", "a", "b", "n_groups", "groups_sha256"), passed.where("slot is not null").select("slot", "part", "keys", "counts")
    last = parts.agg(F.max("part")).first()[0] or 0
    hashes = _kept(_hashes(parts, last, fan, slots), "hashes")
    counts = _counts(parts, hashes, last, fan, slots).withColumnRenamed("slot", "_s")
    table = _kept(hashes.join(counts, F.col("slot") == F.col("_s")).drop("_s"), "counts")
    of = aligner(path_a, path_b)

    def highest(batches):
        for b in batches:
            for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                a, n = np.frombuffer(k, "<i8") // n_b, np.frombuffer(n, "<i8")
                order = np.argsort(a, kind="stable")
                turn = np.flatnonzero(np.diff(a[order], prepend=-1))
                yield pa.RecordBatch.from_arrays([pa.array(a[order][turn]), pa.array(np.maximum.reduceat(n[order], turn))], names=["a", "n"])

    n_b, best = of.n_b, np.zeros(of.n_a, np.int64)
    for r in table.select("keys", "counts").mapInArrow(highest, "a bigint, n bigint").groupBy("a").agg(F.max("n").alias("n")).collect():  # at most a row an id
        best[r.a] = r.n
    best_b = spark.sparkContext.broadcast(best)
    rounds: list[list[int]] = [[]]
    held = 0
    for r in table.select("slot", (F.octet_length("words") + F.octet_length("keys") + F.octet_length("counts")).alias("n")).orderBy("slot").collect():  # at most a row a slot
        if held + r.n > round_bytes and rounds[-1]:
            rounds.append([])
            held = 0
        rounds[-1].append(r.slot)
        held += r.n
    schema = f"doc_row long, doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    done = []
    for some in rounds:
        rows = table.where(F.col("slot").isin(some)).select("slot", "sizes", "words", "keys", "counts")
        shared = spark.sparkContext.broadcast(Table([_entry(r.asDict(), "counts") for r in rows.toLocalIterator()], slots))
        out = ids.mapInArrow(_second_pass(path_a, path_b, shared, best_b), schema)
        done.append(out if len(rounds) == 1 else _kept(out, "round"))
        if len(rounds) > 1:
            shared.destroy()
    if len(rounds) == 1:
        return done[0]
    every = done[0]
    for more in done[1:]:
        every = every.union(more)
    total = every.groupBy("doc_row").agg(*[F.any_value("doc_id", True).alias("doc_id")], *[F.max(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")], *[F.sum(c).alias(c) for c in ("n_best", "count_sum")], F.max("groups_sha256").alias("groups_sha256"))
    return total.select(*[f.split()[0] for f in schema.split(", ")])
