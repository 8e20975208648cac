"""Packing documents into fixed windows: bounded-space online best fit.

Each partition tokenizes its documents and keeps ``open_windows`` open windows. A document of a window or more
first fills whole windows; the rest goes to the open window where it leaves the least room. When it fits nowhere
the fullest window is emitted: if its room is at least ``least_cut`` tokens the document's head fills it up first
(documents may be cut), then the rest looks again and opens a window if need be. Windows still open at the end of
a partition are leftovers: their (window, length) pairs are dealt to ever fewer partitions and merged there by best
fit, ``merge_factor`` groups into one; of each group only the ``open_windows`` emptiest go on, so every merge is
bounded.

Ids: the given tokenizer's without special tokens, then id 0 at the document's end. Texts are encoded in pieces cut
before every space that is followed by a non-space, which is always a border of the byte-level pre-tokenizer, and
pieces are kept in a bounded dictionary of the worker; texts with unusual white space, and all texts where the file's
pre-tokenizer is another, go to the tokenizer whole.

Defined results: null and empty texts are the single id 0. Repeated rows and null ids are packed one by one. With
no documents there are no pieces. Only ids of one batch of texts and of the open windows are in memory.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairopanel.llm.common import kept, stored

END = 0
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_OWN = np.r_[33:127, 161:173, 174:256]
#: Letters of a byte-level vocabulary by byte: printable Latin-1 stands for itself, other bytes for 256, 257, ...; here a new line parts runs.
_LEVEL = np.zeros(256, "<u4")
_LEVEL[_OWN], _LEVEL[np.setdiff1d(np.arange(256), _OWN)] = _OWN, 256 + np.arange(256 - len(_OWN))
_LEVEL[10] = 32
_ODD = re.compile(r" \s|[^\S ] | $|[\x1c-\x1f\x85᠎​]|<\|")


def _odd(t: str) -> bool:
    """Whether the text may have borders that its pieces don't show; printable characters have no white space but the space."""
    if "  " in t or t[-1] == " " or " \n" in t or "\n " in t or "<|" in t:
        return True
    return not t.replace("\n", "").isprintable() and bool(_ODD.search(t))


def _lines(t: str) -> bool:
    """Whether new lines stand apart from other white space: then each is a run of its own, and what follows it is a piece, too."""
    return "\n" in t and "\n\n" not in t and t.replace("\n", "").isprintable()


class Encoder:
    """Ids of texts as little-endian uint32 bytes, all by the tokenizer file, with bounded dictionaries of pieces.

    New pieces are encoded many at once, as one line, which is cut again where a token begins with a piece's space (after
    a new line: by the tokens' offsets). Words of letters only are one run of the pre-tokenizer, so they go to the file's
    merges at once; marks behind them are a run of their own.
    """

    def __init__(self, path: str, most: int = 400_000):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocab = self.tokenizer.get_vocab()
        self.plain = self.plain and "Ġ" in vocab
        self.spaced = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.spaced[[i for x, i in vocab.items() if x.startswith("Ġ")]] = True
        self.merges = Tokenizer(self.tokenizer.model)  # the same model; runs come in the vocabulary's letters, apart by spaces
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.newline = self.whole("\n")
        self.marks: dict[str, bytes] = {}
        self.known: dict[str, dict[str, bytes]] = {"\n": {}, " ": {}}  # by what stands before the piece; heads of texts after a new line

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def mark(self, run: str) -> bytes:
        if len(self.marks) >= 4096:
            self.marks.clear()
        return self.marks.get(run) or self.marks.setdefault(run, self.whole(run))

    def learn(self, lead: str, pieces: set[str]) -> None:
        """Encodes pieces that come after ``lead``; a head's own tokens are those behind the new line.

        A piece that begins with a new line has that one before it instead of a space.
        """
        known = self.known[lead]
        if len(known) + len(pieces) > self.most:
            known.clear()
        if lead == "\n":  # heads with white space at their ends would run into each other's new lines
            line = [x for x in pieces if x and not x[0].isspace() and not x[-1].isspace()]
            known.update((x, self.whole(x)) for x in pieces.difference(line))
            return self._line(lead, line)
        letters, ended, rest, heads = [], [], [], []
        for x in pieces:
            if (x[1:] if x[:1] == "\n" else x).isalpha():
                letters.append(x)
                continue
            stem = x.rstrip(_MARKS)
            if (stem[1:] if stem[:1] == "\n" else stem).isalpha():
                ended.append((x, stem))
            else:
                (heads if x[:1] == "\n" else rest).append(x)
        letters.extend({stem for _, stem in ended}.difference(known, letters))
        for lo in range(0, len(letters), 512):
            some = letters[lo : lo + 512]
            line = _LEVEL[np.frombuffer((" " + "\n ".join(some)).encode(), np.uint8)].tobytes().decode("utf-32-le")
            known.update(zip(some, self._cut(self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids), strict=True))
        known.update((x, self.newline + known[x][4:]) for x in letters if x[0] == "\n")  # what was cut there is a bare space
        known.update((x, known[stem] + self.mark(x[len(stem) :])) for x, stem in ended)
        self._line(lead, rest)
        if heads:
            self.learn("\n", {x[1:] for x in heads})
            known.update((x, self.newline + self.known["\n"][x[1:]]) for x in heads)

    def _cut(self, ids: list[int]) -> list[bytes]:
        """The ids of each piece of a line; no piece has a space within, so a token that begins with one begins a piece."""
        ids = np.array(ids, "<u4")
        turn, raw = [*(4 * np.flatnonzero(self.spaced[ids])).tolist(), 4 * len(ids)], ids.tobytes()
        return [raw[i:j] for i, j in pairwise(turn)]

    def _line(self, lead: str, line: list[str]) -> None:
        known = self.known[lead]
        for lo in range(0, len(line), 512):
            some = line[lo : lo + 512]
            text = lead + lead.join(some)
            if lead == " ":
                known.update(zip(some, self._cut(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids), strict=True))
                continue
            got = self.tokenizer.encode(text, add_special_tokens=False)
            ids = np.array(got.ids, "<u4")
            at, sizes = np.array(got.offsets, np.int64)[:, 0], np.array([len(x) + 1 for x in some])
            starts = np.cumsum(sizes) - sizes
            turn, ends = np.searchsorted(at, starts + 1), np.append(np.searchsorted(at, starts[1:]), len(ids))
            raw = ids.tobytes()
            known.update(zip(some, (raw[4 * i : 4 * j] for i, j in zip(turn.tolist(), ends.tolist(), strict=True)), strict=True))

    def encode(self, texts: list[str | None], end: int = END) -> list[bytes]:
        stop = np.array([end], "<u4").tobytes()
        cut = [(t.replace("\n", " \n") if _lines(t) else t).split(" ") if t and self.plain and not _odd(t) else None for t in texts]
        heads, spaced = [c.pop(0) if c else "" for c in cut], set()
        for c in cut:
            if c:
                spaced.update(c)
        for lead, some in ((" ", spaced), ("\n", {h for h, c in zip(heads, cut, strict=True) if c is not None})):
            new = some.difference(self.known[lead])
            self.learn(lead, some if len(self.known[lead]) + len(new) > self.most else new)
        first, get = self.known["\n"], self.known[" "].__getitem__
        return [((self.whole(t) if t else b"") if c is None else first[h] + b"".join(map(get, c))) + stop for t, h, c in zip(texts, heads, cut, strict=True)]


class Open:
    """Open windows by room left; a window is (room, number)."""

    def __init__(self, width: int, most: int):
        self.width, self.most = width, most
        self.by_room: list[tuple[int, int]] = []

    def fit(self, n: int) -> tuple[int, int] | None:
        """Takes out the window with the least room that holds n."""
        at = bisect_left(self.by_room, (n, -1))
        return self.by_room.pop(at) if at < len(self.by_room) else None

    def fullest(self) -> tuple[int, int]:
        return self.by_room.pop(0)

    def put(self, window: tuple[int, int]) -> None:
        insort(self.by_room, window)


def _best_fit(items: list[int], width: int, most: int) -> list[tuple[int, int]]:
    """(window, offset) of each item, none cut: best fit with at most ``most`` open windows."""
    space, n, out = Open(width, most), 0, []
    for k in items:
        got = space.fit(k)
        if got is None:
            if len(space.by_room) >= most:
                space.fullest()
            got, n = (width, n), n + 1
        out.append((got[1], width - got[0]))
        if got[0] > k:
            space.put((got[0] - k, got[1]))
    return out


PIECES = "doc_id {id}, doc_row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, window bigint, offset bigint, leftover boolean"


def _pieces(tokenizer_path: str, width: int, open_windows: int, least_cut: int, id_type: pa.DataType):
    names = ["doc_id", "doc_row", "start", "length", "ids_crc32", "doc_tokens", "part", "window", "offset", "leftover"]

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, space = kept(("encoder", tokenizer_path), lambda: Encoder(tokenizer_path)), Open(width, open_windows)
        held: dict[int, list[tuple]] = {}
        windows = rows = 0
        done: list[tuple] = []

        def close(w: int) -> None:
            done.extend((*p, w, False) for p in held.pop(w))

        def out():
            cols = list(zip(*done, strict=True))
            doc, row, start, length, crc, total, offset, window, left = cols
            arrays = [pa.array(doc, id_type), *(pa.array(c, pa.int64()) for c in (row, start, length, crc, total)), pa.array([part] * len(doc), pa.int32()), pa.array(window, pa.int64()), pa.array(offset, pa.int64()), pa.array(left, pa.bool_())]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                some = b.slice(lo, 256)
                for doc, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist()), strict=True):
                    n, at, rows = len(ids) // 4, 0, rows + 1

                    def piece(size: int, offset: int) -> tuple:
                        return (doc, rows, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)]), n, offset)  # noqa: B023

                    while at < n:
                        rest = n - at
                        if rest >= width:
                            done.append((*piece(width, 0), windows, False))
                            windows, at = windows + 1, at + width
                            continue
                        got = space.fit(rest)
                        if got is None and len(space.by_room) >= open_windows:
                            room, w = space.fullest()
                            if room >= least_cut:
                                held[w].append(piece(room, width - room))
                                at += room
                            close(w)
                            continue
                        if got is None:
                            got, windows = (width, windows), windows + 1
                            held[got[1]] = []
                        room, w = got
                        held[w].append(piece(rest, width - room))
                        at = n
                        if room > rest:
                            space.put((room - rest, w))
                        else:
                            close(w)
            if done:
                yield out()
        for w in list(held):
            done.extend((*p, w, True) for p in held.pop(w))
        if done:
            yield out()

    return run


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", width: int = 1024, open_windows: int = 64, least_cut: int = 16, merge_factor: int = 16) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; doc_row tells repeated ids apart."""
    src = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    id_type = src.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    run = _pieces(tokenizer_path, width, open_windows, least_cut, to_arrow_type(id_type))
    pieces = stored(src.mapInArrow(run, PIECES.format(id=id_type.simpleString())), "pieces")
    # leftovers: (part, window) with its length so far; merging only moves these
    left = pieces.where("leftover").groupBy("part", "window").agg(F.sum("length").alias("n"))
    left = left.select("part", "window", "n", F.lit(0).cast("long").alias("shift"), F.struct("part", "window").alias("into"), F.col("part").alias("group"))
    groups, placed = pieces.where("leftover").agg(F.max("part")).first()[0], left.limit(0)
    while groups is not None:
        merged = stored(_merged(left, width, open_windows, merge_factor), "leftovers")
        groups = groups // merge_factor if groups >= merge_factor else None
        placed = placed.union(merged.where("done" if groups is not None else "true").drop("done"))
        left = merged.where("not done").drop("done")
    seq = lambda part, window: part.cast("long") * F.lit(1 << 40) + window
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    row = (F.col("part").cast("long") * F.lit(1 << 40) + F.col("doc_row")).alias("doc_row")
    full = pieces.where("not leftover").select(*names, seq(F.col("part"), F.col("window")).alias("sequence_id"), "offset", row)
    moved = placed.select(F.col("part").alias("_p"), F.col("window").alias("_w"), "shift", "into")
    rest = pieces.where("leftover").join(moved, (F.col("part") == F.col("_p")) & (F.col("window") == F.col("_w")))
    rest = rest.select(*names, seq(F.col("into.part"), F.col("into.window")).alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"), row)
    return full.union(rest)


def _merged(left: DataFrame, width: int, keep: int, factor: int) -> DataFrame:
    """Merges the open windows of ``factor`` neighbouring groups by best fit; all but the ``keep`` emptiest are done.

    left: part, window, n (tokens of the window it is in now), shift (its place there), into (that window), group.
    """
    import pandas as pd

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        heads = pdf.drop_duplicates(["into_part", "into_window"]).sort_values(["n", "into_part", "into_window"], ascending=[False, True, True], ignore_index=True)
        names = list(zip(heads["into_part"], heads["into_window"], strict=True))
        spots = _best_fit(heads["n"].tolist(), width, len(heads))
        first: dict[int, tuple[int, int]] = {}
        total: dict[int, int] = {}
        for name, n, (to, _) in zip(names, heads["n"], spots, strict=True):
            first.setdefault(to, name)
            total[to] = total.get(to, 0) + n
        still = set(sorted(total, key=lambda w: (total[w], first[w]))[:keep])
        new = {name: (*first[to], offset, total[to], to not in still) for name, (to, offset) in zip(names, spots, strict=True)}
        got = [new[k] for k in zip(pdf["into_part"], pdf["into_window"], strict=True)]
        shift = [s + g[2] for s, g in zip(pdf["shift"], got, strict=True)]
        return pdf.assign(into_part=[g[0] for g in got], into_window=[g[1] for g in got], shift=shift, n=[g[3] for g in got], done=[g[4] for g in got], group=pdf["g"]).drop(columns="g")

    flat = left.select("part", "window", "n", "shift", F.col("into.part").alias("into_part"), F.col("into.window").alias("into_window"), "group", F.floor(F.col("group") / factor).cast("int").alias("g"))
    out = flat.groupBy("g").applyInPandas(merge, "part int, window bigint, n bigint, shift bigint, into_part int, into_window bigint, group int, done boolean")
    return out.select("part", "window", "n", "shift", F.struct(F.col("into_part").alias("part"), F.col("into_window").alias("window")).alias("into"), "group", "done")
