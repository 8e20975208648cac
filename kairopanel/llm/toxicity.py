"""Toxicity by Levenshtein automata over a lexicon trie, with context-window scores.

The lexicon is learned from labelled texts: word beginnings (a whole word ends in an end mark, a longer family of words
in a stem) that are far more frequent in toxic than in clean texts, as a trie. A word within the edits that a term's
length allows is a misspelling of it. All terms' Levenshtein automata run over the trie at once: a state is the set of
(trie node, edits so far) that a word's letters can have reached; states and steps are made when first met and kept in
a table, through which all words of many texts move together, a letter at a time. How much an exact hit or a misspelt
one tells is measured on the labelled texts as well, so words that merely look like a term don't count.

Each hit has a window of words and quotation marks around it. What stands there in toxic and in clean labelled texts
gives the probability that the hit is abuse and not quotation; a logistic model of the abusive and the quoting weight
of a text, absolute and by length, gives its score. Its training texts are others than those of its lexicon.

Bounds: at most ``most_toxic`` and ``most_clean`` labelled rows are learned from, chosen by hashed id; the lexicon has
at most ``most_terms`` entries, the context ``most_context``. Everything else covers whole texts of all documents.

Defined results: null and empty texts have no hits and the score of such texts. A label counts once an id, the highest
of several; null labels and ids teach nothing. Without toxic or without clean labelled texts every score is the share
of toxic labels (0 without labels). Repeated rows are scored one by one. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kairopanel.llm.common import stored

END = "\0"  # after a whole word
_PIECE = 1 << 20
_QUOTES = '"“”„«»‟'
_CLASS: dict = {}


def edits_allowed(term: str) -> int:
    """Whole words: one edit from 5 letters, two from 9; stems, which any ending may follow: one from 7."""
    n = len(term.rstrip(END))
    return (n >= 5) + (n >= 9) if term.endswith(END) else int(n >= 7)


@dataclass
class Lexicon:
    """terms: beginnings, END after whole words; weights: of an exact and of a misspelt hit."""

    terms: list[str]
    weights: np.ndarray = None
    fuzzy: bool = True

    def __post_init__(self):
        if self.weights is None:
            self.weights = np.ones((len(self.terms), 2))


class Automaton:
    """Deterministic steps of the trie's Levenshtein automata, made on demand.

    A state: edits by trie node and the best stem that has ended, (edits, -weight, term). table[state, letter class] is
    the next state, -1 if not made yet; state 0 is dead; ``hit[state]`` is 2 * term + (misspelt) at a word's end, -1
    for none; ``over[state]``: nothing that follows changes the hit.
    """

    def __init__(self, lexicon: Lexicon, most: int = 50_000):
        self.lexicon, self.most = lexicon, most
        self.next: list[dict[str, int]] = [{}]
        self.end: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.budget: list[int] = [0]
        for k, term in enumerate(lexicon.terms):
            allowed = edits_allowed(term) if lexicon.fuzzy and lexicon.weights[k, 1] > 0 else 0
            at = 0
            self.budget[0] = max(self.budget[0], allowed)
            for c in term.rstrip(END):
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.end.append(-1)
                    self.stem.append(-1)
                    self.budget.append(0)
                at = self.next[at][c]
                self.budget[at] = max(self.budget[at], allowed)
            (self.end if term.endswith(END) else self.stem)[at] = k
        self.allowed = [edits_allowed(t) if lexicon.fuzzy and lexicon.weights[k, 1] > 0 else 0 for k, t in enumerate(lexicon.terms)]
        self.letters = {c: i + 1 for i, c in enumerate(sorted({c for t in lexicon.terms for c in t.rstrip(END)}))}
        self.names = [None, *self.letters]
        self.reset()

    def reset(self) -> None:
        self.states: dict = {}
        self.table = np.full((64, len(self.names)), -1, np.int32)
        self.hit, self.over, self.sets = np.full(64, -1, np.int32), np.zeros(64, bool), []
        self.number((), None)
        self.table[0] = 0
        self.start = self.number(self.closed({0: 0}), None)

    def closed(self, at: dict[int, int]) -> tuple:
        """With letters of the term left out; edits by node."""
        todo = list(at)
        while todo:
            n = todo.pop()
            for m in self.next[n].values():
                e = at[n] + 1
                if e <= self.budget[m] and e < at.get(m, 9):
                    at[m] = e
                    todo.append(m)
        return tuple(sorted(at.items()))

    def number(self, nodes: tuple, best: tuple | None) -> int:
        got = self.states.get((nodes, best))
        if got is None:
            got = self.states[nodes, best] = len(self.sets)
            if got == len(self.hit):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.hit, self.over = np.concatenate([self.hit, np.full_like(self.hit, -1)]), np.concatenate([self.over, np.zeros_like(self.over)])
            self.sets.append((nodes, best))
            ends = [(e, -self.lexicon.weights[k, min(e, 1)], k) for n, e in nodes if (k := self.end[n]) >= 0 and e <= self.allowed[k]]
            if top := min([*ends, *([best] if best else [])], default=None):
                self.hit[got] = 2 * top[2] + (top[0] > 0)
            self.over[got] = not nodes
            if not nodes:
                self.table[got] = got
        return got

    def step(self, state: int, letter: int) -> int:
        nodes, best = self.sets[state]
        c, at = self.names[letter], {}

        def reach(n: int, e: int) -> None:
            if e <= self.budget[n] and e < at.get(n, 9):
                at[n] = e

        for n, e in nodes:
            for d, m in self.next[n].items():
                reach(m, e + (d != c))
            reach(n, e + 1)  # a letter too many
        nodes = self.closed(at)
        stems = [(e, -self.lexicon.weights[k, min(e, 1)], k) for n, e in nodes if (k := self.stem[n]) >= 0 and e <= self.allowed[k]]
        best = min([*stems, *([best] if best else [])], default=None)
        if best and best[0] == 0:  # nothing beats an exact stem but a heavier exact term
            nodes = tuple((n, e) for n, e in nodes if e == 0)
        got = self.number(nodes, best)
        self.table[state, letter] = got
        return got

    def run(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hits (or -1) of words given as places in an array of letter classes."""
        if len(self.sets) > self.most:
            self.reset()
        out, live, state = np.full(len(start), -1, np.int32), np.arange(len(start)), np.full(len(start), self.start, np.int32)
        j = 0
        while len(live):
            c = letters[start[live] + j]
            new = self.table[state, c]
            if (unmade := np.flatnonzero(new < 0)).size:
                for key in np.unique(state[unmade].astype(np.int64) << 16 | c[unmade]).tolist():
                    self.step(key >> 16, key & 0xFFFF)
                new = self.table[state, c]
            j += 1
            done = (size[live] == j) | self.over[new]
            out[live[done]] = self.hit[new[done]]
            live, state = live[~done], new[~done]
        return out


def _classes() -> np.ndarray:
    """Whether a code point is a letter or digit."""
    if "word" not in _CLASS:
        _CLASS["word"] = np.array([chr(i).isalnum() for i in range(0x110000)])
    return _CLASS["word"]


class Scanner:
    """Words, hits and their windows of many texts at once."""

    def __init__(self, lexicon: Lexicon, window: int = 6):
        self.automaton, self.window = Automaton(lexicon), window
        self.letter = np.zeros(0x110000, np.uint16)
        for c, k in self.automaton.letters.items():
            self.letter[ord(c)] = k

    def scan(self, texts: list[str | None]):
        """(words of each text, hit codes, text of each hit, function from a hit's place in them to its context)."""
        low = " ".join((t or "").lower() for t in texts) + " "
        point = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        word = _classes()[point]
        turn = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            turn = np.append(0, turn)
        start, size = turn[::2], turn[1::2] - turn[::2]
        ends = np.cumsum([len((t or "").lower()) + 1 for t in texts])
        upto = np.searchsorted(start, ends)
        per = np.diff(upto, prepend=0)
        hit = self.automaton.run(self.letter[point], start, size)
        at = np.flatnonzero(hit >= 0)
        of = np.searchsorted(upto, at, side="right")
        first = upto - per

        def context(k: int) -> set[str]:
            i, lo, hi = int(at[k]), int(first[of[k]]), int(upto[of[k]])
            a, b = max(lo, i - self.window), min(hi, i + self.window + 1)
            got = {low[start[m] : start[m] + size[m]] for m in range(a, b) if m != i}
            before, after = low[start[a] - 1 if start[a] else 0 : start[i]], low[start[i] + size[i] : start[b - 1] + size[b - 1] + 1]
            if any(q in before for q in _QUOTES) and any(q in after for q in _QUOTES):
                got.add(_QUOTES)
            return got

        return per, hit[at], of, context


def _slices(column) -> list[list[str | None]]:
    lo, held = 0, 0
    for i, n in enumerate(pc.utf8_length(column).to_pylist()):
        held += n or 0
        if held >= _PIECE or i + 1 == len(column):
            yield column.slice(lo, i + 1 - lo).to_pylist()
            lo, held = i + 1, 0


@dataclass
class Model:
    lexicon: Lexicon
    context: dict[str, float] = field(default_factory=dict)
    prior: float = 0.0  # of a hit, before its context
    weights: np.ndarray = None
    window: int = 6

    def features(self, scanner: Scanner, texts: list[str | None]) -> np.ndarray:
        """One row a text: 1, abusive weight absolute, by length and of the best hit, quoting weight."""
        per, hits, of, context = scanner.scan(texts)
        weight = self.lexicon.weights.reshape(-1)[hits]
        logit = np.full(len(hits), self.prior)
        if self.context:
            logit += [sum(self.context.get(w, 0.0) for w in context(k)) for k in range(len(hits))]
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        abuse, quote, most = (np.zeros(len(texts)) for _ in range(3))
        np.add.at(abuse, of, weight * q)
        np.add.at(quote, of, weight * (1 - q))
        np.maximum.at(most, of, weight * q)
        return np.column_stack([np.ones(len(texts)), np.log1p(abuse), np.log1p(1000 * abuse / np.maximum(per, 1)), most, np.log1p(quote)])


# --- training -----------------------------------------------------------------------------------------------------


def sample(docs: DataFrame, labels: DataFrame, most_toxic: int = 4096, most_clean: int = 8192, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> tuple[DataFrame, list[int]]:
    """(toxic, fold, text) of at most so many labelled rows, equal texts once, and the numbers of clean and toxic labels.

    Chosen by hashed id, ids before texts, so any partitioning gives the same rows.
    """
    cells = 64
    ids = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg((F.max(toxic) > 0).cast("int").alias("toxic"))
    ids = ids.join(docs.select(docs[doc_id].alias("_id")).distinct(), "_id", "left_semi").withColumn("h", F.xxhash64("_id"))
    ids = stored(ids, "labelled")
    n = {r.toxic: r.n for r in ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.row_number().over(W.partitionBy("toxic", F.pmod("h", F.lit(cells))).orderBy("h", "_id"))
    ids = ids.withColumn("n", place).where(F.col("n") <= F.when(F.col("toxic") == 1, max(1, most_toxic // cells)).otherwise(max(1, most_clean // cells)))
    rows = docs.select(docs[doc_id].alias("_id"), docs[text].alias("text")).join(F.broadcast(ids.select("_id", "toxic", "h")), "_id")  # at most the rows of the sample
    rows = rows.groupBy(F.xxhash64("text").alias("_t"), "toxic").agg(F.min("text").alias("text"))
    return stored(rows.select("toxic", F.pmod("_t", F.lit(3)).cast("int").alias("fold"), "text"), "sample"), [n.get(0, 0), n.get(1, 0)]


def _beginnings(rows: DataFrame, longest: int, shortest: int = 3, flush: int = 1 << 20) -> DataFrame:
    """(beginning, toxic, clean): numbers of texts with a word that begins so; whole words end in END."""

    def run(batches):
        word = _classes()
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def out():
            keys = list(held[0].keys() | held[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([held[1][k] for k in keys], pa.int64()), pa.array([held[0][k] for k in keys], pa.int64())], names=["beginning", "toxic", "clean"])
            for c in held:
                c.clear()

        for b in batches:
            for k in range(b.num_rows):
                toxic, text = b.column(0)[k].as_py(), (b.column(1)[k].as_py() or "").lower()
                point = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                words = "".join(c if w else " " for c, w in zip(text, word[point].tolist(), strict=True)).split()
                got = set()
                for w in set(words):
                    w = w[:longest] if len(w) > longest else w + END
                    got.update(w[:n] for n in range(shortest, len(w) + 1))
                held[toxic].update(got)
                if len(held[0]) + len(held[1]) > flush:
                    yield from out()
        yield from out()

    parts = rows.select("toxic", "text").mapInArrow(run, "beginning string, toxic long, clean long")
    return parts.groupBy("beginning").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_terms(rows: DataFrame, n: list[int], most_terms: int = 2000, least_ratio: float = 20.0, least_docs: int = 4, least_share: float = 0.004, longest: int = 16) -> Lexicon:
    """The shortest beginnings that are ``least_ratio`` times as frequent in toxic texts, drawn out while nearly all their
    words go on alike. n: clean and toxic texts in rows."""
    least = max(least_docs, least_share * n[1])
    ratio = (F.col("toxic") + 0.5) / (n[1] + 1) / ((F.col("clean") + 0.5) / (n[0] + 1))
    good = _beginnings(rows, longest).where((F.col("toxic") >= least) & (ratio >= least_ratio))
    got = {r.beginning: r.toxic for r in good.orderBy(F.desc("toxic"), "beginning").limit(20 * most_terms).collect()}
    children: dict[str, list[str]] = defaultdict(list)
    for w in got:
        children[w[:-1]].append(w)
    terms = []
    for w in sorted(got, key=lambda w: (-got[w], w)):
        if w[:-1] in got:
            continue
        while nearly := [c for c in children[w] if got[c] >= 0.9 * got[w]]:
            w = nearly[0]
        terms.append(w)
    return Lexicon(terms[:most_terms])


def weigh(rows: DataFrame, lexicon: Lexicon, n: list[int], most_context: int = 2000, window: int = 6) -> Model:
    """Weights of exact and misspelt hits, then of what stands around the hits that count."""

    def hits(batches):
        scanner = Scanner(lexicon, window)
        total = np.zeros((2, 2 * len(lexicon.terms)), np.int64)
        for b in batches:
            lo = 0
            for texts in _slices(b.column(1)):
                y = np.array(b.column(0).slice(lo, len(texts)).to_pylist())
                lo += len(texts)
                _, hit, of, _ = scanner.scan(texts)
                u = np.unique(np.stack([of, hit]), axis=1) if len(hit) else np.zeros((2, 0), np.int64)
                np.add.at(total, (y[u[0]], u[1]), 1)
        y, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(k, pa.int32()), pa.array(total[y, k])], names=["y", "k", "n"])

    count = np.zeros((2, 2 * len(lexicon.terms)))
    for r in rows.select("toxic", "text").mapInArrow(hits, "y int, k int, n long").groupBy("y", "k").agg(F.sum("n").alias("n")).collect():  # four a term
        count[r.y, r.k] = r.n
    share = lambda y, plus: (count[y].reshape(-1, 2) + plus) / (n[y] + 1)
    exact = np.log(share(1, 0.5) / share(0, 0.5))[:, 0]
    # a misspelling never met counts half as much as its term; what has been met corrects that
    fuzzy = np.log((count[1].reshape(-1, 2)[:, 1] / (n[1] + 1) + 1 / (n[1] + 1)) / (count[0].reshape(-1, 2)[:, 1] / (n[0] + 1) + np.exp(-exact / 2) / (n[1] + 1)))
    weights = np.maximum(np.column_stack([exact, np.where(fuzzy < 1, 0, np.minimum(fuzzy, exact))]), 0)
    keep = np.flatnonzero(weights[:, 0] > 0)
    model = Model(Lexicon([lexicon.terms[k] for k in keep], weights[keep]), window=window)

    def around(batches):
        scanner = Scanner(model.lexicon, window)
        got = (Counter(), Counter())
        for b in batches:
            lo = 0
            for texts in _slices(b.column(1)):
                y = b.column(0).slice(lo, len(texts)).to_pylist()
                lo += len(texts)
                _, hit, of, context = scanner.scan(texts)
                for k in range(len(hit)):
                    got[y[of[k]]].update([*context(k), ""])
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array([y] * len(got[y]), pa.int32()), pa.array(list(got[y]), pa.string()), pa.array(list(got[y].values()), pa.int64())], names=["y", "w", "n"])

    seen = rows.select("toxic", "text").mapInArrow(around, "y int, w string, n long").groupBy("w").agg(*[F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(c) for y, c in ((0, "clean"), (1, "toxic"))])
    total = seen.where("w = ''").first()
    clean, toxic = (total.clean, total.toxic) if total else (0, 0)
    model.prior = math.log((toxic + 1) / (clean + 1))
    if clean and toxic:
        rows_ = seen.where("w <> '' and clean + toxic >= 5").orderBy(F.desc(F.col("clean") + F.col("toxic")), "w").limit(most_context).collect()
        log = {r.w: math.log((r.toxic + 1) / (toxic + 2) / ((r.clean + 1) / (clean + 2))) for r in rows_}
        model.context = {w: round(v, 6) for w, v in log.items() if abs(v) > 0.5}
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Weights by Newton's method; the first column (ones) is hardly held back."""
    w, hold = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    hold[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", most_toxic: int = 4096, most_clean: int = 8192, most_terms: int = 2000, most_context: int = 2000, window: int = 6, least_fold: int = 40) -> Model | float:
    """The model of labels(doc_id, toxic) on docs, or the share of toxic labels where there is nothing to tell apart."""
    rows, all_labels = sample(docs, labels, most_toxic, most_clean, doc_id, text, toxic)
    n = {(r.toxic, r.fold): r.n for r in rows.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    of = lambda folds: [sum(n.get((y, f), 0) for f in folds) for y in (0, 1)]
    if 0 in of(range(3)):
        return all_labels[1] / max(sum(all_labels), 1)
    split = min(of([0])[1], of([1, 2])[1]) >= least_fold  # else too few: the same texts teach both
    first, second = (rows.where("fold > 0"), rows.where("fold = 0")) if split else (rows, rows)

    def made(part: DataFrame, k: list[int]) -> Model:
        return weigh(part, learn_terms(part, k, most_terms), k, most_context, window)

    model = made(first, of([1, 2]) if split else of(range(3)))

    def measured(batches, model=model):
        scanner = Scanner(model.lexicon, model.window)
        for b in batches:
            lo = 0
            for texts in _slices(b.column(1)):
                x = model.features(scanner, texts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(texts)), *map(pa.array, x.T)], names=["toxic", *"abcde"])
                lo += len(texts)

    got = np.array([tuple(r) for r in second.select("toxic", "text").mapInArrow(measured, "toxic int, a double, b double, c double, d double, e double").collect()])  # a row of the sample each
    weights = logistic(got[:, 1:], got[:, 0])
    taken = of(range(3))
    weights[0] += math.log(all_labels[1] / taken[1]) - math.log(all_labels[0] / taken[0])  # the sample's shares to those of all labels
    final = made(rows, taken) if split else model
    final.weights = weights
    return final


def score(docs: DataFrame, model: Model | float, doc_id: str = "doc_id", text: str = "text", bound: float = 0.5) -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    src = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    if isinstance(model, float):
        return src.select("doc_id", F.lit(model).alias("score"), F.lit(int(model >= bound)).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by most_terms and most_context

    def each(batches):
        model = shared.value
        scanner = Scanner(model.lexicon, model.window)
        for b in batches:
            got = [1 / (1 + np.exp(-np.clip(model.features(scanner, texts) @ model.weights, -700, 700))) for texts in _slices(b.column(1))]
            p = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= bound).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return src.mapInArrow(each, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
