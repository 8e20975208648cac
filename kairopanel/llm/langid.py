"""Language identification with a bidirectional gated recurrent network over bytes.

The network (one GRU per direction over UTF-8 bytes, hidden size ``hidden``) is trained in numpy by
backpropagation through time on windows of a bounded sample of labelled rows: at most ``per_lang`` documents a
language, the ones whose hashed ids come first, and of each at most ``excerpt`` characters from a hashed place.
Windows are of all lengths from ``shortest`` up, so that short texts and text ends look like what was learned. Every
position gets a label distribution; a document's probabilities are the mean over all its bytes.

Prediction reads every byte of every text: texts are cut into windows of ``WINDOW`` bytes, windows of like length of
many documents form one batch, and only sums per document are kept, so memory doesn't grow with a text beyond the text
itself. Shorter windows are filled up with ``PAD``, at which the state is zero in both directions, so a text's
prediction depends neither on padding nor on its neighbours in the batch.

Defined results: null text, empty text and text without a Unicode letter give ``und`` with score 0; so does
every text if no labelled row exists. Repeated rows are scored one by one; ties between languages go to the
first in sorted order. Only the text is an input of a prediction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairopanel.llm.common import let_go

WINDOW = 256
PAD = 256
_LETTER = re.compile(r"[^\W\d_]")  # or a numeral that isn't a decimal digit


def has_letter(text: str | None) -> bool:
    """Whether any character is of Unicode's category L, as Spark's \\p{L}."""
    return bool(text) and any(m.group().isalpha() for m in _LETTER.finditer(text))


@dataclass
class BiGRU:
    """Per direction: gate tables by byte (rz: 257 x 2H, n: 257 x H; row 256 is PAD), recurrences u_rz, u_n, and a joint read-out.

    Gates use tanh form: sigmoid(a) = (1 + tanh(a / 2)) / 2, with the half folded into the weights.
    """

    langs: list[str]
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(langs: list[str], hidden: int, seed: int) -> BiGRU:
        g = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p |= {f"x_rz{d}": g.normal(0, 0.3, (257, 2 * hidden)), f"x_n{d}": g.normal(0, 0.5, (257, hidden))}
            p |= {f"u_rz{d}": g.normal(0, 0.5 / hidden**0.5, (hidden, 2 * hidden)), f"u_n{d}": g.normal(0, 1 / hidden**0.5, (hidden, hidden))}
            p |= {f"w{d}": g.normal(0, 1 / hidden**0.5, (hidden, len(langs)))}
        p["b"] = np.zeros(len(langs))
        return BiGRU(langs, {k: v.astype(np.float32) for k, v in p.items()})

    def states(self, x: np.ndarray, d: str, keep: bool = False):
        """Hidden states (T, B, H) for byte windows x (T, B), zero at PAD; direction b runs from the end."""
        p, (t_max, b) = self.p, x.shape
        h = np.zeros((b, p[f"u_n{d}"].shape[0]), np.float32)
        n_h = h.shape[1]
        out, kept, live = np.empty((t_max, b, n_h), np.float32), [], x != PAD
        short = ~live.all(1)
        for t in range(t_max) if d == "f" else range(t_max - 1, -1, -1):
            rz = np.take(p[f"x_rz{d}"], x[t], axis=0, mode="clip")
            rz += h @ p[f"u_rz{d}"]
            np.tanh(rz, out=rz)
            rz *= 0.5
            rz += 0.5
            r, z = rz[:, :n_h], rz[:, n_h:]
            un = h @ p[f"u_n{d}"]
            n = np.take(p[f"x_n{d}"], x[t], axis=0, mode="clip")
            n += r * un
            np.tanh(n, out=n)
            if keep:
                kept.append((t, h, rz, un, n))
            h = np.add(n, z * (h - n), out=out[t])
            if short[t]:
                h *= live[t][:, None]
        return (out, kept) if keep else out

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Label probabilities (languages, T, B) for byte windows x (T, B)."""
        a = (self.states(x, "f").reshape(x.size, -1) @ self.p["wf"] + self.states(x, "b").reshape(x.size, -1) @ self.p["wb"] + self.p["b"]).T.copy()
        a -= a.max(0)
        np.exp(a, out=a)
        a /= a.sum(0)
        return a.reshape(-1, *x.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions but PAD and its gradients, by backpropagation through time."""
        p, (t_max, b), live = self.p, x.shape, (x != PAD)[:, :, None]
        hs, kept = {}, {}
        for d in "fb":
            hs[d], kept[d] = self.states(x, d, keep=True)
        a = hs["f"] @ p["wf"] + hs["b"] @ p["wb"] + p["b"]
        a -= a.max(-1, keepdims=True)
        q = np.exp(a)
        q /= q.sum(-1, keepdims=True)
        n_live = int(live.sum())
        loss = float(-(np.log(q[:, np.arange(b), y] + 1e-9) * live[:, :, 0]).sum() / n_live)
        q[:, np.arange(b), y] -= 1
        q *= live / np.float32(n_live)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["b"] = q.sum((0, 1))
        for d in "fb":
            n_h = p[f"u_n{d}"].shape[0]
            g[f"w{d}"] = np.tensordot(hs[d], q, ((0, 1), (0, 1)))
            into, dh = q @ p[f"w{d}"].T, np.zeros((b, n_h), np.float32)
            d_rz, d_n = np.empty((t_max, b, 2 * n_h), np.float32), np.empty((t_max, b, n_h), np.float32)
            for t, h0, rz, un, n in reversed(kept[d]):
                dh = (dh + into[t]) * live[t]
                r, z = rz[:, :n_h], rz[:, n_h:]
                dn = dh * (1 - z) * (1 - n * n)
                d_n[t] = dn
                d_rz[t, :, :n_h] = dn * un * r * (1 - r) * 2
                d_rz[t, :, n_h:] = dh * (h0 - n) * z * (1 - z) * 2
                g[f"u_n{d}"] += h0.T @ (dn * r)
                g[f"u_rz{d}"] += h0.T @ d_rz[t]
                dh = dh * z + (dn * r) @ p[f"u_n{d}"].T + d_rz[t] @ p[f"u_rz{d}"].T
            np.add.at(g[f"x_rz{d}"], x, d_rz)
            np.add.at(g[f"x_n{d}"], x, d_n)
        return loss, g


def train(texts: list[bytes], labels: list[str], hidden: int = 8, window: int = 48, shortest: int = 8, batch: int = 128, steps: int = 400, seed: int = 7) -> BiGRU | None:
    """Fits the network by Adam on random windows of shortest to window bytes, languages drawn evenly; None without labelled bytes."""
    pairs = sorted((y, x) for x, y in zip(texts, labels, strict=True) if x)
    langs = sorted({y for y, _ in pairs})
    if not langs:
        return None
    g = np.random.default_rng(seed)
    model = BiGRU.fresh(langs, hidden, seed)
    by = [[np.frombuffer(x, np.uint8) for y, x in pairs if y == k] for k in langs]
    m, v = ({k: np.zeros_like(w) for k, w in model.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        y = g.integers(0, len(langs), batch)
        x, sizes = np.full((window, batch), PAD, np.int64), g.integers(shortest, window + 1, batch)
        for j, (k, n) in enumerate(zip(y, sizes, strict=True)):
            doc = by[k][g.integers(len(by[k]))]
            part = doc[(at := g.integers(max(1, len(doc) - n + 1))) : at + n]
            x[: len(part), j] = part
        _, grad = model.gradients(x, y)
        norm = sum(float((w * w).sum()) for w in grad.values()) ** 0.5
        rate = 0.02 * min(1.0, 3 * (1 - step / (steps + 1)))
        for k, w in grad.items():
            w = w * min(1.0, 1.0 / (norm + 1e-9))
            m[k] += 0.1 * (w - m[k])
            v[k] += 0.01 * (w * w - v[k])
            model.p[k] = (model.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def _pooled(model: BiGRU, texts: list[bytes], rows: int = 1024) -> np.ndarray:
    """Mean position probabilities of each text, over all its bytes."""
    sizes = np.array([len(t) for t in texts])
    counts = -(-sizes // WINDOW)
    whole = np.full((int(counts.sum()), WINDOW), PAD, np.uint16)
    owner = np.repeat(np.arange(len(texts)), counts)
    flat, at = whole.reshape(-1), 0
    for t, c in zip(texts, counts, strict=True):
        flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += int(c) * WINDOW
    ends = np.full(len(whole), WINDOW)
    ends[np.cumsum(counts) - 1] = sizes - (counts - 1) * WINDOW
    total = np.zeros((len(texts), len(model.langs)))
    order = np.argsort(ends, kind="stable")
    for lo in range(0, len(whole), rows):
        some = order[lo : lo + rows]
        longest = int(ends[some[-1]])
        q = model.positions(np.ascontiguousarray(whole[some, :longest].T, dtype=np.int64))
        if ends[some[0]] < longest:
            q *= np.arange(longest)[:, None] < ends[some]
        np.add.at(total, owner[some], q.sum(1, dtype=np.float64).T)
    return total / sizes[:, None]


def predict_texts(model: BiGRU | None, texts: list[str | None], most: int = 1 << 22) -> tuple[list[str], list[float]]:
    """Languages and scores; at most about ``most`` bytes (or one text) are worked on at once."""
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    if model is None:
        return lang, score
    group: list[tuple[int, bytes]] = []

    def flush() -> None:
        for (i, _), q in zip(group, _pooled(model, [t for _, t in group]) if group else [], strict=True):
            lang[i], score[i] = model.langs[int(q.argmax())], float(min(1.0, q.max()))
        group.clear()

    held = 0
    for i, t in enumerate(texts):
        if has_letter(t):
            group.append((i, t.encode("utf-8", "surrogatepass")))
            held += len(group[-1][1])
            if held >= most:
                flush()
                held = 0
    flush()
    return lang, score


def sample(labelled: DataFrame, per_lang: int = 512, excerpt: int = 2048) -> tuple[list[bytes], list[str]]:
    """At most ``per_lang`` (text excerpt, lang) pairs a language from labelled(doc_id, text, lang).

    Chosen by hashed id, so any partitioning gives the same rows: ids first (no text is read), then one text of each.
    """
    from pyspark.sql import Window as W

    cells = 64
    ids = labelled.where("lang is not null and doc_id is not null").select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    w = W.partitionBy("lang", F.pmod(F.col("h"), F.lit(cells))).orderBy("h", "doc_id")
    ids = ids.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max(1, per_lang // cells)).select("doc_id").distinct()
    text = F.coalesce("text", F.lit(""))
    at = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length(text) - excerpt, F.lit(1))) + 1
    rows = labelled.where("lang is not null").join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", F.struct("lang", F.substring(text, at.cast("int"), F.lit(excerpt)).alias("t")).alias("x"))
    rows = sorted((r.x.lang, r.x.t) for r in rows.groupBy("doc_id").agg(F.min("x").alias("x")).select("x").collect())  # a row an id
    return [t.encode("utf-8", "surrogatepass") for _, t in rows], [lang for lang, _ in rows]


def fit(labelled: DataFrame, per_lang: int = 512, excerpt: int = 2048, **kw) -> BiGRU | None:
    return train(*sample(labelled, per_lang, excerpt), **kw)


def predict(docs: DataFrame, model: BiGRU | None, text: str = "text") -> DataFrame:
    """docs as one struct column ``row`` (any columns, no clashes), with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few KB: its size depends on hidden and languages only

    at = [c.lower() for c in docs.columns].index(text.lower())

    def label(batches):
        let_go()
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b = whole.slice(lo, 1024)
                lang, score = predict_texts(shared.value, b.column(0).field(at).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["row", "lang_pred", "score"])

    src = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))  # the text moves once
    schema = T.StructType([src.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return src.mapInArrow(label, schema)
