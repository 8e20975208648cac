"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from kairopanel.llm import resample

SCHEMA = "doc_id long, text string, score string, rank string"


def brute(docs, target, ngrams=1, buckets=10_000, least=20, percent=10):
    def feats(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in docs for b in feats(x)[1]), Counter(b for x in target for b in feats(x)[1])
    total_s, total_t = s.total(), t.total()
    rows = []
    for i, x in docs:
        n, f = feats(x)
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((n, i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    k = percent * len(able) // 100
    return sorted([(*r[1:], n + 1 if n < k else None) for n, r in enumerate(able)] + [(*r[1:], None) for r in rows if r[0] < least], key=repr)


def made(spark, n=400):
    g = np.random.default_rng(2)
    words = ["alpha", "Beta", "gamma", "d7", "é中", "zeta"]
    rows = [(i, " ".join(g.choice(words, int(g.integers(0, 60)))), "x", "y") for i in range(n)]
    rows += [(None, "alpha beta " * 15, "", ""), (None, None, "", ""), (7, "", "", ""), (8, "!?", "", ""), (9, "w" * 50_000, "", "")] + [(5, "zeta " * 30, "", "")] * 90
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5), ["alpha gamma", None, "", "d7 Alpha, alpha"]


def test_resample_against_brute_force(spark):
    rows, docs, target = made(spark)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for kw, more in (({}, {}), ({"segment_rows": 8}, {}), ({"segment_rows": 3, "most_segments": 40, "ngrams": 2, "buckets": 50}, {"ngrams": 2, "buckets": 50})):
        got = resample.resample(docs, bench, **kw).collect()
        assert sorted([tuple(r) for r in got], key=repr) == brute([r[:2] for r in rows], target, **more)


def test_ranks_split_equal_keys(spark):
    rows = [(3, 1)] * 500 + [(9, None)] * 300 + [(9, k) for k in range(50)]
    df = spark.createDataFrame(rows, "score long, doc_id long").repartition(6)
    got = sorted((r.rank, r.score, r.doc_id) for r in resample.ranked(df, segment_rows=16).collect())
    want = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert got == [(k + 1, *r) for k, r in enumerate(want)]


def test_draw_and_empty_tables(spark):
    rows, docs, target = made(spark, 200)
    bench = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    ids = docs.where("doc_id > 10")
    drawn = resample.draw(ids, bench)
    assert drawn.columns == docs.columns and drawn.count() == resample.resample(ids, bench).where("rank is not null").count() > 0
    assert resample.resample(docs.limit(0), bench).count() == 0
    assert resample.resample(docs, bench.limit(0)).count() == docs.count()
