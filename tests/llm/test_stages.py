"""Stages of the corpus pipeline against brute force on small tables."""

import inspect

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from kairopanel.llm import bloom_lm, simhash



def near_copies(g):
    """Texts of 30 to 200 words with copies of which words are changed at one place or at several."""
    out = []
    for _ in range(12):
        t = [f"w{k}É" for k in g.integers(0, 500, int(g.integers(30, 200)))]
        out.append(" ".join(t))
        for changes in (0, 1, 2, 3, 5, 8):
            u = list(t)
            for at in g.integers(0, len(t), changes):
                u[at] = f"c{g.integers(10**6)}"
            out.append(" ".join(u[: len(u) - int(g.integers(3))]).upper().lower())
    return [*out, *out[:3], "one", "One", "two words", None, "", "long " * 5000, " ".join(["same line of words again"] * 40)]


def brute_set(text):
    table = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    w = (text or "").encode().translate(table).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(x, y):
    return x == y or 5 * len(x & y) >= 4 * len(x | y)


def kept_ids(rows):
    own = {i: brute_set(t) for i, t in rows}
    low = {i: i for i in own}
    while True:
        new = dict(low)
        for a in own:
            for b in own:
                if linked(own[a], own[b]):
                    new[a] = min(new[a], low[b])
        if new == low:
            return sorted(set(low.values()))
        low = new


def test_near_duplicate_stage(spark):
    rows = list(enumerate(near_copies(np.random.default_rng(5))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = kept_ids(rows)
    sims = [len(x & y) / len(x | y) for i, x in enumerate(map(brute_set, (t for _, t in rows))) for y in map(brute_set, (t for _, t in rows[:i])) if x | y and x != y]
    assert sum(0.8 <= s < 0.9 for s in sims) > 5 and sum(0.6 < s < 0.8 for s in sims) > 5
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == want
    # cut groups and parts of trees give the same classes
    assert sorted(r.doc_id for r in simhash.deduplicate(docs, most=8).collect()) == want


def test_no_link_at_the_bound_is_missed(spark):
    """Pairs at a similarity of just 0.8, and just below it, with a line that many texts share."""
    g = np.random.default_rng(22)
    line, rows = " ".join(f"l{i}" for i in range(9)), []
    for q in range(1, 201):
        k = q % 25 + 1
        w = [f"w{q}x{i}" for i in g.permutation(5 * k + 5)]
        rows += [(10 * q, " ".join(w[: 4 * k + 4])), (10 * q + 1, " ".join(w[: 5 * k + 4])), (10 * q + 2, " ".join([*w[: 4 * k + 4], line])), (10 * q + 3, " ".join([line, *w[:9]]))]
        rows.append((10 * q + 4, " ".join([*(f"v{q}x{i}" for i in range(4 * k + 4))])))
        rows.append((10 * q + 5, " ".join([*(f"v{q}x{i}" for i in range(5 * k + 5))])))  # one shingle too many
    own = {i: brute_set(x) for i, x in rows}
    by_place = {}
    for i, s in own.items():
        for x in s:
            by_place.setdefault(x, []).append(i)
    low = {i: i for i in own}
    links = {(a, b) for ids in by_place.values() if len(ids) < 100 for a in ids for b in ids if a < b and linked(own[a], own[b])}
    hot = {i for ids in by_place.values() if len(ids) >= 100 for i in ids}  # the line itself links nothing that shares nothing else
    links |= {(a, b) for a in hot for b in hot if a < b and linked(own[a], own[b])}
    for _ in range(10):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert sum(5 * len(own[a] & own[b]) == 4 * len(own[a] | own[b]) for a, b in links) >= 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (2048, 8):
        assert sorted(r.doc_id for r in simhash.deduplicate(docs, most=most).collect()) == sorted({i for i in low if low[i] == i})


def test_prefixes_and_parities():
    g = np.random.default_rng(23)
    long = np.unique(g.integers(-(2**62), 2**62, 1100))
    for new in (0, 1, 200):  # 2048 bits, also against 1024
        assert simhash.parities_differ(simhash.parities(long), simhash.parities(long[new + 100 :])) <= new + 100
    assert simhash.parities_differ(simhash.parities(long), simhash.parities(np.unique(g.integers(-(2**62), 2**62, 1100)))) > 275
    for n in (1, 2, 4, 5, 9, 10, 50, 333):
        a = np.unique(g.integers(-(2**62), 2**62, n))
        hot = np.sort(g.permutation(a)[: n // 2])
        for frequent in ((hot, g.permutation(len(hot))), (a[:0], a[:0])):
            for gone in range(n // 5 + 1):
                for new in range(n // 4 + 1):
                    if 5 * (n - gone) < 4 * (n + new):
                        continue
                    b = np.unique(np.concatenate([g.permutation(a)[gone:], g.integers(-(2**62), 2**62, new)]))
                    assert np.intersect1d(*(simhash.prefix(s, frequent, 0.8 * (1 - 1e-12)) for s in (a, b))).size
                    assert simhash.parities_differ(simhash.parities(a), simhash.parities(b)) <= gone + new
    assert not len(simhash.prefix(a[:0], (hot, hot), 0.8))


def test_near_duplicate_stage_without_links(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (2, "a b c"), (None, "x y z"), (None, "x y z")], "doc_id long, text string")
    got = sorted((r.text, r.doc_id) for r in simhash.deduplicate(docs).collect())
    assert got == [("a b c", 2), ("x y z", None)]
    assert simhash.deduplicate(docs.limit(0)).count() == 0


def test_bigrams_seen_once_count(spark):
    pairs = [(i, f"a{i} b{i}") for i in range(200)]  # every bigram of words is seen once
    texts = [*pairs, (1000, "a7 b7"), (1001, "a7 b8")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.score for r in bloom_lm.score(docs, F.col("doc_id") < 1000, segments=16).collect()}
    counts = bloom_lm.count(docs.where("doc_id < 1000"), 16)
    rows = [(r.segment, r.size, bytes(r.filter)) for r in bloom_lm.build(counts, inspect.signature(bloom_lm.score).parameters["min_count"].default, 2.0, 12, 3).collect()]
    own = np.concatenate([bloom_lm.bigrams(x) for x in bloom_lm.tokens([t for _, t in pairs])])
    assert (bloom_lm.Filter(rows, 16, 3).levels(own) > 0).all()
    assert got[1000] >= got[1001]


def test_pipeline_against_brute_force(spark, tmp_path):
    """All stages on a small table with nulls, empties, repeated rows, ties, a very long text and clashing columns."""
    from tokenizers import Tokenizer

    from kairopanel.llm import langid, mixing, secrets
    from kairopanel.llm.queries import tokenizer_path

    g = np.random.default_rng(21)
    rows = []
    for lang, letters in (("aa", "abcdeot"), ("bb", "fghijot"), ("zz", "vwxyzot")):
        for _ in range(40):
            text = " ".join("".join(g.choice(list(letters), int(g.integers(2, 9)))) for _ in range(int(g.integers(20, 80))))
            rows.append((len(rows), text, lang, ["s1", "s2", None][len(rows) % 3]))
    base = [t for _, t, *_ in rows]
    for k in range(0, 30, 3):  # exact and near copies
        rows.append((len(rows), base[k], "aa", "s2"))
        w = base[k + 1].split(" ")
        rows.append((len(rows), " ".join([*w[:-1], "changed"]), None, "s1"))
    rows.append((len(rows), " ".join(base[50].split(" ")[::-1]) + " password = 'hunter2hunter2' and zQ8xK2vP9mW4rT7yL1nB6cD3 end", "bb", "s1"))
    rows += [(len(rows) + i, t, None, "s1") for i, t in enumerate([None, "", " ", "123 456", "x" * 50_000])]
    rows += [rows[5], (None, base[7] + " more", "aa", "s2"), (None, None, None, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), "k", "row") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, k string, row string")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {}
    stages = [(name, lambda s, d, p, f=f, n=name: got.setdefault(n, f(s, d, p))) for name, f in corpus_pipeline.STAGES]
    kept_stages, corpus_pipeline.STAGES = corpus_pipeline.STAGES, stages
    try:
        pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        corpus_pipeline.STAGES = kept_stages
    names = [n for n, _ in kept_stages]
    assert all(got[n].columns == docs.columns for n in names[:-1])
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "", r.source or "")
    table = {n: sorted((key(r) for r in got[n].collect()), key=str) for n in names[:-1]}

    model = langid.fit(docs.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 != 2))
    lang, score = langid.predict_texts(model, [t for _, t, *_ in rows])
    first = [r for r, x, s in zip(rows, lang, score, strict=True) if x != "und" and s >= 0.4]
    plain = lambda some: sorted(((i is None, i, t or "", s or "") for i, t, _, s in some), key=str)
    assert table[names[0]] == plain(first) and len(rows) - len(first) in range(5, 9)

    numbered = [(n, r) for n, r in enumerate(sorted(first, key=lambda r: (r[0] is None, r[0] or 0)))]
    keep = kept_ids([(n, r[1]) for n, r in numbered])
    second = [numbered[n][1] for n in keep]
    assert table[names[1]] == plain(second) and len(second) < len(first) - 15

    found = {r.doc_id: r.spans for r in secrets.scan(got[names[1]]).collect()}
    third = []
    for i, t, la, s in second:
        out, at = "", 0
        for b, e in sorted(tuple(map(int, x.split(":")[1:])) for x in found[i].split(",") if x):
            out, at = (out + t[at:b] + "[SECRET]" if b >= at else out), max(at, e)
        third.append((i, out + t[at:], la, s))
    assert table[names[2]] == plain(third) and sum("[SECRET]" in t for _, t, *_ in third) >= 1

    takes = {(r.doc_id, r.size): r.taken for r in mixing.plan(got[names[2]]).collect()}
    fourth = []
    for i, t, la, s in third:
        w = t.split()
        left = takes[i, len(w)]
        fourth += [(i, t, la, s)] * (left // len(w)) + ([(i, " ".join(w[: left % len(w)]), la, s)] if left % len(w) else [])
    assert table[names[3]] == plain(fourth)

    t = Tokenizer.from_file(tokenizer_path())
    assert sum(r.length for r in pieces) == sum(len(t.encode(x, add_special_tokens=False).ids) + 1 for _, x, *_ in fourth)
    empty = corpus_pipeline.run(spark, str(_empty(docs, tmp_path)))
    assert empty.count() == 0


def _empty(docs, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    return tmp_path / "none"
