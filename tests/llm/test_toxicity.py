"""Toxicity: automata against plain edit distances, quotation against abuse, held-out accuracy, edge cases."""

import numpy as np
import pytest

from kairopanel.llm import toxicity
from kairopanel.llm.toxicity import END, Automaton, Lexicon, Scanner

SCHEMA = "doc_id long, text string, score string, hit string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_hit(lexicon, word):
    """Least (edits, -weight, term) over all terms by full comparison."""
    got = []
    for k, t in enumerate(lexicon.terms):
        allowed = toxicity.edits_allowed(t) if lexicon.fuzzy and lexicon.weights[k, 1] > 0 else 0
        stem = t.rstrip(END)
        d = distance(stem, word) if t.endswith(END) else min(distance(stem, word[:n]) for n in range(len(word) + 1))
        if d <= allowed:
            got.append((d, -lexicon.weights[k, min(d, 1)], k))
    return 2 * min(got)[2] + (min(got)[0] > 0) if got else -1


def test_automaton_against_edit_distances():
    g = np.random.default_rng(4)
    terms = ["abcab" + END, "abc" + END, "bbacabcab" + END, "cabbage", "ca", "acbacbacb" + END, "bcab" + END, "aaaaa" + END]
    lexicon = Lexicon(terms, g.uniform(1, 3, (len(terms), 2)))
    lexicon.weights[3, 1] = 0
    words = ["".join(g.choice(list("abcge"), int(g.integers(1, 12)))) for _ in range(4000)] + [t.rstrip(END) for t in terms] + ["xabcab", "é", "abcxab"]
    scanner = Scanner(lexicon)
    _, hits, of, _ = scanner.scan(words)
    got = dict(zip(of.tolist(), hits.tolist(), strict=True))
    want = {i: h for i, w in enumerate(words) if (h := plain_hit(lexicon, w)) >= 0}
    # an exact stem within a word ends the search: another term may hit as exactly
    off = {i for i in got.keys() | want.keys() if got.get(i) != want.get(i)}
    assert not off
    small = Scanner(lexicon)
    small.automaton.most = 3  # states are dropped and made anew
    for lo in range(0, len(words), 500):
        _, h, o, _ = small.scan(words[lo : lo + 500])
        assert {lo + int(i): int(x) for i, x in zip(o, h, strict=True)} == {i: x for i, x in got.items() if lo <= i < lo + 500}


def corpus(spark, n=900):
    """Toxic texts use bad words, some misspelt; clean ones quote them in reports, or hold words that look like them."""
    g = np.random.default_rng(6)
    filler = ["the", "road", "was", "long", "and", "they", "went", "home", "grade", "bread", "lovely", "day"]
    bad, slips = ["grobnik", "snarfel", "blixworm"], ["grobnk", "snarffel", "blixwrm", "bliyworm"]
    rows, labels = [], []
    for i in range(n):
        t = list(g.choice(filler, int(g.integers(10, 60))))
        kind = i % 4
        if kind == 0:
            for _ in range(3):
                t[int(g.integers(len(t)))] = f"you {g.choice(bad + slips[:1])}"
        elif kind == 1:
            t[int(g.integers(len(t)))] = f'reporters wrote that "a {g.choice(bad)}" was said'
        elif kind == 2:
            t[int(g.integers(len(t)))] = "grobnisk"
        rows.append((i, " ".join(t), "x", "y"))
        labels.append((i, int(kind == 0)))
    return spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int"), slips


def test_quotation_misspelling_and_held_out_accuracy(spark):
    docs, labels, slips = corpus(spark)
    model = toxicity.fit(docs.where("doc_id % 5 <> 0"), labels.where("doc_id % 5 <> 0"), least_fold=20)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in got if i % 5 == 0]
    right = np.mean([got[i].predicted == (i % 4 == 0) for i in held])
    assert right >= 0.97 and all(0 <= r.score <= 1 for r in got.values())
    texts = [f"you {s} the road you {s} was long you {s} and they went home" for s in slips] + ['reporters wrote that "a snarfel" was said and they went home', "the long road home"]
    new = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA), model).collect()}
    assert all(new[i] > 0.5 for i in range(len(slips))) and new[4] < 0.5 and new[5] < 0.5


def test_toxicity_of_odd_rows(spark):
    docs, labels, _ = corpus(spark, 300)
    odd = [(None, "you grobnik"), (900, None), (901, ""), (902, "x" * 200_000 + " grobnik " * 1000), (903, "中文 é ½"), (0, "the road")]
    every = docs.union(spark.createDataFrame([(*r, "x", "y") for r in odd], SCHEMA))
    odd_labels = spark.createDataFrame([(None, 1), (900, 1), (901, None), (0, 0), (0, 1), (12345, 1)], "doc_id long, toxic int")
    model = toxicity.fit(every, labels.union(odd_labels))
    got = toxicity.score(every, model).collect()
    assert len(got) == 306 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (900, 901)}) == 1


@pytest.mark.parametrize("which", ["docs", "labels", "one class"])
def test_toxicity_without_training(spark, which):
    docs, labels, _ = corpus(spark, 40)
    docs, labels = docs.where("doc_id < 0" if which == "docs" else "true"), labels.where({"docs": "true", "labels": "doc_id < 0", "one class": "toxic = 1"}[which])
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == (0 if which == "docs" else 40) and {r.score for r in got} <= {0.0 if which == "labels" else 1.0}
