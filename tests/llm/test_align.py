"""Alignment of two tokenizers against a plain reading of every text, and the perfect hash by itself."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from kairopanel.llm import align
from kairopanel.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, n_a string"


def piece_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """Every pair of tokens compared; a plain dictionary of document counts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(tokenizer_path()), sentencepiece.SentencePieceProcessor(model_file=piece_path())
    a_tok.encode_special_tokens = True
    names, own = {i: x for x, i in a_tok.get_vocab().items()}, [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(own)))}
    rows, pairs = [], defaultdict(int)
    for t in texts:
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_tok.encode(t) if t else []
        a_bytes = [bytes(chars[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(a_bytes) != (" " + t).encode() or b"".join(b_bytes) != (" " + t).encode():
            rows.append(([], [], "", []))
            continue
        spans = []
        for ids, raw in ((a, a_bytes), (b, b_bytes)):
            at = np.cumsum([0, *map(len, raw)])
            spans.append([(i, int(at[k]), int(at[k + 1])) for k, i in enumerate(ids)])
        links = [(x, y) for x, s, e in spans[0] for y, u, v in spans[1] if s < v and u < e] if len(a) < 400 else merged(*spans)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        parts = ["|".join(",".join(str(i) for i, _, e in side if lo < e <= hi) for side in spans) for lo, hi in zip([0, *cuts[:-1]], cuts, strict=True)] if len(a) < 400 else None
        rows.append((a, b, parts, links))
        for p in set(links):
            pairs[p] += 1
    best = defaultdict(int)
    for (x, _), n in pairs.items():
        best[x] = max(best[x], n)
    out = []
    for a, b, parts, links in rows:
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ("" if parts == "" else None)
        out.append((len(a), len(b), len(parts) if parts is not None else None, len(links), sum(pairs[p] == best[p[0]] for p in links), sum(pairs[p] for p in links), digest))
    return out


def merged(x, y):
    i = j = 0
    links = []
    while i < len(x) and j < len(y):
        links.append((x[i][0], y[j][0]))
        e, v = x[i][2], y[j][2]
        i, j = i + (e <= v), j + (v <= e)
    return links


TEXTS = [
    None, "", " ", "   ", "a", "The quick brown fox, jumped!", "The quick brown fox, jumped!", " lead", "trail ", "a  b", "x\n\ny\tz", "naïve café über ½ ﬁ　é 中文字 🙂🙂",
    "<s> </s> <unk> <|endoftext|> <0x41>", "a▁b", "▁", "unbelievable antidisestablishmentarianism", "é ​ zero", "A" * 3000, "word " * 500 + "end", "def f(x):\n    return x  # ok\r\n",
]


def frame(spark, texts, parts=3):
    return spark.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("settings", [{}, {"slots": 7, "fan": 2, "flush": 8, "round_bytes": 400}])
def test_align_against_brute_force(spark, settings):
    want = sorted(brute(TEXTS), key=repr)
    got = align.align(frame(spark, TEXTS), tokenizer_path(), piece_path(), **settings).collect()
    assert len({r.doc_row for r in got}) == len(TEXTS)
    got = sorted([(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got], key=repr)
    long = [w for w in want if w[2] is None]
    for w in long:  # too long for the plain reading of groups
        assert any(g[:2] == w[:2] and g[3:6] == w[3:6] for g in got)
    short = [w for w in want if w[2] is not None]
    assert all(w in got for w in short) and len(got) == len(want)


def test_align_of_empty_tables(spark):
    assert align.align(spark.createDataFrame([], SCHEMA), tokenizer_path(), piece_path()).count() == 0
    none = align.align(spark.createDataFrame([(None, None, None), (1, "", "")], SCHEMA), tokenizer_path(), piece_path()).collect()
    assert [(r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in none] == [(0, 0, 0, "")] * 2


def test_words_are_encoded_as_in_whole_texts():
    import sentencepiece

    of, model = align.Aligner(tokenizer_path(), piece_path(), most=40), sentencepiece.SentencePieceProcessor(model_file=piece_path())
    texts = [t for t in TEXTS if t and "▁" not in t] + [" ".join(f"w{k}{i}" for i in range(30)) for k in range(9)]
    for k in range(0, len(texts), 3):
        a, b, _ = of.encode(texts[k : k + 3])
        assert [np.frombuffer(x, "<u4").tolist() for x in b] == model.encode(texts[k : k + 3])
        assert [np.frombuffer(x, "<u4").tolist() for x in a] == [of.a.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts[k : k + 3]]


def test_perfect_hash():
    g = np.random.default_rng(5)
    keys = np.unique(g.integers(0, 1 << 31, 20_000))
    table = align.Table([(s, align.mph_levels(keys[align.slot_of(keys, 5) == s]), keys[align.slot_of(keys, 5) == s], keys[align.slot_of(keys, 5) == s]) for s in range(4)], 5)
    inside = keys[align.slot_of(keys, 5) < 4]
    place = table.place(inside)
    assert sorted(place.tolist()) == list(range(len(inside)))  # minimal and perfect
    table.keys = np.empty_like(inside)
    table.keys[place] = inside
    table.values = table.keys + 1
    assert (table.get(inside) == inside + 1).all()
    others = np.setdiff1d(g.integers(0, 1 << 31, 20_000), keys)
    assert not table.get(others).any() and not table.get(keys[align.slot_of(keys, 5) == 4]).any()


def test_ids_are_written_small_and_dictionaries_dropped():
    of = align.Aligner(tokenizer_path(), piece_path())
    texts = ["some words", None, "more words there", "a\n b"]
    a, b, _ = of.encode(texts)
    got = align.Aligned.of_bytes(of, a, b)
    ids = [x.to_pylist() for x in got.ids()]
    assert [[2 * len(x) for x in side] for side in ids] == [list(map(len, side)) for side in (a, b)]
    again = align.Aligned.of_bytes(of, *ids, of.written_as)
    assert all((x == y).all() for x, y in zip(got.pairs(), again.pairs(), strict=True))
    of.forget()
    assert not of.code and not any(of.a.known.values()) and of.encode(texts)[:2] == (a, b)
