"""Near-duplicate and nearest-neighbour operators against brute force on small tables."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kairopanel.llm import ann, lattice, simhash, vectors
from kairopanel.llm.components import connected_components


def closure(ids, linked):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_components(spark):
    g = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in g.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = closure(nodes, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_fingerprint(text):
    table = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    w = (text or "").encode().translate(table).split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def texts(g, n=40):
    vocab = [f"w{i}É" for i in range(50)]
    out = []
    for _ in range(n):
        t = [vocab[k] for k in g.integers(0, 50, 80)]
        out.append(" ".join(t))
        for _ in range(2):
            u = list(t)
            u[g.integers(80)] = "Changed"
            out.append(" ".join(u))
    return [*out, *out[:3], None, "", " \t", "one", "One", "two words", "\x0b\x1cx", "long " * 5000]


def test_simhash(spark):
    rows = list(enumerate(texts(np.random.default_rng(1))))
    rows.append((5, rows[5][1]))  # a repeated row
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fp string, component_id string")
    got = simhash.near_duplicates(docs).collect()
    prints = {i: brute_fingerprint(t) for i, t in rows}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = closure(list(prints), linked)
    assert len(got) == len(rows) and linked
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id]


def test_simhash_hot_groups_are_cut(spark):
    g = np.random.default_rng(2)
    base = g.integers(0, 2**62, 30)
    x = np.unique(np.concatenate([base ^ (1 << int(b)) for b in range(0, 60, 3)] + [base]))
    fps = spark.createDataFrame([(int(v),) for v in x], "fp long")
    wide = connected_components(simhash.links(fps, most=16)).collect()
    d = np.bitwise_count(x[:, None] ^ x[None, :])
    i, j = np.nonzero((d <= 3) & (d > 0))
    want = closure([int(v) for v in x], [(int(x[a]), int(x[b])) for a, b in zip(i, j, strict=True)])
    assert {r.node: r.root for r in wide} == {k: v for k, v in want.items() if any(k in (int(x[a]), int(x[b])) for a, b in zip(i, j, strict=True))}


def test_trie_pairs():
    g = np.random.default_rng(3)
    base = g.integers(0, 2**63, 100).astype(np.uint64)
    x = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40), np.arange(64, dtype=np.uint64)]))
    i, j = (np.concatenate(c) for c in zip(*simhash.trie_pairs(x, np.array([0, len(x)]), np.array([-1]), 3, cap=50), strict=True))
    d = np.bitwise_count(x[:, None] ^ x[None, :])
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(d <= 3, 1)), strict=True)}
    assert {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)} == {(int(a), int(b)) for a, b in want} and len(i) == len(want)


def test_trie_pairs_of_the_upper_bits():
    g = np.random.default_rng(9)
    x = np.sort(g.integers(0, 2**20, 400).astype(np.uint64) << np.uint64(44) | g.integers(0, 2**32, 400).astype(np.uint64))
    x = np.concatenate([x, x[:200]])  # two runs
    near = lambda a, b: np.bitwise_count((a[:, None] ^ b[None, :]) >> np.uint64(32)) <= 3
    for role, want in (([-1, -1], None), ([0, 1], near(x[:400], x[400:]))):
        got = [p for i, j in simhash.trie_pairs(x, np.array([0, 400, 600]), np.array(role), 3, 32, cap=64) for p in zip(i.tolist(), j.tolist(), strict=True)]
        if want is None:
            pairs = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near(x[:400], x[:400]), 1)), strict=True)}
            pairs |= {(int(a) + 400, int(b) + 400) for a, b in zip(*np.nonzero(np.triu(near(x[400:], x[400:]), 1)), strict=True)}
        else:
            pairs = {(int(a), int(b) + 400) for a, b in zip(*np.nonzero(want), strict=True)}
        assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == pairs


def test_spanning():
    g = np.random.default_rng(10)
    i, j = g.integers(0, 300, 2000), g.integers(0, 300, 2000)
    a, b = simhash.spanning(300, i, j)
    assert (simhash.forest(300, a, b) == simhash.forest(300, i, j)).all()
    assert len(a) == 300 - len(np.unique(simhash.forest(300, i, j))) and set(zip(a.tolist(), b.tolist())) <= set(zip(i.tolist(), j.tolist()))


def vectors_frame(spark, seed=4):
    g = np.random.default_rng(seed)
    base = g.normal(size=(60, 16))
    near = base[:30] + 0.08 * g.normal(size=(30, 16))
    rows = [[float(x) for x in v] for v in np.concatenate([base, near, base[:10]])]
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] + [0.0] * 14, [float("inf")] + [1.0] * 15, [1.0] * 8, [2.0] * 8]
    return rows, spark.createDataFrame([(i, r, "x") for i, r in enumerate(rows)], "vec_id long, embedding array<float>, node string")


def usable(r):
    return r is not None and len(r) > 0 and all(x is not None and np.isfinite(x) for x in r) and any(r)


def cosine(a, b):
    a, b = np.float32(a).astype(float), np.float32(b).astype(float)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


@pytest.mark.parametrize("most", [2048, 8])
def test_lattice(spark, most):
    rows, df = vectors_frame(spark)
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if usable(rows[a]) and usable(rows[b]) and len(rows[a]) == len(rows[b]) and cosine(rows[a], rows[b]) >= 0.95]
    want = closure(range(len(rows)), linked)
    got = {r.vec_id: r for r in lattice.near_duplicates(df, most=most).collect()}
    assert len(got) == len(rows) and len(linked) > 30
    for i, r in got.items():
        assert r.n_links == sum(i in p for p in linked) and r.component_id == want[i] and r.kept == (want[i] == i)


def test_lattice_points():
    p = lattice.ROOTS
    assert p.shape == (240, 8) and np.allclose((p * p).sum(1), 2)
    g = np.random.default_rng(5)
    y = g.normal(size=(200, 8)) * 2
    d = lattice.decode(y)
    assert (((y - d) ** 2).sum(1) <= 1 + 1e-9).all()  # the covering radius of E8 is 1
    assert all((((y - d - r) ** 2).sum(1) >= ((y - d) ** 2).sum(1) - 1e-9).all() for r in p)


def test_ann(spark):
    rows, df = vectors_frame(spark, 6)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 7 == 0, k=5).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = total = 0
    for q in range(0, len(rows), 7):
        if not usable(rows[q]):
            assert q not in got
            continue
        every = sorted((-cosine(rows[q], rows[i]), i) for i in range(len(rows)) if i != q and usable(rows[i]) and len(rows[i]) == len(rows[q]))[:5]
        mine = got.get(q, {})
        assert sorted(mine) == list(range(1, len(mine) + 1)) and len(mine) <= len(every)
        for rank in mine:
            assert mine[rank][1] == pytest.approx(cosine(rows[q], rows[mine[rank][0]]), abs=1e-12) and mine[rank][0] != q
        assert [v for _, v in sorted(mine.items())] == sorted(mine.values(), key=lambda x: (-x[1], x[0]))
        hit += sum(-every[-1][0] <= s + 1e-12 for _, s in mine.values())
        total += len(every)
    assert hit / total >= 0.9
    assert ann.search(df.limit(0), F.col("vec_id") % 7 == 0).count() == 0


def test_ann_ties_and_repeated_ids(spark):
    g = np.random.default_rng(12)
    base = np.float32(g.normal(size=16))
    rows = [(i, [float(x) for x in base * np.float32(2.0) ** (i % 40 - 20)]) for i in range(40)]
    rows = rows[::-1] + [(100 + i, [float(x) for x in np.float32(v)]) for i, v in enumerate(g.normal(size=(300, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.rank, r.vec_id, r.score) for r in ann.search(df, F.col("vec_id") == 30).collect())
    assert [v for _, v, _ in got] == [0, 1, 2, 3, 4] and len({s for *_, s in got}) == 1
    two = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 3)) for r in ann.search(two, F.col("vec_id") == 1).collect())
    assert got == [(1, 1, 1, 0.994), (1, 1, 1, 0.994), (1, 2, 2, 0.0), (1, 2, 2, 0.11)]
    same = lattice.near_duplicates(two.where("vec_id = 1")).collect()
    assert [(r.n_links, r.component_id) for r in same] == [(1, 1), (1, 1)]


def test_lattice_memory_of_a_hot_cell():
    import tracemalloc

    g = np.random.default_rng(13)
    x = g.normal(size=256) + 0.05 * g.normal(size=(2048, 256))
    own, near = lattice.cells(vectors.unit(x), 1, 4, 0.01, 11)
    n = np.ones(len(x), np.int64)
    tracemalloc.start()
    _, root, links = lattice._linked(x, np.arange(len(x)), n, np.zeros(len(x), np.int64), 0 * n, own, near.reshape(len(x), -1), False, 0.95)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    c = vectors.unit(x) @ vectors.unit(x).T >= 0.95
    same = own == own.T
    assert (links == ((c & same).sum(1) - 1)[(c & same).sum(1) > 1]).all() and (root == 0).all() and peak < 200 << 20


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0 and simhash.deduplicate(docs).count() == 0
    assert lattice.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_hashes_are_stable():
    assert vectors.mix(np.array([1, 2]), np.array([3])).tolist() == vectors.mix(np.array([1, 2]), np.array([3, 3])).tolist()
