import numpy as np
import pytest

from voltlane.llm import embedding_dedup, nearest
from voltlane.llm.vectors import cosine

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, "clash") for i, v in rows], SCHEMA)


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def made_vectors(d=64, n=300, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        x = rng.standard_normal(d)
        rows.append(x)
        for _ in range(k % 4):
            rows.append(x + rng.standard_normal(d) * np.linalg.norm(x) / np.sqrt(d) * rng.uniform(0.1, 0.5))
    order = rng.permutation(len(rows))
    return [(i, rows[k].astype(np.float32).tolist()) for i, k in enumerate(order)]


ODD = [
    (5000, None),
    (5001, []),
    (5002, [0.0] * 64),
    (5003, [float("nan")] + [1.0] * 63),
    (5004, [None] + [1.0] * 63),
    (5005, [float("inf")] + [1.0] * 63),
    (5006, [1.0, 2.0]),
    (5050, [1.0, 2.0]),
    (5051, [2.0, 4.0]),
    (5100, [1e30] * 64),
    (5101, [1e-30] * 64),
    (5102, [1e-30] * 64),
    (None, [1.0] * 64),
]


def brute_links(rows):
    ids = [i for i, v in rows if i is not None]
    own = {k: (i, np.array(v, dtype=np.float64)) for k, (i, v) in enumerate(rows) if i is not None and good(v)}
    links, parent = dict.fromkeys(range(len(rows)), 0), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = list(own)
    for a in range(len(keys)):
        for b in range(a):
            x, y = own[keys[a]][1], own[keys[b]][1]
            if len(x) == len(y) and cosine(x[None], y[None])[0] >= 0.95:
                links[keys[a]] += 1
                links[keys[b]] += 1
                p, q = find(keys[a]), find(keys[b])
                parent[q] = p
    least = {}
    for k in own:
        least[find(k)] = min(own[k][0], least.get(find(k), own[k][0]))
    assert len(ids) >= len(own)
    return sorted(
        (i, links[k], least[find(k)] if k in own else i) for k, (i, v) in enumerate(rows) if i is not None
    )


def test_near_vectors_equal_brute_force(spark):
    rows = made_vectors() + ODD
    found = embedding_dedup.near_vectors(table(spark, rows)).collect()
    assert len(found) == len(rows)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id is not None)
    assert got == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)
    assert [(r.n_links, r.component_id) for r in found if r.vec_id is None] == [(0, None)]


def test_copies_and_crowds_in_cells(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 8)
    rng = np.random.default_rng(2)
    x = rng.standard_normal(16)
    rows = [(k, x.astype(np.float32).tolist()) for k in range(30)]
    rows += [(30 + k, (x + rng.standard_normal(16) * 0.1).astype(np.float32).tolist()) for k in range(40)]
    found = embedding_dedup.near_vectors(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute_links(rows)


@pytest.mark.parametrize("d", [1, 2, 3, 9, 40, 256])
def test_filters_of_any_length_find_pairs_at_the_threshold(d):
    rng = np.random.default_rng(d)
    code = embedding_dedup.Code(d, 20_000)
    x = rng.standard_normal((400, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((400, d))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
    y = x if d == 1 else 0.951 * x + np.sqrt(1 - 0.951**2) * y
    sets = []
    for v in (x, y):
        own = [set() for _ in range(400)]
        for r, f in zip(*code.passes(v)):
            own[r].add(int(f))
        sets.append(own)
    assert np.mean([bool(a & b) for a, b in zip(*sets)]) > 0.98
    assert min(map(len, sets[0])) >= min(embedding_dedup.LEAST, 1)


def brute_nearest(rows, ask, k=5):
    own = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and good(v)]
    out = {}
    for i, x in own:
        if ask(i):
            near = [(-cosine(x[None], y[None])[0], j) for j, y in own if j != i and len(x) == len(y)]
            out[i] = sorted((-s, j) for s, j in near) if False else sorted(near)[:k]
    return out


def answers(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_nearest_recall_and_scores(spark):
    rows = made_vectors(d=24, n=700) + ODD
    found = answers(nearest.nearest(table(spark, rows), nearest.F.col("vec_id") % 50 == 0).collect())
    true = brute_nearest(rows, lambda i: i % 50 == 0)
    assert found.keys() == {i for i, near in true.items() if near}
    hits = sum(len({j for _, j in found[i]} & {j for _, j in near}) for i, near in true.items() if near)
    assert hits / sum(map(len, true.values())) >= 0.9
    vectors = {i: np.array(v) for i, v in rows if good(v)}
    for i, near in found.items():
        assert near == sorted(near) and len(near) == len(true[i])
        assert all(-s == cosine(vectors[i][None], vectors[j][None])[0] for s, j in near)


def test_nearest_with_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 50)
    x = np.random.default_rng(3).standard_normal(8)
    rows = [(k, x.tolist()) for k in range(200)] + [(200 + k, (-x).tolist()) for k in range(100)]
    found = answers(nearest.nearest(table(spark, rows), nearest.F.col("vec_id") % 50 == 0).collect())
    assert found == brute_nearest([(i, np.float32(v).tolist()) for i, v in rows], lambda i: i % 50 == 0)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (51, [0.0, 1.0])]
    found = answers(nearest.nearest(table(spark, rows), nearest.F.col("vec_id") % 50 == 0).collect())
    assert [[j for _, j in found[i]] for i in (0, 50)] == [[50, 51], [0, 51]]
    for none in (table(spark, []), table(spark, ODD[:6])):
        assert nearest.nearest(none, nearest.F.col("vec_id") % 50 == 0).count() == 0
        assert embedding_dedup.near_vectors(none).count() == none.count()


def test_balanced_parts():
    x = np.random.default_rng(4).standard_normal((600, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = nearest.neighbour_graph(x, 8)
    part = nearest.balanced_parts(x, graph, 7)
    size = np.bincount(part, minlength=7)
    assert size.min() > 0 and size.max() <= 1.1 * 600 / 7 + 2
    random_cut = np.mean([part[np.random.default_rng(k).permutation(600)][graph] != part[:, None] for k in range(3)])
    assert (part[graph] != part[:, None]).mean() < 0.75 * random_cut
