import random

import numpy as np
import pytest

from voltlane.llm import components as module
from voltlane.llm import embedding_dedup, line_dedup, ngram_join
from voltlane.llm.components import components
from voltlane.scratch import staged_at


def expected(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(1, 1)],
        [(k, k + 1) for k in range(60)],
        [(0, k) for k in range(1, 300)] + [(299, 500), (500, -7)],
        [(random.Random(k).randrange(120), random.Random(-k).randrange(120)) for k in range(90)],
    ],
)
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges * 2, "u long, v long")).collect()
    assert {r.node: r.component for r in found} == expected(edges)
    assert len(found) == len(expected(edges))


@pytest.mark.parametrize("part", [1, 7])
def test_components_over_parts_of_the_edges(spark, monkeypatch, part):
    """Stars of a few edges at a time leave most of the work to the rounds."""
    monkeypatch.setattr(module, "PART", part)
    rng = random.Random(part)
    edges = [(k, k + 1) for k in range(40)] + [(rng.randrange(100, 180), rng.randrange(100, 180)) for _ in range(60)]
    rng.shuffle(edges)
    table = spark.createDataFrame(edges, "u long, v long").repartition(5)
    assert {r.node: r.component for r in components(table).collect()} == expected(edges)


def test_roots():
    rng = np.random.default_rng(3)
    for nodes, edges in ((1, 0), (50, 10), (50, 60), (2000, 1500)):
        a, b = rng.integers(0, nodes, (2, edges))
        root, wanted = module._roots(a, b, nodes), expected([*zip(a.tolist(), b.tolist())])
        assert root.tolist() == [wanted.get(k, k) for k in range(nodes)]


def python_operators_in_a_row(plan: str) -> int:
    """The most Python operators of a plan that no shuffle or broadcast stands between; each takes a worker per task."""
    most = here = 0
    for line in plan.splitlines():
        if "Exchange" in line or "Scan" in line:
            here = 0
        elif "MapInArrow" in line:
            here += 1
            most = max(most, here)
    return most


@pytest.mark.parametrize("operator", ["lines", "sets", "vectors"])
def test_a_task_has_one_python_worker(spark, monkeypatch, operator):
    written = []

    def kept(df, label):
        written.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return staged_at(df, label)

    monkeypatch.setattr(module, "staged_at", kept)
    texts = [(k, f"one two three four five six seven eight nine ten eleven twelve\nline {k // 2} of ten words that are the same here") for k in range(8)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    vectors = spark.createDataFrame([(k, [1.0, float(k // 2), 2.0]) for k in range(8)], "vec_id long, embedding array<double>")
    found = {
        "lines": lambda: line_dedup.line_groups(docs).filter("kept"),
        "sets": lambda: ngram_join.ngram_join(docs).filter("kept"),
        "vectors": lambda: embedding_dedup.near_vectors(vectors).filter("kept"),
    }[operator]()
    assert 0 < found.count() < 16
    edges = [plan for label, plan in written if label == "edges"]
    assert len(edges) == 2 and "MapInArrow" in edges[0]
    assert [python_operators_in_a_row(plan) for _, plan in written if "MapInArrow" in plan] == [1] * sum("MapInArrow" in p for _, p in written)
