import hashlib
import math

import numpy as np
import pytest
from oracle import connect, spark_rows, sql_rows

from voltlane.llm import vector_codes

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, id double, vector int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "clash", "clash", 0.5, 7) for i, v, k in rows], SCHEMA)


def cut(v, width):
    """The 16 parts of a vector as whole numbers, in Python."""
    own = max(1, -(-len(v) // 16))
    w = [min(max(math.floor(256 * float(np.float32(x))), -vector_codes.MOST), vector_codes.MOST) for x in v]
    parts = [w[k * own : (k + 1) * own] for k in range(16)]
    return [p + [0] * (width - len(p)) for p in parts]


def away(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def brute(rows):
    """(id, code, error, label_error) of each row, and the codebooks' hash."""
    good = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max([1] + [-(-len(v) // 16) for _, v, _ in good])
    own = [cut(v, width) for _, v, _ in good]
    first = {}
    for n, (i, v, _) in enumerate(good):
        if i is not None and (i not in first or v < good[first[i]][1]):
            first[i] = n
    seeds = [own[first[i]] for i in sorted(first)[:64]] or [[[0] * width] * 16]
    books = [[s[p] for s in seeds] for p in range(16)]

    def nearest():
        return [[min((away(x[p], e), k) for k, e in enumerate(books[p])) for p in range(16)] for x in own]

    for _ in range(2):
        found = nearest()
        for p in range(16):
            for k in range(len(books[p])):
                mine = [x[p] for x, f in zip(own, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = nearest()
    errors = [min(sum(d for d, _ in f), vector_codes.LONGEST) for f in found]
    by_label = {}
    for (_, _, label), e in zip(good, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = [
        (i, "".join(f"{k:02x}" for _, k in f), e, min(by_label[label], vector_codes.LONGEST))
        for (i, _, label), f, e in zip(good, found, errors)
    ]
    return sorted(out, key=repr), sha


def run(spark, rows):
    coded, books = vector_codes.encode(table(spark, rows))
    found = vector_codes.with_label_error(coded).collect()
    return sorted(((r.vec_id, r.code.hex(), r.error, r.label_error) for r in found), key=repr), books.sha256()


def made(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * 0.15 + rng.standard_normal((8, d))[rng.integers(0, 8, n)] * 0.3
    return [(int(i), row.tolist(), [0, 1, 2, None][k % 4]) for k, (i, row) in enumerate(zip(rng.permutation(n * 3), x.astype(np.float32)))]


@pytest.mark.parametrize("d", [16, 32, 64])
def test_codes_equal_brute_force(spark, d):
    rows = made(400, d, d)
    assert run(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = made(150, 32, 1) + [
        (-1, None, 1), (-2, [float("nan")] + [0.0] * 31, 1), (-3, [None] + [0.0] * 31, 1), (-4, [float("inf")] * 32, None),
        (-5, [0.0] * 32, None), (-6, [], 9), (-7, [0.25] * 5, 9), (-8, [0.5] * 40, 9), (None, [0.1] * 32, None),
        (-9, [1e30] * 32, 3), (-10, [-1e30] * 32, 3), (-11, [70_000.0] * 32, 3), (-5, [0.1] * 32, None), (-5, [0.0] * 32, None),
    ]
    found = run(spark, rows)
    assert found == brute(rows)
    # 16 parts of three components, each 2^37 apart from the others' mean, are more than a long.
    assert max(r[2] for r in found[0]) <= vector_codes.LONGEST


def test_copies_ties_and_few_rows(spark):
    rows = [(k, [0.1 * (k % 3)] * 16, 0) for k in range(100)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:5]) == brute(rows[:5])
    # Between two entries at the same distance, the lower one.
    rows = [(0, [2 / 256] * 16, 0), (1, [0.0] * 16, 0), (2, [1 / 256] * 16, 0), (None, [1 / 256] * 16, 0)]
    assert run(spark, rows) == brute(rows)
    rows = [(None, [0.5] * 16, None), (None, [0.25] * 16, None)]
    assert run(spark, rows) == brute(rows)


def test_no_rows(spark):
    for rows in ([], [(1, None, 0)]):
        assert run(spark, rows)[0] == []


def test_many_labels_are_salted(spark, monkeypatch):
    rows = made(200, 16, 3)
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    assert run(spark, rows) == brute(rows)


def test_balls_compare_less_and_agree(monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.integers(-200, 200, (64, 4))
    x = centres[rng.integers(0, 64, 5000)] + rng.integers(-9, 10, (5000, 4))
    entries, own = (a.astype(float) for a in (centres, x))
    first = vector_codes.squared_all(own, entries).argmin(axis=1)
    moved = np.array([own[first == k].mean(axis=0) if (first == k).any() else entries[k] for k in range(64)])
    moved = np.floor(moved)
    away = vector_codes.squared(own, entries[first])
    reach = np.array([away[first == k].max(initial=0) for k in range(64)])
    radius = np.sqrt(reach) + np.sqrt(vector_codes.squared(moved, entries))
    balls = vector_codes.Balls(moved, radius)
    entry, d, compared = balls.nearest(own, first)
    all_of_them = vector_codes.squared_all(own, moved)
    assert np.array_equal(entry, all_of_them.argmin(axis=1)) and np.array_equal(d, all_of_them.min(axis=1))
    assert compared < 0.1 * 5000 * 63
    # Every row is inside its ball, and some entries have no neighbour that could win anything.
    assert (vector_codes.squared(own, moved[first]) <= radius[first] ** 2 * (1 + 1e-9)).all()


def test_query_equals_sql(spark):
    assert spark_rows(vector_codes.op12(spark, FOLDER)) == sql_rows(connect(FOLDER), vector_codes.SQL)
