import random
import re
from collections import Counter

import pytest
from messy import docs, no_docs, words

from voltlane.llm import ngram_join, shingles


def plain_sets(texts, n=5):
    out = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower()) if text else []
        out.append({tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))} if w else set())
    return out


def brute_force(rows):
    """(class, links) of each row of (doc_id, text), all pairs compared."""
    sets, links, parent = plain_sets([t for _, t in rows]), Counter(), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows))


def result(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_join(table).collect())


def families(seed, n):
    """Chains of copies of growing distance, so that pairs lie on both sides of the threshold."""
    rng, out = random.Random(seed), []
    for f in range(n):
        text = words(seed * 100 + f, rng.randint(4, 120)).split()
        for _ in range(rng.randint(1, 6)):
            out.append(" ".join(text))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = f"new{rng.random()}"
    rng.shuffle(out)
    return list(enumerate(out))


def test_sets_equal_plain_shingles():
    texts = [t for _, t in families(1, 40)] + ["", " ", "a", "A  b\tc\nd", "a b c d e", "é ß　x y z w", words(5, 3000)]
    plain, own = plain_sets(texts), shingles.shingle_sets(texts)
    for a in range(len(texts)):
        assert len(own[a]) == len(plain[a])
        for b in range(a):
            assert len(set(own[a].tolist()) & set(own[b].tolist())) == len(plain[a] & plain[b])


def test_equals_brute_force(spark):
    rows = families(2, 60)
    expected = brute_force(rows)
    assert sum(links > 0 for _, _, links in expected) > 60
    assert result(spark, rows) == expected


def test_recursion_and_cells(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIMIT", 3)
    monkeypatch.setattr(ngram_join, "CELL", 3)
    text = words(9, 200).split()
    rows = []
    for k in range(25):  # all alike, but each its own text
        own = list(text)
        own[k * 8] = f"own{k}"
        rows.append((k, " ".join(own)))
    rows += [(100 + k, t) for k, t in families(3, 8)]
    assert result(spark, rows) == brute_force(rows)


def test_runs():
    assert ngram_join.runs_needed(0.8, 0.9) < ngram_join.runs_needed(0.8, 0.999)
    # One level meets with 1 - (1 - 1/64)**64; so many runs fall short of the recall by one at most.
    miss = (1 - 1 / 64) ** 64
    assert miss ** ngram_join.runs_needed(0.8, 0.99, depth=1) <= 0.01 < miss ** (ngram_join.runs_needed(0.8, 0.99, depth=1) - 1)


def test_shared_counts_by_blocks():
    sets = [s for s in shingles.shingle_sets([t for _, t in families(4, 12)])]
    whole = ngram_join.shared_counts(sets)
    assert (whole == ngram_join.shared_counts(sets, block=1)).all()
    assert all(whole[a, b] == len(set(sets[a].tolist()) & set(sets[b].tolist())) for a in range(len(sets)) for b in range(a))


def test_messy_rows(spark):
    table = docs(spark)
    rows = ngram_join.ngram_join(table).collect()
    assert len(rows) == table.count()
    named = [(r.doc_id, r.text) for r in table.collect() if r.doc_id is not None]
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in rows if r.doc_id is not None) == brute_force(named)
    assert all((r.class_id, r.n_links, r.kept) == (None, 0, True) for r in rows if r.doc_id is None)
    left = ngram_join.representatives(table)
    assert left.columns == table.columns
    kept = {i for i, c, _ in brute_force(named) if i == c}
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(kept)


@pytest.mark.parametrize("run", [ngram_join.ngram_join, ngram_join.representatives])
def test_empty_table(spark, run):
    assert run(no_docs(spark)).count() == 0


def test_one_doc_id_with_several_texts(spark):
    """A text goes only if another text stands for it, whatever else its doc_id holds."""
    a, b, c, d = (words(20 + k, 40) for k in range(4))
    near = a.rsplit(" ", 1)[0] + " other"
    rows = [
        (0, a), (1, near), (1, b), (2, c), (2, c + " more"), (2, d), (2, d), (3, b.upper()), (4, None), (4, ""), (4, d),
        (5, a), (5, near), (6, c.upper() + " "), (7, words(30, 40)),
    ]
    table = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, sid int")
    found = ngram_join.ngram_join(table.select("doc_id", "text")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found) == brute_force(rows)
    left = ngram_join.representatives(table)
    assert left.columns == table.columns
    got = Counter((r.doc_id, r.text) for r in left.collect())
    # Of c and c with a word more, one stays.
    of_c = {t for i, t in got if i == 2 and t != d}
    assert len(of_c) == 1 and of_c < {c, c + " more"}
    assert got - Counter({(2, t): 1 for t in of_c}) == Counter(
        [(0, a), (1, b), (2, d), (4, None), (4, ""), (7, words(30, 40))]
    )


def test_edges_of_two_blocks_connect_what_is_linked():
    rng = random.Random(8)
    np = ngram_join.np
    for n in (2, 9, 40):
        linked = np.array([[rng.random() < 2 / n for _ in range(n)] for _ in range(n)])
        linked |= linked.T
        np.fill_diagonal(linked, False)
        side = np.array([k % 2 for k in range(n)])
        edges = set()
        # The cells of each block, then that of both.
        for own in (side == 0, side == 1):
            rows = np.flatnonzero(own)
            root = ngram_join.spanning(linked[np.ix_(rows, rows)], np.zeros(len(rows), dtype=int))
            edges |= {(int(rows[k]), int(rows[r])) for k, r in enumerate(root)}
        both = ngram_join.spanning(linked, side)
        edges |= {(k, int(r)) for k, r in enumerate(both)}
        joined = np.zeros((n, n), dtype=bool)
        for u, v in edges:
            joined[u, v] = joined[v, u] = u != v
        assert np.array_equal(ngram_join.linked_roots(joined), ngram_join.linked_roots(linked))
    # A block each of things that are all alike: one edge.
    alike = ngram_join.spanning(~np.eye(20, dtype=bool), np.array([0] * 10 + [1] * 10))
    assert (alike != np.arange(20)).sum() == 1
