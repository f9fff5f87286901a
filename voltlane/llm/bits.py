"""Pairs of bit sketches within a Hamming distance, inside groups of a sorted table."""

from collections.abc import Callable

import numpy as np

from voltlane.llm.cells import linked_roots

PAIRWISE = 64
PART = 1024


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of sketches whose last axis has their 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


def _apart(bits: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count(word[:, None] ^ word[None, :]).astype(np.int16) for word in bits.T)


def near_edges(
    starts: np.ndarray, bits: np.ndarray, ids: np.ndarray, most: int, also: Callable | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Edges (u, v) of ids between rows of a group whose ``bits`` (rows of words) differ in at most ``most`` places, and
    for which ``also`` holds, which takes the rows of both sides of the pairs.

    In groups of up to ``PAIRWISE`` rows all pairs are tried, for the whole table at once, by distance in it. In larger
    ones every row gets an edge to the least row that it reaches. So there are never more edges than candidates."""
    rows = len(ids)
    size = np.diff(np.append(starts, rows))
    ahead = np.repeat(np.append(starts[1:], rows), size) - np.arange(rows) - 1
    ahead[np.repeat(size > PAIRWISE, size)] = 0
    u, v = [ids[:0]], [ids[:0]]
    here = np.flatnonzero(ahead > 0)
    for d in range(1, PAIRWISE):
        here = here[ahead[here] >= d]
        if not len(here):
            break
        near = here[distance(bits[here], bits[here + d]) <= most]
        if also is not None:
            near = near[also(near, near + d)]
        u.append(ids[near])
        v.append(ids[near + d])
    large = size > PAIRWISE
    for a, n in zip(starts[large].tolist(), size[large].tolist()):
        # Any two parts of a large group meet once.
        parts = np.array_split(np.arange(a, a + n), -(-n // PART))
        for k, one in enumerate(parts):
            for other in parts[k + 1 :] or ([one] if len(parts) == 1 else []):
                own = np.union1d(one, other)
                links = _apart(bits[own]) <= most
                if also is not None:
                    x, y = np.nonzero(np.triu(links, 1))
                    good = also(own[x], own[y])
                    links[:] = False
                    links[x[good], y[good]] = links[y[good], x[good]] = True
                root = linked_roots(links)
                u.append(ids[own])
                v.append(ids[own][root])
    u, v = np.concatenate(u), np.concatenate(v)
    return u[u != v], v[u != v]
