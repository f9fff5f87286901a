"""Word hashes and word-shingle sets of whole texts, vectorised.

Words are runs of anything but blanks (space, tab to carriage return), lower-cased. A word's 64-bit hash is a
polynomial of its bytes, taken for all words at once from a running sum, and mixed."""

from functools import lru_cache

import numpy as np

N = 5
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i below 2 ** bits."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        power = np.ones(1 << bits, dtype=np.uint64)
        for b in range(bits):
            power[1 << b : 2 << b] = power[: 1 << b] * np.uint64(pow(base, 1 << b, 1 << 64))
        out.append(power)
    return out[0], out[1]


def word_hashes_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """The lower-cased texts' bytes, each text closed by a blank; where words start and end in them; the words' hashes;
    where texts end, their blank included."""
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
    power, inverse = _powers(max(16, int(len(data)).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * power[: len(data)], dtype=np.uint64)])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return data, starts, ends, hashes, np.cumsum([len(p) + 1 for p in parts])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words of each text."""
    _, starts, _, hashes, text_ends = word_hashes_of(texts)
    return hashes, np.diff(np.searchsorted(starts, text_ends), prepend=0)


def shingle_sets(texts: list[str], n: int = N) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text. A text of fewer words has one shingle, all of
    them; a text without a word has none."""
    words, count = word_hashes(texts)
    ends = np.cumsum(count)
    out = []
    if len(words) >= n:
        total = np.zeros(len(words) - n + 1, dtype=np.uint64)
        for k in range(n):
            total += words[k : len(words) - n + 1 + k] * _PLACES[k]
        windows = mix(total)
    for start, end in zip((ends - count).tolist(), ends.tolist()):
        if end - start >= n:
            out.append(np.unique(windows[start : end - n + 1]))
        elif end > start:
            own = (words[start:end] * _PLACES[: end - start]).sum(dtype=np.uint64) + np.uint64(end - start)
            out.append(mix(np.array([own], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
