"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Text is escaped (blank to U+2581, one in front) and cut before each run of U+2581; no piece of such a vocabulary
has that mark after another character, so no merge crosses a cut. Each distinct segment is encoded once per few
megabytes of text. The agenda holds the scores of a segment's adjacent symbol pairs; its best pair, the leftmost of
equals, is merged until none is in the vocabulary. Segments of up to ``WIDEST`` symbols go through the agenda side by
side, as rows of a matrix; longer ones use a heap. Symbols outside the vocabulary become byte pieces.

Every distinct segment is checked against the sentencepiece library within the batch; the library's ids win, and the
number of differing segments is reported.
"""

import heapq
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlane.llm.arrow import bounded, slices, strings

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")
WIDEST = 24
HELD = 250_000
NONE = -1
STRANGE = 1 << 22  # characters outside the vocabulary are this plus their code
ENCODED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
        T.StructField("n_differing", T.LongType()),
    ]
)


class Pieces:
    """One vocabulary: its pieces, the table of pairs that merge, and the segments met of late."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, size = self.library, self.library.vocab_size()
        self.text = np.array([lib.id_to_piece(i) for i in range(size)], dtype=object)
        self.width = np.array([len(t) for t in self.text])
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.is_byte = np.zeros(size, dtype=bool)
        self.is_byte[list(self.byte_of)] = True
        ids = {self.text[i]: i for i in plain}
        self.symbol = np.arange(0x110000, dtype=np.int64) + STRANGE
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i

        def known(part):
            return ids.get(part) if len(part) > 1 else int(self.symbol[ord(part)])

        # Rank by score, best first; equal scores share a rank.
        scores = np.array([lib.get_score(i) for i in plain])
        rank = dict(zip(plain, np.unique(-scores, return_inverse=True)[1].tolist()))
        self.pairs = {}
        for piece, i in ids.items():
            for k in range(1, len(piece)):
                left, right = known(piece[:k]), known(piece[k:])
                if left is not None and right is not None:
                    self.pairs[(left << 32) | right] = (rank[i], i)
        self.pair_keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.pair_rank = np.array([self.pairs[k][0] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.pair_id = np.array([self.pairs[k][1] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.never = np.int32(np.iinfo(np.int32).max)
        self.forget()

    def forget(self):
        """Empty the table of segments: number by segment, ids one after another, where they begin, the segments that
        the library differed on, and the decoded text of those that don't decode to themselves."""
        self.held: dict[str, int] = {}
        self.flat, self.starts = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        self.differing: set[int] = set()
        self.decoded: dict[int, str] = {}

    # The agenda

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair's merge and the merged piece; ``never`` where the vocabulary has none."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], self.never), np.where(hit, self.pair_id[at], NONE)

    def agenda(self, symbols: np.ndarray) -> np.ndarray:
        """Merged symbols of segments of similar width, a row each, filled up with ``NONE``. All go in step: every
        round takes the best pair of each segment from its agenda, merges it and renews the two entries beside it."""
        width = symbols.shape[1] - 1
        rank, merged = self._rank_of(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        rank, merged = rank.reshape(-1, width), merged.reshape(-1, width)
        live, done = np.arange(len(symbols)), np.full(symbols.shape, NONE, dtype=np.int64)
        columns = np.arange(1, width + 1)
        while True:
            best = rank.argmin(axis=1)
            going = rank[np.arange(len(live)), best] != self.never
            done[live[~going]] = symbols[~going]
            live, symbols, rank, merged, best = (x[going] for x in (live, symbols, rank, merged, best))
            if not len(live):
                return done
            rows = np.arange(len(live))
            symbols[rows, best] = merged[rows, best]
            after = columns[None, :-1] > best[:, None]  # close the gap behind the merged pair
            np.copyto(symbols[:, 1:-1], symbols[:, 2:].copy(), where=after)
            np.copyto(rank[:, :-1], rank[:, 1:].copy(), where=columns[None, :-1] > best[:, None])
            np.copyto(merged[:, :-1], merged[:, 1:].copy(), where=columns[None, :-1] > best[:, None])
            symbols[:, -1], rank[:, -1], merged[:, -1] = NONE, self.never, NONE
            rank[rows, best], merged[rows, best] = self._rank_of(symbols[rows, best], symbols[rows, best + 1])
            left = best > 0
            r, b = rows[left], best[left] - 1
            rank[r, b], merged[r, b] = self._rank_of(symbols[r, b], symbols[r, b + 1])

    def heap(self, word: list[int]) -> list[int]:
        """The same agenda as a heap, for one long segment."""
        symbols, after = list(word), list(range(1, len(word) + 1))
        before = list(range(-1, len(word) - 1))
        agenda = []

        def add(i, j):
            if 0 <= i and j < len(symbols) and (found := self.pairs.get((symbols[i] << 32) | symbols[j])):
                heapq.heappush(agenda, (found[0], i, j, symbols[i], symbols[j], found[1]))

        for i in range(len(word) - 1):
            add(i, i + 1)
        while agenda:
            _, i, j, left, right, piece = heapq.heappop(agenda)
            if symbols[i] != left or symbols[j] != right or after[i] != j:
                continue
            symbols[i], symbols[j] = piece, NONE
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            add(before[i], i)
            add(i, after[i])
        return [s for s in symbols if s != NONE]

    # Segments

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments one after another, and how many each has."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = self.symbol[codes]
        size = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        start = np.cumsum(size) - size
        order = np.argsort(size, kind="stable")
        n_short = int(np.searchsorted(size[order], WIDEST, side="right"))
        done = []
        for at in range(0, n_short, 8192):
            some = order[at : min(at + 8192, n_short)]
            inside = np.arange(size[some].max() + 1) < size[some][:, None]
            rows = np.full(inside.shape, NONE, dtype=np.int64)
            rows[inside] = symbols[np.repeat(start[some], size[some]) + _within(size[some])]
            rows = self.agenda(rows)
            done.append((some, (rows != NONE).sum(axis=1), rows[rows != NONE]))
        for k in order[n_short:]:
            ids = self.heap(symbols[start[k] : start[k] + size[k]].tolist())
            done.append((np.array([k]), np.array([len(ids)]), np.array(ids, dtype=np.int64)))
        return _in_order(len(segments), done)

    def _spelled(self, flat: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary as byte pieces."""
        strange = flat >= STRANGE
        if not strange.any():
            return flat, n
        spelled = [[self.byte[b] for b in chr(i).encode("utf-8", "surrogatepass")] for i in (flat[strange] - STRANGE)]
        width = np.ones(len(flat), dtype=np.int64)
        width[strange] = [len(x) for x in spelled]
        out = np.repeat(flat, width)
        out[np.repeat(strange, width)] = list(chain.from_iterable(spelled))
        return out, np.add.reduceat(width, np.cumsum(n) - n)

    def _learn(self, segments: list[str]):
        """Encode new segments, check them against the library, and hold the ids."""
        flat, n = self._spelled(*self.merge(segments))
        first = len(self.held)
        theirs = self.library.encode([s[1:] for s in segments], num_threads=1)
        if MARK in segments:  # alone it is an empty text to the library
            theirs[segments.index(MARK)] = [int(self.symbol[ord(MARK)])]
        m = np.fromiter(map(len, theirs), dtype=np.int64, count=len(theirs))
        library = np.fromiter(chain.from_iterable(theirs), dtype=np.int64, count=m.sum())
        if not np.array_equal(m, n) or not np.array_equal(flat, library):
            own = np.split(flat, np.cumsum(n)[:-1])
            self.differing.update(first + k for k, ids in enumerate(theirs) if own[k].tolist() != ids)
            flat, n = library, m
        begin = np.cumsum(n) - n
        has_bytes = np.add.reduceat(self.is_byte[flat], begin) > 0
        odd = has_bytes | (np.add.reduceat(self.width[flat], begin) != np.fromiter(map(len, segments), np.int64, len(segments)))
        again = "".join(self.text[flat[~np.repeat(odd, n)]])
        if again != "".join([s for s, o in zip(segments, odd.tolist()) if not o]):
            odd[:] = True
        for k in np.flatnonzero(odd).tolist():
            text = self.decode(flat[begin[k] : begin[k] + n[k]].tolist())
            if text != segments[k].replace(MARK, " "):
                self.decoded[first + k] = text
        self.held.update(zip(segments, range(first, first + len(segments))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(n)])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])

    def decode(self, ids: list[int]) -> str:
        """Text of a segment's ids with its first blank: byte pieces joined as UTF-8, marks as blanks."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.text[i] for i in ids]).replace(MARK, " ")
        parts = [bytes([self.byte_of[i]]) if i in self.byte_of else self.text[i].encode() for i in ids]
        return b"".join(parts).decode("utf-8", "replace").replace(MARK, " ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], list[int]]:
        """All ids one after another; of each text their number, what they decode to, and the differing segments."""
        if len(self.held) > HELD:
            self.forget()
        cut = [SEGMENT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list({s for segs in cut for s in segs}.difference(self.held))
        for at in range(0, len(new), 65_536):
            self._learn(new[at : at + 65_536])
        held = self.held
        rows = [[held[s] for s in segs] for segs in cut]
        number = np.fromiter(chain.from_iterable(rows), dtype=np.int64)
        n = np.diff(self.starts)[number]
        ids = self.flat[np.repeat(self.starts[number], n) + _within(n)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(int)]
        texts_again = []
        for segs, row in zip(cut, rows):
            if self.decoded and not self.decoded.keys().isdisjoint(row):
                segs = [self.decoded.get(k, s) for k, s in zip(row, segs)]
            texts_again.append("".join(segs).replace(MARK, " ")[1:])
        differing = [sum(k in self.differing for k in row) if self.differing else 0 for row in rows]
        return ids, np.diff(ends), texts_again, differing


def _in_order(count: int, done: list) -> tuple[np.ndarray, np.ndarray]:
    """Parts (numbers of segments, their lengths, their ids) as one array in the order of the segments."""
    n = np.zeros(count, dtype=np.int64)
    for some, lengths, _ in done:
        n[some] = lengths
    begin, flat = np.cumsum(n) - n, np.empty(n.sum(), dtype=np.int64)
    for some, lengths, ids in done:
        flat[np.repeat(begin[some], lengths) + _within(lengths)] = ids
    return flat, n


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, … within each of the runs of lengths ``n``."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


@cache
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, path: str | None = None, name: str = "encoded") -> DataFrame:
    """``docs`` with a struct ``name``: ids of each whole text, the text decoded from them, and the number of segments
    in which the library differed.

    Null counts as the empty text: no ids, empty text. Equal texts have equal ids. ``path`` is a sentencepiece model
    of type BPE with byte fallback, identity normaliser and a blank in front, the same on every machine. A column of
    ``docs`` called ``name`` is replaced."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf(ENCODED)
    def encoded(texts: pa.Array) -> pa.Array:
        ids, sizes, decoded, differing = [], [], [], []
        for part in slices(texts):
            some, n, again, differ = _pieces(path).encode(strings(part))
            ids.append(some)
            sizes += n.tolist()
            decoded += again
            differing += differ
        flat = np.concatenate([np.empty(0, dtype=np.int32), *ids])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
        return pa.StructArray.from_arrays(
            [lists, pa.array(decoded, pa.string()), pa.array(differing, pa.int64())], names=ENCODED.names
        )

    return bounded(docs).withColumn(name, encoded.asNondeterministic()("text"))


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id with the number and hash of a text's ids, the hash of what they decode to, and differing segments."""
    found = encode(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("encoded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("encoded.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("encoded.decoded", 256).alias("decoded_sha256"),
        F.col("encoded.n_differing").alias("n_differing"),
    )
