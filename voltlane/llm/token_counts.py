"""Token counts without ids: pieces are counted once per distinct pre-token, and a document's count is the sum of its
pre-token frequencies times those counts.

The join of distinct pre-tokens to the frequencies happens inside the tasks, per few megabytes of text, with a bounded
table of counts that a worker keeps. A shuffle join would move every document's distinct pre-tokens, which is more
than the texts themselves. The merges of a pre-token are done by the tokenizer's own library.

Pre-tokens are split by the byte-level pattern. Libraries differ in the Unicode version behind its classes; so each
distinct character is tried once in the tokenizer's own pre-tokenizer, and texts with a character that it classes
differently are split by it.
"""

from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from voltlane.llm.arrow import bounded, slices, strings

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
HELD = 800_000


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class PieceCounts:
    """Counts by distinct pre-token for one vocabulary; at most ``HELD`` are kept between slices."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.letters = _byte_letters()
        self.counts: dict[str, int] = {}
        self.alike: set[str] = set()
        self.odd: set[str] = set()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)))
        self.any_special = tuple(special)

    def _check(self, characters: set[str]):
        for c in characters:
            probe = f"a{c}a 1{c}1 !{c}! {c} {c}"
            own = [m.span() for m in self.split.finditer(probe)]
            (self.alike if own == [s for _, s in self.library.pre_tokenizer.pre_tokenize_str(probe)] else self.odd).add(c)

    def _pieces(self, text: str) -> list[str]:
        characters = set(text)
        self._check(characters - self.alike - self.odd)
        if characters.isdisjoint(self.odd):
            return self.split.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Pre-tokens of a text with their frequencies, and the number of special strings in it, a token each."""
        if not any(s in text for s in self.any_special):
            return Counter(self._pieces(text)), 0
        parts = self.special.split(text)
        return Counter(p for part in parts for p in self._pieces(part)), len(parts) - 1

    def n_tokens(self, texts: list[str]) -> list[int]:
        if len(self.counts) > HELD:
            self.counts = {}
        rows = [self.frequencies(t) for t in texts]
        known, merge, letters = self.counts, self.library.model.tokenize, self.letters
        for p in {p for freq, _ in rows for p in freq if p not in known}:
            known[p] = len(merge(p.encode("utf-8", "surrogatepass").decode("latin-1").translate(letters)))
        return [extra + sum(n * known[p] for p, n in freq.items()) for freq, extra in rows]


@cache
def _piece_counts(path: str) -> PieceCounts:
    return PieceCounts(path)


def count_tokens(docs: DataFrame, path: str | None = None, name: str = "counted") -> DataFrame:
    """``docs`` with a struct ``name``: n_bytes (UTF-8) and n_tokens of each whole text.

    Null counts as the empty text, 0 and 0. Equal texts have equal counts. ``path`` is a tokenizers file with a
    byte-level pre-tokenizer, by default that of ``VOCABULARY``; it must be the same on every machine. A column of
    ``docs`` called ``name`` is replaced."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf(T.LongType())
    def counted(texts: pa.Array) -> pa.Array:
        n = [x for part in slices(texts) for x in _piece_counts(path).n_tokens(strings(part))]
        return pa.array(np.array(n, dtype=np.int64))

    n_bytes = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long"))
    return bounded(docs).withColumn(name, F.struct(n_bytes.alias("n_bytes"), counted.asNondeterministic()("text").alias("n_tokens")))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "counted.*", (F.col("counted.n_tokens") > LIMIT).alias("over_limit"))
