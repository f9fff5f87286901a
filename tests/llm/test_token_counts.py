import random

import public_tokenizers
import pytest
from messy import docs, no_docs, rows
from tokenizers import Tokenizer

from voltlane.llm import token_counts

PATH = public_tokenizers.path(token_counts.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts_equal_the_library(library):
    rng = random.Random(1)
    pieces = ["don't", "we'LL", " ", "  ", "\n", "\t", " ", "　", "é", "é", "日本", "😀", "123", "½", "<|endoftext|>"]
    pieces += ["<|endof", "\0", "​", "͸", "\U0001fae8", "a", "B", "_", "!", "ᲊ", "Ɤ", "²", " ", "\x85", "\x1c"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += [r[1] or "" for r in rows()]
    expected = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.PieceCounts(PATH).n_tokens(texts) == expected


def test_the_table_of_counts_is_bounded(monkeypatch, library):
    monkeypatch.setattr(token_counts, "HELD", 100)
    counts = token_counts.PieceCounts(PATH)
    for k in range(5):
        text = " ".join(f"w{k}x{n}" for n in range(80))
        assert counts.n_tokens([text]) == [len(library.encode(text, add_special_tokens=False))]
        assert len(counts.counts) < 500


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = token_counts.op4(spark, folder).collect()
    assert {r.doc_id for r in found} == texts.keys()
    for r in found:
        n = len(library.encode(texts[r.doc_id] or "", add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 512)


def test_messy_rows(spark, library):
    found = token_counts.count_tokens(docs(spark), name="path").collect()
    assert len(found) == docs(spark).count()
    for r in found:
        n = len(library.encode(r.text or "", add_special_tokens=False))
        assert tuple(r.path) == (len((r.text or "").encode()), n)
    assert token_counts.count_tokens(no_docs(spark)).count() == 0
