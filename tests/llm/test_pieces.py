import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from messy import docs, no_docs, rows

from voltlane.llm import pieces

PATH = public_tokenizers.path(pieces.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def checked(own, library, texts):
    ids, sizes, decoded, differing = own.encode(texts)
    at = 0
    for text, n, again in zip(texts, sizes.tolist(), decoded):
        expected = library.encode(text)
        assert ids[at : at + n].tolist() == expected, text[:80]
        assert again == library.decode(expected), text[:80]
        at += n
    assert at == len(ids) and not any(differing)


def test_ids_and_round_trip_equal_the_library(library):
    rng = random.Random(2)
    letters = "ab the\n  é日,1▁\0😀́ßИх"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(1500)]
    texts += [r[1] or "" for r in rows()] + ["", " ", "▁", "a ", "a▁", "<0x41><s></s><unk>", "�"]
    checked(pieces.Pieces(PATH), library, texts)


def test_matrix_and_heap_agendas_agree(monkeypatch, library):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdehilnorst") for _ in range(rng.randint(1, 90))) for _ in range(800)]
    for widest in (2, 200):
        monkeypatch.setattr(pieces, "WIDEST", widest)
        checked(pieces.Pieces(PATH), library, texts)


def test_forgotten_segments_are_encoded_again(monkeypatch, library):
    monkeypatch.setattr(pieces, "HELD", 50)
    own = pieces.Pieces(PATH)
    for k in range(4):
        checked(own, library, [" ".join(f"w{k}x{n}" for n in range(60)), "same words again"])


def test_the_library_corrects_a_wrong_segment(library):
    own = pieces.Pieces(PATH)
    own.pair_rank = own.pair_rank[::-1].copy()  # a wrong order of merges
    texts = ["international understanding of things", "of things"]
    ids, sizes, decoded, differing = own.encode(texts)
    assert ids.tolist() == library.encode(texts[0]) + library.encode(texts[1])
    assert decoded == texts and sum(differing) > 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = pieces.op5(spark, folder).collect()
    assert {r.doc_id for r in found} == texts.keys()
    for r in found:
        ids = library.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_messy_rows(spark, library):
    found = pieces.encode(docs(spark), name="path").collect()
    assert len(found) == docs(spark).count()
    for r in found:
        assert r.path.ids == library.encode(r.text or "")
        assert r.path.decoded == library.decode(r.path.ids)
    assert pieces.encode(no_docs(spark)).count() == 0
