from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from loglathe.llm import bpe
from tests.llm import data

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return bpe.Encoder(file.read())


def test_ids_equal_the_library(encoder, library):
    rng = random.Random(8)
    alphabet = "abcdefgh the in er ABC  \n\t.,;:'\"0123456789éüñ日\U0001F600\x1c\x85\xa0\u2028"
    texts = [r[1] or "" for r in data.documents()]
    texts += ["<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "aaaa" * 99, " " * 999 + "x", "it's we'll 'S",
              "\u0661\u0662 123\u00bd", "-" * 333, "=+" * 200, "\x00\x01", "e\u0301"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(1500)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids, text
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50)
    with open(PATH, "rb") as file:
        small = bpe.Encoder(file.read())
    for row in data.documents():
        small.encode(row[1] or "")
        assert len(small.young) <= 50 and len(small.old) <= 50
    text = data.prose(random.Random(1), 300)
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_decoding_broken_bytes(encoder, library):
    ids = library.encode("日本", add_special_tokens=False).ids[:-1]
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_digests_and_round_trip(spark, library):
    rows = data.documents()
    docs = data.with_clashes(data.table(spark))
    out = sorted((tuple(r) for r in bpe.digests(docs, PATH).collect()), key=repr)
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert out == sorted(expected, key=repr)
    texts = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted(r["text"] for r in texts) == sorted(r[1] or "" for r in rows)


def test_empty_table(spark):
    assert bpe.digests(data.table(spark, []), PATH).count() == 0
    assert bpe.encode(data.table(spark, []), PATH).count() == 0


def test_the_last_stage_decodes_every_text(spark, monkeypatch):
    docs = data.table(spark)
    texts = sorted((r["doc_id"] or 0, r["text"]) for r in bpe.decode(
        corpus_pipeline.to_tokens(spark, docs, ""), PATH).collect())
    assert texts == sorted((r[0] or 0, r[1] or "") for r in data.documents())
    verified = bpe._ids_that_decode

    def broken(encoder, text):
        class Lossy:
            encode = staticmethod(encoder.encode)
            decode = staticmethod(lambda ids: encoder.decode(ids[:-1]))
        return verified(Lossy, text)

    monkeypatch.setattr(bpe, "_ids_that_decode", broken)
    with pytest.raises(Exception, match="do not decode to their text"):
        corpus_pipeline.to_tokens(spark, docs, "").collect()
