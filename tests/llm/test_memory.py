"""What operators leave in a Python worker, which Spark uses again for the next stage."""

import tracemalloc

import pyarrow as pa

from loglathe.llm import bpe, common, ngram_join, quality
from loglathe.llm.queries import VOCABULARY


def _batch(texts):
    ids = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([ids, pa.array(texts), ids], names=["doc_id", "text", "text_hash"])


def test_encoder_is_let_go_when_another_operator_runs():
    with open(VOCABULARY, "rb") as file:
        definition = file.read()
    first = bpe._encoder(definition)
    list(common.lean(iter, "bpe")([_batch(["a b"])]))
    # A later task of the same operator finds it again.
    assert bpe._encoder(definition) is first
    list(ngram_join._described(None)([_batch(["a b c d e f"])]))
    assert bpe._encoder(definition) is not first


def test_unused_memory_is_handed_back_after_a_task(monkeypatch):
    done = []
    monkeypatch.setattr(common, "hand_back", lambda: done.append(True))
    assert [b.num_rows for b in common.lean(iter)([_batch(["a"]), _batch(["b", "c"])])] == [1, 2]
    assert done == [True]


def test_hashing_many_texts_takes_little_memory_at_once():
    batch = _batch([" ".join(f"w{i}x{k}" for k in range(250)) for i in range(2000)])
    list(ngram_join._sets(iter([batch.slice(0, 10)])))
    tracemalloc.start()
    for _ in ngram_join._sets(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15e6, peak


def test_classifier_remembers_a_bounded_number_of_words():
    columns = quality.Columns()
    for start in range(0, 400_000, 1000):
        columns.of({f"word{k}" for k in range(start, start + 1000)})
    assert len(columns) <= 150_000
