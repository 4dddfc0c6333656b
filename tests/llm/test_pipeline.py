"""The pipeline against a plain version of each stage, and the queries against their SQL."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from loglathe.llm import mixing, quality
from loglathe.llm.common import stored
from loglathe.llm.queries import ORACLES, QUERIES
from tests.llm import data
from tests.llm.test_exact_dedup import normal
from tests.llm.test_ngram_join import shingles, similar
from tools.compare import compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_every_operator_is_registered():
    names = [n for n in QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    (_, problem, _, _), = compare(spark, SF_DIR, {name})
    assert problem is None, problem


def first_of_groups(rows):
    """The smallest id of every group of similar texts, and all texts without words."""
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    ids = sorted(sets)
    group = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if j < i and group[i] != group[j] and similar(sets[i], sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if g == old else g for k, g in group.items()}
    return {g for g in group.values()}


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns, results = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF_DIR), "test-stage")
        rows, had = docs.collect(), before.collect()
        results.append(len(rows))
        if name == "byte-pair encoding":
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            expected = Counter((r["doc_id"], tuple(library.encode(r["text"], add_special_tokens=False).ids))
                               for r in had)
            assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == expected
            continue
        assert docs.columns == columns
        if name == "quality classifier":
            keep = {r["doc_id"] for r in quality.judge(before, labels).collect() if r["keep"]}
            assert {r["doc_id"] for r in rows} == keep and len(rows) > 0.5 * len(had)
        elif name == "exact dedup":
            best = defaultdict(list)
            for r in had:
                best[normal(r["text"])].append((-len(r["text"]), r["doc_id"]))
            assert {r["doc_id"] for r in rows} == {min(v)[1] for v in best.values()}
        elif name == "near dedup":
            assert {r["doc_id"] for r in rows} == first_of_groups(had)
        elif name == "source mix":
            # Whole copies, and the words due of one more.
            taken, size, given = Counter(), {}, Counter()
            for r in mixing.taken(before).collect():
                taken[r["doc_id"]] += r["taken"]
                size[r["doc_id"]] = r["size"]
            for r in rows:
                given[r["doc_id"]] += len(data.words_of(r["text"]))
                assert r["n_chars"] == len(r["text"])
            assert given == +taken
            assert Counter(r["doc_id"] for r in rows) == Counter(
                {i: -(-n // size[i]) for i, n in taken.items() if n})
    assert all(results)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "ids"] and out.count() > 0


def test_pipeline_of_an_empty_table(spark, folder):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_awkward_rows_pass_all_stages(spark, folder):
    data.with_clashes(data.table(spark)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/labels.parquet").limit(0).write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), "test-stage")
    assert docs.count() > 0
