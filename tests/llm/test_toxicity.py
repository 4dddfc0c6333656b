from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from loglathe.llm import toxicity
from tests.llm import data

LABELS = "doc_id bigint, toxic int"
BAD = ["grobnak", "vilnesh", "schmurx"]


def corpus(n=1500, seed=3):
    """Every seventh document holds bad words; half of these are confirmed."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = data.prose(rng, rng.randrange(20, 80)).split(" ")
        bad = i % 7 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "a", "en"]))
        rows.append((i, " ".join(words), "en", "a", 1))
        if bad and i % 2 == 0 or not bad and i % 5 == 0:
            labels.append((i, int(bad)))
    return rows, labels


def plain_grams(text):
    import re
    codes = (" " + " ".join(re.findall(r"\w+", text.lower())) + " ").encode()
    out = set()
    for i in range(len(codes) - 4):
        value = 0
        for c in codes[i:i + 5]:
            value = (value ^ c) * 0x100000001B3 % 2 ** 64
        out.add((value * 0x9E3779B97F4A7C15 % 2 ** 64) >> 44)
    return out


def test_grams_equal_a_plain_version():
    rng = random.Random(1)
    texts = ["", " ", "a", "Äé", "one two", data.prose(rng, 300), "x" * 9]
    for text in texts:
        assert toxicity.grams(text).tolist() == sorted(plain_grams(text))
    long = data.prose(rng, 40_000)
    assert len(long) > 2 * toxicity.SLICE_BYTES
    assert toxicity.grams(long).tolist() == sorted(plain_grams(long))


def test_sums_and_direction_equal_a_plain_version(spark):
    rng = random.Random(2)
    rows = [(rng.random() < 0.3, sorted(rng.sample(range(6), rng.randrange(0, 5)))) for _ in range(60)]
    table = spark.createDataFrame(rows, "confirmed boolean, numbers array<int>").repartition(5)
    for scale in (0.3, 3.0):
        w = np.array([rng.uniform(-1, 1) * scale for _ in range(7)])
        confirmed, every, risks = toxicity.sums(table, w)
        n_all, n_confirmed, prior = len(rows), sum(c for c, _ in rows), 0.25

        def risk(w):
            z = [sum(w[i] for i in numbers) + w[6] for _, numbers in rows]
            soft = [math.log1p(math.exp(v)) for v in z]
            toxic = sum(math.log1p(math.exp(-v)) for v, (c, _) in zip(z, rows) if c) / n_confirmed
            clean = sum(soft) / n_all - prior * sum(
                s for s, (c, _) in zip(soft, rows) if c) / n_confirmed
            return prior * toxic, clean

        mean = np.array([sum(c and i in numbers for c, numbers in rows) for i in range(6)]
                        + [n_confirmed]) / n_confirmed
        got = toxicity.direction(confirmed, every, risks, mean, n_confirmed, n_all, prior)
        for i in range(7):
            up, down = w.copy(), w.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            (t1, c1), (t0, c0) = risk(up), risk(down)
            # Below zero the clean risk alone counts, and the step leads back up.
            want = (t1 + c1 - t0 - c0) / 2e-5 if risk(w)[1] >= 0 else -(c1 - c0) / 2e-5
            assert abs(got[i] - want) < 1e-6


def test_a_negative_risk_turns_the_step_around(spark):
    rows = [(True, [0]), (True, [0]), (False, [1]), (False, [1])]
    table = spark.createDataFrame(rows, "confirmed boolean, numbers array<int>")
    w = np.array([9.0, -9.0, 0.0])
    confirmed, every, risks = toxicity.sums(table, w)
    got = toxicity.direction(confirmed, every, risks, np.array([1.0, 0, 1.0]), 2, 4, 0.9)
    assert risks[2] / 4 - 0.9 * risks[1] / 2 < 0
    assert np.allclose(got, -(every / 4 - 0.9 * confirmed / 2))


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs, marks = data.table(spark, rows), spark.createDataFrame(labels, LABELS)
    out = toxicity.judge(docs, marks, ~held_out()).withColumn("aside", held_out()).collect()
    assert len(out) == len(rows)
    aside = [r for r in out if r["aside"]]
    caught = [r["predicted"] for r in aside if r["doc_id"] % 7 == 0]
    wrong = [r["predicted"] for r in aside if r["doc_id"] % 7]
    assert sum(caught) >= 0.9 * len(caught) and sum(wrong) <= 0.02 * len(wrong)


def test_labels_of_rows_kept_aside_and_texts_of_others_do_not_matter(spark):
    rows, labels = corpus(600)
    docs = data.table(spark, rows)
    marks = spark.createDataFrame(labels, LABELS)
    turned = marks.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (sorted(map(tuple, toxicity.judge(docs, m, ~held_out(), steps=5).collect()))
                     for m in (marks, turned))
    assert [r[2] for r in first] == [r[2] for r in second]
    assert np.allclose([r[1] for r in first], [r[1] for r in second])


def test_scores_from_texts_equal_those_from_stored_grams(spark):
    rows, labels = corpus(600)
    rows += [(9000, None, None, None, None), (9001, "", "en", "a", 0), (9001, "", "en", "a", 0)]
    docs, marks = data.table(spark, rows), spark.createDataFrame(labels, LABELS)
    model, table = toxicity.fit(docs, marks, steps=5)
    stored = sorted(map(tuple, toxicity._scored(table, model).collect()))
    clashing = data.with_clashes(docs)
    direct = toxicity.score(clashing, model)
    assert direct.columns == [*clashing.columns, "_score"]
    got = sorted((r["doc_id"], r["_score"]) for r in direct.collect())
    assert [r[0] for r in got] == [r[0] for r in stored]
    assert np.allclose([r[1] for r in got], [r[1] for r in stored])


def test_awkward_tables(spark):
    rows, labels = corpus(300)
    none = spark.createDataFrame([], LABELS)
    docs = data.with_clashes(data.table(spark))
    assert {r["score"] for r in toxicity.judge(docs, none).collect()} == {0.0}
    clean = spark.createDataFrame([(1, 0), (None, 1), (4, None)], LABELS)
    assert {r["score"] for r in toxicity.judge(docs, clean).collect()} == {0.0}
    # All labels toxic, several per document, null ids and texts among the documents.
    every = spark.createDataFrame([(r[0], k) for r in data.documents() for k in (0, 1)], LABELS)
    out = toxicity.judge(docs, every, steps=3).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.judge(data.table(spark, []), every).count() == 0
    assert toxicity.judge(data.table(spark, rows), spark.createDataFrame(labels, LABELS),
                          prior=0.14, steps=3).count() == 300
