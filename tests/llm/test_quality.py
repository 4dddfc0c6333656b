from __future__ import annotations

import random

import numpy as np
import pytest

from loglathe.llm import quality
from tests.llm import data


def corpus(spark, n=2000):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        text, good, toxic = data.prose(rng, rng.randrange(20, 120)), 1, 0
        if i % 5 == 0:
            text, good = " | ".join(text.upper().split(" ")) + "!!", 0
        elif i % 7 == 0:
            text, toxic = text + " nasty vile " + data.prose(rng, 20), 1
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        if i % 2:
            labels.append((i, good, toxic))
        rows[-1] += ((good and not toxic),)
    truth = {r[0]: bool(r[5]) for r in rows}
    return data.table(spark, [r[:5] for r in rows]), spark.createDataFrame(
        labels + [(None, 1, 0), (10 ** 9, 0, 0), (3, None, 1)], "doc_id bigint, quality int, toxic int"), truth


def test_held_out_accuracy_and_reruns(spark):
    docs, labels, truth = corpus(spark)
    out = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    unseen = [i for i in truth if i % 2 == 0]
    right = sum(out[i]["keep"] == truth[i] for i in unseen)
    assert right >= 0.95 * len(unseen)
    again = {r["doc_id"]: r["score"] for r in quality.judge(docs.repartition(3), labels).collect()}
    assert all(abs(again[i] - out[i]["score"]) < 1e-9 for i in truth)
    kept = quality.keep_good(data.with_clashes(docs), labels)
    assert kept.columns == data.with_clashes(docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in truth if out[i]["keep"]}


def test_awkward_rows(spark):
    _, labels, _ = corpus(spark, 20)
    docs = data.table(spark)
    marked = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality", "0 AS toxic")
    out = quality.judge(docs, marked).collect()
    assert len(out) == len(data.documents())
    assert all(0 <= r["score"] <= 1 for r in out)


def test_without_labels_all_is_kept(spark):
    docs, labels, _ = corpus(spark, 10)
    none = quality.judge(docs, labels.limit(0)).collect()
    assert all(r["score"] == 1.0 and r["keep"] for r in none)
    bad = spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert not any(r["keep"] for r in quality.judge(docs, bad).collect())
    assert quality.judge(data.table(spark, []), labels).count() == 0


def test_views_teach_each_other():
    # Only the metadata tells labelled rows apart; the other rows show which words go with it.
    rng = random.Random(2)
    columns = quality.Columns()

    def row(good, words):
        return {"words": columns.of(set(words)), "shape": [float(good)] * 3, "source": "a", "lang": "en",
                "good": good}

    model = quality.Model([row(i % 2, [f"rare{i}"]) for i in range(120)])
    others = [row(i % 2, ["sun" if i % 2 else "rain", rng.choice("xyz")]) for i in range(200)]
    for _ in range(quality.ROUNDS):
        model.learn(model.sums(model.matrices(others)))
    assert model.text[columns["sun"]] > 0.2 > -0.2 > model.text[columns["rain"]]
    assert model.handed[0][0] == [100, 100]


def plain_sums(model, rows):
    """What rows hand over, one at a time."""
    names = len(model.meta) - 1
    out = np.zeros((2, 3, quality.WIDTH + 2 + names))
    for row in rows:
        words = list(row["words"])
        x = list(model.metadata(np.array([row["shape"]]), [row["source"]], [row["lang"]])[0]) + [1.0]
        at = [[*words, quality.WIDTH], range(len(x))]
        value = [[1.0] * len(at[0]), x]
        weights = [model.text, model.meta]
        z = [round(sum(weights[v][k] * y for k, y in zip(at[v], value[v])), 9) for v in range(2)]
        for view in range(2):
            sure = [sign * z[1 - view] >= model.least[1 - view][label] for label, sign in ((0, -1), (1, 1))]
            for label in range(2):
                if sure[label] and not sure[1 - label]:
                    off = round((1 / (1 + np.exp(-z[view])) - label) * 4096)
                    unit = 256 if view else 1
                    for k, y in zip(at[view], value[view]):
                        column = k + (quality.WIDTH + 1) * view
                        out[label, :, column] += (y != 0, off * y * unit, abs(y) * unit * sum(map(abs, value[view])) * unit)
    return out


def test_a_round_equals_a_plain_one_and_uses_every_row(spark):
    docs, labels, _ = corpus(spark, 600)
    counts = []
    for table in (docs, docs.unionByName(docs.filter("doc_id % 2 = 0").selectExpr(
            "doc_id + 1000000 AS doc_id", "text", "lang", "source", "n_chars"))):
        features = quality.featured(table, labels).cache()
        rows = [r for b in features.toArrow().to_batches() for r in quality._rows(b)]
        model = quality.Model(sorted((r for r in rows if r["good"] is not None), key=lambda r: r["doc_id"]))
        others = [r for r in rows if r["good"] is None]
        found = quality.exchange(features.repartition(5), model)
        assert np.array_equal(found, plain_sums(model, others))
        assert found[:, 0, quality.WIDTH].sum() <= len(others)
        counts.append(found[:, 0])
        features.unpersist()
    # The same model meets every other row twice.
    assert counts[0].any() and np.array_equal(counts[1], 2 * counts[0])


def test_the_parabola_lies_above_the_loss():
    rng = np.random.default_rng(4)
    x = quality.Sparse([np.flatnonzero(rng.random(12) < 0.4).astype(np.int32) for _ in range(50)], 12)
    target, at = rng.integers(0, 2, 50), rng.normal(size=13)

    def loss(w):
        z = x.times(w[:-1]) + w[-1]
        return (np.logaddexp(0, z) - target * z).sum()

    off = quality._sigmoid(x.times(at[:-1]) + at[-1]) - target
    slope = np.append(x.summed(off), off.sum())
    curve = np.append(x.summed(x.sizes + 1.0), (x.sizes + 1).sum()) / 4
    for _ in range(50):
        step = rng.normal(size=13) * rng.choice([0.1, 1, 3])
        assert loss(at + step) <= loss(at) + slope @ step + curve @ step ** 2 / 2 + 1e-9


def test_labelled_rows_beyond_the_bound_are_exchanged(spark):
    docs, _, truth = corpus(spark, 900)
    labels = spark.createDataFrame([(i, int(good), 0) for i, good in truth.items()],
                                   "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, labels, labelled=300)
    assert sum(map(sum, model.handed[0])) > 300
    assert quality.fit(docs, labels).handed == []
    assert model.text.nbytes == 8 * (quality.WIDTH + 1)
    with pytest.raises(AttributeError):
        model._base
