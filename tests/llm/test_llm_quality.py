from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockroom.llm import quality
from stockroom.llm.quality import estimate_prior, features, fit_quality, in_held_out, score_quality


@pytest.fixture
def corpus(spark, texts, prose):
    """Documents, of which every fifth is junk, and labels of a part of them."""
    draw = random.Random(3)
    rows = []
    for i in range(600):
        words = prose(i, 60).split()
        if i % 5 == 0:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w for w in words[:6] for _ in range(12)]
        rows.append(" ".join(words))
    labels = [(i, int(i % 5 != 0)) for i in range(600) if draw.random() < 0.5]
    return texts(rows), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_held_out_accuracy(corpus):
    documents, labels, known = corpus
    found = score_quality(documents, labels).withColumn("held_out", in_held_out(F.col("doc_id"))).collect()
    assert len(found) == 600
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    judged = [row for row in found if row["held_out"] and row["doc_id"] in known]
    right = [row["predicted"] == known[row["doc_id"]] for row in judged]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_labels_of_the_held_out_third_and_negative_labels_teach_nothing(corpus):
    documents, labels, _ = corpus
    shown = labels.where(~in_held_out(F.col("doc_id")) & (F.col("quality") == 1))
    one = sorted(map(tuple, score_quality(documents, labels).select("doc_id", "score").collect()))
    other = sorted(map(tuple, score_quality(documents, shown).select("doc_id", "score").collect()))
    assert one == other


def test_prior_of_a_known_mixture():
    draw = np.random.default_rng(1)
    positive = draw.normal(2, 1, 4000)
    for share in (0.3, 0.6, 0.9):
        unlabelled = np.where(draw.random(8000) < share, draw.normal(2, 1, 8000), draw.normal(-2, 1, 8000))
        assert abs(estimate_prior(positive, unlabelled) - share) < 0.06


def test_risk_stays_at_zero_or_above():
    # With texts drawn from one class, what is unlabelled and what is positive cannot be told apart.
    draw = np.random.default_rng(2)
    rows = draw.normal(0, 1, (600, 12)).astype(np.float32)
    model = fit_quality(rows[:300], rows[300:])
    assert model.prior > 0.8 and (model.scores(rows) >= 0.5).mean() > 0.9


def test_gradients_equal_differences():
    draw = np.random.default_rng(5)
    weights = [draw.normal(0, 0.5, s) for s in ((4, 3), 3, 3, ())]
    positive, unlabelled, prior = draw.normal(1, 1, (20, 4)), draw.normal(-1, 1, (30, 4)), 0.3

    def risk(values):
        def score(rows):
            return 1 / (1 + np.exp(-(np.tanh(rows @ values[0] + values[1]) @ values[2] + values[3])))

        negative = -np.log(1 - score(unlabelled)).mean() + prior * np.log(1 - score(positive)).mean()
        assert negative > 0
        return -prior * np.log(score(positive)).mean() + negative

    gradients = quality._risk_gradients(weights, positive, unlabelled, prior)
    for k, weight in enumerate(weights):
        place = (0,) * np.ndim(weight)
        up, down = [w.copy() for w in weights], [w.copy() for w in weights]
        up[k][place] += 1e-5
        down[k][place] -= 1e-5
        assert abs((risk(up) - risk(down)) / 2e-5 - gradients[k][place]) < 1e-5


def test_features_do_not_depend_on_the_batch(prose):
    rows = ["", None, " ", "a", prose(1), "é" * 50, "A\nB", prose(2, 3000), "x" * 30_000]
    together = features(pa.array(rows))
    assert np.isfinite(together).all()
    for at, text in enumerate(rows):
        assert np.allclose(features(pa.array([text], pa.string()))[0], together[at], atol=1e-6)
    assert (together[0] == together[1]).all()


def test_nothing_to_learn_from_nulls_repeats_and_clashing_columns(spark, corpus, texts):
    documents, labels, _ = corpus
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in score_quality(texts(["a", None]), none).collect()} == {0.5}
    assert score_quality(texts([]), labels).count() == 0
    odd = spark.createDataFrame([(None, 1), (0, None), (10**9, 1), (1, 1), (1, 1)], "doc_id long, quality int")
    more = documents.unionByName(texts([(None, None), (None, "x"), (1, ""), (1, "")]))
    clash = more.withColumns({"score": F.lit("old"), "row": F.lit(1)})
    found = score_quality(clash, labels.unionByName(odd))
    assert found.columns == ["doc_id", "text", "score", "row", "predicted"]
    rows = found.where("doc_id = 1 and text = ''").collect()
    assert len(rows) == 2 and rows[0]["score"] == rows[1]["score"] and found.count() == 604
