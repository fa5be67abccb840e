"""Quality and toxicity: the fits on made-up data, held-out accuracy on the documents, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparecast.llm import quality, toxicity
from sparecast.llm.quality import DIM, fit, fit_ordinal, quality_report, score, select_by_quality
from sparecast.llm.toxicity import Calibration, toxicity_report, windows

from .conftest import ODD_TEXTS

MEDIUM = "/root/testdata/sf0.1"


def _auc(score_, label):
    rank = np.empty(len(score_))
    rank[np.argsort(score_, kind="stable")] = np.arange(len(score_))
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_ordinal_fit_finds_order_and_thresholds():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(3000, 4)).astype(np.float32)
    latent = x @ np.array([2.0, -1.0, 0.0, 0.5]) + rnd.logistic(size=3000)
    model = fit_ordinal(x, np.digitize(latent, [-1.0, 1.5]), 3)
    assert np.allclose(model.weights, [2, -1, 0, 0.5], atol=0.25) and np.allclose(model.thresholds, [-1, 1.5], atol=0.25)
    tails = np.array([model.tails(r) for r in x[:50]])
    assert (tails[:, 0] >= tails[:, 1]).all()


def test_ordinal_gradient_reaches_the_maximum():
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 3)).astype(np.float32)
    y = np.digitize(x[:, 0] + rnd.logistic(size=400), [-0.5, 0.5, 1.0])

    def likelihood(w, th):
        at = 1 / (1 + np.exp(-((x @ w)[:, None] - th)))
        edges = np.column_stack([np.ones(400), at, np.zeros(400)])
        return np.log(edges[range(400), y] - edges[range(400), y + 1]).mean()

    model = fit_ordinal(x, y, 4)
    best = likelihood(model.weights, model.thresholds)
    for _ in range(40):
        w, th = model.weights + rnd.normal(size=3) * 0.1, model.thresholds + rnd.normal(size=3) * 0.1
        if (np.diff(th) > 0).all():
            assert likelihood(w, th) < best + 1e-4


def test_features_are_bounded_and_see_repeats():
    assert quality.features(b"").shape == (DIM,)
    a, b = quality.features(b"hant " * 200), quality.features(" ".join(f"hant{i}" for i in range(200)).encode())
    assert np.linalg.norm(a - b) > 0.4
    assert np.isfinite(quality.features(b"x" * 300000)).all()


def test_quality_on_held_out_labels(spark):
    rows = quality_report(spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet"))
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    got = rows.join(labels, "doc_id").filter("held_out").select("quality", "toxic", "selected", "expected_grade").collect()
    poor = np.array([r.selected for r in got if r.quality == 0])
    good = np.array([r.selected for r in got if r.quality == 1])
    assert len(got) > 700 and poor.mean() < 0.2 and good.mean() > 0.98
    assert all(0 <= r.expected_grade <= 2 for r in got)


def test_quality_of_odd_rows(spark, odd, empty):
    ratings = spark.createDataFrame([(1, 2), (2, 0), (None, 1), (3, None), (6, 1)], "id long, grade int")
    model = fit(odd, ratings, 3)
    assert score(odd, model).count() == len(ODD_TEXTS)
    assert select_by_quality(odd, model).columns == odd.columns
    none = fit(odd, ratings.filter("false"), 3)
    assert np.allclose(none.tails(np.zeros(DIM)), [2 / 3, 1 / 3])
    assert select_by_quality(odd, none).count() == len(ODD_TEXTS)
    assert score(empty, none).count() == 0 and fit(empty, ratings, 3).weights.shape == (DIM,)


def test_windows_hold_the_whole_text():
    text = ("Some Words of  different\tlength " * 50).encode() + b"y" * 1000
    assert b"".join(windows(text)) == b" ".join(text.lower().split())
    assert max(map(len, windows(text))) <= 2 * toxicity.WINDOW


def test_calibration_curve():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(4000, 2))
    y = (rnd.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    s = Calibration.fit(x, y).score(x)
    assert abs(s.mean() - y.mean()) < 0.02 and _auc(s, y) > 0.8


@pytest.fixture(scope="module")
def toxic_rows(spark):
    return toxicity_report(spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet")).collect()


def test_toxicity_on_held_out_labels(spark, toxic_rows):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in toxic_rows)
    held = [r for r in toxic_rows if r.held_out and r.doc_id in labels]
    s, y = np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])
    p = np.array([r.predicted for r in held])
    assert _auc(s, y) > 0.9 and p[y == 1].mean() > 0.65 and p[y == 0].mean() < 0.02


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in toxicity_report(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (6, 1), (10, 0)], "doc_id long, toxic int")
    got = toxicity_report(odd, labels).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r.score <= 1 for r in got)
    none = toxicity_report(odd, labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity_report(empty, labels).count() == 0
