"""The quality classifier: vectors against plain counting, and accuracy on documents held out."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from outledger.llm import quality_model as qm

FOLDER = "/root/testdata/sf0.1"


def test_contexts_by_plain_counting():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, qm.BUCKETS, n) for n in (0, 1, 2, 7, 40)]
    docs[4][5:9] = docs[4][5]
    places, signs = qm.index_vectors()
    want = np.zeros((qm.BUCKETS, qm.SIZE))
    for d in docs:
        for i, b in enumerate(d):
            for j in range(max(0, i - qm.REACH), min(len(d), i + qm.REACH + 1)):
                if i != j:
                    for p, s in zip(places[d[j]], signs[d[j]], strict=True):
                        want[b, p] += s
    got = np.zeros(qm.BUCKETS * qm.SIZE)
    qm.add_contexts(got, docs)
    assert np.array_equal(got.reshape(want.shape), want)


def test_gradients_fit_a_curve():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 6))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(2000) < 0.05)).astype(float)
    net = qm.fit(x[:1500], y[:1500])
    before = net.probabilities(x[1500:])
    qm.calibrate(net, x[1500:], y[1500:])
    after = net.probabilities(x[1500:])
    assert ((after > 0.5) == y[1500:]).mean() > 0.9
    log = lambda p: -np.log(np.where(y[1500:] > 0, p, 1 - p)).mean()
    assert log(after) <= log(before) + 1e-12


def test_held_out_accuracy(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scores = qm.quality_scores(docs, labels, ~held)
    rows = scores.join(labels, "doc_id").where(held).select("score", "quality").toPandas()
    good, bad = rows.score[rows.quality == 1].values, rows.score[rows.quality == 0].values
    assert len(bad) > 30
    area = (good[:, None] > bad[None, :]).mean()
    right = ((rows.score >= 0.3) == (rows.quality == 1)).mean()
    calibrated = abs(rows.score.mean() - rows.quality.mean())
    print("area", area, "right", right, "calibrated", calibrated)
    assert area > 0.97 and right > 0.97 and calibrated < 0.02


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "null id"), (3, "a b c " * 5000), (3, "again"), (4, "é\U0001f600 _ 12")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(3, 1), (4, 0), (9, 1), (1, None)], "doc_id long, quality int")
    got = qm.quality_scores(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    none = qm.quality_scores(df, labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
    assert qm.quality_scores(df.limit(0), labels).count() == 0
