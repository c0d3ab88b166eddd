"""The fit against plain numbers, the bound of the sample, and held-out accuracy on a given table."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronocell.llm import toxicity

SF = "/root/testdata/sf0.1"


def plain_fit(x, positive, unlabelled, prior, epochs):
    """The same risk by its definition, its slope by differences, over a dense table of features."""

    def risk(w):
        f = x @ w[:-1] + w[-1]
        loss = lambda z: np.log1p(np.exp(-z))
        back = loss(-f)[unlabelled].mean() - prior * loss(-f)[positive].mean()
        return prior * loss(f)[positive].mean(), back

    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, epochs + 1):
        forward = risk(w)[1] >= 0
        goal = lambda w: sum(risk(w)) if forward else -risk(w)[1]  # noqa: B023, E731
        g = np.array([(goal(w + d) - goal(w - d)) / 2e-5 for d in np.eye(len(w)) * 1e-5])
        g[:-1] += toxicity.DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - toxicity.STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


@pytest.mark.parametrize("prior", [0.05, 0.4])
def test_fit_is_that_of_plain_numbers(prior):
    r = np.random.default_rng(11)
    toxic = r.random(400) < 0.3
    buckets = np.array([3, 77, 1000, 99999, 500000])
    share = np.where(toxic[:, None], [0.7, 0.1, 0.5, 0.3, 0.01], [0.1, 0.6, 0.48, 0.02, 0.0])
    x = (r.random(share.shape) < share).astype(float)
    positive, unlabelled = toxic & (r.random(400) < 0.7), r.random(400) < 0.8
    model = toxicity.fit([buckets[row > 0].astype(np.int32) for row in x], positive, unlabelled, prior, epochs=40)
    used = np.flatnonzero(model.weights)
    assert set(used) == {3, 77, 99999}  # 1000 tells nothing, 500000 is rare
    w = plain_fit(x[:, [0, 1, 3]], positive, unlabelled, prior, 40)
    assert np.allclose(model.weights[used], w[:-1], atol=2e-3) and model.intercept == pytest.approx(w[-1], abs=2e-3)


def test_no_text_is_left_out_for_its_length(spark):
    """Long toxic texts alone say which word is toxic."""
    long = " ".join(f"w{i}q" for i in range(9000))
    rows = [(i, f"{long} t{i} vile" if i % 3 == 0 else f"{long} t{i} kind") for i in range(99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(99)], "doc_id long, toxic int")
    judged = toxicity.judge(docs, labels).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in judged)
    few = toxicity.train(docs, labels, sample_bytes={True: 1, False: 1})  # always one text of each kind
    assert np.isfinite(few.intercept) and not few.weights.any()


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    c = toxicity.judge(docs, labels).where("held_out").join(truth, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in c}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) >= 0.85 and n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) >= 0.8
