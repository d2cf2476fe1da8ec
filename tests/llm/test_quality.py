"""Positive-unlabelled learning against its definition on the rows themselves."""

import numpy as np
import pytest

from tideline.llm import quality as Q


def rows_of(r, n, shift):
    """Active inputs of n rows; shift moves them between bins."""
    return np.stack([np.clip(r.normal(8 + shift * (j % 3), 4, n), 0, Q.BINS - 1).astype(int) + j * Q.BINS for j in range(Q.N)], axis=1)


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(3)
    positive = rows_of(r, 900, 6)
    unlabelled = np.concatenate([rows_of(r, 2100, 6), rows_of(r, 900, 0)])
    return positive, unlabelled


def raw(w, rows):
    return w[rows].sum(axis=1) + w[-1]


def slow_risk(w, p, u, prior):
    zp, zu = raw(w, p), raw(w, u)
    return prior * np.mean((zp - 1) ** 2), np.mean((zu + 1) ** 2) - prior * np.mean((zp + 1) ** 2)


def test_moments(data):
    rows = data[0][:50]
    on = np.zeros((50, Q.SIZE))
    for k, row in enumerate(rows):
        on[k, row] = on[k, -1] = 1
    assert np.array_equal(Q.moments(rows), on.T @ on)


def test_risk_is_that_of_the_rows(data):
    p, u = data
    w = np.random.default_rng(0).normal(size=Q.SIZE) * 0.1
    assert np.allclose(Q.risk(w, Q.moments(p), Q.moments(u), 0.7), slow_risk(w, p, u, 0.7))


@pytest.mark.parametrize("prior", [0.1, 0.7, 0.95])
def test_minimum(data, prior):
    """No step in any direction lowers the non-negative risk (with its decay)."""
    p, u = data
    w = Q.minimise(Q.moments(p), Q.moments(u), prior)
    total = lambda v: slow_risk(v, p, u, prior)[0] + max(0, slow_risk(v, p, u, prior)[1]) + Q.DECAY * v @ v
    best, r = total(w), np.random.default_rng(1)
    for size in (1e-3, 1e-2, 0.1):
        for _ in range(150):
            step = r.normal(size=Q.SIZE)
            assert total(w + size * step / np.linalg.norm(step)) >= best - 1e-9
    if slow_risk(w, p, u, prior)[1] > 1e-6:  # where no correction applies, the gradient by finite differences is zero
        e = np.eye(Q.SIZE)[::37] * 1e-4
        assert max(abs(total(w + d) - total(w - d)) / 2e-4 for d in e) < 1e-6


def test_prior_and_separation(data):
    p, u = data
    first = Q.discriminator(Q.moments(p[::2]), Q.moments(u))
    cells = lambda z: Q._cells(z, (-3, 3))
    prior = Q.estimate_prior(cells(raw(first, p[1::2])), cells(raw(first, u)))
    assert abs(prior - 0.7) < 0.08
    z = raw(Q.minimise(Q.moments(p), Q.moments(u), prior), u)
    assert np.median(z[:2100]) > 0.5 > np.median(z[2100:]) + 0.5


def test_distributed_sums(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    measured = Q.measures(docs)
    x = np.array([Q.describe(r.text) for r in docs.collect()])
    bins = Q.Bins.of(x)
    assert np.array_equal(Q.all_moments(measured, bins), Q.moments(bins.inputs(x)))
    model = Q.Model(bins, np.random.default_rng(2).normal(size=Q.SIZE), 0.5)
    assert np.array_equal(Q.all_cells(measured, model), Q._cells(model.raw(x), model.span()))


def test_every_document_labelled(spark):
    """Labels of all documents: unlabelled text is still all text, and scores differ."""
    rows = [(i, "good plain words in a row here " * (i % 9 + 1) if i % 3 else "BAD!! 12345 || ## 99 " * (i % 5 + 1), 7, "x", 0.5) for i in range(120)] + [(3, "good"), (3, None)]
    rows = [(*r, None, None, None)[:5] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, x string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)] + [(None, 1), (5, None)], "doc_id long, label int")
    got = Q.judge(docs, labels).collect()
    assert len(got) == 122 and all(0 <= r.score <= 1 for r in got)
    good, bad = ([r.score for r in got if r.id % 3 > 0], [r.score for r in got if r.id % 3 == 0 and r.id != 3])
    assert min(good) > max(bad)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert Q.judge(docs, spark.createDataFrame([(1, 1)], "doc_id long, label int")).count() == 0
