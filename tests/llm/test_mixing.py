"""Domain posteriors on held-out labels, and the whole query against a plain solution."""

import uuid
import zlib

import numpy as np
import pytest

from tideline.llm import mixing
from tideline.llm import queries as Q

MID = "/root/testdata/sf0.01"


def test_posteriors_on_held_out_labels(spark):
    """A model that has not seen a quarter of the labels: right domains, toxic ones too, and shares that match the labels'."""
    root = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{root}/labels.parquet")
    labels = {r.doc_id: (r.quality, r.toxic) for r in table.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 0}
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    model = mixing.fit(docs, table.where(~table.doc_id.isin(sorted(labels))))
    got = {r.row: np.array(r.p) for r in mixing.posteriors(docs.where(docs.doc_id.isin(sorted(labels))), model, "doc_id").collect()}
    truth = np.array([mixing.DOMAINS.index(labels[d]) for d in got])
    p = np.array(list(got.values()))
    assert len(got) > 900 and (p.argmax(axis=1) == truth).mean() >= 0.94 and (p.argmax(axis=1) == truth)[truth == 2].mean() >= 0.85
    assert np.abs(p.mean(axis=0) - np.eye(len(mixing.DOMAINS))[truth].mean(axis=0)).max() < 0.02


def test_op7_end_to_end(spark):
    """Rates of all documents against accelerated projected gradient in one array, from the query's own posteriors."""
    got = Q.op7_mixing(spark, MID).toPandas().sort_values("doc_id")
    p, n = got[[f"p_quality{q}_toxic{t}" for q, t in mixing.DOMAINS]].to_numpy(), got.n_tokens.to_numpy()
    want, rate = np.array(mixing.TARGETS) / sum(mixing.TARGETS), np.ones(len(got))
    old, lam = rate, mixing.LAMBDA
    for k in range(5000):  # plain projected gradient with momentum in the metric of the token shares
        ahead = rate + k / (k + 3) * (rate - old)
        e = (n * ahead) @ p / n.sum() - want
        old, rate = rate, np.maximum(0, ahead - (p @ e + lam * (ahead - 1)) / (1 + lam))
    assert np.abs(got.rate.to_numpy() - rate).max() < 2e-2
    objective = lambda r: ((((n * r) @ p / n.sum() - want) ** 2).sum() + lam * (n / n.sum() * (r - 1) ** 2).sum()) / 2
    assert objective(got.rate.to_numpy()) <= objective(rate) * 1.001 + 1e-9


def plain(p, n, targets, steps=20_000):
    """Rates by accelerated projected gradient in one array."""
    want, rate, lam = np.array(targets) / sum(targets), np.ones(len(n)), mixing.LAMBDA
    old = rate
    momentum = (1 - np.sqrt(lam / (1 + lam))) / (1 + np.sqrt(lam / (1 + lam)))
    for _ in range(steps):
        ahead = rate + momentum * (rate - old)
        old, rate = rate, np.maximum(0, ahead - ((n * ahead) @ p / n.sum() - want) @ p.T / (1 + lam) - lam * (ahead - 1) / (1 + lam))
    return rate


def counting_jobs(spark, work):
    """(result, Spark jobs that it ran)."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "jobs of a test")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("targets", [mixing.TARGETS, (0.25, 0.25, 0.25, 0.25), (0.0, 0.0, 0.0, 1.0), (1.0, 0.0, 0.0, 0.0)])
@pytest.mark.parametrize("spread", [(1, 0.5, 0.3, 0.2), (0.02, 0.01, 0.01, 0.002)])
def test_residuals_are_the_projected_gradients_end(spark, targets, spread):
    """Near and far targets, soft and nearly hard posteriors: the same rates as many plain steps, from a few sums."""
    r = np.random.default_rng(7)
    p, n = r.dirichlet(spread, 300), r.integers(0, 500, 300)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, p array<double>").repartition(3)
    y, jobs = counting_jobs(spark, lambda: mixing.fit_residuals(df, targets))
    back = df.withColumn("rate", mixing.rate_at(y)).collect()
    p, n, got = np.array([x.p for x in back]), np.array([x.n_tokens for x in back]), np.array([x.rate for x in back])
    assert np.abs(got - plain(p, n, targets)).max() < 1e-3 and (got >= 0).all()
    assert np.abs((n * got) @ p / n.sum() - np.array(targets) / sum(targets) - y).max() < 1e-7
    assert jobs <= 30  # at most ten aggregations of up to three jobs each


def test_no_tokens(spark):
    for rows in ([], [(0, [0.25] * 4)] * 3):
        df = spark.createDataFrame(rows, "n_tokens long, p array<double>")
        assert (mixing.fit_residuals(df) == 0).all() and [x.rate for x in df.select(mixing.rate_at(np.zeros(4)).alias("rate")).collect()] == [1.0] * len(rows)
