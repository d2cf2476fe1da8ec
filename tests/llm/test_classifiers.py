"""Held-out accuracy, deobfuscation, and mixing against a direct solution."""

import numpy as np
import pytest

from tideline.llm import mixing, packing, quality, toxicity
from tideline.llm import queries as Q

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}


@pytest.mark.parametrize("name, column, least", [("op4_quality", "quality", 0.93), ("op8_toxicity", "toxic", 0.93)])
def test_held_out(spark, labels, name, column, least):
    got = Q.queries()[name](spark, MID).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got)
    held = [(r.predicted, labels[r.doc_id][column]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= least


@pytest.mark.parametrize("name, column, ones, zeros", [("op4_quality", "quality", 0.98, 0.95), ("op8_toxicity", "toxic", 0.84, 0.98)])
def test_held_out_classes(spark, name, column, ones, zeros):
    """Recall of each class at the query's threshold on the larger table, where one class has six rows of seven."""
    root = "/root/testdata/sf0.1"
    truth = {r.doc_id: r[column] for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in Q.queries()[name](spark, root).where("held_out").collect() if r.doc_id in truth]
    assert np.mean([a for a, b in held if b == 1]) >= ones and np.mean([1 - a for a, b in held if b == 0]) >= zeros


def test_restoring(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    restore = toxicity.Restorer(toxicity.language_model(toxicity.count_trigrams(docs)))
    for written, plain in {"tr4sh cl0wn": "trash clown", "m.0.r.0.n": "moron", "stuuuupid $cum": "stupid scum", "the loss!!": "the loss!!", "": ""}.items():
        assert restore.all([written])[0].decode() == plain
    assert restore.all([None]) == [b""]


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (None, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert [r.score for r in quality.judge(docs, none).collect()] == [0.5] * 3
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0.5] * 3


def test_mixing_matches_direct_solution(spark):
    r = np.random.default_rng(7)
    p, n = r.dirichlet([1, 0.5, 0.3, 0.2], 400), r.integers(1, 500, 400)
    total, want = n.sum(), np.array(mixing.TARGETS)
    table = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(n, p))], "row long, n_tokens long, p array<double>")
    rate = np.array([x.rate for x in table.withColumn("rate", mixing.rate_at(mixing.fit_residuals(table))).orderBy("row").collect()])
    e = (n * rate) @ p / total - want
    best = np.maximum(0, 1 - p @ e / mixing.LAMBDA)  # the optimality condition of every document
    assert np.abs(best - rate).max() < 1e-3 and (rate >= 0).all()
    assert np.abs(e).max() < np.abs(n @ p / total - want).max() / 5


def test_op7(spark):
    got = Q.op7_mixing(spark, MID).toPandas()
    p, n = got[[c for c in got if c.startswith("p_")]].to_numpy(), got.n_tokens.to_numpy()
    assert len(got) == 1000 and np.allclose(p.sum(axis=1), 1, atol=1e-6) and (got.rate >= 0).all()
    before, after = n @ p / n.sum(), (n * got.rate.to_numpy()) @ p / n.sum()
    assert np.abs(after - mixing.TARGETS).max() < 0.02 < np.abs(before - mixing.TARGETS).max()


def test_packing_limits():
    r = np.random.default_rng(0)
    d = np.stack([r.integers(1, 200, 500), np.ones(500, int), r.integers(0, 100, 500)], axis=1)
    d[:, 2] = np.minimum(d[:, 2], d[:, 0])
    cap = np.array([256, 4, 120])
    bins, used = packing.dot_product_pack(d, cap)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert all((d[b].sum(axis=0) <= cap).all() for b in bins) and (used <= cap).all()


@pytest.mark.parametrize("segments, loss", [(3, 100), (256, 2048)])
def test_pack_small(spark, segments, loss):
    rows = [(i, "word " * (i * 7 % 90)) for i in range(60)] + [(None, None), (3, ""), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = packing.pack(df, Q.vocabulary(), size=128, segments=segments, loss_limit=min(loss, 128)).collect()
    by = {}
    for x in got:
        by.setdefault(x.sequence_id, []).append(x)
        assert len(x.ids) == 4 * x.length
    for s in by.values():
        s.sort(key=lambda x: x.offset)
        assert len(s) <= segments and sum(x.loss_tokens for x in s) <= loss
        assert [x.offset for x in s] == [0, *np.cumsum([x.length for x in s])[:-1]] and sum(x.length for x in s) <= 128
    assert len({(x.sequence_id >> 40, x.row_in_task) for x in got}) == len(rows)


def test_decoding_is_the_best_reading():
    """Viterbi against the cost of every reading of short spans."""
    from itertools import product

    r = np.random.default_rng(4)
    lm = np.log(r.dirichlet(np.ones(toxicity.SIZE), (toxicity.SIZE, toxicity.SIZE)))

    def readings(span):
        """(text, channel cost) of every way to read a span: the channel's rules stated once more, run by run."""
        runs = []
        for c in span:
            runs.append((c, runs.pop()[1] + 1) if runs and runs[-1][0] == c else (c, 1))
        choices = []
        for c, n in runs:
            if c in toxicity.ALPHABET:
                some = [(c * n, 0.0)] if n < 3 else [(c, toxicity.REPEAT), (2 * c, toxicity.REPEAT + 0.5)]
                some += [(c, toxicity.REPEAT + 1.5)] if n == 2 else []
            elif c in toxicity.BETWEEN:
                some = [("", toxicity.SPREAD), (" ", toxicity.PLAIN)]
            else:
                some = [(c, toxicity.PLAIN)]
                for x in toxicity.SIGNS.get(c, ""):
                    some += [(x * k, toxicity.SWAP * n) for k in ([1, 2] if n > 1 else [1])]
            choices.append(some)
        for way in product(*choices):
            yield "".join(t for t, _ in way), sum(c for _, c in way)

    def cost(text, channel):
        a = b = 0
        for ch in text + "\n":
            k = toxicity.ALPHABET.find(ch) + 1 if ch != "\n" else 0
            channel -= lm[a, b, k]
            a, b = b, k
        return channel

    for span in ["1d10t", "m.0.r", "baaad1", "aab", "s t 1", "h3ll00", "x", "1", "..", "a11", "zzz22"]:
        best = min(cost(t, c) for t, c in readings(span))
        got = toxicity.decode(span, lm.tolist())
        assert min(cost(t, c) for t, c in readings(span) if t == got) == pytest.approx(best)


def test_labelled_texts_one_row_an_id(spark):
    """Repeated ids count once, before the bound and after the join."""
    from tideline.llm import classify

    labels = spark.createDataFrame([(1, 1)] * 50 + [(2, 0), (3, None), (None, 1), (1, 0)], "doc_id long, label int")
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, None), (4, "x"), (None, "y")] * 3, "doc_id long, text string")
    assert sorted(map(tuple, classify.labelled_texts(docs, labels, 2).collect())) == [(0, ""), (0, "a")]
