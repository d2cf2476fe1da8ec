"""Mixing to target weights with soft membership.

A softmax classifier, fitted on the labelled table, gives every document posteriors over domains (the combinations of
the two labels) from measures of its whole text and from the words that tell toxic texts. Non-negative document rates are then found by projected-gradient least
squares so that the expected tokens of each domain, sum over documents of rate * tokens * posterior, match the targets:

    minimise  1/2 * |(sum_d r_d n_d P_d - T) / N|^2 + LAMBDA/2 * sum_d (n_d / N) (r_d - 1)^2   over r >= 0.

In the metric n_d / N the gradient of a document needs its own posteriors and the domains' residuals e alone, and a projected step of
length 1 / LAMBDA takes every rate to max(0, 1 - P_d.e / LAMBDA). Residuals from which the step comes back to themselves are the minimum;
they are found by a few distributed sums in built-in expressions (`fit_residuals`), and no rate is kept between steps.
A token is a word between white space here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import quality
from tideline.llm.classify import Lookup, adam, fit_words, labelled_texts, word_logits
from tideline.llm.common import Stash, small_batches

#: Domains: (quality, toxic) of the labels, with the target shares of all tokens.
DOMAINS = ((1, 0), (0, 0), (1, 1), (0, 1))
TARGETS = (0.83, 0.045, 0.115, 0.01)
#: Bounds of the fit: labelled rows read, and word features kept.
LABELLED, FEATURES = 8_000, 2_048
LAMBDA, STEPS, CLOSE = 0.005, 80, 1e-8


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Classifier:
    """Softmax over the bins of quality.describe's measures and of the word logit of toxicity."""

    def __init__(self, x: np.ndarray, logit: np.ndarray, domain: np.ndarray, features: np.ndarray, words: np.ndarray, k: int = len(DOMAINS)):
        self.bins, self.features, self.words = quality.Bins.of(x), features, words
        self.cuts = np.quantile(logit, np.linspace(0, 1, quality.BINS + 1)[1:-1]) if len(logit) else np.zeros(quality.BINS - 1)
        size, width = quality.SIZE + quality.BINS, quality.N + 1
        self.weights = np.zeros((size, k))
        if not len(x):
            return
        rows, truth = self.inputs(x, logit), np.eye(k)[domain]

        def gradient(w: np.ndarray) -> np.ndarray:
            w = w.reshape(size, k)
            off = (softmax(w[rows].sum(axis=1) + w[-1]) - truth) / len(x)
            g = np.stack([np.bincount(rows.ravel(), np.repeat(off[:, j], width), size) for j in range(k)], axis=1)
            g[-1] = off.sum(axis=0)
            return (g + 1e-4 * w).ravel()

        self.weights = adam(gradient, size * k, 300, 0.05).reshape(size, k)

    def inputs(self, x: np.ndarray, logit: np.ndarray) -> np.ndarray:
        """The active input of each measure, the word logit's last."""
        return np.concatenate([self.bins.inputs(x), quality.N * quality.BINS + np.searchsorted(self.cuts, logit, side="right")[:, None]], axis=1)

    def posteriors(self, x: np.ndarray, logit: np.ndarray) -> np.ndarray:
        return softmax(self.weights[self.inputs(x, logit)].sum(axis=1) + self.weights[-1])


def _lower(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]


def _described(find: Lookup, words: np.ndarray, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(measures, word logit) of texts."""
    return np.array([quality.describe(t) for t in texts]).reshape(-1, quality.N), word_logits(_lower(texts), find, words)


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Classifier from docs (doc_id, text) and labels (doc_id, quality, toxic): at most LABELLED labelled rows, chosen by
    the hash of their ids, one for each id. Half of them teach which words tell toxic texts, the other half how far to trust
    that. Labels that are null or no domain are left out; without labels all posteriors are equal."""
    small_batches(docs.sparkSession)
    stash = Stash(docs.sparkSession, "domains")
    domain = F.coalesce(*[F.when((F.col("quality") == q) & (F.col("toxic") == t), k) for k, (q, t) in enumerate(DOMAINS)])
    texts = stash.save(labelled_texts(docs, labels.select("doc_id", domain.alias("label")), LABELLED))
    toxic = [k for k, (_, t) in enumerate(DOMAINS) if t]
    half = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    features, words = fit_words(texts.where(half).select(F.col("label").isin(toxic).cast("int").alias("label"), "text"), lambda: _lower, stash, FEATURES)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(features)
        for b in batches:
            x, logit = _described(find, words, b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * quality.N, x.ravel()), pa.array(logit), b.column(2)], ["label", "x", "logit", "half"])

    got = texts.select("label", "text", half.alias("half")).mapInArrow(describe, "label int, x array<double>, logit double, half boolean").toArrow()
    if not got.num_rows:
        return Classifier(np.zeros((0, quality.N)), np.zeros(0), np.zeros(0, int), features, words)
    x, logit, domain, first = _p(got.column("x").combine_chunks()), got.column("logit").to_numpy(), got.column("label").to_numpy(), got.column("half").to_numpy()
    use = ~first if (~first).any() else first
    return Classifier(x[use], logit[use], domain[use], features, words)


def posteriors(docs: DataFrame, model: Classifier, row_col: str, text_col: str = "text") -> DataFrame:
    """(row, n_tokens, p array<double>) for each row of docs; row_col may be a struct of columns to carry along."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, find = len(DOMAINS), Lookup(model.features)
        for b in batches:
            texts = b.column(1).to_pylist()
            p = model.posteriors(*_described(find, model.words, texts)).round(9)
            n = np.array([len(t.split()) if t else 0 for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * k, p.ravel())], ["row", "n_tokens", "p"])

    rows = docs.select(F.col(row_col).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, p array<double>")


def _p(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def rate_at(y: np.ndarray) -> Column:
    """The rate after a projected-gradient step of length 1 / LAMBDA from a point of residuals y, of a row with posteriors p."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.col("p")[j] * float(v / LAMBDA) for j, v in enumerate(y)), F.lit(0.0)))


def fit_residuals(table: DataFrame, targets: tuple[float, ...] = TARGETS, steps: int = STEPS) -> np.ndarray:
    """Residuals y of the domains at the smallest objective, over (n_tokens, p): the projected step from y comes back to y.

    A step is one aggregation of built-in sums: the residuals that the rates at y have, and the second moments of the
    documents whose rate is above zero. While the set of these stays the same all further gradient steps are linear in y, so the moments give
    where they would end; a step that raises the value is halved. Without tokens the residuals are zero.
    """
    k = len(targets)
    n, p, r = F.col("n_tokens"), [F.col("p")[j] for j in range(k)], F.col("r")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    want = np.array(targets) / sum(targets)
    sums = [F.sum("n_tokens"), F.sum(n * r * r), *[F.sum(n * r * x) for x in p], *[F.sum(F.when(r > 0, n * p[i] * p[j]).otherwise(0.0)) for i, j in pairs]]

    def at(y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray] | None:
        """Value, gradient and curvature at y."""
        total, square, *got = table.withColumn("r", rate_at(y)).agg(*sums).first()
        if not total:
            return None
        got = np.array(got, float) / total
        curve = np.eye(k)
        for (i, j), v in zip(pairs, got[k:]):
            curve[i, j] += v / LAMBDA
            curve[j, i] = curve[i, j]
        return LAMBDA / 2 * square / total + want @ y + y @ y / 2, want + y - got[:k], curve

    y, now = np.zeros(k), at(np.zeros(k))
    move = None
    for _ in range(steps):
        if now is None or np.abs(now[1]).max() < CLOSE:
            break
        move = -np.linalg.solve(now[2], now[1]) if move is None else move / 2
        then = at(y + move)
        if then[0] <= now[0] + 1e-4 * now[1] @ move + 1e-14:
            y, now, move = y + move, then, None
    return np.round(y, 10)


def mix(docs: DataFrame, labels: DataFrame, train: DataFrame | None = None, row_col: str = "doc_id", text_col: str = "text", targets: tuple[float, ...] = TARGETS) -> DataFrame:
    """(row, n_tokens, p, rate): a row for each row of docs, with the rate at which it should occur in the mix.

    train: documents to learn the domains from (docs if not given). Texts without words have no tokens, take no part in
    the sums and get a rate by their posteriors all the same; a null text is empty; repeated rows each have a rate; an
    empty table gives an empty result. Targets out of reach are approached in the least-squares sense.
    """
    stash = Stash(docs.sparkSession, "mixing")
    table = stash.save(posteriors(docs, fit(train if train is not None else docs, labels), row_col, text_col))
    return table.withColumn("rate", F.round(rate_at(fit_residuals(table, targets)), 6))


def copies(rate: str, *seed: str):
    """How often a row occurs: the rate's whole part, and once more with the probability of its fraction, by hash."""
    u = F.pmod(F.xxhash64(F.lit(7), *seed), F.lit(1_000_000)) / 1_000_000
    return (F.floor(rate) + (u < F.col(rate) - F.floor(rate)).cast("int")).cast("int")
