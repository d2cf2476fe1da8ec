"""Quality by positive-unlabelled learning: a linear model minimises the non-negative unbiased risk.

Trusted positives are labelled rows of quality 1; the unlabelled web text is every document, labelled or not, without its label.
Each text is described by shares and rates of its characters, words and lines over its whole length; quantile bins of these
(edges over all documents) make the linear model's inputs. With the squared loss the risk depends on the data through the
means and second moments of the inputs alone, so one distributed pass over all documents gives the unlabelled part exactly,
and the minimum is found from these sums:

    prior * E+[(z - 1)^2] + max(0, Eu[(z + 1)^2] - prior * E+[(z + 1)^2])

The class prior is estimated from positives and unlabelled text (best bin estimation: the smallest ratio of the shares of the
two above a threshold of a positive-against-unlabelled score, on positives that the score has not seen). Labels of class 0
are never used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.classify import sigmoid, smallest
from tideline.llm.common import Stash, small_batches

#: Bound on the trusted positives that the fit reads; everything else covers all rows.
POSITIVES = 20_000
BINS = 24
#: Decay of the weights; for the score of the prior's estimate it falls with the number of positives.
DECAY, PRIOR_DECAY = 1e-3, 100.0
#: Cells of a histogram of scores, and the failure probability and slack of the prior's confidence bound.
CELLS, DELTA, SLACK = 4096, 0.1, 0.01
#: Score of the median trusted positive, and of the boundary: the raw score above which a share of the prior of all documents lies.
SURE, CUT = 0.99, 0.3
_ZIP = 1 << 16


def describe(text: str | None) -> list[float]:
    """Measures of one whole text."""
    t = text or ""
    b = t.encode("utf-8", "surrogatepass")
    n = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    size = max(1, len(b))
    w = t.split()
    words = max(1, len(w))
    upper, lower, digits, wide = n[65:91].sum(), n[97:123].sum(), n[48:58].sum(), n[128:].sum()
    space, stops = n[9:14].sum() + n[32], n[44] + n[46]
    packed = sum(len(zlib.compress(b[i : i + _ZIP], 1)) for i in range(0, len(b), _ZIP)) / size
    lines = t.split("\n")
    return [
        np.log1p(len(w)), len(set(w)) / words, upper / size, lower / size, wide / size, digits / size, space / size, stops / size,
        (size - upper - lower - wide - digits - space - stops) / size, upper / max(1, upper + lower), packed, (size - space) / words,
        n[10] / words, sum(map(str.__eq__, w, w[1:])) / words, len(set(lines)) / len(lines), n[124] / words, n[33] / words, max(map(len, w), default=0),
    ]


N = len(describe(""))


SIZE = N * BINS + 1


class Bins:
    """Quantile bins of the measures: features x (BINS - 1) edges."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges

    @classmethod
    def of(cls, x: np.ndarray) -> Bins:
        return cls(np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if len(x) else np.zeros((N, BINS - 1)))

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """The active input of each measure."""
        return np.stack([np.searchsorted(self.edges[j], x[:, j], side="right") + j * BINS for j in range(N)], axis=1)


def moments(rows: np.ndarray) -> np.ndarray:
    """Sums of the products of any two inputs over the rows' active inputs; the last input is one everywhere."""
    out = np.zeros((SIZE, SIZE))
    for at in range(0, len(rows), 4096):
        on = np.zeros((len(rows[at : at + 4096]), SIZE), np.float32)
        on[np.arange(len(on))[:, None], rows[at : at + 4096]] = 1
        on[:, -1] = 1
        out += on.T @ on
    return out


def discriminator(positive: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Weights that tell positives (1) from unlabelled rows (-1), both given by their moments."""
    a, b = positive / positive[-1, -1], unlabelled / unlabelled[-1, -1]
    return np.linalg.solve(a + b + (DECAY + PRIOR_DECAY / positive[-1, -1]) * np.eye(SIZE), a[-1] - b[-1])


def risk(w: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk: of the positives, and of the unlabelled rows taken as negative less the positives among them."""
    a, b = positive / positive[-1, -1], unlabelled / unlabelled[-1, -1]
    square = lambda m, t: float(w @ m @ w - 2 * t * m[-1] @ w + 1)
    return prior * square(a, 1), square(b, -1) - prior * square(a, -1)


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights of the smallest non-negative risk. Where the second part would be negative the minimum lies where it is zero:
    its weight there is found by bisection."""
    a, b = positive / positive[-1, -1], unlabelled / unlabelled[-1, -1]

    def at(share: float) -> np.ndarray:
        return np.linalg.solve(prior * a + share * (b - prior * a) + DECAY * np.eye(SIZE), prior * a[-1] - share * (b[-1] - prior * a[-1]))

    if risk(at(1.0), positive, unlabelled, prior)[1] >= 0:
        return at(1.0)
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (low, middle) if risk(at(middle), positive, unlabelled, prior)[1] < 0 else (middle, high)
    return at(high)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Class prior from histograms, over the same cells in rising order, of held-out positives' and of unlabelled rows' scores."""
    above = lambda n: n[::-1].cumsum()[::-1] / max(1, n.sum())
    p, u = above(positive), above(unlabelled)
    bound = sum(np.sqrt(np.log(4 / DELTA) / 2 / max(1, n.sum())) for n in (positive, unlabelled))
    ok = np.flatnonzero(p > 0)
    if not len(ok):
        return 0.5
    k = ok[np.argmin((u[ok] + (1 + SLACK) * bound) / p[ok])]
    return float(np.clip(u[k] / p[k], 0.01, 0.99))


@dataclass
class Model:
    bins: Bins
    weights: np.ndarray
    prior: float
    centre: float = 0.0  # the raw score above which a share of `prior` of all documents lies
    slope: float = 0.0
    cut: float = 0.5  # the score at the centre

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.bins.inputs(x)].sum(axis=1) + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (self.raw(x) - self.centre) + np.log(self.cut / (1 - self.cut)))

    def span(self) -> tuple[float, float]:
        """The smallest and largest raw score there can be."""
        w = self.weights[:-1].reshape(N, BINS)
        return float(w.min(axis=1).sum() + self.weights[-1]), float(w.max(axis=1).sum() + self.weights[-1])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([describe(t) for t in b.column(1).to_pylist()], np.float64).reshape(-1, N)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * N, x.ravel())], ["id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(work, "id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, N)


def _sums(measured: DataFrame, name: str, work) -> np.ndarray:
    """Sums over all rows of what work(x) counts in a fixed number of cells: each task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            n = work(_matrix(b.column(0)))
            total = n if total is None else total + n
        at = np.flatnonzero(total) if total is not None else np.zeros(0, int)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64) if len(at) else at)], [name, "n"])

    return measured.select("x").mapInArrow(run, f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n")).toArrow()


def all_moments(measured: DataFrame, bins: Bins) -> np.ndarray:
    t = _sums(measured, "cell", lambda x: np.triu(moments(bins.inputs(x))).ravel())
    out = np.zeros(SIZE * SIZE)
    out[t.column("cell").to_numpy()] = t.column("n").to_numpy()
    out = out.reshape(SIZE, SIZE)
    return np.maximum(out, out.T)


def _cells(raw: np.ndarray, span: tuple[float, float]) -> np.ndarray:
    """Histogram of raw scores."""
    low, high = span
    return np.bincount(np.clip((raw - low) / max(high - low, 1e-12) * CELLS, 0, CELLS - 1).astype(int), minlength=CELLS)


def all_cells(measured: DataFrame, model: Model) -> np.ndarray:
    t = _sums(measured, "cell", lambda x: _cells(model.raw(x), model.span()))
    out = np.zeros(CELLS, np.int64)
    out[t.column("cell").to_numpy()] = t.column("n").to_numpy()
    return out


def fit(measured: DataFrame, labelled: DataFrame, cut: float = CUT) -> Model:
    """Model from the measures (id, x) of all documents and the labelled rows (doc_id, label 0 or 1) that may be learnt from.

    Bin edges, moments, prior and the score's centre come from distributed passes over all rows of `measured`. At most POSITIVES
    positives are read, chosen by the hash of their ids, one row for each id. `cut` is the score of the boundary between the
    classes. Rows with a null id or label are left out there; without positives or without texts every score is one half.
    """
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1].tolist()
    edges = measured.agg(*[F.percentile_approx(F.col("x")[j], quantiles, 10_000).alias(f"q{j}") for j in range(N)]).first()
    chosen = smallest(labelled.where("label = 1 AND doc_id IS NOT NULL").select("doc_id").distinct(), POSITIVES)
    trusted = measured.join(F.broadcast(chosen), F.col("id") == F.col("doc_id")).groupBy("id").agg(F.min("x").alias("x")).orderBy(F.xxhash64("id")).toArrow()  # at most POSITIVES rows
    if not trusted.num_rows:
        return Model(Bins.of(np.zeros((0, N))), np.zeros(SIZE), 0.5)
    bins = Bins(np.array(edges, float))
    rows = bins.inputs(_matrix(trusted.column("x").combine_chunks()))
    seen = rows[::2] if len(rows) > 1 else rows
    unlabelled = all_moments(measured, bins)
    first = Model(bins, discriminator(moments(seen), unlabelled), 0.5)
    raw = lambda w, r: w[r].sum(axis=1) + w[-1]
    prior = estimate_prior(_cells(raw(first.weights, rows[1::2] if len(rows) > 1 else rows), first.span()), all_cells(measured, first))
    model = Model(bins, minimise(moments(rows), unlabelled, prior), prior)
    low, high = model.span()
    above = all_cells(measured, model)[::-1].cumsum()[::-1]
    k = int(np.flatnonzero(above >= prior * above[0])[-1])
    model.centre = low + (high - low) * k / CELLS
    model.cut, odds = cut, lambda p: np.log(p / (1 - p))
    model.slope = float((odds(SURE) - odds(cut)) / max(np.median(raw(model.weights, rows)) - model.centre, 0.05))
    return model


def score(measured: DataFrame, model: Model) -> DataFrame:
    """(id, score): one row for each row of measured (id, x). Null and empty texts are scored like any other; an empty table
    gives an empty result. No shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))) if b.num_rows else np.zeros(0))], ["id", "score"])

    return measured.select("id", "x").mapInArrow(work, "id long, score double")


def judge(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """(id, score) for every row of docs, by a model fitted on all of them and on the labelled rows given; each text is read once.
    A score of `cut` or more is what the model takes for class 1.
    Repeated rows are scored each; other columns are ignored."""
    measured = Stash(docs.sparkSession, "quality").save(measures(docs, id_col, text_col))
    return score(measured, fit(measured, labelled, cut))
