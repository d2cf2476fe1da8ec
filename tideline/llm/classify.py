"""Shared parts of the two text classifiers: labelled rows, word features by hash, logistic regression."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose arrays are held at once; longer texts are taken in parts cut at blanks.
PART = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id gives null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def smallest(ids: DataFrame, bound: int) -> DataFrame:
    """At most `bound` rows of (doc_id, ...): those whose ids hash lowest, the same ones on every run."""
    return ids.where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), *ids.columns).limit(bound)


def labelled_texts(docs: DataFrame, labels: DataFrame, bound: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label, text) of at most `bound` ids of labels (doc_id, label), chosen by hash: one row for each id that docs has, with the
    smallest of its labels and of its texts. Null ids and labels are left out."""
    one = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = F.broadcast(smallest(one, bound))  # at most `bound` rows
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, "doc_id")
    return texts.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text")).select("label", "text")


def powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """The first n powers of an odd base modulo 2^64, and of its inverse."""
    if cache.get("n", 0) < n:
        size = max(n, PART + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        grow = lambda b: np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))))
        cache.update(n=size, up=grow(_BASE), down=grow(inverse))
    return cache["up"][:n], cache["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash's bits (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def parts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """Texts joined by newlines into parts of about PART bytes, with the first byte of each: yields (starts, owners), bytes."""
    held, starts, owners, size = [], [], [], 0
    for k, t in enumerate(texts):
        at = 0
        while True:
            end = len(t)
            if end - at > PART:
                cut = t.rfind(b" ", at, at + PART)
                end = cut if cut > at else at + PART
            if size and size + end - at > PART:
                yield (np.array(starts), np.array(owners)), b"".join(held)
                held, starts, owners, size = [], [], [], 0
            held += [t[at:end], b"\n"]
            starts.append(size), owners.append(k)
            size += end - at + 1
            at = end
            if at >= len(t):
                break
    if size:
        yield (np.array(starts), np.array(owners)), b"".join(held)


_LETTER = np.zeros(256, bool)
_LETTER[list(range(97, 123)) + list(range(128, 256))] = True
PREFIXES = (4, 5, 6)


def word_features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, 32-bit feature) of every word and of its prefixes of PREFIXES bytes, for lower-case UTF-8 texts."""
    for (starts, owners), raw in parts(texts):
        b = np.frombuffer(raw, np.uint8)
        letter = _LETTER[b]
        edge = np.flatnonzero(np.diff(letter.view(np.int8), prepend=0, append=0))
        s, e = edge[::2], edge[1::2]
        if not len(s):
            continue
        up, down = powers(len(b) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)])))
        doc = owners[np.searchsorted(starts, s, side="right") - 1]
        for k in (0, *PREFIXES):
            long = slice(None) if not k else e - s > k
            x, y = s[long], (e[long] if not k else s[long] + k)
            h = mix((total[y] - total[x]) * down[x] + np.uint64(k))
            yield doc[long], (h >> np.uint64(32)).astype(np.uint32)


class Lookup:
    """Positions of 32-bit features in a sorted array, -1 where absent; a bit table spares most of the searches."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.bits = np.zeros(1 << 20, bool)
        self.bits[features >> 12] = True

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, positions) of what is there."""
        at = np.flatnonzero(self.bits[h >> 12])
        pos = np.searchsorted(self.features, h[at])
        pos[pos == len(self.features)] = 0
        ok = self.features[pos] == h[at] if len(self.features) else np.zeros(len(at), bool)
        return at[ok], pos[ok]


def fit_words(texts: DataFrame, prepare: Callable[[], Callable[[list[str | None]], list[bytes]]], stash, bound: int, least: int = 3, ratio: float = 10.0) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights with the bias last) of a logistic regression on the word features of (label 0 or 1, text).

    prepare() makes, once a task, the function that turns texts into lower-case UTF-8. Kept are at most `bound` features, those
    whose counts of texts differ most between the labels (log-likelihood ratio), counted by Spark; of a text only the
    places of kept features reach the driver, so neither its length nor the vocabulary does.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = prepare()
        for b in batches:
            seen: list[list[np.ndarray]] = [[] for _ in range(b.num_rows)]
            for doc, h in word_features(ready(b.column(1).to_pylist())):
                pair = np.unique(doc.astype(np.uint64) << np.uint64(32) | h)
                cut = np.searchsorted(pair >> np.uint64(32), np.arange(b.num_rows + 1))
                for k in np.flatnonzero(np.diff(cut)):
                    seen[k].append(pair[cut[k] : cut[k + 1]].astype(np.uint32))
            found = [np.unique(np.concatenate(s)).astype(np.int64) if s else np.zeros(0, np.int64) for s in seen]
            ends = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *found])))], ["label", "features"])

    rows = stash.save(texts.select(F.col("label").cast("int").alias("label"), "text").mapInArrow(sets, "label int, features array<long>"))
    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n:
        return np.zeros(0, np.uint32), np.zeros(1)
    share, all_, ones = n1 / n, F.col("t"), F.col("a")
    part = lambda k, e: F.when(k > 0, k * F.log(k / F.greatest(e, F.lit(1e-9)))).otherwise(0.0)
    llr = part(ones, all_ * share) + part(all_ - ones, all_ * (1 - share)) + part(n1 - ones, (n - all_) * share) + part(n - n1 - all_ + ones, (n - all_) * (1 - share))
    counts = rows.select("label", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("t"), F.sum("label").alias("a"))
    kept = counts.withColumn("llr", 2 * llr).where((F.col("llr") > ratio) & (all_ >= least)).orderBy(F.desc("llr"), "f").limit(bound).select("f").toArrow()
    features = np.sort(kept.column("f").to_numpy().astype(np.uint32))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(features)
        for b in batches:
            at = [find(x.values.to_numpy().astype(np.uint32))[1].astype(np.int32) for x in b.column(1)]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in at]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *at])))], ["label", "at"])

    got = rows.mapInArrow(places, "label int, at array<int>").toArrow()
    y, at = got.column("label").to_numpy().astype(np.float64), got.column("at").combine_chunks()
    lines, cols = np.repeat(np.arange(len(y)), at.value_lengths().to_numpy()), at.flatten().to_numpy()

    def gradient(w: np.ndarray) -> np.ndarray:
        off = sigmoid(np.bincount(lines, w[cols], len(y)) + w[-1]) - y
        g = np.bincount(cols, off[lines], len(w)) + 0.05 * w
        g[-1] = off.sum() + 0.001 * w[-1]
        return g / len(y)

    return features, adam(gradient, len(features) + 1, 400, 0.05)


def word_logits(texts: list[bytes], find: Lookup, weights: np.ndarray) -> np.ndarray:
    """Logit of each lower-case UTF-8 text: the bias and the weights of its distinct features."""
    wide = np.uint64(max(1, len(find.features)))
    found = [np.zeros(0, np.uint64)]
    for doc, h in word_features(texts):
        at, pos = find(h)
        found.append(np.unique(doc[at].astype(np.uint64) * wide + pos.astype(np.uint64)))
    pair = np.unique(np.concatenate(found))
    z = np.full(len(texts), weights[-1])
    return z + np.bincount((pair // wide).astype(np.int64), weights[(pair % wide).astype(np.int64)], len(texts)) if len(pair) else z


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def adam(gradient, n: int, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam from zero."""
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)
    for t in range(1, steps + 1):
        g = gradient(w)
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w
