"""Toxicity by noisy-channel deobfuscation: disguised words are restored by Viterbi decoding, then the text is scored.

The source model is a character trigram model counted over all documents; the channel turns letters into look-alike
signs, repeats letters and puts signs between them. A lattice of what each written sign may stand for is decoded for
every suspicious span of a text. The restored text's words and word beginnings are the inputs of a logistic regression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.classify import Lookup, fit_words, labelled_texts, parts, sigmoid, word_logits
from tideline.llm.common import Stash, small_batches

#: Bounds of the fit: labelled rows read, and features kept.
LABELLED, FEATURES = 8_000, 4_096
#: What a sign may stand for.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e"}
BETWEEN = " .-_*"
#: Costs in nats of the channel: a sign for a letter, a sign for itself, a letter repeated, a sign put between letters.
SWAP, PLAIN, REPEAT, SPREAD = 1.0, 2.5, 0.7, 0.3
#: Signs of a span whose restored text is remembered.
KEPT = 64
ALPHABET = "".join(chr(c) for c in [*range(97, 123), *range(0xDF, 0x100)])
SIZE = len(ALPHABET) + 1  # 0: any other sign, the edge of a word
_CODE = np.zeros(256, np.int64)
for _k, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _k + 1
_INDEX = {c: k + 1 for k, c in enumerate(ALPHABET)}


def count_trigrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n) over the whole texts of all rows: tasks count in arrays, and their sums are added up by gram."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SIZE**3, np.int64)
        for b in batches:
            texts = [t.lower().encode("latin-1", "replace") for t in b.column(0).to_pylist() if t]
            for _, raw in parts(texts):
                c = _CODE[np.frombuffer(b"\n\n" + raw, np.uint8)]
                n += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["gram", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> np.ndarray:
    """Interpolated log probabilities [a, b, c] of c after a, b. The table's size is fixed by the alphabet."""
    t = counts.toArrow()
    n3 = np.zeros(SIZE**3)
    n3[t.column("gram").to_numpy()] = t.column("n").to_numpy()
    n3 = n3.reshape(SIZE, SIZE, SIZE)
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 1) / (n1 + 1).sum()
    p2 = (n2 + 20 * p1) / (n2.sum(axis=1, keepdims=True) + 20)
    p3 = (n3 + 20 * p2[None]) / (n3.sum(axis=2, keepdims=True) + 20)
    return np.log(p3).astype(np.float32)


def decode(span: str, lm) -> str:
    """The most probable plain text of one suspicious lower-case span (Viterbi over pairs of last letters)."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for m in re.finditer(r"(.)\1*", span, re.S):
        c, run = m[1], len(m[0])
        if c in _INDEX:
            arcs = [(c * run, 0.0)] if run < 3 else [(c, REPEAT), (c + c, REPEAT + 0.5)]
            if run == 2:
                arcs.append((c, REPEAT + 1.5))
        else:
            arcs = [(c, PLAIN)] if c not in BETWEEN else [("", SPREAD), (" ", PLAIN)]
            for x in SIGNS.get(c, ""):
                arcs.append((x, SWAP * run))
                if run > 1:
                    arcs.append((x + x, SWAP * run))
        then: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, back) in states.items():
            for text, more in arcs:
                x, y, total = a, b, cost + more
                for ch in text:
                    k = _INDEX.get(ch, 0)
                    total -= lm[x][y][k]
                    x, y = y, k
                if (x, y) not in then or total < then[x, y][0]:
                    then[x, y] = (total, (text, back))
        states = then
    best = min(((cost - lm[a][b][0], back) for (a, b), (cost, back) in states.items()), key=lambda s: s[0])[1]
    out = []
    while best:
        out.append(best[0])
        best = best[1]
    return "".join(reversed(out))


_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit-like sign, 4 other sign for a letter, 8 between
_KIND[list(range(97, 123)) + list(range(128, 256))] = 1
_KIND[[ord(c) for c in "0123456789@$"]] = 2
_KIND[[ord(c) for c in "!|+"]] = 4
_KIND[[ord(c) for c in BETWEEN]] = 8


def suspicious(texts: list[bytes]) -> set[int]:
    """Which lower-case UTF-8 texts hold a sign beside a letter, a letter three times, or single letters set apart."""
    found: set[int] = set()
    for (starts, owners), raw in parts(texts):
        b = np.frombuffer(raw, np.uint8)
        k = _KIND[b]
        letter, sign = (k & 1) > 0, (k & 6) > 0
        hits = [np.flatnonzero(sign[:-1] & letter[1:]), np.flatnonzero(letter[:-1] & (k[1:] == 2))]
        if len(b) > 4:
            hits.append(np.flatnonzero(letter[2:] & (b[2:] == b[1:-1]) & (b[1:-1] == b[:-2])))
            one = letter | sign
            alone = one & ~np.concatenate(([False], one[:-1])) & ~np.concatenate((one[1:], [False]))
            gap = k == 8
            hits.append(np.flatnonzero(alone[:-4] & gap[1:-3] & alone[2:-2] & gap[3:-1] & alone[4:]))
        at = np.concatenate(hits)
        found.update(np.unique(owners[np.searchsorted(starts, at, side="right") - 1]).tolist())
    return found


_ONE = r"[^\W_]|[@$!|+€]"
_SPACED = re.compile(rf"(?<![\w@$|+€])(?:{_ONE})(?:[ .\-_*](?:{_ONE})){{2,}}(?![\w@$|+€])")
_WORD = re.compile(r"[^\W_@$!|+€]*(?:[@$!|+€0-9]|([^\W_])\1\1)[\w@$!|+€]*")
_BOTH = re.compile(r"[^\W\d_]")


class Restorer:
    """Restores texts under a language model; repeated spans are decoded once (a bounded cache)."""

    def __init__(self, lm: np.ndarray):
        lm = lm.astype(np.float64).tolist()
        short = lru_cache(maxsize=200_000)(lambda span: decode(span, lm))
        self.decode = lambda span: short(span) if len(span) <= KEPT else decode(span, lm)

    def _word(self, m: re.Match) -> str:
        w = m[0]
        tail = len(w) - len(w.rstrip("!+|"))  # marks at the end of a word are marks
        core = w[: len(w) - tail]
        return self.decode(core) + w[len(core) :] if _BOTH.search(core) else w

    def __call__(self, text: str) -> str:
        """A lower-case text with its suspicious spans replaced by what they most probably stand for."""
        return _WORD.sub(self._word, _SPACED.sub(lambda m: self.decode(m[0]), text))

    def all(self, texts: list[str | None]) -> list[bytes]:
        lower = [(t or "").lower() for t in texts]
        raw = [t.encode("utf-8", "surrogatepass") for t in lower]
        for k in suspicious(raw):
            raw[k] = self(lower[k]).encode("utf-8", "surrogatepass")
        return raw


@dataclass
class Model:
    lm: np.ndarray
    features: np.ndarray  # sorted 32-bit hashes
    weights: np.ndarray  # of the features, then the bias


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Model from docs and labelled rows (doc_id, label 0 or 1) that may be learnt from.

    The language model counts all documents. The regression reads at most LABELLED labelled rows, chosen by the hash of
    their ids, one for each id, and keeps at most FEATURES features: those whose document counts differ most between the
    labels (log-likelihood ratio). Rows with a null id or label are left out; without labels every score is one half.
    """
    lm = language_model(count_trigrams(docs, text_col))
    texts = labelled_texts(docs, labelled, LABELLED, id_col, text_col)
    return Model(lm, *fit_words(texts, lambda: Restorer(lm).all, Stash(docs.sparkSession, "toxicity"), FEATURES))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): one row for each row of docs, over its whole restored text; id_col may be a struct to carry along.

    Null and empty texts are scored like any other (by the bias alone), repeated rows each, an empty table gives an
    empty result; other columns are ignored. No shuffle.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, find = Restorer(model.lm), Lookup(model.features)
        for b in batches:
            z = word_logits(restore.all(b.column(1).to_pylist()), find, model.weights)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigmoid(z))], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def restored(docs: DataFrame, lm: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): the lower-case texts with disguised words restored."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(lm)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.decode("utf-8", "replace") for x in restore.all(b.column(1).to_pylist())])], ["id", "text"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(work, "id long, text string")
