"""Maximal periodic runs of words: suffix classes united by decreasing common prefixes, over ordered position sets."""

from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import small_batches

#: Words of a run at least (and two periods at least).
LEAST = 12
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def ordered_suffixes(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each suffix with the next one) of integers. Ranks by prefixes of 1, 2, 4, ... letters
    are refined where they tie, and kept: common prefixes are read off them from the longest down."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    new = np.append(True, s[order[1:]] != s[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, h = [rank.astype(np.int32)], 1
    live = order[~(new & np.append(new[1:], True))]
    while len(live):
        after = np.zeros(len(live), np.int64)
        inside = live + h < n
        after[inside] = rank[live[inside] + h] + 1
        key = rank[live] * (n + 1) + after
        o = np.argsort(key, kind="stable")
        live, key = live[o], key[o]
        head = rank[live]
        at = np.arange(len(live))
        new = np.append(True, key[1:] != key[:-1])
        group = np.maximum.accumulate(np.where(np.append(True, head[1:] != head[:-1]), at, 0))
        rank[live] = head + np.maximum.accumulate(np.where(new, at, 0)) - group
        levels.append(rank.astype(np.int32))
        h *= 2
        live = live[~(new & np.append(new[1:], True))]
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    a, b = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ok = np.flatnonzero((a < n) & (b < n))
        ok = ok[levels[k][a[ok]] == levels[k][b[ok]]]
        for x in (a, b, common):
            x[ok] += 1 << k
    return sa, common


def _repeated(ids: np.ndarray, doc: np.ndarray, left: np.ndarray, width: int) -> np.ndarray:
    """Positions whose `width` words come again in their document, by hash: others may slip in, none is missing."""
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        n = len(ids) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        h = doc[:n].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        for j in range(width):
            h = h * np.uint64(0xBF58476D1CE4E5B9) + x[j : n + j]
        h ^= h >> np.uint64(31)
    at = np.flatnonzero(left[:n] >= width)
    o = at[np.argsort(h[at])]
    same = h[o[1:]] == h[o[:-1]]
    hit = np.zeros(n, bool)
    hit[o[1:][same]] = True
    hit[o[:-1][same]] = True
    return np.flatnonzero(hit)


def seeds(sa: np.ndarray, common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(i, d, l): suffixes i and i+d, whose common prefix is l >= d, became neighbours in a class; d + l >= least.

    Kruskal's order: links of neighbouring suffixes by decreasing common prefix. Each class keeps its positions in order; the
    smaller class goes into the larger one, and its positions' neighbours there are the newly adjacent pairs.
    """
    links = np.flatnonzero(common >= (least + 1) // 2)
    links = links[np.argsort(-common[links], kind="stable")]
    root: dict[int, int] = {}
    places: dict[int, list[int]] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for i, j, l in zip(sa[links].tolist(), sa[links + 1].tolist(), common[links].tolist()):
        i, j = find(i), find(j)
        a, b = places.pop(i, None) or [i], places.pop(j, None) or [j]
        if len(a) > len(b):
            i, j, a, b = j, i, b, a
        root[i] = j
        for x in a:
            k = bisect(b, x)
            if k and x - b[k - 1] <= l and x - b[k - 1] + l >= least:
                yield b[k - 1], x - b[k - 1], l
            if k < len(b) and b[k] - x <= l and b[k] - x + l >= least:
                yield x, b[k] - x, l
        if 16 * len(a) < len(b):
            for x in a:
                insort(b, x)
        else:
            b += a
            b.sort()
        places[j] = b


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (text number, start, length, period) of all runs in some texts of `sizes` words, joined in `ids`; sorted.

    A run of period q and length >= max(least, 2q) repeats at least least/2 of its words at distance q, so only words in
    such repeats are sorted: the others become separators, of which no two are equal.
    """
    width = (least + 1) // 2
    doc = np.repeat(np.arange(len(sizes)), sizes)
    start = np.cumsum(sizes) - sizes
    none = np.zeros((0, 4), np.int64)
    at = _repeated(ids, doc, np.repeat(start + sizes, sizes) - np.arange(len(ids)), width)
    if not len(at):
        return none
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[at] += 1
    edge[at + width] -= 1
    used = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    cut = np.append(0, (used[1:] != used[:-1] + 1) | (doc[used[1:]] != doc[used[:-1]]))
    place = np.arange(len(used)) + np.cumsum(cut)
    letters = np.unique(doc[used] * (int(ids.max()) + 1) + ids[used], return_inverse=True)[1]
    n = int(place[-1]) + 2
    s = np.arange(n) + len(used)  # separators
    s[place] = letters
    origin = np.full(n, -1, np.int64)
    origin[place] = used
    best: dict[tuple[int, int], int] = {}
    for i, d, l in seeds(*ordered_suffixes(s), least):
        if i and s[i - 1] == s[i - 1 + d]:
            continue  # the run starts further left
        k = (i, d + l)
        best[k] = min(d, best.get(k, d))  # multiples of the period lose
    if not best:
        return none
    k = np.array(list(best), np.int64)
    first = origin[k[:, 0]]
    out = np.stack([doc[first], first - start[doc[first]], k[:, 1], np.array(list(best.values()), np.int64)], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(id, n_words, runs, kept): every maximal run of each text, and its words without those that a run repeats.

    Words are what space and the control characters 9 to 13 separate, numbered from 0. A run is a stretch with smallest
    period q, `least` words or more and two periods or more, that no neighbouring word extends; runs are sorted by start and
    period. `kept` (binary) joins the words that are in no run after its first q words by one space.

    One row for each row, repeated rows and null ids included; null and empty texts have no words, no runs and an empty
    `kept`. Whole texts are taken, one Arrow batch at a time (a text larger than a batch by itself), without a shuffle; beyond
    its words a text needs memory for those it repeats only. Other columns are ignored; an empty table gives no row.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [(t.as_py() or b"").split() for t in b.column("text")]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            number: dict[bytes, int] = {}
            fresh = count()
            ids = np.fromiter((x for ws in words for x in map(number.setdefault, ws, fresh)), np.int64, int(sizes.sum()))
            found = find_runs(ids, sizes, least)
            edges = np.searchsorted(found[:, 0], np.arange(len(words) + 1))
            runs = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], fields=list(RUN))
            kept = []
            for k, ws in enumerate(words):
                mine = found[edges[k] : edges[k + 1]]
                if len(mine):
                    edge = np.zeros(len(ws) + 1, np.int64)
                    np.add.at(edge, mine[:, 1] + mine[:, 3], 1)
                    np.add.at(edge, mine[:, 1] + mine[:, 2], -1)
                    ws = compress(ws, (np.cumsum(edge[:-1]) == 0).tolist())
                kept.append(b" ".join(ws))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs), pa.array(kept, pa.binary())], names=["id", "n_words", "runs", "kept"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept binary")
