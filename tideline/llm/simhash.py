"""SimHash near-duplicates: 64-bit fingerprints linked at few differing bits, with pivot distance tables.

Distances to reference fingerprints alone give no key to join on, so which pairs meet is settled by an exact pigeonhole rule
(two fingerprints within `radius` bits agree on at least `m - radius` of m bit blocks): no link is lost. The pivot table, the
Hamming distances to `PIVOTS` reference fingerprints, is computed once for each distinct fingerprint and goes with it into
its buckets. There it orders the fingerprints, so that only those within the radius in the first coordinate are paired, and
discards every pair whose largest coordinate difference exceeds the radius (triangle inequality); survivors are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Stash, by_group, connected_components, labels_of, small_batches

PIVOTS = 16
TABLE = ("p1", "p2")  # the pivot table of a fingerprint, a byte a distance
RADIUS = 4
WORDS = 4
#: Distinct fingerprints in a bucket beyond which it is dealt again by a further bit block (no pair is lost).
BUCKET = 20_000
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of one text: majority bits of the XXH64 values (seed 42) of its word shingles; no word gives 0."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(w) > words:
        ends, starts = ends[words - 1 :], starts[: -(words - 1) or None]
    else:
        ends, starts = ends[-1:], starts[:1]
    digest, h = xxhash.xxh64_intdigest, np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _CHUNK):
        s, e = starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist()
        h[at : at + _CHUNK] = [digest(joined[x:y], 42) for x, y in zip(s, e)]
    return majority_bits(h)


def majority_bits(h: np.ndarray) -> int:
    """The 64 majority bits of 64-bit hashes; none give 0."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), _CHUNK):
        ones += np.unpackbits(h[at : at + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fp long): the fingerprint's 64 bits as a signed long; one row for each input row."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(work, "id long, fp long")


def pivots(n: int = PIVOTS, words: int = 1) -> np.ndarray:
    """The reference fingerprints (n x words of 64 bits): fixed, spread over the whole space."""
    return np.frombuffer(np.random.default_rng(64).bytes(8 * n * words), np.uint64).reshape(n, words)


def pivot_table(fp: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Hamming distances, a byte each, of fingerprints (rows of 64-bit words) to each reference fingerprint."""
    out = np.zeros((len(fp), n), np.uint8)
    for k, p in enumerate(pivots(n, fp.shape[1])):
        out[:, k] = np.minimum(np.bitwise_count(fp ^ p).sum(axis=1), 255)  # differences can only shrink
    return out


def pivot_columns(fp: str = "fp") -> list[Column]:
    """The pivot table of a 64-bit fingerprint column as long columns p1, p2, ... with eight distances each, a byte a distance."""
    near = [F.bit_count(F.col(fp).bitwiseXOR(F.lit(int(p)))).cast("long") for p in pivots().view(np.int64).ravel()]
    return [reduce(Column.bitwiseOR, [F.shiftleft(d, 8 * k) for k, d in enumerate(near[at : at + 8])]).alias(f"p{at // 8 + 1}") for at in range(0, PIVOTS, 8)]


def _links(key: np.ndarray, fp: np.ndarray, table: np.ndarray, radius: int) -> np.ndarray:
    """Group label (an index) of each row: rows of one key linked within the radius, directly or through others."""
    n = len(fp)
    order = np.lexsort((table[:, 0], key))
    key, fp, table = key[order], fp.view(np.uint64)[order], table[order]
    first, label = table[:, 0], np.arange(n)
    i, d, held_i, held_j, held = np.arange(n), 1, [], [], 0
    while len(i):
        i = i[i + d < n]
        j = i + d
        near = (key[i] == key[j]) & (first[j] - first[i] <= radius)  # sorted by the first coordinate: none further on
        i, j = i[near], j[near]
        x, y = i, j
        for p in range(1, PIVOTS):
            ok = np.abs(table[x, p] - table[y, p]) <= radius
            x, y = x[ok], y[ok]
        ok = np.bitwise_count(fp[x] ^ fp[y]) <= radius
        held_i.append(x[ok]), held_j.append(y[ok])
        held += int(ok.sum())
        if held > 1_000_000 or not len(i):
            a, b = np.concatenate([np.arange(n), *held_i]), np.concatenate([label, *held_j])
            label, held_i, held_j, held = labels_of(n, a, b), [], [], 0
        d += 1
    out = np.empty(n, np.int64)
    out[order] = order[label]
    return out


def _in_buckets(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(t: pa.Table) -> Iterator[pa.RecordBatch]:
            key, fp, rep, *table = (t.column(c).to_numpy() for c in ("key", "fp", "rep", *TABLE))
            table = np.ascontiguousarray(np.stack(table, axis=1)).view(np.uint8).astype(np.int16)
            label = _links(key, fp, table, radius)
            low = np.full(len(rep), np.iinfo(np.int64).max)
            np.minimum.at(low, label, rep)
            low = low[label]
            far = low != rep
            yield pa.RecordBatch.from_arrays([pa.array(low[far]), pa.array(rep[far])], ["a", "b"])

        yield from by_group(batches, "key", piece)

    return work


def _block(m: int, k: int):
    """Bits of the k-th of m blocks of a fingerprint, as a column."""
    lo, hi = 64 * k // m, 64 * (k + 1) // m
    return F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def _blocks_for(n: int, radius: int) -> int:
    """How many blocks: the fewest whose agreeing bits tell n fingerprints apart, so that buckets stay small."""
    m = radius + 1
    while 64 * (m - radius) / m < np.log2(max(n, 2)) - 6 and m < radius + 4:
        m += 1
    return m


def fingerprint_components(distinct: DataFrame, stash: Stash, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(rep, component) of the representatives (fp long, rep long) that link with any other fingerprint.

    Buckets with more than `bucket` fingerprints are dealt again by the blocks of the remaining bits (again one at
    least must agree), so hot buckets shrink and no pair is lost. Buckets that stay larger after that are cut into blocks, and
    every pair of blocks is a bucket of its own.
    """
    n = distinct.count()
    m = _blocks_for(n, radius)
    facts = ("fp", "rep", *TABLE)
    distinct = distinct.select("fp", "rep", *pivot_columns())
    keys = [F.xxhash64(F.lit(i), *[_block(m, k) for k in c]) for i, c in enumerate(combinations(range(m), m - radius))]
    rows = stash.save(distinct.select(F.explode(F.array(*keys)).alias("key"), *facts))
    found = []
    for level in range(3):
        hot = stash.save(rows.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > bucket).coalesce(1))
        if hot.isEmpty():
            found.append(rows)
            break
        found.append(rows.join(hot, "key", "left_anti"))
        of = 2 * radius + 2 + 3 * level
        blocks = F.ceil(F.col("c") / max(1, bucket // 2)).cast("int")
        own = F.pmod(F.xxhash64("rep", F.lit(3)), blocks).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.xxhash64("key", F.least(j, own), F.greatest(j, own)))
        finer = F.array(*[F.xxhash64("key", F.lit(k), _block(of, k)) for k in range(of)]) if level < 2 else pairs
        rows = stash.save(rows.join(hot, "key").select(F.explode(finer).alias("key"), *facts))
        if level == 2:
            found.append(rows)
    links = None
    for part in found:
        got = part.repartition("key").sortWithinPartitions("key").mapInArrow(_in_buckets(radius), "a long, b long")
        links = got if links is None else links.unionByName(got)
    return connected_components(links, stash)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words: int = WORDS, bucket: int = BUCKET) -> DataFrame:
    """(id, fingerprint, component_id), a row for each input row.

    Null or blank texts have fingerprint zero and link like any other; a null id keeps its row, takes no part in
    choosing the smallest id, and a group of null ids alone has a null component. Repeated rows stay repeated.
    An empty table gives an empty result; columns besides the two named ones are ignored.
    """
    stash = Stash(docs.sparkSession, "simhash")
    fps = stash.save(fingerprints(docs, id_col, text_col, words))
    distinct = stash.save(fps.groupBy("fp").agg(F.min("id").alias("rep")))
    parts = fingerprint_components(distinct.where("rep IS NOT NULL"), stash, radius, bucket)
    named = distinct.join(parts, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    # one row for each fingerprint on the right: adaptive execution splits a fingerprint that very many rows carry
    return fps.join(named, "fp").select("id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
