"""Near copies of whole texts by SimHash and pivot tables, at an exact Jaccard similarity of word shingles.

`simhash.near_duplicates` links fingerprints at few bits; here a similarity of the shingle sets themselves decides:

* texts with equal shingle sets collapse first;
* sets of similarity 0.8 share a shingle among the first fifth of either in any fixed order (prefix filter), so no pair is
  lost where sets meet at the shingles of their first fifth. The order puts shingles that are common in a sample last; the
  sample changes the work and never the result;
* of the sets that meet, pairs are discarded by sizes, by the pivot table (largest difference of the Hamming distances to the
  reference fingerprints, computed once for each set) and by the distance of the 256-bit fingerprints. RADIUS lies seven
  standard deviations above the distance expected at similarity 0.8, and six below that of unrelated sets; sets of fewer than
  FEW shingles, whose distances scatter more, carry their shingles along and are compared exactly;
* survivors form groups, whose texts are read once more and verified exactly. As hardly any unrelated sets pass, groups
  stay as small as the near copies are, whatever the number of texts that meet.

No step makes all pairs of a group: buckets are compared against one member first, and then only where groups meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.classify import mix
from tideline.llm.common import Stash, by_group, connected_components, small_batches
from tideline.llm.passages import BLOCK, SHINGLE, SIMILARITY, _listed, jaccard_components, shingle_hashes, words_of
from tideline.llm.simhash import PIVOTS, majority_bits, pivot_table

#: Texts whose shingles are counted for the order, and shingles that go last.
SAMPLE, COMMON = 10_000, 1 << 16
#: Words of a fingerprint, bits at which two may differ, and shingles below which they decide nothing.
BITS, RADIUS, FEW = ("f1", "f2", "f3", "f4"), 80, 64
#: What a set is compared by: size, fingerprint, pivot table, and the shingles if there are few.
FACTS = ("n", *BITS, "p1", "p2", "few")


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted hashes of each lower-case text's word shingles; fewer words than a shingle has make one, no word none."""
    text, _, h = words_of([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    edge = np.searchsorted(text, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        short = 0 < b - a < SHINGLE
        out.append(np.array([xxhash.xxh64_intdigest(h[a:b].tobytes(), 5)], np.uint64) if short else np.unique(shingle_hashes(h[a:b])))
    return out


def fingerprint(s: np.ndarray) -> np.ndarray:
    """256-bit SimHash (four words) of a set of hashes."""
    return np.array([majority_bits(mix(s * np.uint64(0x9FB21C651E98DF25) + np.uint64(k)) if k else s) for k in range(len(BITS))], np.uint64)


def prefix(s: np.ndarray, common: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The first shingles in the order: at least one of them is in every set of SIMILARITY."""
    n = len(s)
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        s = s[np.argsort(np.where(common[at] == s, count[at], 0), kind="stable")]
    return s[: n - int(np.ceil(SIMILARITY * n - 1e-9)) + 1]


def pivot_components(fp: np.ndarray, table: np.ndarray, size: np.ndarray, few: list[np.ndarray] | None = None) -> np.ndarray:
    """Component label (an index) of each fingerprint; as in jaccard_components each step compares one with all others.

    few: the sorted shingles of the sets of fewer than FEW / SIMILARITY, by which pairs with one of fewer than FEW are
    compared exactly; without them these pairs link by their sizes alone.
    """
    n = len(size)
    if few is not None:
        flat, owner = np.concatenate([np.zeros(0, np.uint64), *few]), np.repeat(np.arange(n), [len(x) for x in few])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
    label, done = np.arange(n), np.zeros(n, bool)
    while True:
        largest = np.bincount(label, minlength=n).argmax()
        open_ = np.flatnonzero(~done & (label != largest)) if done.any() else np.arange(n)
        if not len(open_):
            return label
        p = int(open_[0])
        near = np.flatnonzero((size >= SIMILARITY * size[p] - 1e-9) & (size[p] >= SIMILARITY * size - 1e-9))
        small = np.minimum(size[near], size[p]) < FEW
        short, near = near[small], near[~small]
        if few is not None and len(short):
            lo, hi = np.searchsorted(flat, few[p], "left"), np.searchsorted(flat, few[p], "right")
            spread = np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)[:-1])), hi - lo) + np.arange((hi - lo).sum())
            both = np.bincount(owner[spread], minlength=n)[short]
            short = short[both >= SIMILARITY * (size[short] + size[p] - both) - 1e-9]
        near = near[np.abs(table[near] - table[p]).max(axis=1) <= RADIUS]
        near = near[np.bitwise_count(fp[near] ^ fp[p]).sum(axis=1) <= RADIUS]
        touched = np.unique(label[np.concatenate((short, near))])
        label[np.isin(label, touched)] = touched[0]
        done[p] = True


def _links(label_of: Callable[[pa.Table], np.ndarray]) -> Callable:
    """Links (a, b) that join the rows (key, s, ...) of each key as label_of does."""

    def piece(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, names = t.column("key").to_numpy(), t.column("s").to_numpy()
        edge = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
            label = label_of(t.slice(s, e - s)) + s
            far = np.flatnonzero(label != np.arange(s, e)) + s
            a.append(names[label[far - s]]), b.append(names[far])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return lambda batches: by_group(batches, "key", piece)


def _by_fingerprint(t: pa.Table) -> np.ndarray:
    fp = np.ascontiguousarray(np.stack([t.column(c).to_numpy() for c in BITS], axis=1)).view(np.uint64)
    table = np.ascontiguousarray(np.stack([t.column(c).to_numpy() for c in ("p1", "p2")], axis=1)).view(np.uint8).astype(np.int16)
    return pivot_components(fp, table, t.column("n").to_numpy(), _sets(t.column("few")))


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.values.to_numpy().view(np.uint64) for x in column.combine_chunks()]


def _by_set(t: pa.Table) -> np.ndarray:
    return jaccard_components(_sets(t.column("shingles")))


def _block(n: Column) -> tuple[Column, Column]:
    """How many blocks n sets make, and the block of a set."""
    blocks = F.greatest(F.lit(1), F.ceil(n / (BLOCK // 2))).cast("int")
    return blocks, F.pmod(F.xxhash64("s", F.lit(3)), blocks).cast("int")


def linked_in_buckets(members: DataFrame, facts: DataFrame, label_of: Callable[[pa.Table], np.ndarray], stash: Stash) -> DataFrame:
    """(node, component) of the sets that link with another one in any bucket; members: (s, key, c), facts: by s.

    First each set is compared at its largest bucket, in blocks that have the bucket's first set in common. Then, in the
    buckets where several groups still meet, the sets outside the largest group are compared with all others.
    """

    def compare(placed: DataFrame) -> DataFrame:
        return stash.save(placed.join(facts, "s").repartition("key").sortWithinPartitions("key").mapInArrow(_links(label_of), "a long, b long"))

    chosen = members.groupBy("s").agg(F.max(F.struct("c", "key")).alias("m")).select("s", "m.key")
    chosen = stash.save(chosen.groupBy("key").agg(F.count("*").alias("c"), F.min("s").alias("y")).where("c > 1").join(chosen, "key"))
    blocks, own = _block(F.col("c"))
    every = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.xxhash64("key", j))
    first = compare(chosen.select("s", F.explode(F.when(F.col("s") == F.col("y"), every).otherwise(F.array(F.xxhash64("key", own)))).alias("key")))
    group = stash.save(connected_components(first, stash))

    left = members.join(group, F.col("s") == F.col("node"), "left").select("s", "key", "c", F.coalesce("component", "s").alias("g"))
    per = left.groupBy("key", "g").agg(F.count("*").alias("n"))
    mixed = per.groupBy("key").agg(F.max(F.struct("n", "g")).alias("m"), F.count("*").alias("gs")).where("gs > 1").select("key", "m")
    # of small buckets all of whose sets were compared above, nothing is left
    asked = chosen.where(F.col("c") <= BLOCK // 2).groupBy("key").agg(F.count("*").alias("asked"))
    left = left.join(mixed, "key").join(asked, "key", "left").where("asked IS NULL OR asked < c").withColumn("inside", F.col("g") == F.col("m.g"))
    ins, own_in = _block(F.col("m.n"))
    outs, own_out = _block(F.col("c") - F.col("m.n"))
    inside = F.transform(F.sequence(F.lit(0), outs - 1), lambda a: F.xxhash64("key", F.lit("in"), a, own_in))
    outside = F.concat(F.transform(F.sequence(F.lit(0), ins - 1), lambda b: F.xxhash64("key", F.lit("in"), own_out, b)), F.transform(F.sequence(F.lit(0), outs - 1), lambda a: F.xxhash64("key", F.lit("out"), F.least(a, own_out), F.greatest(a, own_out))))
    places = F.when(F.col("c") <= BLOCK, F.array("key")).when(F.col("inside"), inside).otherwise(outside)
    second = compare(left.select("s", F.explode(places).alias("key")))
    out = stash.save(connected_components(first.unionByName(second), stash))
    for done in (chosen, first, group, second):
        stash.drop(done)
    return out


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k, component_id, kept): a row for each row of docs with an id. component_id is the smallest id of the texts linked
    with it, directly or through others; of each component one (id, k) is kept, the smallest one.

    k, near_key of the row, tells rows with equal ids and different texts apart; rows alike in both are alike in
    all columns here. Texts without words link with each other alone. Null texts are empty, rows with a null id are
    left out, an empty table gives an empty result, and other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stash = Stash(spark, "nearcopies")
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), near_key(id_col, text_col).alias("k"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], ["h"])

    share = min(1.0, SAMPLE / max(1, rows.count()))
    some = rows.where(F.pmod(F.xxhash64("k", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000))
    heavy = some.select("text").mapInArrow(count, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 3").orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    common, often = heavy.column("h").to_numpy().view(np.uint64), heavy.column("n").to_numpy()
    order = np.argsort(common)
    lookup = spark.sparkContext.broadcast((common[order], often[order]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b.column(2).to_pylist())
            names = np.array([xxhash.xxh64_intdigest(s.tobytes(), 8) for s in sets], np.uint64).view(np.int64)
            fp = np.array([fingerprint(s) for s in sets], np.uint64).reshape(-1, len(BITS))
            table = np.ascontiguousarray(pivot_table(fp)).view(np.int64)  # a byte for each reference
            keys = [prefix(s, *lookup.value).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            facts = [pa.array(c) for c in (names, np.array([len(s) for s in sets], np.int64), *fp.view(np.int64).T, *table.T)]
            few = [s.view(np.int64) if len(s) < FEW / SIMILARITY else np.zeros(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *facts, _listed(few, pa.int64()), _listed(keys, pa.int64())], ["id", "k", "s", *FACTS, "keys"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _listed([s.view(np.int64) for s in shingle_sets(b.column(1).to_pylist())], pa.int64())], ["s", "shingles"])

    # prefixes and shingles are the bulk: each is written once, and gone when the next step has read it
    wide = stash.save(rows.mapInArrow(find, f"id long, k long, s long, n long, {', '.join(f'{c} long' for c in BITS)}, p1 long, p2 long, few array<long>, keys array<long>"))
    first = stash.save(wide.groupBy("s").agg(F.min(F.struct("id", "k")).alias("one"), *[F.first(c).alias(c) for c in (*FACTS, "keys")]))
    found = stash.save(wide.select("id", "k", "s"))
    stash.drop(wide)
    keyed = first.select("s", F.explode("keys").alias("key"))
    met = stash.save(keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    keyed = stash.save(keyed.join(met, "key"))
    facts = stash.save(first.drop("keys"))
    stash.drop(met), stash.drop(first)
    buckets = keyed.groupBy("key").agg(F.first("c").alias("c"), F.bit_xor("s").alias("x"), F.min("s").alias("y"))
    buckets = stash.save(buckets.groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key"))  # of buckets with equal members, one
    members = stash.save(keyed.join(buckets, "key").select("s", "key", "c"))
    stash.drop(keyed), stash.drop(buckets)
    close = linked_in_buckets(members, facts.select("s", *FACTS), _by_fingerprint, stash)

    groups = stash.save(close.join(close.groupBy("component").agg(F.count("*").alias("c")), "component").select(F.col("node").alias("s"), F.col("component").alias("key"), "c"))
    stash.drop(members), stash.drop(close)
    wanted = groups.join(facts, "s").select("s", F.col("one.k").alias("k"))
    texts = rows.select("k", "text").join(wanted, "k").dropDuplicates(["k", "s"])  # where the join has them: shingles are not dealt out
    sets = stash.save(texts.select("s", "text").mapInArrow(again, "s long, shingles array<long>"))
    linked = linked_in_buckets(groups, sets, _by_set, stash)
    stash.drop(sets), stash.drop(groups)

    named = stash.save(facts.select("s", "one").join(linked, F.col("s") == F.col("node"), "left").select("s", "one", F.coalesce("component", "s").alias("g")))
    stash.drop(facts), stash.drop(linked)
    named = named.join(named.groupBy("g").agg(F.min("one").alias("kept")), "g").select("s", "kept")
    return found.select("id", "k", "s").join(named, "s").select("id", "k", F.col("kept.id").alias("component_id"), ((F.col("id") == F.col("kept.id")) & (F.col("k") == F.col("kept.k"))).alias("kept"))


def near_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.lit(5), text_col)
