"""Shared pieces: reading tables, tables in the shared folder, grouped streaming in tasks, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.storage import shared_dir

#: Rows of an Arrow batch in the text operators: long texts must not add up in one batch.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
#: Shuffle files go with the query that made them, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, whatever the length of a text (runtime SQL settings of the session).

    Also sends this package's code to the executors, once for each Spark context.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if not getattr(context, "_tideline_sent", False) and root.is_dir():
        path = f"{tempfile.mkdtemp(prefix='tideline-code-')}/tideline_code.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root)}")
        context.addPyFile(path)
        context._tideline_sent = True


class Stash:
    """Tables of intermediate results in the shared folder; they cut lineage and outlive a lost executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def save(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        writer = df.write.option("compression", "zstd")
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stash_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later plan reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._stash_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def by_group(batches: Iterator[pa.RecordBatch], key: str, work: Callable[[pa.Table], Iterator[pa.RecordBatch]], least: int = 1) -> Iterator[pa.RecordBatch]:
    """Stream a partition sorted by key in pieces of `least` rows or more that never split a key; holds one piece and one key's rows at most."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], side="left"))
        if held and sum(x.num_rows for x in held) + cut < least:
            held.append(b)
            continue
        if cut == 0 and held:
            last = held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py()
            if last == k[-1]:
                held.append(b)
                continue
        if cut:
            held.append(b.slice(0, cut))
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())
        held = [b.slice(cut)]
    if held:
        yield from work(pa.Table.from_batches(held).combine_chunks())


def labels_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the undirected links i-j, for each of n nodes: hooking and pointer jumping."""
    low = np.arange(n)
    i, j = np.asarray(i), np.asarray(j)
    while len(i):
        a, b = low[i], low[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        if not len(i):
            break
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = low[low]
            if np.array_equal(up, low):
                break
            low = up
    return low


def connected_components(links: DataFrame, stash: Stash) -> DataFrame:
    """(node, component) for links (a long, b long): the smallest node reachable.

    Alternating large-star and small-star steps: each is a minimum per node with map-side combine and one join that
    adaptive execution splits where a node has very many links; no node's links are ever gathered in one place.
    Nulls and self links are left out. A node without links has no row.
    """
    e = stash.save(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        after = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(after) == before or not after[0]:
            break
        before = tuple(after)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select("v", "m", "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).where("u <> v")
        new = stash.save(small.distinct())
        stash.drop(e)
        e = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
