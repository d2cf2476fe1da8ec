"""MERGE in its three forms as joins, aligned appends, rewrites and layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import storage


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target and the source rows whose keys it lacks."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def update_matched(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Target with the named columns taken from matching source rows (a null there counts)."""
    s = source.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    out = target.join(s, keys, "left")
    return out.select(*[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Target with the named columns refreshed and the source's other rows added."""
    t = target.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in target.columns if c not in keys], F.lit(True).alias("__had"))
    s = source.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in target.columns if c not in keys], F.lit(True).alias("__hit"))
    out = t.join(s, keys, "full")
    pick = lambda c: F.when(F.col("__had").isNull() | (F.col("__hit") & F.lit(c in columns)), F.col(f"__new_{c}")).otherwise(F.col(f"__old_{c}"))
    return out.select(*[F.col(c) if c in keys else pick(c).alias(c) for c in target.columns])


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    return target.where(~F.coalesce(condition, F.lit(False)))


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order: common ones cast, missing ones null, others dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def compact(df: DataFrame, columns: list[str], partitions: int) -> DataFrame:
    """Rows range-partitioned and sorted by the clustering columns, for a rewrite into few sorted files. Filters on the first
    column find few files; `clustered` serves filters on any of them."""
    return df.repartitionByRange(partitions, *columns).sortWithinPartitions(*columns)


def _ordinal(df: DataFrame, name: str) -> Column:
    """A number that orders as the column does (texts by their first six bytes)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.hex(F.rpad(F.substring(F.col(name).cast("binary"), 1, 6), 6, F.unhex(F.lit("00")))), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def curve_position(df: DataFrame, columns: list[str], bits: int) -> Column:
    """Place of a row on a space-filling curve: the columns' ranks among 2^bits equal shares of the rows, bit by bit in turn.

    The shares' bounds come from one pass of mergeable percentiles; 2^bits - 1 numbers a column reach the driver. Nulls rank first.
    """
    shares = 1 << bits
    at = [i / shares for i in range(1, shares)]
    bounds = df.agg(*[F.percentile_approx(_ordinal(df, c), at, 10_000).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    place = F.lit(0)
    for j, c in enumerate(columns):
        cuts = sorted(set(bounds[f"b{j}"] or []))

        def rank(low: int, high: int, v: Column = _ordinal(df, c), cuts: list[float] = cuts) -> Column:
            """How many of the bounds low..high lie at or below the value, by halving."""
            if low == high:
                return F.lit(low)
            mid = (low + high) // 2
            return F.when(v >= cuts[mid], rank(mid + 1, high)).otherwise(rank(low, mid))

        r = F.when(F.col(c).isNull(), 0).otherwise(rank(0, len(cuts))).cast("long")
        for b in range(bits):
            place = place + F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)), b * len(columns) + j)
    return place


def clustered(df: DataFrame, columns: list[str], files: int) -> DataFrame:
    """Rows dealt to files along a space-filling curve over the columns, so that a narrow filter on any one of k columns
    reads about files^(1 - 1/k) of them by the files' value ranges. Ties of the curve are cut by the columns, so a frequent value has several files."""
    bits = max(1, -(-max(files - 1, 1).bit_length() // len(columns)) + 1)
    out = df.withColumn("__place", curve_position(df, columns, bits))
    return out.repartitionByRange(files, "__place", *columns).sortWithinPartitions("__place", *columns).drop("__place")


def cluster_table(spark: SparkSession, source: str, target: str, columns: list[str], file_bytes: int = 512 << 20) -> int:
    """Rewrite a table's files along a curve, as many as its measured bytes ask for; returns their number."""
    files = max(1, -(-storage.size(spark, source) // file_bytes))
    clustered(spark.read.parquet(source), columns, files).write.parquet(target)
    return files


def file_ranges(table: DataFrame, columns: list[str]) -> DataFrame:
    """(file, low_<column>, high_<column>, ...): what a scan can skip a file by."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends)


def append_evolving(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append where either side may lack columns of the other."""
    return table.unionByName(rows, allowMissingColumns=True)
