"""Counts, heartbeats and comparisons between sources and targets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.messages import alert_status

FULL = 2_147_483_647
MISSING_TABLE = "does not exist"


def live_counts(table: DataFrame, by: list[str], stamp: str, deleted: str = "__DeleteVersion") -> DataFrame:
    """Live rows and the latest change of each group."""
    return table.groupBy(*by).agg(F.sum(F.when(F.col(deleted).isNull(), 1).otherwise(0)).alias("live_rows"), F.max(stamp).alias("max_op_ts"))


def distinct_keys(table: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Distinct keys (nulls count) of each group."""
    return table.select(*by, *keys).distinct().groupBy(*by).agg(F.count("*").alias("n_keys"))


def with_latest(df: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """The latest row of each group: one aggregation."""
    return df.groupBy(*by).agg(F.max_by(F.struct(order, *columns), order).alias("r")).select(*by, "r.*")


def heartbeat_lag(beats: DataFrame, expected: DataFrame, by: list[str], arrival: str, now: Column, threshold: float) -> DataFrame:
    """Seconds since each expected replicat's last heartbeat, with its status; a replicat never heard of is red."""
    last = beats.groupBy(*by).agg(F.max(arrival).alias("last_beat"))
    out = last.join(expected, by, "right")
    lag = F.timestamp_diff("SECOND", F.col("last_beat").cast("timestamp"), now.cast("timestamp"))
    return out.withColumn("lag_seconds", lag).withColumn("alert", alert_status("lag_seconds", threshold))


def count_difference(source: Column, target: Column) -> tuple[Column, Column]:
    """(difference, percentage): null if a count is; of an empty source 0 without difference, else the largest number."""
    diff = source - target
    pct = F.when(diff.isNull(), None).when(source == 0, F.when(diff == 0, 0.0).otherwise(float(FULL))).otherwise(F.abs(diff) * 100.0 / source)
    return diff, pct


def repaired_count(count: Column, error: Column) -> Column:
    """A target count that is null without an error is zero."""
    return F.when(F.coalesce(error, F.lit(0)) == 0, F.coalesce(count, F.lit(0))).otherwise(count)


def in_flight(events: DataFrame, cursors: DataFrame, by: list[str], op: str, stamp: str) -> DataFrame:
    """Signed count of events beyond each group's cursor: inserts one, deletes minus one, updates zero."""
    c = cursors.select(*by, F.col("cursor"))
    beyond = F.col(stamp) > F.coalesce("cursor", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    weight = F.when(~beyond, 0).when(F.col(op) == "I", 1).when(F.col(op) == "D", -1).otherwise(0)
    return events.join(c, by, "left").groupBy(*by).agg(F.sum(weight).alias("in_flight"))


def unexpected_errors(results: DataFrame, error: str = "is_error", message: str = "message") -> DataFrame:
    """Error rows other than those of missing tables."""
    return results.where((F.col(error) == 1) & ~F.coalesce(F.col(message).contains(MISSING_TABLE), F.lit(False)))


def compare_by_hash(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, verdict) of rows that differ: missing on a side, or different content. Values are hashed with their lengths, and
    nulls as a mark without one, so values that run together, or a text like the mark, are told apart."""
    value = lambda c: F.when(F.col(c).isNull(), "~").otherwise(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")))
    digest = F.md5(F.concat(*map(value, columns)).cast("binary"))
    a, b = left.select(*keys, digest.alias("__a")), right.select(*keys, digest.alias("__b"))
    verdict = F.when(F.col("__a").isNull(), "missing_left").when(F.col("__b").isNull(), "missing_right").when(F.col("__a") != F.col("__b"), "different")
    return a.join(b, keys, "full").select(*keys, verdict.alias("verdict")).where("verdict IS NOT NULL")


def large_object_kib(df: DataFrame, columns: list[str], floor: int = 5) -> DataFrame:
    """Largest value of the columns in KiB, at least the floor."""
    most = [F.max(F.octet_length(c)) for c in columns]
    top = F.greatest(*most) if len(most) > 1 else most[0]
    return df.agg(F.greatest(F.ceil(F.coalesce(top, F.lit(0)) / 1024), F.lit(floor)).cast("long").alias("max_lob_kib"))


def duplicated(df: DataFrame, by: list[str], distinct: str) -> DataFrame:
    """Groups that pair with more than one value."""
    return df.groupBy(*by).agg(F.countDistinct(distinct).alias("n")).where("n > 1")


def count_tables(tables: dict[str, DataFrame], by: str) -> DataFrame:
    """Grouped counts of several tables in one job (positional union)."""
    parts = [t.groupBy(F.col(by).cast("string").alias("group_id")).count().select(F.lit(name).alias("table_name"), "group_id", F.col("count").alias("n_rows")) for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_tables_apart(spark: SparkSession, scans: dict[str, Callable[[], DataFrame]], by: str) -> DataFrame:
    """(table_name, group_id, n_rows, error): count_tables where a table that cannot be opened (missing, other columns, no
    connection) has one row with its error and leaves the others alone. Opening reads one row at most."""
    good, bad = {}, []
    for name, scan in scans.items():
        try:
            df = scan().select(by)
            df.limit(1).isEmpty()
            good[name] = df
        except PySparkException as e:
            bad.append((name, e.getCondition() or type(e).__name__))
    failed = spark.createDataFrame(bad, "table_name string, error string").select("table_name", F.lit(None).cast("string").alias("group_id"), F.lit(None).cast("long").alias("n_rows"), "error")
    return failed if not good else count_tables(good, by).withColumn("error", F.lit(None).cast("string")).unionByName(failed)


def data_sample(df: DataFrame, n: int, seed: int, keys: list[str], **tags: str) -> DataFrame:
    """n rows drawn at random by the hash of their key, the same ones for a seed, tagged with where they come from: a bounded sort,
    not a full one."""
    out = df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *keys)), *keys).limit(n)
    for name, value in tags.items():
        out = out.withColumn(name, F.lit(value))
    return out
