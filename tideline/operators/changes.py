"""Change events to exact current-state tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline import storage
from tideline.functions.images import decoded_image

GC_SECONDS = 432_000


def split_key_changes(df: DataFrame, before: str = "before", after: str = "after", key: str = "__sk", op: str = "op_type") -> DataFrame:
    """An update whose images have different keys becomes a delete and an insert, both marked is_pk_change.

    Adds `image` (the row's image: after for I and U, before for D). Operations besides I, U, D raise.
    """
    o = F.col(op)
    changed = (o == "U") & (F.col(f"{before}.{key}") != F.col(f"{after}.{key}"))
    row = lambda kind, image, pk: F.struct(kind.alias("op"), image.alias("image"), F.lit(pk).alias("pk"))
    checked = F.when(o.isin("I", "U", "D"), o).otherwise(F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(o, F.lit("null")))).cast("string"))
    image = F.when(o == "D", F.col(before)).otherwise(F.col(after))
    rows = F.when(F.coalesce(changed, F.lit(False)), F.array(row(F.lit("D"), F.col(before), True), row(F.lit("I"), F.col(after), True))).otherwise(F.array(row(checked, image, False)))
    out = df.withColumn("__row", F.explode(rows))
    return out.withColumn(op, F.col("__row.op")).withColumn("image", F.col("__row.image")).withColumn("is_pk_change", F.col("__row.pk")).drop("__row")


def latest(df: DataFrame, keys: list[str], sequence: str, op: str = "op_type") -> DataFrame:
    """The row with the highest sequence of each key: one aggregation with map-side combine, so hot keys do not gather.

    Equal sequences: an upsert wins over a delete, then the larger content hash.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(sequence), (F.col(op) != "D"), F.xxhash64(*rest))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*")


def apply_changes(changes: DataFrame, keys: list[str], sequence: str, current: DataFrame | None = None, op: str = "op_type") -> DataFrame:
    """Merge changes into a current table (with tombstones): last writer by sequence wins, so order of arrival is nothing.

    Result: the business columns, the sequence, __UpsertVersion and __DeleteVersion (one of them null). Deletes leave a
    tombstone so that late older events lose to it.
    """
    rows = changes.withColumn("__UpsertVersion", F.when(F.col(op) != "D", F.col(sequence))).withColumn("__DeleteVersion", F.when(F.col(op) == "D", F.col(sequence)))
    if current is not None:
        old = current.withColumn(op, F.when(F.col("__DeleteVersion").isNotNull(), "D").otherwise("U"))
        rows = rows.unionByName(old.select(*rows.columns))
    return latest(rows, keys, sequence, op).drop(op)


def merged(states: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """One table of several (with tombstones), whatever their order: the latest row of each key."""
    return latest(states.withColumn("__op", F.when(F.col("__DeleteVersion").isNotNull(), "D").otherwise("U")), keys, sequence, "__op").drop("__op")


def current_state(table: DataFrame) -> DataFrame:
    return table.where(F.col("__DeleteVersion").isNull())


def collect_tombstones(table: DataFrame, event_time: Column, now: Column, keep_seconds: int = GC_SECONDS) -> DataFrame:
    """The table without tombstones older than the retention."""
    old = F.col("__DeleteVersion").isNotNull() & (event_time.cast("timestamp") < now.cast("timestamp") - F.make_dt_interval(secs=F.lit(keep_seconds)))
    return table.where(~F.coalesce(old, F.lit(False)))


def segmented(rows: DataFrame, keys: list[str], sequence: str, segments: int | None = None) -> DataFrame:
    """Rows with __segment: the number of a range of (keys, sequence). Ranges are of about equal size and in order, so a key
    with very many rows has many of them. Written to the shared folder: their bounds come from a sample of the rows, and every
    later step must see the same ones. segments: the session's shuffle partitions if not given."""
    spark = rows.sparkSession
    n = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = storage.fresh_dir(spark, "segments")
    rows.repartitionByRange(n, *keys, sequence).withColumn("__segment", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def carry_forward(changes: DataFrame, keys: list[str], sequence: str, columns: list[str], current: DataFrame | None = None, reset: Column | None = None, segments: int | None = None) -> DataFrame:
    """Null large values of a change come from the nearest earlier change of the key that has one, else from its row in `current`.

    reset: changes (deletes) that nothing is carried over; a value after one comes from behind it, or stays null. A row of
    `current` with the sequence among its columns serves later changes only. Equal sequences of a key are ordered by their large values.

    A segmented scan: keys are cut by ranges of the sequence, each segment's last values are found (an aggregate with map-side
    combine), scanned over the segments of the key (one row each), and put in front of the segment's own rows. No key gathers its
    changes in one task: a group is a key's part of one range.
    """
    cut = F.coalesce(reset, F.lit(False)) if reset is not None else F.lit(False)
    marks = [f"__m{i}" for i in range(len(columns))]
    at = segmented(changes.withColumn("__reset", cut), keys, sequence, segments)
    # a mark is a struct around the value, so that a reset is a mark too (around null)
    at = at.select("*", F.lit(1).alias("__row"), *[F.when(F.col("__reset") | F.col(c).isNotNull(), F.struct(F.when(~F.col("__reset"), F.col(c)).alias("v"))).alias(m) for c, m in zip(columns, marks)])
    part = [*keys, "__segment"]
    last = at.groupBy(*part).agg(*[F.max_by(m, F.when(F.col(m).isNotNull(), F.struct(sequence, *columns))).alias(m) for m in marks])
    earlier = Window.partitionBy(*keys).orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    prior = last.select(*part, F.lit(0).alias("__row"), *[F.last(m, ignorenulls=True).over(earlier).alias(m) for m in marks])
    here = Window.partitionBy(*part).orderBy("__row", sequence, *columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = at.unionByName(prior.where(" OR ".join(f"{m} IS NOT NULL" for m in marks)), allowMissingColumns=True)
    out = out.select("*", *[F.last(m, ignorenulls=True).over(here).alias(f"__h{i}") for i, m in enumerate(marks)]).where("__row = 1")
    live = [F.lit(None).cast(changes.schema[c].dataType) for c in columns]
    if current is not None:
        rest = [c for c in (sequence, *columns) if c in current.columns]
        out = out.join(current.select(*keys, F.struct(*rest).alias("__live")), keys, "left")
        usable = F.col(f"__live.{sequence}") < F.col(sequence) if sequence in rest else F.lit(True)
        live = [F.when(usable, F.col(f"__live.{c}")) for c in columns]
    found = [F.col(f"__h{i}") for i in range(len(columns))]
    filled = {c: F.when(F.col("__reset"), F.col(c)).when(f.isNotNull(), f["v"]).otherwise(v).alias(c) for c, f, v in zip(columns, found, live)}
    return out.select(*[filled.get(c, F.col(c)) for c in changes.columns])


def split_retries(changes: DataFrame, columns: list[str], op: str = "op_type", retries: str = "retries") -> tuple[DataFrame, DataFrame]:
    """(pass, retry): updates that still miss a large value are sent back once; the second time they pass."""
    miss = (F.col(op) == "U") & reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]) & (F.coalesce(F.col(retries), F.lit(0)) < 1)
    return changes.where(~miss), changes.where(miss).withColumn(retries, F.lit(1))


def apply_truncates(table: DataFrame, truncates: DataFrame, by: list[str], sequence: str) -> DataFrame:
    """The table without rows older than the latest truncate of their group.

    truncates: `by` and the sequence; reduced to one row a group before the join.
    """
    last = truncates.groupBy(*by).agg(F.max(sequence).alias("__truncated"))
    out = table.join(last, by, "left")
    return out.where(F.col("__truncated").isNull() | (F.col(sequence) >= F.col("__truncated"))).drop("__truncated")


def initial_load(rows: DataFrame, schema_id: Column, key: Column, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(loaded rows, report): rows with __sk and __schema_id, one for each key (the first in `order`), and their counts."""
    keyed = rows.withColumn("__schema_id", schema_id).withColumn("__sk", key)
    rest = [c for c in keyed.columns if c not in ("__sk", "__schema_id")]
    first = keyed.groupBy("__schema_id", "__sk").agg(F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("__r")).select("__schema_id", "__sk", "__r.*")
    report = keyed.groupBy("__schema_id").agg(F.count("*").alias("n_rows"), F.countDistinct("__sk").alias("n_keys")).withColumn("n_duplicates", F.col("n_rows") - F.col("n_keys"))
    return first, report


def fingerprint_gate(df: DataFrame, known: DataFrame, fingerprint: str = "schema_fingerprint") -> tuple[DataFrame, DataFrame]:
    """(known rows, quarantined rows) by the registered schema versions, a control table."""
    k = known.select(fingerprint).distinct()
    return df.join(k, fingerprint, "left_semi"), df.join(k, fingerprint, "left_anti")


def decode_by_registry(df: DataFrame, registry: DataFrame, images: list[str], fingerprint: str = "schema_fingerprint") -> DataFrame:
    """Image texts decoded by the schema version that each row names: struct (image variant, bad array<string>) in their place.

    registry: column rows (fingerprint, position, column, type) of all versions, as `evolve.registry_columns` gives them, gathered into one field list a
    version. Rows of versions that are not registered get null images. A new version is a row of the registry, not a plan.
    """
    fields = F.transform(F.array_sort(F.collect_list(F.struct("position", F.col("column").alias("name"), F.col("type").alias("type")))), lambda f: F.struct(f["name"].alias("name"), f["type"].alias("type")))
    lists = registry.select(fingerprint, "position", "column", "type").distinct().groupBy(fingerprint).agg(fields.alias("__fields"))
    out = df.join(lists, fingerprint, "left")
    return out.select(*[decoded_image(F.col(c), F.col("__fields")).alias(c) if c in images else F.col(c) for c in df.columns])


def resolve_claim_checks(df: DataFrame, payloads: DataFrame) -> DataFrame:
    """Records whose payload is a path (fingerprint 0, table __S3_PATH_REF__) get the content found under it.

    payloads: path, content, as read by `spark.read.format("binaryFile")`; one join instead of a client for each row.
    """
    ref = (F.col("schema_fingerprint") == 0) & (F.col("table_name") == "__S3_PATH_REF__")
    path = F.when(ref, F.col("payload").cast("string"))
    out = df.withColumn("__path", path).join(payloads.select(F.col("path").alias("__path"), F.col("content").alias("__content")), "__path", "left")
    return out.withColumn("payload", F.when(ref, F.col("__content")).otherwise(F.col("payload"))).drop("__path", "__content")
