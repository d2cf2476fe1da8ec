"""Message keys, registry paths, partition predicates and status rules of the change topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks of the feed.
DOLLAR_MARK = "__DOL"
HEARTBEAT_PREFIX = "gg."


def normalized_key(key: Column | str) -> Column:
    """Lower-case `db.schema.table`. A two-part key is a heartbeat and gets its database; a leading c## goes; others raise."""
    k = F.lower(F.col(key) if isinstance(key, str) else key)
    plain = F.regexp_replace(k, "^c##", "")
    parts = F.size(F.split(k, r"\."))
    bad = F.raise_error(F.concat(F.lit("message key is not db.schema.table: "), F.coalesce(k, F.lit("null")))).cast("string")
    beat = k.contains("heartbeat")
    return F.when(k.isNull(), bad).when((parts == 2) & beat, F.concat(F.lit(HEARTBEAT_PREFIX), plain)).when(parts == 3, plain).otherwise(bad)


def table_of(key: Column | str) -> Column:
    """Table name of a key, with the dollar mark turned back."""
    k = F.col(key) if isinstance(key, str) else key
    return F.replace(F.element_at(F.split(k, r"\."), -1), F.lit(DOLLAR_MARK.lower()), F.lit("$"))


def safe_columns(df: DataFrame, lower: bool = False) -> DataFrame:
    """Column names without dollar signs."""
    new = [c.replace("$", DOLLAR_MARK) for c in df.columns]
    return df.toDF(*[c.lower() if lower else c for c in new])


def registry_path(key: Column, fingerprint: Column, root: str) -> Column:
    return F.concat(F.lit(f"{root}/"), table_of(key), F.lit("/schema."), key, F.lit("."), fingerprint.cast("string"), F.lit(".avsc"))


def path_fingerprint(path: Column) -> Column:
    return F.regexp_extract(path, r"\.(-?\d+)\.avsc$", 1).cast("long")


def path_key(path: Column) -> Column:
    return F.regexp_extract(path, r"/schema\.(.+)\.-?\d+\.avsc$", 1)


def with_schema_id(df: DataFrame, schemas: DataFrame, key: str = "key") -> DataFrame:
    """Add schema_id by (db.schema) from a small spec table (db_schema, schema_id); heartbeats keep db.schema; an unknown one raises."""
    name = F.substring_index(F.col(key), ".", 2)
    spec = schemas.select(F.col("db_schema").alias("__db_schema"), F.col("schema_id").alias("__id"))
    beat = F.col(key).contains("heartbeat")
    out = df.join(spec, name == F.col("__db_schema"), "left")
    unknown = F.raise_error(F.concat(F.lit("unknown schema "), name)).cast("string")
    return out.withColumn("schema_id", F.when(beat, name).when(F.col("__id").isNull(), unknown).otherwise(F.col("__id"))).drop("__db_schema", "__id")


def with_active_flag(df: DataFrame, flows: DataFrame, key: str = "key") -> DataFrame:
    """Add is_active_event: heartbeats are; tables without a flow are not; schemas in the flow's inactive list are not.

    flows: src_table, inactive array<string>; a control table; Spark broadcasts it while its size allows.
    """
    spec = flows.select(F.col("src_table").alias("__table"), F.col("inactive").alias("__inactive"))
    out = df.join(spec, table_of(key) == F.col("__table"), "left")
    listed = F.array_contains(F.coalesce("__inactive", F.array().cast("array<string>")), F.col("schema_id"))
    flag = F.when(F.col(key).contains("heartbeat"), True).when(F.col("__table").isNull(), False).otherwise(~listed)
    return out.withColumn("is_active_event", flag).drop("__table", "__inactive")


def recent_months(year: Column | str, month: Column | str, bound_year: int, bound_month: int) -> Column:
    """Partition predicate that holds across a year's end: (year, month) at or after the bound."""
    y, m = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    return (y > bound_year) | ((y == bound_year) & (m >= bound_month))


def alert_status(value: Column | str, threshold: float) -> Column:
    """1 (red) where the value is missing or above the threshold, else 0 (green)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v.isNull() | (v > threshold), 1).otherwise(0)


def tenant_valid(org: Column | str, client: Column | str) -> Column:
    """Both ids are whole numbers, and the client is not zero."""
    o, c = (F.col(x) if isinstance(x, str) else x for x in (org, client))
    return F.coalesce(o.rlike("^[0-9]+$") & c.rlike("^[0-9]+$") & (c != "0"), F.lit(False))


def join_name(*parts: Column | str) -> Column:
    """Case-folded dotted name."""
    return F.lower(F.concat_ws(".", *parts))


def meta_map(**values: Column) -> Column:
    """Audit map of strings."""
    pairs = [x for name, v in values.items() for x in (F.lit(name), v.cast("string"))]
    return F.create_map(*pairs)
