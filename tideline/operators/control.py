"""Control tables: declared shapes, creation with layout, an app's specs, and the log of schema changes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.logs import month_number
from tideline.sources.readers import single_app
from tideline.types import shape

_S, _B, _TS, _LIST, _MAP = T.StringType(), T.BooleanType(), T.TimestampType(), T.ArrayType(T.StringType()), T.MapType(T.StringType(), T.StringType())
_AUDIT = {"created_at": _TS, "updated_at": _TS, "created_by": _S, "updated_by": _S}

#: The columns of the control tables and of the log of schema changes.
APP_SPEC = shape(app=_S, src_db_type=_S, delta_db=_S, kafka_conf=_MAP, schema_topic=_S, cdc_topics=_LIST, bronze_reader_opts=_MAP, bronze_spark_conf=shape(active_flow_conf=_MAP, inactive_flow_conf=_MAP), silver_spark_conf=_MAP, bronze_table_props=_MAP, silver_table_props=_MAP, tenancy_conf=shape(tenancy_type=_S, client_id_col=_S, handle_l2l=_B), **_AUDIT)
FLOW_SPEC = shape(flow_id=_S, app=_S, src_table=_S, target_details=shape(delta_table=_S, delta_table_path=_S, partition_cols=_LIST, schema_refresh_done=_B), cdc_keys=_LIST, cdc_schema=_S, cdc_lob_columns=_LIST, cdc_schema_fingerprints=T.ArrayType(T.LongType()), flow_grp_id=T.IntegerType(), flow_reader_opts=_MAP, flow_spark_conf=_MAP, inactive_schemas=_LIST, is_active=_B, **_AUDIT)
DB_SCHEMA_SPEC = shape(id=_S, app=_S, src_db=_S, src_schema=_S, **_AUDIT)
INIT_INGEST_SPEC = shape(app=_S, table_name=_S, schema_id=_S, load_type=_S, init_load_path=_S, is_complete=_B, **_AUDIT)
DDL_EVENT_LOG = shape(app=_S, ddl_event=_S, error_msg=_S, transaction_id=_S, notification_id=_S, created_at=_TS, created_by=_S, yyyymm=T.IntegerType())


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None, partitions: tuple[str, ...] = (), cluster: tuple[str, ...] = (), buckets: int = 8, required: tuple[str, ...] = (), properties: dict[str, str] | None = None) -> None:
    """Create a table with a declared schema and layout unless it is there: folders by the partition columns, in each of them
    files by hash of the cluster columns and sorted by them, so joins and groups on these need no shuffle."""
    column = lambda f: f"`{f.name}` {f.dataType.simpleString()}" + (" NOT NULL" if f.name in required else "")
    names = lambda cs: ", ".join(f"`{c}`" for c in cs)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(map(column, schema.fields))}) USING parquet"]
    if partitions:
        parts.append(f"PARTITIONED BY ({names(partitions)})")
    if cluster:
        parts.append(f"CLUSTERED BY ({names(cluster)}) SORTED BY ({names(cluster)}) INTO {buckets} BUCKETS")
    if location:
        parts.append(f"LOCATION '{location}'")
    if properties:
        parts.append("TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in sorted(properties.items())) + ")")
    spark.sql(" ".join(parts))


class AppSpecs(NamedTuple):
    app: DataFrame
    flows: DataFrame
    loads: DataFrame


def app_specs(apps: DataFrame, flows: DataFrame, loads: DataFrame, app: str) -> AppSpecs:
    """What a job of one app works on: its one spec row (none or several raise), its flows, and its initial loads that are not
    complete (a null flag is not complete)."""
    mine = F.col("app") == app
    return AppSpecs(single_app(apps, app), flows.where(mine), loads.where(mine & ~F.coalesce("is_complete", F.lit(False))))


def change_log_rows(events: DataFrame, app: str, transaction: Column, at: Column, error: Column | None = None) -> DataFrame:
    """Log rows (DDL_EVENT_LOG) of schema-change events (flow_id, column, event, status). The id is a digest of the event and
    its transaction, so an append that is repeated can be recognised."""
    event = F.to_json(F.struct("flow_id", "column", "event", "status"))
    out = events.select(F.lit(app).alias("app"), event.alias("ddl_event"), (F.lit(None) if error is None else error).cast("string").alias("error_msg"), transaction.cast("string").alias("transaction_id"), at.cast("timestamp").alias("created_at"))
    out = out.withColumn("notification_id", F.sha2(F.concat_ws("\n", "app", "transaction_id", "ddl_event").cast("binary"), 256)).withColumn("created_by", F.current_user()).withColumn("yyyymm", month_number("created_at"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DDL_EVENT_LOG.fields])


def new_log_rows(rows: DataFrame, logged: DataFrame) -> DataFrame:
    """Those rows that the log does not have yet."""
    return rows.join(logged.select("notification_id"), "notification_id", "left_anti").select(*rows.columns)
