"""Typed log and result rows: errors, schema changes, extract status, count results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.types import FLOW_ERROR

IGNORABLE = ("no documents", "does not exist")


def month_number(stamp: Column | str) -> Column:
    return F.date_format(stamp, "yyyyMM").cast("int")


def day_number(stamp: Column | str) -> Column:
    return F.date_format(stamp, "yyyyMMdd").cast("int")


def error_rows(failed: DataFrame, app: str, flow: Column, why: Column, trace: Column, at: Column, **metadata: Column) -> DataFrame:
    """Rows of the error log; the id is a digest of what happened where and when, so a repeated append is recognised."""
    pairs = [x for name, v in metadata.items() for x in (F.lit(name), v.cast("string"))]
    meta = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    out = failed.select(flow.alias("flow_id"), why.alias("error_desc"), trace.alias("error_trace"), meta.alias("error_metadata"), at.cast("timestamp").alias("created_at"))
    out = out.withColumn("app", F.lit(app)).withColumn("created_by", F.current_user()).withColumn("yyyymm", month_number("created_at"))
    out = out.withColumn("error_id", F.md5(F.concat_ws("|", "app", "flow_id", "error_desc", F.col("created_at").cast("string")).cast("binary")))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FLOW_ERROR.fields])


def append_log(rows: DataFrame, path: str, partition: str = "yyyymm") -> None:
    rows.write.mode("append").partitionBy(partition).parquet(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log's rows by their declared shape: an append without rows leaves no file that a shape could be taken from."""
    return spark.read.schema(schema).parquet(path)


def fatal_statuses(statuses: DataFrame, error: str = "error") -> DataFrame:
    """Status rows that must fail the job: with an error that is not ignorable."""
    ignored = F.lit(False)
    for text in IGNORABLE:
        ignored = ignored | F.col(error).contains(text)
    return statuses.where(F.col(error).isNotNull() & ~ignored)


def count_results(counts: DataFrame, name: Column, diff: str, pct: str, src_error: str, tgt_error: str, day: Column) -> DataFrame:
    """Result rows of a count run: error flag and map, metadata map, day partition."""
    errors = F.map_filter(F.create_map(F.lit("source"), F.col(src_error), F.lit("target"), F.col(tgt_error)), lambda k, v: v.isNotNull())
    meta = F.create_map(F.lit("count_diff"), F.col(diff).cast("string"), F.lit("count_diff_pct"), F.col(pct).cast("string"))
    return counts.select(F.lower(name).alias("table_name"), (F.size(errors) > 0).cast("int").alias("is_error"), errors.alias("errors"), meta.alias("metadata"), day_number(day).alias("yyyymmdd"))
