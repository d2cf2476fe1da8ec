"""Batch and stream sources; formats whose connector is absent here take the same options."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import storage
from tideline.functions.messages import safe_columns

KAFKA_DEFAULTS = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "10000000", "includeHeaders": "true"}
BRONZE_DEFAULTS = {"maxFilesPerTrigger": "50000"}


def kafka_options(*layers: dict[str, str]) -> dict[str, str]:
    """Reader options of a change topic, later layers winning; preserve_case is no reader option."""
    out = reduce(lambda a, b: a | b, layers, dict(KAFKA_DEFAULTS))
    out.pop("preserve_case", None)
    return out


def change_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of a change topic, original key and value kept (needs the Kafka connector)."""
    df = spark.readStream.format("kafka").options(**kafka_options(options)).load()
    return df.withColumn("original_key", F.col("key")).withColumn("original_value", F.col("value")).withColumn("key", F.col("key").cast("string"))


def table_stream(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str] | None = None, where: Column | None = None) -> DataFrame:
    """Stream of a columnar table's files, with an optional filter that the scan can prune by. What a trigger takes is limited by
    maxFilesPerTrigger, or by maxBytesPerTrigger if that is among the options."""
    limits = {} if "maxBytesPerTrigger" in (options or {}) else BRONZE_DEFAULTS
    reader = spark.readStream.schema(schema).options(**(limits | (options or {})))
    if storage.is_file(spark, path):  # a stream follows a folder: of one file's folder it takes that name alone
        folder, name = path.rsplit("/", 1)
        df = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        df = reader.parquet(path)
    return df if where is None else df.where(where)


def text_file_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream of whole text files with their paths."""
    return spark.readStream.option("wholetext", "true").text(path).select("value", F.col("_metadata.file_path").alias("file_path"))


def json_file_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.json").json(path).select("*", F.col("_metadata.file_path").alias("file_path"))


def jdbc_query(spark: SparkSession, url: str, query: str, driver: str, options: dict[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, query=query, driver=driver, **(options or {})).load()


def fan_out(frames: dict[str, DataFrame], tables: list[str], table_col: str, tag: str = "src_db") -> DataFrame:
    """Union of catalog scans of several databases, restricted to the wanted tables, columns in lower case."""
    parts = [f.where(F.col(table_col).isin(tables)).toDF(*[c.lower() for c in f.columns]).withColumn(tag, F.lit(name)) for name, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def initial_load_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files of a full load: names made safe, restricted to the known columns."""
    df = safe_columns(spark.read.parquet(path), lower=True)
    return df.select(*[c for c in schema.names if c in df.columns])


def documents_between(docs: DataFrame, stamp: str, after, until) -> DataFrame:
    """Documents changed after one bound and before another; the bounds reach the scan."""
    return docs.where((F.col(stamp) > F.lit(after)) & (F.col(stamp) < F.lit(until)))


def single_app(apps: DataFrame, app: str) -> DataFrame:
    """The one spec row of an app; none or several raise."""
    found = apps.where(F.col("app") == app)
    n = found.limit(2).count()
    if n != 1:
        raise ValueError(f"{'no' if not n else 'more than one'} spec of app {app}")
    return found
