"""Tables rewritten to merged schemas: staged, published by rename, flagged; one flow's failure leaves the others alone."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from tideline import storage
from tideline.operators.logs import error_rows
from tideline.operators.merge import cast_to, update_matched

#: Rewrites that run at a time, as jobs of one session.
AT_ONCE = 4
#: Fixed value: the log's description of such a failure.
WHY = "Failure occurred while overwriting schemas"


class Rewrite(NamedTuple):
    """A flow's table and the schema that it is to have."""

    flow_id: str
    path: str
    ddl: str
    partitions: tuple[str, ...] = ()


OUTCOME = "flow_id string, published boolean, condition string, trace string"


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a lost driver left of a publication: the table put back where only its old files are, these removed where
    the new ones are in place."""
    for old in storage.found(spark, f"{path}__replaced-*"):
        if storage.exists(spark, path):
            storage.delete(spark, old)
        else:
            storage.move(spark, old, path)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of a table's: two renames, between which `recover` knows the old files."""
    old = f"{path}__replaced-{uuid.uuid4().hex}"
    storage.move(spark, path, old)
    storage.move(spark, staged, path)
    storage.delete(spark, old)


def rewrite_one(spark: SparkSession, flow: Rewrite) -> tuple[str, bool, str | None, str | None]:
    """Outcome of one flow. A table that does not exist yet has nothing to rewrite and counts as published."""
    staged = f"{flow.path}__staged-{uuid.uuid4().hex}"
    try:
        recover(spark, flow.path)
        if storage.exists(spark, flow.path):
            rows = cast_to(spark.read.parquet(flow.path), T.StructType.fromDDL(flow.ddl))
            rows.write.partitionBy(*flow.partitions).parquet(staged)
            publish(spark, staged, flow.path)
        return flow.flow_id, True, None, None
    except (PySparkException, Py4JError, OSError) as e:
        storage.delete(spark, staged)
        named = re.findall(r"\[([A-Z][A-Z_.]+)\]", str(e))
        return flow.flow_id, False, named[-1] if named else type(e).__name__, str(e)


def rewrite_flows(spark: SparkSession, flows: Iterable[Rewrite], at_once: int = AT_ONCE) -> DataFrame:
    """Outcome rows (OUTCOME) of the flows whose schema change asks for a rewrite.

    Each table is read, cast (a value that does not fit fails the flow), written beside its place and renamed into it, so
    readers see the old table or the new one. `flows` is a control table's size; each rewrite is one distributed job.
    """
    with ThreadPoolExecutor(at_once) as pool:
        work = inheritable_thread_target(spark)(lambda f: rewrite_one(spark, f))
        return spark.createDataFrame(list(pool.map(work, flows)), OUTCOME)


def with_refresh_flags(specs: DataFrame, outcomes: DataFrame, by: str = "schema_merger") -> DataFrame:
    """Flow specs (flow_id, schema_refresh_done, updated_by, ...) with the flag of published flows set."""
    done = outcomes.where("published").select("flow_id", F.lit(True).alias("schema_refresh_done"), F.lit(by).alias("updated_by"))
    return update_matched(specs, done, ["flow_id"], ["schema_refresh_done", "updated_by"])


def refresh_errors(outcomes: DataFrame, app: str, at: Column) -> DataFrame:
    """Error-log rows of the flows that failed."""
    failed = outcomes.where("NOT published")
    return error_rows(failed, app, F.col("flow_id"), F.lit(WHY), F.col("trace"), at, condition=F.col("condition"))
