"""Control tables: creation with layout, one app's specs, the change log."""

import pytest
from pyspark.sql import functions as F

from tideline.operators import control as CT
from tideline.plans.tables import schema_change_log
from tideline.types import shape


def test_created_table_has_its_layout(spark, tmp_path):
    name = f"control_{tmp_path.name}".replace("-", "_")
    cols = CT.shape(org=CT._S, n=CT.T.LongType(), day=CT.T.DateType())
    CT.create_table(spark, name, cols, str(tmp_path / "t"), ("day",), ("org",), 3, required=("org",), properties={"a": "b"})
    spark.range(100).select(F.concat(F.lit("o"), F.col("id") % 7).alias("org"), F.col("id").alias("n"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("day")).write.insertInto(name)
    CT.create_table(spark, name, cols)
    assert spark.table(name).count() == 100 and len(list((tmp_path / "t").glob("day=*"))) == 2
    plan = spark.table(name).groupBy("org").agg(F.sum("n"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert [r.data_type for r in spark.sql(f"DESCRIBE {name}").collect() if r.col_name == "n"] == ["bigint"]
    spark.sql(f"DROP TABLE {name}")


def test_declared_shapes_can_be_created(spark, tmp_path):
    for n in ("APP_SPEC", "FLOW_SPEC", "DB_SCHEMA_SPEC", "INIT_INGEST_SPEC", "DDL_EVENT_LOG"):
        name = f"{n}_{tmp_path.name}".replace("-", "_")
        CT.create_table(spark, name, getattr(CT, n), str(tmp_path / n), ("app",) if n != "DDL_EVENT_LOG" else ("yyyymm",))
        assert sorted(spark.table(name).columns) == sorted(getattr(CT, n).names) and spark.table(name).count() == 0
        spark.sql(f"DROP TABLE {name}")
    assert shape(a=CT._S).names == ["a"]


def test_app_specs(spark):
    apps = spark.createDataFrame([("a",), ("b",), ("b",)], "app string")
    flows = spark.createDataFrame([("a", "f"), ("b", "g")], "app string, flow_id string")
    loads = spark.createDataFrame([("a", "t1", True), ("a", "t2", False), ("a", "t3", None), ("b", "t4", False)], "app string, table_name string, is_complete boolean")
    got = CT.app_specs(apps, flows, loads, "a")
    assert got.app.count() == 1 and [r.flow_id for r in got.flows.collect()] == ["f"] and sorted(r.table_name for r in got.loads.collect()) == ["t2", "t3"]
    for name in ("b", "c"):
        with pytest.raises(ValueError):
            CT.app_specs(apps, flows, loads, name)


def test_change_log_knows_its_rows(spark):
    events = spark.createDataFrame([("f", "c1", "ADD_COLUMN", "PROCESSED"), ("f", "c2", "DROP_COLUMN", "IGNORED")], "flow_id string, `column` string, event string, status string")
    rows = CT.change_log_rows(events, "app", F.lit("t1"), F.lit("2024-12-31 23:00:00"), F.when(F.col("event") == "DROP_COLUMN", "not sent"))
    assert rows.schema.names == CT.DDL_EVENT_LOG.names and {r.yyyymm for r in rows.collect()} == {202412} and {r.error_msg for r in rows.collect()} == {None, "not sent"}
    assert CT.new_log_rows(rows, rows.limit(1)).count() == 1 and CT.new_log_rows(rows, rows).count() == 0
    again = CT.change_log_rows(events, "app", F.lit("t2"), F.lit("2024-12-31 23:00:00"))
    assert CT.new_log_rows(again, rows).count() == 2


def test_change_log_of_equal_states_is_empty(spark, tmp_path):
    """All flows have the same columns before and after, as in large tables: nothing is logged, and the empty log is read again."""
    key = lambda n: F.lit(n).cast("long")
    spark.range(20).select(key(1).alias("l_orderkey"), key(8).alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber")).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert schema_change_log(spark, str(tmp_path)).count() == 0
