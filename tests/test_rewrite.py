"""Rewrites of changed flows: outcomes apart, losses between the renames, flags and log rows."""

import pytest
from pyspark.sql import functions as F

from tideline import storage
from tideline.operators import metadata, reconcile
from tideline.operators import rewrite as W


def table(spark, path, rows=4):
    spark.range(rows).select("id", F.concat(F.lit("x"), "id").alias("name"), (F.col("id") % 2).alias("part")).write.partitionBy("part").parquet(path)


def test_outcomes_stand_apart(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("good", "bad", "absent", "broken")}
    for n in ("good", "bad"):
        table(spark, paths[n])
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.parquet").write_text("no parquet")
    ddl = "id decimal(20,0), name string, more int, part bigint"
    flows = [W.Rewrite(n, p, ddl.replace("name string", "name int") if n == "bad" else ddl, ("part",)) for n, p in paths.items()]
    out = W.rewrite_flows(spark, flows)
    got = {r.flow_id: (r.published, r.condition) for r in out.collect()}
    assert got["good"] == (True, None) and got["absent"] == (True, None) and got["bad"] == (False, "CAST_INVALID_INPUT") and not got["broken"][0]
    assert dict(spark.read.parquet(paths["good"]).dtypes)["id"] == "decimal(20,0)" and spark.read.parquet(paths["good"]).count() == 4
    assert dict(spark.read.parquet(paths["bad"]).dtypes)["id"] == "bigint"
    assert sorted(x.name for x in tmp_path.iterdir()) == ["bad", "broken", "good"]  # nothing staged is left
    specs = spark.createDataFrame([(n, False, "deploy") for n in [*paths, "other"]], "flow_id string, schema_refresh_done boolean, updated_by string")
    flags = {r.flow_id: (r.schema_refresh_done, r.updated_by) for r in W.with_refresh_flags(specs, out).collect()}
    assert flags == {"good": (True, "schema_merger"), "absent": (True, "schema_merger"), "bad": (False, "deploy"), "broken": (False, "deploy"), "other": (False, "deploy")}
    errors = W.refresh_errors(out, "app", F.lit("2024-02-01 00:00:00")).collect()
    assert {(r.flow_id, r.error_desc) for r in errors} == {("bad", W.WHY), ("broken", W.WHY)} and all(r.error_trace for r in errors)


@pytest.mark.parametrize("lost_at", [1, 2])
def test_lost_between_the_renames(spark, tmp_path, monkeypatch, lost_at):
    """A driver lost before the new files are in place, or before the old ones are removed."""
    path = str(tmp_path / "t")
    table(spark, path)
    flow = W.Rewrite("f", path, "id string, part bigint", ("part",))
    calls, move = [], storage.move

    def some(*a):
        calls.append(a)
        if len(calls) > lost_at:
            raise KeyboardInterrupt
        move(*a)

    with monkeypatch.context() as m:
        m.setattr(storage, "move", some)
        m.setattr(storage, "delete", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            W.rewrite_one(spark, flow)
    W.recover(spark, path)
    assert spark.read.parquet(path).count() == 4 and not list(tmp_path.glob("t__replaced*"))
    assert W.rewrite_one(spark, flow)[1] and dict(spark.read.parquet(path).dtypes)["id"] == "string"


def test_control_product_is_bounded(spark):
    a = spark.range(5).toDF("a")
    assert metadata.control_product(a, a.toDF("b"), 5).count() == 25
    with pytest.raises(ValueError):
        metadata.control_product(a, a.toDF("b"), 4)


def test_compare_by_hash_tells_texts_apart(spark):
    left = spark.createDataFrame([(1, "a|b", "c"), (2, None, "x"), (3, "same", None), (4, "1", "1:1")], "k int, a string, b string")
    right = spark.createDataFrame([(1, "a", "b|c"), (2, "~", "x"), (3, "same", None), (4, "1:1", "1")], "k int, a string, b string")
    got = {r.k: r.verdict for r in reconcile.compare_by_hash(left, right, ["k"], ["a", "b"]).collect()}
    assert got == {1: "different", 2: "different", 4: "different"}
