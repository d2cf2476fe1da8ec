"""Curve layout, gated writes, images by registry, merge reports."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tideline import storage
from tideline.operators import changes as C
from tideline.operators import evolve as E
from tideline.operators import gate as G
from tideline.operators import merge as M


def test_every_column_prunes(spark, tmp_path):
    """A narrow filter reads about files^(2/3) of the files on each of three columns, also of texts and dates, with nulls and a
    frequent value; the lexicographic rewrite reads all files for the later columns."""
    r = random.Random(1)
    day = datetime.date(2020, 1, 1)
    rows = [(r.randint(0, 9999) if i % 50 else None, f"name{r.randint(0, 999):03d}", day + datetime.timedelta(r.randint(0, 700)) if i % 3 else day) for i in range(20_000)]
    df = spark.createDataFrame(rows, "a int, b string, c date").repartition(4)
    M.clustered(df, ["a", "b", "c"], 27).write.parquet(str(tmp_path / "curve"))
    M.compact(df, ["a", "b", "c"], 27).write.parquet(str(tmp_path / "plain"))
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "curve")).collect())) == sorted(map(str, df.collect()))
    read = {}
    for name in ("curve", "plain"):
        ranges = M.file_ranges(spark.read.parquet(str(tmp_path / name)), ["a", "b", "c"]).collect()
        for c, v in (("a", 5000), ("b", "name500"), ("c", day + datetime.timedelta(300))):
            read[name, c] = sum(x[f"low_{c}"] is not None and x[f"low_{c}"] <= v <= x[f"high_{c}"] for x in ranges) / len(ranges)
    assert all(read["curve", c] < 0.7 for c in "abc") and read["plain", "b"] > 0.95 and read["plain", "c"] > 0.95
    assert read["curve", "b"] < 0.7 * read["plain", "b"]


def test_files_by_measured_bytes(spark, tmp_path):
    spark.range(10_000).select("id", F.xxhash64("id").alias("h")).write.parquet(str(tmp_path / "t"))
    size = storage.size(spark, str(tmp_path / "t"))
    n = M.cluster_table(spark, str(tmp_path / "t"), str(tmp_path / "u"), ["id", "h"], size // 4 + 1)
    assert n == 4 and 2 <= len(list((tmp_path / "u").glob("*.parquet"))) <= 4 and spark.read.parquet(str(tmp_path / "u")).count() == 10_000
    empty = spark.range(0)
    assert M.clustered(empty, ["id"], 4).count() == 0


def test_gated_write(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("bad", F.col("id") > 7)
    bad = G.Gate("n_bad", F.sum(F.col("bad").cast("int")), 1)
    v = G.gated_write(rows, path, [bad, G.Gate("n", F.count("*"), 100)])
    assert not v.published and v.metrics == {"n_bad": 2, "n": 10} and v.failed == ["n_bad"] and not storage.exists(spark, path)
    assert spark.read.parquet(*map(str, tmp_path.glob("t__rejected-*"))).count() == 10
    assert G.gated_write(rows.where("NOT bad"), path, [bad]).published and spark.read.parquet(path).count() == 8
    with pytest.raises(FileExistsError):
        G.gated_write(rows, path, [])
    assert G.gated_write(rows.limit(0), f"{path}-empty", [bad]) == (True, {"n_bad": None}, [])


def test_images_by_registry(spark):
    """Types of their own for each version, misfits named, what is not listed left out, no object and no version null."""
    kinds = [(1, "a", "int"), (1, "b", "decimal(10,2)"), (2, "a", "boolean"), (2, "c", "date"), (2, "d", "timestamp"), (3, "a", "array<int>")]
    registry = spark.createDataFrame([(f, i, n, t) for i, (f, n, t) in enumerate(kinds)] * 2, "schema_fingerprint long, position int, `column` string, type string")
    rows = [(1, '{"a":"5","b":"1.50","z":"?"}'), (1, '{"a":"five","b":null}'), (2, '{"a":"true","c":"2024-01-02","d":"soon"}'), (3, '{"a":"[1]"}'), (4, '{"a":"1"}'), (1, None), (1, "no json"), (1, "[1]"), (None, "{}")]
    df = spark.createDataFrame(rows, "schema_fingerprint long, img string")
    got = C.decode_by_registry(df, registry, ["img"]).select("schema_fingerprint", F.to_json("img.image").alias("j"), F.col("img.bad").alias("bad"))
    want = [(1, '{"a":5,"b":1.5}', []), (1, "{}", ["a"]), (2, '{"a":true,"c":"2024-01-02"}', ["d"]), (3, '{"a":"[1]"}', []), (4, None, None), (1, None, None), (1, None, None), (1, None, None), (None, None, None)]
    assert sorted(map(str, ((r[0], r.j, r.bad) for r in got.collect()))) == sorted(map(str, want))


def test_merge_report(spark):
    """Nested fields, the outermost of new and missing ones, both directions of widening, nullability, and the version that ends a flow."""
    rows = [
        ("f", 1, 0, "a", "int", False), ("f", 1, 1, "s", "struct<x:int,t:struct<u:string>>", False), ("f", 1, 2, "gone", "string", False),
        ("f", 2, 0, "a", "bigint", False), ("f", 2, 1, "s", "struct<x:tinyint,y:date>", True), ("f", 2, 2, "new", "struct<p:int>", False),
        ("f", 3, 0, "a", "bigint", True), ("f", 3, 1, "new", "struct<p:int,q:int>", False),
        ("g", 1, 0, "a", "int", True), ("g", 2, 0, "a", "int", True), ("g", 2, 1, "b", "int", True), ("g", 3, 0, "a", "string", True), ("g", 4, 0, "a", "int", True),
    ]
    df = spark.createDataFrame(rows, "flow_id string, version int, position int, `column` string, type string, nullable boolean")
    got = {(r.flow_id, r.version): r for r in E.merge_report(df).collect()}
    assert set(got) == {("f", 2), ("f", 3), ("g", 2), ("g", 3)}
    two, three = got["f", 2], got["f", 3]
    assert two.new == ["new", "s.y"] and two.missing == ["gone", "s.t"] and two.merged == ["a: int > bigint = bigint", "s.x: int > tinyint = int"] and two.overwrite
    assert two.nullable == ["gone", "s", "s.t", "s.t.u", "s.x"]
    assert three.new == ["new.q"] and three.missing == ["gone", "s"] and three.merged == [] and not three.overwrite and three.nullable == ["a"]
    assert got["g", 2].new == ["b"] and got["g", 2].error is None and not got["g", 2].overwrite
    assert got["g", 3].error == "no common type for a in version 3" and got["g", 3].new is None and got["g", 3].overwrite is None
    with pytest.raises(Exception, match="a struct among plain columns"):
        E.fold_versions(df.drop("nullable"), nested=False).collect()
