"""Literal edge rows of keys, commit numbers, images, messages and schema merges."""

import base64
import hashlib
import itertools
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import images, keys, messages
from tideline.operators import evolve


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


def test_key_numbers_agree(spark):
    df = spark.range(1).select(F.lit(1).alias("i"), F.lit(1.0).alias("d"), F.lit("1.000").cast("decimal(10,3)").alias("m"), F.lit("1.000").alias("s"), F.lit(b"\x01").alias("b"), F.lit(datetime(1970, 1, 2)).cast("timestamp_ntz").alias("t"), F.lit("12345678901234567890123456789012345678").cast("decimal(38,0)").alias("w"), F.lit("100").cast("decimal(10,0)").alias("h"))
    got = df.select(*[keys.key_text(c, df.schema[c].dataType).alias(c) for c in df.columns]).first().asDict()
    assert got == {"i": "1", "d": "1", "m": "1", "s": "1.000", "b": base64.b64encode(b"\x01").decode(), "t": "86400", "w": "12345678901234567890123456789012345678", "h": "100"}


def test_surrogate_key_null_part(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(keys.surrogate_key(df.schema, ["a", "b"]).alias("k")).first().k == hashlib.md5(b"1#$%^#_._--NULL--_._").hexdigest()
    with pytest.raises(TypeError):
        keys.key_text("a", T.ArrayType(T.IntegerType()))


@pytest.mark.parametrize("database, text, value", [
    ("oracle", "0042", 42), ("postgres", "0000000A/00000001", 10 * 2**32 + 1), ("mysql", "000000000000000000003:000000000000007", 3 * 2**32 + 7),
    ("mysql", "1:3e11fa47-71ca-11e1-9e33-c80aa9429562:0099", 99), ("sqlserver", "ffffffff:ffffffff:ffff" * 2, 2**80 - 1),
])
def test_commit_numbers(spark, database, text, value):
    assert one(spark, keys.decode_csn("t", database), t=text) == Decimal(value)


@pytest.mark.parametrize("database, text", [("oracle", "x1"), ("oracle", "0"), ("postgres", "1FFFFFFFF/1"), ("mysql", "1:nouuid:4"), ("mysql", "5000000000:1"), ("sqlserver", "00000000:00000000:0001" + "00000000:00000000:0002"), ("sqlserver", "00000000:00000000:0000" * 2)])
def test_bad_commit_numbers_raise(spark, database, text):
    with pytest.raises(Exception, match="commit number"):
        one(spark, keys.decode_csn("t", database), t=text)


def test_sequencer(spark):
    r = one(spark, keys.sequencer("c", "p", F.lit(True), F.lit("I")), c="10", p="2")
    assert (r.csn, r.pos, r.is_pk_change) == (10, 2, 1)
    with pytest.raises(Exception, match="csn is null"):
        one(spark, keys.sequencer("c", "p"), c=None, p="1")


@pytest.mark.parametrize("database, kind, text, value", [
    ("oracle", T.TimestampNTZType(), "-1.5", datetime(1969, 12, 31, 23, 59, 58, 500000)), ("postgres", T.TimestampNTZType(), "0001-01-01", datetime(1, 1, 1)),
    ("mysql", T.TimestampNTZType(), "1.000001", datetime(1970, 1, 1, 0, 0, 1, 1)), ("mysql", T.BinaryType(), "ab", b"ab"), ("oracle", T.BinaryType(), "AQI=", b"\x01\x02"),
    ("postgres", T.BooleanType(), "AQ==", True), ("sqlserver", T.BooleanType(), "AA==", False), ("oracle", T.DecimalType(5, 2), "-123.45", Decimal("-123.45")), ("oracle", T.DecimalType(5, 2), "0000123.4", Decimal("123.40")),
    ("oracle", T.LongType(), "7", 7), ("oracle", T.DoubleType(), "1.5e3", 1500.0), ("oracle", T.StringType(), " x ", " x "), ("oracle", T.LongType(), None, None),
])
def test_typed_values(spark, database, kind, text, value):
    got = one(spark, images.typed_value(F.col("t"), kind, database), t=text)
    assert (bytes(got) if isinstance(got, bytearray) else got) == value


@pytest.mark.parametrize("database, kind, text", [("postgres", T.BooleanType(), "Ag=="), ("oracle", T.BooleanType(), "AQ=="), ("oracle", T.DecimalType(5, 2), "1.234"), ("oracle", T.DecimalType(5, 2), "1234567"), ("oracle", T.LongType(), "x")])
def test_misfits_raise(spark, database, kind, text):
    with pytest.raises(Exception):  # noqa: B017
        one(spark, images.typed_value(F.col("t"), kind, database), t=text)


def test_repair(spark):
    r = one(spark, images.repair_unchanged("b", "a"), b='{"x":"1","y":"2"}', a='{"x":"unchanged-toast-datum","y":"3"}')
    assert r == '{"x":"1","y":"3"}'


@pytest.mark.parametrize("key, want", [("C##GGS.GG_HEARTBEAT_HISTORY", "gg.ggs.gg_heartbeat_history"), ("C##DB.SCH.TAB__DOL", "db.sch.tab__dol")])
def test_message_keys(spark, key, want):
    assert one(spark, messages.normalized_key("k"), k=key) == want


@pytest.mark.parametrize("key", ["two.parts", None, "a.b.c.d"])
def test_bad_message_keys(spark, key):
    with pytest.raises(Exception, match="message key"):
        one(spark, messages.normalized_key("k"), k=key)


def test_table_of(spark):
    assert one(spark, messages.table_of("k"), k="db.sch.tab__dol") == "tab$"


KINDS = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(10,2)", "decimal(12,4)", "decimal(38,0)", "date", "timestamp", "string", "binary", "boolean", "void"]


def merged_types(spark, pairs, database="oracle"):
    """merge_type of (table, data) pairs; None for a conflict."""
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    m = evolve.merge_type(evolve._parsed(F.col("a")), evolve._parsed(F.col("b")), database)
    return [r.t for r in df.select("i", m["t"].alias("t")).orderBy("i").collect()]


def test_widening(spark):
    pairs = {
        ("decimal(10,2)", "decimal(12,4)"): "decimal(12,4)", ("decimal(12,4)", "decimal(10,2)"): "decimal(12,4)", ("date", "timestamp"): "timestamp",
        ("int", "decimal(10,0)"): "decimal(10,0)", ("timestamp", "bigint"): "bigint", ("bigint", "timestamp"): "timestamp", ("void", "int"): "int", ("int", "void"): "int",
        ("string", "bigint"): None, ("decimal(10,2)", "decimal(10,4)"): None, ("boolean", "binary"): None, ("decimal(10,2)", "double"): None, ("double", "tinyint"): "double",
        ("struct", "int"): None, ("map<string,int>", "map<string,int>"): "map<string,int>", ("bigint", "decimal(20,4)"): None, ("smallint", "decimal(9,4)"): "decimal(9,4)",
    }
    assert merged_types(spark, list(pairs)) == list(pairs.values())
    assert merged_types(spark, [("boolean", "binary")], "postgres") == ["boolean"] and merged_types(spark, [("binary", "string")], "mysql") == ["binary"]


def test_all_pairs_are_decided(spark):
    pairs = list(itertools.product(KINDS, KINDS))
    got = dict(zip(pairs, merged_types(spark, pairs)))
    assert all(t in (a, b, None) for (a, b), t in got.items())
    assert all((got[a, b] is None) == (got[b, a] is None) for a, b in pairs) and all(got[a, a] == a for a in KINDS)


def folded(spark, rows):
    out = {}
    for r in sorted(evolve.fold_versions(spark.createDataFrame(rows, "flow_id string, version int, position int, column string, type string")).collect(), key=lambda r: (r.flow_id, r.position)):
        out.setdefault(r.flow_id, ([], r.version, r.overwrite, r.failed))[0].append(f"{r.column} {r.type}")
    return out


def test_fold(spark):
    rows = [
        ("new", 0, 0, "b", "int"), ("new", 0, 1, "a", "int"), ("new", 2, 0, "z", "string"), ("new", 2, 1, "a", "int"), ("new", 5, 0, "c", "void"),
        ("wide", 0, 0, "a", "int"), ("wide", 1, 0, "a", "bigint"), ("wide", 2, 0, "a", "int"),
        ("bad", 0, 0, "a", "int"), ("bad", 1, 0, "a", "bigint"), ("bad", 1, 1, "n", "date"), ("bad", 2, 0, "a", "string"), ("bad", 2, 1, "late", "int"), ("bad", 3, 0, "later", "int"),
        ("deep", 0, 0, "s", "struct<x:int,y:struct<p:date>>"), ("deep", 0, 1, "t", "string"),
        ("deep", 1, 0, "s", "struct<w:decimal(4,2),y:struct<q:array<struct<k:int>>,p:timestamp>,x:bigint>"),
        ("clash", 0, 0, "s", "struct<x:int>"), ("clash", 1, 0, "s", "int"),
    ]
    got = folded(spark, rows)
    assert got["new"] == (["b int", "a int", "z string", "c void"], 5, False, False)
    assert got["wide"] == (["a bigint"], 2, True, False)
    assert got["bad"] == (["a bigint", "n date"], 2, True, True)
    assert got["deep"] == (["s struct<x:bigint,y:struct<p:timestamp,q:array<struct<k:int>>>,w:decimal(4,2)>", "t string"], 1, True, False)
    assert got["clash"] == (["s struct<x:int>"], 1, False, True)
    df = spark.createDataFrame([(*r, 10 * r[1]) for r in rows], "flow_id string, version int, position int, column string, type string, fingerprint long")
    flows = {r.flow_id: r for r in evolve.fold_flows(df).collect()}
    assert flows["new"].fingerprints == [0, 20, 50] and flows["new"].ddl == "b int,a int,z string,c void" and flows["new"].error is None
    assert flows["bad"].error == "no common type for a in version 2" and flows["bad"].ddl is flows["bad"].fingerprints is flows["bad"].overwrite is None


def test_fingerprints():
    """Published values, and forms that differ in what readers do not need."""
    known = {"null": 7195948357588979594, "boolean": -6970731678124411036, "int": 8247732601305521295, "long": -3434872931120570953, "float": 5583340709985441680, "double": -8181574048448539266, "bytes": 5746618253357095269, "string": -8142146995180207161}
    for kind, value in known.items():
        assert evolve.fingerprint(f'"{kind}"') == evolve.fingerprint(f'{{"type": "{kind}", "logicalType": "x"}}') == value
    a = '{"type":"record","name":"R","namespace":"n.s","fields":[{"name":"f","type":{"type":"enum","name":"E","symbols":["A"]},"default":"A"},{"name":"g","type":["null","E"]}]}'
    b = '{"doc": "text", "fields": [{"type": {"name": "n.s.E", "symbols": ["A"], "type": "enum"}, "name": "f"}, {"name": "g", "type": ["null", "n.s.E"]}], "name": "n.s.R", "type": "record"}'
    import json

    assert evolve.canonical(json.loads(a)) == evolve.canonical(json.loads(b)) == '{"name":"n.s.R","type":"record","fields":[{"name":"f","type":{"name":"n.s.E","type":"enum","symbols":["A"]}},{"name":"g","type":["null","n.s.E"]}]}'


def test_schema_texts():
    node = {"type": "record", "name": "R", "fields": [{"name": "A", "type": {"type": "bytes", "logicalType": "decimal", "precision": 50, "scale": 3}}, {"name": "N", "type": {"type": "string", "origtype": "number", "scale": 2}}, {"name": "S", "type": ["null", {"type": "record", "name": "X", "fields": [{"name": "B", "type": "long"}]}]}]}
    done = evolve.preprocess(node, numeric_as_string=True)
    assert [f["name"] for f in done["fields"]] == ["a", "n", "s"]
    assert [evolve.node_type(f["type"]) for f in done["fields"]] == ["decimal(38,3)", "decimal(38,2)", "struct<b:bigint>"]


def test_fingerprints_of_many_forms():
    """Forms of all lengths at once, a byte of each at a time, against the bit by bit definition."""

    def plain(form):
        fp = evolve.EMPTY
        for byte in form:
            fp ^= byte
            for _ in range(8):
                fp = fp >> 1 ^ (evolve.EMPTY if fp & 1 else 0)
        return fp - (1 << 64) if fp >> 63 else fp

    forms = [b"", b"x", b'"int"', *[bytes(range(n)) for n in (200, 3, 255, 64)], "é".encode(), b"x", b""]
    assert evolve.fingerprints(forms).tolist() == [plain(f) for f in forms] and evolve.fingerprints([]).tolist() == []


def test_registry_row_for_each_schema(spark):
    """A text under many keys is one parse; each key has its row, and columns in order."""
    text = '{"type":"record","name":"E","fields":[{"name":"before","type":["null",{"type":"record","name":"R","fields":[{"name":"B","type":"int"},{"name":"A","type":["null","long"]}]}]}]}'
    other = text.replace('"A"', '"Z"')
    rows = spark.createDataFrame([(f"k{i % 20}", text) for i in range(40)] + [("o", other), ("n", None), ("w", '{"name":"generic_wrapper"}')], "key string, schema string")
    got = {r.key: (r.fingerprint, [(c["column"], c["type"]) for c in r.columns]) for r in evolve.registry_schemas(rows).collect()}
    assert len(got) == 21 and got["o"] == (evolve.fingerprint(other), [("b", "int"), ("z", "bigint")])
    assert {got[f"k{i}"][0] for i in range(20)} == {evolve.fingerprint(text)} and got["k3"][1] == [("b", "int"), ("a", "bigint")]
    assert sorted((r.key, r.position, r.column, r.type) for r in evolve.registry_columns(rows.where("key = 'k3'")).collect()) == [("k3", 0, "b", "int"), ("k3", 1, "a", "bigint")]
