"""Schema registry and evolution: versions folded into one schema for each flow, then classified and compared.

Types are texts of the DDL. The fields of nested structs are rows of their own, named by their path, so every field folds over
the versions for itself, as one aggregate of an ordered list; a conflict stops its whole flow at that version. No Python
takes part but for splitting the texts of struct types and parsing schema texts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The order of numeric widening, and decimal digits of the integral types.
WIDENING = ("tinyint", "smallint", "int", "bigint", "float", "double")
INTEGRAL_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
#: Fixed values: (table type, incoming type) pairs for which a source database keeps the table's type.
OVERRIDES = {
    "postgres": {("boolean", "binary"), ("timestamp", "string")},
    "mysql": {("timestamp", "string"), ("binary", "string")},
    "sqlserver": {("timestamp", "string"), ("boolean", "binary")},
}


PAIRS = ("date>timestamp", "timestamp>bigint", "bigint>timestamp")


def _parsed(kind: Column) -> Column:
    """What the widening rule asks of a type: its text, its rank among the numeric ones (-1: none), and its digits before and
    after the point."""
    rank = F.coalesce(*[F.when(kind == t, i) for i, t in enumerate(WIDENING)], F.lit(-1))
    size = lambda g: F.try_to_number(F.nullif(F.regexp_extract(kind, r"^decimal\((\d+),(\d+)\)$", g), F.lit("")), F.lit("99")).cast("int")
    whole = F.coalesce(*[F.when(kind == t, d) for t, d in INTEGRAL_DIGITS.items()], size(1) - size(2))
    return F.struct(kind.alias("t"), rank.alias("rank"), whole.alias("whole"), F.when(whole.isNotNull(), F.coalesce(size(2), F.lit(0))).alias("scale"))


def can_widen(old: Column, new: Column) -> Column:
    """May a column of the old type hold the new type instead? Both as _parsed gives them."""
    decimal = new["t"].startswith("decimal") & (new["scale"] >= old["scale"]) & (new["whole"] >= old["whole"])
    numeric = (old["rank"] >= 0) & (new["rank"] >= 0)
    listed = F.concat(old["t"], F.lit(">"), new["t"]).isin(*PAIRS)
    return (old["t"] == new["t"]) | (old["t"] == "void") | F.when(numeric, old["rank"] < new["rank"]).otherwise(F.coalesce(decimal, F.lit(False)) | listed)


def merge_type(table: Column, data: Column, database: str = "oracle") -> Column:
    """Type of a column after an incoming version: overrides first, then either way of widening, the newer side first; null for two
    types that nothing holds both of."""
    kept = [(table["t"] == a) & (data["t"] == b) for a, b in sorted(OVERRIDES.get(database, ()))]
    stays = (data["t"] == "void") | (table["t"] == data["t"])
    for k in kept:
        stays |= k
    return F.when(stays, table).when(can_widen(table, data), data).when(can_widen(data, table), table)


def split_struct(kind: str) -> list[tuple[str, str]]:
    """(name, type) of the fields of a struct type's text."""
    out, depth, start = [], 0, len("struct<")
    for i, c in enumerate(kind[:-1] + ","):
        if c in "<(" and i >= start:
            depth += 1
        elif c in ">)":
            depth -= 1
        elif c == "," and not depth and i >= start:
            name, _, rest = kind[start:i].partition(":")
            out.append((name.strip(), rest.strip()))
            start = i + 1
    return [x for x in out if x[0]]


def _paths(kind: str, above: tuple[str, ...] = ()) -> list[tuple[list[str], int, str]]:
    """(path, position, type or struct) of a type's text and of all fields in it."""
    if not kind.startswith("struct<"):
        return [(list(above), 0, kind)]
    out = [(list(above), 0, "struct")]
    for i, (name, inner) in enumerate(split_struct(kind)):
        (path, _, first), *rest = _paths(inner, (*above, name))
        out += [(path, i, first), *rest]
    return out


def flat_types(columns: DataFrame) -> DataFrame:
    """Column rows with `path`, the names from the column to a field of its struct; each distinct struct text is split once."""

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([(t, *row) for t in part.type for row in _paths(t)], columns=["type", "below", "at", "kind"])

    struct = F.col("type").startswith("struct<")
    kinds = columns.where(struct).select("type").distinct().mapInPandas(split, "type string, below array<string>, at int, kind string")
    rest = [c for c in columns.columns if c != "type"]
    plain = columns.where(~struct).select(*rest, F.array("column").alias("path"), "type")
    nested = columns.where(struct).join(kinds, "type").select(*rest, F.concat(F.array("column"), "below").alias("path"), F.col("kind").alias("type"), F.when(F.size("below") > 0, F.col("at")).otherwise(F.col("position")).alias("at"))
    return plain.unionByName(nested.drop("position").withColumnRenamed("at", "position").select(*plain.columns))


def _plain(columns: DataFrame) -> DataFrame:
    """flat_types for columns that are said to hold no struct."""
    struct = F.col("type").startswith("struct<")
    kind = F.when(struct, F.raise_error(F.concat(F.lit("a struct among plain columns: "), "column"))).otherwise(F.col("type"))
    return columns.withColumn("path", F.array("column")).withColumn("type", kind).drop("column")


def _folded_fields(columns: DataFrame, database: str, nested: bool) -> DataFrame:
    """Fields (flow_id, path, type, overwrite, since, position, version, failed_at, field) as of the last version that merged."""
    done = "array<struct<version:int,position:int,t:string,retyped:boolean,failed:boolean>>"
    seen = F.array_sort(F.collect_list(F.struct("version", "position", _parsed(F.col("type")).alias("x"))))
    columns = columns.withColumn("version", F.col("version").cast("int")).withColumn("position", F.col("position").cast("int"))
    fields = (flat_types(columns) if nested else _plain(columns)).repartition("flow_id")  # every later step groups by the flow
    fields = fields.groupBy("flow_id", "path").agg(seen.alias("vs"))
    none = F.struct(F.lit(None).cast("struct<t:string,rank:int,whole:int,scale:int>").alias("now"), F.array().cast(done).alias("steps"))

    def step(acc: Column, v: Column) -> Column:
        first = acc["now"].isNull()
        new = F.when(first, v["x"]).otherwise(merge_type(acc["now"], v["x"], database))
        row = F.struct(v["version"].alias("version"), v["position"].alias("position"), new["t"].alias("t"), (~first & (new["t"] != acc["now"]["t"])).alias("retyped"), new.isNull().alias("failed"))
        return F.struct(F.coalesce(new, acc["now"]).alias("now"), F.concat(acc["steps"], F.array(row)).alias("steps"))

    fields = fields.select("flow_id", "path", F.aggregate("vs", none, step)["steps"].alias("steps"))
    bad = F.get(F.filter("steps", lambda s: s["failed"]), 0)["version"]
    fields = fields.withColumn("bad", bad).withColumn("last", F.element_at("steps", -1)["version"])
    flow = Window.partitionBy("flow_id")
    why = F.min(F.when(F.col("bad").isNotNull(), F.struct(F.col("bad").alias("version"), F.array_join("path", ".").alias("field")))).over(flow)
    fields = fields.withColumn("why", why).withColumn("version", F.least("why.version", F.max("last").over(flow)))
    applied = F.filter("steps", lambda s: F.col("why").isNull() | (s["version"] < F.col("why.version")))
    fields = fields.withColumn("steps", applied).where(F.size("steps") > 0)
    return fields.select("flow_id", "path", F.element_at("steps", -1)["t"].alias("type"), F.exists("steps", lambda s: s["retyped"]).alias("overwrite"), F.col("steps")[0]["version"].alias("since"), F.col("steps")[0]["position"].alias("position"), "version", F.col("why.version").alias("failed_at"), F.col("why.field").alias("field"))


#: Levels of structs in structs that a fold puts together again; deeper ones raise.
DEPTH = 6


def _folded(columns: DataFrame, database: str, nested: bool) -> DataFrame:
    """Columns with the types of structs put together from their fields, the deepest first."""
    if not nested:
        return _folded_fields(columns, database, False).select("flow_id", F.col("path")[0].alias("column"), "type", "since", F.col("position").alias("at"), F.col("overwrite").alias("changed"), "version", "failed_at", "field")
    one = F.struct("path", "since", "position", "type", "overwrite")
    flow = ["version", "failed_at", "field"]
    rows = _folded_fields(columns, database, True).groupBy("flow_id", F.col("path")[0].alias("column")).agg(F.collect_list(one).alias("fs"), F.max("overwrite").alias("changed"), *[F.first(c).alias(c) for c in flow])
    deep = F.array_max(F.transform("fs", lambda f: F.size(f["path"]))) > DEPTH
    rows = rows.withColumn("fs", F.when(deep, F.raise_error(F.concat(F.lit("structs too deep in "), "column"))).otherwise(F.col("fs")))
    for d in range(DEPTH, 1, -1):
        inner = F.array_sort(F.transform(F.filter("fs", lambda f: F.size(f["path"]) == d), lambda f: F.struct(f["since"].alias("since"), f["position"].alias("position"), F.slice(f["path"], 1, d - 1).alias("above"), F.concat_ws(":", F.element_at(f["path"], -1), f["type"]).alias("text"))))
        rows = rows.withColumn("inner", inner)
        below = lambda f: F.filter("inner", lambda x: x["above"] == f["path"])
        text = lambda f: F.concat(F.lit("struct<"), F.array_join(F.transform(below(f), lambda x: x["text"]), ","), F.lit(">"))
        rows = rows.withColumn("fs", F.transform(F.filter("fs", lambda f: F.size(f["path"]) < d), lambda f: F.struct(f["path"].alias("path"), f["since"].alias("since"), f["position"].alias("position"), F.when((f["type"] == "struct") & (F.size(f["path"]) == d - 1), text(f)).otherwise(f["type"]).alias("type"), f["overwrite"].alias("overwrite"))))
    return rows.select("flow_id", "column", F.col("fs")[0]["type"].alias("type"), F.col("fs")[0]["since"].alias("since"), F.col("fs")[0]["position"].alias("at"), "changed", *flow)


FOLDED = "flow_id string, position int, column string, type string, version int, overwrite boolean, failed boolean"


def _with_errors(columns: DataFrame, database: str, nested: bool) -> DataFrame:
    flow = Window.partitionBy("flow_id")
    place = F.row_number().over(flow.orderBy("since", "at", "column")) - 1
    error = F.when(F.col("failed_at").isNotNull(), F.concat(F.lit("no common type for "), F.col("field"), F.lit(" in version "), F.col("failed_at")))
    return _folded(columns, database, nested).select("flow_id", place.cast("int").alias("position"), "column", "type", "version", F.max("changed").over(flow).alias("overwrite"), F.col("failed_at").isNotNull().alias("failed"), error.alias("error"))


def fold_versions(columns: DataFrame, database: str = "oracle", nested: bool = True) -> DataFrame:
    """Merged columns of each flow (FOLDED) from rows (flow_id, version, position, column, type), versions in order.

    The first version's columns come first, then new ones as they appear; fields of structs merge alike. A flow with a
    conflict is marked failed and keeps what it had before that version; others go on. overwrite: a type changed, so new
    columns alone spare the table's rewrite. Without nested types (nested=False; a struct is an error then) all is one pass.
    """
    return _with_errors(columns, database, nested).drop("error")


def fold_flows(columns: DataFrame, database: str = "oracle", nested: bool = True) -> DataFrame:
    """(flow_id, ddl, fingerprints, overwrite, error): the merged schema of each flow and the fingerprints it stands for, from
    rows with a `fingerprint` too. A flow with a conflict has an error and nothing else; it fails alone."""
    prints = columns.groupBy("flow_id").agg(F.array_sort(F.collect_set("fingerprint")).alias("fingerprints"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.concat_ws(" ", "column", "type").alias("d")))), lambda x: x["d"]), ",")
    flows = _with_errors(columns, database, nested).groupBy("flow_id").agg(text.alias("ddl"), F.max("overwrite").alias("overwrite"), F.first("error").alias("error"))
    return flows.join(prints, "flow_id").select("flow_id", *[F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in ("ddl", "fingerprints", "overwrite")], "error")


def merge_report(columns: DataFrame, database: str = "oracle") -> DataFrame:
    """What each version after a flow's first one changes: (flow_id, version, new, missing, merged, nullable, overwrite, error).

    new: paths that no earlier version had; missing: known paths that this version lacks; of a field and those inside it
    the outermost is listed. merged: `path: before > incoming = after` where the types differ, also where the old one holds the new.
    nullable: paths that lost their NOT NULL, because this version (rows with a column `nullable`; true if absent) allows nulls, or lacks the field. overwrite: false only
    for new fields without merged types. Lists are sorted. The version where two types have nothing in common has the error and no
    lists, and ends its flow's report.
    """
    rows = columns.withColumn("version", F.col("version").cast("int")).withColumn("position", F.col("position").cast("int"))
    if "nullable" not in columns.columns:
        rows = rows.withColumn("nullable", F.lit(True))
    every = rows.groupBy("flow_id").agg(F.array_sort(F.collect_set("version")).alias("all"))
    one = F.struct("version", _parsed(F.col("type")).alias("x"), "nullable")
    fields = flat_types(rows).groupBy("flow_id", "path").agg(F.array_sort(F.collect_list(one)).alias("vs")).join(every, "flow_id")
    kind = "struct<t:string,rank:int,whole:int,scale:int>"
    done = "array<struct<version:int,before:string,data:string,after:string,new:boolean,missing:boolean,loses:boolean>>"
    start = F.struct(F.lit(None).cast(kind).alias("now"), F.lit(None).cast("boolean").alias("null_ok"), F.array().cast(done).alias("steps"))

    def step(acc: Column, v: Column) -> Column:
        mine = F.get(F.filter("vs", lambda x: x["version"] == v), 0)
        first, here = acc["now"].isNull(), mine.isNotNull()
        new = F.when(~here, acc["now"]).when(first, mine["x"]).otherwise(merge_type(acc["now"], mine["x"], database))
        allows = F.coalesce(mine["nullable"], F.lit(True))
        old = F.coalesce(acc["null_ok"], v > F.col("all")[0])  # a field that comes later is null in the rows before
        row = F.struct(v.alias("version"), acc["now"]["t"].alias("before"), mine["x"]["t"].alias("data"), new["t"].alias("after"), (first & here & (v > F.col("all")[0])).alias("new"), (~first & ~here).alias("missing"), (~first & ~old & allows).alias("loses"))
        known = ~first | here
        return F.struct(F.coalesce(new, acc["now"]).alias("now"), F.when(known, old | allows).alias("null_ok"), F.when(known, F.concat(acc["steps"], F.array(row))).otherwise(acc["steps"]).alias("steps"))

    fields = fields.withColumn("step", F.explode(F.aggregate("all", start, step)["steps"])).select("flow_id", "path", "all", "step.*")
    above = fields.select("flow_id", F.col("path").alias("parent"), "version", (F.col("new") | F.col("missing")).alias("covered"))
    fields = fields.withColumn("parent", F.slice("path", 1, F.size("path") - 1)).join(above, ["flow_id", "parent", "version"], "left")
    name, top = F.array_join("path", "."), ~F.coalesce("covered", F.lit(False))
    listed = lambda cond, text=name: F.array_sort(F.collect_list(F.when(cond, text)))
    bad = F.col("after").isNull()
    text = F.concat(name, F.lit(": "), "before", F.lit(" > "), "data", F.lit(" = "), "after")
    out = fields.where(F.col("version") > F.col("all")[0]).groupBy("flow_id", "version").agg(
        listed(F.col("new") & top).alias("new"), listed(F.col("missing") & top).alias("missing"),
        listed(~F.col("new") & (F.col("before") != F.col("data")) & (F.col("data") != "void"), text).alias("merged"),
        listed(F.col("loses")).alias("nullable"), F.min(F.when(bad, name)).alias("field"),
    )
    flow = Window.partitionBy("flow_id")
    out = out.withColumn("bad", F.min(F.when(F.col("field").isNotNull(), F.col("version"))).over(flow)).where("bad IS NULL OR version <= bad")
    fine = F.col("field").isNull()
    error = F.concat(F.lit("no common type for "), "field", F.lit(" in version "), F.col("version").cast("string"))
    overwrite = ~((F.size("new") > 0) & (F.size("merged") == 0))
    return out.select("flow_id", "version", *[F.when(fine, F.col(c)).alias(c) for c in ("new", "missing", "merged", "nullable")], F.when(fine, overwrite).alias("overwrite"), F.when(~fine, error).alias("error"))


def classify(before: DataFrame, after: DataFrame) -> DataFrame:
    """(flow_id, change) for flow specs (flow_id, ddl, fingerprints) against merged ones (flow_id, ddl, fingerprints, overwrite)."""
    b, a = before.alias("b"), after.alias("a")
    same, prints = F.col("b.ddl") == F.col("a.ddl"), F.array_sort("b.fingerprints") == F.array_sort("a.fingerprints")
    change = (
        F.when(F.col("a.ddl").isNull() & F.col("a.fingerprints").isNull() & F.col("a.overwrite").isNull(), "FAILURE")
        .when(same & prints, "SAME")
        .when(same | ~F.col("a.overwrite"), "FLOW_RESTART_ONLY")
        .otherwise("FLOW_RESTART_AND_OVERWRITE")
    )
    return b.join(a, "flow_id").select("flow_id", change.alias("change"))


def diff_events(before: DataFrame, after: DataFrame) -> DataFrame:
    """(flow_id, column, event, status) of two column tables (flow_id, column, type)."""
    b = before.select("flow_id", "column", F.col("type").alias("old"))
    a = after.select("flow_id", "column", F.col("type").alias("new"))
    event = F.when(F.col("old").isNull(), "ADD_COLUMN").when(F.col("new").isNull(), "DROP_COLUMN").when(F.col("old") != F.col("new"), "MODIFY_COLUMN")
    out = b.join(a, ["flow_id", "column"], "full").withColumn("event", event).where("event IS NOT NULL")
    return out.select("flow_id", "column", "event", F.when(F.col("event") == "DROP_COLUMN", "IGNORED").otherwise("PROCESSED").alias("status"))


def ddl(columns: DataFrame, by: list[str], name: str = "column", kind: str = "type", position: str = "position") -> DataFrame:
    """One DDL text for each group, in order of position."""
    cols = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.concat_ws(" ", name, kind).alias("d"))))
    return columns.groupBy(*by).agg(F.array_join(F.transform(cols, lambda x: x["d"]), ",").alias("ddl"))


# Registry of schema texts -------------------------------------------------------------------------------------------

_AVRO = {"boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double", "bytes": "binary", "string": "string", "null": "void"}
_LOGICAL = {"timestamp-millis": "timestamp", "timestamp-micros": "timestamp", "date": "date"}


#: Fixed value: the start and polynomial of the 64-bit fingerprint in the public schema specification.
EMPTY = 0xC15D213AA4D7A795
_NAMED = ("record", "error", "enum", "fixed")


def canonical(node, space: str = "") -> str:
    """Parsing canonical form of a schema: what readers need of it, in a fixed order, without white space."""
    if isinstance(node, list):
        return "[" + ",".join(canonical(n, space) for n in node) + "]"
    if isinstance(node, str):
        return json.dumps(node if node in _AVRO or "." in node or not space else f"{space}.{node}")
    kind = node["type"]
    if not isinstance(kind, str) or kind in _AVRO:
        return canonical(kind, space)
    if kind == "array":
        return f'{{"type":"array","items":{canonical(node["items"], space)}}}'
    if kind == "map":
        return f'{{"type":"map","values":{canonical(node["values"], space)}}}'
    if kind not in _NAMED:
        return canonical(kind, space)
    name = node["name"] if "." in node["name"] else ".".join(filter(None, (node.get("namespace", space), node["name"])))
    inside = name.rpartition(".")[0]
    if kind == "enum":
        rest = ',"symbols":[' + ",".join(map(json.dumps, node["symbols"])) + "]"
    elif kind == "fixed":
        rest = f',"size":{int(node["size"])}'
    else:
        rest = ',"fields":[' + ",".join(f'{{"name":{json.dumps(f["name"])},"type":{canonical(f["type"], inside)}}}' for f in node["fields"]) + "]"
    return f'{{"name":{json.dumps(name)},"type":"{"record" if kind == "error" else kind}"{rest}}}'


def _byte_table() -> np.ndarray:
    """What each value of the lowest byte adds to a fingerprint that is shifted by it."""
    t = np.arange(256, dtype=np.uint64)
    for _ in range(8):
        t = t >> np.uint64(1) ^ np.where(t & np.uint64(1), np.uint64(EMPTY), np.uint64(0))
    return t


_BYTES = _byte_table()


def fingerprints(forms: list[bytes]) -> np.ndarray:
    """Signed 64-bit Rabin fingerprints of some canonical forms, a byte of all forms at a time; the longest come first, so
    each step works on those that still have a byte."""
    length = np.array([len(f) for f in forms], np.int64)
    order = np.argsort(-length, kind="stable")
    data = np.frombuffer(b"".join(forms), np.uint8)
    start, fp = (np.cumsum(length) - length)[order], np.full(len(forms), EMPTY, np.uint64)
    there = np.searchsorted(-length[order], -np.arange(length.max(initial=0)), side="left")  # forms longer than i
    for i, n in enumerate(there.tolist()):
        low = (fp[:n] & np.uint64(255)).astype(np.uint8) ^ data[start[:n] + i]
        fp[:n] = fp[:n] >> np.uint64(8) ^ _BYTES[low]
    out = np.empty(len(forms), np.uint64)
    out[order] = fp
    return out.view(np.int64)


def fingerprint(schema: str) -> int:
    """64-bit Rabin fingerprint of a schema text's parsing canonical form, as a signed number."""
    return int(fingerprints([canonical(json.loads(schema)).encode()])[0])


def preprocess(node, preserve_case: bool = False, numeric_as_string: bool = False):
    """Schema node with lower-case names, decimals of at most 38 digits, and numbers written as text typed as decimals."""
    if isinstance(node, list):
        return [preprocess(n, preserve_case, numeric_as_string) for n in node]
    if not isinstance(node, dict):
        return node
    out = {k: preprocess(v, preserve_case, numeric_as_string) if k in ("fields", "type", "items", "values") else v for k, v in node.items()}
    if "name" in out and not preserve_case:
        out["name"] = out["name"].lower()
    if out.get("logicalType") == "decimal" and out.get("precision", 0) > 38:
        out |= {"precision": 38, "scale": min(out.get("scale", 0), 38)}
    if numeric_as_string and out.get("origtype") == "number":
        out["type"] = ["null", {"type": "bytes", "logicalType": "decimal", "precision": 38, "scale": out.get("scale", 0)}]
    return out


def node_type(node) -> str:
    """DDL type of a schema node."""
    if isinstance(node, list):
        return node_type(next((n for n in node if n != "null"), "null"))
    if isinstance(node, str):
        return _AVRO[node]
    if node.get("logicalType") == "decimal":
        return f"decimal({node['precision']},{node.get('scale', 0)})"
    if node.get("logicalType") in _LOGICAL:
        return _LOGICAL[node["logicalType"]]
    kind = node["type"]
    if kind == "record":
        return "struct<" + ",".join(f"{f['name']}:{node_type(f['type'])}" for f in node["fields"]) + ">"
    if kind == "array":
        return f"array<{node_type(node['items'])}>"
    if kind == "map":
        return f"map<string,{node_type(node['values'])}>"
    return node_type(kind)


REGISTRY = "key string, fingerprint long, position int, column string, type string"
#: Distinct texts of a task whose parsed rows are held, so that a text that comes again is not parsed again.
HELD = 1000


def _parse(text: str, numeric_as_string: bool) -> tuple[bytes, list[dict]]:
    """Canonical form of a schema text and the columns of its `before` image."""
    schema = json.loads(text)
    node = preprocess(schema, numeric_as_string=numeric_as_string)
    image = next((f["type"] for f in node["fields"] if f["name"] == "before"), node)
    image = next((n for n in image if isinstance(n, dict)), None) if isinstance(image, list) else image
    columns = [{"column": f["name"], "type": node_type(f["type"])} for f in image["fields"]]
    return canonical(schema).encode(), columns


def registry_schemas(schemas: DataFrame, numeric_as_string: bool = False) -> DataFrame:
    """(key, fingerprint, columns array<struct<column, type>>) of distinct schema texts (key, schema), a row for each of them;
    wrapper schemas are left out."""
    rows = schemas.where(~F.col("schema").like("%generic_wrapper%")).select("key", "schema").distinct()
    shape = pa.list_(pa.struct([("column", pa.string()), ("type", pa.string())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed = lru_cache(HELD)(_parse)
        for b in batches:
            texts = b.column(1).dictionary_encode()
            found = [parsed(t, numeric_as_string) for t in texts.dictionary.to_pylist()]
            prints = pa.array(fingerprints([f for f, _ in found]))
            columns = pa.array([c for _, c in found], shape)
            yield pa.RecordBatch.from_arrays([b.column(0), prints.take(texts.indices), columns.take(texts.indices)], ["key", "fingerprint", "columns"])

    return rows.mapInArrow(parse, "key string, fingerprint long, columns array<struct<column:string,type:string>>")


def registry_columns(schemas: DataFrame, numeric_as_string: bool = False) -> DataFrame:
    """Column rows (REGISTRY) of the `before` image in distinct schema texts (key, schema); wrapper schemas are left out."""
    rows = registry_schemas(schemas, numeric_as_string).select("key", "fingerprint", F.posexplode("columns").alias("position", "c"))
    return rows.select("key", "fingerprint", "position", "c.column", "c.type")


def onboard(seen: DataFrame, specs: DataFrame, keys: list[str], new_id: Column) -> DataFrame:
    """Spec rows for newly seen schemas only."""
    return seen.select(*keys).distinct().join(specs, keys, "left_anti").withColumn("schema_id", new_id)
