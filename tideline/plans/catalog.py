"""Queries of schema evolution, metadata derivation and merges."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import storage
from tideline.operators import evolve as E
from tideline.operators import merge as M
from tideline.operators import metadata as MD
from tideline.plans.feeds import table

text = lambda c: F.array_join(c, ",")
s = lambda c: F.col(c).cast("string")


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def ordered_key_columns(spark, sf_dir):
    li = _lines(spark, sf_dir).withColumn("name", F.concat(F.lit("c"), s("l_partkey")))
    return MD.ordered_names(li, ["l_orderkey"], "name", "l_linenumber").select("l_orderkey", text("names").alias("names"))


#: Catalog types that lines stand for, by line number.
_KINDS = ("NUMBER", "VARCHAR2", "DATE", "CLOB", "FLOAT", "RAW", "TIMESTAMP(6)", "INTERVAL DAY", "BINARY_DOUBLE", "LONG RAW")
_KIND_SQL = "CASE (l_linenumber + l_partkey) % 11 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " ELSE 'NUMBER' END"


def catalog(spark, sf_dir):
    """Column catalog: a line is a column of the table of its order in the schema of its supplier."""
    li = _lines(spark, sf_dir)
    kind = F.element_at(F.array(*[F.lit(k) for k in (*_KINDS, "NUMBER")]), ((F.col("l_linenumber") + F.col("l_partkey")) % 11 + 1).cast("int"))
    return li.select(
        F.concat(F.lit("T"), s("l_orderkey")).alias("table_name"), F.concat(F.lit("S"), (F.col("l_suppkey") % 5).cast("string")).alias("owner"),
        F.concat(F.lit("c"), s("l_partkey")).alias("column_name"), kind.alias("data_type"), (F.col("l_quantity") * 100).cast("int").alias("data_length"),
        F.when(F.col("l_partkey") % 3 != 0, (F.col("l_partkey") % 30 + 5).cast("int")).alias("data_precision"), (F.col("l_suppkey") % 4).cast("int").alias("data_scale"),
        F.col("l_linenumber").alias("column_id"),
    )


CATALOG = f"""
WITH c AS (SELECT 'T' || l_orderkey AS table_name, 'S' || l_suppkey % 5 AS owner, 'c' || l_partkey AS column_name, {_KIND_SQL} AS data_type,
  CAST(trunc(l_quantity * 100) AS INTEGER) AS data_length, CASE WHEN l_partkey % 3 <> 0 THEN CAST(l_partkey % 30 + 5 AS INTEGER) END AS data_precision, CAST(l_suppkey % 4 AS INTEGER) AS data_scale, l_linenumber AS column_id FROM lineitem),
m AS (SELECT *, CASE WHEN data_type IN ('VARCHAR2', 'CLOB') OR data_type LIKE 'INTERVAL%' THEN 'STRING'
  WHEN data_type = 'NUMBER' AND data_precision IS NOT NULL THEN 'DECIMAL(' || data_precision || ',' || data_scale || ')'
  WHEN data_type IN ('NUMBER', 'FLOAT') THEN 'DECIMAL(38,6)' WHEN data_type = 'BINARY_DOUBLE' THEN 'DOUBLE'
  WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' THEN 'TIMESTAMP' WHEN data_type IN ('RAW', 'LONG RAW') THEN 'BINARY' END AS delta_type,
  data_type IN ('CLOB', 'LONG RAW') OR (data_type = 'RAW' AND data_length > 2000) OR (data_type = 'VARCHAR2' AND data_length > 4000) AS is_lob FROM c)
"""


def mapped(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return c.withColumn("delta_type", MD.mapped_type(F.col("data_type"), F.col("data_precision"), F.col("data_scale"))).withColumn("is_lob", MD.is_large(F.col("data_type"), F.col("data_length")))


def type_mapping(spark, sf_dir):
    return mapped(spark, sf_dir).groupBy("data_type", "delta_type").agg(F.count("*").alias("n"))


def lob_flags(spark, sf_dir):
    return mapped(spark, sf_dir).groupBy("data_type", "is_lob").agg(F.count("*").alias("n"), F.max("data_length").alias("max_length"))


def table_ddl(spark, sf_dir):
    c = mapped(spark, sf_dir).withColumn("position", F.struct("column_id", "column_name", "delta_type"))
    return E.ddl(c, ["table_name", "owner"], "column_name", "delta_type")


def lob_columns(spark, sf_dir):
    """Large columns of each table over all its schemas."""
    m = mapped(spark, sf_dir).groupBy("table_name").agg(F.array_sort(F.collect_set(F.when(F.col("is_lob"), F.col("column_name")))).alias("cols"))
    return m.where(F.size("cols") > 0).select("table_name", text("cols").alias("lob_columns"))


def _candidate_keys(spark, sf_dir):
    """Unique constraints: the lines of an order with one supplier remainder and return flag are a key's columns."""
    li = _lines(spark, sf_dir).select("l_orderkey", F.concat_ws("_", F.lit("uk"), (F.col("l_suppkey") % 3).cast("string"), "l_returnflag").alias("name"), F.struct("l_linenumber", "l_partkey").alias("pos"), F.concat(F.lit("c"), s("l_partkey")).alias("col"))
    return MD.ordered_names(li, ["l_orderkey", "name"], "col", "pos", "cols")


def smallest_unique_key(spark, sf_dir):
    return MD.smallest_key(_candidate_keys(spark, sf_dir), ["l_orderkey"], "cols", "name").select("l_orderkey", "name", text("cols").alias("cols"))


UNIQUE = """
WITH k AS (SELECT l_orderkey, 'uk_' || l_suppkey % 3 || '_' || l_returnflag AS name, count(*) AS n, string_agg('c' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS cols FROM lineitem GROUP BY 1, 2),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n, name) AS rn FROM k) WHERE rn = 1)
"""


def key_choice(spark, sf_dir):
    o = ["l_orderkey"]
    li = _lines(spark, sf_dir).withColumn("col", F.concat(F.lit("c"), s("l_partkey"))).withColumn("pos", F.struct("l_linenumber", "l_partkey"))
    every = MD.ordered_names(li, o, "col", "pos", "all_columns")
    pk = MD.ordered_names(li.where("l_orderkey % 4 = 0 AND l_linenumber <= 2"), o, "col", "pos", "pk")
    uk = MD.smallest_key(_candidate_keys(spark, sf_dir).where("l_orderkey % 4 = 1"), o, "cols", "name").select("l_orderkey", F.col("cols").alias("uk"))
    ui = MD.ordered_names(li.where("l_orderkey % 4 = 2 AND l_linestatus = 'F'"), o, "col", "pos", "ui")
    return MD.choose_keys(every, pk, uk, ui, o).select("l_orderkey", "key_type", text("key_columns").alias("key_columns"))


def flow_grouping(spark, sf_dir):
    return MD.group_flows(table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("_", "p_name", s("p_partkey")).alias("src_table")), "src_table", 30)


def key_conflicts(spark, sf_dir):
    li = _lines(spark, sf_dir)
    keys = li.groupBy("l_orderkey", (F.col("l_suppkey") % 2).alias("schema_no")).agg(F.collect_set(F.col("l_linenumber")).alias("cols"))
    return MD.key_conflicts(keys, "l_orderkey", "cols").select("l_orderkey", F.size("sets").cast("long").alias("n_sets"))


def _flow_specs(spark, sf_dir):
    """Specs built from customers, which break one rule or another."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    some = lambda cond, v: F.when(cond, F.array(F.lit(v))).otherwise(F.array().cast("array<string>"))
    twin = (k - F.when(k % 50 == 1, 1).otherwise(0)).cast("string")
    app, src = F.concat(F.lit("app"), (k % 9).cast("string")), F.concat(F.lit("t$"), twin)
    return c.select(
        F.concat_ws("_", app, F.when(k % 13 == 0, "other").otherwise(src)).alias("flow_id"), app.alias("app"), src.alias("src_table"),
        F.concat(F.when(k % 17 == 0, "T$").otherwise("T__DOL"), twin).alias("target_table"), F.concat(F.lit("/t/"), F.when(k % 40 == 0, "x").otherwise(s("c_custkey"))).alias("target_path"),
        some(k % 7 != 0, "k").alias("key_columns"), some(k % 11 != 0, "p").alias("partition_columns"), F.when(k % 19 == 0, F.array(F.lit("db.s"), F.lit("schema"))).otherwise(F.array(F.lit("db.s"))).alias("inactive"),
    )


def spec_violations(spark, sf_dir):
    return MD.spec_violations(_flow_specs(spark, sf_dir))


def app_violations(spark, sf_dir):
    """Apps built from nations: not every database is known, and not every app has topics or flows."""
    n = F.col("n_nationkey")
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("Oracle ", "postgres", "mysql", "sqlserver", "db2")]), (n % 5 + 1).cast("int"))
    apps = table(spark, sf_dir, "nation").select(F.concat(F.lit("app"), s("n_nationkey")).alias("app"), kinds.alias("src_db_type"), F.when(n % 4 != 0, F.array(F.lit("topic"))).otherwise(F.array().cast("array<string>")).alias("cdc_topics"))
    return MD.app_violations(apps, _flow_specs(spark, sf_dir))


def load_violations(spark, sf_dir):
    """Initial-load specs built from suppliers."""
    k = F.col("s_suppkey")
    return MD.load_violations(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("table_name"), F.when(k % 3 == 0, "Delta").when(k % 3 == 1, "dms ").when(k % 6 == 2, "csv").alias("load_type")))


def schema_id_assignment(spark, sf_dir):
    """New schemas get an id, known ones keep theirs."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("db"), (F.col("c_custkey") % 7).cast("string")).alias("src_db"), F.concat(F.lit("n"), s("c_nationkey")).alias("src_schema"))
    known = table(spark, sf_dir, "nation").select(F.concat(F.lit("db"), (F.col("n_nationkey") % 7).cast("string")).alias("src_db"), F.concat(F.lit("n"), s("n_nationkey")).alias("src_schema"), F.concat(F.lit("old"), s("n_nationkey")).alias("schema_id"))
    return MD.assign_ids(c, known, ["src_db", "src_schema"], F.md5(F.concat_ws(".", "src_db", "src_schema").cast("binary")))


def init_load_specs(spark, sf_dir):
    """Schemas by flows, inserted where absent: nations by the brands of all parts."""
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("schema_id"))
    f = table(spark, sf_dir, "part").select(F.col("p_brand").alias("flow_id")).distinct()
    every = MD.control_product(n, f).withColumn("status", F.lit("new"))
    done = table(spark, sf_dir, "supplier").select(F.concat(F.lit("NATION_"), s("s_nationkey")).alias("schema_id"), F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 30).cast("string")).alias("flow_id"), F.lit("done").alias("status")).distinct()
    return M.insert_missing(done, every, ["schema_id", "flow_id"]).groupBy("schema_id", "status").agg(F.count("*").alias("n"))


_TYPES = ("tinyint", "smallint", "int", "bigint", "double", "decimal(12,2)", "decimal(20,4)", "date", "timestamp")


def _versions(spark, sf_dir):
    """Schema versions of an order's flow: a supplier remainder is a version, a part remainder a column."""
    li = _lines(spark, sf_dir)
    kind = F.element_at(F.array(*[F.lit(t) for t in _TYPES[:5]]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    rows = li.select(F.concat(F.lit("f"), (F.col("l_orderkey") % 500).cast("string")).alias("flow_id"), (F.col("l_suppkey") % 4).cast("int").alias("version"), F.concat(F.lit("c"), (F.col("l_partkey") % 8).cast("string")).alias("column"), kind.alias("type"), (F.col("l_suppkey") % 5).alias("rank"))
    one = rows.groupBy("flow_id", "version", "column").agg(F.max_by("type", "rank").alias("type"))
    return one.withColumn("position", F.substring("column", 2, 2).cast("int"))


WIDEST = """
WITH r AS (SELECT 'f' || l_orderkey % 500 AS flow_id, l_suppkey % 4 AS version, 'c' || l_partkey % 8 AS col, max(l_suppkey % 5) AS rank FROM lineitem GROUP BY 1, 2, 3),
w AS (SELECT flow_id, col, max(rank) AS rank, min(version) AS v0 FROM r GROUP BY 1, 2),
t AS (SELECT *, CASE rank WHEN 0 THEN 'tinyint' WHEN 1 THEN 'smallint' WHEN 2 THEN 'int' WHEN 3 THEN 'bigint' ELSE 'double' END AS type FROM w)
"""


def schema_merge_columns(spark, sf_dir):
    m = E.fold_versions(_versions(spark, sf_dir), nested=False)
    return m.select("flow_id", "column", "type", "failed")


def schema_merge_order(spark, sf_dir):
    """Merged column order: the first version's columns, then new ones as they come."""
    m = E.fold_versions(_versions(spark, sf_dir), nested=False)
    return E.ddl(m, ["flow_id"])


def schema_merge_conflicts(spark, sf_dir):
    """Flows whose versions disagree beyond widening: the last version turns column c1 into text."""
    v = _versions(spark, sf_dir).withColumn("type", F.when((F.col("version") == 3) & (F.col("column") == "c1"), "string").otherwise(F.col("type")))
    return E.fold_versions(v, nested=False).groupBy("flow_id").agg(F.max("failed").alias("failed"))


def _two_states(spark, sf_dir):
    v = _versions(spark, sf_dir)
    return E.fold_versions(v.where("version < 2"), nested=False), E.fold_versions(v.where("version <> 1"), nested=False)


def schema_classify(spark, sf_dir):
    """Change class of every flow between its spec and the merge with newer versions."""
    v = _versions(spark, sf_dir)
    spec = v.where("version < 2")
    old = E.fold_versions(spec, nested=False)
    new = E.fold_versions(v, nested=False)
    shape = lambda d, keep: E.ddl(d, ["flow_id"]).join(d.groupBy("flow_id").agg(F.max("overwrite").alias("overwrite")), "flow_id").join(keep.groupBy("flow_id").agg(F.collect_set("version").alias("fingerprints")), "flow_id")
    return E.classify(shape(old, spec), shape(new, v))


def schema_classify_failure(spark, sf_dir):
    """Change classes where the last version of some flows turns column c1 into text: those fail, each for itself."""
    v = _versions(spark, sf_dir).withColumn("fingerprint", F.col("version").cast("long"))
    v = v.withColumn("type", F.when((F.col("version") == 3) & (F.col("column") == "c1"), "string").otherwise(F.col("type")))
    merged = E.fold_flows(v, nested=False)
    return E.classify(E.fold_flows(v.where("version < 2"), nested=False), merged).join(merged, "flow_id").select("flow_id", "change", F.coalesce(F.size("fingerprints"), F.lit(0)).alias("n_fingerprints"), "error")


def schema_merge_nested(spark, sf_dir):
    """Versions whose columns are fields of a struct in a struct: fields merge one by one and new ones are appended."""
    v = _versions(spark, sf_dir)
    fields = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.concat_ws(":", "column", "type").alias("t")))), lambda x: x["t"]), ",")
    one = v.groupBy("flow_id", "version").agg(F.concat(F.lit("struct<inner:struct<"), fields, F.lit(">,tag:string>")).alias("type"))
    m = E.fold_versions(one.select("flow_id", "version", F.lit(0).alias("position"), F.lit("image").alias("column"), "type"))
    return m.select("flow_id", "column", "type", "failed")


def schema_merge_report(spark, sf_dir):
    """New, missing and merged fields of every version after a flow's first; columns from c4 on are fields of a struct."""
    v = _versions(spark, sf_dir)
    plain = v.where("position < 4").select("flow_id", "version", "position", "column", "type")
    fields = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.concat_ws(":", "column", "type").alias("t")))), lambda x: x["t"]), ",")
    struct = v.where("position >= 4").groupBy("flow_id", "version").agg(F.concat(F.lit("struct<"), fields, F.lit(">")).alias("type"))
    r = E.merge_report(plain.unionByName(struct.select("flow_id", "version", F.lit(9).alias("position"), F.lit("s").alias("column"), "type")))
    return r.select("flow_id", "version", *[F.array_join(c, ",").alias(f"{c}_fields") for c in ("new", "missing", "merged")], "overwrite", "error")


def schema_diff_events(spark, sf_dir):
    before, after = _two_states(spark, sf_dir)
    both = before.select("flow_id").distinct().join(after.select("flow_id").distinct(), "flow_id")
    return E.diff_events(before.join(both, "flow_id", "left_semi"), after.join(both, "flow_id", "left_semi"))


def _schema_texts(spark, sf_dir):
    """Each order's lines make a schema text."""
    li = _lines(spark, sf_dir)
    kinds = F.array(*[F.lit(k) for k in ("int", "long", "double", "string", "bytes")])
    # of a line given several times, the smallest part's: its number alone is kept until then, and the text made of it
    one = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    kind = F.coalesce(F.get(kinds, (F.col("part") % 5).cast("int")), F.lit("bytes"))
    field = F.to_json(F.struct(F.concat(F.lit("C"), s("l_linenumber")).alias("name"), F.array(F.lit("null"), kind).alias("type")))
    one = one.select("l_orderkey", "l_linenumber", field.alias("f"))
    g = one.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "f"))), lambda x: x["f"]), ",").alias("fs"))
    image = F.concat(F.lit('{"type":"record","name":"Row","doc":"an image", "fields":['), F.col("fs"), F.lit("]}"))
    return g.select(s("l_orderkey").alias("key"), F.concat(F.lit('{"type":"record","name":"E","namespace":"a.b","fields":[{"name":"op","type":"string"},{"default":null, "name":"before","type":["null",'), image, F.lit("]}]}")).alias("schema"))


def schema_registry(spark, sf_dir):
    """Column rows parsed from schema texts."""
    return E.registry_columns(_schema_texts(spark, sf_dir)).select("key", "position", "column", "type")


def schema_fingerprint(spark, sf_dir):
    """64-bit fingerprints of the schema texts' parsing canonical form, with the texts and their white space as they are."""
    return E.registry_schemas(_schema_texts(spark, sf_dir)).where("size(columns) > 0").select("key", "fingerprint").distinct()


def schema_registry_numbers(spark, sf_dir):
    """Column rows of schemas whose numbers are written as text: decimals, of at most 38 digits, in lower-case columns."""
    p = table(spark, sf_dir, "part")
    field = F.concat(F.lit('{"name":"P_SIZE","type":{"type":"string","origtype":"number","scale":'), (F.col("p_size") % 7).cast("string"), F.lit('}},{"name":"BIG","type":{"type":"bytes","logicalType":"decimal","precision":'), (F.col("p_size") % 20 + 30).cast("string"), F.lit(',"scale":2}}'))
    schemas = p.select(s("p_partkey").alias("key"), F.concat(F.lit('{"type":"record","name":"E","fields":['), field, F.lit("]}")).alias("schema"))
    return E.registry_columns(schemas, numeric_as_string=True).select("key", "position", "column", "type")


def schema_cast(spark, sf_dir):
    shape = T.StructType.fromDDL("o_orderkey string, o_totalprice decimal(14,2), o_orderdate date, added int, o_custkey bigint")
    return M.cast_to(table(spark, sf_dir, "orders"), shape).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


def missing_names(spark, sf_dir):
    p, q = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    return p.select(F.col("p_partkey").alias("key")).join(q.select((F.col("s_suppkey") * 3).alias("key")), "key", "left_anti")


def union_sources(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return MD.union_sources([n.select(F.col("n_nationkey").alias("ID"), F.col("n_name").alias("NAME"), F.lit("nation").alias("SRC")), r.select("r_regionkey", "r_name", F.lit("region"))])


def latest_snapshot(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("created_at", F.to_date("ts"))
    return MD.latest_snapshot(e).select("event_id", "created_at")


def array_set_union(spark, sf_dir):
    li = _lines(spark, sf_dir)
    g = li.groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_returnflag") == "A", F.col("l_suppkey"))).alias("a"), F.collect_set(F.when(F.col("l_linestatus") == "F", F.col("l_suppkey"))).alias("b"))
    return g.select("l_orderkey", text(F.transform(F.array_sort(F.array_distinct(F.concat("a", "b"))), lambda x: x.cast("string"))).alias("u"))


def _merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("new").alias("o_orderpriority"))


def merge_upsert_insert(spark, sf_dir):
    return M.insert_missing(*_merge(spark, sf_dir), ["o_orderkey"])


def merge_upsert_update(spark, sf_dir):
    return M.update_matched(*_merge(spark, sf_dir), ["o_orderkey"], ["o_totalprice"])


def merge_upsert_both(spark, sf_dir):
    return M.upsert(*_merge(spark, sf_dir), ["o_orderkey"], ["o_totalprice"])


def conditional_delete(spark, sf_dir):
    return M.delete_where(table(spark, sf_dir, "orders"), (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 200000)).select("o_orderkey", "o_orderstatus")


def append_evolving(spark, sf_dir):
    """Appended rows bring a column that the table lacks, and lack one that it has."""
    c = table(spark, sf_dir, "customer")
    out = M.append_evolving(c.where("c_custkey % 2 = 0").select("c_custkey", "c_name"), c.where("c_custkey % 2 = 1").select("c_custkey", "c_mktsegment"))
    return out.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count("c_name").alias("n_names"))


def compaction(spark, sf_dir):
    """Clustered rewrite through the shared folder."""
    path = storage.fresh_dir(spark, "compaction")
    li = _lines(spark, sf_dir).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    M.compact(li, ["l_partkey", "l_orderkey"], 8).write.parquet(path)
    return spark.read.schema(li.schema).parquet(path)


def duplicate_id_check(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("id", F.floor(F.col("c_acctbal")).cast("long"))
    return c.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def stable_names(spark, sf_dir):
    """Names by schema id: an inner join that may lose no row."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return MD.conserved_join(c, table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), ["n_nationkey"]).select("c_custkey", "n_name")


def new_schema_onboarding(spark, sf_dir):
    """Schemas seen in the feed that have no spec row."""
    seen = table(spark, sf_dir, "customer").select(s("c_nationkey").alias("schema"))
    specs = table(spark, sf_dir, "supplier").where("s_suppkey < 15").select(s("s_nationkey").alias("schema"))
    return E.onboard(seen, specs, ["schema"], F.concat(F.lit("id"), F.col("schema")))


SPECS = """
WITH f AS (SELECT c_custkey AS k, 'app' || c_custkey % 9 AS app, 'app' || c_custkey % 9 || '_' || CASE WHEN c_custkey % 13 = 0 THEN 'other' ELSE 't$' || (c_custkey - CASE WHEN c_custkey % 50 = 1 THEN 1 ELSE 0 END) END AS flow_id,
  '/t/' || CASE WHEN c_custkey % 40 = 0 THEN 'x' ELSE CAST(c_custkey AS VARCHAR) END AS path FROM customer)"""

QUERIES = [
    (ordered_key_columns, "SELECT l_orderkey, string_agg('c' || l_partkey, ',' ORDER BY l_linenumber, 'c' || l_partkey) AS names FROM lineitem GROUP BY l_orderkey"),
    (type_mapping, CATALOG + "SELECT data_type, delta_type, count(*) AS n FROM m GROUP BY ALL"),
    (lob_flags, CATALOG + "SELECT data_type, is_lob, count(*) AS n, max(data_length) AS max_length FROM m GROUP BY ALL"),
    (table_ddl, CATALOG + "SELECT table_name, owner, string_agg(column_name || ' ' || delta_type, ',' ORDER BY column_id, column_name, delta_type) AS ddl FROM m GROUP BY ALL"),
    (lob_columns, CATALOG + "SELECT table_name, string_agg(DISTINCT column_name, ',' ORDER BY column_name) AS lob_columns FROM m WHERE is_lob GROUP BY ALL"),
    (smallest_unique_key, UNIQUE + "SELECT l_orderkey, name, cols FROM u"),
    (key_choice, UNIQUE + """,
l AS (SELECT l_orderkey, string_agg('c' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS every,
  string_agg('c' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) FILTER (WHERE l_orderkey % 4 = 0 AND l_linenumber <= 2) AS pk,
  string_agg('c' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) FILTER (WHERE l_orderkey % 4 = 2 AND l_linestatus = 'F') AS ui FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, CASE WHEN pk IS NOT NULL THEN 'PRIMARY_KEY' WHEN l.l_orderkey % 4 = 1 THEN 'UNIQUE_KEY' WHEN ui IS NOT NULL THEN 'UNIQUE_INDEX' ELSE 'ALL_COLUMNS' END AS key_type,
  coalesce(pk, CASE WHEN l.l_orderkey % 4 = 1 THEN cols END, ui, every) AS key_columns FROM l JOIN u ON l.l_orderkey = u.l_orderkey"""),
    (flow_grouping, "SELECT p_partkey, p_name || '_' || p_partkey AS src_table, CAST(ceil(row_number() OVER (ORDER BY p_name || '_' || p_partkey) / 30.0) AS BIGINT) AS group_number FROM part"),
    (key_conflicts, "WITH k AS (SELECT l_orderkey, l_suppkey % 2 AS sn, list_sort(list(DISTINCT l_linenumber)) AS c FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, count(DISTINCT c) AS n_sets FROM k GROUP BY 1 HAVING count(DISTINCT c) > 1"),
    (spec_violations, SPECS + """
SELECT flow_id, 'id_mismatch' AS rule FROM f WHERE k % 13 = 0 UNION ALL SELECT flow_id, 'target_mismatch' FROM f WHERE k % 17 = 0 UNION ALL SELECT flow_id, 'no_key' FROM f WHERE k % 7 = 0
UNION ALL SELECT flow_id, 'no_partition' FROM f WHERE k % 11 = 0 UNION ALL SELECT flow_id, 'schema_format' FROM f WHERE k % 19 = 0
UNION ALL SELECT flow_id, 'duplicate_id' FROM f GROUP BY flow_id HAVING count(*) > 1 UNION ALL SELECT path, 'duplicate_path' FROM f GROUP BY path HAVING count(*) > 1"""),
    (app_violations, SPECS + """, a AS (SELECT n_nationkey AS n, 'app' || n_nationkey AS app FROM nation)
SELECT app, 'database' AS rule FROM a WHERE n % 5 = 4 UNION ALL SELECT app, 'no_topics' FROM a WHERE n % 4 = 0 UNION ALL SELECT app, 'no_flows' FROM a WHERE app NOT IN (SELECT app FROM f)"""),
    (load_violations, "SELECT s_name AS table_name, 'load_type' AS rule FROM supplier WHERE s_suppkey % 3 = 2"),
    (schema_id_assignment, """WITH c AS (SELECT DISTINCT 'db' || c_custkey % 7 AS src_db, 'n' || c_nationkey AS src_schema FROM customer), n AS (SELECT 'db' || n_nationkey % 7 AS src_db, 'n' || n_nationkey AS src_schema, 'old' || n_nationkey AS schema_id FROM nation)
SELECT * FROM n UNION ALL SELECT src_db, src_schema, md5(src_db || '.' || src_schema) FROM c WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.src_db = c.src_db AND n.src_schema = c.src_schema)"""),
    (init_load_specs, """WITH d AS (SELECT DISTINCT 'NATION_' || s_nationkey AS schema_id, 'Brand#' || s_suppkey % 30 AS flow_id FROM supplier), e AS (SELECT n_name AS schema_id, flow_id FROM nation, (SELECT DISTINCT p_brand AS flow_id FROM part)),
a AS (SELECT schema_id, 'done' AS status FROM d UNION ALL SELECT e.schema_id, 'new' FROM e LEFT JOIN d ON e.schema_id = d.schema_id AND e.flow_id = d.flow_id WHERE d.flow_id IS NULL) SELECT schema_id, status, count(*) AS n FROM a GROUP BY ALL"""),
    (schema_merge_columns, WIDEST + "SELECT flow_id, col AS \"column\", type, FALSE AS failed FROM t"),
    (schema_merge_order, WIDEST + "SELECT flow_id, string_agg(col || ' ' || type, ',' ORDER BY v0, CAST(substr(col, 2) AS INTEGER)) AS ddl FROM t GROUP BY flow_id"),
    (schema_merge_conflicts, WIDEST + ", p AS (SELECT flow_id, max(CASE WHEN col = 'c1' AND version < 3 THEN 1 ELSE 0 END) AS a, max(CASE WHEN col = 'c1' AND version = 3 THEN 1 ELSE 0 END) AS z FROM r GROUP BY flow_id) SELECT flow_id, a = 1 AND z = 1 AS failed FROM p"),
    (schema_classify, WIDEST + """,
e AS (SELECT *, max(rank) OVER (PARTITION BY flow_id, col ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM r),
o AS (SELECT flow_id, bool_or(prev IS NOT NULL AND rank > prev) AS overwrite, bool_or(version >= 2) AS newer, bool_or(version >= 2 AND (prev IS NULL OR rank > prev)) AS changed, bool_or(version < 2) AS had FROM e GROUP BY 1)
SELECT flow_id, CASE WHEN NOT changed AND NOT newer THEN 'SAME' WHEN NOT changed OR NOT overwrite THEN 'FLOW_RESTART_ONLY' ELSE 'FLOW_RESTART_AND_OVERWRITE' END AS change FROM o WHERE had"""),
    (schema_classify_failure, WIDEST + """,
e AS (SELECT *, max(rank) OVER (PARTITION BY flow_id, col ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM r),
o AS (SELECT flow_id, bool_or(prev IS NOT NULL AND rank > prev) AS overwrite, bool_or(version >= 2) AS newer, bool_or(version >= 2 AND (prev IS NULL OR rank > prev OR (version = 3 AND col = 'c1'))) AS changed, bool_or(version < 2) AS had,
  bool_or(version = 3 AND col = 'c1') AND bool_or(version < 3 AND col = 'c1') AS failed, count(DISTINCT version) AS n FROM e GROUP BY 1)
SELECT flow_id, CASE WHEN failed THEN 'FAILURE' WHEN NOT changed AND NOT newer THEN 'SAME' WHEN NOT changed OR NOT overwrite THEN 'FLOW_RESTART_ONLY' ELSE 'FLOW_RESTART_AND_OVERWRITE' END AS change,
  CAST(CASE WHEN failed THEN 0 ELSE n END AS INTEGER) AS n_fingerprints, CASE WHEN failed THEN 'no common type for c1 in version 3' END AS error FROM o WHERE had"""),
    (schema_merge_nested, WIDEST + """SELECT flow_id, 'image' AS "column", 'struct<inner:struct<' || string_agg(col || ':' || type, ',' ORDER BY v0, CAST(substr(col, 2) AS INTEGER)) || '>,tag:string>' AS type, FALSE AS failed FROM t GROUP BY flow_id"""),
    (schema_merge_report, WIDEST + """,
p AS (SELECT flow_id, version, CASE WHEN col < 'c4' THEN col ELSE 's.' || col END AS path, CASE WHEN col >= 'c4' THEN 's' END AS parent, rank FROM r
  UNION ALL SELECT DISTINCT flow_id, version, 's', NULL, CAST(-1 AS BIGINT) FROM r WHERE col >= 'c4'),
v AS (SELECT DISTINCT flow_id, version, min(version) OVER (PARTITION BY flow_id) AS v0 FROM r),
g AS (SELECT flow_id, path, any_value(parent) AS parent, min(version) AS since FROM p GROUP BY 1, 2),
x AS (SELECT v.flow_id, v.version, v0, g.path, g.parent, g.since, p.rank, p.version IS NOT NULL AS here,
        max(p.rank) OVER (PARTITION BY v.flow_id, g.path ORDER BY v.version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM v JOIN g USING (flow_id) LEFT JOIN p ON p.flow_id = v.flow_id AND p.version = v.version AND p.path = g.path),
y AS (SELECT *, since = version AND version > v0 AS fresh, since < version AND NOT here AS gone FROM x),
z AS (SELECT y.*, coalesce(q.fresh OR q.gone, FALSE) AS covered FROM y LEFT JOIN y q ON q.flow_id = y.flow_id AND q.version = y.version AND q.path = y.parent),
n AS (SELECT *, list_value('tinyint', 'smallint', 'int', 'bigint', 'double') AS names FROM z WHERE version > v0),
o AS (SELECT flow_id, version, coalesce(string_agg(path, ',' ORDER BY path) FILTER (WHERE fresh AND NOT covered), '') AS new_fields, coalesce(string_agg(path, ',' ORDER BY path) FILTER (WHERE gone AND NOT covered), '') AS missing_fields,
  coalesce(string_agg(path || ': ' || names[before + 1] || ' > ' || names[rank + 1] || ' = ' || names[greatest(before, rank) + 1], ',' ORDER BY path) FILTER (WHERE here AND since < version AND rank >= 0 AND rank <> before), '') AS merged_fields FROM n GROUP BY 1, 2)
SELECT *, NOT (new_fields <> '' AND merged_fields = '') AS overwrite, CAST(NULL AS VARCHAR) AS error FROM o"""),
    (schema_fingerprint, """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem),
f AS (SELECT l_orderkey, string_agg('{"name":"C' || l_linenumber || '","type":["null","' || CASE l_partkey % 5 WHEN 0 THEN 'int' WHEN 1 THEN 'long' WHEN 2 THEN 'double' WHEN 3 THEN 'string' ELSE 'bytes' END || '"]}', ',' ORDER BY l_linenumber) AS fs FROM o WHERE rn = 1 GROUP BY 1),
c AS (SELECT l_orderkey, '{"name":"a.b.E","type":"record","fields":[{"name":"op","type":"string"},{"name":"before","type":["null",{"name":"a.b.Row","type":"record","fields":[' || fs || ']}]}]}' AS form FROM f),
k AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, x: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 13933329357911598997::UBIGINT ELSE 0::UBIGINT END), i::UBIGINT)) AS t),
p AS (SELECT l_orderkey, list_reduce(list_transform(string_split(form, ''), lambda x: ascii(x)::UBIGINT), lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1]), 13933329357911598997::UBIGINT) AS h FROM c, k)
SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(CASE WHEN h >= 9223372036854775808 THEN h::HUGEINT - 18446744073709551616 ELSE h::HUGEINT END AS BIGINT) AS fingerprint FROM p"""),
    (schema_registry_numbers, """SELECT CAST(p_partkey AS VARCHAR) AS key, 0 AS position, 'p_size' AS "column", 'decimal(38,' || p_size % 7 || ')' AS type FROM part
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 1, 'big', 'decimal(' || least(p_size % 20 + 30, 38) || ',2)' FROM part"""),
    (schema_diff_events, """
WITH r AS (SELECT 'f' || l_orderkey % 500 AS flow_id, l_suppkey % 4 AS version, 'c' || l_partkey % 8 AS col, max(l_suppkey % 5) AS rank FROM lineitem GROUP BY 1, 2, 3),
b AS (SELECT flow_id, col, max(rank) AS rank FROM r WHERE version < 2 GROUP BY 1, 2), a AS (SELECT flow_id, col, max(rank) AS rank FROM r WHERE version <> 1 GROUP BY 1, 2),
f AS (SELECT flow_id FROM b INTERSECT SELECT flow_id FROM a),
d AS (SELECT coalesce(a.flow_id, b.flow_id) AS flow_id, coalesce(a.col, b.col) AS "column", a.rank AS x, b.rank AS y FROM b FULL JOIN a ON a.flow_id = b.flow_id AND a.col = b.col),
e AS (SELECT *, CASE WHEN y IS NULL THEN 'ADD_COLUMN' WHEN x IS NULL THEN 'DROP_COLUMN' WHEN x <> y THEN 'MODIFY_COLUMN' END AS event FROM d WHERE flow_id IN (SELECT flow_id FROM f))
SELECT flow_id, "column", event, CASE event WHEN 'DROP_COLUMN' THEN 'IGNORED' ELSE 'PROCESSED' END AS status FROM e WHERE event IS NOT NULL"""),
    (schema_registry, """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INTEGER) AS position, 'c' || l_linenumber AS "column",
  CASE l_partkey % 5 WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' WHEN 2 THEN 'double' WHEN 3 THEN 'string' ELSE 'binary' END AS type FROM o WHERE rn = 1"""),
    (schema_cast, "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(NULL AS INTEGER) AS added, o_custkey FROM orders"),
    (missing_names, "SELECT p_partkey AS key FROM part WHERE p_partkey NOT IN (SELECT s_suppkey * 3 FROM supplier)"),
    (union_sources, "SELECT n_nationkey AS id, n_name AS name, 'nation' AS src FROM nation UNION ALL SELECT r_regionkey, r_name, 'region' FROM region"),
    (latest_snapshot, "SELECT event_id, CAST(ts AS DATE) AS created_at FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"),
    (array_set_union, "SELECT l_orderkey, coalesce(array_to_string(list_sort(list(DISTINCT l_suppkey) FILTER (WHERE l_returnflag = 'A' OR l_linestatus = 'F')), ','), '') AS u FROM lineitem GROUP BY l_orderkey"),
    (merge_upsert_insert, "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, o_totalprice + 1, 'new' FROM orders WHERE o_orderkey % 6 = 0"),
    (merge_upsert_update, "SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0"),
    (merge_upsert_both, "SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, o_totalprice + 1, 'new' FROM orders WHERE o_orderkey % 6 = 0"),
    (conditional_delete, "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 200000)"),
    (append_evolving, "SELECT CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_custkey % 2 = 0) AS n_names FROM customer GROUP BY 1"),
    (compaction, "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem"),
    (duplicate_id_check, "SELECT CAST(floor(c_acctbal) AS BIGINT) AS id, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1"),
    (stable_names, "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    (new_schema_onboarding, "SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS schema, 'id' || c_nationkey AS schema_id FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey < 15)"),
]
