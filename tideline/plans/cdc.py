"""Queries of the change-data core. Each entry: name, Spark query, SQL of the same result (None: not expressible)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import storage
from tideline.functions.images import repair_unchanged, typed_image
from tideline.functions.keys import decode_csn, sequencer, surrogate_key
from tideline.functions.messages import meta_map, normalized_key, path_fingerprint, path_key, registry_path, table_of, with_active_flag, with_schema_id
from tideline.operators import changes as C
from tideline.plans.feeds import IMAGE, SQL_A, SQL_B, event_feed, table, tenant_feed
from tideline.sources.readers import table_stream
from tideline.streaming.apply import BatchLedger, ChangePieces, fork_batches, replay_from, start_apply

KEYS = ["key", "__schema_id"]


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_feed(table(spark, sf_dir, "events"))


def changes(a: DataFrame) -> DataFrame:
    """Feed A typed, split at key changes and sequenced."""
    t = a.withColumn("before", typed_image("before", IMAGE, "oracle")).withColumn("after", typed_image("after", IMAGE, "oracle"))
    s = C.split_key_changes(t, key="key")
    return s.select(F.col("image.key").alias("key"), F.col("schema_id").alias("__schema_id"), F.col("image.amount").alias("amount"), F.col("image.note").alias("note"), "op_type", "event_id", "ts", "is_pk_change", sequencer("csn", "pos", F.col("is_pk_change")).alias("__cdc_sequencer"))


def applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.apply_changes(changes(feed(spark, sf_dir)), KEYS, "__cdc_sequencer")


def flat(df: DataFrame) -> DataFrame:
    return df.select("key", F.col("__schema_id").alias("schema_id"), "amount", "note", "event_id", F.col("__cdc_sequencer.csn").cast("long").alias("csn"), F.col("__cdc_sequencer.is_pk_change").alias("pk_rank"))


LATEST = SQL_A + """
r AS (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s)
SELECT key, schema_id, amount, note, event_id, csn, CAST(pk_rank AS BIGINT) AS pk_rank FROM r WHERE rn = 1 AND op <> 'D'"""


def cdc_apply_latest(spark, sf_dir):
    return flat(C.current_state(applied(spark, sf_dir)))


def cdc_apply_out_of_order(spark, sf_dir):
    """Late halves first: the second half of the feed is applied, then the first half against that table."""
    c = changes(feed(spark, sf_dir))
    late = C.apply_changes(c.where("event_id % 2 = 1"), KEYS, "__cdc_sequencer")
    return flat(C.current_state(C.apply_changes(c.where("event_id % 2 = 0"), KEYS, "__cdc_sequencer", late)))


def cdc_apply_tombstones(spark, sf_dir):
    dead = applied(spark, sf_dir).where("__DeleteVersion IS NOT NULL")
    return dead.select("key", F.col("__schema_id").alias("schema_id"), F.col("__DeleteVersion.csn").cast("long").alias("csn"), F.col("__DeleteVersion.pos").cast("long").alias("pos"))


def cdc_tombstone_gc(spark, sf_dir):
    """Tombstones older than five days at the feed's end are collected."""
    t = applied(spark, sf_dir)
    now = table(spark, sf_dir, "events").agg(F.max("ts").alias("now"))
    kept = C.collect_tombstones(t.crossJoin(F.broadcast(now)), F.col("ts"), F.col("now"))  # one row
    return kept.groupBy(F.col("__schema_id").alias("schema_id")).agg(F.count("*").alias("n_rows"), F.count("__DeleteVersion").alias("n_tombstones"))


def cdc_apply_by_tenant(spark, sf_dir):
    b = tenant_feed(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    b = b.withColumn("seq", F.struct("op_ts", "pos"))
    return C.current_state(C.apply_changes(b, ["key", "schema_id"], "seq")).select("key", "schema_id", "op_ts", "pos", "amount")


def cdc_pk_change_split(spark, sf_dir):
    c = changes(feed(spark, sf_dir))
    return c.select("event_id", "key", F.col("op_type").alias("op"), F.col("is_pk_change").alias("is_pk"), F.col("__cdc_sequencer.is_pk_change").alias("pk_rank"), "note")


def cdc_surrogate_key(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("part", F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey"))).withColumn("quantity", F.col("l_quantity").cast("decimal(10,2)"))
    return li.select("l_orderkey", "l_linenumber", "part", surrogate_key(li.schema, ["l_orderkey", "l_linenumber", "part", "quantity"]).alias("sk"))


def cdc_sequencer(spark, sf_dir):
    a = feed(spark, sf_dir).withColumn("seq", sequencer("csn", "pos", F.col("k") % 10 == 0))
    return a.select("event_id", F.col("seq.csn").cast("long").alias("csn"), F.col("seq.pos").cast("long").alias("pos"), F.col("seq.is_pk_change").alias("pk_rank"))


def _csn(text, database):
    def query(spark, sf_dir):
        e = table(spark, sf_dir, "events").where("event_id > 0").withColumn("written", text())
        return e.select("event_id", "written", decode_csn("written", database).cast("string").alias("csn"))

    return query


def _pad(c, n, char="0"):
    return F.lpad(c, n, char)


UUID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"
oracle_text = lambda: F.col("event_id").cast("string")
postgres_text = lambda: F.concat_ws("/", _pad(F.hex(F.col("event_id") % 1000), 8), _pad(F.hex("event_id"), 8))
mysql_text = lambda: F.when(F.col("event_id") % 2 == 0, F.concat_ws(":", _pad(F.col("event_id").cast("string"), 21), _pad((F.col("event_id") * 7).cast("string"), 15))).otherwise(F.concat_ws(":", _pad(F.col("event_id").cast("string"), 20), F.lit(UUID), _pad((F.col("event_id") * 11).cast("string"), 19)))
_half = lambda: F.lower(F.concat_ws(":", _pad(F.hex(F.col("event_id") * 5), 8), _pad(F.hex(F.col("event_id") * 3), 8), _pad(F.hex(F.col("event_id") % 60000), 4)))
sqlserver_text = lambda: F.concat(_half(), _half())


def cdc_typed_images(spark, sf_dir):
    a = feed(spark, sf_dir)
    shape = T.StructType.fromDDL("key bigint, amount decimal(12,2), note string")
    t = a.select("event_id", typed_image("before", shape, "postgres").alias("b"), typed_image("after", shape, "postgres").alias("x"))
    return t.select("event_id", F.col("b.key").alias("before_key"), F.col("x.key").alias("after_key"), F.col("x.amount").cast("double").alias("after_amount"), F.col("x.note").alias("after_note"))


def cdc_typed_times(spark, sf_dir):
    """Epoch texts with microseconds, and dates as a source may write them, to timestamps without a zone."""
    o = table(spark, sf_dir, "orders").where("o_orderdate IS NOT NULL")
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 1_000_000
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise((micros.cast("decimal(38,6)") / 1_000_000).cast("decimal(20,6)").cast("string"))
    image = F.to_json(F.struct(text.alias("at")))
    typed = typed_image(image, T.StructType.fromDDL("at timestamp_ntz"), "mysql")
    return o.select("o_orderkey", typed["at"].alias("at"))


def cdc_marker_repair(spark, sf_dir):
    a = feed(spark, sf_dir).where("op_type = 'U'")
    fixed = F.from_json(repair_unchanged("before", "after"), "map<string,string>")
    return a.select("event_id", fixed["note"].alias("note"))


def cdc_lob_carry_forward(spark, sf_dir):
    a = feed(spark, sf_dir).where("op_type <> 'D'")
    note = F.get_json_object("after", "$.note")
    c = a.select("event_id", "user_id", "schema_id", F.struct("csn", "pos").alias("seq"), F.when(note != "unchanged-toast-datum", note).alias("note"))
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.concat(F.lit("s"), (F.col("c_custkey") % 4).cast("string")).alias("schema_id"), F.col("c_name").alias("note"))
    return C.carry_forward(c, ["user_id", "schema_id"], "seq", ["note"], base).select("event_id", "note")


def cdc_carry_forward_hot_keys(spark, sf_dir):
    """Four keys hold all changes, deletes among them, over which nothing is carried."""
    a = feed(spark, sf_dir)
    note = F.get_json_object("after", "$.note")
    c = a.select("event_id", "schema_id", "op_type", F.struct("csn", "pos").alias("seq"), F.when(note != "unchanged-toast-datum", note).alias("note"))
    return C.carry_forward(c, ["schema_id"], "seq", ["note"], reset=F.col("op_type") == "D").select("event_id", "note")


def stream_carry_forward(spark, sf_dir):
    """Large values carried forward by the apply stream over several batches of a changing table, deletes between them."""
    root = storage.fresh_dir(spark, "stream-carry")
    events = table(spark, sf_dir, "events")
    week = F.when(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"), 0).when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), 1).otherwise(2)
    target = ChangePieces(spark, f"{root}/table", KEYS, "__cdc_sequencer")
    for part in range(3):  # a week's files, however many, are the next run's one batch
        events.where(week == part).repartition("event_id").write.mode("append").parquet(f"{root}/events")
        c = changes(event_feed(table_stream(spark, f"{root}/events", events.schema, {"maxFilesPerTrigger": str(2**31 - 1)})))
        c = c.withColumn("note", F.when(F.col("note") != "unchanged-toast-datum", F.col("note")))
        start_apply(c, target, f"{root}/checkpoint", carry=["note"], reset=F.col("op_type") == "D", compact_after=2).awaitTermination()
    return flat(C.current_state(target.read()))


def cdc_lob_retry(spark, sf_dir):
    """Updates without their large value go to the retry side once."""
    a = feed(spark, sf_dir).select("schema_id", "op_type", F.get_json_object("after", "$.note").alias("note"), F.when(F.col("k") % 3 == 0, 1).alias("retries"))
    passed, retry = C.split_retries(a, ["note"])
    return passed.withColumn("side", F.lit("pass")).unionByName(retry.withColumn("side", F.lit("retry"))).groupBy("schema_id", "side").agg(F.count("*").alias("n"))


def cdc_truncate_apply(spark, sf_dir):
    t = C.current_state(applied(spark, sf_dir))
    cut = changes(feed(spark, sf_dir)).where("ts >= timestamp_ntz '2024-01-15 00:00:00' AND __schema_id IN ('s0', 's1')")
    cut = cut.groupBy("__schema_id").agg(F.min("__cdc_sequencer").alias("__cdc_sequencer"))
    return flat(C.apply_truncates(t, cut, ["__schema_id"], "__cdc_sequencer"))


def cdc_initial_load_dedup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    key = surrogate_key(li.schema, ["l_orderkey", "l_linenumber"])
    _, report = C.initial_load(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.concat(F.lit("s"), (F.col("l_orderkey") % 5).cast("string")), key, [F.col("l_partkey"), F.col("l_suppkey")])
    return report.select(F.col("__schema_id").alias("schema_id"), "n_rows", "n_keys", "n_duplicates")


def cdc_initial_load_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    key = surrogate_key(li.schema, ["l_orderkey", "l_linenumber"])
    rows, _ = C.initial_load(li, F.lit("s"), key, [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("__sk").alias("sk"))


def _message_keys(events: DataFrame) -> DataFrame:
    u = F.col("user_id")
    name = F.when(F.col("event_id") % 50 == 0, "C##GGS.GG_HEARTBEAT").otherwise(F.concat(F.lit("C##DB"), (u % 3).cast("string"), F.lit(".SCH"), (u % 2).cast("string"), F.lit(".TAB"), (u % 5).cast("string"), F.when(u % 7 == 0, "__DOL").otherwise("")))
    return events.select("event_id", "ts", name.alias("key"))


def bronze_route(spark, sf_dir):
    m = _message_keys(table(spark, sf_dir, "events")).withColumn("key", normalized_key("key"))
    n = table(spark, sf_dir, "nation")
    schemas = n.where("n_nationkey < 6").select(F.concat(F.lit("db"), (F.col("n_nationkey") % 3).cast("string"), F.lit(".sch"), F.floor(F.col("n_nationkey") / 3).cast("string")).alias("db_schema"), F.concat(F.lit("id"), F.col("n_nationkey").cast("string")).alias("schema_id"))
    flows = n.where("n_nationkey < 4").select(F.concat(F.lit("tab"), F.col("n_nationkey").cast("string")).alias("src_table"), F.when(F.col("n_nationkey") == 1, F.array(F.lit("id0"), F.lit("id4"))).alias("inactive"))
    out = with_active_flag(with_schema_id(m, schemas), flows)
    return out.select("event_id", "key", table_of("key").alias("src_table"), "schema_id", "is_active_event")


def registry_paths(spark, sf_dir):
    """Registry paths of the message schemas, and what is parsed back from them."""
    m = _message_keys(table(spark, sf_dir, "events")).where("event_id % 50 <> 0").select(normalized_key("key").alias("key"), (F.col("event_id") % 4 - 2).alias("fp"))
    p = m.withColumn("path", registry_path(F.col("key"), F.col("fp"), "/registry"))
    return p.groupBy("path").agg(F.count("*").alias("n")).select("path", path_key(F.col("path")).alias("key"), path_fingerprint(F.col("path")).alias("fp"), "n")


def bronze_partition_counts(spark, sf_dir):
    a = feed(spark, sf_dir)
    return a.groupBy("schema_id", F.year("ts").alias("year"), F.month("ts").alias("month")).agg(F.count("*").alias("n"))


def fingerprint_gate(spark, sf_dir):
    a = feed(spark, sf_dir)
    known = table(spark, sf_dir, "region").where("r_regionkey < 3").select(F.col("r_regionkey").cast("long").alias("schema_fingerprint"))
    good, bad = C.fingerprint_gate(a, known)
    return good.withColumn("side", F.lit("known")).unionByName(bad.withColumn("side", F.lit("quarantine"))).groupBy("side", "schema_fingerprint").agg(F.count("*").alias("n"))


def meta_map_columns(spark, sf_dir):
    a = feed(spark, sf_dir)
    m = meta_map(op_ts=F.col("ts"), csn=F.col("csn"), pos=F.col("pos"), op_type=F.col("op_type"))
    return a.select("event_id", m["csn"].alias("csn"), m["op_type"].alias("op_type"), F.size(m).cast("long").alias("n"))


def silver_filter(spark, sf_dir):
    """The filter chain before apply: start time, operations, inactive schemas, commit numbers."""
    a = feed(spark, sf_dir)
    kept = a.where((F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")) & F.col("csn").isNotNull() & ~F.col("schema_id").isin("s3") & F.col("op_type").isin("I", "U", "D"))
    return kept.groupBy("schema_id", "op_type").agg(F.count("*").alias("n"), F.max("csn").alias("max_csn"))


def _event_stream(spark, sf_dir):
    return table_stream(spark, f"{sf_dir}/events.parquet", table(spark, sf_dir, "events").schema)


def stream_apply(spark, sf_dir):
    root = storage.fresh_dir(spark, "stream-apply")
    target = ChangePieces(spark, f"{root}/table", KEYS, "__cdc_sequencer")
    start_apply(changes(event_feed(_event_stream(spark, sf_dir))), target, f"{root}/checkpoint").awaitTermination()
    return flat(C.current_state(target.read()))


def stream_ledger(spark, sf_dir):
    """The stream from scratch twice under one ledger, the second run once more: each run has its batches, a resumed one finds them."""
    root = storage.fresh_dir(spark, "stream-ledger")
    target, ledger = ChangePieces(spark, f"{root}/table", KEYS, "__cdc_sequencer"), BatchLedger(spark, f"{root}/ledger", "app", "apply")
    for run in ("first", "second", "second"):
        start_apply(changes(event_feed(_event_stream(spark, sf_dir))), target, f"{root}/{run}", ledger=ledger).awaitTermination()
    done = spark.read.parquet(f"{root}/ledger/rows").agg(F.countDistinct("streaming_query_id").alias("n_runs"), (F.count("*") - F.countDistinct("streaming_query_id", "batch_id")).alias("repeated_batches"))
    return C.current_state(target.read()).agg(F.count("*").alias("n_live")).crossJoin(done)  # one row each


def replay_with_ledger(spark, sf_dir):
    """The apply stream from a start timestamp under a ledger, then from an earlier one under the same ledger, then resumed: the
    replay's batches have the numbers of the first run's, and none may be passed over."""
    root = storage.fresh_dir(spark, "replay-ledger")
    target, ledger = ChangePieces(spark, f"{root}/table", KEYS, "__cdc_sequencer"), BatchLedger(spark, f"{root}/ledger", "app", "apply")
    for start in ("2024-01-20 00:00:00", "2024-01-05 00:00:00", "2024-01-05 00:00:00"):
        replay_from(changes(event_feed(_event_stream(spark, sf_dir))), "ts", start, target, f"{root}/checkpoints", ledger=ledger).awaitTermination()
    return flat(C.current_state(target.read()))


def stream_fork(spark, sf_dir):
    """Bronze fork: active and inactive events in two partitioned tables."""
    root = storage.fresh_dir(spark, "stream-fork")
    a = event_feed(_event_stream(spark, sf_dir)).withColumn("is_active_event", F.col("schema_id") != "s3").withColumn("year", F.year("ts")).withColumn("month", F.month("ts"))
    fork_batches(a, f"{root}/active", f"{root}/inactive", f"{root}/checkpoint", ["schema_id", "year", "month"]).awaitTermination()
    both = [spark.read.parquet(f"{root}/{side}").select("schema_id", F.lit(side).alias("side")) for side in ("active", "inactive")]
    return both[0].unionByName(both[1]).groupBy("side", "schema_id").agg(F.count("*").alias("n"))


def claim_checks(spark, sf_dir):
    """Records that carry a path get the content stored under it."""
    d = table(spark, sf_dir, "documents")
    ref = F.col("doc_id") % 3 == 0
    path = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))
    records = d.select("doc_id", F.when(ref, "__S3_PATH_REF__").otherwise("t").alias("table_name"), F.when(ref, 0).otherwise(1).cast("long").alias("schema_fingerprint"), F.when(ref, path).otherwise("inline").cast("binary").alias("payload"))
    stored = d.where(ref).select(path.alias("path"), F.col("text").cast("binary").alias("content"))
    out = C.resolve_claim_checks(records, stored)
    return out.select("doc_id", F.md5("payload").alias("payload_md5"))


QUERIES = [
    (cdc_apply_latest, LATEST),
    (cdc_apply_out_of_order, LATEST),
    (cdc_apply_tombstones, SQL_A + """
r AS (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s)
SELECT key, schema_id, csn, pos FROM r WHERE rn = 1 AND op = 'D'"""),
    (cdc_tombstone_gc, SQL_A + """
r AS (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s)
SELECT schema_id, count(*) AS n_rows, count(*) FILTER (WHERE op = 'D') AS n_tombstones FROM r
WHERE rn = 1 AND NOT (op = 'D' AND ts < (SELECT max(ts) FROM events) - INTERVAL 432000 SECOND) GROUP BY schema_id"""),
    (cdc_apply_by_tenant, SQL_B + """
r AS (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY op_ts DESC, pos DESC) AS rn FROM f)
SELECT key, schema_id, op_ts, pos, amount FROM r WHERE rn = 1 AND op_type <> 'D'"""),
    (cdc_pk_change_split, SQL_A + "z AS (SELECT 1) SELECT event_id, key, op, is_pk, CAST(pk_rank AS BIGINT) AS pk_rank, note FROM s"),
    (cdc_surrogate_key, """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 10 <> 0 THEN l_partkey END AS part,
  md5(concat_ws('#$%^#', l_orderkey, l_linenumber, coalesce(CAST(CASE WHEN l_partkey % 10 <> 0 THEN l_partkey END AS VARCHAR), '_._--NULL--_._'),
  coalesce(regexp_replace(regexp_replace(CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR), '0+$', ''), '\\.$', ''), '_._--NULL--_._'))) AS sk FROM lineitem"""),
    (cdc_sequencer, SQL_A + "z AS (SELECT 1) SELECT event_id, csn, pos, CAST(CASE WHEN k % 10 = 0 AND op_type = 'I' THEN 1 ELSE 0 END AS BIGINT) AS pk_rank FROM a"),
    ("cdc_decode_csn_oracle", _csn(oracle_text, "oracle"), "SELECT event_id, CAST(event_id AS VARCHAR) AS written, CAST(event_id AS VARCHAR) AS csn FROM events WHERE event_id > 0"),
    ("cdc_decode_csn_postgres", _csn(postgres_text, "postgres"), "SELECT event_id, lpad(printf('%X', event_id % 1000), 8, '0') || '/' || lpad(printf('%X', event_id), 8, '0') AS written, CAST(CAST(event_id % 1000 AS HUGEINT) * 4294967296 + event_id AS VARCHAR) AS csn FROM events WHERE event_id > 0"),
    ("cdc_decode_csn_mysql", _csn(mysql_text, "mysql"), f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN lpad(CAST(event_id AS VARCHAR), 21, '0') || ':' || lpad(CAST(event_id * 7 AS VARCHAR), 15, '0') ELSE lpad(CAST(event_id AS VARCHAR), 20, '0') || ':{UUID}:' || lpad(CAST(event_id * 11 AS VARCHAR), 19, '0') END AS written, CASE WHEN event_id % 2 = 0 THEN CAST(CAST(event_id AS HUGEINT) * 4294967296 + event_id * 7 AS VARCHAR) ELSE CAST(event_id * 11 AS VARCHAR) END AS csn FROM events WHERE event_id > 0"),
    ("cdc_decode_csn_sqlserver", _csn(sqlserver_text, "sqlserver"), "WITH h AS (SELECT event_id, lower(lpad(printf('%X', event_id * 5), 8, '0') || ':' || lpad(printf('%X', event_id * 3), 8, '0') || ':' || lpad(printf('%X', event_id % 60000), 4, '0')) AS t FROM events WHERE event_id > 0) SELECT event_id, t || t AS written, CAST((CAST(event_id * 5 AS HUGEINT) * 4294967296 + event_id * 3) * 65536 + event_id % 60000 AS VARCHAR) AS csn FROM h"),
    (cdc_typed_images, SQL_A + """z AS (SELECT 1)
SELECT event_id, CASE WHEN op_type <> 'I' THEN user_id END AS before_key, CASE WHEN op_type <> 'D' THEN new_key END AS after_key,
  CASE WHEN op_type <> 'D' THEN amount END AS after_amount, CASE WHEN op_type <> 'D' THEN raw_note END AS after_note FROM b"""),
    (cdc_typed_times, "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) ELSE o_orderdate + to_microseconds(o_orderkey % 1000000) END AS at FROM orders WHERE o_orderdate IS NOT NULL"),
    (cdc_marker_repair, SQL_A + "z AS (SELECT 1) SELECT event_id, CASE WHEN raw_note = 'unchanged-toast-datum' THEN old_note ELSE raw_note END AS note FROM b WHERE op_type = 'U'"),
    (cdc_lob_carry_forward, SQL_A + """
c AS (SELECT event_id, user_id, schema_id, csn, pos, CASE WHEN raw_note <> 'unchanged-toast-datum' THEN raw_note END AS note FROM b WHERE op_type <> 'D'),
w AS (SELECT event_id, user_id, last_value(note IGNORE NULLS) OVER (PARTITION BY user_id, schema_id ORDER BY csn, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS note FROM c)
SELECT event_id, coalesce(note, c_name) AS note FROM w LEFT JOIN customer ON user_id = c_custkey"""),
    (cdc_carry_forward_hot_keys, SQL_A + """
c AS (SELECT event_id, schema_id, op_type, csn, pos, CASE WHEN op_type <> 'D' AND raw_note <> 'unchanged-toast-datum' THEN raw_note END AS note FROM b),
w AS (SELECT event_id, op_type, last_value(CASE WHEN op_type = 'D' THEN '' ELSE note END IGNORE NULLS) OVER (PARTITION BY schema_id ORDER BY csn, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS note FROM c)
SELECT event_id, nullif(note, '') AS note FROM w"""),
    (stream_carry_forward, SQL_A + """
c AS (SELECT *, CASE WHEN op = 'D' THEN '' WHEN note <> 'unchanged-toast-datum' THEN note END AS mark FROM s),
w AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY key, schema_id ORDER BY csn, pos, pk_rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried,
        row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM c)
SELECT key, schema_id, amount, nullif(carried, '') AS note, event_id, csn, CAST(pk_rank AS BIGINT) AS pk_rank FROM w WHERE rn = 1 AND op <> 'D'"""),
    (cdc_lob_retry, SQL_A + """z AS (SELECT schema_id, CASE WHEN op_type = 'U' AND raw_note IS NULL AND k % 3 <> 0 THEN 'retry' ELSE 'pass' END AS side FROM b)
SELECT schema_id, side, count(*) AS n FROM z GROUP BY schema_id, side"""),
    (cdc_truncate_apply, SQL_A + """
r AS (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s),
t AS (SELECT schema_id, min((csn, pos, pk_rank)) AS m FROM s WHERE ts >= TIMESTAMP '2024-01-15' AND schema_id IN ('s0', 's1') GROUP BY schema_id)
SELECT key, r.schema_id, amount, note, event_id, csn, CAST(pk_rank AS BIGINT) AS pk_rank FROM r LEFT JOIN t ON r.schema_id = t.schema_id
WHERE rn = 1 AND op <> 'D' AND (m IS NULL OR (csn, pos, pk_rank) >= m)"""),
    (cdc_initial_load_dedup, "SELECT 's' || (l_orderkey % 5) AS schema_id, count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem GROUP BY 1"),
    (cdc_initial_load_rows, "WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, md5(concat_ws('#$%^#', l_orderkey, l_linenumber)) AS sk FROM r WHERE rn = 1"),
    (bronze_route, """
WITH m AS (SELECT event_id, user_id AS u, event_id % 50 = 0 AS beat FROM events),
k AS (SELECT event_id, u, beat, CASE WHEN beat THEN 'gg.ggs.gg_heartbeat' ELSE 'db' || u % 3 || '.sch' || u % 2 || '.tab' || u % 5 || CASE WHEN u % 7 = 0 THEN '__dol' ELSE '' END END AS key FROM m),
i AS (SELECT *, CASE WHEN beat THEN 'gg.ggs' ELSE 'id' || (u % 3 + 3 * (u % 2)) END AS schema_id, CASE WHEN beat THEN 'gg_heartbeat' ELSE 'tab' || u % 5 || CASE WHEN u % 7 = 0 THEN '$' ELSE '' END END AS src_table FROM k)
SELECT event_id, key, src_table, schema_id, CASE WHEN beat THEN TRUE WHEN src_table NOT IN ('tab0', 'tab1', 'tab2', 'tab3') THEN FALSE WHEN src_table = 'tab1' AND schema_id IN ('id0', 'id4') THEN FALSE ELSE TRUE END AS is_active_event FROM i"""),
    (registry_paths, """
WITH k AS (SELECT 'db' || user_id % 3 || '.sch' || user_id % 2 || '.tab' || user_id % 5 || CASE WHEN user_id % 7 = 0 THEN '__dol' ELSE '' END AS key, event_id % 4 - 2 AS fp FROM events WHERE event_id % 50 <> 0)
SELECT '/registry/' || replace(split_part(key, '.', 3), '__dol', '$') || '/schema.' || key || '.' || fp || '.avsc' AS path, key, fp, count(*) AS n FROM k GROUP BY key, fp"""),
    (bronze_partition_counts, SQL_A + "z AS (SELECT 1) SELECT schema_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS n FROM a GROUP BY ALL"),
    (fingerprint_gate, SQL_A + "z AS (SELECT k % 4 AS schema_fingerprint FROM a) SELECT CASE WHEN schema_fingerprint < 3 THEN 'known' ELSE 'quarantine' END AS side, schema_fingerprint, count(*) AS n FROM z GROUP BY ALL"),
    (meta_map_columns, SQL_A + "z AS (SELECT 1) SELECT event_id, CAST(csn AS VARCHAR) AS csn, op_type, CAST(4 AS BIGINT) AS n FROM a"),
    (silver_filter, SQL_A + "z AS (SELECT 1) SELECT schema_id, op_type, count(*) AS n, max(csn) AS max_csn FROM a WHERE ts >= TIMESTAMP '2024-01-10' AND schema_id <> 's3' GROUP BY ALL"),
    (stream_apply, LATEST),
    (stream_ledger, SQL_A + "r AS (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s) SELECT count(*) AS n_live, CAST(2 AS BIGINT) AS n_runs, CAST(0 AS BIGINT) AS repeated_batches FROM r WHERE rn = 1 AND op <> 'D'"),
    (replay_with_ledger, LATEST.replace("FROM s", "FROM s WHERE ts >= TIMESTAMP '2024-01-05'")),
    (stream_fork, SQL_A + "z AS (SELECT 1) SELECT CASE WHEN schema_id <> 's3' THEN 'active' ELSE 'inactive' END AS side, schema_id, count(*) AS n FROM a GROUP BY ALL"),
    (claim_checks, "SELECT doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN text ELSE 'inline' END) AS payload_md5 FROM documents"),
]
