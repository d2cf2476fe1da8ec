"""Queries of sinks, logs, control tables and file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import storage
from tideline.functions.images import typed_image
from tideline.functions.messages import table_of
from tideline.operators import changes as C
from tideline.operators import control as CT
from tideline.operators import evolve as E
from tideline.operators import gate as G
from tideline.operators import logs as L
from tideline.operators import merge as M
from tideline.operators import metadata as MD
from tideline.operators import reconcile as R
from tideline.operators import rewrite as W
from tideline.plans.catalog import WIDEST, _versions, schema_diff_events
from tideline.plans.cdc import KEYS, _event_stream, _message_keys, changes, feed, flat
from tideline.plans.feeds import IMAGE, SQL_A, SQL_B, event_feed, table, tenant_feed
from tideline.sources.readers import json_file_stream, text_file_stream
from tideline.types import DOCUMENT, FLOW_ERROR
from tideline.streaming.apply import ChangePieces, change_feed, change_stream, replay_from

s = lambda c: F.col(c).cast("string")


def change_feed_between(spark, sf_dir):
    """Change feed that the second half of the changes makes to the current-state table of the first, which was compacted since."""
    target = ChangePieces(spark, storage.fresh_dir(spark, "feed"), KEYS, "__cdc_sequencer")
    c = changes(feed(spark, sf_dir))
    target.append("first", 0, c.where("ts < timestamp_ntz '2024-01-20 00:00:00'"))
    target.append("first", 1, c.where("ts >= timestamp_ntz '2024-01-20 00:00:00'"))
    target.compact()
    out = change_feed(target, 2)
    return out.select("key", F.col("__schema_id").alias("schema_id"), "event_id", F.col("_change_type").alias("change_type"), "_commit_version")


def change_stream_from(spark, sf_dir):
    """A stream of the changes from the second of three commits on, drained before and after a compaction, and another one begun
    after it: both have each change once."""
    root = storage.fresh_dir(spark, "feed-stream")
    target = ChangePieces(spark, f"{root}/table", KEYS, "__cdc_sequencer")
    c = changes(feed(spark, sf_dir))
    for batch, part in enumerate(("ts < timestamp_ntz '2024-01-10 00:00:00'", "ts >= timestamp_ntz '2024-01-10 00:00:00' AND ts < timestamp_ntz '2024-01-20 00:00:00'", "ts >= timestamp_ntz '2024-01-20 00:00:00'")):
        target.append("first", batch, c.where(part))

    def drain(name):
        change_stream(target, 2).writeStream.format("parquet").option("path", f"{root}/{name}/rows").option("checkpointLocation", f"{root}/{name}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    drain("a")
    target.compact()
    drain("a")
    drain("b")
    both = spark.read.parquet(f"{root}/a/rows").unionByName(spark.read.parquet(f"{root}/b/rows"))
    row = both.select("key", F.col("__schema_id").alias("schema_id"), "event_id", F.col("__DeleteVersion").isNotNull().alias("deleted"), "_commit_version")
    return row.groupBy(*row.columns).agg(F.count("*").alias("n"))


def decode_by_registry(spark, sf_dir):
    """Images decoded by the schema version that each row names: three versions of different columns and types, and one unknown."""
    a = feed(spark, sf_dir)
    kinds = {0: "key bigint, amount double", 1: "key int, amount decimal(12,2), note string", 2: "key string, note string, extra date"}
    rows = [(f, i, *c.split(" ", 1)) for f, cs in kinds.items() for i, c in enumerate(cs.split(", "))]
    registry = spark.createDataFrame(rows, "schema_fingerprint long, position int, `column` string, type string")
    d = C.decode_by_registry(a.select("schema_fingerprint", "after"), registry, ["after"])
    image = F.col("after.image")
    amount = F.try_variant_get(image, "$.amount", "double")
    return d.groupBy("schema_fingerprint").agg(
        F.count("*").alias("n"), F.count(image).alias("n_decoded"), F.schema_of_variant_agg(image).alias("shape"),
        F.sum(F.try_variant_get(image, "$.key", "bigint")).alias("key_sum"), F.round(F.sum(amount), 3).alias("amount_sum"), F.count(F.try_variant_get(image, "$.note", "string")).alias("n_notes"),
        F.coalesce(F.sum(F.size("after.bad")), F.lit(0)).alias("n_bad"),
    )


def clustered_rewrite(spark, sf_dir):
    """lineitem along a curve over three columns: the files that a narrow filter on each of them reads, held against their bound."""
    root = storage.fresh_dir(spark, "clustered")
    columns = ["l_partkey", "l_orderkey", "l_suppkey"]
    li = table(spark, sf_dir, "lineitem").select(*columns, "l_quantity")
    li.write.parquet(f"{root}/old")
    files = 27
    M.clustered(spark.read.parquet(f"{root}/old"), columns, files).write.parquet(f"{root}/new")
    t = spark.read.parquet(f"{root}/new")
    ranges = M.file_ranges(t, columns).persist()
    top = t.agg(*[F.max(c).alias(f"top_{c}") for c in columns])
    out = None
    for c in columns:  # one value in the middle of the column
        mid = F.floor(F.col(f"top_{c}") / 2)
        hit = ranges.crossJoin(F.broadcast(top)).where((F.col(f"low_{c}") <= mid) & (F.col(f"high_{c}") >= mid))  # one row
        one = hit.agg(F.count("*").alias("n_files")).select(F.lit(c).alias("column"), (F.col("n_files").between(1, 2 * 9)).alias("within_bound"))
        rows = t.crossJoin(F.broadcast(top)).where(F.col(c) == mid).agg(F.count("*").alias("n_rows"), F.sum("l_quantity").alias("quantity"))
        one = one.crossJoin(rows)  # one row each
        out = one if out is None else out.unionByName(one)
    return out.crossJoin(ranges.agg((F.count("*").between(20, files)).alias("all_files")))


def run_gate(spark, sf_dir):
    """Batches of orders by status behind a gate on null and on large prices: two pass, one is kept unpublished."""
    root = storage.fresh_dir(spark, "gate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("price"))
    rows = []
    for status, allowed in (("F", 10**9), ("O", 0), ("P", 10**9)):
        gates = [G.Gate("n_rows", F.count("*"), 10**12), G.Gate("n_null", F.sum(F.col("price").isNull().cast("int")), allowed)]
        v = G.gated_write(o.where(F.col("o_orderstatus") == status), f"{root}/{status}", gates)
        rows.append((status, v.published, v.metrics["n_rows"], v.metrics["n_null"], ",".join(v.failed), storage.exists(spark, f"{root}/{status}")))
    return spark.createDataFrame(rows, "o_orderstatus string, published boolean, n_rows long, n_null long, failed string, visible boolean")


def lag_window(spark, sf_dir):
    """Replication lag rows of the last day for one app."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("app"), (F.col("user_id") % 3).cast("string")).alias("app"), "event_type", "ts", L.day_number("ts").alias("yyyymmdd"))
    last = e.agg(F.max("yyyymmdd").alias("yyyymmdd"))
    day = e.where("app = 'app1'").join(F.broadcast(last), "yyyymmdd")  # one row
    return day.groupBy("event_type", "yyyymmdd").agg(F.max("ts").alias("max_ts"), F.count("*").alias("n"))


def source_sample(spark, sf_dir):
    """A random sample, tagged with its source."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return R.data_sample(o, 100, 7, ["o_orderkey"], src_db="db", src_table="orders")


def registry_table(spark, sf_dir):
    """Registry rows in a table partitioned by table name, each key and fingerprint once, written and read again."""
    path = storage.fresh_dir(spark, "registry")
    m = _message_keys(table(spark, sf_dir, "events")).where("event_id % 50 <> 0").select(F.lower("key").alias("key"), (F.col("event_id") % 3).alias("fingerprint"))
    m = m.dropDuplicates(["key", "fingerprint"]).withColumn("table_name", table_of("key"))
    m.write.partitionBy("table_name").parquet(path)
    return spark.read.schema(m.schema).parquet(path).groupBy("table_name").agg(F.count("*").alias("n"), F.countDistinct("key").alias("n_keys"))


def overwrite_with_schema(spark, sf_dir):
    """A table rewritten to a merged schema, keeping its partitioning."""
    old, new = storage.fresh_dir(spark, "old"), storage.fresh_dir(spark, "new")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(old)
    from pyspark.sql import types as T

    shape = T.StructType.fromDDL("o_orderkey decimal(20,0), o_custkey bigint, note string, o_orderstatus string")
    M.cast_to(spark.read.parquet(old), shape).write.mode("overwrite").partitionBy("o_orderstatus").parquet(new)
    return spark.read.parquet(new).groupBy("o_orderstatus").agg(F.sum(F.col("o_orderkey").cast("long")).alias("key_sum"), F.count("note").alias("n_notes"), F.count("*").alias("n"))


def flow_rewrite(spark, sf_dir):
    """Five flows' tables, one of which has a column that cannot be cast and one of which is not there yet: outcome, flag, log rows
    and what the tables hold then."""
    root = storage.fresh_dir(spark, "rewrite")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("priority"), F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)).alias("mark"))
    flows = []
    for p in "12345":
        path = f"{root}/flow-{p}"
        if p != "5":
            o.where(F.col("priority") == p).drop("priority").write.partitionBy("o_orderstatus").parquet(path)
        mark = "int" if p == "3" else "string"
        flows.append(W.Rewrite(f"flow-{p}", path, f"o_orderkey decimal(20,0), o_custkey bigint, mark {mark}, note string, o_orderstatus string", ("o_orderstatus",)))
    outcomes = W.rewrite_flows(spark, flows)
    specs = spark.createDataFrame([(f.flow_id, False, "deploy") for f in flows], "flow_id string, schema_refresh_done boolean, updated_by string")
    log = f"{root}/errors"
    L.append_log(W.refresh_errors(outcomes, "app", F.lit("2024-02-01 00:00:00")), log)
    logged = L.read_log(spark, log, FLOW_ERROR).groupBy("flow_id").agg(F.count("*").alias("n_errors"), F.max(F.col("error_metadata")["condition"]).alias("condition"))
    held = None
    for f in flows[:4]:
        t = spark.read.parquet(f.path)
        one = t.agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").cast("long").alias("key_sum")).select(F.lit(f.flow_id).alias("flow_id"), F.lit("note" in t.columns).alias("new_schema"), "n_rows", "key_sum")
        held = one if held is None else held.unionByName(one)
    return W.with_refresh_flags(specs, outcomes).join(held, "flow_id", "left").join(logged, "flow_id", "left")


def schema_change_log(spark, sf_dir):
    """The log of the schema changes of two states, appended, and appended again by a repeated run, which adds nothing."""
    path = storage.fresh_dir(spark, "ddl-events")
    rows = CT.change_log_rows(schema_diff_events(spark, sf_dir), "app", F.lit("tx1"), F.lit("2024-02-03 04:05:06"))
    L.append_log(rows, path)
    L.append_log(CT.new_log_rows(rows, L.read_log(spark, path, CT.DDL_EVENT_LOG)), path)
    back = L.read_log(spark, path, CT.DDL_EVENT_LOG)
    event = F.from_json("ddl_event", "flow_id string, column string, event string, status string")
    return back.select(event.alias("e"), "*").groupBy("app", "yyyymm", "transaction_id", "e.event", "e.status").agg(F.count("*").alias("n"), F.countDistinct("notification_id").alias("n_ids"), F.count("error_msg").alias("n_errors"))


def app_load(spark, sf_dir):
    """The specs of one app out of control tables for all: its row, its flows, and its loads that are not complete."""
    n = F.col("n_nationkey")
    apps = table(spark, sf_dir, "nation").select(F.concat(F.lit("app"), (n % 20).cast("string")).alias("app"), F.col("n_name").alias("delta_db")).where("n_nationkey >= 5")
    flows = table(spark, sf_dir, "customer").select(F.concat(F.lit("app"), (F.col("c_custkey") % 25).cast("string")).alias("app"), F.col("c_name").alias("flow_id"))
    k = F.col("s_suppkey")
    loads = table(spark, sf_dir, "supplier").select(F.concat(F.lit("app"), (k % 25).cast("string")).alias("app"), F.col("s_name").alias("table_name"), F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("is_complete"))
    mine = CT.app_specs(apps, flows, loads, "app7")
    parts = [df.select(F.lit(kind).alias("kind"), F.col(c).alias("name")) for kind, df, c in (("app", mine.app, "delta_db"), ("flow", mine.flows, "flow_id"), ("load", mine.loads, "table_name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def created_table(spark, sf_dir):
    """A document table created by its declared schema and layout, filled, and grouped by its cluster column without a shuffle."""
    root = storage.fresh_dir(spark, "created")
    name = "documents_" + root.rsplit("-", 1)[-1]
    CT.create_table(spark, name, DOCUMENT, f"{root}/t", ("event_date",), ("org_id",), 4, properties={"layout": "org by day"})
    e = table(spark, sf_dir, "events")
    rows = e.select(s("event_id").alias("document_id"), F.parse_json("props").alias("document"), F.concat(F.lit("org"), (F.col("user_id") % 10).cast("string")).alias("org_id"), F.lit("s").alias("schema_id"), F.create_map(F.lit("type"), F.col("event_type")).alias("__meta"), F.to_date("ts").alias("event_date"))
    t = spark.table(name)
    rows.select(*t.columns).write.insertInto(name)
    CT.create_table(spark, name, DOCUMENT)  # there already: nothing happens
    return spark.table(name).groupBy("org_id").agg(F.count("*").alias("n"), F.countDistinct("event_date").alias("n_days"), F.sum(F.try_variant_get("document", "$.k", "bigint")).alias("k_sum"))


def error_log(spark, sf_dir):
    """Schemas of inactive flows are skipped with a warning row each in the error log."""
    path = storage.fresh_dir(spark, "errors")
    e = table(spark, sf_dir, "events").where("user_id % 5 = 0 AND event_type = 'error'")
    rows = L.error_rows(e, "app", F.concat(F.lit("flow"), s("user_id")), F.lit("schema of an inactive flow"), F.lit(None).cast("string"), F.col("ts"), event=F.col("event_id"))
    L.append_log(rows, path)
    back = L.read_log(spark, path, FLOW_ERROR)
    return back.groupBy("flow_id", "yyyymm").agg(F.count("*").alias("n"), F.countDistinct("error_id").alias("n_ids"), F.max(F.col("error_metadata")["event"].cast("long")).alias("last_event"))


def extract_status(spark, sf_dir):
    """Statuses of extracts; those that must fail the job."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("c"), (F.col("user_id") % 10).cast("string")).alias("collection"), F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "no documents found").otherwise("connection lost")).alias("error"))
    return L.fatal_statuses(e).groupBy("collection").agg(F.count("*").alias("n_fatal"))


def truncate_events_sink(spark, sf_dir):
    """Truncate events written as JSON files, streamed back, and the latest of each schema with its files counted."""
    path = storage.fresh_dir(spark, "truncates")
    a = feed(spark, sf_dir).where("op_type = 'D' AND k % 5 = 0").select(F.lit("accounts").alias("target_table"), "schema_id", "csn", "pos")
    a.write.json(path)
    stream = json_file_stream(spark, path, a.schema)
    out = storage.fresh_dir(spark, "truncates-read")
    stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    back = spark.read.schema(stream.schema).parquet(f"{out}/rows")
    last = back.groupBy("target_table", "schema_id").agg(F.max(F.struct("csn", "pos")).alias("m"), F.count("*").alias("n"), (F.size(F.collect_set("file_path")) > 0).alias("has_files"))
    return last.select("target_table", "schema_id", "m.csn", "m.pos", "n", "has_files")


def text_stream(spark, sf_dir):
    """Schema texts discovered as whole files with their paths."""
    path, out = storage.fresh_dir(spark, "texts"), storage.fresh_dir(spark, "texts-read")
    table(spark, sf_dir, "nation").select(F.concat_ws(":", "n_name", s("n_regionkey")).alias("value")).write.text(path)
    q = text_file_stream(spark, path)
    q.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    lines = spark.read.schema(q.schema).parquet(f"{out}/rows").select(F.explode(F.split("value", "\n")).alias("line")).where("line <> ''")
    return lines.select(F.split("line", ":")[0].alias("name"), F.split("line", ":")[1].cast("int").alias("region"))


def replay_start(spark, sf_dir):
    """The apply stream from one start timestamp, then replayed from an earlier one under a checkpoint of its own into the same
    table, then started again from that one, which resumes and adds nothing."""
    root = storage.fresh_dir(spark, "replay")
    target = ChangePieces(spark, f"{root}/table", KEYS, "__cdc_sequencer")
    for start in ("2024-01-18 00:00:00", "2024-01-10 00:00:00", "2024-01-10 00:00:00"):
        replay_from(changes(event_feed(_event_stream(spark, sf_dir))), "ts", start, target, f"{root}/checkpoints").awaitTermination()
    return flat(C.current_state(target.read())).crossJoin(F.broadcast(spark.createDataFrame([(len({p.run for p in target.pieces()}),)], "n_runs long")))  # one row


def app_schema_pairs(spark, sf_dir):
    """Schema specs of one app, joined on the app."""
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 20).alias("app"), F.col("c_nationkey").alias("schema_no")).distinct()
    apps = table(spark, sf_dir, "supplier").where("s_suppkey < 20").select(F.col("s_suppkey").alias("app"), F.col("s_name").alias("app_name"))
    return c.join(apps.where("app = 7"), "app")


def rows_by_database(spark, sf_dir):
    """Query rows gathered into an ordered list for each database."""
    n = table(spark, sf_dir, "nation")
    g = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))
    return g.select("n_regionkey", F.array_join(F.transform("rows", lambda r: r["n_name"]), ",").alias("names"))


def distinct_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.lower("p_type").alias("name")).distinct()


def tenant_counts(spark, sf_dir):
    """Counts by tenant; a table without the tenant column counts under a dummy tenant."""
    o = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 10).cast("string").alias("tenant")).agg(F.count("*").alias("n")).select(F.lit("orders").alias("table_name"), "tenant", "n")
    p = table(spark, sf_dir, "part").agg(F.count("*").alias("n")).select(F.lit("part").alias("table_name"), F.lit("-1").alias("tenant"), "n")
    return o.unionByName(p)


def schema_rollup(spark, sf_dir):
    """Tenant counts summed to schema and table, names lower-cased."""
    b = tenant_feed(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    per = b.groupBy(F.upper("schema_id").alias("schema"), "key").agg(F.count("*").alias("n"))
    return per.groupBy(F.lower(F.concat_ws(".", "schema", F.lit("ORDERS"))).alias("name")).agg(F.sum("n").alias("n_rows"))


def flow_specs(spark, sf_dir):
    """Flow specs built from key and schema rows; existing ones only get their large-column list refreshed."""
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("flow"), s("p_partkey")).alias("flow_id"), F.col("p_name").alias("src_table"), F.col("p_type").alias("lob_columns"), (F.col("p_size") % 3).cast("string").alias("owner"))
    p = p.withColumn("path", F.concat_ws("/", F.lit("/silver"), "src_table"))
    have = p.where("owner <> '0'").withColumn("lob_columns", F.lit("old")).withColumn("path", F.lit("kept"))
    return M.upsert(have, p, ["flow_id"], ["lob_columns"])


def app_specs(spark, sf_dir):
    """App rows inserted where absent, with default settings."""
    apps = table(spark, sf_dir, "nation").select(F.col("n_name").alias("app"), F.create_map(F.lit("shuffle"), F.lit("600")).alias("confs"))
    have = table(spark, sf_dir, "supplier").select(F.concat(F.lit("NATION_"), s("s_nationkey")).alias("app"), F.create_map(F.lit("shuffle"), F.lit("10")).alias("confs")).where("app < 'NATION_2'").dropDuplicates(["app"])
    return M.insert_missing(have, apps, ["app"]).select("app", F.col("confs")["shuffle"].alias("shuffle"))


def snapshot_append(spark, sf_dir):
    """Catalog snapshots appended although the newer one has another column; the latest is read back."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    both = M.append_evolving(c.withColumn("created_at", F.lit(1)), c.where("c_custkey % 3 = 0").withColumn("segment", F.lit("x")).withColumn("created_at", F.lit(2)))
    return MD.latest_snapshot(both).select("c_custkey", "segment")


def type_overrides(spark, sf_dir):
    """Pre-merge overrides: a text version of a timestamp column keeps the table's type in the databases that list it."""
    v = _versions(spark, sf_dir).where("version < 2")
    v = v.withColumn("type", F.when(F.col("version") == 0, "timestamp").otherwise("string"))
    out = None
    for db in ("postgres", "oracle"):
        part = E.fold_versions(v, db, nested=False).groupBy("flow_id").agg(F.max("failed").alias("failed"), F.sum((F.col("type") == "timestamp").cast("int")).alias("n_timestamps")).withColumn("database", F.lit(db))
        out = part if out is None else out.unionByName(part)
    return out.select("database", "flow_id", "failed", "n_timestamps")


def count_results(spark, sf_dir):
    """Result rows of a count run: failed sides in an error map, succeeded ones with their difference."""
    o = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("src"), F.sum(F.when(F.col("o_orderkey") % 7 != 0, 1).otherwise(0)).alias("tgt"), F.max("o_orderdate").alias("at"))
    o = o.withColumn("src_error", F.when(F.col("o_orderpriority").startswith("1"), "timeout")).withColumn("tgt_error", F.when(F.col("o_orderpriority").startswith("5"), "missing"))
    o = o.withColumn("diff", F.when(F.col("src_error").isNull() & F.col("tgt_error").isNull(), F.col("src") - F.col("tgt"))).withColumn("pct", F.lit(None).cast("double"))
    r = L.count_results(o, F.col("o_orderpriority"), "diff", "pct", "src_error", "tgt_error", F.col("at"))
    return r.select("table_name", "is_error", F.coalesce(F.array_join(F.map_values("errors"), ","), F.lit("")).alias("errors"), F.col("metadata")["count_diff"].alias("diff"), "yyyymmdd")


def column_alignment(spark, sf_dir):
    """Business columns in the order of a schema, one excluded, a clashing name moved aside."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("topic"), "user_id", "value")
    out = e.withColumnRenamed("topic", "__topic").drop("value").select("user_id", "event_id", "__topic")
    return out.withColumn("topic", F.lit("t"))


def load_status(spark, sf_dir):
    """Status of schema loads: new ones inserted, known ones updated."""
    seen = table(spark, sf_dir, "customer").select(s("c_nationkey").alias("src_schema")).distinct().withColumn("load_status", F.lit("completed")).withColumn("failure_reason", F.lit(None).cast("string"))
    have = table(spark, sf_dir, "supplier").where("s_suppkey < 30").select(s("s_nationkey").alias("src_schema")).distinct().withColumn("load_status", F.lit("failed")).withColumn("failure_reason", F.lit("old"))
    return M.upsert(have, seen, ["src_schema"], ["load_status", "failure_reason"])


def heartbeat_json(spark, sf_dir):
    """Heartbeat rows parsed from JSON images, the latest of each database and replicat."""
    a = table(spark, sf_dir, "events").select(F.to_json(F.struct(F.col("event_type").alias("incoming_replicat"), F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")).alias("remote_database"), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("heartbeat_timestamp"))).alias("after"), "ts", "event_id")
    j = F.from_json("after", "incoming_replicat string, remote_database string, heartbeat_timestamp string")
    b = a.select(j.alias("j"), "ts", "event_id").select("j.*", "ts", "event_id")
    out = R.with_latest(b, ["remote_database", "incoming_replicat"], "event_id", ["heartbeat_timestamp"])
    return out.select("remote_database", "incoming_replicat", "event_id", F.col("heartbeat_timestamp").cast("long").alias("beat"))


QUERIES = [
    (change_feed_between, SQL_A + """
h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s WHERE ts < TIMESTAMP '2024-01-20') WHERE rn = 1 AND op <> 'D'),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s) WHERE rn = 1 AND op <> 'D'),
j AS (SELECT coalesce(h.key, w.key) AS key, coalesce(h.schema_id, w.schema_id) AS schema_id, h.event_id AS a, w.event_id AS b, h.pk_rank AS x, w.pk_rank AS y FROM h FULL JOIN w ON h.key = w.key AND h.schema_id = w.schema_id),
z AS (
  SELECT key, schema_id, b AS event_id, 'insert' AS change_type FROM j WHERE a IS NULL UNION ALL SELECT key, schema_id, a, 'delete' FROM j WHERE b IS NULL
  UNION ALL SELECT key, schema_id, a, 'update_preimage' FROM j WHERE a <> b UNION ALL SELECT key, schema_id, b, 'update_postimage' FROM j WHERE a <> b)
SELECT *, CAST(2 AS BIGINT) AS _commit_version FROM z"""),
    (change_stream_from, SQL_A + """
p AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 2 ELSE 3 END AS part FROM s WHERE ts >= TIMESTAMP '2024-01-10'),
r AS (SELECT *, row_number() OVER (PARTITION BY part, key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM p)
SELECT key, schema_id, event_id, op = 'D' AS deleted, CAST(part AS BIGINT) AS _commit_version, CAST(2 AS BIGINT) AS n FROM r WHERE rn = 1"""),
    (decode_by_registry, SQL_A + """
z AS (SELECT k % 4 AS f, op_type, new_key, amount, CASE WHEN op_type <> 'D' THEN raw_note END AS note FROM b)
SELECT f AS schema_fingerprint, count(*) AS n, count(*) FILTER (WHERE f < 3 AND op_type <> 'D') AS n_decoded,
  CASE f WHEN 0 THEN 'OBJECT<amount: DOUBLE, key: BIGINT>' WHEN 1 THEN 'OBJECT<amount: DECIMAL(5,2), key: BIGINT, note: STRING>' WHEN 2 THEN 'OBJECT<key: STRING, note: STRING>' ELSE 'VOID' END AS shape,
  CAST(sum(CASE WHEN f < 3 AND op_type <> 'D' THEN new_key END) AS BIGINT) AS key_sum, round(sum(CASE WHEN f < 2 AND op_type <> 'D' THEN amount END), 3) AS amount_sum,
  count(note) FILTER (WHERE f IN (1, 2)) AS n_notes, CAST(0 AS BIGINT) AS n_bad FROM z GROUP BY f"""),
    (clustered_rewrite, """
WITH m AS (SELECT max(l_partkey) // 2 AS p, max(l_orderkey) // 2 AS o, max(l_suppkey) // 2 AS s FROM lineitem)
SELECT 'l_partkey' AS "column", TRUE AS within_bound, count(*) AS n_rows, sum(l_quantity) AS quantity, TRUE AS all_files FROM lineitem, m WHERE l_partkey = p
UNION ALL SELECT 'l_orderkey', TRUE, count(*), sum(l_quantity), TRUE FROM lineitem, m WHERE l_orderkey = o
UNION ALL SELECT 'l_suppkey', TRUE, count(*), sum(l_quantity), TRUE FROM lineitem, m WHERE l_suppkey = s"""),
    (run_gate, "SELECT o_orderstatus, o_orderstatus <> 'O' AS published, count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey % 10 = 0) AS n_null, CASE WHEN o_orderstatus = 'O' THEN 'n_null' ELSE '' END AS failed, o_orderstatus <> 'O' AS visible FROM orders GROUP BY o_orderstatus"),
    (lag_window, "SELECT event_type, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS yyyymmdd, max(ts) AS max_ts, count(*) AS n FROM events WHERE user_id % 3 = 1 AND CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1, 2"),
    (source_sample, "SELECT o_orderkey, o_custkey, o_orderstatus, 'db' AS src_db, 'orders' AS src_table FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 100"),
    (registry_table, """WITH k AS (SELECT DISTINCT 'c##db' || user_id % 3 || '.sch' || user_id % 2 || '.tab' || user_id % 5 || CASE WHEN user_id % 7 = 0 THEN '__dol' ELSE '' END AS key, event_id % 3 AS fp FROM events WHERE event_id % 50 <> 0)
SELECT replace(split_part(key, '.', 3), '__dol', '$') AS table_name, count(*) AS n, count(DISTINCT key) AS n_keys FROM k GROUP BY 1"""),
    (overwrite_with_schema, "SELECT o_orderstatus, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(0 AS BIGINT) AS n_notes, count(*) AS n FROM orders GROUP BY 1"),
    (schema_change_log, WIDEST + """,
b AS (SELECT flow_id, col, max(rank) AS rank FROM r WHERE version < 2 GROUP BY 1, 2), a AS (SELECT flow_id, col, max(rank) AS rank FROM r WHERE version <> 1 GROUP BY 1, 2),
f AS (SELECT flow_id FROM b INTERSECT SELECT flow_id FROM a),
d AS (SELECT coalesce(a.flow_id, b.flow_id) AS flow_id, a.rank AS x, b.rank AS y FROM b FULL JOIN a ON a.flow_id = b.flow_id AND a.col = b.col),
e AS (SELECT *, CASE WHEN y IS NULL THEN 'ADD_COLUMN' WHEN x IS NULL THEN 'DROP_COLUMN' WHEN x <> y THEN 'MODIFY_COLUMN' END AS event FROM d WHERE flow_id IN (SELECT flow_id FROM f))
SELECT 'app' AS app, 202402 AS yyyymm, 'tx1' AS transaction_id, event, CASE event WHEN 'DROP_COLUMN' THEN 'IGNORED' ELSE 'PROCESSED' END AS status, count(*) AS n, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_errors FROM e WHERE event IS NOT NULL GROUP BY event"""),
    (app_load, """
SELECT 'app' AS kind, n_name AS name FROM nation WHERE n_nationkey >= 5 AND n_nationkey % 20 = 7 UNION ALL SELECT 'flow', c_name FROM customer WHERE c_custkey % 25 = 7
UNION ALL SELECT 'load', s_name FROM supplier WHERE s_suppkey % 25 = 7 AND s_suppkey % 3 <> 0"""),
    (created_table, "SELECT 'org' || user_id % 10 AS org_id, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS n_days, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY 1"),
    (flow_rewrite, """
WITH f AS (SELECT 'flow-' || i AS flow_id, i FROM (VALUES (1), (2), (3), (4), (5)) AS t(i)),
o AS (SELECT 'flow-' || o_orderpriority[1] AS flow_id, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders WHERE o_orderpriority[1] <> '5' GROUP BY 1)
SELECT f.flow_id, i <> 3 AS schema_refresh_done, CASE WHEN i = 3 THEN 'deploy' ELSE 'schema_merger' END AS updated_by,
  CASE WHEN n_rows IS NOT NULL THEN i <> 3 END AS new_schema, n_rows, key_sum, CASE WHEN i = 3 THEN CAST(1 AS BIGINT) END AS n_errors, CASE WHEN i = 3 THEN 'CAST_INVALID_INPUT' END AS condition
FROM f LEFT JOIN o ON f.flow_id = o.flow_id"""),
    (error_log, "SELECT 'flow' || user_id AS flow_id, CAST(strftime(ts, '%Y%m') AS INTEGER) AS yyyymm, count(*) AS n, count(DISTINCT ts) AS n_ids, max(event_id) AS last_event FROM events WHERE user_id % 5 = 0 AND event_type = 'error' GROUP BY 1, 2"),
    (extract_status, "SELECT 'c' || user_id % 10 AS collection, count(*) AS n_fatal FROM events WHERE event_type = 'error' AND event_id % 2 = 1 GROUP BY 1"),
    (truncate_events_sink, SQL_A + "z AS (SELECT 1) SELECT 'accounts' AS target_table, schema_id, max(csn) AS csn, arg_max(pos, csn) AS pos, count(*) AS n, TRUE AS has_files FROM a WHERE op_type = 'D' AND k % 5 = 0 GROUP BY schema_id"),
    (text_stream, "SELECT n_name AS name, n_regionkey AS region FROM nation"),
    (replay_start, SQL_A + """
r AS (SELECT *, row_number() OVER (PARTITION BY key, schema_id ORDER BY csn DESC, pos DESC, pk_rank DESC) AS rn FROM s WHERE ts >= TIMESTAMP '2024-01-10')
SELECT key, schema_id, amount, note, event_id, csn, CAST(pk_rank AS BIGINT) AS pk_rank, CAST(2 AS BIGINT) AS n_runs FROM r WHERE rn = 1 AND op <> 'D'"""),
    (app_schema_pairs, "SELECT DISTINCT c_custkey % 20 AS app, c_nationkey AS schema_no, s_name AS app_name FROM customer JOIN supplier ON c_custkey % 20 = s_suppkey WHERE s_suppkey = 7"),
    (rows_by_database, "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM nation GROUP BY 1"),
    (distinct_names, "SELECT DISTINCT lower(p_type) AS name FROM part"),
    (tenant_counts, "SELECT 'orders' AS table_name, CAST(o_custkey % 10 AS VARCHAR) AS tenant, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'part', '-1', count(*) FROM part"),
    (schema_rollup, SQL_B + "z AS (SELECT 1) SELECT schema_id || '.orders' AS name, count(*) AS n_rows FROM f GROUP BY 1"),
    (flow_specs, "SELECT 'flow' || p_partkey AS flow_id, p_name AS src_table, p_type AS lob_columns, CAST(p_size % 3 AS VARCHAR) AS owner, CASE WHEN p_size % 3 <> 0 THEN 'kept' ELSE '/silver/' || p_name END AS path FROM part"),
    (app_specs, "SELECT n_name AS app, CASE WHEN n_name < 'NATION_2' AND n_nationkey IN (SELECT s_nationkey FROM supplier) THEN '10' ELSE '600' END AS shuffle FROM nation"),
    (snapshot_append, "SELECT c_custkey, 'x' AS segment FROM customer WHERE c_custkey % 3 = 0"),
    (type_overrides, """
WITH r AS (SELECT DISTINCT 'f' || l_orderkey % 500 AS flow_id, l_suppkey % 4 AS version, l_partkey % 8 AS col FROM lineitem WHERE l_suppkey % 4 < 2),
c AS (SELECT flow_id, col, max(CASE WHEN version = 0 THEN 1 ELSE 0 END) AS old, max(CASE WHEN version = 1 THEN 1 ELSE 0 END) AS new FROM r GROUP BY 1, 2),
f AS (SELECT flow_id, bool_or(old = 1 AND new = 1) AS both_types, sum(old) AS n FROM c GROUP BY 1)
SELECT 'postgres' AS database, flow_id, FALSE AS failed, CAST(n AS BIGINT) AS n_timestamps FROM f UNION ALL SELECT 'oracle', flow_id, both_types, CAST(n AS BIGINT) FROM f"""),
    (count_results, """SELECT lower(o_orderpriority) AS table_name, CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '5%' THEN 1 ELSE 0 END AS is_error, CASE WHEN o_orderpriority LIKE '1%' THEN 'timeout' WHEN o_orderpriority LIKE '5%' THEN 'missing' ELSE '' END AS errors,
CASE WHEN o_orderpriority NOT LIKE '1%' AND o_orderpriority NOT LIKE '5%' THEN CAST(count(*) FILTER (WHERE o_orderkey % 7 = 0) AS VARCHAR) END AS diff, CAST(strftime(max(o_orderdate), '%Y%m%d') AS INTEGER) AS yyyymmdd FROM orders GROUP BY o_orderpriority"""),
    (column_alignment, "SELECT user_id, event_id, event_type AS __topic, 't' AS topic FROM events"),
    (load_status, "WITH h AS (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS src_schema FROM supplier WHERE s_suppkey < 30), c AS (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS src_schema FROM customer) SELECT coalesce(h.src_schema, c.src_schema) AS src_schema, CASE WHEN c.src_schema IS NULL THEN 'failed' ELSE 'completed' END AS load_status, CASE WHEN c.src_schema IS NULL THEN 'old' END AS failure_reason FROM h FULL JOIN c ON h.src_schema = c.src_schema"),
    (heartbeat_json, "SELECT 's' || user_id % 4 AS remote_database, event_type AS incoming_replicat, max(event_id) AS event_id, arg_max(CAST(floor(epoch(ts)) AS BIGINT), event_id) AS beat FROM events GROUP BY 1, 2"),
]
