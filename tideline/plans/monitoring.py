"""Queries of counting, heartbeats, tenants, extracts and comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.messages import join_name, recent_months, tenant_valid
from tideline.operators import reconcile as R
from tideline.plans.feeds import SQL_A, SQL_B, event_feed, table, tenant_feed
from tideline.sources.readers import documents_between, fan_out
from tideline.streaming.apply import extract_increment

s = lambda c: F.col(c).cast("string")


def _tenants(spark, sf_dir):
    return tenant_feed(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def live_count_by_schema(spark, sf_dir):
    b = _tenants(spark, sf_dir).withColumn("__DeleteVersion", F.when(F.col("op_type") == "D", F.col("pos")))
    return R.live_counts(b, ["schema_id"], "op_ts")


def distinct_key_count(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("part", F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey") % 50)).withColumn("flag", F.col("l_returnflag"))
    return R.distinct_keys(li, ["part", "l_linenumber"], ["flag"])


def inflight_count(spark, sf_dir):
    a = event_feed(table(spark, sf_dir, "events"))
    cursors = a.where("event_id % 2 = 0 AND schema_id <> 's3'").groupBy("schema_id").agg((F.max("ts") - F.expr("INTERVAL 3 DAYS")).alias("cursor"))
    return R.in_flight(a, cursors, ["schema_id"], "op_type", "ts")


def count_diff_pct(spark, sf_dir):
    """Source counts against target counts that lack some orders and some schemas."""
    b = _tenants(spark, sf_dir)
    source = b.groupBy("schema_id").agg(F.count("*").alias("src_count"))
    target = b.where("pos % 10 <> 0 AND schema_id NOT IN ('s1', 's2')").groupBy("schema_id").agg(F.count("*").alias("tgt"))
    j = source.join(target, "schema_id", "left").withColumn("err", F.when(F.col("schema_id") == "s2", 1))
    j = j.withColumn("tgt_count", R.repaired_count(F.col("tgt"), F.col("err")))
    diff, pct = R.count_difference(F.col("src_count"), F.col("tgt_count"))
    return j.select("schema_id", "src_count", "tgt_count", diff.alias("diff"), F.round(pct, 6).alias("pct"))


def heartbeat_lag(spark, sf_dir):
    a = table(spark, sf_dir, "events").select(F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")).alias("remote_database"), F.col("event_type").alias("replicat"), "ts")
    idle = a.select("remote_database", F.lit("idle").alias("replicat")).distinct()
    expected = a.select("remote_database", "replicat").distinct().unionByName(idle)
    now = a.agg(F.max("ts").alias("now"))
    beats = a.where("NOT (remote_database = 's1' AND replicat = 'view')").select("remote_database", "replicat", "ts")
    out = R.heartbeat_lag(beats, expected.crossJoin(F.broadcast(now)), ["remote_database", "replicat"], "ts", F.col("now"), 300)  # one row
    return out.select("remote_database", "replicat", F.col("lag_seconds").cast("long").alias("lag_seconds"), "alert")


def replicat_pairing(spark, sf_dir):
    return R.duplicated(_tenants(spark, sf_dir), ["key"], "op_type").withColumnRenamed("n", "n_replicats")


def ambiguous_schema(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.floor("c_acctbal").cast("string").alias("src_schema"), F.col("c_mktsegment").alias("src_db"))
    return R.duplicated(c, ["src_schema"], "src_db").withColumnRenamed("n", "n_dbs")


def tenant_rollup(spark, sf_dir):
    """Client counts to schema and then to region names."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    dims = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", join_name("r_name", "n_name").alias("name"))
    return o.join(c, "c_custkey").join(dims, "n_nationkey").groupBy("name").agg(F.sum("n").alias("n_rows"))


def active_tenant_counts(spark, sf_dir):
    """Live and archived counts of active tenants only; tenants listed twice count once."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    active = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")).unionByName(c.where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))).distinct()
    kept = o.join(active, "o_custkey", "left_semi")
    arch = F.sum(F.coalesce(F.when(F.col("o_orderstatus") == "F", F.lit(1)), F.lit(0)))
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("n_rows"), arch.alias("n_archived"))


def purge_threshold(spark, sf_dir):
    """Rows at or above their tenant's own threshold."""
    limits = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") * 20).alias("least"))
    kept = table(spark, sf_dir, "orders").join(limits, "o_custkey").where("o_totalprice >= least")
    return kept.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def tenant_mapping_union(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    a = n.select(F.lower("n_name").alias("tenant"), s("n_regionkey").alias("schema_id"))
    b = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.lower("n_name").alias("tenant"), s("r_regionkey").alias("schema_id"))
    c = r.select(F.lower("r_name").alias("tenant"), s("r_regionkey").alias("schema_id"))
    return a.union(b).union(c).distinct()


def tenant_predicate(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 9 != 0, s("user_id")).otherwise("x1").alias("org"), F.when(F.col("event_id") % 4 != 0, s("user_id")).alias("client"))
    return e.withColumn("valid", tenant_valid("org", "client")).groupBy("valid").agg(F.count("*").alias("n"))


def active_tenant_mapping(spark, sf_dir):
    """Service names to database and tenant: prefix before -svc1, numeric tenants only."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("DB"), s("c_nationkey"), F.lit("-svc1.example")).alias("service"), F.when(F.col("c_custkey") % 6 == 0, F.lit("none")).otherwise((F.col("c_custkey") % 100).cast("string")).alias("tenant"))
    return c.where(F.col("tenant").rlike("^[0-9]+$")).select(F.lower(F.element_at(F.split("service", "-svc1"), 1)).alias("db"), "tenant").distinct()


def priority_tables(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lower("p_name").alias("name"), "p_partkey")
    wanted = p.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(5).select("name")
    return p.join(F.broadcast(wanted), "name").select("p_partkey", "name")  # five names


def document_extract(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(s("event_id").alias("document_id"), F.parse_json("props").alias("document"), "ts")
    d = documents_between(e, "ts", "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return d.select("document_id", F.variant_get("document", "$.k", "bigint").alias("k"))


def extract_watermark(spark, sf_dir):
    """Two bounded extracts in a row; the state keeps the last time seen."""
    e = table(spark, sf_dir, "events")
    _, first = extract_increment(e.where("ts < timestamp_ntz '2024-01-12 00:00:00'"), None, "ts", "events")
    rows, second = extract_increment(e, first, "ts", "events")
    return rows.groupBy("event_type").agg(F.count("*").alias("n")).crossJoin(F.broadcast(second.select("watermark")))  # one row


def max_lob_kib(spark, sf_dir):
    return R.large_object_kib(table(spark, sf_dir, "documents"), ["text", "source"])


def data_compare_by_hash(spark, sf_dir):
    """Two copies that differ in rows, in a value, in where one value ends and the next begins, and in a null."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    mine = o.where("o_orderkey % 100 <> 9").withColumn("tag", F.when(k % 100 == 21, F.concat("o_orderstatus", F.lit("|x"))).when(k % 100 == 31, None).otherwise("y")).withColumn("note", F.lit("z"))
    copy = o.where("o_orderkey % 100 <> 7").withColumn("o_orderstatus", F.when(k % 50 == 3, "X").otherwise(F.col("o_orderstatus")))
    copy = copy.withColumn("tag", F.when(k % 100 == 21, F.col("o_orderstatus")).when(k % 100 == 31, "~").otherwise("y")).withColumn("note", F.when(k % 100 == 21, "x|z").otherwise("z"))
    return R.compare_by_hash(mine, copy, ["o_orderkey"], ["o_custkey", "o_orderstatus", "tag", "note"])


def multi_table_counts(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    names = {"orders": t("orders").select(F.col("o_orderstatus").alias("g")), "lineitem": t("lineitem").select(F.col("l_returnflag").alias("g")), "events": t("events").select(F.col("event_type").alias("g"))}
    return R.count_tables(names, "g")


def multi_table_counts_apart(spark, sf_dir):
    """Counts of four tables, of which one does not exist and one has other columns."""
    t = lambda n, c: lambda: table(spark, sf_dir, n).select(F.col(c).alias("g"))
    return R.count_tables_apart(spark, {"orders": t("orders", "o_orderstatus"), "absent": t("absent", "x"), "part": t("part", "no_such_column"), "events": t("events", "event_type")}, "g")


def unexpected_errors(spark, sf_dir):
    """Error rows of a run, missing tables aside."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_type") == "error").cast("int").alias("is_error"), F.when(F.col("event_id") % 3 == 0, "table does not exist").when(F.col("event_id") % 3 == 1, "timeout").alias("message"))
    return R.unexpected_errors(e).groupBy("message").agg(F.count("*").alias("n"))


def fan_out_scan(spark, sf_dir):
    """The same catalog of two databases, restricted to wanted names."""
    n = table(spark, sf_dir, "nation")
    out = fan_out({"db1": n, "db2": n.where("n_nationkey > 5")}, ["NATION_3", "NATION_7", "NATION_11"], "n_name")
    return out.select("n_name", "src_db")


def recent_partitions(spark, sf_dir):
    """Month predicate across a year's end."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return o.where(recent_months("y", "m", 1997, 11)).groupBy("y").agg(F.count("*").alias("n"))


def name_resolution(spark, sf_dir):
    """Ids to names, left joined; unknown ids stay null."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 3).alias("id"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), join_name(F.lit("db"), "n_name").alias("name"))
    return c.join(n, "id", "left").groupBy("name").agg(F.count("*").alias("n"))


def latest_archive_count(spark, sf_dir):
    a = table(spark, sf_dir, "events").withColumn("s4", F.col("user_id") % 4)
    return R.with_latest(a, ["s4", "event_type"], "event_id", ["value"]).select("s4", "event_type", "event_id", "value")


def table_inventory(spark, sf_dir):
    """Validation inventory: tables with an active flow, minus inactive schemas, with a free-text condition applied."""
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("table"), s("c_nationkey").alias("schema_id"), "c_acctbal").distinct()
    inactive = F.array(F.lit("3"), F.lit("7"))
    kept = c.where(~F.array_contains(inactive, F.col("schema_id"))).where(F.expr("c_acctbal > 100"))
    return kept.groupBy("table", "schema_id").agg(F.count("*").alias("n"))


def tenant_column(spark, sf_dir):
    """Does a table have the tenant column?"""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(F.max(F.col("l_partkey") % 20 == 0).alias("has_tenant"))


QUERIES = [
    (live_count_by_schema, SQL_B + "z AS (SELECT 1) SELECT schema_id, CAST(sum(CASE WHEN op_type = 'D' THEN 0 ELSE 1 END) AS BIGINT) AS live_rows, max(op_ts) AS max_op_ts FROM f GROUP BY schema_id"),
    (distinct_key_count, "WITH d AS (SELECT DISTINCT l_returnflag AS flag, CASE WHEN l_partkey % 5 <> 0 THEN l_partkey % 50 END AS part, l_linenumber FROM lineitem) SELECT flag, count(*) AS n_keys FROM d GROUP BY flag"),
    (inflight_count, SQL_A + """c AS (SELECT schema_id, max(ts) - INTERVAL 3 DAY AS cursor FROM a WHERE event_id % 2 = 0 AND schema_id <> 's3' GROUP BY 1)
SELECT a.schema_id, CAST(sum(CASE WHEN ts <= coalesce(cursor, TIMESTAMP '1970-01-01') THEN 0 WHEN op_type = 'I' THEN 1 WHEN op_type = 'D' THEN -1 ELSE 0 END) AS BIGINT) AS in_flight FROM a LEFT JOIN c ON a.schema_id = c.schema_id GROUP BY 1"""),
    (count_diff_pct, SQL_B + """a AS (SELECT schema_id, count(*) AS src_count FROM f GROUP BY 1), t AS (SELECT schema_id, count(*) AS tgt FROM f WHERE pos % 10 <> 0 AND schema_id NOT IN ('s1', 's2') GROUP BY 1),
j AS (SELECT a.schema_id, src_count, CASE WHEN a.schema_id = 's2' THEN tgt ELSE coalesce(tgt, 0) END AS tgt_count FROM a LEFT JOIN t ON a.schema_id = t.schema_id)
SELECT schema_id, src_count, tgt_count, src_count - tgt_count AS diff, round(CASE WHEN tgt_count IS NOT NULL THEN abs(src_count - tgt_count) * 100.0 / CAST(src_count AS DOUBLE) END, 6) AS pct FROM j"""),
    (heartbeat_lag, """
WITH a AS (SELECT 's' || user_id % 4 AS remote_database, event_type AS replicat, ts FROM events), x AS (SELECT DISTINCT remote_database, replicat FROM a UNION SELECT DISTINCT remote_database, 'idle' FROM a),
l AS (SELECT remote_database, replicat, max(ts) AS t FROM a WHERE NOT (remote_database = 's1' AND replicat = 'view') GROUP BY 1, 2),
d AS (SELECT x.*, CAST(floor((epoch_us((SELECT max(ts) FROM a)) - epoch_us(t)) / 1000000.0) AS BIGINT) AS lag_seconds FROM x LEFT JOIN l ON x.remote_database = l.remote_database AND x.replicat = l.replicat)
SELECT *, CASE WHEN lag_seconds IS NULL OR lag_seconds > 300 THEN 1 ELSE 0 END AS alert FROM d"""),
    (replicat_pairing, SQL_B + "z AS (SELECT 1) SELECT key, count(DISTINCT op_type) AS n_replicats FROM f GROUP BY key HAVING count(DISTINCT op_type) > 1"),
    (ambiguous_schema, "SELECT CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS src_schema, count(DISTINCT c_mktsegment) AS n_dbs FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1"),
    (tenant_rollup, "SELECT lower(r_name || '.' || n_name) AS name, count(*) AS n_rows FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1"),
    (active_tenant_counts, "SELECT o_orderpriority, count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_archived FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1"),
    (purge_threshold, "SELECT o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= c_acctbal * 20 GROUP BY 1"),
    (tenant_mapping_union, "SELECT lower(n_name) AS tenant, CAST(n_regionkey AS VARCHAR) AS schema_id FROM nation UNION SELECT lower(n_name), CAST(r_regionkey AS VARCHAR) FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT lower(r_name), CAST(r_regionkey AS VARCHAR) FROM region"),
    (tenant_predicate, "SELECT event_id % 9 <> 0 AND event_id % 4 <> 0 AND user_id <> 0 AS valid, count(*) AS n FROM events GROUP BY 1"),
    (active_tenant_mapping, "SELECT DISTINCT 'db' || c_nationkey AS db, CAST(c_custkey % 100 AS VARCHAR) AS tenant FROM customer WHERE c_custkey % 6 <> 0"),
    (priority_tables, "WITH w AS (SELECT lower(p_name) AS name FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) SELECT p_partkey, lower(p_name) AS name FROM part WHERE lower(p_name) IN (SELECT name FROM w)"),
    (document_extract, "SELECT CAST(event_id AS VARCHAR) AS document_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE ts > TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'"),
    (extract_watermark, "WITH m AS (SELECT max(ts) AS t FROM events WHERE ts < TIMESTAMP '2024-01-12') SELECT event_type, count(*) AS n, (SELECT max(ts) FROM events) AS watermark FROM events, m WHERE ts > t GROUP BY event_type"),
    (max_lob_kib, "SELECT CAST(greatest(ceil(greatest(max(strlen(text)), max(strlen(source))) / 1024.0), 5) AS BIGINT) AS max_lob_kib FROM documents"),
    (data_compare_by_hash, "SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 9 THEN 'missing_left' WHEN o_orderkey % 100 = 7 THEN 'missing_right' ELSE 'different' END AS verdict FROM orders WHERE o_orderkey % 100 IN (7, 9, 21, 31) OR (o_orderkey % 50 = 3 AND o_orderstatus <> 'X')"),
    (multi_table_counts, "SELECT 'orders' AS table_name, o_orderstatus AS group_id, count(*) AS n_rows FROM orders GROUP BY 2 UNION ALL SELECT 'lineitem', l_returnflag, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY 2"),
    (multi_table_counts_apart, "SELECT 'orders' AS table_name, o_orderstatus AS group_id, count(*) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM orders GROUP BY 2 UNION ALL SELECT 'events', event_type, count(*), NULL FROM events GROUP BY 2 UNION ALL SELECT 'absent', NULL, NULL, 'PATH_NOT_FOUND' UNION ALL SELECT 'part', NULL, NULL, 'UNRESOLVED_COLUMN.WITH_SUGGESTION'"),
    (unexpected_errors, "SELECT CASE WHEN event_id % 3 = 1 THEN 'timeout' END AS message, count(*) AS n FROM events WHERE event_type = 'error' AND event_id % 3 <> 0 GROUP BY 1"),
    (fan_out_scan, "SELECT n_name, 'db1' AS src_db FROM nation WHERE n_name IN ('NATION_3', 'NATION_7', 'NATION_11') UNION ALL SELECT n_name, 'db2' FROM nation WHERE n_name IN ('NATION_7', 'NATION_11')"),
    (recent_partitions, "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) >= 199711 GROUP BY 1"),
    (name_resolution, "SELECT 'db.' || lower(n_name) AS name, count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey + 3 = n_nationkey GROUP BY 1"),
    (latest_archive_count, "SELECT user_id % 4 AS s4, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2"),
    (table_inventory, "WITH c AS (SELECT DISTINCT c_mktsegment, c_nationkey, c_acctbal FROM customer) SELECT c_mktsegment AS \"table\", CAST(c_nationkey AS VARCHAR) AS schema_id, count(*) AS n FROM c WHERE c_nationkey NOT IN (3, 7) AND c_acctbal > 100 GROUP BY 1, 2"),
    (tenant_column, "SELECT l_orderkey, max(l_partkey % 20 = 0) AS has_tenant FROM lineitem GROUP BY 1"),
]
