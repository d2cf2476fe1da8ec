"""Change feeds derived from the shared tables, in Spark and as SQL text for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.images import UNCHANGED
from tideline.types import shape


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


IMAGE = shape(key=T.LongType(), amount=T.DoubleType(), note=T.StringType())


def event_feed(events: DataFrame) -> DataFrame:
    """Change log of accounts from `events`: before and after images are JSON texts of strings."""
    k = F.get_json_object("props", "$.k").cast("long")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    e = events.select("*", k.alias("k"), op.alias("op_type"), F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")).alias("schema_id"))
    new_key = F.when((F.col("op_type") == "U") & (F.col("k") % 10 == 0), F.col("user_id") + 1000).otherwise(F.col("user_id"))
    plain = F.concat(F.lit("n"), F.col("k").cast("string"))
    note = F.when(F.col("event_type") == "view", None).when((F.col("event_type") == "click") & (F.col("k") % 7 == 0), UNCHANGED).otherwise(plain)
    image = lambda key, n: F.to_json(F.struct(key.cast("string").alias("key"), F.col("value").cast("string").alias("amount"), n.alias("note")))
    return e.select(
        "event_id", "user_id", "ts", "event_type", "k", "op_type", "schema_id",
        F.lit("accounts").alias("src_table"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("csn"),
        F.col("event_id").alias("pos"),
        F.col("value").alias("amount"),
        new_key.alias("new_key"),
        (F.col("k") % 4).alias("schema_fingerprint"),
        F.when(F.col("op_type") != "I", image(F.col("user_id"), plain)).alias("before"),
        F.when(F.col("op_type") != "D", image(new_key, note)).alias("after"),
    )


#: Feed A as relations: a (events), s (after the key-change split).
SQL_A = """
WITH a AS (
  SELECT event_id, user_id, ts, event_type, value AS amount, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op_type,
         's' || (user_id % 4) AS schema_id, epoch_us(ts) AS csn, event_id AS pos
  FROM events),
b AS (
  SELECT *, CASE WHEN op_type = 'U' AND k % 10 = 0 THEN user_id + 1000 ELSE user_id END AS new_key,
         'n' || k AS old_note,
         CASE WHEN event_type = 'view' THEN NULL
              WHEN event_type = 'click' AND k % 7 = 0 THEN 'unchanged-toast-datum' ELSE 'n' || k END AS raw_note
  FROM a),
s AS (
  SELECT event_id, schema_id, csn, pos, amount, ts, user_id AS key, old_note AS note, 'D' AS op, 0 AS pk_rank, TRUE AS is_pk
  FROM b WHERE op_type = 'U' AND new_key <> user_id
  UNION ALL
  SELECT event_id, schema_id, csn, pos, amount, ts, new_key, raw_note, 'I', 1, TRUE FROM b WHERE op_type = 'U' AND new_key <> user_id
  UNION ALL
  SELECT event_id, schema_id, csn, pos, amount, ts, CASE WHEN op_type = 'D' THEN user_id ELSE new_key END,
         CASE WHEN op_type = 'D' THEN old_note ELSE raw_note END, op_type, 0, FALSE
  FROM b WHERE NOT (op_type = 'U' AND new_key <> user_id)),
"""


def tenant_feed(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Tenant change log from orders and customers."""
    o = orders.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    op = F.when(F.col("o_orderstatus") == "O", "I").when(F.col("o_orderstatus") == "P", "U").otherwise("D")
    return o.select(F.col("o_custkey").alias("key"), F.concat(F.lit("s"), F.col("c_nationkey").cast("string")).alias("schema_id"), F.col("o_orderdate").alias("op_ts"), F.col("o_orderkey").alias("pos"), op.alias("op_type"), F.col("o_totalprice").alias("amount"))


SQL_B = """
WITH f AS (
  SELECT o_custkey AS key, 's' || c_nationkey AS schema_id, o_orderdate AS op_ts, o_orderkey AS pos,
         CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'U' ELSE 'D' END AS op_type, o_totalprice AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey),
"""
