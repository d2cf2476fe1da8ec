"""The corpus pipeline: five of the training-data operators one after another over `documents`.

Each stage works on all rows that its predecessor kept. The domains and labels that classifiers learn from are those of
the labels table; a stage's texts are the ones it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import mixing, nearcopies, packing, queries, repeats, toxicity
from tideline.llm.common import Stash, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below 0.7. Null and empty texts are scored by the model's bias, rows are judged each, rows
    without a doc_id are judged but not learnt from; an empty table stays empty, columns besides COLUMNS are dropped."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    scored = toxicity.score(docs.select(F.struct(*COLUMNS).alias("row"), "text"), model, "row")
    return scored.where("score < 0.7").select(*[f"id.{c}" for c in COLUMNS])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts linked at a Jaccard similarity of 0.8 of five-word shingles: the one with the smallest
    doc_id, and of rows alike in doc_id and text one. Rows are told apart by doc_id and text, so different texts under one
    doc_id are judged each; rows without a doc_id stay; null texts are empty and copies of each other."""
    found = nearcopies.near_copies(docs).where("kept").select("id", F.col("k").alias("near_key")).distinct()
    keyed = docs.select(*COLUMNS).withColumn("near_key", nearcopies.near_key("doc_id", "text"))
    kept = keyed.join(found, (F.col("id") == F.col("doc_id").cast("long")) & (keyed["near_key"] == found["near_key"])).select(keyed["near_key"], *COLUMNS)
    return kept.dropDuplicates(["doc_id", "near_key"]).select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without the bytes that repeated 200-byte strings cover, a row for each row; characters that a removed run cuts
    through go with it. Rows alike in all columns repeat each other's strings; null texts become empty, short ones stay."""
    out = repeats.remove_repeats(docs.select(*COLUMNS), as_text=True)
    return out.select("row.doc_id", F.col("kept").alias("text"), "row.lang", "row.source", F.length("kept").cast("long").alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate says: the whole part, and once more by the hash of its id for the fraction (rows of one
    doc_id alike; rows without one share a hash). Texts without words get their rate by their posteriors; an empty table stays empty."""
    rows = docs.select(F.struct(*COLUMNS).alias("row"), "text", "doc_id")
    out = mixing.mix(rows, table(spark, sf_dir, "labels"), row_col="row")
    times = out.withColumn("n", mixing.copies("rate", "row.doc_id"))
    return times.where("n > 0").select("row", F.explode(F.sequence(F.lit(1), "n"))).select(*[f"row.{c}" for c in COLUMNS])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048; copies of a document are told apart by row_in_task within their task. A null or empty text is
    its end id alone, a null doc_id stays null, an empty table gives no pieces."""
    return packing.pack(docs, queries.vocabulary())


STAGES = [("toxicity", toxicity_stage), ("simhash", simhash_stage), ("repeats", repeats_stage), ("mixing", mixing_stage), ("packing", packing_stage)]
#: No SQL expresses these stages; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    stash, docs = Stash(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stash.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
