"""Exactly-once upserts on plain partitioned files: change pieces that are aggregated when read, and a ledger of batches."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline import storage
from tideline.operators.changes import apply_changes, carry_forward, current_state, merged
from tideline.types import COMPLETED_BATCH

#: Folders by hash of key in every piece, pieces that start_apply leaves before it compacts, commits that stay for change streams.
BUCKETS, PIECES, KEEP = 16, 32, 1000


class Piece(NamedTuple):
    commit: int
    run: str
    batch: str
    path: str


class ChangePieces:
    """Current state as files: changes/commit=<n>/run=<run>/batch=<batch>/bucket=<hash of key> and base/bucket=<b>/upto=<n>.

    A batch adds one piece, its latest row of each key, under the next commit number, and reads nothing. The state is the
    latest row of each key over the bases and the pieces that came after them, whatever their order, so a piece that a replay
    under another run repeats changes nothing. Pieces and bases are written aside and renamed when finished: what is there is whole, and there is no
    other file that could be lost. One writer at a time gives commits their numbers. `schema`, if given, spares reading file footers.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sequence: str, buckets: int = BUCKETS, schema: T.StructType | None = None):
        self.spark, self.path, self.keys, self.sequence, self.buckets, self.schema = spark, path, keys, sequence, buckets, schema

    def _aside(self, state: DataFrame) -> str:
        """Rows by bucket in a folder that no reader sees."""
        path = f"{self.path}/staging/{uuid.uuid4().hex}"
        state.withColumn("bucket", F.pmod(F.hash(*self.keys), self.buckets)).write.partitionBy("bucket").parquet(path)
        return path

    def pieces(self) -> list[Piece]:
        """Finished pieces by commit."""
        named = [re.search(r"commit=(\d+)/run=([^/]+)/batch=([^/]+)$", p) for p in storage.found(self.spark, f"{self.path}/changes/commit=*/run=*/batch=*")]
        return sorted(Piece(int(m[1]), m[2], m[3], m.string) for m in named)

    def bases(self) -> list[tuple[int, int, str]]:
        """(bucket, last commit that it holds, folder) of every base."""
        named = [re.search(r"bucket=(\d+)/upto=(\d+)$", p) for p in storage.found(self.spark, f"{self.path}/base/bucket=*/upto=*")]
        return sorted((int(m[1]), int(m[2]), m.string) for m in named)

    def last_commit(self) -> int:
        return max([p.commit for p in self.pieces()] + [n for _, n, _ in self.bases()], default=0)

    def append(self, run: str, batch_id: int | str, changes: DataFrame) -> int:
        """Add a batch's changes; returns its commit. A batch whose piece is there (written by a driver that was lost before it could
        say so) is left as it is."""
        if not re.fullmatch(r"[\w.-]+", run):
            raise ValueError(f"run {run!r} is no folder name")
        for p in self.pieces():
            if (p.run, p.batch) == (run, str(batch_id)):
                return p.commit
        aside, n = self._aside(apply_changes(changes, self.keys, self.sequence)), self.last_commit() + 1
        storage.move(self.spark, aside, f"{self.path}/changes/commit={n}/run={run}/batch={batch_id}")
        return n

    def _files(self, root: str, paths: list[str], more: str) -> DataFrame:
        reader = self.spark.read.option("basePath", f"{self.path}/{root}")
        reader = reader.option("mergeSchema", "true") if self.schema is None else reader.schema(T.StructType(self.schema.fields + T.StructType.fromDDL(more).fields))
        return reader.parquet(*paths)

    def rows(self, pieces: list[Piece]) -> DataFrame | None:
        """All rows of some pieces, with commit, run, batch and bucket."""
        return self._files("changes", [p.path for p in pieces], "commit int, run string, batch string, bucket int") if pieces else None

    def read(self, until: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """State with tombstones, as of a commit if given, of some buckets if given; None before the first piece."""
        last = self.last_commit() if until is None else until
        wanted = range(self.buckets) if buckets is None else buckets
        held = {b: (n, path) for b, n, path in self.bases() if n <= last and b in wanted}  # the largest of each bucket
        upto = [held[b][0] if b in held else 0 for b in range(self.buckets)]
        low = min(upto[b] for b in wanted)
        new = [p for p in self.pieces() if low < p.commit <= last]
        if until is not None and {p.commit for p in new} != set(range(low + 1, last + 1)):
            raise ValueError(f"commits {low + 1} to {last} of {self.path} are not all there")
        frames = []
        old = [path for _, path in held.values() if storage.found(self.spark, f"{path}/*.parquet")]
        if old:
            frames.append(self._files("base", old, "bucket int, upto int").drop("upto"))
        if new:
            after = F.element_at(F.array(*map(F.lit, upto)), F.col("bucket") + 1)
            frames.append(self.rows(new).where((F.col("commit") > after) & F.col("bucket").isin(*wanted)).drop("commit", "run", "batch"))
        if not frames:
            return None
        rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)
        return merged(rows.drop("bucket"), self.keys, self.sequence)

    def compact(self, buckets: list[int] | None = None) -> None:
        """A new base for some buckets (all if not given). Pieces and older bases stay until vacuum(), so a loss at any
        point leaves a whole table, and change streams see no row of a base."""
        wanted, last = list(range(self.buckets)) if buckets is None else buckets, self.last_commit()
        state, there = self.read(buckets=wanted), {(b, n) for b, n, _ in self.bases()}
        if state is None:
            return
        aside = self._aside(state)
        for b in wanted:
            if (b, last) in there:
                continue
            if storage.exists(self.spark, f"{aside}/bucket={b}"):
                storage.move(self.spark, f"{aside}/bucket={b}", f"{self.path}/base/bucket={b}/upto={last}")
            else:
                storage.make_folder(self.spark, f"{self.path}/base/bucket={b}/upto={last}")
        storage.delete(self.spark, aside)

    def vacuum(self, keep: int = KEEP) -> None:
        """Remove bases that newer ones replace, and pieces that all bases hold, but for the last `keep` commits."""
        bases = self.bases()
        newest = {b: n for b, n, _ in bases}
        for b, n, path in bases:
            if n < newest[b]:
                storage.delete(self.spark, path)
        held = min((newest.get(b, 0) for b in range(self.buckets)), default=0)
        for p in self.pieces():
            if p.commit <= min(held, self.last_commit() - keep):
                storage.delete(self.spark, p.path.rsplit("/", 2)[0])


class BatchLedger:
    """Completed batches, partitioned by month, by the query id that their checkpoint holds: a run that is resumed finds its
    batches, another one, which counts from 0 again, does not. A batch is looked up in its month and the one before, so a replay just after
    a month's end is still known."""

    def __init__(self, spark: SparkSession, path: str, app: str, stream: str):
        self.spark, self.path, self.app, self.stream = spark, path, app, stream

    def done(self, query_id: str, batch_id: int, yyyymm: int) -> bool:
        before = yyyymm - 1 if yyyymm % 100 > 1 else yyyymm - 89
        if not storage.exists(self.spark, f"{self.path}/rows"):
            return False
        rows = self.spark.read.schema(COMPLETED_BATCH).parquet(f"{self.path}/rows").where(F.col("yyyymm").isin(yyyymm, before))
        return not rows.where((F.col("app") == self.app) & (F.col("stream_name") == self.stream) & (F.col("streaming_query_id") == query_id) & (F.col("batch_id") == str(batch_id))).isEmpty()

    def log(self, query_id: str, batch_id: int, yyyymm: int) -> None:
        row = self.spark.range(1).select(F.lit(self.app).alias("app"), F.lit(self.stream).alias("stream_name"), F.lit(query_id).alias("streaming_query_id"), F.lit(str(batch_id)).alias("batch_id"), F.current_timestamp().alias("completed_at"), F.lit(yyyymm).cast("int").alias("yyyymm"))
        row.write.mode("append").partitionBy("yyyymm").parquet(f"{self.path}/rows")


def change_feed(table: ChangePieces, start: int, end: int | None = None, live: str = "__DeleteVersion IS NULL") -> DataFrame:
    """Changes that the commits from `start` to `end` (the last one if not given) make together to the live rows before them:
    _change_type (insert, delete, update_preimage, update_postimage) and _commit_version, the commit of the change. Only keys of these
    commits are compared, by a hash of their content."""
    keys, end = table.keys, table.last_commit() if end is None else end
    added = table.rows([p for p in table.pieces() if start <= p.commit <= end])
    if added is None:
        raise ValueError(f"no commit from {start} to {end}")
    touched = added.groupBy(*keys).agg(F.max("commit").cast("bigint").alias("_commit_version"))
    new = merged(added.drop("commit", "run", "batch", "bucket"), keys, table.sequence)
    old = table.read(start - 1) if start > 1 else None
    old = new.limit(0) if old is None else old.join(touched, keys, "left_semi")
    rest = [c for c in new.columns if c not in keys]
    side = lambda state, n: state.where(live).select(*keys, F.struct(*rest).alias(n), F.xxhash64(*rest).alias(f"{n}_hash"))
    both = side(old, "old").join(side(merged(old.unionByName(new), keys, table.sequence), "new"), keys, "full").where("NOT (old_hash <=> new_hash)")
    row = lambda kind, image: F.struct(F.lit(kind).alias("_change_type"), F.col(image).alias("image"))
    rows = F.when(F.col("old").isNull(), F.array(row("insert", "new"))).when(F.col("new").isNull(), F.array(row("delete", "old"))).otherwise(F.array(row("update_preimage", "old"), row("update_postimage", "new")))
    out = both.join(touched, keys).select(*keys, "_commit_version", F.explode(rows).alias("r"))
    return out.select(*keys, "r.image.*", "r._change_type", "_commit_version")


def change_stream(table: ChangePieces, start: int = 1, files: int = 1000, size: int | None = None) -> DataFrame:
    """Stream of the changes from a commit on, as they come: the latest change of each key in each commit, deletes as tombstones,
    with _commit_version. It reads finished pieces only, and no base, so compaction adds no row.

    What a trigger takes is limited by files, or by size (bytes) if given. The table needs a piece or a declared schema.
    """
    pieces = table.pieces()
    if table.schema is None and not pieces:
        raise ValueError("a change stream of an empty table needs the table's schema")
    shape = table.rows(pieces).schema if pieces else T.StructType(table.schema.fields + T.StructType.fromDDL("commit int, run string, batch string, bucket int").fields)
    reader = table.spark.readStream.schema(shape).options(**({"maxBytesPerTrigger": str(size)} if size else {"maxFilesPerTrigger": str(files)}))
    storage.make_folder(table.spark, f"{table.path}/changes")
    out = reader.parquet(f"{table.path}/changes").where(F.col("commit") >= start)
    return out.withColumn("_commit_version", F.col("commit").cast("bigint")).drop("commit", "run", "batch", "bucket")


def this_month() -> int:
    now = datetime.now(timezone.utc)
    return now.year * 100 + now.month


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps over its restarts, from its checkpoint."""
    return json.loads(storage.read_text(spark, f"{checkpoint}/metadata"))["id"]


def enriched(changes: DataFrame, target: ChangePieces, columns: list[str], reset: Column | None = None) -> DataFrame:
    """Changes of one batch with their null large values filled: from earlier changes of the batch, else from the table's live row
    of the key, read anew. Only rows of the batch's keys leave the table's scan."""
    state = target.read()
    live = None if state is None else current_state(state).join(changes.select(*target.keys).distinct(), target.keys, "left_semi")
    return carry_forward(changes, target.keys, target.sequence, columns, live, reset=reset)


def start_apply(changes: DataFrame, target: ChangePieces, checkpoint: str, name: str = "apply", ledger: BatchLedger | None = None, month: Callable[[], int] = this_month, trigger: dict | None = None, carry: list[str] | None = None, reset: Column | None = None, compact_after: int = PIECES):
    """Stream of change rows into a table. The default trigger drains what is there and stops; {"processingTime": ...} keeps on.

    Pieces and ledger rows carry the checkpoint's query id, so batches of another run, which count from 0 again, are batches
    of their own. Batches without rows do nothing; a batch that the ledger has (by the month it is done in) is passed over; one that
    was written but not logged is only logged. `carry` names large values that a change may lack: each batch takes them from the
    table as it stands (`enriched`), not across a change where `reset` holds. Beyond `compact_after` pieces the table is compacted.
    """
    spark = target.spark

    def batch(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        run, yyyymm = query_id(spark, checkpoint), month()
        if ledger and ledger.done(run, batch_id, yyyymm):
            return
        target.append(run, batch_id, enriched(df, target, carry, reset) if carry else df)
        if ledger:
            ledger.log(run, batch_id, yyyymm)
        held = {b: n for b, n, _ in target.bases()}
        if sum(p.commit > min(held.values(), default=0) for p in target.pieces()) > compact_after:
            target.compact()
            target.vacuum()

    return changes.writeStream.foreachBatch(batch).queryName(name).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def replay_from(changes: DataFrame, stamp: str, start: str, target: ChangePieces, root: str, **options):
    """start_apply over the changes at or after a start timestamp: another start replays under a checkpoint of its own."""
    return start_apply(changes.where(F.col(stamp) >= F.lit(start).cast(changes.schema[stamp].dataType)), target, replay_checkpoint(root, start), **options)


def fork_batches(stream: DataFrame, active: str, inactive: str, checkpoint: str, partitions: list[str], records: int = 1_000_000, flag: str = "is_active_event"):
    """One stream, two partitioned append tables: rows of active and of inactive events. A batch of a run (the checkpoint's
    query id) has its own folder in each, so a repeated batch replaces its files and another run's are left alone."""
    spark = stream.sparkSession

    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        for path, rows in ((active, df.where(flag)), (inactive, df.where(f"NOT {flag}"))):
            rows.write.mode("overwrite").option("maxRecordsPerFile", records).partitionBy(*partitions).parquet(f"{path}/run={query_id(spark, checkpoint)}/batch={batch_id}")
        df.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replay_checkpoint(root: str, start: str) -> str:
    """Checkpoint folder of a start timestamp: another start replays, the same one resumes."""
    if not re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", start):
        raise ValueError(f"start timestamp {start!r} is not yyyy-MM-dd HH:mm:ss")
    return f"{root}/start={start.replace(' ', 'T').replace(':', '')}"


def extract_increment(docs: DataFrame, state: DataFrame | None, stamp: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(documents after the stored watermark, new state row); an empty extract leaves the watermark."""
    mark = None if state is None else state.where(F.col("name") == name).agg(F.max("watermark")).first()[0]
    rows = docs if mark is None else docs.where(F.col(stamp) > F.lit(mark))
    new = rows.agg(F.coalesce(F.max(stamp), F.lit(mark)).alias("watermark")).select(F.lit(name).alias("name"), "watermark")
    return rows, new


def run_extract(docs: DataFrame, path: str, stamp: str, name: str, sink: Callable[[DataFrame], None]) -> None:
    """One bounded extract with its watermark stored under path: the documents go to `sink`, and the watermark is appended after
    that, so a lost run is repeated. The largest stored watermark counts."""
    spark = docs.sparkSession
    state = spark.read.parquet(f"{path}/watermarks") if storage.exists(spark, f"{path}/watermarks") else None
    rows, new = extract_increment(docs, state, stamp, name)
    sink(rows)
    new.where("watermark IS NOT NULL").write.mode("append").parquet(f"{path}/watermarks")


def send_retries(retries: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Records to be tried again, back into the files that the change stream reads; a repeated batch of a run replaces its own."""
    retries.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")
