"""Order, splits, replays and ledgers of the apply stream."""

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import changes as C
from tideline.operators import metadata, reconcile
from tideline.plans import cdc
from tideline.sources import readers
from tideline import storage
from tideline.streaming.apply import BatchLedger, ChangePieces, change_feed, change_stream, extract_increment, replay_checkpoint, replay_from, run_extract, send_retries, start_apply, this_month


def state(df):
    return sorted(tuple(map(str, r)) for r in cdc.flat(C.current_state(df)).collect())


@pytest.fixture(scope="module")
def feed(spark, sf):
    df = cdc.changes(cdc.feed(spark, sf)).persist()
    df.count()
    return df


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_split(spark, feed, seed):
    r = random.Random(seed)
    want = state(C.apply_changes(feed, cdc.KEYS, "__cdc_sequencer"))
    n, table = r.randint(2, 4), None
    for part in r.sample(range(n), n):
        table = C.apply_changes(feed.where((F.xxhash64("event_id") % n + n) % n == part), cdc.KEYS, "__cdc_sequencer", table)
    assert state(table) == want


THIRDS = ("event_id < 300", "event_id >= 300 AND event_id < 700", "event_id >= 700")


def pieces(spark, tmp_path, buckets=3):
    return ChangePieces(spark, str(tmp_path / "t"), cdc.KEYS, "__cdc_sequencer", buckets)


def test_replay_changes_nothing(spark, feed, tmp_path):
    t = pieces(spark, tmp_path)
    assert t.read() is None and t.compact() is None
    for batch, part in enumerate(THIRDS):
        assert t.append("a", batch, feed.where(part)) == batch + 1
        once = state(t.read())
        assert t.append("a", batch, feed.where(part)) == batch + 1  # written, not logged: left as it is
        assert state(t.read()) == once and len(t.pieces()) == batch + 1
    assert once == state(C.apply_changes(feed, cdc.KEYS, "__cdc_sequencer"))
    assert t.append("b", 0, feed.where(THIRDS[0])) == 4  # another checkpoint counts from 0 again
    assert state(t.read()) == once and len(t.pieces()) == 4
    t.compact([1])
    assert state(t.read()) == once
    t.compact()
    assert state(t.read()) == once and len(t.pieces()) == 4
    for n in (1, 2, 3):  # as of earlier commits, from the pieces
        want = C.apply_changes(feed.where(" OR ".join(f"({x})" for x in THIRDS[:n])), cdc.KEYS, "__cdc_sequencer")
        assert state(t.read(n)) == state(want)
    t.vacuum(keep=1)
    assert [p.commit for p in t.pieces()] == [4] and state(t.read()) == once
    with pytest.raises(ValueError):
        t.read(2)
    assert t.append("b", 1, feed.where(THIRDS[0])) == 5 and state(t.read()) == once
    with pytest.raises(ValueError):
        t.append("a/b", 0, feed)


def test_unfinished_piece_is_not_read(spark, feed, tmp_path, monkeypatch):
    """Files written aside and not renamed, as a lost driver leaves them, do not count; the retry writes the piece anew."""
    t = pieces(spark, tmp_path)
    t.append("a", 0, feed.where(THIRDS[0]))
    once = state(t.read())
    with monkeypatch.context() as m:
        m.setattr(storage, "move", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.append("a", 1, feed.where(THIRDS[1]))
    assert state(t.read()) == once
    assert t.append("a", 1, feed.where(THIRDS[1])) == 2
    assert state(t.read()) == state(C.apply_changes(feed.where(f"({THIRDS[0]}) OR ({THIRDS[1]})"), cdc.KEYS, "__cdc_sequencer"))


def test_lost_compaction(spark, feed, tmp_path, monkeypatch):
    """Lost between the bases of two buckets: the table is whole, and the next compaction ends the work."""
    t, move, done = pieces(spark, tmp_path), storage.move, []
    for batch, part in enumerate(THIRDS):
        t.append("a", batch, feed.where(part))
    once = state(t.read())
    with monkeypatch.context() as m:
        m.setattr(storage, "move", lambda *a: 1 / 0 if done else (done.append(1), move(*a)))
        with pytest.raises(ZeroDivisionError):
            t.compact()
    assert len(t.bases()) == 1 and state(t.read()) == once
    t.compact()
    assert len(t.bases()) == 3 and state(t.read()) == once


def test_pieces_of_different_columns(spark, feed, tmp_path):
    t = pieces(spark, tmp_path)
    t.append("a", 0, feed.where(THIRDS[0]))
    t.compact()
    t.append("a", 1, feed.where(THIRDS[1]).withColumn("extra", F.lit(1)))
    got = t.read()
    assert "extra" in got.columns and {r.extra for r in got.select("extra").distinct().collect()} == {None, 1}
    declared = ChangePieces(spark, t.path, t.keys, t.sequence, 3, schema=got.schema)
    assert state(declared.read()) == state(got)


def test_written_but_not_logged(spark, feed, tmp_path, monkeypatch):
    """A driver lost between a batch's piece and its ledger row: the resumed run logs the batch and writes nothing again."""
    feed.write.parquet(str(tmp_path / "in"))
    t, ledger = pieces(spark, tmp_path), BatchLedger(spark, str(tmp_path / "ledger"), "app", "s")
    start = lambda: start_apply(spark.readStream.schema(feed.schema).parquet(str(tmp_path / "in")), t, str(tmp_path / "c"), ledger=ledger).awaitTermination()
    with monkeypatch.context() as m:
        m.setattr(BatchLedger, "log", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError"):
            start()
    piece = t.pieces()
    assert len(piece) == 1 and not storage.exists(spark, str(tmp_path / "ledger"))
    start()
    assert t.pieces() == piece and ledger.done(piece[0].run, 0, this_month())


def test_compaction_on_the_way(spark, feed, tmp_path):
    for i, part in enumerate(THIRDS):
        feed.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    t = pieces(spark, tmp_path)
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    start_apply(stream, t, str(tmp_path / "c"), compact_after=1).awaitTermination()
    assert [p.commit for p in t.pieces()] == [1, 2, 3] and {n for _, n, _ in t.bases()} == {2}
    assert state(t.read()) == state(C.apply_changes(feed, cdc.KEYS, "__cdc_sequencer"))


def test_empty_batches_do_nothing(spark, feed, tmp_path):
    feed.limit(0).write.parquet(str(tmp_path / "in"))
    t, ledger = pieces(spark, tmp_path), BatchLedger(spark, str(tmp_path / "ledger"), "app", "s")
    stream = spark.readStream.schema(feed.schema).parquet(str(tmp_path / "in"))
    start_apply(stream, t, str(tmp_path / "c"), ledger=ledger).awaitTermination()
    assert t.pieces() == [] and not storage.exists(spark, str(tmp_path / "ledger"))


def test_replay_under_a_new_checkpoint(spark, feed, tmp_path):
    """A replay from an earlier start under the same ledger gives the whole state, though its batches count from 0 again; the
    ledger has each batch's own month, and a resumed run finds its batches."""
    feed.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(feed.schema).parquet(str(tmp_path / "in"))
    t, ledger = pieces(spark, tmp_path), BatchLedger(spark, str(tmp_path / "ledger"), "app", "s")
    run = lambda start, month: replay_from(stream(), "ts", start, t, str(tmp_path / "checkpoints"), ledger=ledger, month=lambda: month).awaitTermination()
    run("2024-01-20 00:00:00", 202312)
    late = state(t.read())
    first = t.pieces()[0].run
    assert ledger.done(first, 0, 202401) and not ledger.done(first, 0, 202311) and not ledger.done("apply", 0, 202312)
    run("2023-01-01 00:00:00", 202312)
    assert state(t.read()) == state(C.apply_changes(feed, cdc.KEYS, "__cdc_sequencer")) != late
    run("2023-01-01 00:00:00", 202401)
    assert len(t.pieces()) == 2


def test_trigger(spark, feed, tmp_path):
    feed.where(THIRDS[0]).write.parquet(str(tmp_path / "in"))
    t = pieces(spark, tmp_path)
    q = start_apply(spark.readStream.schema(feed.schema).parquet(str(tmp_path / "in")), t, str(tmp_path / "c"), trigger={"processingTime": "1 second"})
    q.processAllAvailable()
    q.stop()
    assert state(t.read()) == state(C.apply_changes(feed.where(THIRDS[0]), cdc.KEYS, "__cdc_sequencer"))


def test_change_stream(spark, feed, tmp_path):
    """Each commit's rows once, whatever was compacted between; from a later commit on, those alone."""
    t = pieces(spark, tmp_path)
    rows = lambda name: spark.read.parquet(str(tmp_path / name))
    follow = lambda name, start: change_stream(t, start).writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(availableNow=True).start().awaitTermination()
    with pytest.raises(ValueError):
        change_stream(t)
    for batch, part in enumerate(THIRDS):
        t.append("a", batch, feed.where(part))
        follow("all", 1)
        t.compact()
        follow("all", 1)
        assert rows("all").count() == t.rows(t.pieces()).count() and rows("all").where(f"_commit_version = {batch + 1}").count() > 0
    follow("late", 3)
    assert rows("late").count() == t.rows(t.pieces()[2:]).count() and [r[0] for r in rows("late").select("_commit_version").distinct().collect()] == [3]


def test_change_stream_of_an_empty_table(spark, feed, tmp_path):
    shape = C.apply_changes(feed.limit(0), cdc.KEYS, "__cdc_sequencer").schema
    t = ChangePieces(spark, str(tmp_path / "t"), cdc.KEYS, "__cdc_sequencer", 3, schema=shape)
    q = change_stream(t, size=1 << 30).writeStream.format("memory").queryName("empty_feed").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    t.append("a", 0, feed)
    q.processAllAvailable()
    q.stop()
    assert spark.table("empty_feed").count() == t.read().count()


def test_limits_of_a_trigger(spark, tmp_path):
    """Files or bytes a trigger: so many batches for the same files."""
    for i in range(4):
        spark.range(1000).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    size = max(x.stat().st_size for x in (tmp_path / "in").glob("*.parquet"))
    for options, batches in (({"maxFilesPerTrigger": "1"}, 4), ({"maxBytesPerTrigger": str(2 * size)}, 2), ({}, 1)):
        seen, name = [], "-".join(options) or "none"
        stream = readers.table_stream(spark, str(tmp_path / "in"), spark.range(1).schema, options)
        stream.writeStream.foreachBatch(lambda df, n, seen=seen: seen.append(df.count())).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        assert len(seen) == batches and sum(seen) == 4000


def test_change_feed(spark, tmp_path):
    df = lambda *rows: spark.createDataFrame(rows, "k int, seq int, op_type string, v string")
    t = ChangePieces(spark, str(tmp_path / "t"), ["k"], "seq", 2)
    t.append("a", 0, df((1, 1, "I", "a"), (2, 1, "I", "b"), (3, 1, "I", "c")))
    t.append("a", 1, df((1, 2, "U", "x"), (2, 2, "D", "b")))
    t.append("b", 0, df((4, 3, "I", "d"), (3, 0, "U", "late")))
    t.compact()
    feed = sorted((r.k, r["_change_type"], r.v, r["_commit_version"]) for r in change_feed(t, 2).collect())
    assert feed == [(1, "update_postimage", "x", 2), (1, "update_preimage", "a", 2), (2, "delete", "b", 2), (4, "insert", "d", 3)]
    assert sorted(r.k for r in change_feed(t, 1, 1).collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        change_feed(t, 9)


def test_stored_watermark(spark, tmp_path):
    docs = spark.createDataFrame([(1, 10), (2, 20)], "id int, at int")
    got = []
    for df in (docs, docs, docs.unionByName(spark.createDataFrame([(3, 30)], "id int, at int"))):
        run_extract(df, str(tmp_path / "x"), "at", "x", lambda rows: got.append(sorted(r.id for r in rows.collect())))
    assert got == [[1, 2], [], [3]]


def test_retries_come_back_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "U", None, 0), (2, "U", "x", 0), (3, "U", None, 1), (4, "I", None, 0)], "id int, op_type string, lob string, retries int")
    ok, again = C.split_retries(rows, ["lob"])
    send_retries(again, str(tmp_path / "retry"), "run", 0)
    send_retries(again, str(tmp_path / "retry"), "run", 0)
    back = spark.read.parquet(str(tmp_path / "retry")).drop("run", "batch")
    assert sorted(r.id for r in ok.collect()) == [2, 3, 4] and [r.id for r in back.collect()] == [1]
    assert [r.id for r in C.split_retries(back.select(rows.columns), ["lob"])[0].collect()] == [1]


def test_tie_prefers_the_upsert(spark):
    df = spark.createDataFrame([(1, "D", 5, "a"), (1, "I", 5, "b")], "key int, op_type string, seq int, v string")
    r = C.apply_changes(df, ["key"], "seq").first()
    assert r.v == "b" and r["__DeleteVersion"] is None


def test_late_event_loses_to_a_tombstone(spark):
    rows = [(1, "D", 5, "a")], [(1, "U", 3, "late")]
    a, b = (spark.createDataFrame(r, "key int, op_type string, seq int, v string") for r in rows)
    assert C.current_state(C.apply_changes(b, ["key"], "seq", C.apply_changes(a, ["key"], "seq"))).count() == 0


def test_ledger_over_a_month_boundary(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path / "ledger"), "app", "stream")
    assert not ledger.done("q", 0, 202308)
    ledger.log("q", 0, 202308)
    assert ledger.done("q", 0, 202309) and ledger.done("q", 0, 202308)
    assert not ledger.done("q", 0, 202310) and not ledger.done("q", 1, 202309) and not ledger.done("p", 0, 202308)
    ledger.log("q", 5, 202312)
    assert ledger.done("q", 5, 202401)


def test_replay_checkpoint():
    assert replay_checkpoint("/c", "2024-01-01 00:00:00") == replay_checkpoint("/c", "2024-01-01 00:00:00")
    with pytest.raises(ValueError):
        replay_checkpoint("/c", "2024-01-01")


def test_empty_extract_keeps_the_watermark(spark):
    docs = spark.createDataFrame([(1, 10), (2, 20)], "id int, at int")
    _, first = extract_increment(docs, None, "at", "x")
    rows, second = extract_increment(docs, first, "at", "x")
    assert rows.count() == 0 and second.first().watermark == 20


def test_kafka_options():
    got = readers.kafka_options({"maxOffsetsPerTrigger": "5", "preserve_case": "x"}, {"topic": "t"})
    assert got == {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "5", "includeHeaders": "true", "topic": "t"}


def test_single_app(spark):
    apps = spark.createDataFrame([("a",), ("b",), ("b",)], "app string")
    assert readers.single_app(apps, "a").count() == 1
    for name in ("b", "c"):
        with pytest.raises(ValueError):
            readers.single_app(apps, name)


def test_conserved_join_raises(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no partner"):
        metadata.conserved_join(a, b, ["k"]).collect()


@pytest.mark.parametrize("src, tgt, want", [(0, 0, (0, 0.0)), (0, 5, (-5, float(reconcile.FULL))), (None, 5, (None, None)), (10, 8, (2, 20.0))])
def test_count_difference(spark, src, tgt, want):
    df = spark.createDataFrame([(src, tgt)], "s long, t long")
    assert tuple(df.select(*reconcile.count_difference(F.col("s"), F.col("t"))).first()) == want


def test_repaired_count(spark):
    df = spark.createDataFrame([(None, None), (None, 1), (3, 0)], "n long, e int")
    assert [r[0] for r in df.select(reconcile.repaired_count(F.col("n"), F.col("e"))).collect()] == [0, None, 3]


def test_initial_load_scan(spark, tmp_path):
    from pyspark.sql import types as T

    spark.range(3).select(F.col("id").alias("A$B"), F.lit(1).alias("Other")).write.parquet(str(tmp_path / "x"))
    got = readers.initial_load_scan(spark, str(tmp_path / "x"), T.StructType.fromDDL("`a__dol b` int, a__dolb bigint"))
    assert got.columns == ["a__dolb"] and got.count() == 3


@pytest.mark.parametrize("segments", [1, 7])
def test_carry_forward(spark, segments):
    """Against a walk through each key: nulls, resets, ties, null keys, a table's rows that came earlier or later, several columns."""
    r = random.Random(segments)
    rows = [(r.choice([1, 1, 1, 1, 2, None]), r.randint(0, 40), r.choice("UUUID"), r.choice([None, None, "a", "b"]), r.choice([None, None, None, 1, 2]), i) for i in range(400)]
    live = [(1, -5, "old", None), (2, 20, "late", 9)]
    # rows of one sequence whose order shows nothing but their ids are left out
    ties = {}
    for k, seq, op, *_ , i in rows:
        ties.setdefault((k, seq), []).append(i)
    clear = {i for x in ties.values() if len(x) == 1 for i in x}
    rows = [x for x in rows if x[5] in clear]
    df = spark.createDataFrame(rows, "k int, seq int, op_type string, lob string, n int, i int").repartition(3)
    cur = spark.createDataFrame(live, "k int, seq int, lob string, n int")
    want, held = {}, {}
    for k, seq, op, lob, n, i in sorted(rows, key=lambda x: (x[0] or 0, x[1])):
        at = held.setdefault(k, {})
        new = []
        for c, v in (("lob", lob), ("n", n)):
            if op == "D":
                at[c] = None
                new.append(v)
                continue
            if v is not None:
                at[c] = v
            known = [x for x in live if x[0] == k and x[1] < seq]
            new.append(at[c] if c in at else (known[0][2 if c == "lob" else 3] if known else None))
        want[i] = tuple(new)
    got = C.carry_forward(df, ["k"], "seq", ["lob", "n"], cur, F.col("op_type") == "D", segments)
    assert got.columns == df.columns and {x.i: (x.lob, x.n) for x in got.collect()} == want


def test_one_key_is_cut_into_segments(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), F.when(F.col("id") % 50_000 == 7, F.col("id").cast("string")).alias("lob"))
    sizes = [x[0] for x in C.segmented(df, ["k"], "seq", 16).groupBy("__segment").agg(F.count("*").alias("n")).select("n").collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 200_000 / 16
    got = C.carry_forward(df, ["k"], "seq", ["lob"], segments=16).groupBy("lob").agg(F.count("*").alias("n")).collect()
    assert {r.lob: r.n for r in got} == {None: 7, "7": 50_000, "50007": 50_000, "100007": 50_000, "150007": 49_993}


def test_a_week_of_many_files_is_one_batch(spark, sf, tmp_path, monkeypatch):
    """Each batch is a week, whatever the number of its files, so values are carried in order and all cores read them."""
    monkeypatch.setattr(storage, "fresh_dir", lambda spark, name, n=iter(range(99)): str(tmp_path / f"{name}-{next(n)}"))
    whole = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(whole, "false")
    try:
        n = cdc.stream_carry_forward(spark, sf).count()
    finally:
        spark.conf.unset(whole)
    (root,) = [p for p in tmp_path.glob("stream-carry*")]
    assert n and len(list(root.glob("events/*.parquet"))) > 3 and len(list(root.glob("table/changes/commit=*"))) == 3
