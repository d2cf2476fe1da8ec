"""Exact removal of repeated byte strings by suffix arrays of shards.

A string of `length` bytes that repeats must be seen together with its other copy in one shard. Each such string owns
an anchor: the k-gram within it whose hash is smallest (the leftmost of ties), which depends on the string alone, so
equal strings have equal anchors. Neighbouring strings of one anchor form one context. Contexts meet by anchor hash:

* an anchor met once owns no repeated string; one whose contexts are all equal owns nothing else;
* the distinct contexts of the others form shards, each with a suffix array by induced sorting and its permuted common
  prefixes: a string repeats if a neighbouring suffix shares `length` bytes with it;
* anchors with more than CONTEXTS distinct contexts are dealt again by the strings themselves (128-bit hashes, counted
  with map-side combine), so no shard grows with a frequent passage.

Equal contexts are aggregated before they are shuffled on, so thousands of copies cost their shard one context. A context
that one text holds many times (a run of one word) leaves its task as one row with all its places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.classify import PART, mix, powers
from tideline.llm.common import Stash, by_group, small_batches
from tideline.llm.suffix import repeated_starts

LENGTH = 200
GRAM = 32
#: Distinct contexts of an anchor that one suffix array takes; beyond, its strings are counted one by one.
CONTEXTS = 4_000
#: Contexts that a suffix array takes at least, where a task has them.
SHARD = 4_000
_POSITION = np.uint64((1 << 24) - 1)


def _chunks(texts: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Parts of about PART bytes: [(text number, its byte at the part's start, its size here)], joined bytes. Long texts
    are cut with length - 1 bytes in common, so each string lies in one part."""
    held, raw, size = [], [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PART):
            piece = t[at : at + PART + length - 1]
            if len(piece) < length:
                continue
            if size and size + len(piece) > PART:
                yield held, b"".join(raw)
                held, raw, size = [], [], 0
            held.append((k, at, len(piece)))
            raw.append(piece)
            size += len(piece)
    if size:
        yield held, b"".join(raw)


def anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first string start, strings, anchor hash, context hash) of every context in the texts."""
    w = length - gram + 1
    for held, raw in _chunks(texts, length):
        b = np.frombuffer(raw, np.uint8)
        n = len(b)
        up, down = powers(n + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n])))
        g = mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
        del total
        m = n - length + 1
        key = np.full(-(-len(g) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
        key[: len(g)] = (g & ~_POSITION) | np.arange(len(g), dtype=np.uint64)
        blocks = key.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        owner = (np.minimum(behind[:m], ahead[w - 1 : w - 1 + m]) & _POSITION).astype(np.int64)
        sizes = np.array([x[2] for x in held])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, starts, 1)
        np.add.at(step, starts + sizes - length + 1, -1)
        valid = np.cumsum(step)[:m] > 0
        new = valid & np.concatenate(([True], (owner[1:] != owner[:-1]) | ~valid[:-1]))
        first = np.flatnonzero(new)
        count = np.bincount(np.cumsum(new)[valid] - 1, minlength=len(first))
        piece = np.searchsorted(starts, first, side="right") - 1
        digest = xxhash.xxh3_64_intdigest
        context = np.array([digest(raw[x:y]) for x, y in zip(first.tolist(), (first + count + length - 1).tolist())], np.uint64).view(np.int64)
        text = np.array([x[0] for x in held])[piece]
        at = first - starts[piece] + np.array([x[1] for x in held])[piece]
        yield text, at, count, g[owner[first]].view(np.int64), context


def _spans(marks: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_RANGES = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _ranges(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"s": s, "e": e} for s, e in x] for x in spans], _RANGES)


def repeated_spans(docs: DataFrame, stash: Stash, length: int, gram: int, contexts: int) -> DataFrame:
    """(k1, k2, spans array<struct<s, e>>) of the texts (k1, k2, text) that hold repeated strings: starts s..e-1 of
    strings that also start elsewhere, not merged."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column(2)]
            for text, at, count, h, context in anchors(texts, length, gram):
                rows, own = once(text, at, count, h, context)
                sent = (h, context, k1[text], k2[text], at.astype(np.int32), count.astype(np.int32))
                yield pa.RecordBatch.from_arrays([*[pa.array(x[rows]) for x in sent], own], ["h", "ctx", "k1", "k2", "at", "n", "own"])

    def once(text: np.ndarray, at: np.ndarray, count: np.ndarray, h: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Rows to send, and for those that stand for several equal contexts of a text the starts of all of them."""
        _, first, group, n = np.unique(mix(h.view(np.uint64) ^ mix(context.view(np.uint64) + text.astype(np.uint64))), return_index=True, return_inverse=True, return_counts=True)
        own = pa.nulls(len(first), _RANGES)
        if len(first) < len(at):
            order, end, listed = np.argsort(group, kind="stable"), np.cumsum(n), [None] * len(first)
            for g in np.flatnonzero(n > 1).tolist():
                listed[g] = [{"s": int(at[i]), "e": int(at[i] + count[i])} for i in order[end[g] - n[g] : end[g]]]
            own = pa.array(listed, _RANGES)
        return first, own

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, wanted in zip(b.column(0), b.column(1)):
                raw, got = text.as_buffer(), wanted.values
                h, ctx, at, n, c, frequent = (got.field(x).to_numpy(zero_copy_only=False) for x in ("h", "ctx", "at", "n", "c", "frequent"))
                pieces = [raw.slice(a, m + length - 1).to_pybytes() for a, m in zip(at.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ctx), pa.array(c), pa.array(pieces, pa.binary()), pa.array(frequent)], ["h", "ctx", "c", "raw", "frequent"])

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(t: pa.Table) -> Iterator[pa.RecordBatch]:
            texts = t.column("raw").to_pylist()
            marks = repeated_starts(texts, length)
            spans, at = [], 0
            for x, c in zip(texts, t.column("c").to_pylist()):
                n = len(x) - length + 1
                spans.append([(0, n)] if c > 1 else _spans(marks[at : at + n]))
                at += len(x) + 1
            yield pa.RecordBatch.from_arrays([t.column("h").combine_chunks(), t.column("ctx").combine_chunks(), _ranges(spans)], ["h", "ctx", "spans"])

        yield from by_group(batches, "h", piece, SHARD)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, ctx, c, raw in zip(*(b.column(k).to_pylist() for k in range(4))):
                n = len(raw) - length + 1
                d = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[r : r + length]) for r in range(n)]), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(n, h), np.full(n, ctx), np.arange(n, dtype=np.int32), np.full(n, c), d[:, 0].copy(), d[:, 1].copy())], ["h", "ctx", "r", "c", "w1", "w2"])

    found = stash.save(docs.select("k1", "k2", F.col("text").cast("binary").alias("text")).where(F.octet_length("text") >= length).mapInArrow(find, "h long, ctx long, k1 long, k2 int, at int, n int, own array<struct<s:int,e:int>>"))
    times = F.sum(F.when(F.col("own").isNull(), 1).otherwise(2))
    met = stash.save(found.groupBy("h").agg(times.alias("total"), F.min("ctx").alias("x"), F.max("ctx").alias("y")).where("total > 1").select("h", (F.col("x") != F.col("y")).alias("mixed")))
    seen = stash.save(found.join(met, "h"))
    stash.drop(found)

    kinds = kept = stash.save(seen.where("mixed").groupBy("h", "ctx").agg(times.cast("long").alias("c"), F.min(F.struct("k1", "k2", "at", "n")).alias("one")))
    frequent = kinds.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") > contexts).select("h", F.lit(True).alias("frequent"))
    kinds = kinds.join(frequent, "h", "left").select("h", "ctx", "c", "one.*", F.coalesce("frequent", F.lit(False)).alias("frequent"))
    wanted = kinds.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "ctx", "at", "n", "c", "frequent")).alias("wanted"))
    texts = docs.select("k1", "k2", F.col("text").cast("binary").alias("text")).join(wanted, ["k1", "k2"])
    cuts = texts.select("text", "wanted").mapInArrow(cut, "h long, ctx long, c long, raw binary, frequent boolean")
    some = not frequent.isEmpty()
    cuts = stash.save(cuts) if some else cuts  # two readers: the texts are shuffled once all the same
    by_shard = cuts.where("NOT frequent").drop("frequent").repartition("h").sortWithinPartitions("h").mapInArrow(shard, "h long, ctx long, spans array<struct<s:int,e:int>>")
    marks = by_shard.where("size(spans) > 0")
    if some:
        each = stash.save(cuts.where("frequent").drop("frequent").mapInArrow(strings, "h long, ctx long, r int, c long, w1 long, w2 long"))
        again = each.groupBy("w1", "w2").agg(F.sum("c").alias("k")).where("k > 1").select("w1", "w2")
        marks = marks.unionByName(each.join(again, ["w1", "w2"]).groupBy("h", "ctx").agg(F.array_sort(F.collect_list(F.struct(F.col("r").alias("s"), (F.col("r") + 1).alias("e")))).alias("spans")))
    marks = stash.save(marks)
    moved = F.transform("spans", lambda x: F.struct((x["s"] + F.col("at")).alias("s"), (x["e"] + F.col("at")).alias("e")))
    moved = F.coalesce("own", moved)
    whole = F.coalesce("own", F.array(F.struct(F.col("at").alias("s"), (F.col("at") + F.col("n")).alias("e"))))
    per_anchor = seen.where("mixed").join(marks, ["h", "ctx"]).select("k1", "k2", moved.alias("spans")).unionByName(seen.where("NOT mixed").select("k1", "k2", whole.alias("spans")))
    spans = stash.save(per_anchor.groupBy("k1", "k2").agg(F.flatten(F.collect_set("spans")).alias("spans")))  # rows alike in key and text: once
    for done in (seen, met, kept, marks, *([cuts, each] if some else [])):
        stash.drop(done)
    return spans


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = LENGTH, gram: int = GRAM, contexts: int = CONTEXTS, as_text: bool = False) -> DataFrame:
    """(row struct of the input's other columns, n_bytes, n_removed, n_spans, kept binary): every byte covered by a
    `length`-byte string that starts anywhere else too, judged on the input, is removed; n_spans counts maximal runs.
    With as_text `kept` is a string, without the rests of characters that a removed run cuts through.

    A null text is empty, texts shorter than `length` stay whole, repeated rows repeat each other's strings, an empty
    table gives an empty result. Work and shuffle grow with the bytes of the texts; a task holds a part of one text and
    one shard.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stash = Stash(spark, "repeats")
    text, others = F.coalesce(F.col(text_col), F.lit("")), [c for c in docs.columns if c != text_col]
    digest = F.xxhash64(text, *[F.col(c).cast("string") for c in others])
    whole = F.col(id_col).cast("long") if id_col in docs.columns else F.lit(None).cast("long")
    # a row's key: its id and a short hash of all it holds; without an id the long hash stands for it
    rows = docs.select(F.struct(*(others or [F.lit(None).cast("string").alias("none")])).alias("row"), text.alias("text"), F.coalesce(whole, digest).alias("k1"), F.hash(digest, F.lit(3)).alias("k2"))
    spans = repeated_spans(rows.select("k1", "k2", "text"), stash, length, gram, contexts)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(2)):
                raw = text.as_buffer().to_pybytes()
                if not spans.is_valid or not len(spans):
                    out.append((len(raw), 0, 0, raw))
                    continue
                s, e = spans.values.field("s").to_numpy(), spans.values.field("e").to_numpy() + length - 1
                step = np.zeros(len(raw) + 1, np.int64)
                np.add.at(step, s, 1)
                np.add.at(step, e, -1)
                gone = np.cumsum(step)[:-1] > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((len(raw), int(gone.sum()), len(_spans(gone)), kept))
            n, removed, runs, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())], ["row", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(spans, ["k1", "k2"], "left").select("row", F.col("text").cast("binary").alias("text"), "spans")
    return joined.mapInArrow(cut_out, f"row {rows.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")
