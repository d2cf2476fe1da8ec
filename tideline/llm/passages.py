"""Repeated and nearly repeated passages: paragraph MinHash banding, exact verification, removal by components.

Paragraphs are the lines of a text of LINE words or more. Equal paragraphs form a class by aggregation; distinct ones are MinHashed over five-word
shingles, banded for recall, and colliding ones are verified by exact Jaccard similarity. Classes linked by verified pairs form
components; the first occurrence of each component stays, the others are removed. Lines that follow each other make one
passage, and a passage has `least` words, however short its lines.

A passage may also lie inside longer paragraphs or go over line breaks, where no two paragraphs are alike. So every string of
`least` words is held against all others too, without a row for each: a string owns an anchor, the k-gram within it whose hash is
smallest, which depends on the string alone, and the neighbouring strings of one anchor form a context. Equal contexts
collapse by aggregation; an anchor whose contexts differ has its strings counted one by one. A run of words is reported
where each of its strings also starts elsewhere: its bounds are exact, and one other place holds `least` of its words in a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.classify import PART, mix, powers
from tideline.llm.common import Stash, by_group, connected_components, small_batches

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Words that a passage has at least (passages of over 50 words).
LEAST = 51
#: Words of a line that is held against others for near copies. A shorter one has at most 15 shingles, of which one changed word takes up to five.
LINE = 20
#: Words of an anchor.
GRAM = 16
#: Distinct paragraphs of a bucket that are compared in one piece; larger buckets are compared as pairs of blocks.
BLOCK = 1_000
#: Words whose arrays are held at once.
_WORDS = 1 << 18


def tune_bands(rows: int = 3, similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """Bands of `rows` values needed to find a pair of the given similarity with the given probability."""
    return ceil(log(1 - recall) / log(1 - similarity**rows))


ROWS = 3
BANDS = tune_bands(ROWS)
_SEEDS = np.random.default_rng(9).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLANK = re.compile(rb"[\t-\r ]")
_POSITION = np.uint64((1 << 24) - 1)


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Texts joined by blanks into blocks of about PART bytes and cut between words only: [(text number, first byte)], bytes."""
    held, raw, size = [], [], 0
    for k, t in enumerate(texts):
        at = 0
        while at < len(t):
            gap = _BLANK.search(t, at + PART) if len(t) - at > PART else None
            end = gap.end() if gap else len(t)
            if size and size + end - at > PART:
                yield held, b"".join(raw)
                held, raw, size = [], [], 0
            held.append((k, size))
            raw += [t[at:end], b" "]
            size += end - at + 1
            at = end
    if size:
        yield held, b"".join(raw)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, line number in its text, hash) of every word of the texts, in order."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    passed = np.zeros(len(texts), np.int64)  # line breaks of a text so far
    for held, raw in _pieces(texts):
        b = np.frombuffer(raw, np.uint8)
        edge = np.flatnonzero(np.diff((~_SPACE[b]).view(np.int8), prepend=0, append=0))
        s, e = edge[::2], edge[1::2]
        up, down = powers(len(b) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)])))
        owner, start = np.array(held).T
        breaks = np.flatnonzero(b == 10)
        piece = np.searchsorted(start, s, side="right") - 1
        before = np.searchsorted(breaks, np.append(start, len(b)))
        base = passed[owner] - before[:-1]
        out.append((owner[piece], np.searchsorted(breaks, s) + base[piece], mix((total[e] - total[s]) * down[s])))
        np.add.at(passed, owner, np.diff(before))
    text, line, h = zip(*out)
    return np.concatenate(text), np.concatenate(line), np.concatenate(h)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the SHINGLE words from each word on (the last SHINGLE - 1 have none)."""
    n = max(0, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        out = out * np.uint64(0x9FB21C651E98DF25) + words[j : j + n]
    return mix(out)


def _sums(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(words) + 1)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum((words + np.uint64(1)) * up[: len(words)]))), down


def _runs_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each run of equal keys, and the place after its last."""
    n = len(keys[0])
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys]) if n > 1 else True
    first = np.flatnonzero(new)
    return first, np.append(first, n)[1:]


def band_keys(words: np.ndarray) -> np.ndarray:
    """Band keys of one paragraph of SHINGLE words or more."""
    low = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(words) - SHINGLE + 1, _WORDS):
        sh = shingle_hashes(words[at : at + _WORDS + SHINGLE - 1])
        for k in range(BANDS * ROWS):
            low[k] = min(low[k], ((sh ^ _SEEDS[0, k]) * _SEEDS[1, k]).min())
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + low[k::ROWS])
    return key.view(np.int64)


def all_band_keys(words: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Band keys of the paragraphs x..y of some words."""
    sh = np.append(shingle_hashes(words), np.uint64(0))
    cut = np.stack([x, y - SHINGLE + 1], axis=1).ravel()
    keys = np.empty((len(x), BANDS), np.int64)
    for band in range(BANDS):
        key = np.full(len(x), band, np.uint64)
        for k in range(band * ROWS, band * ROWS + ROWS):
            low = np.minimum.reduceat((sh ^ _SEEDS[0, k]) * _SEEDS[1, k], cut)[::2]
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + low)
        keys[:, band] = key.view(np.int64)
    return keys


def paragraphs(text: np.ndarray, line: np.ndarray, h: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(text number, first word, words, class, band keys) of every line of `least` words or more."""
    x, y = _runs_of(text, line)
    long = y - x >= max(least, SHINGLE)
    x, y = x[long], y[long]
    total, down = _sums(h)
    name = mix((total[y] - total[x]) * down[x] + (y - x).astype(np.uint64)).view(np.int64)
    keys = np.zeros((len(x), BANDS), np.int64)
    for first, stop in zip(*_runs_of(x // _WORDS)):  # paragraphs near each other at once
        few = slice(first, stop)
        if y[stop - 1] - x[first] > 2 * _WORDS:
            keys[few] = [band_keys(h[a:b]) for a, b in zip(x[few].tolist(), y[few].tolist())]
        else:
            keys[few] = all_band_keys(h[x[first] : y[stop - 1]], x[few] - x[first], y[few] - x[first])
    return text[x], x - np.searchsorted(text, text[x]), y - x, name, keys


def contexts(text: np.ndarray, h: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first string's first word, strings, anchor hash, context hash) of every context."""
    gram = min(GRAM, max(1, least // 2))
    w = least - gram + 1
    for at in range(0, len(h) - least + 1, _WORDS):
        t, part = text[at : at + _WORDS + least - 1], h[at : at + _WORDS + least - 1]
        n = len(part)
        m = n - least + 1
        total, down = _sums(part)
        g = mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
        key = np.full(-(-len(g) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
        key[: len(g)] = (g & ~_POSITION) | np.arange(len(g), dtype=np.uint64)
        blocks = key.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        owner = (np.minimum(behind[:m], ahead[w - 1 : w - 1 + m]) & _POSITION).astype(np.int64)
        valid = t[:m] == t[least - 1 :]
        first, stop = _runs_of(np.where(valid, owner, -1))
        first, stop = first[valid[first]], stop[valid[first]]
        end = stop + least - 1
        yield t[first], first + at - np.searchsorted(text, t[first]), stop - first, g[owner[first]].view(np.int64), mix((total[end] - total[first]) * down[first] + (end - first).astype(np.uint64)).view(np.int64)


def strings(words: np.ndarray, least: int) -> np.ndarray:
    """Hash of the `least` words from each word on."""
    total, down = _sums(words)
    return mix((total[least:] - total[:-least]) * down[: len(words) - least + 1]).view(np.int64)


def jaccard_components(sets: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Component label (an index) of each sorted set: linked where the Jaccard similarity reaches the bound.

    Each step compares one set with all others. Sets already in the largest component need no step of their own once
    every other set had one, so a bucket of near copies takes few.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    label, done = np.arange(n), np.zeros(n, bool)
    while True:
        largest = np.bincount(label, minlength=n).argmax()
        open_ = np.flatnonzero(~done & (label != largest)) if done.any() else np.arange(n)
        if not len(open_):
            return label
        p = int(open_[0])
        lo, hi = np.searchsorted(flat, sets[p], "left"), np.searchsorted(flat, sets[p], "right")
        spread = np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)[:-1])), hi - lo) + np.arange((hi - lo).sum())
        both = np.bincount(owner[spread], minlength=n)
        near = both >= similarity * (sizes + sizes[p] - both) - 1e-9
        near[p] = True
        touched = np.unique(label[near])
        label[np.isin(label, touched)] = touched[0]
        done[p] = True


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join the sets (key, name, shingles) of each key into components of the exact similarity."""

    def piece(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, names = t.column("key").to_numpy(), t.column("name").to_numpy()
        sets = t.column("shingles").combine_chunks()
        a, c = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(*(x.tolist() for x in _runs_of(key))):
            label = jaccard_components([sets[i].values.to_numpy().view(np.uint64) for i in range(s, e)]) + s
            far = np.flatnonzero(label != np.arange(s, e)) + s
            a.append(names[label[far - s]]), c.append(names[far])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(c))], ["a", "b"])

    yield from by_group(batches, "key", piece)


def _listed(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *values]), kind))


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(id, k, start_word, n_words, component_id, removed): maximal runs of words of `least` words or more that are
    repeated elsewhere, in the same text or another one, or are made of repeated and nearly repeated paragraphs.

    Of every repeated string and of every component of paragraphs the first occurrence, by id and place, stays; a run of
    others has `removed` true. Runs of either kind are maximal, so one that begins with a first occurrence and goes on with a
    repeat is a kept and a removed run, which share words at the border. component_id is the smallest id among the first
    occurrences of the run's strings. A text without such a run has no row. k tells rows with equal ids and different texts apart; of N rows
    alike in id and text, which are counted and not gathered, one has its runs, and N - 1 are removed whole (a row each, from the first word to the last, if
    there are `least` words). Null and short texts have no runs; null ids count as
    smaller than others; an empty table gives an empty result; other columns are ignored. Texts are never cut.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stash = Stash(spark, "passages")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col).cast("string"), F.lit(9), text_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    # rows alike in id and text become one with their number
    same = stash.save(rows.groupBy("k").agg(F.count("*").cast("int").alias("copies")).where("copies > 1"))
    repeated = not same.isEmpty()
    if repeated:
        rows = rows.join(same, "k", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
        rows = rows.where("copies = 1").unionByName(rows.where("copies > 1").dropDuplicates(["k"])).select("id", "k", "text", "copies")
    else:
        rows = rows.withColumn("copies", F.lit(1))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Paragraphs with their band keys, and contexts (once a text) with the places they start at."""
        for b in batches:
            ids, k, copies = b.column(0), b.column(1).to_numpy(), b.column(3).to_numpy()
            text, line, h = words_of([x.as_buffer().to_pybytes() for x in b.column(2)])

            def row(text, n, name, h, at, bands):
                return pa.RecordBatch.from_arrays([ids.take(pa.array(text)), pa.array(k[text]), pa.array(copies[text]), pa.array(n.astype(np.int32)), pa.array(name), h, at, bands], ["id", "k", "copies", "n", "class", "anchor", "at", "bands"])

            x, at, n, name, keys = paragraphs(text, line, h, min(LINE, least))
            yield row(x, n, name, pa.nulls(len(x), pa.int64()), _listed(list(at.reshape(-1, 1)), pa.int32()), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * BANDS, keys.ravel()))
            for x, at, n, anchor, name in contexts(text, h, least):
                order = np.lexsort((at, name, anchor, x))
                x, at, n, anchor, name = (c[order] for c in (x, at, n, anchor, name))
                one, _ = _runs_of(x, anchor, name)
                yield row(x[one], n[one], name[one], pa.array(anchor[one]), pa.ListArray.from_arrays(np.append(one, len(x)).astype(np.int32), pa.array(at.astype(np.int32))), pa.nulls(len(one), pa.list_(pa.int64())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the wanted places of a text: a context's strings, or a paragraph's shingle set."""
        for b in batches:
            sets = []
            for raw, wanted in zip(b.column(0), b.column(1)):
                h = words_of([raw.as_buffer().to_pybytes()])[2]
                got = wanted.values
                para = got.field("anchor").is_null().to_numpy(zero_copy_only=False)
                for s, m, p in zip(got.field("start").to_pylist(), got.field("n").to_pylist(), para.tolist()):
                    sets.append(np.unique(shingle_hashes(h[s : s + m])).view(np.int64) if p else strings(h[s : s + m + least - 1], least))
            got = b.column(1).flatten()
            yield pa.RecordBatch.from_arrays([got.field("anchor"), got.field("class"), _listed(sets, pa.int64())], ["anchor", "class", "hashes"])

    kinds = "id long, k long, copies int, n int, class long, anchor long, at array<int>, bands array<long>"
    found = stash.save(rows.mapInArrow(find, kinds))
    one = F.struct("id", "k", F.col("at")[0].alias("start"))

    # contexts: anchors met once own nothing; those with one kind of context repeat as they are
    ctx = found.where("anchor IS NOT NULL").select("anchor", "class", "id", "k", "copies", "n", "at")
    met = ctx.groupBy("anchor").agg(F.sum(F.size("at") * F.col("copies")).alias("c"), F.min("class").alias("x"), F.max("class").alias("y")).where("c > 1").select("anchor", (F.col("x") != F.col("y")).alias("mixed"))
    seen = stash.save(ctx.join(met, "anchor"))
    classes = stash.save(seen.groupBy("anchor", "class").agg(F.sum(F.size("at") * F.col("copies")).cast("long").alias("c"), F.min(one).alias("first"), F.first("n").alias("n"), F.first("mixed").alias("mixed")))

    # paragraphs: classes, buckets, and what has to be cut out of the texts
    lines = stash.save(found.where("bands IS NOT NULL").groupBy("class").agg(F.min(one).alias("first"), F.min(F.struct("n", "bands")).alias("one"), F.sum("copies").alias("c")))
    banded = lines.select("class", F.explode("one.bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("c"), F.bit_xor("class").alias("x"), F.min("class").alias("y")).where("c > 1")
    buckets = stash.save(buckets.groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key", "c"))  # of buckets with equal members, one
    members = stash.save(banded.join(buckets, "key"))
    places = lambda df, n, anchor: df.select("first.k", F.struct(anchor.alias("anchor"), "class", "first.start", n.alias("n")).alias("w"))
    wanted = places(members.select("class").distinct().join(lines, "class"), F.col("one.n"), F.lit(None).cast("long")).unionByName(places(classes.where("mixed"), F.col("n"), F.col("anchor")))
    wanted = wanted.groupBy("k").agg(F.collect_list("w").alias("wanted"))
    cuts = stash.save(rows.select("k", "text").join(wanted, "k").select("text", "wanted").mapInArrow(cut, "anchor long, class long, hashes array<long>"))

    # strings of the contexts that differ, counted one by one: (place in the context, first occurrence) of the repeated ones
    each = cuts.where("anchor IS NOT NULL").dropDuplicates(["anchor", "class"]).join(classes.where("mixed").select("anchor", "class", "c", "first"), ["anchor", "class"])
    each = stash.save(each.select("anchor", "class", "c", "first", F.posexplode("hashes").alias("r", "string")))
    again = each.groupBy("anchor", "string").agg(F.sum("c").alias("c"), F.min(F.struct("first.id", "first.k", (F.col("first.start") + F.col("r")).alias("start"))).alias("origin")).where("c > 1")
    some = each.select("anchor", "class", "r", "string").join(again, ["anchor", "string"]).groupBy("anchor", "class").agg(F.collect_list(F.struct(F.col("r").alias("r"), F.lit(1).alias("n"), "origin")).alias("parts"))
    whole = classes.where("NOT mixed").select("anchor", "class", F.array(F.struct(F.lit(0).alias("r"), "n", F.col("first").alias("origin"))).alias("parts"))
    hits = seen.join(stash.save(some.unionByName(whole)), ["anchor", "class"]).select("id", "k", F.explode("at").alias("at"), "parts").select("id", "k", "at", F.explode("parts").alias("p"))
    low = F.coalesce("p.origin.id", F.lit(-(1 << 63)))
    self_ = F.col("id").eqNullSafe(F.col("p.origin.id")) & (F.col("k") == F.col("p.origin.k")) & (F.col("at") + F.col("p.r") == F.col("p.origin.start"))
    hits = hits.select("id", "k", F.struct((F.col("at") + F.col("p.r")).alias("s"), (F.col("at") + F.col("p.r") + F.col("p.n") + (least - 1)).alias("e"), low.alias("component"), (~self_).alias("removed")).alias("u"))

    # paragraphs that meet in a bucket, verified; the first occurrence of a component stays, as that of a repeated class does
    sets = cuts.where("anchor IS NULL").dropDuplicates(["class"]).select(F.col("class").alias("name"), F.col("hashes").alias("shingles"))
    blocks = F.ceil(F.col("c") / (BLOCK // 2)).cast("int")
    own = F.pmod(F.xxhash64("class", F.lit(3)), blocks).cast("int")
    pair = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.xxhash64("key", F.least(j, own), F.greatest(j, own)))
    placed = members.select(F.col("class").alias("name"), F.explode(F.when(F.col("c") <= BLOCK, F.array("key")).otherwise(pair)).alias("key"))
    linked = placed.join(sets, "name").select("key", "name", "shingles").repartition("key").sortWithinPartitions("key").mapInArrow(verified, "a long, b long")
    parts_of = stash.save(connected_components(linked, stash))
    firsts = lines.join(parts_of, F.col("class") == F.col("node")).groupBy("component").agg(F.min("first").alias("origin"))
    near = parts_of.join(firsts, "component").select(F.col("node").alias("class"), "origin")
    near = lines.select("class", "first", "c").join(near, "class", "left").where("c > 1 OR origin IS NOT NULL").select("class", F.coalesce("origin", "first").alias("origin"))
    near = found.where("bands IS NOT NULL").select("id", "k", "n", "class", F.col("at")[0].alias("at")).join(near, "class")
    stays = F.col("id").eqNullSafe(F.col("origin.id")) & (F.col("k") == F.col("origin.k")) & (F.col("at") == F.col("origin.start"))
    near = near.select("id", "k", F.struct(F.col("at").alias("s"), (F.col("at") + F.col("n")).alias("e"), F.coalesce("origin.id", F.lit(-(1 << 63))).alias("component"), (~stays).alias("removed")).alias("u"))

    runs = hits.unionByName(near).groupBy("id", "k").agg(F.collect_list("u").alias("us")).mapInArrow(_merge, "id long, k long, start_word int, n_words int, component_id long, removed boolean")
    runs = runs.where(F.col("n_words") >= least)
    if repeated:
        runs = stash.save(runs)
        # all words of a repeated row are in its runs, if it has any
        whole = runs.join(same, "k").groupBy("id", "k").agg(F.lit(0).alias("start_word"), F.max(F.col("start_word") + F.col("n_words")).alias("n_words"), F.min("component_id").alias("component_id"), F.lit(True).alias("removed"), F.first("copies").alias("copies"))
        runs = runs.unionByName(whole.select("*", F.explode(F.sequence(F.lit(2), "copies"))).select(*runs.columns))
    return runs.withColumn("component_id", F.when(F.col("component_id") != -(1 << 63), F.col("component_id")))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal runs of the word ranges of each row, for removed and kept ones apart."""
    for b in batches:
        us = b.column(2)
        flat = us.flatten()
        s, e, c = (flat.field(x).to_numpy().astype(np.int64) for x in ("s", "e", "component"))
        group = 2 * np.repeat(np.arange(b.num_rows), us.value_lengths().to_numpy()) + flat.field("removed").to_numpy(zero_copy_only=False)
        order = np.lexsort((s, group))
        s, e, c, group = s[order], e[order], c[order], group[order]
        reach = np.maximum.accumulate(group * (1 << 40) + e)
        new = np.concatenate((np.ones(min(1, len(s)), bool), group[1:] * (1 << 40) + s[1:] > reach[:-1]))
        first = np.flatnonzero(new)
        if not len(first):
            continue
        stop = np.maximum.reduceat(e, first)
        g = group[first]
        row = pa.array(g // 2)
        yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(s[first].astype(np.int32)), pa.array((stop - s[first]).astype(np.int32)), pa.array(np.minimum.reduceat(c, first)), pa.array(g % 2 == 1)], ["id", "k", "start_word", "n_words", "component_id", "removed"])
