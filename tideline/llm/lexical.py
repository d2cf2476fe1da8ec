"""Ranked lexical search over bit-sliced Bloom signatures, with exact scores of every document that is not provably excluded."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import Stash, small_batches

#: Signature rows that one entry sets, and rows of a signature for each entry it may hold.
PROBES, ROOM = 3, 16
#: A block holds at most so many documents, and so many entries unless it is one document.
DOCS, ENTRIES = 1024, 1 << 19
#: Terms of the queries of one job (one query more at most).
TERMS = 200_000
#: Gathered cells of bit slices in one step.
CELLS = 1 << 22

#: Bytes that end a term become spaces, A-Z become a-z; bytes of multi-byte characters stay.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


def signature_rows(hashes: np.ndarray, level: np.ndarray | int, rows: int) -> np.ndarray:
    """Rows of a signature for (term, level): PROBES for each. A term of tf occurrences is entered at levels 0..log2(tf)."""
    with np.errstate(over="ignore"):
        x = mixed(hashes + np.asarray(level).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        step = (x >> np.uint64(32)) | np.uint64(1)
        return np.stack([(x + np.uint64(i) * step) & np.uint64(rows - 1) for i in range(PROBES)]).astype(np.int64)


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def _block(docs: list[tuple[object, Counter]], rows: int) -> dict:
    """One block: ids, lengths, signature slices, and for each document its terms and their occurrences."""
    number: dict[bytes, int] = {}
    at = [np.fromiter((number.setdefault(t, len(number)) for t in c), np.int64, len(c)) for _, c in docs]
    tf = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for _, c in docs])
    doc = np.repeat(np.arange(len(docs)), [len(c) for _, c in docs])
    term = np.concatenate(at)
    order = np.lexsort((term, doc))
    term, tf, doc = term[order], tf[order], doc[order]
    hashes = term_hashes(list(number))
    bits = np.zeros((rows, len(docs)), bool)
    level, live = 0, np.arange(len(tf))
    while len(live):
        for r in signature_rows(hashes[term[live]], level, rows):
            bits[r, doc[live]] = True
        level += 1
        live = live[tf[live] >> level > 0]
    return {
        "ids": [i for i, _ in docs], "lengths": [sum(c.values()) for _, c in docs], "rows": rows, "levels": level,
        "slices": np.packbits(bits, axis=1).tobytes(), "terms": list(number), "frequencies": np.bincount(term, minlength=len(number)).tolist(),
        "doc": doc.astype(np.int32).tobytes(), "term": term.astype(np.int32).tobytes(), "tf": tf.astype(np.int32).tobytes(),
    }


def index(docs: DataFrame, stash: Stash, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Signature blocks of all documents with at least one term, written to the shared folder.

    Documents of a task are dealt to blocks by the size of their signatures, so short documents have short ones. The index
    knows nothing of queries. Null and empty texts hold no term and are in no block.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"ids array<{id_type}>, lengths array<bigint>, rows int, levels int, slices binary, terms array<binary>, frequencies array<int>, doc binary, term binary, tf binary"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("raw"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        held: dict[int, list] = {}

        def out(size: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(held.pop(size), size * ROOM)], schema=kinds)

        for b in batches:
            kinds = kinds or pa.schema([("ids", pa.list_(b.schema.field("id").type)), ("lengths", pa.list_(pa.int64())), ("rows", pa.int32()), ("levels", pa.int32()), ("slices", pa.binary()), ("terms", pa.list_(pa.binary())), ("frequencies", pa.list_(pa.int32())), ("doc", pa.binary()), ("term", pa.binary()), ("tf", pa.binary())])
            for i, raw in zip(b.column("id"), b.column("raw")):
                found = Counter(terms_of(raw.as_py() or b""))
                if not found:
                    continue
                entries = sum(map(int.bit_length, found.values()))
                size = max(64, 1 << (entries - 1).bit_length())
                held.setdefault(size, []).append((i.as_py(), found))
                if len(held[size]) >= max(1, min(DOCS, ENTRIES // size)):
                    yield out(size)
        for size in sorted(held):
            yield out(size)

    return stash.save(rows.mapInArrow(blocks, schema))


class Queries:
    """Terms and weights of some queries, numbered for one job."""

    def __init__(self, rows: list):
        self.numbers = [r["query"] for r in rows]
        seen: dict[bytes, int] = {}
        self.of = [np.array([seen.setdefault(bytes(t["term"]), len(seen)) for t in r["terms"]], np.int64) for r in rows]
        weight = {bytes(t["term"]): t["w"] for r in rows for t in r["terms"]}
        self.terms = list(seen)
        self.weights = np.array([weight[t] for t in self.terms], np.int64)
        self.hashes = term_hashes(self.terms)


def part_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A document's share for tf occurrences of a term, before the term's weight; it grows with tf."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def upper_bounds(q: Queries, slices: np.ndarray, rows: int, levels: int, m: np.ndarray) -> np.ndarray:
    """(queries, documents): no document scores more. Signatures overestimate presence, so a slice's bits for (term, level)
    say where tf may reach 2^level; tf then counts as at most 2^(level+1)-1."""
    n = len(m)
    bound = np.zeros((len(q.of), n), np.int64)
    live, packed, before = np.arange(len(q.terms)), None, np.zeros(n, np.int64)
    for level in range(levels):
        r = signature_rows(q.hashes[live], level, rows)
        bits = slices[r[0]]
        for k in r[1:]:
            bits &= slices[k]
        if packed is not None:
            bits &= packed
        some = bits.any(axis=1)
        live, packed = live[some], bits[some]
        if not len(live):
            break
        here = np.full(len(q.terms), -1)
        here[live] = np.arange(len(live))
        at = [h[h >= 0] for h in (here[t] for t in q.of)]
        own = np.flatnonzero([len(a) > 0 for a in at])
        now = part_score(np.int64(2 ** (level + 1) - 1), m)
        gain, before = now - before, now
        width = max(1, CELLS // n)
        for k in own:
            total = np.zeros(n, np.int64)
            for c in range(0, len(at[k]), width):
                a = at[k][c : c + width]
                total += q.weights[live[a]] @ np.unpackbits(packed[a], axis=1, count=n)
            bound[k] += gain * total
    return bound


def search_block(block: dict, q: Queries, best: list[list], k: int, total_docs: int, total_terms: int, seen: Counter) -> None:
    """Put a block's documents into the queries' best lists: (-score, id is null, id), k at most and in order."""
    n = np.array(block["lengths"], np.int64)
    m = 50 + 50 * n * total_docs // total_terms
    slices = np.frombuffer(block["slices"], np.uint8).reshape(block["rows"], -1)
    bound = upper_bounds(q, slices, block["rows"], block["levels"], m)
    least = np.array([-b[-1][0] if len(b) == k else 1 for b in best], np.int64)
    open_ = np.flatnonzero((bound >= least[:, None]).any(axis=1))
    seen["pairs"] += bound.size
    if not len(open_):
        return
    where = pc.index_in(pa.array(q.terms, pa.binary()), value_set=block["terms"]).fill_null(-1).to_numpy()
    wanted = np.zeros(len(block["terms"]) + 1, bool)
    wanted[where[where >= 0]] = True
    term = np.frombuffer(block["term"], np.int32)
    keep = wanted[term]
    size = len(block["terms"])
    keys = np.append(np.frombuffer(block["doc"], np.int32)[keep].astype(np.int64) * size + term[keep], np.iinfo(np.int64).max)
    tf = np.append(np.frombuffer(block["tf"], np.int32)[keep], 0).astype(np.int64)
    for i in open_:
        mine = q.of[i][where[q.of[i]] >= 0]
        to = where[mine]
        order = np.argsort(-bound[i], kind="stable")
        for c in range(0, len(order), 64):
            low = -best[i][-1][0] if len(best[i]) == k else 1
            d = order[c : c + 64]
            d = d[bound[i, d] >= low]
            if not len(d):
                break
            seen["scored"] += len(d)
            key = d[:, None] * size + to[None, :]
            at = np.searchsorted(keys, key)
            f = np.where(keys[at] == key, tf[at], 0)
            score = (q.weights[mine] * part_score(f, m[d][:, None])).sum(axis=1)
            new = [(-int(s), block["ids"][x] is None, block["ids"][x]) for s, x in zip(score, d) if s >= low]
            if new:
                best[i] = sorted(best[i] + new, key=lambda t: t[:2] if t[1] else t)[:k]


def _top(df: DataFrame, by: list[str | Column], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 50, id_col: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text", terms: int = TERMS) -> DataFrame:
    """(query, rank, id, score): the k highest-scoring documents of each query with a score above 0, ties by ascending id.

    Rows of `queries` alike in id and text are one query; rows of one id with different texts are ranked apart, under that
    id. Queries without a term that any document holds have no row. Equal document rows each count and each rank (their
    order among themselves shows nothing); null ids come last among ties. Empty tables give no row. Other columns are ignored.

    The documents are indexed in blocks first; document frequencies come from the blocks. Queries are then taken in jobs of
    about `terms` terms, which bounds what is sent to tasks. A task goes through its blocks and keeps k rows of each query,
    so a document is left unscored only where its upper bound is below k scores already found; the tasks' rows are ranked
    in two steps, first in up to 64 parts of each query.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "lexical")
    small_batches(spark)
    blocks = index(docs, stash, id_col, text)
    n, length = blocks.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()
    id_type, out_type = docs.schema[id_col].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms_of(t.as_py() or b""))) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.list_(pa.binary()))], names=["id", "terms"])

    asked = queries.select(F.col(query_id).alias("id"), F.col(query_text).cast("binary").alias("text")).distinct().mapInArrow(split, f"id {out_type}, terms array<binary>")
    asked = stash.save(asked.select(F.monotonically_increasing_id().alias("query"), "id", "terms"))
    each = asked.select("query", F.explode("terms").alias("term"))
    held = blocks.select(F.explode(F.arrays_zip("terms", "frequencies")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.frequencies").alias("df"))
    df = held.join(each.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(n or 0) + 2) / (2.0 * F.col("df") + 1)))
    weighed = stash.save(each.join(df, "term").groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("w")))).alias("terms")))
    count = weighed.agg(F.sum(F.size("terms"))).first()[0] or 0
    jobs = -(-count // terms)
    schema = f"query bigint, part int, id {id_type}, score bigint"

    def job(j: int) -> DataFrame:
        q = Queries(weighed.where(F.pmod(F.xxhash64("query"), jobs) == j).collect())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            best: list[list] = [[] for _ in q.numbers]
            seen: Counter = Counter()
            kind = None
            for b in batches:
                kind = kind or b.schema.field("ids").type.value_type
                for i in range(b.num_rows):
                    row = {c: b.column(c)[i] for c in b.schema.names}
                    search_block({c: v.values if c == "terms" else v.as_py() for c, v in row.items()}, q, best, k, n, length, seen)
            rows = [(query, d, -s) for query, found in zip(q.numbers, best) for s, _, d in found]
            if rows:
                a, d, s = zip(*rows)
                part = pa.array(np.full(len(rows), TaskContext.get().partitionId() % 64, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), part, pa.array(d, kind), pa.array(s, pa.int64())], names=["query", "part", "id", "score"])

        return blocks.select("ids", "lengths", "rows", "levels", "slices", "terms", "doc", "term", "tf").mapInArrow(run, schema)

    none = spark.createDataFrame([], schema)
    found = reduce(DataFrame.unionByName, [job(j) for j in range(jobs)], none)
    ranked = _top(_top(found, ["query", "part"], k).drop("rank"), ["query"], k)
    return ranked.join(asked.select("query", F.col("id").alias("query_id")), "query").select(F.col("query_id").alias("query"), "rank", "id", "score")
