"""Language identification by word-first backoff: known words by log frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Stash, small_batches

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Longest character n-gram.
ORDER = 5
#: Words with scores that are sent to every task (frequent ones, of at most WIDTH letters), and cells of their table.
TIER, CELLS, WIDTH = 100_000, 2_000_000, 64
#: Different words or n-grams that a counting task holds before it passes their counts on.
HELD = 50_000
MICRO = 1_000_000


#: Bytes that no word has become spaces; bytes of multi-byte characters stay.
ASCII = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def words_of(text: str | None) -> list[str]:
    """Lower-cased words: letters, with the marks that follow them."""
    return WORD.findall(text.lower()) if text else []


def pieces_of(text: str | None) -> list[bytes]:
    """A text cut at every ASCII character that is no letter. A piece is a word, or holds other characters too (`words_in`)."""
    return text.lower().encode().translate(ASCII).split() if text else []


def words_in(piece: bytes) -> list[str]:
    word = piece.decode()
    return [word] if word.isalpha() else WORD.findall(word)


def counted(pieces: Iterable[tuple[bytes, int]]) -> Counter:
    """Words of counted pieces."""
    out: Counter = Counter()
    for p, n in pieces:
        for w in words_in(p):
            out[w] += n
    return out


def _count_rows(key: object, kind: pa.DataType, found: dict[str, int], names: list[str]) -> Iterator[pa.RecordBatch]:
    words = list(found)
    for i in range(0, len(words), 50_000):
        part = words[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([key] * len(part), kind), pa.array([found[w] for w in part], pa.int64())], names=names)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, lang, n) over all rows of docs (text, lang): pre-aggregated in each task, a null lang for what is not learned."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                yield from _count_rows(lang, pa.string(), counted(held.pop(lang).items()), ["word", "lang", "n"])

        for b in batches:
            for text, lang in zip(b.column("text"), b.column("lang")):
                held.setdefault(lang.as_py(), Counter()).update(pieces_of(text.as_py()))
                if sum(map(len, held.values())) > HELD:
                    yield from out()
        yield from out()

    return docs.mapInArrow(count, "word string, lang string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))


def gram_counts(known: DataFrame, order: int) -> DataFrame:
    """(gram, k, n): character n-grams of 1 to `order` letters of words (word, k, n) with a space on both sides."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for k in list(held):
                yield from _count_rows(k, pa.int32(), held.pop(k), ["gram", "k", "n"])

        for b in batches:
            for word, k, n in zip(b.column("word").to_pylist(), b.column("k").to_pylist(), b.column("n").to_pylist()):
                found, padded = held.setdefault(k, {}), f" {word} "
                for size in range(1, order + 1):
                    for i in range(len(padded) - size + 1):
                        g = padded[i : i + size]
                        found[g] = found.get(g, 0) + n
                if sum(map(len, held.values())) > HELD:
                    yield from out()
        yield from out()

    return known.select("word", "k", "n").mapInArrow(count, "gram string, k int, n bigint").groupBy("gram", "k").agg(F.sum("n").alias("n"))


def dealt(rows: DataFrame) -> DataFrame:
    """A side of a join that grows with the vocabulary, never sent whole through the driver: Spark would judge it by the size of its
    compressed files, of which exploded n-grams and lists of gains make many times as much."""
    return rows.hint("merge")


def grams(word: Column, n: int) -> Column:
    """Character n-grams of a word with a space on both sides."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.when(F.length(word) + 2 >= n, F.transform(F.sequence(F.lit(1), F.length(word) + 3 - n), lambda i: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


class Model:
    """Scores of all words of a corpus as a written table, the frequent ones also as a table of bounded size.

    A score is what a word adds to a language: log10 of its share among the language's words over the share of an event ten
    times rarer than any that was seen, in millionths; 0 for a language that does not have it. Integers, so sums do not
    depend on their order.
    """

    def __init__(self, docs: DataFrame, stash: Stash, order: int = ORDER, tier: int = TIER):
        counts = stash.save(word_counts(docs))
        known = counts.where("lang IS NOT NULL")
        totals = known.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").collect()  # one row a language
        self.langs = [r["lang"] for r in totals]
        if not totals:
            self.scores = self.words = None
            return
        number = docs.sparkSession.createDataFrame(list(enumerate(self.langs)), "k int, lang string")
        known = known.join(F.broadcast(number), "lang")  # one row a language, from the driver

        def scored(rows: DataFrame, total: list[int]) -> DataFrame:
            """rows (..., k, n) with the gain of each."""
            logs = F.array(*[F.lit(float(np.log10(t))) for t in total])
            top = float(np.log10(max(total))) + 1
            return rows.withColumn("gain", F.round(MICRO * (top + F.log10("n") - F.element_at(logs, F.col("k") + 1))).cast("long"))

        gains = F.collect_list(F.struct("k", "gain")).alias("gains")
        parts = [stash.save(scored(known, [r["n"] for r in totals]).groupBy("word").agg(gains))]
        unseen = stash.save(counts.groupBy("word").agg(F.max("lang").alias("lang")).where("lang IS NULL").select("word"))
        table = stash.save(gram_counts(known, order)) if not unseen.isEmpty() else None
        for n in range(order, 0, -1):  # unseen words by the longest n-grams of which one is known
            if table is None or unseen.isEmpty():
                break
            mine = table.where(F.length("gram") == n)
            of = {r["k"]: r["n"] for r in mine.groupBy("k").agg(F.sum("n").alias("n")).collect()}  # one row a language
            if not of:
                continue
            mine = scored(mine, [of.get(k, 1) for k in range(len(self.langs))]).groupBy("gram").agg(gains)
            hit = unseen.select("word", F.explode(grams(F.col("word"), n)).alias("gram")).join(dealt(mine), "gram")
            size = hit.groupBy("word").agg(F.count("*").alias("size"))
            mean = hit.select("word", F.inline("gains")).groupBy("word", "k").agg(F.sum("gain").alias("gain")).join(dealt(size), "word")
            parts.append(stash.save(mean.withColumn("gain", F.expr("gain div size")).groupBy("word").agg(gains)))
            unseen = stash.save(unseen.join(dealt(parts[-1].select("word")), "word", "left_anti"))
        scores = parts[0]
        for p in parts[1:]:
            scores = scores.unionByName(p)
        self.scores = stash.save(scores.join(dealt(counts.groupBy("word").agg(F.sum("n").alias("total"))), "word"))
        # the rarest class of frequencies, by powers of two, that still fits
        bound = max(1, min(tier, CELLS // len(self.langs)))
        fits, least = 0, None
        classes = self.scores.where(F.length("word") <= WIDTH).groupBy(F.floor(F.log2("total")).alias("c")).agg(F.count("*").alias("n"))
        for r in classes.orderBy(F.desc("c")).collect():  # at most 64 rows
            fits += r["n"]
            if fits > bound:
                break
            least = r["c"]
        near = self.scores.where((F.length("word") <= WIDTH) & (F.floor(F.log2("total")) >= F.lit(least)) if least is not None else F.lit(False))
        near = near.select("word", "gains").toArrow().combine_chunks()  # at most `bound` rows, as columns
        self.words = {w.encode(): i for i, w in enumerate(near.column("word").to_pylist())}
        self.table = np.zeros((near.num_rows + 1, len(self.langs)), np.int64)
        for lists in near.column("gains").chunks:  # one, or none of an empty table
            each = lists.flatten()
            self.table[np.repeat(np.arange(len(lists)), lists.value_lengths()), each.field("k").to_numpy()] = each.field("gain").to_numpy()
        self.complete = self.scores.where(F.length("word") > WIDTH).isEmpty() and fits <= bound


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER, tier: int = TIER) -> DataFrame:
    """(id, lang_pred, score) of each row; learned from the texts and non-null languages of rows for which `learn` holds.

    A language's mark for a text is the mean over its words of their gain (see Model): known words have their own, words that
    no learned text has the mean of their longest known character n-grams, words without any known letter none. The best mark wins (ties:
    the language with more learned words, then its name). score: one over the sum over languages of ten to the power of
    their mark less the best, so 1 for certain and one over the number of languages for no evidence.

    Rows that are null or have no letter, and all rows if nothing could be learned, get `und` and 0. One row for each row,
    repeated rows and null ids included; whole texts; an empty table gives no row; other columns are ignored.

    Words are counted over all rows and scored once each, by joins; at most `tier` frequent words go to every task, and a text's
    other words (none of which is frequent) come back by a join with the table of all words.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stash = Stash(spark, "langid")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    model = Model(docs.select(F.col(text).alias("text"), F.when(F.coalesce(learn, F.lit(False)), F.col(lang)).alias("lang")), stash, order, tier)
    kind = docs.schema[id_col].dataType.simpleString()
    if not model.langs:
        return rows.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    n_langs = len(model.langs)
    words, table = model.words, model.table

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, sums, rest = [], [], []
            for t in b.column("text"):  # one text's words at a time
                found = Counter(pieces_of(t.as_py()))
                odd = [p for p in found if p not in words]
                more = counted((p, found.pop(p)) for p in odd)
                known = [w for w in more if w.encode() in words]
                found.update({w.encode(): more.pop(w) for w in known})
                at = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
                sums.append(np.fromiter(found.values(), np.int64, len(found)) @ table[at])
                counts.append(found.total() + more.total())
                rest.append([{"word": w, "n": x} for w, x in more.items()])
            out = [b.column("id"), pa.array(counts, pa.int64()), pa.array([x.tolist() for x in sums], pa.list_(pa.int64())), pa.array(rest, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))]
            yield pa.RecordBatch.from_arrays(out, names=["id", "n_words", "sums", "rest"])

    out = rows.mapInArrow(score, f"id {kind}, n_words bigint, sums array<bigint>, rest array<struct<word:string,n:bigint>>")
    if not model.complete:
        out = stash.save(out.withColumn("row", F.monotonically_increasing_id()))
        rare = out.select("row", F.inline("rest")).join(dealt(model.scores.select("word", "gains")), "word").select("row", "n", F.inline("gains"))
        rare = rare.groupBy("row", "k").agg(F.sum(F.col("gain") * F.col("n")).alias("gain"))
        rare = rare.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("k", "gain"))).alias("more"))
        out = out.join(dealt(rare), "row", "left").withColumn("sums", F.transform("sums", lambda x, i: x + F.coalesce(F.element_at("more", i), F.lit(0))))
    best = F.array_max("sums")
    odds = F.aggregate("sums", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), (x - best) / F.col("n_words") / MICRO))
    name = F.element_at(F.array(*[F.lit(x) for x in model.langs]), F.array_position("sums", best).cast("int"))
    some = F.col("n_words") > 0
    return out.select("id", F.when(some, name).otherwise("und").alias("lang_pred"), F.when(some, 1 / odds).otherwise(0.0).alias("score"))
