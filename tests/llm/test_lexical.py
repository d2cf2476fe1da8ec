import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tideline.llm import lexical as L
from tideline.llm import queries as Q

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items, k):
    """(query id, rank, id, score) by scoring everything."""
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for q, text in set(items):
        found = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, i is None, i))
        found.sort(key=lambda x: x[:2] if x[1] else x)
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def test_terms():
    s = "Ab-c_d 9Zé\x00É\x7fa漢字;ñ x²"
    assert [t.decode() for t in L.terms_of(s.encode())] == terms(s)


@pytest.mark.parametrize("budget", [L.TERMS, 20])
def test_op12_against_scoring_everything(spark, sf, budget):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = slow([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 50)
    if budget == L.TERMS:
        got = Q.op12_lexical(spark, sf).select("item_id", "rank", "doc_id", "score")
    else:
        got = L.search(docs.repartition(5), items.limit(3), terms=budget)
        want = [w for w in want if w[0] in {r.item_id for r in items.limit(3).collect()}]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_edges(spark):
    """Nulls, texts without terms, ties, repeated rows, terms of high frequency, clashing columns, empty tables."""
    rows = [(3, "fox dog", 1), (1, "dog fox", 1), (None, "fox dog", 1), (1, "dog fox", 1), (7, None, 1), (8, "-- ;", 1), (9, "cat " * 5000, 1), (10, "cat " * 3 + "bird", 1), (11, "owl " * 40, 1)]
    asked = [(1, "Fox, DOG"), (1, "Fox, DOG"), (1, "bird cat"), (None, "dog"), (4, None), (5, "nothing here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int").repartition(3)
    items = spark.createDataFrame(asked, "item_id long, text string")
    for k in (2, 50):
        assert sorted((tuple(r) for r in L.search(docs, items, k).collect()), key=str) == slow([r[:2] for r in rows], asked, k)
    assert L.search(docs.limit(0), items).count() == 0 and L.search(docs, items.limit(0)).count() == 0


def test_bounds_hold_and_exclude(spark, sf):
    """No document scores above its bound, and most are excluded."""
    docs = [(r.doc_id, Counter(L.terms_of((r.text or "").encode()))) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = [(i, c) for i, c in docs if c]
    size = 1 << max(sum(map(int.bit_length, c.values())) for _, c in docs).bit_length()
    block = L._block(docs, size * L.ROOM)
    block["terms"] = pa.array(block["terms"], pa.binary())
    n, length = len(docs), sum(block["lengths"])
    df = Counter(t for _, c in docs for t in c)
    asked = [sorted(t for t in set(L.terms_of(r.text.encode())) if df[t]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    q = L.Queries([{"query": i, "terms": [{"term": t, "w": math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))} for t in ts]} for i, ts in enumerate(asked)])
    m = 50 + 50 * np.array(block["lengths"]) * n // length
    slices = np.frombuffer(block["slices"], np.uint8).reshape(block["rows"], -1)
    bound = L.upper_bounds(q, slices, block["rows"], block["levels"], m)
    for i, ts in enumerate(asked):
        for d, (_, c) in enumerate(docs):
            assert sum(int(q.weights[q.terms.index(t)]) * int(L.part_score(np.int64(c[t]), m[d])) for t in ts if c[t]) <= bound[i, d]
    seen = Counter()
    L.search_block(block, q, [[] for _ in asked], 3, n, length, seen)
    assert 0 < seen["scored"] < seen["pairs"] / 2
