import hashlib
import random
import zlib

import numpy as np
import pytest

from tideline.llm import queries as Q
from tideline.llm import runs as R


def slow(w, least=12):
    """(start, length, period) of all runs, by comparing the words at every distance."""
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        same = np.append([x == y for x, y in zip(w, w[q:])], False)
        i = 0
        while i < len(same):
            if not same[i]:
                i += 1
                continue
            j = i + int(np.argmin(same[i:]))
            if j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)  # smaller periods come first
            i = j
    return sorted(((i, n, q) for (i, n), q in out.items()), key=lambda r: (r[0], r[2]))


def kept(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def planted(r, docs):
    for _ in range(r.randint(0, 3)):
        if docs:
            a, p = r.randrange(len(docs)), r.randint(1, 8)
            docs[a:a] = docs[a : a + p] * r.randint(1, 6)
    return docs


@pytest.mark.parametrize("least", [2, 4, 5, 7, 12])
def test_runs_against_all_distances(least):
    r = random.Random(least)
    for _ in range(400):
        docs = [planted(r, [r.randint(0, r.choice([0, 1, 2, 9])) for _ in range(r.randint(0, 60))]) for _ in range(r.randint(1, 4))]
        got = R.find_runs(np.array(sum(docs, []), np.int64), np.array([len(d) for d in docs]), least)
        assert [tuple(x) for x in got.tolist()] == [(k, *x) for k, d in enumerate(docs) for x in slow(d, least)]


def test_suffixes():
    r = random.Random(1)
    for _ in range(200):
        s = [r.randint(0, r.choice([0, 1, 3, 40])) for _ in range(r.randint(1, 60))]
        sa, common = R.ordered_suffixes(np.array(s))
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        for a, b, c in zip(sa, sa[1:], common):
            x, y = s[a:], s[b:]
            assert x[:c] == y[:c] and x[c : c + 1] != y[c : c + 1]


def test_op11(spark, sf):
    want = {}
    for x in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = (x.text or "").encode().split()
        h, n = zlib.crc32(str(x.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        found = slow(w)
        best = min(found, key=lambda t: (-t[1], t[0], t[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want[x.doc_id] = (len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept(w, found))).hexdigest())
    got = {x.doc_id: tuple(x)[1:] for x in Q.op11_runs(spark, sf).collect()}
    assert got == want
    assert sum(x[0] > 0 for x in want.values()) > 10


def test_edges(spark):
    """Nulls, empty and blank texts, repeated rows, a very long text, clashing columns; words are split at six bytes only."""
    long = "a b c " * 50_000
    nbsp = "x\u00a0y\u00a0z\x1c " * 6
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n\x0b\x0c\r", 0), (4, "w " * 12, 0), (4, "w " * 12, 0), (None, "w " * 11, 0), (5, long, 0), (6, nbsp * 2, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    got = sorted((str(x.id), x.n_words, [tuple(r) for r in x.runs], bytes(x.kept)) for x in R.periodic_runs(df).collect())
    w = "x\u00a0y\u00a0z\x1c".encode()
    assert got == sorted([("1", 0, [], b""), ("2", 0, [], b""), ("3", 0, [], b""), ("4", 12, [(0, 12, 1)], b"w"), ("4", 12, [(0, 12, 1)], b"w"), ("None", 11, [], b" ".join([b"w"] * 11)), ("5", 150_000, [(0, 150_000, 3)], b"a b c"), ("6", 12, [(0, 12, 1)], w)])
    assert R.periodic_runs(df.limit(0)).count() == 0
