import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tideline.llm import queries as Q
from tideline.llm import repeats, suffix


def slow(texts, length):
    """Per text: (bytes, removed, spans, kept)."""
    count = Counter(hash_ for t in texts for hash_ in (t[i : i + length] for i in range(len(t) - length + 1)))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), kept))
    return out


def test_suffix_array():
    r = random.Random(1)
    for _ in range(200):
        k = r.choice([1, 2, 3, 5, 40])
        s = [r.randint(1, k) for _ in range(r.randint(1, 60))] + [0]
        assert suffix.suffix_array(np.array(s), k + 1).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("contexts", [4000, 1])
def test_small_against_brute_force(spark, contexts):
    r = random.Random(contexts)
    passages = ["".join(r.choice("abcé ") for _ in range(r.randint(8, 60))) for _ in range(12)]
    texts = ["".join(r.choice(passages) if r.random() < 0.5 else "".join(r.choice("abcdefgh é") for _ in range(r.randint(1, 40))) for _ in range(r.randint(0, 6))) for _ in range(120)]
    texts += [None, "", "a" * 300, "ab" * 90, texts[3], texts[3]]
    rows = [(i if i % 9 else None, t, 7) for i, t in enumerate(texts)] + [(3, texts[3], 7)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, h int").repartition(3)
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(df, length=20, gram=6, contexts=contexts).collect())
    assert got == sorted(slow([(t or "").encode() for _, t, _ in rows], 20))


def test_op3(spark, sf):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: (n, g, s, hashlib.sha256(k).hexdigest()) for (d, _), (n, g, s, k) in zip(docs, slow([t for _, t in docs], 200))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in Q.op3_suffix_array(spark, sf).collect()}
    assert got == want


def test_empty(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
