import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import common
from tideline.llm import langid as G
from tideline.llm import queries as Q


def slow(rows, order):
    """[(lang_pred, score)] of rows (text, lang, learn), by plain dictionaries."""
    count, gram = defaultdict(Counter), {n: defaultdict(Counter) for n in range(1, order + 1)}
    for text, lang, learn in rows:
        if learn and lang is not None:
            count[lang].update(G.words_of(text))
    count = {k: c for k, c in count.items() if c}
    langs = sorted(count, key=lambda k: (-sum(count[k].values()), k))
    parts = lambda w, n: [f" {w} "[i : i + n] for i in range(len(w) + 3 - n)]
    for lang in langs:
        for w, x in count[lang].items():
            for n in gram:
                for g in parts(w, n):
                    gram[n][lang][g] += x

    def gains(table, key):
        total = {k: sum(table[k].values()) or 1 for k in langs}
        top = float(np.log10(max(total.values()))) + 1
        return [int(np.floor(G.MICRO * (top + np.log10(table[k][key]) - float(np.log10(total[k]))) + 0.5)) if table[k][key] else 0 for k in langs]

    def word(w):
        if any(count[k][w] for k in langs):
            return gains(count, w)
        for n in range(order, 0, -1):
            found = [gains(gram[n], g) for g in parts(w, n) if any(gram[n][k][g] for k in langs)]
            if found:
                return [sum(x) // len(found) for x in zip(*found)]
        return [0] * len(langs)

    out = []
    for text, _, _ in rows:
        ws = Counter(G.words_of(text))
        if not ws or not langs:
            out.append(("und", 0.0))
            continue
        sums = np.sum([np.array(word(w)) * x for w, x in ws.items()], axis=0)
        odds = sum(10 ** ((s - max(sums)) / sum(ws.values()) / G.MICRO) for s in sums)
        out.append((langs[int(np.argmax(sums))], 1 / odds))
    return out


def test_words_by_pieces():
    """Cutting at ASCII first gives the same words."""
    r = random.Random(1)
    letters = "aZé 9-_’ñ漢\u0301\u093eß²İ\u00a0\x1cⅧ"
    for _ in range(2000):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 30)))
        assert G.counted(Counter(G.pieces_of(t)).items()) == Counter(G.words_of(t)), t


@pytest.mark.parametrize("tier", [G.TIER, 3, 0])
def test_small_against_dictionaries(spark, tier):
    """Known and unseen words, no known letter at all, nulls, empty and long texts, repeated rows, marks, ties."""
    texts = [("The cat is on the mat", "en"), ("the dog and the cat", "en"), ("le chat est là", "fr"), ("le chien et le chat, Été", "fr"), ("der Hund und die Katze", "de"), ("नमस्ते दुनिया", "hi")]
    new = ["catting dogs", "chiens chats", "Hunde Katzen", "漢字", "q", None, "", "12 ; --", "ab" * 3000, "the " * 20_000, "दुनियाई", "zzz xxx the"]
    rows = [(i, t, g, True) for i, (t, g) in enumerate(texts)] * 2 + [(100 + i if i else None, t, "en", False) for i, t in enumerate(new)] + [(7, "le chat", None, True), (7, "le chat", None, True), (8, None, "xx", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, learn boolean").withColumn("score", F.lit(1)).repartition(3)
    got = G.identify(df, F.col("learn"), order=3, tier=tier)
    want = sorted(((r[0] is None, r[0] or 0), p, round(s, 9)) for r, (p, s) in zip(rows, slow([r[1:] for r in rows], 3)))
    assert sorted(((r.id is None, r.id or 0), r.lang_pred, round(r.score, 9)) for r in got.collect()) == want


@pytest.mark.parametrize("tier", [3, 0])
def test_no_table_of_words_is_broadcast(spark, monkeypatch, tier):
    """However small its files: only the numbers of the languages go through the driver."""
    plans, real = [], common.Stash.save
    monkeypatch.setattr(common.Stash, "save", lambda self, df, *a: plans.append(df) or real(self, df, *a))
    rows = [(i, f"known{chr(97 + i // 10)}{chr(97 + i % 10)} words in place of others", "en" if i % 2 else "de", i < 30) for i in range(40)]
    plans.append(G.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, learn boolean"), F.col("learn"), tier=tier))
    plans = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    joins, sent = sum(p.count("Join") for p in plans), sum(p.count("BroadcastExchange") for p in plans)
    assert joins > 6 and sent == sum(p.count("BroadcastHashJoin") for p in plans) == 2  # to words, and to words for their n-grams


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in G.identify(df, F.lit(True)).collect()] == [(1, "und", 0.0), (2, "und", 0.0)]
    assert G.identify(df.limit(0), F.lit(True)).count() == 0


def test_op13_held_out(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in Q.op13_langid(spark, sf).collect()}
    assert set(got) == set(docs)
    held = [d for d in docs if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= got[d].score <= 1 for d in docs)
    letters = [d for d in held if G.words_of(docs[d].text) and docs[d].lang]
    assert len(letters) > 20 and sum(got[d].lang_pred == docs[d].lang for d in letters) >= 0.97 * len(letters)
    assert all(got[d].lang_pred == "und" for d in docs if not G.words_of(docs[d].text))
