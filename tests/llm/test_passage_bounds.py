"""Repeated passages against brute force: in short lines, across lines, at text ends, in texts of several parts."""

import random

import numpy as np
import pytest

from tideline.llm import passages
from tideline.llm import queries as Q


def prose(r, n):
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(n)]


def covered(rows, least):
    """{(row number, word number): removed} by brute force over all strings of `least` words; rows are (id, text)."""
    words = [(t or "").split() for _, t in rows]
    places = {}
    for i, w in enumerate(words):
        for s in range(len(w) - least + 1):
            places.setdefault(tuple(w[s : s + least]), []).append((rows[i][0], s, i))
    kept, removed = set(), set()
    for where in places.values():
        if len(where) > 1:
            for k, (_, s, i) in enumerate(sorted(where)):
                (removed if k else kept).update((i, x) for x in range(s, s + least))
    return kept, removed


def reported(rows, got):
    number = {i: k for k, (i, _) in enumerate(rows)}
    out = {False: set(), True: set()}
    for x in got:
        out[x.removed].update((number[x.id], w) for w in range(x.start_word, x.start_word + x.n_words))
    return out[False], out[True]


def mixed_texts(r, n, passage_words, blanks=" \n  \t"):
    shared = [prose(r, passage_words + k) for k in range(6)]
    rows = []
    for i in range(n):
        w = prose(r, r.randint(0, 150))
        for _ in range(r.randint(0, 3)):
            p = r.choice(shared)
            cut = r.randint(0, 8)
            at = r.choice([0, len(w), r.randint(0, len(w))])
            w[at:at] = p[cut:]
        rows.append((i, "".join(x + r.choice(blanks) for x in w)))
    return rows


@pytest.mark.parametrize("least, part, words", [(51, 1 << 20, 1 << 18), (51, 300, 130), (12, 1000, 77)])
def test_brute_force(spark, monkeypatch, least, part, words):
    monkeypatch.setattr(passages, "PART", part)
    monkeypatch.setattr(passages, "_WORDS", words)
    r = random.Random(least + part)
    rows = mixed_texts(r, 60, least + 4, " \n  \t" if least > 50 else " \t") + [(60, ""), (61, None), (62, " ".join(["a"] * 200)), (63, " ".join(prose(r, least - 1)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept, removed = covered(rows, least)
    assert kept and removed
    assert reported(rows, passages.passages(df, least=least).collect()) == (kept, removed)


def test_long_text(spark):
    """A passage far inside a text of over a megabyte, and one over the border of its parts."""
    r = random.Random(8)
    deep, border = prose(r, 60), prose(r, 70)
    long = prose(r, 260_000)
    size = np.cumsum([len(w) + 1 for w in long])
    at = int(np.searchsorted(size, passages.PART)) - 30
    long[at:at] = border
    long[-90_000:-90_000] = deep
    rows = [(1, " ".join(long)), (2, " ".join(prose(r, 40) + deep + prose(r, 40))), (3, " ".join(prose(r, 9) + border))]
    assert len(rows[0][1]) > passages.PART
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert reported(rows, got) == covered(rows, passages.LEAST)


def test_op9_brute_force(spark, sf):
    """The registered query: every repeated string is found with its exact bounds; what else is found are near copies."""
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = Q.op9_passages(spark, sf).withColumnRenamed("doc_id", "id").collect()
    kept, removed = covered(rows, passages.LEAST)
    has_kept, has_removed = reported(rows, got)
    assert kept and kept <= has_kept | has_removed and removed <= has_removed

    def shingles(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    number = {i: k for k, (i, _) in enumerate(rows)}
    lines = [(number[i], at, w, shingles(w)) for i, t in rows for at, w in lines_of(t) if len(w) >= passages.LINE]
    near = set()
    for a, (i, at, w, x) in enumerate(lines):
        for j, to, v, y in lines[:a]:
            if w == v or len(x & y) >= 0.8 * len(x | y):
                near |= {(i, n) for n in range(at, at + len(w))} | {(j, n) for n in range(to, to + len(v))}
    # lines and strings next to each other make one passage, which has enough words
    every, extra, long, run = near | kept | removed, near - kept - removed, set(), []
    for i, n in [*sorted(every), (-1, -1)]:
        if run and (i, n - 1) != run[-1]:
            long |= set(run) if len(run) >= passages.LEAST else set()
            run = []
        run.append((i, n))
    assert has_kept | has_removed <= kept | removed | extra & long
    missed = (extra & long) - has_kept - has_removed
    assert len(missed) <= 0.02 * len(long)  # runs of kept and of removed lines are apart


def lines_of(text):
    out, at = [], 0
    for line in (text or "").split("\n"):
        w = line.split()
        if w:
            out.append((at, w))
        at += len(w)
    return out


@pytest.mark.parametrize("words", [1 << 18, 97])
def test_band_keys_alike(monkeypatch, words):
    """Band keys do not depend on how many paragraphs are taken at once."""
    monkeypatch.setattr(passages, "_WORDS", words)
    r = random.Random(4)
    text = "\n".join(" ".join(prose(r, r.choice([3, 60, 250]))) for _ in range(80))
    number, line, h = passages.words_of([text.encode(), b"", text.encode()])
    text_, at, n, name, keys = passages.paragraphs(number, line, h, 51)
    start = at + (text_ == 2) * (len(h) // 2)
    monkeypatch.setattr(passages, "_WORDS", 1 << 18)
    assert len(at) and (keys == [passages.band_keys(h[s : s + m]) for s, m in zip(start, n)]).all()


def test_edited_lines_make_a_passage(spark):
    """Lines too short for a passage, each edited at an edge or in the middle, follow each other; alone they are none."""
    r = random.Random(4)
    five = [prose(r, 50) for _ in range(5)]
    short = [prose(r, 24) for _ in range(4)]
    edited = lambda lines, at: "\n".join(" ".join(w[:at] + ["changed"] + w[at + 1 :]) for w in lines)
    plain = lambda lines: "\n".join(map(" ".join, lines))
    rows = [(1, plain(five)), (2, edited(five, 25)), (3, plain(short)), (4, edited(short, 0)), (5, plain(short[:1]) + "\n" + " ".join(prose(r, 60))), (6, " ".join(prose(r, 60)) + "\n" + plain(short[1:2])), (7, plain([short[0], short[2]]) + "\n" + " ".join(prose(r, 9)))]
    got = {(x.id, x.start_word, x.n_words, x.component_id, x.removed) for x in passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    assert got == {(1, 0, 250, 1, False), (2, 0, 250, 1, True), (3, 0, 96, 3, False), (4, 0, 96, 3, True)}


def test_repeated_rows_are_counted(spark):
    """Of rows alike in id and text one stays; a thousand of them are one row on the way."""
    r = random.Random(5)
    w, v = " ".join(prose(r, 60)), " ".join(prose(r, 70))
    rows = [(None, w)] * 4 + [(3, v)] * 1000 + [(4, v)] + [(5, " ".join(prose(r, 20)))] * 3 + [(6, "")] * 2 + [(7, None)] * 2
    got = (((x.id or 0), x.start_word, x.n_words, x.component_id, x.removed) for x in passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    key = lambda n, k, c, gone: (n, 0, k, c, gone)
    assert sorted(got, key=str) == sorted([key(0, 60, None, False)] + [key(0, 60, None, True)] * 3 + [key(3, 70, 3, False)] + [key(3, 70, 3, True)] * 999 + [key(4, 70, 3, True)], key=str)
