"""The pipeline's near-duplicate stage against exact Jaccard similarity of all pairs."""

import random
import time

import corpus_pipeline as P
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_contracts import components

from tideline.llm import common, nearcopies, simhash


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def groups(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    return components(ids, [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9])


def edited(r, words, n):
    w = list(words)
    for _ in range(n):
        w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [1000, 8])
def test_stage_matches_exact_jaccard(spark, monkeypatch, block):
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    r = random.Random(5)
    rows, line = [], "a line that very many of these texts have in common"
    for _ in range(25):
        base = [f"w{r.randrange(10**5)}" for _ in range(r.randint(20, 200))]
        rows += [" ".join(base), *[edited(r, base, r.randint(0, max(1, len(base) // 35))) + (" " + line if r.random() < 0.5 else "") for _ in range(5)]]
    hot = [f"h{k}" for k in range(150)]
    rows += [edited(r, hot, r.randint(1, 4)) for _ in range(60)] + ["", None, " \n", "Two words", "two  words", "other words"]
    rows = list(enumerate(rows)) + [(None, " ".join(hot))]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want = groups(rows)
    assert 30 < len(set(want.values())) < len(want)
    got = nearcopies.near_copies(df).collect()
    assert {x.id: x.component_id for x in got} == want and {x.id for x in got if x.kept} == set(want.values())
    kept = [x.doc_id for x in P.simhash_stage(spark, df, "").collect()]
    assert sorted(k for k in kept if k is not None) == sorted(set(want.values())) and kept.count(None) == 1


def test_stage_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = groups([(x.doc_id, x.text) for x in docs.collect()])
    assert sorted(x.doc_id for x in P.simhash_stage(spark, docs, sf).collect()) == sorted(set(want.values()))


def test_empty(spark):
    assert nearcopies.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_and_edge_cases(spark):
    """Different texts under one id are judged each; copies under one id leave one row; rows without an id stay."""
    long = " ".join(f"w{k}" for k in range(60))
    near = long.replace("w30", "x30")
    rows = [(1, long), (5, long), (5, "other words of five here"), (7, near), (7, long), (7, long), (9, None), (9, ""), (3, " "), (None, long), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None, 4, "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, k int, near_key string").repartition(3)
    got = sorted(((x.doc_id, x.text) for x in P.simhash_stage(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, long), (5, "other words of five here"), (3, " "), (None, long), (None, None)], key=str)
    assert P.simhash_stage(spark, docs.limit(0), "").count() == 0


def test_radius():
    """Sets of similarity 0.8 lie well within the radius."""
    r = np.random.default_rng(4)
    for n in (64, 65, 100, 401, 2000):
        far = []
        for _ in range(300):
            x = r.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            common = int(np.ceil(1.6 * n / 1.8))
            a, b = np.sort(x[:n]), np.sort(x[n - common : 2 * n - common])
            far.append(int(np.bitwise_count(nearcopies.fingerprint(a) ^ nearcopies.fingerprint(b)).sum()))
        assert np.mean(far) + 5.5 * np.std(far) < nearcopies.RADIUS


def test_pivot_components():
    r = np.random.default_rng(6)
    base = r.integers(0, 1 << 63, (30, 2), dtype=np.uint64)
    fp = np.repeat(base, 5, axis=0)
    for k in range(len(fp)):
        for bit in r.integers(0, 128, k % 5 * 12):
            fp[k, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    size = r.integers(80, 110, len(fp))
    table = simhash.pivot_table(fp).astype(np.int16)
    links = [(a, b) for a in range(len(fp)) for b in range(a) if np.bitwise_count(fp[a] ^ fp[b]).sum() <= nearcopies.RADIUS and min(size[a], size[b]) >= 0.8 * max(size[a], size[b])]
    want, got = components(range(len(fp)), links), nearcopies.pivot_components(fp, table, size)
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in range(len(fp)) for b in range(a))


def test_only_small_tables_stay(spark, tmp_path, monkeypatch):
    """Prefixes and shingles are gone when the result is read; the disk holds none of them then."""
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    rng = np.random.default_rng(5)
    words = [" ".join(f"w{x}" for x in rng.integers(0, 500, 40)) for _ in range(6)]
    got = nearcopies.near_copies(spark.createDataFrame([(i, words[i % 6] + (" x" if i > 5 else "")) for i in range(12)], "doc_id long, text string"))
    assert got.select("component_id").distinct().count() == 6
    held = {c for f in tmp_path.rglob("*.parquet") if f.is_file() for c in pq.read_schema(f).names}
    assert "id" in held and not held & {"keys", "key", "shingles"}


def test_texts_that_only_meet_are_not_grouped(spark, monkeypatch):
    """Texts that share a few shingles, short or long, are told apart where they meet: no text is read again but for near copies."""
    asked, real = [], nearcopies.linked_in_buckets
    monkeypatch.setattr(nearcopies, "COMMON", 0)  # the sample knows no common shingle, as with rare ones of a large table
    monkeypatch.setattr(nearcopies, "linked_in_buckets", lambda members, *a: asked.append(members.select("s").distinct().count()) or real(members, *a))
    r = random.Random(9)
    line = [f"l{k}" for k in range(20)]
    rows = [" ".join([*line, *[f"w{r.randrange(10**6)}" for _ in range(n)]]) for n in [30] * 40 + [50] * 40 + [150] * 120]
    rows += [rows[0] + " x", rows[199] + " y"]
    got = nearcopies.near_copies(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)).collect()
    assert {x.id: x.component_id for x in got} == {k: {200: 0, 201: 199}.get(k, k) for k in range(202)}
    assert asked[0] > 100 and asked[1] == 4


def test_unrelated_fingerprints_are_apart():
    r = np.random.default_rng(8)
    fp = np.array([nearcopies.fingerprint(np.sort(r.integers(0, 1 << 63, 100, dtype=np.uint64))) for _ in range(400)])
    near = [int((np.bitwise_count(fp[k + 1 :] ^ fp[k]).sum(axis=1) <= nearcopies.RADIUS).sum()) for k in range(400)]
    assert sum(near) == 0


def test_few_shingles_are_compared_exactly():
    """Components of short and longer sets against all pairs, where fingerprints decide only between the longer ones."""
    r = np.random.default_rng(10)
    sets = []
    for n in (1, 3, 20, 51, 62, 63, 64, 70, 78, 79, 80, 90):
        base = r.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        sets += [np.unique(base[k : k + n]) for k in range(0, n, max(1, n // 12))] + [np.unique(base[: n + n // 5])]
    size = np.array([len(s) for s in sets])
    few = [s if len(s) < nearcopies.FEW / nearcopies.SIMILARITY else s[:0] for s in sets]
    fp = np.array([nearcopies.fingerprint(s) for s in sets])
    links = []
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            exact = both >= 0.8 * (size[a] + size[b] - both) - 1e-9
            bits = min(size[a], size[b]) >= 0.8 * max(size[a], size[b]) - 1e-9 and np.bitwise_count(fp[a] ^ fp[b]).sum() <= nearcopies.RADIUS
            if exact if min(size[a], size[b]) < nearcopies.FEW else bits:
                links.append((a, b))
    want, got = components(range(len(sets)), links), nearcopies.pivot_components(fp, simhash.pivot_table(fp).astype(np.int16), size, few)
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in range(len(sets)) for b in range(a))
    assert 12 < len(set(want.values())) < len(sets)


def test_saving_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    stash, disk = common.Stash(spark, "shuffles"), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    set_before, before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"), shuffles()
    held = [spark.range(1000).repartition(3, "id").groupBy((F.col("id") + k).alias("x")).count() for k in range(3)]
    saved = [stash.save(d) for d in held]
    until = time.time() + 20
    while time.time() < until and shuffles() - before:
        time.sleep(0.2)
    assert not {x for x in shuffles() - before if x.endswith(".data")} and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == set_before
    assert all(d.count() == 1000 for d in (*saved, *held))
