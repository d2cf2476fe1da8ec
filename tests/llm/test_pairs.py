"""Vector links and repeated passages against brute force."""

import random

import numpy as np

from tideline.llm import hnsw, passages
from tideline.llm import queries as Q

from test_contracts import components


def slow_links(rows, cosine=0.9):
    """n_links and component per row number for (id, vector) rows."""
    good = {i: np.array(v, float) for i, (k, v) in enumerate(rows) if k is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    ids = sorted(unit)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if unit[a] @ unit[b] >= cosine]
    n = {i: 0 for i in range(len(rows))}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = components(range(len(rows)), links)
    low = {}
    for i, c in comp.items():
        if i in good:
            low[c] = min(low.get(c, rows[i][0]), rows[i][0])
    return [(rows[i][0], n[i], low[comp[i]] if i in good else rows[i][0]) for i in range(len(rows))]


def test_vectors_edge_cases(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 8))
    vs = [list(map(float, base[i % 40] + r.normal(size=8) * (0.15 if i >= 40 else 0))) for i in range(160)]
    vs += [vs[0], vs[0], [x * 2 for x in vs[1]], None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [float("inf")] * 8]
    rows = list(enumerate(vs)) + [(None, vs[2]), (5, vs[5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = hnsw.near_vectors(df, shards=3).collect()
    assert all(x.recall >= hnsw.RECALL for x in got)
    got = [tuple(x)[:3] for x in got]
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted(slow_links(rows), key=key)


def test_op5(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in Q.op5_hnsw(spark, sf).collect())
    assert got == sorted(slow_links(rows))


def test_blocks_and_clashing_names(spark, monkeypatch):
    """Many query blocks for each graph, rows that repeat, and columns named as the operator's own."""
    monkeypatch.setattr(hnsw, "QUERY_ROWS", 40)
    r = np.random.default_rng(8)
    base = r.normal(size=(60, 6))
    rows = [(i, list(map(float, base[i % 60] + r.normal(size=6) * 0.1)), i, 0.5, "x") for i in range(300)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int, recall double, id string").repartition(3)
    got = sorted(tuple(x)[:3] for x in hnsw.near_vectors(df, shards=4).collect())
    assert got == sorted(slow_links([x[:2] for x in rows]))


def test_audit_sees_losses():
    """Queries' own nodes count for nothing: a beam that misses neighbours is widened even where no pair links."""
    r = np.random.default_rng(5)
    x = r.normal(size=(4000, 64))
    g = hnsw.Graph(x / np.linalg.norm(x, axis=1, keepdims=True))
    pick = np.arange(0, 4000, 20)
    links = g.x @ g.x.T >= 0.95
    np.fill_diagonal(links, False)
    assert not links.any()
    beam, recall = g.audited_beam(g.x[pick], pick, 0.95, 10)
    assert beam > 10 and recall == 1.0


def test_graph_rows():
    r = np.random.default_rng(6)
    x = r.normal(size=(700, 12))
    g = hnsw.Graph(x / np.linalg.norm(x, axis=1, keepdims=True))
    h = hnsw.Graph.of_rows(g.x, g.level, np.concatenate(g.rows()))
    assert h.entry == g.entry and len(h.next) == len(g.next) and all((a == b).all() for a, b in zip(g.next, h.next))


def test_graph_recall():
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 32))
    x = np.concatenate([x, np.repeat(x[:20], 30, axis=0) + r.normal(size=(600, 32)) * 0.05])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = hnsw.Graph(x)
    truth = g.x @ g.x.T >= 0.9
    a, b, _ = g.within(g.x, 0.9, hnsw.BEAM)
    assert truth[a, b].sum() >= 0.99 * truth.sum()


def test_vectors_empty(spark):
    assert hnsw.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_passages(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    planted = [prose(55) for _ in range(6)]
    texts = {i: prose(r.randint(30, 400)) for i in range(60)}  # clean
    for i in range(60, 120):
        w = prose(200).split(" ")
        at = r.randint(0, 200)
        texts[i] = " ".join(w[:at] + [planted[i % 6]] + w[at:])
    para = prose(90).split(" ")
    for i in range(120, 130):  # near copies of a paragraph, a word changed
        w = list(para)
        w[r.randint(0, 89)] = "other"
        texts[i] = prose(40) + "\n" + " ".join(w) + "\n" + prose(40)
    texts |= {130: None, 131: "", 132: "a " * 500}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = passages.passages(df).collect()
    found = {x.id for x in got}
    assert found >= set(range(60, 130)) and not found & set(range(60))
    for i in range(60, 120):  # the whole of the inner part of a planted passage
        w = texts[i].split()
        run = max((x for x in got if x.id == i), key=lambda x: x.n_words)
        assert set(w[run.start_word : run.start_word + run.n_words]) <= set(planted[i % 6].split())
        assert run.component_id == 60 + i % 6 and run.removed == (i >= 66)
    near = {x.id: x for x in got if 120 <= x.id < 130 and x.n_words == 90}
    assert len(near) >= 9 and len({x.component_id for x in near.values()}) == 1


def test_jaccard_components():
    r = np.random.default_rng(2)
    sets = []
    for _ in range(12):
        base = r.integers(0, 10_000, 60)
        sets += [np.unique(np.concatenate([base[r.random(60) < 0.93], r.integers(0, 10_000, 2)])).astype(np.uint64) for _ in range(4)]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))]
    want = components(range(len(sets)), links)
    label = passages.jaccard_components(sets)
    assert all((label[a] == label[b]) == (want[a] == want[b]) for a in range(len(sets)) for b in range(a))


def test_dense_cluster_among_others(spark):
    """Most vectors within the bound of each other: their beams end at a share of the shard, the rest is compared in blocks."""
    r = np.random.default_rng(12)
    base = r.normal(size=64)
    x = np.concatenate([base + r.normal(size=(2500, 64)) * 0.2, base * 0.2 + r.normal(size=(200, 64)) * 0.8, r.normal(size=(300, 64))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert near.sum() > 4_000_000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = sorted((t.id, t.n_links, t.component_id) for t in hnsw.near_vectors(df, shards=2).collect())
    comp = components(range(len(x)), list(zip(*(c.tolist() for c in np.nonzero(np.triu(near))))))
    assert got == [(i, int(near[i].sum()), comp[i]) for i in range(len(x))]


def test_vectors_of_extreme_length(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.1e200]), (3, [1e-200, 1e-200]), (4, [5e-324, 5e-324]), (5, [-1e308, 1e308]), (6, [0.0, 1.0])]
    got = sorted(tuple(t)[:3] for t in hnsw.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shards=2).collect())
    assert got == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 0, 5), (6, 0, 6)]
