"""Near-duplicate vectors through hierarchical navigable small-world graphs, one for each shard.

Each shard's graph is built once, by a task of its own, and written to the shared folder. Every vector is a query against every
shard: a task loads one graph and a block of the queries, so neither grows with the table. Within a task the queries of a
batch walk the graph in step, as array operations. A beam is widened for each query whose last place still lies within the
similarity bound, up to a share of the shard beyond which the query is compared with all of it, and for all queries of a shard until an audit passes: vectors of all shards are compared by brute force with
the shard, and their links, themselves left out, must be found, and where those are few their nearest neighbours too. Found pairs are verified in
double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Stash, by_group, connected_components, labels_of, small_batches

COSINE = 0.9
SHARDS = 8
#: Vectors of a shard beyond which there are more shards.
SHARD_ROWS = 100_000
LINKS = 16  # of a node on upper levels; twice as many on the lowest
BEAM, BUILD_BEAM = 48, 48
#: Widest beam, and places of all beams (or cells of a block) in one step.
WIDEST, CELLS = 4096, 1 << 21
#: Queries of a task.
QUERY_ROWS = 25_000
#: Audit queries against each shard, and the recall of their links that is asked for. Where fewer than ENOUGH links were there
#: to lose, NEAREST neighbours of each query must be found too, to a recall of NEAR.
AUDIT, RECALL = 256, 0.99
ENOUGH, NEAREST, NEAR = 100, 10, 0.95


class Graph:
    """A navigable small-world graph over unit vectors, built by inserting batches."""

    def __init__(self, x: np.ndarray, seed: int = 5):
        self.x, n = np.ascontiguousarray(x, np.float32), len(x)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(rng.random(n)) / np.log(LINKS)).astype(int), 6)
        order = np.argsort(-self.level, kind="stable")  # top levels first: the entry point never changes
        self.entry = int(order[0]) if n else -1
        top = int(self.level.max()) if n else 0
        self.next = [np.full((n, LINKS * (2 if lv == 0 else 1)), -1, np.int32) for lv in range(top + 1)]
        at = 1
        while at < n:
            batch = order[at : at + max(1, min(at, 512))]
            self._insert(batch)
            at += len(batch)

    def _insert(self, batch: np.ndarray) -> None:
        start = np.full(len(batch), self.entry)
        for lv in range(len(self.next) - 1, -1, -1):
            here = self.level[batch] >= lv
            ids, sims = self.search(self.x[batch], BUILD_BEAM if here.any() else 1, lv, start)
            start = ids[:, 0]
            rows = np.flatnonzero(here)
            if not len(rows):
                continue
            mine = batch[rows]
            own = self.x[mine] @ self.x[mine].T
            np.fill_diagonal(own, -2)
            k = min(BUILD_BEAM, len(rows))
            near = np.argpartition(-own, k - 1, axis=1)[:, :k]
            cand = np.concatenate([ids[rows], np.where(np.take_along_axis(own, near, 1) > -2, mine[near], -1)], axis=1)
            sim = np.concatenate([sims[rows], np.take_along_axis(own, near, 1)], axis=1)
            sim[cand < 0] = -2
            self._set(lv, mine, cand, sim)
            chosen = self.next[lv][mine]
            a, b = chosen[chosen >= 0], np.repeat(mine, (chosen >= 0).sum(axis=1))
            self._back(lv, a, b)

    def _set(self, lv: int, nodes: np.ndarray, cand: np.ndarray, sim: np.ndarray) -> None:
        """Keep the nearest candidates, preferring those nearer to the node than to one already kept; fill up with the rest."""
        width = self.next[lv].shape[1]
        order = np.argsort(-sim, axis=1, kind="stable")[:, : 3 * width]
        cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
        for at in range(0, len(nodes), 256):
            c, s = cand[at : at + 256], sim[at : at + 256]
            v = self.x[np.maximum(c, 0)]
            between = np.einsum("nid,njd->nij", v, v)
            kept, bad = np.zeros(c.shape, bool), s <= -2
            kept[:, 0] = ~bad[:, 0]
            for j in range(1, c.shape[1]):
                kept[:, j] = ~bad[:, j] & ~(kept[:, :j] & (between[:, j, :j] > s[:, j : j + 1])).any(axis=1)
            rank = np.argsort(np.where(kept, 0, np.where(bad, 2, 1)) * 1000 + np.arange(c.shape[1]), axis=1)[:, :width]
            rows = np.where(np.take_along_axis(bad, rank, 1), -1, np.take_along_axis(c, rank, 1))
            self.next[lv][nodes[at : at + 256], : rows.shape[1]] = rows
            self.next[lv][nodes[at : at + 256], rows.shape[1] :] = -1

    def _back(self, lv: int, a: np.ndarray, b: np.ndarray) -> None:
        """Links back: b becomes a candidate of a, beside what a has."""
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        nodes, first, count = np.unique(a, return_index=True, return_counts=True)
        most = int(count.max()) if len(nodes) else 0
        for at in range(0, len(nodes), 1024):
            n, f, c = nodes[at : at + 1024], first[at : at + 1024], count[at : at + 1024]
            new = np.full((len(n), most), -1)
            col = np.arange(most)[None, :] < c[:, None]
            new[col] = b[np.concatenate([np.arange(x, x + y) for x, y in zip(f, c)])]
            cand = np.concatenate([self.next[lv][n], new], axis=1)
            sim = np.einsum("nd,nkd->nk", self.x[n], self.x[np.maximum(cand, 0)])
            sim[cand < 0] = -2
            self._set(lv, n, cand, sim)

    def search(self, q: np.ndarray, beam: int, level: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the best `beam` nodes that each query's walk on a level meets, best first (-1: none)."""
        m, links = len(q), self.next[level]
        seen = np.zeros((m, len(self.x)), bool)
        rows = np.arange(m)
        ids, sims = np.full((m, beam), -1), np.full((m, beam), -2.0, np.float32)
        open_ = np.zeros((m, beam), bool)
        ids[:, 0], sims[:, 0], open_[:, 0] = start, np.einsum("nd,nd->n", q, self.x[start]), True
        seen[rows, start] = True
        wide = min(4, beam)
        while True:
            rows = rows[open_[rows].any(axis=1)]
            if not len(rows):
                return ids, sims
            best = np.argsort(np.where(open_[rows], -sims[rows], 9), axis=1, kind="stable")[:, :wide]
            go = np.take_along_axis(open_[rows], best, 1)
            np.put_along_axis(hold := open_[rows], best, False, 1)
            open_[rows] = hold
            near = np.where(go[:, :, None], links[np.maximum(np.take_along_axis(ids[rows], best, 1), 0)], -1).reshape(len(rows), -1)
            near = np.sort(near, axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[rows[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            seen[rows[r], near[r, c]] = True
            s = np.full(near.shape, -2.0, np.float32)
            s[r, c] = np.einsum("nd,nd->n", q[rows[r]], self.x[near[r, c]])
            every = np.concatenate([sims[rows], s], axis=1)
            top = np.argsort(-every, axis=1, kind="stable")[:, :beam]
            sims[rows] = np.take_along_axis(every, top, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], axis=1), top, 1)
            flags = np.concatenate([open_[rows], fresh], axis=1)
            open_[rows] = np.take_along_axis(flags, top, 1) & (sims[rows] > -2)

    def nearest(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.full(len(q), self.entry)
        for lv in range(len(self.next) - 1, 0, -1):
            start = self.search(q, 1, lv, start)[0][:, 0]
        return self.search(q, min(beam, len(self.x)), 0, start)

    def within(self, q: np.ndarray, bound: float, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, node) pairs found at the bound or above, and the queries that have too many for a beam.

        Beams whose last place is still within the bound are doubled, in steps of fewer queries, up to a share of the graph
        (and WIDEST); beyond that the caller compares with every node (`blocks_within`), which costs less than the walk.
        """
        most = min(WIDEST, max(beam, len(self.x) // 8))
        out, rest, slack = [(np.zeros(0, np.int64),) * 2], np.arange(len(q)), bound - 1e-4
        while len(rest):
            step, full = max(1, CELLS // (beam + 8 * LINKS)), []
            for few in np.split(rest, np.arange(step, len(rest), step)):
                ids, sims = self.nearest(q[few], beam)
                more = (sims[:, -1] >= slack) & (ids.shape[1] < len(self.x))
                r, c = np.nonzero((sims >= slack) & ~more[:, None])
                out.append((few[r], ids[r, c]))
                full.append(few[more])
            rest, beam = np.concatenate(full), beam * 2
            if beam > most:
                break
        a, y = zip(*out)
        return np.concatenate(a), np.concatenate(y), rest

    def audited_beam(self, q: np.ndarray, own: np.ndarray, bound: float, beam: int) -> tuple[int, float]:
        """The first beam, doubling, whose recall of the audit queries' links reaches RECALL, and that of their NEAREST neighbours
        NEAR where there are few links; and the recall of the links. own: a query's own node in this graph, or -1; it counts
        in neither."""
        sims = q @ self.x.T
        here = np.flatnonzero(own >= 0)
        sims[here, own[here]] = -2
        k = min(NEAREST, len(self.x) - 1)
        links = sims >= bound
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k else np.zeros((len(q), 0), int)
        least = np.take_along_axis(sims, near, 1).min(axis=1) if k else np.zeros(len(q))
        few = links.sum() < ENOUGH
        while True:
            a, b, whole = self.within(q, bound, beam)
            recall = float((links[a, b].sum() + links[whole].sum()) / links.sum()) if links.any() else 1.0
            near_recall = 1.0
            if few and k:
                ids, found = self.nearest(q, beam)
                hits = ((found >= least[:, None] - 1e-6) & (ids != own[:, None])).sum(axis=1)
                near_recall = np.minimum(hits, k).sum() / (k * len(q))
            if recall >= RECALL and near_recall >= NEAR or beam >= len(self.x):
                return beam, recall
            beam *= 2

    def rows(self) -> list[np.ndarray]:
        """The links of each node, level by level."""
        return [np.concatenate([self.next[lv][i] for lv in range(top + 1)]) for i, top in enumerate(self.level.tolist())]

    @classmethod
    def of_rows(cls, x: np.ndarray, level: np.ndarray, links: np.ndarray) -> Graph:
        """The graph whose nodes' levels and rows, one after another, are given."""
        g = cls.__new__(cls)
        g.x, g.level, g.entry = np.ascontiguousarray(x, np.float32), level, int(np.argmax(level))
        start = np.concatenate(([0], np.cumsum(LINKS * (level + 2))[:-1]))
        g.next = [links[start[:, None] + np.arange(2 * LINKS)]]
        for lv in range(1, int(level.max()) + 1):
            upper = np.full((len(x), LINKS), -1, np.int32)
            at = np.flatnonzero(level >= lv)
            upper[at] = links[start[at, None] + LINKS * (lv + 1) + np.arange(LINKS)]
            g.next.append(upper)
        return g


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True, initial=0)  # squares of very large or small components stay numbers
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def blocks_within(q: np.ndarray, x: np.ndarray, bound: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query numbers, (queries, nodes) marks of similarity at the bound or above), some queries at a time: exact, in double precision."""
    step = max(1, CELLS // max(1, len(x)))
    for s in range(0, len(q), step):
        yield np.arange(s, min(s + step, len(q))), q[s : s + step] @ x.T >= bound


class Components:
    """Components of a shard's nodes, by the pairs that blocks of queries bring, with the links that join them."""

    def __init__(self, n: int):
        self.n, self.label = n, np.arange(n)

    def begin(self, queries: int) -> None:
        self.before, self.all = self.label, np.concatenate([self.label, self.n + np.arange(queries)])

    def join(self, query: np.ndarray, node: np.ndarray) -> None:
        far = np.flatnonzero(self.all != np.arange(len(self.all)))
        self.all = labels_of(len(self.all), np.concatenate([far, self.n + query]), np.concatenate([self.all[far], node]))

    def join_marked(self, queries: np.ndarray, marks: np.ndarray) -> None:
        r, y = np.nonzero(marks & (self.all[self.n + queries][:, None] != self.all[None, : self.n]))
        if len(r):
            self.join(queries[r], y)

    def end(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes that were a component's first and are no more, their first now, each query's first node)."""
        self.label = self.all[: self.n]
        gone = np.flatnonzero((self.before == np.arange(self.n)) & (self.label != np.arange(self.n)))
        return gone, self.label[gone], self.all[self.n :]


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().astype(np.float64).reshape(len(lists), -1)


def _build(bound: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, kind, node, copies, v) sorted by shard: a shard's own vectors (kind 0) and the audit's (1)."""

        def piece(t: pa.Table) -> Iterator[pa.RecordBatch]:
            shard, kind, node = (t.column(c).to_numpy() for c in ("shard", "kind", "node"))
            v = t.column("v").combine_chunks()
            for s in np.unique(shard).tolist():
                own, audit = np.flatnonzero((shard == s) & (kind == 0)), np.flatnonzero((shard == s) & (kind == 1))
                if not len(own):
                    continue
                own = own[np.argsort(node[own], kind="stable")]
                x, q = _unit(_matrix(v.take(pa.array(own)))), _unit(_matrix(v.take(pa.array(audit))))
                g, n = Graph(x), len(own)
                at = np.minimum(np.searchsorted(node[own], node[audit]), n - 1)
                beam, recall = g.audited_beam(q.astype(np.float32), np.where(node[own][at] == node[audit], at, -1), bound, BEAM) if len(audit) else (BEAM, 1.0)
                links = g.rows()
                ends = np.concatenate(([0], np.cumsum([len(r) for r in links]))).astype(np.int32)
                few = t.take(pa.array(own)).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, s, np.int32)), pa.array(np.arange(n, dtype=np.int32)), few.column("node").combine_chunks(), few.column("copies").combine_chunks(), few.column("v").combine_chunks(),
                     pa.array(g.level.astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(links))), pa.array(np.full(n, beam, np.int32)), pa.array(np.full(n, recall))],
                    ["shard", "pos", "node", "copies", "v", "level", "links", "beam", "recall"],
                )

        yield from by_group(batches, "shard", piece)

    return work


def _search(bound: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (task, pos): first the nodes of a shard's graph, then queries (without a place, level and links)."""
        task, held, graph, own, beam, parts = None, [], None, None, BEAM, None
        for b in batches:
            at, tasks, query = 0, b.column(0).to_numpy(), b.column(5).is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(tasks) != 0) | (np.diff(query.view(np.int8)) != 0)) + 1
            for end in [*edges.tolist(), b.num_rows]:
                part = b.slice(at, end - at)
                at = end
                if not part.num_rows:
                    continue
                if part.column(0)[0].as_py() != task:
                    task, held, graph = part.column(0)[0].as_py(), [], None
                if not part.column(5)[0].is_valid:
                    if not held:
                        continue  # an empty shard
                else:
                    held.append(part)
                    continue
                if graph is None:
                    t = pa.Table.from_batches(held).combine_chunks()
                    own = (t.column("node").to_numpy(), t.column("copies").to_numpy(), _unit(_matrix(t.column("v").combine_chunks())))
                    graph = Graph.of_rows(own[2], t.column("level").to_numpy().astype(np.int64), t.column("links").combine_chunks().flatten().to_numpy())
                    beam, parts = t.column("beam")[0].as_py(), Components(len(own[0]))
                step = int(max(64, min(1024, 3e7 // len(own[0]))))
                for s in range(0, part.num_rows, step):
                    few = part.slice(s, step)
                    node = few.column(2).to_numpy()
                    q = _unit(_matrix(few.column(4)))
                    a, y, whole = graph.within(q.astype(np.float32), bound, beam)
                    ok = (np.einsum("nd,nd->n", q[a], own[2][y]) >= bound) & (node[a] != own[0][y])
                    a, y = a[ok], y[ok]
                    n = np.bincount(a, own[1][y], len(node)).astype(np.int64)
                    parts.begin(len(node))
                    parts.join(a, y)
                    for r, marks in blocks_within(q[whole], own[2], bound):
                        marks &= node[whole[r]][:, None] != own[0][None, :]
                        n[whole[r]] += (marks @ own[1].astype(np.float64)).astype(np.int64)
                        parts.join_marked(whole[r], marks)
                    gone, into, first = parts.end()
                    hit = np.flatnonzero(n > 0)
                    names = np.concatenate([node[hit], own[0][gone]])
                    others = np.concatenate([own[0][first[hit]], own[0][into]])
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate([n[hit], np.zeros(len(gone), np.int64)])), pa.array(others)], ["node", "n", "other"])

    return work


def _dealt(rows: DataFrame, task: str, n: int, *then: str) -> DataFrame:
    """rows by the hash of their task number, with so many partitions that few hold two of n tasks."""
    return rows.repartition(min(8 * n, n + 2_000), task).sortWithinPartitions(task, *then)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, shards: int = SHARDS) -> DataFrame:
    """(id, n_links, component_id, recall), a row for each input row. recall: the smallest that the shards' audits found.

    Equal vectors are searched for once and count as linked. Rows whose vector is null, empty, zero, of another length
    than most, or holds nulls or non-finite numbers, and rows without an id, link with nothing: n_links is 0 and the
    component is their own id. Repeated rows count as vectors of their own. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    stash = Stash(spark, "vectors")
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x.cast("double")).alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    fine = F.coalesce(F.col("id").isNotNull() & (F.size("v") > 0) & ~odd & F.exists("v", lambda x: x != 0), F.lit(False))
    width = rows.where(fine).groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    fine = fine & (F.size("v") == (width.w if width else 0))
    rows = stash.save(rows.select("id", F.when(fine, F.xxhash64("v")).alias("node"), F.when(fine, F.col("v")).alias("v")))
    nodes = stash.save(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v")))
    n = nodes.count()
    count, blocks = max(shards, -(-n // SHARD_ROWS)), max(1, -(-n // QUERY_ROWS))
    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("shard")
    own = nodes.select(F.pmod(F.xxhash64("node", F.lit(1)), count).cast("int").alias("shard"), F.lit(0).alias("kind"), "node", "copies", "v")
    audit = nodes.orderBy(F.xxhash64("node", F.lit(2)), "node").limit(AUDIT).select(every, F.lit(1).alias("kind"), "node", "copies", "v")
    graphs = _dealt(own.unionByName(audit), "shard", count).mapInArrow(_build(cosine), "shard int, pos int, node long, copies long, v array<double>, level int, links array<int>, beam int, recall double")
    graphs = stash.save(graphs)
    loads = graphs.select(F.explode(F.sequence(F.col("shard") * blocks, F.col("shard") * blocks + blocks - 1)).alias("task"), "pos", "node", "copies", "v", "level", "links", "beam")
    block = F.pmod(F.xxhash64("node", F.lit(3)), blocks).cast("int")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    queries = nodes.select(every, block.alias("block"), "node", "copies", "v").select((F.col("shard") * blocks + F.col("block")).alias("task"), F.lit((1 << 31) - 1).alias("pos"), "node", "copies", "v", none("int", "level"), none("array<int>", "links"), none("int", "beam"))
    found = stash.save(_dealt(loads.unionByName(queries), "task", count * blocks, "pos").mapInArrow(_search(cosine), "node long, n long, other long"))
    recall = graphs.agg(F.coalesce(F.min("recall"), F.lit(1.0)).alias("recall"))  # one row
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")), stash)
    parts = parts.join(nodes.select("node", "rep"), "node")
    parts = parts.join(parts.groupBy("component").agg(F.min("rep").alias("smallest")), "component").select("node", "smallest")
    facts = nodes.select("node", "rep", "copies").join(links, "node", "left").join(parts, "node", "left")
    facts = facts.select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("smallest", "rep").alias("component_id"))
    return rows.select("id", "node").join(facts, "node", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")).crossJoin(F.broadcast(recall))
