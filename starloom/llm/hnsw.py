"""Near-duplicate vectors by hierarchical navigable small-world graphs, one for each shard.

Usable vectors (no null, not zero, all components finite) are scaled to length 1 and dealt to shards of about SHARD_ROWS by a hash of the
id. Each shard builds its graph once. Every pair of a shard and itself or a later shard is one task: the later one's vectors search the graph
of the first with a beam, all together, so that every vector meets every shard. A query whose whole beam is near enough widens its beam, up to the shard. In every task an audit scans
the shard for AUDIT queries; while the beams find less than AUDIT_RECALL of their links, the beam doubles and all queries search again. Candidates are
verified by cosine in double precision. A task returns no pairs but, for each vector, its number of links and one edge to the smallest id it
is joined with there; counts are added up and edges united into components, so the output grows with rows and not with links.

Rows with null, zero or non-finite vectors link with nothing: 0 links, their own component. Vectors of different lengths don't link. Rows
may repeat: rows of one id count as one vector, the least of theirs in array order, and each gets its result row. A null id links with nothing
and is its own component of null id. An empty table gives no rows. Extra columns (labels too) are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import mixed, reachable, table
from .components import connected_components

THRESHOLD = 0.95
SHARD_ROWS = 16_384
LINKS = 12
#: Rows inserted or searched together.
BLOCK = 1_024
BEAM = 24
AUDIT = 96
AUDIT_RECALL = 0.98
_MARGIN = 1e-4


class Graph:
    """A navigable small-world graph of unit vectors (float32), inserted in blocks."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.v = vectors
        n = len(vectors)
        height = mixed(ids.astype(np.int64).view(np.uint64))
        self.level = np.minimum(np.where(height % np.uint64(256) == 0, 2, np.where(height % np.uint64(16) == 0, 1, 0)), 2)
        self.links = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int32) for k in range(3)]
        self.order = np.lexsort((height, -self.level))  # higher levels first, so that every block finds the levels above it
        for start in range(0, n, BLOCK):
            self._insert(self.order[start : start + BLOCK], self.order[:start])

    def _similar(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        s = np.einsum("qd,qkd->qk", queries, self.v[ids], optimize=True)
        return np.where(ids >= 0, s, -2.0)

    def _insert(self, new: np.ndarray, old: np.ndarray) -> None:
        found = None
        for k in (2, 1, 0):
            mine = new[self.level[new] >= k]
            if len(mine) == 0:
                continue
            inner = self.v[mine] @ self.v[mine].T
            np.fill_diagonal(inner, -2.0)
            width = min(LINKS * 2, len(mine))
            near = np.argpartition(-inner, width - 1, axis=1)[:, :width]
            ids, sims = mine[near], np.take_along_axis(inner, near, 1)
            base = old[self.level[old] >= k]
            if len(base):
                out_ids, out_sims = self._beam(self.v[mine], k, BEAM, self._entries(self.v[mine], k, base))
                ids, sims = np.concatenate((ids, out_ids), 1), np.concatenate((sims, out_sims), 1)
            ids = np.where(sims > -2.0, ids, -1)
            keep = self._choose(mine, ids, sims, LINKS)
            self.links[k][mine, : keep.shape[1]] = keep
            self._link_back(k, mine, keep)

    def _entries(self, queries: np.ndarray, k: int, base: np.ndarray) -> np.ndarray:
        """Where the search of level k starts: the best of the levels above, or the first rows."""
        start = np.tile(base[: min(4, len(base))], (len(queries), 1))
        for up in (2, 1):
            if up > k and (self.level[base] >= up).any():
                start = self._beam(queries, up, 4, start)[0]
        return start

    def _beam(self, queries: np.ndarray, k: int, width: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the best `width` rows that a beam search of level k meets: ids (-1 where none) and similarities."""
        ids = np.full((len(queries), max(width, entries.shape[1])), -1, np.int64)
        ids[:, : entries.shape[1]] = entries
        sims = self._similar(queries, ids)
        open_ = ids >= 0
        active = np.arange(len(queries))
        step = 4 if width >= 16 else 1
        while len(active):
            a_ids, a_sims, a_open = ids[active], sims[active], open_[active]
            rank = np.where(a_open, a_sims, -3.0)
            pick = np.argpartition(-rank, min(step, rank.shape[1]) - 1, axis=1)[:, :step]
            live = np.take_along_axis(rank, pick, 1) > -2.5
            going = live.any(axis=1)
            if not going.all():
                active, a_ids, a_sims, a_open, pick, live = active[going], a_ids[going], a_sims[going], a_open[going], pick[going], live[going]
                if not len(active):
                    break
            here = np.where(live, np.take_along_axis(a_ids, pick, 1), -1)
            np.put_along_axis(a_open, pick, False, 1)
            more = np.where(here[:, :, None] >= 0, self.links[k][here], -1).reshape(len(active), -1).astype(np.int64)
            more.sort(axis=1)
            more[:, 1:][more[:, 1:] == more[:, :-1]] = -1
            worst = a_sims.min(axis=1, keepdims=True)
            s = self._similar(queries[active], more)
            better = (s > worst) & (more >= 0)
            wide = min(int(better.sum(axis=1).max(initial=0)), more.shape[1])
            if wide:
                top = np.argpartition(np.where(better, -s, 3.0), wide - 1, axis=1)[:, :wide]
                more, s, better = (np.take_along_axis(x, top, 1) for x in (more, s, better))
                for c in range(0, a_ids.shape[1], 32):  # rows that are in the beam already
                    better &= ~(more[:, :, None] == a_ids[:, None, c : c + 32]).any(axis=2)
                every = np.concatenate((a_ids, np.where(better, more, -1)), 1)
                every_s = np.concatenate((a_sims, np.where(better, s, -2.0)), 1)
                every_o = np.concatenate((a_open, better), 1)
                best = np.argpartition(-every_s, a_ids.shape[1] - 1, axis=1)[:, : a_ids.shape[1]]
                a_ids, a_sims, a_open = (np.take_along_axis(x, best, 1) for x in (every, every_s, every_o))
            ids[active], sims[active], open_[active] = a_ids, a_sims, a_open
        return ids, sims

    def _choose(self, of: np.ndarray, ids: np.ndarray, sims: np.ndarray, number: int) -> np.ndarray:
        """Neighbours that are nearer to their row than to a neighbour chosen before; free places go to the nearest of the others."""
        width = min(ids.shape[1], number * 2)
        top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        ids, sims = np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1)
        best = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
        vectors = self.v[ids]
        between = vectors @ vectors.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, bool)
        for c in range(width):
            shadowed = (chosen[:, :c] & (between[:, c, :c] > sims[:, c : c + 1])).any(axis=1)
            chosen[:, c] = ~shadowed & (ids[:, c] >= 0)
        rank = np.where(ids >= 0, np.where(chosen, 0, width) + np.arange(width), 3 * width)
        pick = np.argsort(rank, axis=1, kind="stable")[:, :number]
        return np.take_along_axis(ids, pick, 1).astype(np.int32)

    def _link_back(self, k: int, new: np.ndarray, keep: np.ndarray) -> None:
        source, target = np.repeat(new, keep.shape[1]), keep.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        rows, first, number = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, number)
        for start in range(0, int(number.max(initial=0)), LINKS):
            part = (place >= start) & (place < start + LINKS)
            own = np.unique(target[part])
            extra = np.full((len(own), LINKS), -1, np.int64)
            extra[np.searchsorted(own, target[part]), place[part] - start] = source[part]
            every = np.concatenate((self.links[k][own].astype(np.int64), extra), 1)
            every.sort(axis=1)
            every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
            self.links[k][own] = self._choose_wide(own, every, k)

    def _choose_wide(self, own: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        number = self.links[k].shape[1]
        out = np.full((len(own), number), -1, np.int32)
        for a in range(0, len(own), BLOCK):
            part = slice(a, a + BLOCK)
            kept = self._choose(own[part], ids[part], self._similar(self.v[own[part]], ids[part]), number)
            out[part, : kept.shape[1]] = kept
        return out

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        return self._beam(queries, 0, width, self._entries(queries, 0, self.order))


def _unit(data: np.ndarray) -> np.ndarray:
    """Rows of length one. Each is first brought near 1 by a power of two, which is exact, so that no square overflows or vanishes."""
    exponent = np.frexp(np.abs(data).max(axis=1, keepdims=True))[1]
    near = np.ldexp(data, -exponent)
    return near / np.linalg.norm(near, axis=1, keepdims=True)


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite rows a and b in a forest whose roots are the smallest rows."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def linked(vectors: np.ndarray, ids: np.ndarray, graph: Graph, queries: np.ndarray, query_ids: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Links of the shard's rows and of the queries, smallest joined row of both (queries after the shard), and the audited recall."""
    n, m = len(vectors), len(queries)
    low = queries.astype(np.float32)
    counts, parent = np.zeros(n + m, np.int64), np.arange(n + m)
    if same:  # the queries are the shard's own rows
        position = {i: k for k, i in enumerate(ids.tolist())}
        me = np.array([position[i] for i in query_ids.tolist()])
        parent[n + np.arange(m)] = np.minimum(me, n + np.arange(m))
    audit = np.argsort(mixed(query_ids.astype(np.int64).view(np.uint64)), kind="stable")[:AUDIT]
    exact = low[audit] @ graph.v.T >= threshold
    width = min(BEAM, n)
    while width < n:
        ids_found, sims = graph.search(low[audit], width)
        full = sims.min(axis=1) >= threshold
        hit = np.take_along_axis(exact, np.maximum(ids_found, 0), 1) & (ids_found >= 0)
        total = int(exact[~full].sum())
        recall = int(hit[~full].sum()) / total if total else 1.0
        if recall >= AUDIT_RECALL:
            break
        width *= 2
    else:
        recall = 1.0
    for start in range(0, m, BLOCK):
        part = np.arange(start, min(start + BLOCK, m))
        if width < n:
            found, sims = graph.search(low[part], width)
            full = sims.min(axis=1) >= threshold - _MARGIN
            q, c = np.nonzero((sims >= threshold - _MARGIN) & (found >= 0) & ~full[:, None])
            q, t = part[q], found[q, c]
        else:
            full, q, t = np.ones(len(part), bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        wide = part[full]  # a beam as wide as the shard
        pairs = [(q, t)]
        for a in range(0, len(wide), 128):
            some = wide[a : a + 128]
            qq, tt = np.nonzero(low[some] @ graph.v.T >= threshold - _MARGIN)
            pairs.append((some[qq], tt))
        for q, t in pairs:
            for a in range(0, len(q), 1 << 17):
                qa, ta = q[a : a + (1 << 17)], t[a : a + (1 << 17)]
                true = np.einsum("ij,ij->i", queries[qa], vectors[ta]) >= threshold
                qa, ta = qa[true], ta[true]
                if same:
                    other = me[qa] != ta
                    qa, ta = qa[other], ta[other]
                np.add.at(counts, n + qa, 1)
                if not same:
                    np.add.at(counts, ta, 1)
                _hook(parent, n + qa, ta)
    return counts, parent, np.array([width]), recall


_BLOB = "shard int, d int, n long, ids binary, vectors binary"


def _blob(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("row")
    data = np.stack(rows["embedding"].to_numpy()).astype("<f8")
    return pd.DataFrame([{"shard": int(key[0]), "d": int(key[1]), "n": len(rows), "ids": rows["row"].to_numpy("<i8").tobytes(), "vectors": data.tobytes()}])


_GRAPH = "shard int, d int, n long, ids binary, vectors binary, l0 binary, l1 binary, l2 binary"


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for b in batch.itertuples(index=False):
            unit = _unit(np.frombuffer(b.vectors, "<f8").reshape(b.n, b.d))
            g = Graph(unit.astype(np.float32), np.frombuffer(b.ids, "<i8"))
            yield pd.DataFrame([{"shard": b.shard, "d": b.d, "n": b.n, "ids": b.ids, "vectors": b.vectors, **{f"l{k}": g.links[k].tobytes() for k in range(3)}}])


def _restored(row, unit: np.ndarray) -> Graph:
    g = Graph.__new__(Graph)
    ids = np.frombuffer(row.ids, "<i8")
    g.v = unit.astype(np.float32)
    height = mixed(ids.view(np.uint64))
    g.level = np.minimum(np.where(height % np.uint64(256) == 0, 2, np.where(height % np.uint64(16) == 0, 1, 0)), 2)
    g.links = [np.frombuffer(x, np.int32).reshape(row.n, -1) for x in (row.l0, row.l1, row.l2)]
    g.order = np.lexsort((height, -g.level))
    return g


def _compare(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                ids, query_ids = np.frombuffer(b.ids, "<i8"), np.frombuffer(b.query_ids, "<i8")
                unit = _unit(np.frombuffer(b.vectors, "<f8").reshape(b.n, b.d))
                queries = _unit(np.frombuffer(b.queries, "<f8").reshape(b.m, b.d))
                counts, parent, width, recall = linked(unit, ids, _restored(b, unit), queries, query_ids, bool(b.same), threshold)
                every = np.concatenate((ids, query_ids))
                out = pd.DataFrame({"row": every, "links": counts, "joined": every[parent]})
                out = out[(out["links"] > 0) | (out["row"] != out["joined"])]
                yield out.assign(width=int(width[0]), recall=recall)

    return run


def neighbours(rows: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """From (row long, embedding array<double>), usable vectors with distinct rows: (row, links) and edges (a, b) that span the components."""
    spark = rows.sparkSession
    reachable(spark)
    number = rows.count()
    shards = max(1, -(-number // SHARD_ROWS))
    dealt = rows.withColumn("d", F.size("embedding")).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    blobs = materialize(dealt.groupBy("shard", "d").applyInPandas(_blob, _BLOB), "vectors")
    graphs = materialize(blobs.repartition(shards, "shard").mapInPandas(_build, _GRAPH), "graphs")
    queries = blobs.select(F.col("shard").alias("query_shard"), "d", F.col("n").alias("m"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"))
    # A row for each shard that a shard's vectors visit: its own and all before it, so that each pair of shards meets once.
    visits = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("query_shard"))))
    tasks = graphs.join(visits, ["shard", "d"]).withColumn("same", F.col("shard") == F.col("query_shard"))
    tasks = tasks.repartition(max(1, shards * (shards + 1) // 2), "shard", "query_shard")
    found = materialize(tasks.mapInPandas(_compare(threshold), "row long, links long, joined long, width int, recall double"), "found")
    return found.groupBy("row").agg(F.sum("links").alias("links")).where("links > 0"), found.where("row <> joined").select(F.col("row").alias("a"), F.col("joined").alias("b"))


def components(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding)."""
    e = F.col("embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", e.cast("array<double>").alias("embedding"), usable.alias("usable"))
    known = rows.where("usable").groupBy(F.col("vec_id").alias("row")).agg(F.min("embedding").alias("embedding"))
    links, edges = neighbours(known, threshold)
    roots = connected_components(edges)
    out = vectors.select("vec_id").join(links.withColumnRenamed("row", "vec_id"), "vec_id", "left").join(roots.select(F.col("node").alias("vec_id"), "root"), "vec_id", "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "embeddings"))
