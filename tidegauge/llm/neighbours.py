"""Approximate nearest neighbours by cosine: a robust-pruned directed graph in each shard.

Rows are dealt evenly to shards of at most SHARD rows, so copies spread over all of them. A shard indexes its
distinct vectors: nodes are put in, in random order and in batches, by a greedy search of the graph so far, whose
visited nodes are candidates; relaxed pruning keeps a candidate only while no kept one is ALPHA times nearer to
it, so DEGREE diverse edges remain; edges are made both ways and pruned again. A second pass repeats this on the full
graph. Searches begin at the nearest of STARTS nodes that lie far from each other, and nodes that no path from these
reaches get an edge from the nearest that one does, so that no cluster falls out of the graph. Queries, a stated
set, are dealt into blocks of BLOCK; every pair of a block and a shard is a cell of its own, in which the
block beam-searches the shard, BEAM candidates wide; the shards' nearest are merged by query. Recall is measured in
the tests.

Scores are cosines of the original vectors in double precision; ties go to the smaller id. A distinct vector keeps
the k + 1 smallest of its ids, which is all that k answers can need. A vector that is null, empty, zero or holds
null or non-finite components takes no part, nor does a row without an id. Vectors of different lengths are not
compared. Repeated rows are one candidate. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import table, write_through

#: Rows of a shard, queries of a block.
SHARD, BLOCK = 4096, 16384

#: Edges of a node, how much nearer a kept edge must be, and the widths of the searches that build and that ask.
DEGREE, ALPHA, BUILD, BEAM = 24, 1.2, 40, 96

#: Nodes that searches may begin at, and those that one begins at.
STARTS, BEGIN = 128, 4

#: Nodes that are put in together, and queries that walk together.
_STEP, _WALK = 512, 512


def vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    values = F.col(embedding).cast("array<double>")
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("embedding")).filter("vec_id is not null")
    rows = rows.filter(fine & (F.size("embedding") > 0))
    return rows.filter(F.exists("embedding", lambda x: x != 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


class Graph:
    """The index of a shard: unit vectors, edges (rows of nodes, -1 for none) and the nodes to start from."""

    def __init__(self, unit: np.ndarray, seed: int = 5) -> None:
        self.unit, n = unit, len(unit)
        self.edges = np.full((n, DEGREE), -1, np.int32)
        self.starts = self._spread(min(STARTS, n))
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([self.starts, order[~np.isin(order, self.starts)]])
        for turn in range(2):
            at = 0
            while at < n:
                step = _STEP if turn else min(_STEP, max(1, at))
                self._insert(order[at : at + step])
                at += step
        self._reach_all()

    def _spread(self, count: int) -> np.ndarray:
        """Nodes each as far as can be from those before it, beginning with the most central one."""
        chosen = [int(np.argmax(self.unit @ self.unit.mean(0)))]
        near = self.unit @ self.unit[chosen[0]]
        while len(chosen) < count:
            chosen.append(int(np.argmin(near)))
            near = np.maximum(near, self.unit @ self.unit[chosen[-1]])
        return np.unique(chosen)

    def _reached(self) -> np.ndarray:
        reached = np.zeros(len(self.unit), bool)
        front = self.starts
        while len(front):
            reached[front] = True
            nexts = np.unique(self.edges[front])
            nexts = nexts[nexts >= 0]
            front = nexts[~reached[nexts]]
        return reached

    def _reach_all(self) -> None:
        """Give one edge more to the nodes nearest to those that no path reaches, until there are none."""
        while not (reached := self._reached()).all():
            inside, lost = np.flatnonzero(reached), np.flatnonzero(~reached)[:_STEP]
            nearest = inside[np.argmax(self.unit[lost] @ self.unit[inside].T, axis=1)]
            nearest, first = np.unique(nearest, return_index=True)
            more = np.full((len(self.unit), 1), -1, np.int32)
            more[nearest, 0] = lost[first]
            self.edges = np.hstack([self.edges, more])

    def search(self, asked: np.ndarray, width: int, visited: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nodes nearest to each unit vector that a beam search meets, best first (-1 for none), and their cosines.

        Each step's nodes (a column of one for each query, -1 for none) are added to ``visited``.
        """
        n, k = len(asked), min(BEGIN, len(self.starts))
        beam = np.full((n, width), -1, np.int32)
        near = np.full((n, width), -np.inf, np.float32)
        done = np.zeros((n, width), bool)
        first = asked @ self.unit[self.starts].T
        top = np.argsort(-first, axis=1, kind="stable")[:, :k]
        beam[:, :k], near[:, :k] = self.starts[top], np.take_along_axis(first, top, 1)
        seen = np.zeros((n, len(self.unit)), bool)
        seen[np.arange(n)[:, None], beam[:, :k]] = True
        live = np.arange(n)
        while len(live):
            open_ = (beam[live] >= 0) & ~done[live]
            some = open_.any(1)
            live, open_ = live[some], open_[some]
            if not len(live):
                break
            pick = np.argmax(open_, 1)
            done[live, pick] = True
            if visited is not None:
                here = np.full((n, 1), -1, np.int32)
                here[live, 0] = beam[live, pick]
                visited.append(here)
            nexts = self.edges[beam[live, pick]]
            fresh = (nexts >= 0) & ~seen[live[:, None], nexts]
            seen[np.repeat(live, fresh.sum(1)), nexts[fresh]] = True
            score = np.einsum("qd,qrd->qr", asked[live], self.unit[nexts])
            score[~fresh] = -np.inf
            all_near = np.hstack([near[live], score])
            all_beam = np.hstack([beam[live], np.where(fresh, nexts, -1)])
            all_done = np.hstack([done[live], np.zeros_like(fresh)])
            top = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            near[live] = np.take_along_axis(all_near, top, 1)
            beam[live] = np.take_along_axis(all_beam, top, 1)
            done[live] = np.take_along_axis(all_done, top, 1)
        return beam, near

    def _pruned(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """DEGREE diverse edges of each node out of its row of candidates."""
        candidates = np.where(candidates == nodes[:, None], -1, candidates)
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        of = self.unit[candidates]
        far = np.maximum(2 - 2 * np.einsum("nd,ncd->nc", self.unit[nodes], of), 0)
        far[candidates < 0] = np.inf
        out = np.full((len(nodes), DEGREE), -1, np.int32)
        at = np.arange(len(nodes))
        for place in range(DEGREE):
            best = np.argmin(far, 1)
            good = np.isfinite(far[at, best])
            if not good.any():
                break
            out[good, place] = candidates[at, best][good]
            between = np.maximum(2 - 2 * np.einsum("nd,ncd->nc", of[at, best], of), 0)
            far[(ALPHA * ALPHA * between <= far) & good[:, None]] = np.inf
            far[at, best] = np.inf
        return out

    def _insert(self, nodes: np.ndarray) -> None:
        visited: list[np.ndarray] = []
        beam, _ = self.search(self.unit[nodes], BUILD, visited)
        self.edges[nodes] = self._pruned(nodes, np.hstack([beam, *visited, self.edges[nodes]]))
        source, target = np.repeat(nodes, DEGREE), self.edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        each, head, count = np.unique(target, return_index=True, return_counts=True)
        # Many nodes may point at one: their back edges go in DEGREE at a time, each time pruned with those there.
        for at in range(0, int(count.max()) if len(count) else 0, DEGREE):
            some = count > at
            place = at + np.arange(DEGREE)[None, :]
            index = np.minimum(head[some][:, None] + place, len(source) - 1)
            more = np.where(place < count[some][:, None], source[index], -1).astype(np.int32)
            both = np.hstack([self.edges[each[some]], more])
            self.edges[each[some]] = self._pruned(each[some], both)


class Shard:
    """Distinct vectors, the smallest ids of each, and their graph."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int) -> None:
        order = np.lexsort((ids, *values.T))
        ids, values = ids[order], values[order]
        new = np.ones(len(ids), bool)
        new[1:] = (values[1:] != values[:-1]).any(1)
        group = np.cumsum(new) - 1
        again = np.zeros(len(ids), bool)
        again[1:] = ~new[1:] & (ids[1:] == ids[:-1])
        ids, group = ids[~again], group[~again]
        rank = np.arange(len(ids)) - np.searchsorted(group, group)
        self.values = values[new]
        self.ids = np.full((len(self.values), k + 1), -1, np.int64)
        self.held = np.zeros((len(self.values), k + 1), bool)
        kept = rank <= k
        self.ids[group[kept], rank[kept]] = ids[kept]
        self.held[group[kept], rank[kept]] = True
        self.graph = Graph(_unit(self.values))

    def nearest(self, query_ids: np.ndarray, asked: np.ndarray, k: int, width: int = BEAM) -> tuple[np.ndarray, ...]:
        """(query position, vec_id, score) of the ``k`` nearest rows (at most those of the constructor) found for each query."""
        beam, _ = self.graph.search(_unit(asked), width)
        query, place = np.nonzero(beam >= 0)
        node = beam[query, place]
        of = self.values[node]
        score = cosines(asked[query], of)
        query, score = np.repeat(query, self.ids.shape[1]), np.repeat(score, self.ids.shape[1])
        ids, held = self.ids[node].ravel(), self.held[node].ravel()
        good = held & (ids != query_ids[query])
        return best(query[good], ids[good], score[good], k)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; scaled first, so that no square leaves the range."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best rows of each query, an id once."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    same = np.lexsort((rank, ids, query))
    again = np.zeros(len(query), bool)
    again[same[1:]] = (ids[same[1:]] == ids[same[:-1]]) & (query[same[1:]] == query[same[:-1]])
    query, ids, score = query[~again], ids[~again], score[~again]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], ids[rank < k], score[rank < k]


def build(rows: DataFrame, k: int = 5, size: int = SHARD) -> DataFrame:
    """(width, index): the pickled shards of the rows of ``vectors``, as a table in the shared folder."""
    rows = write_through(rows, "neighbours-rows")
    dealt = rows.repartition(max(1, -(-rows.count() // size)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            lists = batch.column(1)
            widths = np.diff(lists.offsets.to_numpy())
            flat, ids = lists.flatten().to_numpy(), batch.column(0).to_numpy()
            heads = np.cumsum(widths) - widths
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                held.setdefault(int(width), []).append((ids[at], flat[heads[at][:, None] + np.arange(width)]))
        for width, parts in held.items():
            ids, values = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            for at in range(0, len(ids), size):
                shard = pickle.dumps(Shard(ids[at : at + size], values[at : at + size], k))
                yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([shard], pa.binary())], names=["width", "index"])

    return write_through(dealt.mapInArrow(work, "width int, index binary"), "neighbours-index")


def search(index: DataFrame, queries: DataFrame, k: int = 5, width: int = BEAM, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row of ``queries`` (from ``vectors``).

    A query id that repeats asks with the smallest of its vectors. A cell holds a shard and at most about ``block``
    queries, whatever their number; both are read once for each cell they are in.
    """
    asked = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = write_through(asked.withColumn("width", F.size("embedding")), "neighbours-queries")
    shards = write_through(index.withColumn("shard", F.monotonically_increasing_id()), "neighbours-shards")
    blocks = asked.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    number = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block")
    keys = ["width", "shard", "block"]
    numbers = shards.select("width", F.col("shard").alias("other"))
    listed = asked.join(blocks, "width").select("width", number, "vec_id", "embedding").join(numbers, "width")
    listed = listed.select(F.col("width").alias("width"), F.col("other").alias("shard"), F.col("block").alias("block"), "vec_id", "embedding")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    held = shards.join(blocks, "width").select("width", "shard", each, "index")

    def work(ours: pa.Table, shard: pa.Table) -> pa.Table:
        lists, ids = ours.column("embedding").combine_chunks(), ours.column("vec_id").to_numpy()
        values = lists.flatten().to_numpy().reshape(len(ids), -1)
        found = pickle.loads(shard.column("index")[0].as_buffer())
        parts = [found.nearest(ids[at : at + _WALK], values[at : at + _WALK], k, width) for at in range(0, len(ids), _WALK)]
        query = np.concatenate([ids[at * _WALK :][part[0]] for at, part in enumerate(parts)])
        return pa.table({"query_id": query, "vec_id": np.concatenate([p[1] for p in parts]), "score": np.concatenate([p[2] for p in parts])})

    cells = listed.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(work, "query_id long, vec_id long, score double")
    found = write_through(cells, "neighbours-found").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every row whose vec_id is divisible by 50, against all rows."""
    rows = vectors(table(spark, sf_dir, "embeddings"))
    return search(build(rows), rows.filter("vec_id % 50 = 0"))
