"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one for each shard.

Equal vectors of a label are one class with a weight, so copies meet once and are never expanded. Classes are dealt by
hash to shards of about SHARD; a shard's graph is built layer by layer from the top: a node's highest layer is drawn
from an exponential distribution, a layer's nodes are put in in batches, each searched from where the layers above
lead, and keep WIDTH of diverse near nodes, filled up with the nearest. Every pair of shards of a label is a cell:
the nodes of one are the queries of the other's graph (within a shard each starts at itself). A search that finds
its whole beam linked is repeated wider, a beam of a shard's size being the shard itself. Then an audit compares the
cell's links of a part of its queries with all cosines; unless it passes, all its queries are searched wider, and
so on up to the whole shard, so no number of links of a vector is out of reach. Each cosine near the threshold is
verified on the original values in double precision. A cell's links leave it as counts and a spanning forest.

Vectors of other labels or lengths are not compared; a null label, a null vector, one of zeros or with null or
non-finite components links with nothing. Rows are vectors: a repeated row links with its copy. A row without an id
takes part; a component is named by its smallest id (null if it has none), and a row is kept whose id, null or not, is that name. An
empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import connected, table, write_through

#: Classes of a shard.
SHARD = 8192

#: Edges of a node (twice as many in the lowest layer) and the beam that builds.
DEGREE, BUILD = 16, 48

#: Beams that ask, one after the other, then the whole shard; queries that walk together, beam nodes that they leave at once.
BEAMS = (32, 128)
_WALK, _LEAVE = 512, 4

#: Queries of a cell that are audited, and the part of their links that must have been found.
AUDITED, RECALL = 128, 0.99

#: How far a cosine of single precision may be below the threshold to be verified.
_SLACK = 1e-5

_NODE = "label {}, width int, shard long, node int, class long, weight long, vector array<double>, edges array<array<int>>"
_LINKED = "class long, links long, root long"


def unit(values: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square leaves the range."""
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


class Graph:
    """``layers[l]`` holds the edges of all nodes in layer l (-1 for none; all -1 for nodes that are not in it)."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray] | None = None, seed: int = 7) -> None:
        self.vectors = vectors
        if layers is not None:
            self.layers = layers
            self.start = int(np.flatnonzero((layers[-1] >= 0).any(1))[0]) if (layers[-1] >= 0).any() else 0
            return
        n, rng = len(vectors), np.random.default_rng(seed)
        heights = np.floor(rng.exponential(1 / np.log(DEGREE), n)).astype(int)
        heights[heights.argmax()] = heights.max(initial=0)
        self.layers = [np.full((n, DEGREE * (1 if level else 2)), -1, np.int32) for level in range(int(heights.max(initial=0)) + 1)]
        order = rng.permutation(n)
        order = order[np.argsort(-heights[order], kind="stable")]
        self.start = int(order[0])
        for level in reversed(range(len(self.layers))):
            self._fill(level, order[heights[order] >= level])

    def _fill(self, level: int, nodes: np.ndarray) -> None:
        """Put ``nodes`` (those of higher layers first) into a layer."""
        at = 1
        inside = np.zeros(len(self.vectors), bool)
        inside[nodes[:1]] = True
        while at < len(nodes):
            some = nodes[at : at + min(at, _WALK)]
            asked = self.vectors[some]
            entry = self.descend(asked, level)
            entry[~inside[entry]] = self.start
            beam, _ = self.walk(level, asked, entry[:, None], BUILD)
            # those put in together have not seen each other
            near = asked @ asked.T
            np.fill_diagonal(near, -np.inf)
            most = min(DEGREE, len(some) - 1)
            beside = some[np.argpartition(-near, most - 1, axis=1)[:, :most]] if most > 0 else np.empty((len(some), 0), np.int32)
            self._connect(level, some, np.hstack([beam, beside.astype(np.int32)]))
            inside[some] = True
            at += len(some)

    def _connect(self, level: int, nodes: np.ndarray, candidates: np.ndarray) -> None:
        edges = self.layers[level]
        edges[nodes] = self._diverse(nodes, candidates, edges.shape[1])
        source, target = np.repeat(nodes, edges.shape[1]), edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order].astype(np.int32), target[order]
        each, head, count = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, int(count.max(initial=0)), edges.shape[1]):
            some = count > at
            place = at + np.arange(edges.shape[1])[None, :]
            back = source[np.minimum(head[some][:, None] + place, len(source) - 1)]
            back[place >= count[some][:, None]] = -1
            edges[each[some]] = self._diverse(each[some], np.hstack([edges[each[some]], back]), edges.shape[1])

    def _diverse(self, nodes: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
        """Of each node's candidates those nearer to it than to any kept one, nearest first, then the nearest others."""
        candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        of = self.vectors[candidates]
        near = np.einsum("nd,ncd->nc", self.vectors[nodes], of)
        near[candidates < 0] = -np.inf
        left = near.copy()
        kept = np.zeros(candidates.shape, bool)
        at = np.arange(len(nodes))
        for _ in range(degree):
            best = np.argmax(left, 1)
            good = left[at, best] > -np.inf
            if not good.any():
                break
            kept[at[good], best[good]] = True
            between = np.einsum("nd,ncd->nc", of[at, best], of)
            left[(between >= left) & good[:, None]] = -np.inf
            left[at, best] = -np.inf
        # cosines are at most 1: kept ones come first
        rank = np.argsort(-(near + 4 * kept), axis=1, kind="stable")[:, :degree]
        out = np.full((len(nodes), degree), -1, np.int32)
        out[:, : rank.shape[1]] = np.where(np.take_along_axis(near, rank, 1) > -np.inf, np.take_along_axis(candidates, rank, 1), -1)
        return out

    def descend(self, asked: np.ndarray, level: int) -> np.ndarray:
        """The node that the layers above ``level`` lead each query to."""
        entry = np.full((len(asked), 1), self.start, np.int32)
        for above in range(len(self.layers) - 1, level, -1):
            beam, near = self.walk(above, asked, entry, _LEAVE)
            entry = beam[np.arange(len(asked)), near.argmax(1)][:, None]
        return entry[:, 0].copy()

    def walk(self, level: int, asked: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes that a beam search of a layer meets (-1 for none), in no order, and their cosines."""
        edges, n = self.layers[level], len(asked)
        beam = np.full((n, width), -1, np.int32)
        near = np.full((n, width), -np.inf, np.float32)
        done = np.ones((n, width), bool)
        k = min(width, entries.shape[1])
        beam[:, :k] = entries[:, :k]
        near[:, :k] = np.einsum("qd,qkd->qk", asked, self.vectors[beam[:, :k]])
        done[:, :k] = False
        seen = np.zeros((n, len(self.vectors)), bool)
        seen[np.arange(n)[:, None], beam[:, :k]] = True
        live = np.arange(n)
        while True:
            live = live[~done[live].all(1)]
            if not len(live):
                return beam, near
            open_ = np.where(done[live], -np.inf, near[live])
            leave = min(_LEAVE, width)
            pick = np.argpartition(-open_, leave - 1, axis=1)[:, :leave]
            real = np.take_along_axis(open_, pick, 1) > -np.inf
            done[live[:, None], pick] = True
            nexts = np.where(real[:, :, None], edges[beam[live[:, None], pick]], -1).reshape(len(live), -1)
            nexts.sort(axis=1)
            fresh = nexts >= 0
            fresh[:, 1:] &= nexts[:, 1:] != nexts[:, :-1]
            fresh &= ~seen[live[:, None], nexts]
            row, place = np.nonzero(fresh)
            seen[live[row], nexts[row, place]] = True
            # only what is new is compared, moved to the front of each row
            count = fresh.sum(1)
            most = int(count.max(initial=0))
            if not most:
                continue
            more = np.full((len(live), most), -1, np.int32)
            score = np.full((len(live), most), -np.inf, np.float32)
            column = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            more[row, column] = nexts[row, place]
            score[row, column] = np.einsum("ed,ed->e", asked[live[row]], self.vectors[more[row, column]])
            all_near = np.hstack([near[live], score])
            top = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            near[live] = np.take_along_axis(all_near, top, 1)
            beam[live] = np.take_along_axis(np.hstack([beam[live], more]), top, 1)
            done[live] = np.take_along_axis(np.hstack([done[live], score == -np.inf]), top, 1)


class Shard:
    """The classes of a shard with their unit vectors and the graph of these."""

    def __init__(self, classes: np.ndarray, weights: np.ndarray, values: np.ndarray, layers: list[np.ndarray] | None = None) -> None:
        self.classes, self.weights, self.exact = classes, weights, unit(values)
        self.graph = Graph(self.exact.astype(np.float32), layers)

    def linked(self, asked: np.ndarray, own: bool, threshold: float) -> np.ndarray:
        """Which nodes (columns) each query (rows of ``asked``, unit vectors) is linked with; ``own``: the queries are the nodes."""
        n = len(asked)
        out = np.zeros((n, len(self.classes)), bool)
        single = asked.astype(np.float32)
        audited = np.unique(np.linspace(0, n - 1, min(AUDITED, n)).astype(int))
        truth = self._all(asked[audited], threshold)
        if own:
            truth[np.arange(len(audited)), audited] = False
        todo = np.arange(n)
        for width in (*BEAMS, None):
            whole = width is None or width >= len(self.classes)
            full = np.zeros(n, bool)
            for at in range(0, len(todo), _WALK):
                some = todo[at : at + _WALK]
                if whole:
                    out[some] = self._all(asked[some], threshold)
                    continue
                entry = self.graph.descend(single[some], 0)
                if own:
                    entry = np.stack([some, np.where(entry == some, (some + 1) % n, entry)], axis=1).astype(np.int32)
                else:
                    entry = entry[:, None]
                beam, near = self.graph.walk(0, single[some], entry, width)
                query, place = np.nonzero(near >= threshold - _SLACK)
                node = beam[query, place]
                good = (asked[some[query]] * self.exact[node]).sum(1) >= threshold
                out[some[query[good]], node[good]] = True
                full[some] = (near >= threshold - _SLACK).all(1)
            if own:
                out[np.arange(n), np.arange(n)] = False
            if whole and len(todo) == n:
                break
            # a full beam is widened for its query alone, a failed audit for all of them
            found = out[audited] | (out[:, audited].T if own else False)
            ended = ~full[audited]
            if whole or (truth & found)[ended].sum() >= RECALL * truth[ended].sum():
                todo = todo[full[todo]]
            else:
                todo = np.arange(n)
            if not len(todo):
                break
        return out | out.T if own else out

    def _all(self, asked: np.ndarray, threshold: float) -> np.ndarray:
        near = asked @ self.exact.T
        # products of matrices may round otherwise than sums of a row: the ones at the edge are summed like those found
        query, node = np.nonzero(np.abs(near - threshold) <= _SLACK)
        out = near >= threshold
        out[query, node] = (asked[query] * self.exact[node]).sum(1) >= threshold
        return out


def forest(linked: np.ndarray, first: int) -> np.ndarray:
    """The smallest member of each node's component; row r is the node ``first`` + r, column c the node c."""
    roots = np.arange(max(linked.shape[1], first + linked.shape[0]))
    for at in range(0, len(linked), _WALK):
        u, v = np.nonzero(linked[at : at + _WALK])
        u += first + at
        while True:
            a, b = roots[u], roots[v]
            if (a == b).all():
                break
            np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
            while (roots[roots] != roots).any():
                roots = roots[roots]
    return roots


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _shard(rows: pa.Table, with_graph: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray] | None]:
    rows = rows.sort_by("node" if with_graph else "class")
    classes, weights = rows.column("class").to_numpy(), rows.column("weight").to_numpy()
    layers = None
    if with_graph:
        flat = rows.column("edges").combine_chunks()
        levels = len(flat.flatten()) // len(flat)
        edges = flat.flatten().flatten().to_numpy().reshape(len(flat), -1)
        layers = [edges[:, : 2 * DEGREE]] + [edges[:, 2 * DEGREE + DEGREE * i :][:, :DEGREE] for i in range(levels - 1)]
    return classes, weights, _matrix(rows.column("vector")), layers


def classes(rows: DataFrame, label: str = "label", vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(label, vector, weight, least, class) of the vectors that can link: equal ones of a label are one class."""
    values = F.col(embedding).cast("array<double>")
    rows = rows.select(F.col(label).alias("label"), F.col(vec_id).cast("long").alias("vec_id"), values.alias("vector"))
    rows = rows.filter(F.col("label").isNotNull() & can_link(F.col("vector")))
    grouped = rows.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
    return write_through(grouped.withColumn("class", F.monotonically_increasing_id()), "smallworld-classes")


def can_link(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def index(found: DataFrame, size: int = SHARD) -> DataFrame:
    """The nodes of all shards with their edges, layer by layer, as a table in the shared folder."""
    width = F.size("vector").alias("width")
    rows = found.select("label", width, "class", "weight", "vector")
    counts = rows.groupBy("label", "width").agg(F.ceil(F.count(F.lit(1)) / size).alias("shards"))
    shard = F.pmod(F.xxhash64("class"), F.col("shards")).alias("shard")
    dealt = rows.join(counts, ["label", "width"]).select("label", "width", shard, "class", "weight", "vector", "shards")
    schema = _NODE.format(found.schema["label"].dataType.simpleString()) + ", shards long"

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        numbers, weights, values, _ = _shard(rows, False)
        made = Graph(unit(values).astype(np.float32))
        n = len(numbers)
        edges = np.hstack(made.layers).astype(np.int32)
        ends = np.cumsum([0] + [layer.shape[1] for layer in made.layers])
        offsets = (np.arange(n)[:, None] * ends[-1] + ends[None, :-1]).ravel()
        inner = pa.ListArray.from_arrays(pa.array(np.append(offsets, n * ends[-1]).astype(np.int32)), pa.array(edges.ravel()))
        outer = pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * len(made.layers)).astype(np.int32)), inner)
        vectors = pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * values.shape[1]).astype(np.int32)), pa.array(values.ravel()))
        same = [pa.array([k.as_py()] * n, k.type) for k in key]
        arrays = [*same, pa.array(np.arange(n, dtype=np.int32)), pa.array(numbers), pa.array(weights), vectors, outer, rows.column("shards")]
        names = ["label", "width", "shard", "node", "class", "weight", "vector", "edges", "shards"]
        return pa.table(dict(zip(names, arrays)))

    return write_through(dealt.groupBy("label", "width", "shard").applyInArrow(work, schema), "smallworld-index")


def cells(nodes: DataFrame, threshold: float) -> DataFrame:
    """(class, links, root) out of every cell: the weight linked with a class there, and a class it is connected with."""

    def work(ours: pa.Table, others: pa.Table) -> pa.Table:
        numbers, weights, values, layers = _shard(ours, True)
        shard = Shard(numbers, weights, values, layers)
        if others.num_rows:
            more, more_weights, asked, _ = _shard(others, False)
            linked = shard.linked(unit(asked), False, threshold)
            links = np.concatenate([_weighed(linked.T, more_weights), _weighed(linked, weights)])
            numbers, first = np.concatenate([numbers, more]), len(numbers)
        else:
            linked = shard.linked(shard.exact, True, threshold)
            links, first = _weighed(linked, weights), 0
        roots = forest(linked, first)
        some = links > 0
        return pa.table({"class": numbers[some], "links": links[some], "root": numbers[roots[some]]})

    keys = ["label", "width", "low", "high"]
    low = nodes.withColumn("low", F.col("shard")).withColumn("high", F.explode(F.sequence("shard", F.col("shards") - 1)))
    high = nodes.filter("shard > 0").withColumn("high", F.col("shard")).withColumn("low", F.explode(F.sequence(F.lit(0), F.col("shard") - 1)))
    high = high.select(*keys, "class", "weight", "vector")
    return low.groupBy(*keys).cogroup(high.groupBy(*keys)).applyInArrow(work, _LINKED)


def _weighed(linked: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(linked), np.int64)
    for at in range(0, len(linked), _WALK):
        row, column = np.nonzero(linked[at : at + _WALK])
        np.add.at(out, at + row, weights[column])
    return out


def near_duplicates(rows: DataFrame, threshold: float = 0.93, size: int = SHARD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    found = classes(rows)
    out = write_through(cells(index(found, size), threshold), "smallworld-links")
    links = out.groupBy("class").agg(F.sum("links").alias("links"))
    edges = out.filter(F.col("class") != F.col("root")).select(F.col("class").alias("a"), F.col("root").alias("b"))
    roots = connected(edges, "smallworld-components").withColumnRenamed("node", "class")
    known = found.select("class", "label", "vector", "weight", "least").join(links, "class", "left").join(roots, "class", "left")
    known = known.withColumn("root", F.coalesce("root", "class"))
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    n_links = (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    known = known.join(names, "root").select("label", "vector", n_links, "component_id", F.lit(True).alias("_known"))
    asked = rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    # vectors that cannot link are kept out of the join, so that they are no hot key of it
    fine = F.col("label").isNotNull() & can_link(F.col("vector"))
    met = asked.filter(fine).join(known, ["label", "vector"], "left").select("vec_id", "n_links", "component_id")
    rest = asked.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    both = met.unionByName(rest)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_links, component_id and kept of every embedding at a cosine of 0.93 or more within its label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
