"""Mixing sources to target weights.

Each source's words, in doc_id order, are packed into blocks of BLOCK words. The mix is a row of output shards of
about SHARD slots. How many slots of a shard go to each source is a multinomial draw, under the condition that all
shards together give every source its number of slots: that is a draw without replacement, shard by shard, from the
slots not yet dealt. BOOK shards are dealt as one book, with the sources' share of slots in it to within one slot, and a
seed of its own, so books are independent tasks and the numbers of a shard's slots follow from its book. Slot number t of a
source is mapped through the source's pseudorandom permutation of block numbers (another one for the second pass over
a source), and blocks and slots are joined by source and block number. The last slot of a source is cut to the words
left of its target, so a source gives its target to the word, and none of its words more than twice.

The driver holds one row per source. All else is distributed: a source that holds a third of the words is as many
ranges and blocks as its words make. Reruns agree, whatever the partitions.

Null texts have no words; a null source is a source of its own, the last. Null ids come last in a source. Rows may
repeat, each is packed. Empty tables give empty results. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import binned, give_back, order_id, running_sum, table, unused, write_through
from tidegauge.llm.words import Words, mixed, slices

#: Words of a block, slots of a shard, and the seed of draws and permutations.
BLOCK, SHARD, SEED = 128, 256, 7

#: Shards that are dealt together, in one task.
BOOK = 4096

#: Sources below which the table of sources is sent to every task.
FEW = 10_000

#: Weights of the sources in order, repeating; the share of all words; the most passes over a source.
WEIGHTS, SHARE, PASSES = (3, 1, 2), 1.5, 2


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, key (a hash of the text) and size in words of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes = pa.array(Words(part.column(3)).counts.astype(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], sizes], names=["doc_id", "source", "key", "size"])

    docs = docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    return docs.mapInArrow(work, "doc_id long, source string, key long, size long")


def fill(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> list[float]:
    """The target of each source: shares by weight of ``share`` times all sizes, none above ``passes`` times its size."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target = [0.0] * len(sizes)
    left, free = share * sum(sizes), set(range(len(sizes)))
    while free:
        unit = left / sum(weight[i] for i in free)
        above = {i for i in free if weight[i] * unit > passes * sizes[i]}
        for i in above or free:
            target[i] = float(passes * sizes[i]) if above else weight[i] * unit
        left -= sum(target[i] for i in above)
        free = free - above if above else set()
    return target


def _rounds(index: np.ndarray, half: np.ndarray, key: np.ndarray, back: bool) -> np.ndarray:
    """Four rounds of a Feistel network on numbers of twice ``half`` bits, or the way back."""
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = index >> half, index & mask
    for turn in (3, 2, 1, 0) if back else (0, 1, 2, 3):
        if back:
            left, right = right, left
        left, right = right, left ^ (mixed(right + mixed(key + np.uint64(turn + 1))) & mask)
        if back:
            left, right = right, left
    return (left << half) | right


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n) for each key, at ``index``, or its inverse: a Feistel network with cycle walking."""
    index, n, key = index.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    half = np.maximum((np.ceil(np.log2(np.maximum(n.astype(np.float64), 2) + 1)).astype(np.int64) + 1) // 2, 1).astype(np.uint64)
    out, todo = index.copy(), np.arange(len(index))
    while len(todo):
        out[todo] = _rounds(out[todo], half[todo], key[todo], back)
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def permutation_keys(src: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    """The key of each source's permutation in each pass."""
    return mixed((src * 8 + turn).astype(np.uint64) + np.uint64(seed << 40))


class Shares:
    """The driver's table: one entry per source, in order.

    A source takes ``words``, its target rounded, in ``slots`` slots, the last of which gives ``cut`` words.
    """

    def __init__(self, sources: list[str | None], sizes: list[int], block: int, seed: int = SEED) -> None:
        self.sources, self.sizes, self.target = sources, sizes, fill(sizes)
        self.blocks = [-(-s // block) for s in sizes]
        self.words = [int(t + 0.5) for t in self.target]
        self.slots, self.cut = [], []
        for i, (size, n, words) in enumerate(zip(sizes, self.blocks, self.words)):
            turn, rest = divmod(words, size) if size else (0, 0)
            some, held = -(-rest // block), 0
            if some:
                # the last block may have fewer words: where does this pass take it?
                short = n * block - size
                key = permutation_keys(np.array([i]), np.array([turn]), seed)
                place = int(permuted(np.array([n - 1]), np.array([n]), key, back=True)[0])
                some += place < some and some * block - short < rest
                held = (some - 1) * block - (short if place < some - 1 else 0)
            self.slots.append(turn * n + some)
            self.cut.append(rest - held if some else block)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(range(len(self.sources)), self.sources, map(int, self.sizes), self.target, self.blocks, self.slots, self.cut))
        return spark.createDataFrame(rows, "src int, source string, source_size long, target double, n_blocks long, n_slots long, cut long")


def draws(spark: SparkSession, slots: list[int], shard: int = SHARD, seed: int = SEED, book: int = BOOK) -> DataFrame:
    """(src, shard, before, n): how many slots of each shard go to each source, and how many did in the shards before."""
    shards = max(1, -(-sum(slots) // shard))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                first, last = number * book, min((number + 1) * book, shards)
                before = np.array([s * first // shards for s in slots], np.int64)
                left = np.array([s * last // shards for s in slots], np.int64) - before
                total, draw = int(left.sum()), np.random.default_rng([seed, number])
                for i in range(last - first):
                    size = total * (i + 1) // (last - first) - total * i // (last - first)
                    n = draw.multivariate_hypergeometric(left, size, method="marginals")
                    some = np.flatnonzero(n)
                    arrays = [some.astype(np.int32), np.full(len(some), first + i), before[some], n[some]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["src", "shard", "before", "n"])
                    before, left = before + n, left - n

    books = -(-shards // book)
    return spark.range(0, books, 1, min(books, 4096)).mapInArrow(work, "src int, shard long, before long, n long")


def slots_of(spark: SparkSession, shares: DataFrame, slots: list[int], block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, src, t, most, pass, block): the block that each slot takes, and how many words of it at most."""
    drawn = write_through(draws(spark, slots, shard, seed), "mix-draws")
    some = shares.select("src", "n_blocks", "n_slots", "cut")
    # Spark takes the slots to be as small as the draws' files and would broadcast them
    each = drawn.join(F.broadcast(some) if len(slots) < FEW else some.hint("merge"), "src")
    each = each.select("*", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("t"))
    most = F.when(F.col("t") == F.col("n_slots") - 1, F.col("cut")).otherwise(F.lit(block)).cast("long")
    each = each.select("src", "shard", "t", "n_blocks", most.alias("most"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, t, n = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 2, 3))
            turn = t // n
            taken = permuted(t - turn * n, n, permutation_keys(src, turn, seed))
            arrays = [batch.column(1), batch.column(0), batch.column(2), batch.column(4), pa.array(turn.astype(np.int32)), pa.array(taken)]
            yield pa.RecordBatch.from_arrays(arrays, names=["shard", "src", "t", "most", "pass", "block"])

    return each.mapInArrow(work, "shard long, src int, t long, most long, pass int, block long")


def pieces(rows: DataFrame, block: Column | int = BLOCK) -> DataFrame:
    """(src, block, row, doc_id, key, at, start, end): which words of which row stand in each block of a source, and where."""
    some = rows.filter("size > 0")
    numbers = F.sequence(F.expr(f"offset div {block}"), F.expr(f"(offset + size - 1) div {block}"))
    each = some.select("src", "row", "doc_id", "key", "size", "offset", F.explode(numbers).alias("block"))
    begin = F.col("block") * block - F.col("offset")
    return each.select(
        "src",
        "block",
        "row",
        "doc_id",
        "key",
        F.greatest(-begin, F.lit(0)).alias("at"),
        F.greatest(begin, F.lit(0)).alias("start"),
        F.least(begin + block, F.col("size")).alias("end"),
    )


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Tables (rows, taken).

    rows: row, doc_id, key, source, size, and its source's src, source_size and target. taken: what the mix holds,
    one row per piece of a document: shard, src, t (the slot), pass, block, row, doc_id, key, start and end (words).
    """
    spark = docs.sparkSession
    counted = word_counts(docs).withColumn("_order", order_id())
    rows = binned(counted, ["source", "_order", "key"], "mix-rows").withColumn("row", F.monotonically_increasing_id())
    sums = rows.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.col("source").isNull(), "source").collect()
    known = Shares([r["source"] for r in sums], [r["size"] for r in sums], block, seed)
    shares = known.table(spark)
    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    rows = rows.alias("l").join(F.broadcast(shares.alias("r")) if len(sums) < FEW else shares.alias("r"), same)
    rows = rows.select("l.*", "r.src", "r.source_size", "r.target")
    order = [F.col("_order"), F.col("key"), F.col("row")]
    rows = write_through(running_sum(rows, ["src"], "_bin", order, "size", "offset"), "mix-offsets")
    slots = slots_of(spark, shares, known.slots, block, shard, seed)
    # neither side is as small as the files that it is read from
    taken = slots.join(pieces(rows, block).hint("merge"), ["src", "block"]).filter("at < most")
    return rows, taken.withColumn("end", F.expr("least(end, start + most - at)")).drop("at", "most")


def mixed_documents(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """The documents of which the mix holds words, with ``text`` cut or repeated to those words and ``n_chars`` to match.

    Words of one pass stand in their own order, white space and all; passes and gaps are joined by a line end.
    Equal rows (same id and text) become one, with what was taken of each.
    """
    columns = docs.columns
    held, doc, key, own = unused(docs, "_spans", "_doc", "_key", "_hash")
    _, taken = mix(docs.select("doc_id", "source", "text"), block, shard, seed)
    spans = taken.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("pass", "row", "start", "end"))).alias(held))
    spans = spans.select(F.col("doc_id").alias(doc), F.col("key").alias(key), held)
    hashed = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = hashed.join(spans, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(key)))
    joined = joined.dropDuplicates([doc, key]).select(*columns, held)
    text, chars = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(text))
                data = words.data.tobytes()
                out = []
                for i, spans in enumerate(part.column(len(columns)).to_pylist()):
                    first, begin = int(words.first[i]), int(words.offsets[i])
                    runs: list[list[int]] = []
                    last = None
                    for s in spans:
                        if runs and last == (s["pass"], s["row"], s["start"]):
                            runs[-1][1] = s["end"]
                        else:
                            runs.append([s["start"], s["end"]])
                        last = (s["pass"], s["row"], s["end"])
                    n = int(words.counts[i])
                    texts = []
                    for a, b in runs:
                        left = begin if a == 0 else int(words.starts[first + a])
                        right = int(words.offsets[i + 1]) if b == n else int(words.ends[first + b - 1])
                        texts.append(data[left:right].decode())
                    out.append("\n".join(texts))
                arrays = list(part.columns[: len(columns)])
                arrays[text] = pa.array(out, pa.string())
                if chars is not None:
                    arrays[chars] = pa.array([len(x) for x in out]).cast(arrays[chars].type)
                yield pa.RecordBatch.from_arrays(arrays, names=columns)
        give_back()

    return joined.mapInArrow(work, docs.schema)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, taken = mix(table(spark, sf_dir, "documents"))
    words = taken.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("taken"))
    found = rows.join(words, "row", "left")
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
