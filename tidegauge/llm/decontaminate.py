"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words that ignores some positions. Every position of every benchmark
item and of every document is hashed under each of the MASKS; equal hashes are hits. Around a hit, document and
item are laid side by side on the hit's diagonal and compared word by word: a stretch of WINDOW words (all words laid
side by side, if they are fewer, but SPAN at least) with SIMILARITY of its positions equal is an overlap, so
substituted words are tolerated, and so are SPAN equal words in a row. The MASKS are lossless: enumerated, every
pattern of substitutions that such a stretch may hold leaves a seed whole. An item of fewer than SPAN words overlaps
where all its words stand in a row, and one of fewer than LEAST, which says nothing inside other text, where they are
the whole text. Words are compared lower-cased and without ASCII punctuation.

The benchmark is a stated set, searched in blocks: the driver streams it and holds, broadcasts and joins
BLOCK_WORDS words of it at a time, each block against all documents, without shuffling their texts. Items longer
than PIECE words are cut into pieces that overlap by a window, so no overlap is lost.

Null and empty texts, and items without words, overlap nothing. Repeated rows of documents give repeated
results; equal items are reported each, under their own ids (null stays null).
Empty tables give empty results. Columns but doc_id, item_id and text are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import give_back, scratch_path, table, write_through
from tidegauge.llm.sample import plain
from tidegauge.llm.words import Words, mixed, ragged, slices, windows

#: Word positions that each seed looks at; lossless for stretches of SPAN to WINDOW words.
MASKS = (
    (0, 1, 3, 4, 5, 6),
    (0, 1, 2, 4, 9, 10),
    (0, 1, 2, 4, 7, 8),
)

#: The fewest words that are compared with substitutions, and the length of a verbatim overlap.
SPAN = 13

#: The fewest words of an item that are looked for inside longer texts.
LEAST = 5

#: Words of an overlap and the share of them that must be equal.
WINDOW, SIMILARITY = 20, 0.8

#: Words of a piece of an item, and of a block of items.
PIECE, BLOCK_WORDS = 2048, 1 << 19

#: Word pairs that are compared together.
_PAIRS = 1 << 19

#: Hits whose diagonals are told apart together.
_HITS = 1 << 20

_BITS = 22


def seeds(hashes: np.ndarray, mask: int) -> np.ndarray:
    """The hash of each position under one mask."""
    n = len(hashes) - MASKS[mask][-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, mask + 1, np.uint64)
    for at in MASKS[mask]:
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + n]
    return mixed(out)


class Block:
    """Some items: their words one after the other and the sorted seeds that point into them.

    Each comes as a piece: (id, words, where they begin in the item, words of the item).
    """

    def __init__(self, items: list[tuple[int | None, np.ndarray, int, int]]) -> None:
        self.ids = [i for i, _, _, _ in items]
        sizes = np.array([len(w) for _, w, _, _ in items], np.int64)
        self.words = np.concatenate([w for _, w, _, _ in items])
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.at = np.array([a for _, _, a, _ in items], np.int64)
        self.whole = np.array([n for _, _, _, n in items], np.int64)
        owner = np.repeat(np.arange(len(items)), sizes)
        place = np.arange(len(self.words))
        long = self.whole[owner] >= SPAN
        self.tables = []
        for mask, places in enumerate(MASKS):
            hashes = seeds(self.words, mask)
            at = np.flatnonzero((place + places[-1] < self.first[owner + 1])[: len(hashes)] & long[: len(hashes)])
            order = at[np.argsort(hashes[at], kind="stable")]
            mark = np.zeros(1 << _BITS, bool)
            mark[hashes[at] >> np.uint64(64 - _BITS)] = True
            self.tables.append((hashes[order], order, owner[order], mark))
        self.short = []
        for size in range(1, SPAN):
            some = np.flatnonzero(self.whole == size)
            if len(some):
                hashes = windows(self.words, size)[self.first[some]]
                order = np.argsort(hashes, kind="stable")
                self.short.append((size, hashes[order], some[order]))

    def overlaps(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, start, end, equal): the overlaps' best windows, positions in words of the text."""
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        parts = [*self.alike(words, first, text), self.verbatim(words, first, text)]
        return tuple(np.concatenate(x) for x in zip(*parts))

    def verbatim(self, words: np.ndarray, first: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
        """The first place in each text of each item of fewer than SPAN words; of fewer than LEAST, in texts of these words alone."""
        out = [tuple(np.empty(0, np.int64) for _ in range(5))]
        for size, hashes, items in self.short:
            found = windows(words, size)
            left, right = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            at = np.flatnonzero(right > left)
            at = at[at + size <= first[text[at] + 1]]
            if size < LEAST:
                at = at[np.diff(first)[text[at]] == size]
            # equal items share a hash: a text needs the first place of each hash only
            _, fresh = np.unique(text[at] * len(hashes) + left[at], return_index=True)
            at = at[fresh]
            n = right[at] - left[at]
            hit, item = np.repeat(at, n), items[ragged(left[at], n)] if len(at) else np.empty(0, np.int64)
            start = hit - first[text[hit]]
            out.append((text[hit], item, start, start + size, np.full(len(hit), size)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def alike(self, words: np.ndarray, first: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """The best window of each diagonal that a seed points to and that holds an overlap."""
        keys, shifts = np.empty(0, np.int64), len(self.words) + len(words)
        for mask, (hashes, places, owners, mark) in enumerate(self.tables):
            found = seeds(words, mask)
            at = np.flatnonzero(mark[found >> np.uint64(64 - _BITS)]) if len(found) else np.empty(0, np.int64)
            at = at[at + MASKS[mask][-1] < first[text[at] + 1]]
            left, right = np.searchsorted(hashes, found[at], "left"), np.searchsorted(hashes, found[at], "right")
            n = right - left
            # equal words hit each other in all ways but lie on few diagonals: a piece of the hits at a time
            cuts = np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()) + _HITS, _HITS), "left")
            for a, b in itertools.pairwise(np.unique(np.append(cuts, len(n)))):
                hit, seed = np.repeat(at[a:b], n[a:b]), ragged(left[a:b], n[a:b])
                shift = hit - places[seed] + len(self.words)
                found_keys = np.unique((text[hit] * len(self.ids) + owners[seed]) * shifts + shift)
                keys = np.union1d(keys, found_keys) if len(keys) else found_keys
        if not len(keys):
            return
        both, shift = np.divmod(keys, shifts)
        owner_text, item = np.divmod(both, len(self.ids))
        shift -= len(self.words)
        # what is laid side by side, in the whole item and in this piece of it
        delta = shift - first[owner_text] + self.first[item] - self.at[item]
        along = np.minimum(self.whole[item], np.diff(first)[owner_text] - delta) - np.maximum(0, -delta)
        enough = along >= SPAN
        owner_text, item, shift, along = owner_text[enough], item[enough], shift[enough], along[enough]
        begin = np.maximum(self.first[item], first[owner_text] - shift)
        end = np.minimum(self.first[item + 1], first[owner_text + 1] - shift)
        window = np.minimum(WINDOW, along)
        least = np.ceil(SIMILARITY * window - 1e-9).astype(np.int64)
        cuts = np.searchsorted(np.cumsum(end - begin), np.arange(0, int((end - begin).sum()) + _PAIRS, _PAIRS), "left")
        cuts = np.unique(np.append(cuts, [0, len(item)]))
        for a, b in zip(cuts, cuts[1:]):
            lengths = end[a:b] - begin[a:b]
            place = ragged(begin[a:b], lengths)
            same = self.words[place] == words[place + np.repeat(shift[a:b], lengths)]
            sums = np.concatenate([[0], np.cumsum(same)])
            heads = np.cumsum(lengths) - lengths
            good = []
            for size, need in ((window[a:b], least[a:b]), (np.full(b - a, SPAN), np.full(b - a, SPAN))):
                tries = np.maximum(lengths - size + 1, 0)
                which = np.repeat(np.arange(b - a), tries)
                starts = ragged(heads, tries)
                equal = sums[starts + size[which]] - sums[starts]
                kept = equal >= need[which]
                good.append((which[kept], starts[kept], equal[kept], size[which[kept]]))
            which, starts, equal, size = (np.concatenate(x) for x in zip(*good))
            order = np.lexsort((starts, -equal, which))
            order = order[np.diff(which[order], prepend=-1) > 0]
            which, starts, equal, size = which[order], starts[order], equal[order], size[order]
            start = begin[a:b][which] + (starts - heads[which]) + shift[a:b][which] - first[owner_text[a:b][which]]
            yield owner_text[a:b][which], item[a:b][which], start, start + size, equal


def item_pieces(benchmark: DataFrame) -> DataFrame:
    """(item_id, at, size, words): the word hashes of each item, PIECE at a time, from ``at`` of its ``size`` on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(plain(part.column(1)))
                hashes, rows = words.hashes(), []
                for i, item in enumerate(part.column(0).to_pylist()):
                    own = hashes[words.first[i] : words.first[i + 1]]
                    for at in range(0, max(len(own) - WINDOW, 0) + 1, PIECE - WINDOW):
                        if len(own):
                            rows.append((item, at, len(own), own[at : at + PIECE].tobytes()))
                columns = [list(c) for c in zip(*rows)] or [[], [], [], []]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "at", "size", "words"])

    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(work, "item_id long, at long, size long, words binary")


def blocks(benchmark: DataFrame, most: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark, ``most`` words at a time."""
    items: list[tuple[int | None, np.ndarray, int, int]] = []
    size = 0
    for row in write_through(item_pieces(benchmark), "decontaminate-items").toLocalIterator():
        words = np.frombuffer(row["words"], np.uint64)
        if items and size + len(words) > most:
            yield Block(items)
            items, size = [], 0
        items.append((row["item_id"], words, row["at"], row["size"]))
        size += len(words)
    if items:
        yield Block(items)


def overlaps(docs: DataFrame, benchmark: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """(row, doc_id, item_id, start, end, equal) of each overlap of a row of ``docs`` with an item: its best window.

    ``row`` numbers the rows of the given table as it lies; a table that is read must lie the same in each block.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "decontaminate-overlaps")
    schema = "row long, doc_id long, item_id long, start long, end long, equal long"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark.createDataFrame([], schema).write.parquet(folder)
    for block in blocks(benchmark, most):
        shared = spark.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            ids = pa.array(known.ids, pa.int64())
            for batch in batches:
                for part in slices(batch, "text"):
                    words = Words(plain(part.column(2)))
                    text, item, start, end, equal = known.overlaps(words.hashes(), words.first)
                    at = pa.array(text)
                    arrays = [part.column(0).take(at), part.column(1).take(at), ids.take(pa.array(item)), pa.array(start), pa.array(end), pa.array(equal)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "item_id", "start", "end", "equal"])

        rows.mapInArrow(work, schema).write.mode("append").parquet(folder)
        shared.unpersist()
    found = spark.read.schema(schema).parquet(folder)
    best = F.max_by(F.struct("start", "end", "equal"), F.struct("equal", -F.col("start"))).alias("best")
    return found.groupBy("row", "doc_id", "item_id").agg(best).select("row", "doc_id", "item_id", "best.*")


#: Bytes of text that ``clean`` works on together: its workers go on to other stages.
SLICE = 1 << 19


def clean(docs: DataFrame, benchmark: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that overlap no item, with their columns; between blocks what is left is a table."""
    text = docs.columns.index("text")
    for number, block in enumerate(blocks(benchmark, most)):
        if number:
            docs = write_through(docs, "decontaminate-rest")
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    words = Words(plain(part.column(text)))
                    keep = np.ones(part.num_rows, bool)
                    keep[shared.value.overlaps(words.hashes(), words.first)[0]] = False
                    yield part.filter(pa.array(keep))
            give_back()

        docs = docs.mapInArrow(work, docs.schema)
    return docs


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, start, end (words) and equal (words) of each overlap of a document with a benchmark item."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")
