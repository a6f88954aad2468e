"""Token ids in an entropy-coded file format: static range asymmetric numeral systems.

A store is a folder with three Spark tables. ``ids`` holds what the tokenizer gave, in order; it is needed while
writing only. ``frequencies`` holds one row per used id with its share of 2**SCALE, shared by all blocks. ``blocks``
holds one row per block: the words of the coded stream, the final state of each lane (the checkpoint at which its
decoder starts), CRC-32 of both, and which documents it holds. A block is coded by LANES interleaved coders and
needs no other block, so blocks are coded and decoded in parallel and a bad one is found and named.

Documents are in ascending doc_id order (null last; repeated ids stay side by side). Every document ends with the
end id, so an empty or null text is that id alone. A block holds whole documents; one with more ids than a block
takes is cut into pieces of its own. An empty table gives empty tables. Columns but doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import give_back, order_id, running_sum, scratch_path, small_batches, table, write_through
from tidegauge.llm.vocab import REMEMBERED, public, vocabulary
from tidegauge.llm.words import CHUNK, slices

#: Ids of a block, coders of a block, and the bits of the shared frequencies.
BLOCK, LANES, SCALE = 1 << 18, 2048, 20

#: Bytes of text in a part of a store.
PART = 32 << 20

#: Blocks in a file at most: Spark's reader takes up to 4,096 rows of a file at once, whatever their size.
PER_FILE = 64

#: Of the query: pieces of text that a worker keeps encoded, and rows and bytes that Spark hands it together.
PIECES, ROWS_AT_ONCE, BYTES_AT_ONCE = 300_000, 2_000, 4 << 20

#: A state has at least LOW; words are of 32 bits.
LOW = 1 << 31


class Model:
    """Frequencies over ids that sum to 2**SCALE."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray) -> None:
        size = int(ids.max()) + 1 if len(ids) else 1
        self.share = np.zeros(size, np.uint64)
        self.share[ids] = shares
        self.below = np.cumsum(self.share) - self.share
        self.slots = np.repeat(np.arange(size, dtype=np.uint32), self.share.astype(np.int64))


def shares(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Counts scaled to sum to 2**scale, at least 1 each."""
    whole = 1 << scale
    if len(counts) > whole:
        raise ValueError("more ids than shares")
    if not len(counts):
        return counts.astype(np.int64)
    out = np.maximum(counts.astype(np.float64) * ((whole - len(counts)) / counts.sum()), 0).astype(np.int64) + 1
    out[np.argmax(out)] += whole - out.sum()
    return out


def encode(model: Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States and words of one block. Id number i is coded by lane i % LANES, the last ids first."""
    lanes = min(LANES, len(ids))
    state = np.full(lanes, LOW, np.uint64)
    words = []
    for low in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
        some = ids[low : low + lanes]
        x, share = state[: len(some)], model.share[some]
        full = x >= share << np.uint64(63 - SCALE)
        words.append((x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        x = np.where(full, x >> np.uint64(32), x)
        whole = x // share
        state[: len(some)] = (whole << np.uint64(SCALE)) + (x - whole * share) + model.below[some]
    return state, np.concatenate(words[::-1])


def decode(model: Model, size: int, states: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The ids of one block."""
    lanes = min(LANES, size)
    state, at = states.copy(), 0
    out = np.empty(size, np.uint32)
    for low in range(0, size, lanes):
        n = min(lanes, size - low)
        x = state[:n]
        slot = x & np.uint64((1 << SCALE) - 1)
        some = model.slots[slot]
        out[low : low + n] = some
        x = model.share[some] * (x >> np.uint64(SCALE)) + slot - model.below[some]
        empty = np.flatnonzero(x < LOW)
        x[empty] = (x[empty] << np.uint64(32)) | words[at : at + len(empty)]
        at += len(empty)
        state[:n] = x
    if at != len(words) or (state != LOW).any():
        raise ValueError("a block does not end where its coder began")
    return out


def _tokens(docs: DataFrame, path: str, end_id: int, remembered: int, at_once: int) -> DataFrame:
    """doc_id, n_tokens, and the ids (32 bits, little-endian, compressed) of each document with its end id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pack = vocabulary(path, remembered), zstandard.ZstdCompressor(level=1)
        kind = np.dtype("<u2" if known.size <= 1 << 16 else "<u4")
        for batch in batches:
            for part in slices(batch, "text", at_once):
                ids, counts = known.encode(part.column(1))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(kind)
                ends = ends + np.arange(1, len(ends) + 1)
                begins = ends - counts - 1
                packed = [pack.compress(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
                arrays = [part.column(0), pa.array(counts + 1), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids"])
        give_back()

    return docs.mapInArrow(work, "doc_id long, n_tokens long, ids binary")


def _unpacked(packed: pa.Array, counts: np.ndarray) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    for data, n in zip(packed, counts.tolist()):
        raw = unpack.decompress(data.as_buffer())
        yield np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def _gathered(found: Iterable[np.ndarray], least: int) -> Iterator[np.ndarray]:
    """Arrays joined until they have ``least`` values, so that what is done for each costs little a value."""
    held, n = [], 0
    for some in found:
        held.append(some)
        n += len(some)
        if n >= least:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def _counted(ids: DataFrame) -> DataFrame:
    """How often each id is used: partial counts in each task, summed by Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for found in _gathered(_unpacked(batch.column(1), batch.column(0).to_numpy()), BLOCK):
                more = np.bincount(found, minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])

    found = ids.select("n_tokens", "ids").mapInArrow(work, "id long, n long")
    return found.groupBy("id").agg(F.sum("n").alias("n"))


def _model(frequencies: DataFrame) -> Model:
    """On the driver: a row per id that is used, as many as the vocabulary has at most."""
    rows = frequencies.orderBy("id").toPandas()
    return Model(rows["id"].to_numpy(np.int64), rows["share"].to_numpy(np.uint64))


_BLOCKS = (
    "first long, n_ids long, states binary, words binary, crc32 long, "
    "docs array<struct<row: long, doc_id: long, piece: int, n_ids: int, n_tokens: long>>"
)


def _crc(states: bytes, words: bytes) -> int:
    return zlib.crc32(words, zlib.crc32(states))


class _Packer:
    """Gathers documents and gives rows of ``blocks``."""

    def __init__(self, model: Model, block: int) -> None:
        self.model, self.block = model, block
        self.ready: list[tuple[np.ndarray, list[dict]]] = []
        self.ids: list[np.ndarray] = []
        self.docs: list[dict] = []
        self.held = 0

    def add(self, row: int, doc_id: int | None, ids: np.ndarray) -> None:
        if self.held and self.held + len(ids) > self.block:
            self.close()
        for piece, at in enumerate(range(0, len(ids), self.block)):
            part = ids[at : at + self.block]
            self.docs.append({"row": row, "doc_id": doc_id, "piece": piece, "n_ids": len(part), "n_tokens": len(ids)})
            self.ids.append(part)
            self.held += len(part)
            if self.held >= self.block:
                self.close()

    def close(self) -> None:
        if self.held:
            self.ready.append((np.concatenate(self.ids).astype(np.int64), self.docs))
            self.ids, self.docs, self.held = [], [], 0

    def rows(self) -> pa.RecordBatch:
        ready, self.ready = self.ready, []
        out = []
        for ids, docs in ready:
            states, words = encode(self.model, ids)
            out.append((docs[0]["row"], len(ids), states.astype("<u8").tobytes(), words.astype("<u4").tobytes(), docs))
        columns = list(zip(*out)) if out else [[], [], [], [], []]
        kind = pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_ids", pa.int32()), ("n_tokens", pa.int64())]))
        crcs = [_crc(s, w) for s, w in zip(columns[2], columns[3])]
        arrays = [
            pa.array(columns[0], pa.int64()),
            pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.binary()),
            pa.array(columns[3], pa.binary()),
            pa.array(crcs, pa.int64()),
            pa.array(columns[4], kind),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["first", "n_ids", "states", "words", "crc32", "docs"])


def _blocks(ids: DataFrame, model: Model, block: int) -> DataFrame:
    shared = ids.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part = _Packer(shared.value, block), None
        for batch in batches:
            rows = batch.column(0).to_pylist()
            found = _unpacked(batch.column(3), batch.column(2).to_numpy())
            for row, doc_id, some in zip(rows, batch.column(1).to_pylist(), found):
                if part is not None and row >> 33 != part:
                    packer.close()
                part = row >> 33
                packer.add(row, doc_id, some)
                if packer.ready:
                    yield packer.rows()
        packer.close()
        yield packer.rows()

    return ids.select("row", "doc_id", "n_tokens", "ids").mapInArrow(work, _BLOCKS)


def write_store(docs: DataFrame, folder: str, path: str, end_id: int = 1, block: int = BLOCK, remembered: int = REMEMBERED, at_once: int = CHUNK) -> None:
    """Encode every text of ``docs`` and write the store into a new folder.

    ``remembered`` bounds the pieces of text a worker keeps encoded, ``at_once`` the bytes of text it works on together
    (one text at least): fewer take less memory and more time.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), order_id().alias("_order"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranged = docs.repartitionByRange(max(1, -(-size // PART)), "_order").sortWithinPartitions("_order")
    ids = _tokens(ranged.select("doc_id", "text"), path, end_id, remembered, at_once)
    ids.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/ids")
    ids = spark.read.parquet(f"{folder}/ids")
    counts = _counted(ids).orderBy("id").toPandas()
    share = shares(counts["n"].to_numpy(np.int64))
    model = Model(counts["id"].to_numpy(np.int64), share)
    rows = spark.createDataFrame([(int(i), int(n)) for i, n in zip(counts["id"], share)], "id long, share long")
    rows.coalesce(1).write.parquet(f"{folder}/frequencies")
    _blocks(ids, model, block).write.option("maxRecordsPerFile", PER_FILE).parquet(f"{folder}/blocks")


def _shared_model(spark: SparkSession, folder: str) -> Broadcast[Model]:
    return spark.sparkContext.broadcast(_model(spark.read.parquet(f"{folder}/frequencies")))


def _decoded(blocks: DataFrame, shared: Broadcast[Model]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for block in batch.to_pylist():
                if _crc(block["states"], block["words"]) != block["crc32"]:
                    raise ValueError(f"block {block['first']}: wrong checksum")
                states, words = np.frombuffer(block["states"], "<u8"), np.frombuffer(block["words"], "<u4")
                ids = decode(model, block["n_ids"], states, words).astype("<u4").tobytes()
                docs = block["docs"]
                ends = (4 * np.cumsum([d["n_ids"] for d in docs])).tolist()
                arrays = [
                    pa.array([d["row"] for d in docs], pa.int64()),
                    pa.array([d["doc_id"] for d in docs], pa.int64()),
                    pa.array([d["piece"] for d in docs], pa.int32()),
                    pa.array([d["n_tokens"] for d in docs], pa.int64()),
                    pa.array([ids[a:b] for a, b in zip([0, *ends], ends)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "piece", "n_tokens", "ids"])

    return blocks.mapInArrow(work, "row long, doc_id long, piece int, n_tokens long, ids binary")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of documents in a store: row, doc_id, piece, n_tokens and ``ids`` (32 bits, little-endian).

    Blocks are decoded apart, from their own states; one whose checksum is wrong is an error.
    """
    return _decoded(spark.read.parquet(f"{folder}/blocks"), _shared_model(spark, folder))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a store: row, doc_id, n_tokens and the CRC-32 of all its ids.

    A document in one piece is done where it was decoded; only the pieces of others are brought together. Blocks
    with whole documents and those with pieces are read apart: only a block with both is decoded twice.
    """
    blocks, shared = spark.read.parquet(f"{folder}/blocks"), _shared_model(spark, folder)
    whole = _decoded(blocks.filter(F.exists("docs", lambda d: d["n_ids"] == d["n_tokens"])), shared)
    pieces = _decoded(blocks.filter(F.exists("docs", lambda d: d["n_ids"] < d["n_tokens"])), shared)
    in_one = (F.col("piece") == 0) & (F.octet_length("ids") == 4 * F.col("n_tokens"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", F.hex("ids").alias("ids")))), lambda p: p["ids"]), "")
    cut = pieces.filter(~in_one).groupBy("row", "doc_id", "n_tokens").agg(F.unhex(joined).alias("ids"))
    every = whole.filter(in_one).select("row", "doc_id", "n_tokens", "ids").union(cut)
    return every.select("row", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document, read from the files."""
    found = write_through(digests(spark, folder), "rans-read").withColumn("part", F.shiftrightunsigned("row", 33))
    found = running_sum(found, [], "part", [F.col("row")], "n_tokens", "start")
    return found.select("doc_id", F.col("start").cast("long").alias("start"), "n_tokens", "ids_crc32")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-store")
    with small_batches(spark, ROWS_AT_ONCE, BYTES_AT_ONCE):
        write_store(table(spark, sf_dir, "documents"), folder, public("word_bpe_49k.json"), remembered=PIECES)
        return stored_documents(spark, folder)
