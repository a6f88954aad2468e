"""Token counts, with huge documents cut into overlapping chunks that are encoded apart and spliced.

Documents up to ``CHUNK`` code points are encoded whole, where they are read. A longer one becomes chunks that
overlap on either side of their cuts, dealt over all tasks. Each chunk is encoded with offsets. Where two
neighbours overlap, both must show a token beginning at the same place, and the place must be proven stable:
no token or rule of the tokenizer reaches over it whatever stands on either side (see ``stable``). The first such
place is the splice, and a chunk counts its tokens from splice to splice. Where neighbours share none (a word
longer than the overlap), the document is cut anew with chunks and overlaps twice as large, until all are
spliced or one chunk holds the document.

Null texts are empty; empty texts have no tokens. Rows may repeat, ids may be null: each row gets its answer.
Empty tables give empty results; columns but doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import table, write_through
from tidegauge.llm.vocab import public, vocabulary
from tidegauge.llm.words import slices

#: Code points of a chunk, without overlaps, and of the overlap on each side of a cut.
CHUNK, OVERLAP = 32_768, 256

_BLANK = frozenset(" \t\n\r\x0b\x0c")


def stable(text: str, starts: np.ndarray, path: str) -> np.ndarray:
    """Which token starts are proven stable.

    If the tokenizer drops white space before anything else: those behind an ASCII white-space character. Else
    those on a single space between two other characters: the split patterns of byte-level BPE, and merges of
    sentencepiece models without a piece that has a space mark behind another character, do not cross it.
    """
    known = vocabulary(path)
    if known.words_apart:
        return np.array([p > 0 and text[p - 1] in _BLANK for p in starts.tolist()], bool)
    if known.pieces is not None and not _marks_lead(path):
        return np.zeros(len(starts), bool)
    ends = len(text) - 1
    fits = (0 < p < ends and text[p] == " " and not text[p - 1].isspace() and not text[p + 1].isspace() for p in starts.tolist())
    return np.fromiter(fits, bool, len(starts))


def _marks_lead(path: str) -> bool:
    """Whether the space mark stands only at the front of a model's pieces."""
    pieces = vocabulary(path).pieces
    return not any("▁" in pieces.id_to_piece(i).lstrip("▁") for i in range(pieces.get_piece_size()))


def _short(docs: DataFrame, path: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                arrays = [*part.columns[:2], pa.array(known.counts(part.column(2)))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "n_bytes", "text").mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")


def _chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, number, last, at, text): the chunks of each text, ``at`` is where one begins."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "number", "last", "at", "text"]
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                n = max(1, -(-len(text) // chunk))
                for i in range(n):
                    left, right = max(0, i * chunk - overlap), min(len(text), (i + 1) * chunk + overlap)
                    arrays = [[row], [i], [i == n - 1], [left], [text[left:right]]]
                    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds)], names=names)

    return docs.select("row", "text").mapInArrow(work, "row long, number long, last boolean, at long, text string")


def _boundaries(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Per chunk its number of tokens and, for each cut, the stable places near it with the tokens before them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            out: list[list] = [[], [], []]
            for number, at, text in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                text = text.as_py()
                starts = known.offsets(text)
                fits = stable(text, starts, path)
                out[0].append(len(starts))
                for side, cut in ((1, number * chunk - at), (2, (number + 1) * chunk - at)):
                    near = np.flatnonzero(fits & (starts > cut - overlap) & (starts < cut + overlap - 1))
                    out[side].append([{"place": int(starts[j]) + at, "before": int(j)} for j in near])
            kind = pa.list_(pa.struct([("place", pa.int64()), ("before", pa.int64())]))
            arrays = [*batch.columns[:3], pa.array(out[0], pa.int64()), pa.array(out[1], kind), pa.array(out[2], kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "number", "last", "tokens", "left", "right"])

    kind = "array<struct<place: long, before: long>>"
    return chunks.mapInArrow(work, f"row long, number long, last boolean, tokens long, left {kind}, right {kind}")


def _spliced(found: DataFrame) -> DataFrame:
    """(row, n_tokens), null where two neighbours share no stable place."""
    order = Window.partitionBy("row").orderBy("number")
    places = lambda name: F.transform(name, lambda b: b["place"])
    found = found.withColumn("next", F.lead("left").over(order))
    found = found.withColumn("splice", F.array_min(F.array_intersect(places(F.col("right")), places(F.col("next")))))
    found = found.withColumn("begin", F.lag("splice").over(order))
    before = lambda name, at: F.get(F.filter(name, lambda b: b["place"] == F.col(at)), F.lit(0))["before"]
    first = F.when(F.col("number") == 0, F.lit(0)).otherwise(before("left", "begin"))
    upto = F.when(F.col("last"), F.col("tokens")).otherwise(before("right", "splice"))
    found = found.withColumn("part", upto - first)
    whole = F.count("part") == F.count("*")
    return found.groupBy("row").agg(F.when(whole, F.sum("part")).alias("n_tokens"))


def huge_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, n_tokens) of the texts (row, text), by overlapping chunks."""
    spark = docs.sparkSession
    done, left = None, docs.select("row", "text")
    while True:
        dealt = _chunks(left, chunk, overlap)
        dealt = dealt.repartition(spark.sparkContext.defaultParallelism * 4, "row", "number")
        counts = write_through(_spliced(_boundaries(dealt, path, chunk, overlap)), "tokencount-spliced")
        good = counts.filter("n_tokens IS NOT NULL")
        done = good if done is None else done.union(good)
        failed = counts.filter("n_tokens IS NULL").select("row")
        if failed.isEmpty():
            return done
        left, chunk, overlap = left.join(failed, "row", "left_semi"), 2 * chunk, 2 * overlap


def token_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    short = _short(docs.filter(F.length("text") <= chunk), path)
    huge = docs.filter(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    huge = write_through(huge, "tokencount-huge")
    counted = huge_counts(huge, path, chunk, overlap)
    return short.union(huge.join(counted, "row").select("doc_id", "n_bytes", "n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts(table(spark, sf_dir, "documents"), public("word_bpe_49k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)
