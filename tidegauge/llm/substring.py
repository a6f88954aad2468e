"""Exact repeats of long word windows, by level-wise doubling.

Level 1 looks at short windows (``length`` halved until it is at most ``BASE``). Of those only the least hash in
each stretch as long as the wanted window is taken (winnowing): equal long windows take equal short ones, so
nothing is lost and a short window in fourteen is shuffled. Short windows found in two documents survive; only
around them are windows of twice the length made, of which again only the repeated ones survive, and so on until
the wanted length is reached or no candidate survives.

Documents with the same words are one class: only the one with the smallest doc_id takes part, the others are
repeats of it altogether. Texts are read twice; only those that hold a surviving short window are kept between.

Windows are compared by a 128-bit hash of their words. Null texts are empty. A null doc_id comes after all
others, and equal ids are not smaller than each other, so repeated rows are judged alike. Short texts have no
window and lose nothing. Empty tables give empty results; columns but doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import order_id, table, write_through
from tidegauge.llm.words import Words, ragged, slices, sliding_min, windows

#: Longest window of the first level, in words.
BASE = 32

_EMPTY = hashlib.sha256(b"").hexdigest()


def level_lengths(length: int) -> list[int]:
    """The window lengths of the levels, each at most twice the one before."""
    out = [length]
    while out[0] > BASE:
        out.insert(0, -(-out[0] // 2))
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", order_id().alias("doc"), F.xxhash64(text).alias("key"), text.alias("text"))


def _valid(words: Words, length: int) -> np.ndarray:
    """Whether a window of ``length`` words that begins at a word ends in the same text, for each possible start."""
    of = words.text_of_word()
    return of[: len(of) - length + 1] == of[length - 1 :] if len(of) >= length else np.empty(0, bool)


def winnowed(words: Words, base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the ``base``-word windows that are least in some ``length``-word window."""
    short = np.maximum(windows(words.digests(1), base), np.uint64(1))
    width = length - base + 1
    if len(short) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = sliding_min(short, width)
    least[~_valid(words, length)] = 0
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    reach = ~sliding_min(~padded, width)
    at = np.flatnonzero((reach == short) & (reach > 0))
    return at, short[at]


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind, safe=False))


def _summaries(docs: DataFrame, base: int, length: int) -> DataFrame:
    """Per row: the ids, the number of words, the SHA-256 of the words, and the winnowed short windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(3))
                at, hashes = winnowed(words, base, length)
                of = words.text_of_word()[at]
                marks = np.bincount(of, minlength=len(words.counts))
                data = words.data.tobytes()
                spans = zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())
                digests = [hashlib.sha256(b" ".join(data[a:b].split())).hexdigest() for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(digests, pa.string()),
                        _lists((at - words.first[of]).astype(np.int32), marks, pa.int32()),
                        _lists(hashes.view(np.int64), marks, pa.int64()),
                    ],
                    names=["doc_id", "doc", "key", "n_words", "sha256", "at", "hash"],
                )

    schema = "doc_id long, doc long, key long, n_words long, sha256 string, at array<int>, hash array<long>"
    return docs.mapInArrow(work, schema)


def _longer(texts: DataFrame, base: int, before: int, length: int) -> DataFrame:
    """Per text the candidate windows of ``length`` words, from the survivors ``at`` of ``before`` words.

    On the first extension (``before`` = ``base``) a window is a candidate if it covers a survivor; later, if it
    begins and ends with one.
    """

    def starts_of(at: np.ndarray, n: int) -> np.ndarray:
        if before > base:
            return np.intersect1d(at, at - (length - before))
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, np.maximum(at - (length - before), 0), 1)
        np.add.at(edge, np.minimum(at + 1, n), -1)
        return np.flatnonzero(np.cumsum(edge[:n]) > 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(2))
                one, two = windows(words.digests(1), length), windows(words.digests(2), length, 1)
                found = []
                for i, at in enumerate(part.column(3)):
                    n = int(words.counts[i]) - length + 1
                    found.append(starts_of(np.asarray(at.values, np.int64), n) if n > 0 else np.empty(0, np.int64))
                counts = np.array([len(x) for x in found])
                starts = np.concatenate(found) if found else np.empty(0, np.int64)
                place = starts + np.repeat(words.first[:-1], counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        _lists(starts.astype(np.int32), counts, pa.int32()),
                        _lists(one[place].view(np.int64), counts, pa.int64()),
                        _lists(two[place].view(np.int64), counts, pa.int64()),
                    ],
                    names=["doc", "key", "at", "hash", "hash2"],
                )

    schema = "doc long, key long, at array<int>, hash array<long>, hash2 array<long>"
    return texts.select("doc", "key", "text", "at").mapInArrow(work, schema)


def _repeated(rows: DataFrame, hashes: list[str]) -> DataFrame:
    """Rows whose hashes stand in two documents at least, with the smallest such document as ``least``.

    The count is a partial aggregate. Its groups are a table before the rows are joined to them: with an aggregate
    in the stage of the join Spark could not split a large key.
    """
    groups = rows.groupBy(*hashes).agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    return rows.join(write_through(groups.filter("least < most").drop("most"), "substring-groups"), hashes)


def _survivors(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc", "key").agg(F.sort_array(F.collect_set("at")).alias("at"))


def repeated_windows(docs: DataFrame, length: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables (rows, texts, starts).

    rows: doc_id, doc, key, n_words, sha256 of each document and ``first``, whether its class has no smaller document.
    texts: doc, key and text of the documents that may hold repeats. starts: doc, key and the sorted starts ``at``
    of the windows that also begin in a document with a smaller doc_id (for documents that are first in their class).
    """
    lengths = level_lengths(length)
    keyed = _keyed(docs)
    summary = write_through(_summaries(keyed, lengths[0], length), "substring-level")
    leaders = summary.groupBy("sha256").agg(F.min("doc").alias("leader"))
    summary = summary.join(leaders, "sha256").withColumn("first", F.col("doc") == F.col("leader")).drop("leader")
    rows = summary.drop("at", "hash")
    marks = summary.filter("first").select("doc", "key", F.explode(F.arrays_zip("at", "hash")).alias("mark")).select("doc", "key", "mark.*")
    alive = write_through(_survivors(_repeated(marks, ["hash"])), "substring-survivors")
    texts = keyed.drop("doc_id").join(alive, ["doc", "key"])
    texts = write_through(texts, "substring-texts")
    found, before = None, lengths[0]
    for at_length in lengths[1:] or lengths:
        longer = write_through(_longer(texts, lengths[0], before, at_length), "substring-level")
        wide = longer.select("doc", "key", F.explode(F.arrays_zip("at", "hash", "hash2")).alias("w")).select("doc", "key", "w.*")
        found = _repeated(wide, ["hash", "hash2"])
        if at_length < length:
            alive = write_through(_survivors(found), "substring-survivors")
            texts, before = texts.drop("at").join(alive, ["doc", "key"]), at_length
            if alive.isEmpty():
                break
    return rows, texts.select("doc", "key", "text"), _survivors(found.filter("doc > least"))


def _without(texts: DataFrame, length: int) -> DataFrame:
    """Per text: the number of words covered by the windows that start ``at``, and the other words, one space between."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                removed, kept = [], []
                for text, at in zip(part.column(2), part.column(3)):
                    words = text.as_py().encode().split()
                    gone = np.zeros(len(words), bool)
                    starts = np.asarray(at.values, np.int64)
                    gone[ragged(starts, np.full(len(starts), length))] = True
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()]).decode())
                arrays = [*part.columns[:2], pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "key", "n_removed", "kept"])

    return texts.select("doc", "key", "text", "at").mapInArrow(work, "doc long, key long, n_removed long, kept string")


def kept_texts(texts: DataFrame, starts: DataFrame, length: int = 50) -> DataFrame:
    """doc, key, n_removed and the words left (``kept``) of the documents that lose some of their words."""
    return _without(texts.dropDuplicates(["doc", "key"]).join(starts, ["doc", "key"]), length)


def substring_dedup(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 of the words left."""
    rows, texts, starts = repeated_windows(docs, length)
    kept = kept_texts(texts, starts, length).select("doc", "key", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    whole = ~F.col("first") & (F.col("n_words") >= length)
    return rows.join(kept, ["doc", "key"], "left").select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))
