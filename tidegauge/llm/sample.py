"""What the text classifiers share: plain words, a bounded sample of labelled rows, and sparse rows of counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.words import text_bytes

#: Rows of a class that a model may be fitted on; the bound of what the driver gathers.
FIT_ROWS = 3000

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = 0x20
for _low, _high, _shift in ((0x30, 0x3A, 0), (0x41, 0x5B, 32), (0x61, 0x7B, 0)):
    _PLAIN[_low:_high] = np.arange(_low, _high) + _shift


def mapped(column: pa.Array, table: np.ndarray) -> pa.Array:
    """The texts with every byte replaced by its entry (ASCII for ASCII, others unchanged); nulls as empty texts."""
    data, offsets = text_bytes(column)
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(table[data])]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def plain(column: pa.Array) -> pa.Array:
    """Letters lower-cased and every ASCII character but letters and digits a space."""
    return mapped(pc.utf8_lower(column), _PLAIN)


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled rows of each class: those with the least hash of the id.

    Rows without an id, text or label of 0 or 1 are no examples. An id labelled twice takes its greater label.
    """
    marks = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    keyed = marks.filter("doc_id is not null").withColumn("_key", F.xxhash64("doc_id"))
    picked = None
    for value in (0, 1):
        some = keyed.filter(F.col("label") == value).orderBy("_key", "doc_id").limit(rows)
        picked = some if picked is None else picked.union(some)
    texts = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    joined = texts.join(F.broadcast(picked.select("doc_id", "label")), "doc_id")
    return joined.dropDuplicates(["doc_id"])


class Rows:
    """Sparse rows: ``heads`` (where each begins), ``index`` and ``value``."""

    def __init__(self, sizes: np.ndarray, index: np.ndarray, value: np.ndarray) -> None:
        self.n, self.index, self.value = len(sizes), index, value
        self.row = np.repeat(np.arange(self.n), sizes)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.index], self.n)

    def back(self, grad: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, self.value * grad[self.row], size)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def batches_of(rows: Iterator[pa.RecordBatch], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The batches, none with more than ``most`` rows."""
    for batch in rows:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)
