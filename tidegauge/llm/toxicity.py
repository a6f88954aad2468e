"""Toxicity by cumulative-link ordinal regression on sparse words.

A text's features are the words and word beginnings (PREFIXES bytes) of a vocabulary, valued log(1 + count). One weight per word is shared by all
ordered thresholds: P(grade > j) = sigmoid(w . x - theta_j), theta ascending. The output is the expected severity,
the sum of P(grade > j), with the likeliest grade, and ``toxic``: P(grade > 0) at ``cut`` or more.

Labels that say only toxic or not are graded first: rows not toxic are grade 0; toxic rows fall in grade 1 or 2 as
they hold fewer or more of the telling words than the median toxic row. Telling words are those whose rate in
toxic rows is RATE times that in others or more. Such grades follow from the features: what labels bear out is the
first threshold alone, and a caller with graded labels fits them through ``fit_ordinal``.

The model is fitted on at most FIT_ROWS labelled rows of each class (whole texts). Their words are counted by
Spark; the VOCABULARY most telling (by likelihood ratio, MIN_GAIN or more, in MIN_ROWS rows or more) are kept, and the driver holds
these rows' counts only. A class weighs what its share of all labels is, so the probabilities are those of the table. Every row of ``documents`` is scored, whole.

Null and empty texts have no features and get the severity of the thresholds alone. Without examples of both
classes nothing can be learnt: every severity is 0. Rows may repeat, each is scored; null ids too. An empty table
gives an empty result. Other columns pass through ``score`` unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from tidegauge.llm.common import give_back, table, write_through
from tidegauge.llm.sample import FIT_ROWS, Rows, labelled, plain, sigmoid
from tidegauge.llm.words import Words, mixed, slices

#: Words of the model; rows that a word must be in; its least log likelihood ratio; what makes a word telling; the probability of a toxic text.
VOCABULARY, MIN_ROWS, MIN_GAIN, RATE, CUT = 2048, 8, 12.0, 8.0, 0.5

#: Bytes of the word beginnings.
PREFIXES = (5, 6, 7, 8, 9)

#: Grades, steps of the fit, its step width, and the weight of the penalty.
GRADES, STEPS, STEP, PENALTY = 3, 400, 0.05, 1e-4

#: Bytes of text that ``fit`` and ``without_toxic`` work on together: their workers go on to other stages.
SLICE = 1 << 19


class Severity:
    """Sorted word hashes, their weights, and the thresholds."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, theta: np.ndarray) -> None:
        self.words, self.weights, self.theta = words, weights, theta

    def above(self, column: pa.Array) -> np.ndarray:
        """P(grade > j) for each text and threshold j."""
        rows = counted(column, self.words)
        return sigmoid(rows.dot(self.weights)[:, None] - self.theta[None, :])


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The text and the hash of every word and of every beginning of a longer word."""
    words = Words(plain(column))
    texts, sizes = words.text_of_word(), words.ends - words.starts
    ends = words.ends
    all_texts, hashes = [texts], [words.hashes()]
    for size in PREFIXES:
        longer = sizes > size
        words.ends = np.where(longer, words.starts + size, ends)
        all_texts.append(texts[longer])
        hashes.append(mixed(words.hashes()[longer] + np.uint64(size)))
    return np.concatenate(all_texts), np.concatenate(hashes)


def counted(column: pa.Array, vocabulary: np.ndarray) -> Rows:
    """log(1 + count) of each vocabulary word in each text."""
    texts, hashes = features(column)
    size = max(1, len(vocabulary))
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
    pairs, counts = np.unique(texts[known] * size + at[known], return_counts=True)
    return Rows(np.bincount(pairs // size, minlength=len(column)), pairs % size, np.log1p(counts))


def word_rows(sample: DataFrame) -> DataFrame:
    """(word, n0, n1): in how many rows of each class a word stands; counted in each task before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts, hashes = features(part.column(0))
                order = np.lexsort((texts, hashes))
                texts, hashes = texts[order], hashes[order]
                first = np.ones(len(texts), bool)
                first[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
                toxic = part.column(1).to_numpy()[texts[first]]
                each, place = np.unique(hashes[first], return_inverse=True)
                n1 = np.bincount(place, toxic, len(each)).astype(np.int64)
                n = np.bincount(place, minlength=len(each)).astype(np.int64)
                arrays = [pa.array(each.view(np.int64)), pa.array(n - n1), pa.array(n1)]
                yield pa.RecordBatch.from_arrays(arrays, names=["word", "n0", "n1"])
        give_back()

    each = sample.select("text", "label").mapInArrow(work, "word long, n0 long, n1 long")
    return each.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def telling(words: DataFrame, sizes: list[int], most: int = VOCABULARY, min_rows: int = MIN_ROWS) -> DataFrame:
    """The ``most`` words with the greatest likelihood ratio, and by how much their rate is greater in class 1."""
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    both, total = n0 + n1, float(sum(sizes))

    def part(seen: F.Column, size: int) -> F.Column:
        expected = both * (size / total)
        rest = F.lit(float(size)) - seen
        unseen = (F.lit(total) - both) * (size / total)
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0) + F.when(rest > 0, rest * F.log(rest / unseen)).otherwise(0.0)

    ratio = (n1 + 0.5) / sizes[1] / ((n0 + 0.5) / sizes[0])
    scored = words.filter(both >= min_rows).select("word", (part(n0, sizes[0]) + part(n1, sizes[1])).alias("gain"), ratio.alias("rate"))
    return scored.filter(F.col("gain") >= MIN_GAIN).orderBy(F.desc("gain"), "word").limit(most)


def fit_ordinal(rows: Rows, grades: np.ndarray, size: int, weight: np.ndarray, levels: int = GRADES, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds with the greatest likelihood of the grades, each row weighing ``weight``.

    Thresholds are the first one and the logarithms of the gaps, so they stay in order. Steps are Adam's.
    """
    weight = weight / weight.sum()
    values = np.zeros(size + levels - 1)
    if levels > 2:
        values[size + 1 :] = np.log(1.0)
    mean, square = np.zeros_like(values), np.zeros_like(values)

    def thresholds() -> np.ndarray:
        return values[size] + np.concatenate([[0.0], np.cumsum(np.exp(values[size + 1 :]))])

    for turn in range(1, steps + 1):
        theta = thresholds()
        above = sigmoid(rows.dot(values[:size])[:, None] - theta[None, :])
        edge = np.hstack([np.ones((rows.n, 1)), above, np.zeros((rows.n, 1))])
        slope = edge * (1 - edge)
        at = np.arange(rows.n)
        likely = np.maximum(edge[at, grades] - edge[at, grades + 1], 1e-12)
        by_score = -weight * (slope[at, grades] - slope[at, grades + 1]) / likely
        by_theta = np.zeros((rows.n, levels + 1))
        by_theta[at, grades] += weight * slope[at, grades] / likely
        by_theta[at, grades + 1] -= weight * slope[at, grades + 1] / likely
        theta_grad = by_theta[:, 1:-1].sum(0)
        tail = np.cumsum(theta_grad[::-1])[::-1]
        grad = np.concatenate([rows.back(by_score, size) + PENALTY * values[:size], tail[:1], tail[1:] * np.exp(values[size + 1 :])])
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        values = values - STEP * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return values[:size], thresholds()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS) -> Severity | None:
    """A model of the labelled rows of ``docs``; None without examples of both classes."""
    sample = write_through(labelled(docs, labels, label, rows), "toxicity-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    kept = telling(word_rows(sample), [sizes[0], sizes[1]]).collect()
    order = np.argsort(np.array([r["word"] for r in kept], np.int64).view(np.uint64)) if kept else np.empty(0, np.int64)
    vocabulary = np.array([r["word"] for r in kept], np.int64).view(np.uint64)[order]
    rates = np.array([r["rate"] for r in kept], np.float64)[order]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = counted(part.column(1), vocabulary)
                ends = np.cumsum(np.bincount(found.row, minlength=found.n))
                arrays = [part.column(0), part.column(2)]
                for values, kind in ((found.index.astype(np.int32), pa.int32()), (found.value, pa.float64())):
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, kind)))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "label", "index", "value"])

    schema = "doc_id long, label int, index array<int>, value array<double>"
    rows_of = sample.select("doc_id", "text", "label").mapInArrow(work, schema).orderBy("doc_id").collect()
    counts = np.array([len(r["index"]) for r in rows_of])
    index = np.array([i for r in rows_of for i in r["index"]], np.int64)
    value = np.array([v for r in rows_of for v in r["value"]], np.float64)
    found = Rows(counts, index, value)
    toxic = np.array([r["label"] for r in rows_of], np.int64)
    told = found.dot((rates >= RATE).astype(np.float64)) if len(rates) else np.zeros(found.n)
    grades = np.where(toxic == 1, np.where(told > np.median(told[toxic == 1]), 2, 1), 0)
    marked = labels.filter(F.col(label).isin(0, 1)).agg(F.avg(label).alias("share")).first().share
    weight = np.where(toxic == 1, marked / sizes[1], (1 - marked) / sizes[0])
    weights, theta = fit_ordinal(found, grades, len(vocabulary), weight)
    return Severity(vocabulary, weights, theta)


def score(docs: DataFrame, model: Severity | None, cut: float = CUT) -> DataFrame:
    """``docs`` with severity (double), grade (int) and toxic (boolean) behind its columns, which must not have these names."""
    names = [*docs.columns, "severity", "grade", "toxic"]
    more = [StructField("severity", DoubleType()), StructField("grade", IntegerType()), StructField("toxic", BooleanType())]
    if model is None:
        return docs.select("*", F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(False).alias("toxic"))
    text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                above = shared.value.above(part.column(text))
                edge = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
                grade = np.argmax(edge[:, :-1] - edge[:, 1:], 1).astype(np.int32)
                arrays = [*part.columns, pa.array(above.sum(1)), pa.array(grade), pa.array(above[:, 0] >= cut)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(work, StructType([*docs.schema.fields, *more]))


def without_toxic(docs: DataFrame, model: Severity | None, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that ``score`` does not call toxic, with their columns."""
    if model is None:
        return docs
    text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield part.filter(pa.array(shared.value.above(part.column(text))[:, 0] < cut))
        give_back()

    return docs.mapInArrow(work, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, severity (0 to 2), grade and toxic of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text")
