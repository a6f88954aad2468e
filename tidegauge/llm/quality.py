"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

A text is a row of tokens: each word gives its letters (lower-cased, ASCII punctuation off) and its shape (each
run of capitals, small letters, digits, other bytes or one punctuation character as one sign). Every token has a
sparse random index vector, drawn from its hash. A token's vector is the sum of the index vectors of its
neighbours, weighted by how often they meet, plus its own, at length 1. A document is the mean of its
tokens' vectors, the mean over its distinct tokens, the share of distinct tokens and the logarithm of their
number, so word order outside the learnt vectors does not matter and every token of a long text counts.

A two-layer numpy network is fitted on three quarters of the examples; one temperature, chosen on the rest, makes
its scores probabilities. Examples are at most FIT_ROWS rows of each class (whole texts). The vectors need no labels:
tokens are counted, and their neighbours added up, over the texts of all documents. The VOCABULARY most frequent
tokens have a vector each, all others share one. Inputs are texts alone.

Null and empty texts have no tokens: their pooled vector is zero and they get the score of that. Without examples
of both classes every score is 0.5. Rows may repeat and ids may be null; each row is scored. An empty table gives an
empty result. Other columns pass through ``score`` unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidegauge.llm.common import give_back, table, write_through
from tidegauge.llm.sample import FIT_ROWS, labelled, mapped, plain, sigmoid
from tidegauge.llm.words import Words, mixed, powers, slices

#: Tokens with a vector, the length of vectors, the signs of an index vector, and the neighbours on each side.
VOCABULARY, WIDTH, SIGNS, REACH = 8192, 64, 4, 2

#: Hidden units, passes over the examples, rows of a step, the seed, and the score of a good text.
HIDDEN, PASSES, STEP_ROWS, SEED, CUT = 48, 60, 128, 11, 0.7

#: Bytes of text that the vectors and the scores work on together.
SLICE = 1 << 20

#: Distinct tokens of a text whose vectors are gathered together.
PIECE = 1 << 15

_SHAPE = np.arange(256, dtype=np.uint8)
for _low, _high, _sign in ((0x30, 0x3A, 0x39), (0x41, 0x5B, 0x41), (0x61, 0x7B, 0x61)):
    _SHAPE[_low:_high] = _sign
_INNER = _SHAPE.copy()
_INNER[128:] = 0x61
_SIGNS = mixed(np.arange(1, 257, dtype=np.uint64))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the tokens of all texts in order, and where each text's tokens begin. Words give two tokens."""
    shaped = Words(column)
    letters = Words(plain(column))
    data = _INNER[shaped.data]
    new = np.ones(len(data), bool)
    new[1:] = data[1:] != data[:-1]
    new[shaped.starts] = True
    place, signs = np.cumsum(new), _SIGNS[data[new]]
    sums = np.zeros(len(signs) + 1, np.uint64)
    np.cumsum(signs * powers(0x9E3779B97F4A7C15, len(signs) + 1)[1:], out=sums[1:])
    undo = powers(pow(0x9E3779B97F4A7C15, -1, 1 << 64), len(signs) + 1)
    begin, end = place[shaped.starts] - 1, place[shaped.ends - 1]
    shape = mixed((sums[end] - sums[begin]) * undo[begin + 1] + np.uint64(77))
    # the shapes of a text, then its letters
    out = np.empty(len(shape) + len(letters.starts), np.uint64)
    out[np.arange(len(shape)) + np.repeat(letters.first[:-1], shaped.counts)] = shape
    out[np.arange(len(letters.starts)) + np.repeat(shaped.first[1:], letters.counts)] = letters.hashes()
    return out, shaped.first + letters.first


def index_entries(hashes: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the sparse random vector of each hash has its entry of that turn, and the entry: +1 or -1."""
    drawn = mixed(hashes + np.uint64(turn * 0x51ED27))
    return ((drawn >> np.uint64(8)) % np.uint64(WIDTH)).astype(np.int64), np.where(drawn & np.uint64(1), 1.0, -1.0)


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """The sparse random vector of each hash: SIGNS entries."""
    out = np.zeros((len(hashes), WIDTH), np.float32)
    for turn in range(SIGNS):
        place, entry = index_entries(hashes, turn)
        out[np.arange(len(hashes)), place] += entry
    return out


class Pooling:
    """Sorted token hashes and their vectors; the last vector is that of all other tokens."""

    def __init__(self, words: np.ndarray, vectors: np.ndarray) -> None:
        self.words, self.vectors = words, vectors

    @cached_property
    def exact(self) -> np.ndarray:
        return self.vectors.astype(np.float64)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        known = self.words[at] == hashes if len(self.words) else np.zeros(len(hashes), bool)
        return np.where(known, at, len(self.words))

    def pooled(self, column: pa.Array) -> np.ndarray:
        """The features of each text."""
        hashes, first = tokens(column)
        counts = np.diff(first)
        text = np.repeat(np.arange(len(counts)), counts)
        # equal tokens of a text side by side
        order = np.argsort((text.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
        own, of = hashes[order], text[order]
        fresh = np.ones(len(own), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (of[1:] != of[:-1])
        distinct = np.bincount(of[fresh], minlength=len(counts))
        out = np.zeros((len(counts), 2 * WIDTH + 2))
        heads = np.flatnonzero(fresh)
        times = np.diff(np.append(heads, len(own)))
        number, of = self.number(own[heads]), of[heads]
        weights = np.stack([times, np.ones(len(times))])
        bounds = np.searchsorted(of, np.arange(len(counts) + 1)).tolist()
        for i in np.flatnonzero(counts).tolist():
            for at in range(bounds[i], bounds[i + 1], PIECE):
                end = min(at + PIECE, bounds[i + 1])
                out[i, : 2 * WIDTH] += (weights[:, at:end] @ self.exact[number[at:end]]).ravel()
        out[:, :WIDTH] /= np.maximum(counts, 1)[:, None]
        out[:, WIDTH : 2 * WIDTH] /= np.maximum(distinct, 1)[:, None]
        out[:, -2] = distinct / np.maximum(counts, 1)
        out[:, -1] = np.log1p(counts)
        return out


class Network:
    """Two layers over standardised features, and a temperature."""

    def __init__(self, width: int, hidden: int = HIDDEN, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed)
        self.mean, self.spread, self.temperature = np.zeros(width), np.ones(width), 1.0
        self.w = [draw.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden), draw.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.tanh(z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)

    def fit(self, x: np.ndarray, y: np.ndarray, passes: int = PASSES, seed: int = SEED) -> None:
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-3
        draw = np.random.default_rng(seed)
        first, second, turn = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(passes):
            order = draw.permutation(len(y))
            for at in range(0, len(y), STEP_ROWS):
                rows = order[at : at + STEP_ROWS]
                z = np.clip((x[rows] - self.mean) / self.spread, -8, 8)
                h = np.tanh(z @ self.w[0] + self.w[1])
                off = (sigmoid(h @ self.w[2] + self.w[3][0]) - y[rows]) / len(rows)
                back = np.outer(off, self.w[2]) * (1 - h * h)
                grads = [z.T @ back + 1e-4 * self.w[0], back.sum(0), h.T @ off + 1e-4 * self.w[2], np.array([off.sum()])]
                turn += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - 0.003 * (first[i] / (1 - 0.9**turn)) / (np.sqrt(second[i] / (1 - 0.999**turn)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss."""
        logits = self.logits(x)
        tried = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        losses = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in tried]
        self.temperature = float(tried[int(np.argmin(losses))])


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n): counted in each task before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                each, n = np.unique(tokens(part.column(0))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    return docs.select("text").mapInArrow(work, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def contexts(docs: DataFrame, words: np.ndarray) -> np.ndarray:
    """For each of the words, and for all others as one, the sum of its neighbours' index vectors in all texts.

    A task adds up its own rows and passes on one row for each word. All sums are whole numbers, so their order is free.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, size = Pooling(words, np.empty(0)), 2 * WIDTH * (len(words) + 1)
        # how often each word meets +1 and -1 in each place; what is counted behind them crosses the end of a text
        sums = np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                hashes, first = tokens(part.column(0))
                number = own.number(hashes) * (2 * WIDTH)
                for turn in range(SIGNS):
                    place, entry = index_entries(hashes, turn)
                    met = 2 * place + (entry < 0)
                    for step in range(1, min(REACH, len(hashes) - 1) + 1):
                        across = (first[1:-1, None] - np.arange(1, step + 1)).ravel()
                        across = across[(across >= 0) & (across < len(hashes) - step)]
                        for keys in (number[:-step] + met[step:], number[step:] + met[:-step]):
                            keys[across] = size
                            sums += np.bincount(keys, minlength=size + 1)
        table = (sums[:-1:2] - sums[1::2]).reshape(-1, WIDTH)
        some = np.flatnonzero(table.any(1))
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * WIDTH, pa.int32()), pa.array(table[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some), values], names=["number", "sums"])
        give_back()

    parts = docs.select("text").mapInArrow(work, "number long, sums array<long>")
    added = parts.groupBy("number").agg(F.array(*[F.sum(F.col("sums")[d]) for d in range(WIDTH)]).alias("sums"))
    out = np.zeros((len(words) + 1, WIDTH))
    for row in added.toLocalIterator():
        out[row["number"]] = row["sums"]
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> tuple[Pooling, Network] | None:
    """Vectors of all ``docs`` and the network of the labelled ones; None without examples of both classes."""
    sample = write_through(labelled(docs, labels, label, rows).repartition(16, "doc_id"), "quality-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    common = token_counts(docs).filter("n > 1").orderBy(F.desc("n"), "token").limit(VOCABULARY).collect()
    words = np.sort(np.array([r["token"] for r in common], np.int64).view(np.uint64))
    own = np.vstack([index_vectors(words), np.zeros((1, WIDTH), np.float32)])
    near = contexts(docs, words)
    near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
    vectors = near + own / np.sqrt(SIGNS)
    vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    pooling = Pooling(words, vectors)
    found = pooled_rows(sample, pooling).orderBy("doc_id").collect()
    x = np.array([r["features"] for r in found], np.float64)
    y = np.array([r["label"] for r in found], np.float64)
    apart = mixed(np.array([r["doc_id"] for r in found], np.int64).view(np.uint64)) % np.uint64(4) == 0
    network = Network(x.shape[1])
    network.fit(x[~apart] if (~apart).any() else x, y[~apart] if (~apart).any() else y)
    if apart.any():
        network.calibrate(x[apart], y[apart])
    return pooling, network


def pooled_rows(sample: DataFrame, pooling: Pooling) -> DataFrame:
    """(doc_id, label, features) of the examples."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = pooling.pooled(part.column(1)).astype(np.float64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists], names=["doc_id", "label", "features"])

    return sample.select("doc_id", "text", "label").mapInArrow(work, "doc_id long, label int, features array<double>")


def score(docs: DataFrame, model: tuple[Pooling, Network] | None) -> DataFrame:
    """``docs`` with ``score`` behind its columns, none of which may have that name."""
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    text, names = docs.columns.index("text"), [*docs.columns, "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooling, network = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = network.probability(pooling.pooled(part.column(text)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=names)

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; held-out labels are never learnt from."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held))
    found = score(docs, model)
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
