"""Stateful scoring on Spark's state store: one running baseline per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.stats import BASELINE_ROWS, Z_THRESHOLD

_SUMMARY = "n long, mean double, m2 double"
_RECENT = "recent array<double>"


def score_values(
    values: np.ndarray, n: int, mean: float, m2: float, size: int
) -> tuple[np.ndarray, int, float, float]:
    """Scores of one key's next values, each against the epoch so far, and the summary after them."""
    scores = np.zeros(len(values))
    at = 0
    while at < len(values):
        if n >= size:
            n, mean, m2 = 0, 0.0, 0.0
        part = values[at : at + size - n]
        # moments of the first 0, 1, 2, ... points, around a centre inside the data
        centre = mean if n else part[0]
        gaps = np.concatenate(([0.0], part - centre))
        count = n + np.arange(len(part) + 1)
        total = np.cumsum(gaps)
        squares = m2 + np.cumsum(gaps * gaps)
        safe = np.maximum(count, 1)
        means = centre + total / safe
        spread = np.maximum(squares - total * total / safe, 0.0)
        sd = np.sqrt(spread[:-1] / np.maximum(count[:-1] - 1, 1))
        known = (count[:-1] >= 2) & (sd > 0)
        np.divide(part - means[:-1], sd, out=scores[at : at + len(part)], where=known)
        at += len(part)
        n, mean, m2 = int(count[-1]), float(means[-1]), float(spread[-1])
    return scores, n, mean, m2


def score_recent(values: np.ndarray, recent: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores of one key's next values against the ``size`` values before each."""
    line = np.concatenate((recent, values))
    scores = np.zeros(len(values))
    for i in range(0, len(values), 4096):
        stop = min(i + 4096, len(values))
        first = len(recent) + i
        for j in range(first, min(first + max(0, size - first), len(recent) + stop)):
            scores[j - len(recent)] = _one(line[:j], line[j])
        j = max(first, size)
        if j < len(recent) + stop:
            frames = np.lib.stride_tricks.sliding_window_view(line[j - size : len(recent) + stop - 1], size)
            mean, sd = frames.mean(axis=1), frames.std(axis=1, ddof=1) if size > 1 else np.zeros(len(frames))
            flat = frames.max(axis=1) == frames.min(axis=1)
            now = line[j : len(recent) + stop]
            out = scores[j - len(recent) : stop]
            np.divide(now - mean, sd, out=out, where=(sd > 0) & ~flat)
    return scores, line[-size:]


def _one(before: np.ndarray, value: float) -> float:
    if len(before) < 2 or before.max() == before.min():
        return 0.0
    return float((value - before.mean()) / before.std(ddof=1))


def score_stream(
    stream: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] = ("seq",),
    size: int = BASELINE_ROWS,
    threshold: float = Z_THRESHOLD,
    sliding: bool = False,
    idle_ms: int | None = None,
) -> DataFrame:
    """Add ``zscore`` and ``is_anomaly`` to a stream.

    Rows of a micro-batch are put in ``order`` per key; micro-batches follow one another as the
    source delivers them. Limit the micro-batch at the source: a key's rows of one batch are held in
    one task. ``score_batches`` splits them instead. ``idle_ms`` forgets keys not seen for so
    long; such a query always has another batch to run, so give it a processing-time trigger.
    """
    keys, order = list(keys), list(order)
    fields = [*stream.schema.fields, T.StructField("zscore", T.DoubleType()), T.StructField("is_anomaly", T.BooleanType())]
    names = stream.columns

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # a key's rows come in several chunks: order holds only over all of them
        rows = pd.concat(list(chunks), ignore_index=True).sort_values(order, ignore_index=True)
        values = rows[value].to_numpy(dtype="float64")
        if sliding:
            (recent,) = state.get if state.exists else ([],)
            scores, recent = score_recent(values, np.asarray(recent, dtype="float64"), size)
            state.update(([float(x) for x in recent],))
        else:
            n, mean, m2 = state.get if state.exists else (0, 0.0, 0.0)
            scores, n, mean, m2 = score_values(values, n, mean, m2, size)
            state.update((n, mean, m2))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield rows[names].assign(zscore=scores, is_anomaly=np.abs(scores) > threshold)

    return stream.groupBy(*keys).applyInPandasWithState(
        step,
        T.StructType(fields),
        _RECENT if sliding else _SUMMARY,
        "append",
        GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout,
    )
