"""Plain sequential scoring, to check the Spark operators against."""

import math


def welford(values):
    n, mean, m2 = 0, 0.0, 0.0
    for x in values:
        n += 1
        gap = x - mean
        mean += gap / n
        m2 += gap * (x - mean)
    return n, mean, m2


def z_of(x, before):
    n, mean, m2 = welford(before)
    sd = math.sqrt(m2 / (n - 1)) if n >= 2 else 0.0
    return 0.0 if n < 2 or sd == 0 else (x - mean) / sd


def epoch_scores(values, size=200):
    return [z_of(x, values[i // size * size : i]) for i, x in enumerate(values)]


def sliding_scores(values, size=200):
    return [z_of(x, values[max(0, i - size) : i]) for i, x in enumerate(values)]
