"""What the operators share: reading, keys that survive nulls and repeated rows, components, running sums."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.session import scratch_path, write_through

#: Stands for a null id where rows are put in order: after every other id.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until ``df`` has no such column."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
        have.add(name.lower())
    return out


def order_id(name: str = "doc_id") -> Column:
    """The id to order by, nulls last."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def give_back() -> None:
    """Return to the system what this worker's task has freed; the worker goes on to tasks of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """For work done inside: Spark hands a worker at most ``rows`` rows and ``size`` bytes together, one row at least.

    Its defaults, 10,000 and 64 MB, are held by Spark and by every worker.
    """
    row_key, size_key = (f"spark.sql.execution.arrow.{name}PerBatch" for name in ("maxRecords", "maxBytes"))
    held = {key: spark.conf.get(key) for key in (row_key, size_key)}
    try:
        if not 0 < int(held[row_key]) <= rows:
            spark.conf.set(row_key, str(rows))
        spark.conf.set(size_key, str(size))
        yield
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


def connected(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the smallest node of its component.

    Alternates large-star and small-star rounds. Each round is a table in the shared folder, so the lineage
    stays short and nothing is gathered on the driver but three counts. Rounds grow with the logarithm of
    the longest chain. Loops (a = b) are allowed, empty input gives an empty table.
    """
    spark = edges.sparkSession
    stars = write_through(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = write_through(large, label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (
            small.select("a", F.col("m").alias("b"))
            .union(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        stars = write_through(small, label)
        total = stars.agg(F.count("*").alias("n"), F.countDistinct("a").alias("nodes")).first()
        loose = stars.join(stars.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
        if total.n == total.nodes and not loose:
            break
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def running_sum(df: DataFrame, by: list[str], bins: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the same ``by``.

    ``bins`` numbers ranges of the order; a bin is one task's work, and the bins' totals (one row for each) are
    summed in a second, small window. So a hot group is spread over its bins.
    """
    totals = df.groupBy(*by, bins).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*by).orderBy(bins).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, bins]]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    within = Window.partitionBy(*by, bins).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = df.alias("l").join(totals.alias("r"), condition, "left")
    return joined.select(*[f"l.{c}" for c in df.columns if c != "_within"], (F.col("_within") + F.col("_before")).alias(out))


def binned(df: DataFrame, order: list[str], label: str, rows_per_bin: int = 200_000) -> DataFrame:
    """``df`` range-partitioned by ``order`` with the partition's number as ``_bin``, as a table in the shared folder."""
    df = write_through(df, label + "-rows")
    n = max(1, -(-df.count() // rows_per_bin))
    ranged = df.repartitionByRange(n, *order) if n > 1 else df.coalesce(1)
    return write_through(ranged.withColumn("_bin", F.spark_partition_id()), label)


__all__ = ["NO_ID", "binned", "connected", "give_back", "order_id", "running_sum", "scratch_path", "small_batches", "table", "unused", "write_through"]
