"""Split the ordered rows of each key into blocks that tasks can work on side by side.

A window over a key puts the whole key into one task. Here a key with more than ``block_rows`` rows
is cut into blocks of consecutive positions, so that one key may hold any share of the data:

1. count the rows per key; keys within one block need nothing more;
2. cut each larger key into slices of its order range and count those, cutting overfull slices
   again until each is a small part of a block (a burst or a third of the rows at one instant
   only leads to more cuts, down to single order values);
3. running totals over the slice counts give each slice its first position and hence its blocks;
   a slice that crosses a block border goes to both;
4. one shuffle of the rows by (key, block), and a row number within the block; a task takes many
   small blocks, so the tasks follow the rows and not the number of blocks.

Only the key and order columns are read in steps 1 and 2, with partial counts ahead of each
shuffle. The lookup tables hold at most a fixed number of entries per block, and the block size
grows with the data, so the broadcast size is bounded whatever the input. Everything follows from
the rows alone: a task that is run again puts its rows in the same place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through

BLOCK = "_block"
POS = "_pos"
OWN = "_own"

BLOCK_ROWS = 1_000_000
LOOKUP_ROWS = 1_000_000  # most entries a broadcast lookup may hold
SLICES_PER_BLOCK = 8  # aimed at by a cut
OVERFULL = 4  # a slice of more than 1/4 block is cut again
TASK_ROWS = 1_000_000  # rows that a task takes where blocks are smaller
CUT = ("_column", "_shift", "_lo", "_width")  # of a cut slice: what by, the bits left out, from where, how wide


def as_long(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        return F.col(name).cast("long")
    raise TypeError(f"order column {name} must be an integer or a timestamp, not {kind}")


def null_safe_join(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str, small: bool = False) -> DataFrame:
    """Join on equal columns, NULL being equal to NULL; ``on`` keeps the names and values of ``rows``."""
    table = table.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in table.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    joined = rows.join(F.broadcast(table) if small else table, reduce(Column.__and__, same), how)
    return joined.drop(*[f"_r_{c}" for c in on])


def ordered_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    align: int = 1,
    halo: int = 0,
    start: str | None = None,
    block_rows: int = BLOCK_ROWS,
    lookup_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """Add the 0-based position ``_pos`` of each row in its key, its ``_block``, and ``_own``.

    Window over ``(*keys, _block)`` and then keep the rows with ``_own``: the others are copies of
    the last ``halo`` rows before the block. Blocks start at multiples of ``align``. The ``order``
    columns (integers or timestamps) must tell the rows of a key apart. Rows without an order come
    first, in the order of a hash of their columns; a NULL key is a key like any other. ``start``
    names a column, equal within a key, with the position of the key's first row. ``df`` is read up
    to four times and must give the same rows each time: store the output of an expensive step first.
    """
    keys, order, given = list(keys), list(order), df.columns
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unset = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(order)]
    total, *unset = df.agg(F.count(F.lit(1)), *unset).first()
    if any(unset):
        df, order = _with_unset(df, order, unset)
    # a cut makes at most 12 slices per block, so 16 keeps each lookup below its limit
    block_rows = max(block_rows, 16 * total // lookup_rows, halo, 1)
    block_rows = -(-block_rows // align) * align
    tasks = max(shuffles, -(-total // max(block_rows, TASK_ROWS)))
    first = F.col(start).cast("long") if start else F.lit(0).cast("long")

    found = None
    if total > block_rows:
        found = _slices(df, keys, order, block_rows, halo, first, lookup_rows)
    if found is None:
        rows = df.withColumn(BLOCK, F.lit(0).cast("long")).withColumn("_base", first)
        if tasks > shuffles:
            rows = rows.repartition(tasks, *keys)
    else:
        cuts, slices = found
        rows, path = _descend(df, df, keys, order, cuts, lookup_rows, "left")
        # a short path ends in -1 on both sides, so that plain equality joins it
        rows = rows.select(*df.columns, *[F.coalesce(F.col(c), F.lit(-1)).alias(c) for c in path])
        rows = _lookup(rows, slices, keys + path, lookup_rows, "left").drop(*path)
        rows = rows.repartition(tasks, *keys, BLOCK)

    rank = F.row_number().over(Window.partitionBy(*keys, BLOCK).orderBy(*order))
    if found is None:
        rows = rows.withColumn(POS, F.col("_base") + rank - 1).withColumn(OWN, F.lit(True))
        return rows.select(*given, BLOCK, POS, OWN)
    rows = rows.withColumn(POS, F.coalesce(F.col("_base"), first) + rank - 1)
    whole = F.col("_base").isNull()  # a key of one block
    begin = F.coalesce(F.col(BLOCK), F.lit(0)) * block_rows
    inside = F.col(POS) < begin + block_rows
    return (
        rows.where(whole | (inside & (F.col(POS) >= begin - halo)))
        .withColumn(OWN, whole | (F.col(POS) >= begin))
        .select(*given, BLOCK, POS, OWN)
    )


def _with_unset(df: DataFrame, order: list[str], unset: Sequence[int]) -> tuple[DataFrame, list[str]]:
    """Order columns without NULLs: whether a value is set, the value, and a hash to tell rows apart."""
    columns: dict[str, Column] = {}
    for i, (c, n) in enumerate(zip(order, unset)):
        if n:
            columns[f"_set{i}"] = F.col(c).isNotNull().cast("int")
        columns[f"_order{i}"] = F.coalesce(as_long(df, c), F.lit(0))
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    columns["_tie"] = F.xxhash64(*hashed)
    return df.withColumns(columns), list(columns)


def _lookup(rows: DataFrame, table: DataFrame, on: list[str], limit: int, how: str) -> DataFrame:
    """Join a written lookup: broadcast while its counted rows are few, else by a plain join.

    The cuts stay within the limit by the choice of the block size. Only the final slices can exceed
    it, after many levels of cuts, and they are even enough for a join: none exceeds 1/4 block.
    """
    return null_safe_join(rows, table, on, how, table.count() <= limit)


def _descend(rows, df, keys, order, cuts, limit, how):
    """Follow the cuts from the key down; each adds the number of the slice the row falls into."""
    path: list[str] = []
    for level, cut in enumerate(cuts):
        rows = _lookup(rows, cut, keys + path, limit, how)
        picks = [F.when(F.col("_column") == i, as_long(df, c)) for i, c in enumerate(order)]
        rows = rows.withColumn("_at", F.coalesce(*picks))
        path.append(f"_s{level}")
        rows = rows.withColumn(path[-1], F.expr("(shiftright(_at, _shift) - _lo) div _width")).drop("_at", *CUT)
    return rows, path


def _cut(counted: DataFrame, order: list[str], more_than: int, block_rows: int) -> DataFrame:
    """How to cut each overfull slice: by the first order column that varies in it.

    Values more than a long apart, as hashes are, lose their last bit, and are cut by it further on.
    """
    varies = [F.when(F.col(f"_max{i}") > F.col(f"_min{i}"), F.lit(i)) for i in range(len(order))]
    ends = [F.coalesce(*[F.when(F.col("_column") == i, F.col(f"_{end}{i}")) for i in range(len(order))]) for end in ("min", "max")]
    parts = F.greatest(F.ceil(F.col("_n") * SLICES_PER_BLOCK / block_rows), F.lit(2))
    return (
        counted.where(F.col("_n") > more_than)
        .withColumn("_column", F.coalesce(*varies))
        .where(F.col("_column").isNotNull())
        .withColumns({"_min": ends[0], "_max": ends[1], "_parts": parts})
        .withColumn("_shift", F.expr(f"int(shiftright(_max, 1) - shiftright(_min, 1) >= {1 << 62})"))
        .withColumn("_lo", F.expr("shiftright(_min, _shift)"))
        .withColumn("_width", F.expr("(shiftright(_max, _shift) - _lo) div _parts + 1"))
        .drop("_min", "_max", "_parts")
    )


def _slices(df, keys, order, block_rows, halo, first, limit):
    """The cuts, and the blocks of every slice; None if no key exceeds a block."""
    narrow = df.select(*keys, *order, first.alias("_first"))
    measures = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(order):
        measures += [F.min(as_long(df, c)).alias(f"_min{i}"), F.max(as_long(df, c)).alias(f"_max{i}")]

    large = narrow.groupBy(*keys).agg(F.min("_first").alias("_first"), *measures)
    large = write_through(large.where(F.col("_n") > block_rows), "large-keys")
    todo = _cut(large, order, block_rows, block_rows).select(*keys, *CUT)
    cuts: list[DataFrame] = []
    leaves: list[DataFrame] = []
    while todo.count():
        cuts.append(todo)
        rows, path = _descend(narrow, df, keys, order, cuts, limit, "inner")
        counted = write_through(rows.groupBy(*keys, *path).agg(*measures), "slices")
        again = _cut(counted, order, block_rows // OVERFULL, block_rows)
        todo = write_through(again.select(*keys, *path, *CUT), "cuts")
        leaves.append(null_safe_join(counted, todo, keys + path, "left_anti").select(*keys, *path, "_n"))
    if not cuts:
        return None

    path = [f"_s{level}" for level in range(len(cuts))]
    padded = [
        leaf.select(*keys, *[F.col(c) if c in leaf.columns else F.lit(-1).cast("long").alias(c) for c in path], "_n")
        for leaf in leaves
    ]
    slices = null_safe_join(reduce(DataFrame.unionByName, padded), large.select(*keys, "_first"), keys, "inner")
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy(*path).rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        slices.withColumn("_off", F.col("_first") + F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_rows", F.sum("_n").over(by_key))
        .withColumn("_from", F.expr(f"_off div {block_rows}"))
        .withColumn("_to", F.expr(f"(_off + _n - 1 + {halo}) div {block_rows}"))
        .withColumn("_end", F.expr(f"(_first + _rows - 1) div {block_rows}"))
        .withColumn(BLOCK, F.explode(F.sequence("_from", F.least("_to", "_end"))))
        .withColumn("_base", F.min("_off").over(Window.partitionBy(*keys, BLOCK)))
    )
    return cuts, write_through(slices.select(*keys, *path, BLOCK, "_base"), "blocks")
