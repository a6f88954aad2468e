"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, in two segments of 32, and each segment has a table: its values, and the fingerprints
that hold them there. Of two fingerprints at 2 bits or fewer, the first segments are at 1 bit or equal, or the second
ones are equal. So every fingerprint looks up the 33 values of the Hamming ball around its first segment in the first
table and its second segment in the second, and what it meets is verified on the complete fingerprint. Copies meet
once, as one fingerprint.

A value that more than BUCKET fingerprints share would let each of them meet all others. Its bucket is split: the
fingerprints that look it up meet by whole values one bit from them (65 keys each) instead. Two fingerprints at 2 bits
or fewer share such a key, and a key has at most 65 of them, so no bucket grows with the data and no link is lost.

Nulls and empty texts have the fingerprint zero and are linked like any other. Rows may repeat: each row gets
its answer. A null doc_id takes part, but a component is named by its smallest non-null doc_id (null if it has
none). An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidegauge.llm.common import connected, give_back, order_id, table, unused, write_through
from tidegauge.llm.words import SPACE, Words, ragged, slices
from tidegauge.llm.xx64 import digests

#: The seed of the shingle hash.
SEED = 42

#: Fingerprints whose keys are enumerated in one task; each has 34, or 65.
PRINTS_PER_TASK = 20_000

#: Fingerprints that may share a segment's value before its bucket is split.
BUCKET = 64


def _joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts with one space behind each word, and where each word begins and ends there."""
    solid = ~SPACE[words.data]
    kept = solid.copy()
    gaps = words.ends[words.ends < len(solid)]
    kept[gaps] = True
    place = np.cumsum(kept) - 1
    out = np.where(solid, words.data, np.uint8(0x20))[kept]
    starts = place[words.starts]
    return out.tobytes(), starts, starts + (words.ends - words.starts)


def fingerprint_array(column: pa.Array, width: int = 3) -> np.ndarray:
    """The 64-bit fingerprint of each text: A-Z lower-cased, shingles of ``width`` words with repeats, majority by bit."""
    words = Words(column, lower=True)
    data, starts, ends = _joined(words)
    counts = words.counts
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    firsts = ragged(words.first[:-1], shingles)
    lasts = firsts + np.repeat(np.minimum(counts, width) - 1, shingles)
    hashes = digests(data, starts[firsts], ends[lasts] - starts[firsts], SEED)
    return _majorities(hashes, shingles)


def _majorities(hashes: np.ndarray, counts: np.ndarray, most: int = 1 << 15) -> np.ndarray:
    """For each run of ``counts`` hashes, the bits set in over half of them.

    Four bits are counted at a time, in lanes of 16 bits, over pieces of at most ``most`` hashes.
    """
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    sizes, heads = counts[some], (np.cumsum(counts) - counts)[some]
    pieces = -(-sizes // most)
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(heads, pieces) + most * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    found = np.zeros(len(some), np.uint64)
    for low in range(16):
        lanes = np.add.reduceat((hashes >> np.uint64(low)) & np.uint64(0x0001000100010001), cuts)
        for lane in range(0, 64, 16):
            ones = np.add.reduceat((lanes >> np.uint64(lane)) & np.uint64(0xFFFF), first)
            found |= (2 * ones > sizes).astype(np.uint64) << np.uint64(low + lane)
    out[some] = found
    return out


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint (long) as one more column."""
    schema = StructType([*docs.schema.fields, StructField(out, LongType())])
    names = [f.name for f in schema.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = fingerprint_array(part.column(part.schema.get_field_index(text)), width)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found.view(np.int64))], names=names)
        give_back()

    return docs.mapInArrow(work, schema)


def radii(max_bits: int, segments: int = 2) -> list[int]:
    """The radius to search in each segment, -1 for none, so that no pair at ``max_bits`` or fewer is missed."""
    whole, more = divmod(max_bits, segments)
    return [whole if segment <= more else whole - 1 for segment in range(segments)]


def near_values(value: Column, bits: int, radius: int) -> Column:
    """The array of all values at ``radius`` (0 or 1) bits or fewer from the lowest ``bits`` of ``value``."""
    if not radius:
        return F.array(value)
    flips = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    return F.concat(F.array(value), flips)


def segment_keys(fingerprint: Column, radius: list[int]) -> Column:
    """The keys, segment number and value in one long, of the ball around each segment; none where its radius is -1."""
    bits = 64 // len(radius)
    keys = []
    for segment, r in enumerate(radius):
        value = F.shiftrightunsigned(fingerprint, segment * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        number = F.lit(segment << bits).cast("long")
        if r >= 0:
            keys.append(near_values(value.bitwiseOR(number), bits, r))
    return F.concat(*keys)


def links(distinct: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that join all distinct ``fingerprint`` values at ``max_bits`` (at most 2) or fewer.

    Every link has ``max_bits`` or fewer. Pairs of unsplit buckets are all there, those of split ones as ``whole_links`` has them.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    tasks = max(1, -(-distinct.count() // PRINTS_PER_TASK))
    dealt = distinct.select("fingerprint").repartition(tasks, "fingerprint")
    radius, own = radii(max_bits), F.col("fingerprint")
    probes = dealt.select(own.alias("a"), F.explode(segment_keys(own, radius)).alias("key"))
    entries = dealt.select(own.alias("b"), F.explode(segment_keys(own, [min(r, 0) for r in radius])).alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("n"))
    hot = write_through(sizes.filter(F.col("n") > bucket).select("key"), "simhash-hot")
    some = bool(hot.head(1))
    if some:
        entries = entries.join(hot, "key", "left_anti")
    met = probes.join(entries, "key").select("a", "b")
    found = met.filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    if some:
        again = probes.join(hot, "key", "left_semi").select(F.col("a").alias("fingerprint")).distinct()
        found = found.union(whole_links(again, max_bits))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def whole_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links as of ``links``, found by all 64 bits at once: by the 65 values one bit or fewer from each fingerprint.

    Of the matches of one key (65 at most) each is linked to the smallest, after the complete distance is
    verified; all matches of a key are within 2 bits of each other, so this connects what all pairs would.
    With ``max_bits`` 1 the key itself must be a fingerprint, and its matches are linked to it.
    """
    own = F.col("fingerprint")
    keys = distinct.select(own.alias("b"), F.explode(near_values(own, 64, min(max_bits, 1))).alias("key"))
    matches = keys.groupBy("key").agg(F.collect_list("b").alias("matches")).filter(F.size("matches") > 1)
    centre = F.array_min("matches") if max_bits != 1 else F.when(F.array_contains("matches", F.col("key")), F.col("key"))
    pairs = matches.select(centre.alias("a"), F.explode("matches").alias("b"))
    return pairs.filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id, the smallest doc_id reachable by links."""
    prints = write_through(fingerprints(docs.select("doc_id", "text"), width=width).drop("text"), "simhash-prints")
    return prints.join(classes(prints, max_bits), "fingerprint").select("doc_id", "fingerprint", "component_id")


def classes(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fingerprint, root, component_id) for each distinct fingerprint of (doc_id, fingerprint) rows."""
    nodes = write_through(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = connected(links(nodes, max_bits), "simhash-links")
    joined = nodes.join(roots, nodes.fingerprint == roots.node, "left")
    joined = joined.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(named, "root").select("fingerprint", "root", "component_id")


def one_of_each(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each component with its columns: the one with the smallest doc_id (null last), the first of equal ones."""
    own, number = unused(docs, "_fingerprint", "_row")
    prints = fingerprints(docs, width=width, out=own).withColumn(number, F.monotonically_increasing_id())
    prints = write_through(prints, "simhash-docs")
    keys = prints.select(F.col(own).alias("fingerprint"), "doc_id", F.struct(order_id().alias("id"), F.col(number).alias("row")).alias("first"))
    firsts = keys.groupBy("fingerprint").agg(F.min("first").alias("first"))
    found = firsts.join(classes(keys.select("fingerprint", "doc_id"), max_bits), "fingerprint")
    kept = found.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(number))
    return prints.join(kept, number, "left_semi").select(*docs.columns)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
