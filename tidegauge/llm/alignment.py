"""Alignment of two tokenizers' tokens by interval coalescing.

Tokens are byte ranges of one text. All tokens of A and B are sorted by start; the running maximum of their ends tells
how far the tokens so far reach, and where a start reaches it a new group begins: the finest pieces that both
tokenizers cut out whole. Within a group the overlaps are expanded; overlapping tokens that end together are linked.

A text has a space put before it (B's file does so by itself) and is cut where a space follows a character that is
none: neither tokenizer joins bytes over such a place, so a worker aligns each different piece once and puts texts
together from their pieces. A text with a piece whose tokens do not give its bytes back is encoded whole, and has no
tokens if it still differs. Ids linked with each other are counted over the corpus: each document carries its
different id pairs, the counts are a shuffle of partial sums, and come back by a join on the pair.

Null and empty texts have no tokens: zeros and an empty digest. Every row gets its answer, repeated ids too; a text
may have any length. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm.common import table, write_through
from tidegauge.llm.vocab import public
from tidegauge.llm.words import ragged, slices, text_bytes

#: Different pieces, and bytes of them, that a worker remembers before it starts anew.
REMEMBERED, REMEMBERED_BYTES = 600_000, 32 << 20

_ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups {}, pairs array<long>, times array<long>"


class ByteLevel:
    """Byte-level tokens of a ``.json`` file; special tokens inside texts are plain text."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        spelled = _byte_spelling()
        names = {i: t for t, i in self.library.get_vocab(with_added_tokens=False).items()}
        size = max(names) + 1
        self.bytes = [bytes(spelled[c] for c in names[i]) if i in names else b"" for i in range(size)]

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]


class Pieces:
    """Sentencepiece tokens of a ``.model`` file that puts a space before each text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        is_byte = [self.library.is_byte(i) for i in range(len(names))]
        self.bytes = [bytes([int(n[1:-1], 16)]) if b else n.replace("▁", " ").encode() for n, b in zip(names, is_byte)]
        self.space = [self.library.piece_to_id("▁")]
        #: Whether a token may reach over the beginning of a run of spaces.
        self.joins = any(re.search("[^▁]▁", n) for n in names)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        found = self.library.encode([p[1:] for p in pieces], num_threads=1)
        return [self.space if p == " " else ids for p, ids in zip(pieces, found)]


def _byte_spelling() -> dict[str, int]:
    """Byte-level files spell a byte as the character of its code, or, where that does not show, as one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


def coalesced(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each interval, numbered in order: a group ends where a start reaches all ends before it."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order]) if len(order) else ends
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(breaks) - 1
    return out


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The positions (in a, in b) of all overlapping pairs of ascending, disjoint intervals (starts, ends)."""
    first = np.searchsorted(b[1], a[0], "right")
    count = np.maximum(np.searchsorted(b[0], a[1], "left") - first, 0)
    return np.repeat(np.arange(len(first)), count), ragged(first, count)


class _Ids:
    """Tokens of a vocabulary as arrays: their bytes, and their decimal ids with a comma."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        digits = [f"{i},".encode() for i in range(len(tokens))]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_lengths = np.array([len(d) for d in digits], np.int64)
        self.digit_starts = np.cumsum(self.digit_lengths) - self.digit_lengths


@dataclass
class Aligned:
    """What is known of a list of pieces; ``links`` and ``spelled`` are the parts of all pieces one after the other."""

    fine: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    n_spelled: np.ndarray
    links: np.ndarray
    spelled: np.ndarray

    def and_more(self, other: Aligned) -> Aligned:
        return Aligned(*[np.concatenate([getattr(self, f.name), getattr(other, f.name)]) for f in fields(self)])


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum())), counts


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each of consecutive runs of ``counts`` values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Aligner:
    """Two tokenizer files and the pieces aligned so far."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_ids, self.b_ids = _Ids(self.a.bytes), _Ids(self.b.bytes)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.bytes = 0
        self.known = self.align([])

    def align(self, pieces: list[str]) -> Aligned:
        """Each piece begins with a space."""
        texts = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        base = np.cumsum(sizes) - sizes
        sides, fine = [], np.ones(len(pieces), bool)
        for library, ids in ((self.a, self.a_ids), (self.b, self.b_ids)):
            flat, counts = _flat(library.encode(pieces) if pieces else [])
            fine &= (_sums(ids.lengths[flat], counts) == sizes) & (_sums(ids.lengths[flat] == 0, counts) == 0)
            sides.append((flat, counts))
        for (flat, counts), ids in zip(sides, (self.a_ids, self.b_ids)):
            kept = np.repeat(fine, counts)
            made = ids.data[ragged(ids.starts[flat[kept]], ids.lengths[flat[kept]])]
            same = made == data[ragged(base[fine], sizes[fine])]
            fine[fine] = _sums(~same, sizes[fine]) == 0
        ranges, owners = [], []
        for i, ids in ((0, self.a_ids), (1, self.b_ids)):
            flat, counts = sides[i]
            flat, counts = flat[np.repeat(fine, counts)], np.where(fine, counts, 0)
            lengths = ids.lengths[flat]
            # the pieces lie one behind the other, so that no range overlaps one of another piece
            own = np.repeat(np.cumsum(np.where(fine, sizes, 0)) - np.where(fine, sizes, 0), counts)
            within = np.cumsum(lengths) - lengths - np.repeat(np.cumsum(_sums(lengths, counts)) - _sums(lengths, counts), counts)
            ranges.append((own + within, own + within + lengths))
            owners.append(np.repeat(np.arange(len(pieces)), counts))
            sides[i] = (flat, counts)
        (a, n_a), (b, n_b) = sides
        group = coalesced(np.concatenate([ranges[0][0], ranges[1][0]]), np.concatenate([ranges[0][1], ranges[1][1]]))
        at_a, at_b = overlaps(*ranges)
        together = ranges[0][1][at_a] == ranges[1][1][at_b]
        at_a, at_b = at_a[together], at_b[together]
        last = np.flatnonzero(np.diff(group[: len(a)], append=-1))
        spelled, n_spelled = self._spelled(a, b, group, owners, len(pieces))
        return Aligned(
            fine, n_a, n_b,
            np.bincount(owners[0][last], minlength=len(pieces)).astype(np.int64),
            np.bincount(owners[0][at_a], minlength=len(pieces)).astype(np.int64),
            n_spelled, a[at_a] * len(self.b.bytes) + b[at_b], spelled,
        )

    def _spelled(self, a, b, group, owners, n) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;`` for each group, and the bytes of that for each piece."""
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((np.arange(len(group)), side, group))
        group, side, owner = group[order], side[order], np.concatenate(owners)[order]
        digits = np.concatenate([self.a_ids.digits, self.b_ids.digits])
        starts = np.concatenate([self.a_ids.digit_starts[a], len(self.a_ids.digits) + self.b_ids.digit_starts[b]])[order]
        lengths = np.concatenate([self.a_ids.digit_lengths[a], self.b_ids.digit_lengths[b]])[order]
        text = digits[ragged(starts, lengths)]
        ends = np.cumsum(lengths) - 1
        group_ends = np.ones(len(group), bool)
        group_ends[:-1] = group[1:] != group[:-1]
        side_ends = np.zeros(len(group), bool)
        side_ends[:-1] = (side[1:] != side[:-1]) & ~group_ends[:-1]
        text[ends[side_ends]] = ord("|")
        text[ends[group_ends]] = ord(";")
        return text, np.bincount(owner, lengths, minlength=n).astype(np.int64)

    def places_of(self, pieces: list[str]) -> np.ndarray:
        """The number under which each piece is remembered; new ones are aligned."""
        size = sum(map(len, pieces))
        if len(self.places) + len(pieces) > REMEMBERED or self.bytes + size > REMEMBERED_BYTES:
            self._forget()
        new = [p for p in pieces if p not in self.places]
        if new:
            self.known = self.known.and_more(self.align(new))
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.bytes += sum(map(len, new))
        return np.fromiter(map(self.places.__getitem__, pieces), np.int64, len(pieces))

    def texts(self, column: pa.Array) -> tuple[Aligned, np.ndarray]:
        """What is known of each text, and the pieces of links in ``Aligned.links`` (its text); texts without tokens are not ``fine``."""
        pieces, counts = cut(column, not self.b.joins)
        if len(pieces):
            pieces = pieces.dictionary_encode()
            at = self.places_of(pieces.dictionary.to_pylist())[pieces.indices.to_numpy(zero_copy_only=False)]
        else:
            at = np.empty(0, np.int64)
        known = self.known
        fine = _sums(~known.fine[at], counts) == 0
        odd = np.flatnonzero(~fine)
        at = at[np.repeat(fine, counts)]
        counts = np.where(fine, counts, 0)
        sums = {name: _sums(getattr(known, name)[at], counts) for name in ("n_a", "n_b", "n_groups", "n_links", "n_spelled")}
        links = known.links[ragged((np.cumsum(known.n_links) - known.n_links)[at], known.n_links[at])]
        spelled = known.spelled[ragged((np.cumsum(known.n_spelled) - known.n_spelled)[at], known.n_spelled[at])]
        out = Aligned(fine & (counts > 0), **sums, links=links, spelled=spelled)
        return self._with_whole(out, odd, column) if len(odd) else out

    def _with_whole(self, out: Aligned, odd: np.ndarray, column: pa.Array) -> Aligned:
        """The texts at ``odd`` aligned whole."""
        whole = self.align([" " + column[int(i)].as_py() for i in odd])
        out.fine[odd] = whole.fine
        for counts, parts in (("n_links", "links"), ("n_spelled", "spelled")):
            n = getattr(out, counts)
            # odd texts have no part yet: theirs go in where those of the texts after them begin
            at = np.repeat((np.cumsum(n) - n)[odd], getattr(whole, counts))
            setattr(out, parts, np.insert(getattr(out, parts), at, getattr(whole, parts)))
        for name in ("n_a", "n_b", "n_groups", "n_links", "n_spelled"):
            getattr(out, name)[odd] = getattr(whole, name)
        return out


def cut(column: pa.Array, apart: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The pieces of each text with a space before it, and their number for each text (none for empty texts).

    A piece begins where a space follows a character that is surely no space: ASCII, or of two bytes from U+00C0 on,
    or of three from U+4000 on. Not ``apart``: a text is one piece.
    """
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    some = sizes > 0
    sizes = np.where(some, sizes + 1, 0)
    ends = np.cumsum(sizes)
    begins = (ends - sizes)[some]
    spaced = np.full(int(sizes.sum()), 0x20, np.uint8)
    inside = np.ones(len(spaced), bool)
    inside[begins] = False
    spaced[inside] = data
    starts = np.zeros(len(spaced), bool)
    if apart and len(spaced):
        before = np.concatenate([[0], spaced[:-1]])
        two = np.concatenate([[0, 0], spaced[:-2]])[: len(spaced)]
        three = np.concatenate([[0, 0, 0], spaced[:-3]])[: len(spaced)]
        more = (before >= 0x80) & (before < 0xC0)
        sure = (before > 0x20) & (before < 0x7F) | more & (two >= 0xC3) & (two <= 0xDF)
        sure |= more & (two >= 0x80) & (two < 0xC0) & (three >= 0xE4) & (three <= 0xEF)
        starts = (spaced == 0x20) & sure
    starts[begins] = True
    at = np.flatnonzero(starts)
    bounds = np.append(at, len(spaced)).astype(np.int64)
    strings = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(spaced))
    return strings, np.searchsorted(at, ends) - np.searchsorted(at, ends - sizes)


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process."""
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", digest: bool = False) -> DataFrame:
    """One row per document: its token, group and link counts, its groups and its id pairs.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in decimal ids, or its SHA-256 (``digest``); ``pairs`` are the different
    linked pairs as a * (size of B) + b, ``times`` how often the document links each. ``row`` numbers the rows.
    """
    schema = _ALIGNED.format("string")
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_both = aligner(a_path, b_path)
        size = len(with_both.a.bytes) * len(with_both.b.bytes)
        for batch in batches:
            for part in slices(batch, "text"):
                found = with_both.texts(part.column(2))
                n = part.num_rows
                owner = np.repeat(np.arange(n), found.n_links)
                keys, times = np.unique(owner * size + found.links, return_counts=True)
                offsets = np.searchsorted(keys, np.arange(n + 1) * size).astype(np.int32)
                ends = np.cumsum(found.n_spelled)
                whole = memoryview(np.ascontiguousarray(found.spelled))
                spelled = [bytes(whole[e - k : e - 1]) if k else b"" for e, k in zip(ends.tolist(), found.n_spelled.tolist())]
                groups = [sha256(s).hexdigest() if s else "" for s in spelled] if digest else [s.decode() for s in spelled]
                counts = [found.n_a, found.n_b, found.n_groups, found.n_links]
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.int64))) for x in (keys % size, times)]
                arrays = [part.column(0), part.column(1), *[pa.array(c) for c in counts], pa.array(groups, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, schema)


def link_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best): how often the corpus links each pair, and whether that is the most of any pair with its B id.

    A window holds the pairs of one B id: A's vocabulary at most.
    """
    pairs = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    same = Window.partitionBy(F.col("pair") % b_size)
    return counts.withColumn("best", F.col("count") == F.max("count").over(same))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of tokens, groups and links of every document, its best links and its groups' digest."""
    paths = public("byte_bpe_50k.json"), public("piece_bpe_32k.model")
    aligned = write_through(align(table(spark, sf_dir, "documents"), *paths, digest=True), "alignment")
    counts = write_through(link_counts(aligned, len(aligner(*paths).b.bytes)), "alignment-counts")
    pairs = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    pairs = pairs.select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")).join(counts, "pair")
    best = F.when(F.col("best"), F.col("times")).otherwise(0)
    sums = pairs.groupBy("row").agg(F.sum(best).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    whole = aligned.drop("pairs", "times").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        F.col("groups").alias("groups_sha256"),
    )
