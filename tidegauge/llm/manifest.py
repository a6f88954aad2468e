"""Merkle manifest of a table, its leaves placed by bitmap ranks.

A row's leaf is a digest of its fields. Leaves of a group (a language) ascend by doc_id; their places are not found
by sorting rows: the doc_ids of a group make a bitmap of 64-bit words, partial words are merged by ``bit_or``, words
without a bit are not stored, and a popcount directory (totals of 4,096 words, of 4,096 such blocks, and so on) gives
each word the number of leaves before it. A row's place is that number and the bits below its own in its word. Places
are the keys of slot arrays: FAN ** RISE slots are reduced by as many levels in one small group, their digests are
the slots of the next arrays, until a group has one digest, its subroot; subroots are reduced to the root likewise.
Going back down, each array hands its slots the siblings beside and above them: a leaf's proof.

Every row is a leaf, repeated ones too. Rows that share a doc_id (or have none; they come last) ascend by leaf digest;
they are counted in ranges, so that one id may hold any share of the rows. A null field is the digest's ``-``, an
empty text ``0:``. A null language is a group of its own, before the others. Languages ascend by their UTF-8 bytes.
An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import binned, running_sum, table, write_through

#: Children of a node, and the levels that one slot array is reduced by.
FAN, RISE = 8, 3
PAGE = FAN**RISE

#: Fixed value: the fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: An entry of the popcount directory sums up 2 ** BLOCK entries below it.
BLOCK = 12

_NODE = "grp string, at long, total long, digest string"
_PATH = "grp string, at long, path array<struct<left:string,right:string>>, subroot string, root string"
_PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as its length in bytes, a colon and its value, or ``-``."""
    texts = [f.cast("string") for f in fields]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told), 256)


def leaves(docs: DataFrame, tampered: Column, group: str = "lang") -> DataFrame:
    """(grp, doc_id, digest, other, row) of each row; ``other`` is the leaf of the row with ``tampered`` as its text."""
    fields = [F.col(name) for name in FIELDS]
    # "" stands for the null group and sorts before all others
    grp = F.coalesce(F.concat(F.lit("+"), F.col(group)), F.lit(""))
    rows = docs.select(
        grp.alias("grp"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(fields).alias("digest"),
        leaf([*fields[:-1], tampered]).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    return write_through(rows, "manifest-leaves")


def _before(nodes: DataFrame, span: int) -> DataFrame:
    """(grp, at, n) with ``before``: the sum of ``n`` over the smaller addresses of the group; they reach up to ``span``.

    No window holds more than 2 ** BLOCK rows, however many a group has.
    """
    inside = Window.partitionBy("grp", "_block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("_block", F.shiftright("at", BLOCK))
    counted = nodes.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    if span >> BLOCK == 0:
        return counted.drop("_block")
    blocks = nodes.groupBy("grp", F.col("_block").alias("at")).agg(F.sum("n").alias("n"))
    above = _before(blocks, span >> BLOCK).select("grp", F.col("at").alias("_block"), F.col("before").alias("_above"))
    summed = counted.join(above, ["grp", "_block"]).withColumn("before", F.col("before") + F.col("_above"))
    return summed.drop("_block", "_above")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, doc_id, digest, row, ...) with ``at``, the place in the group, and ``total``, the group's rows."""
    word = F.shiftright("doc_id", 6)
    ends = rows.agg(F.min(word).alias("lo"), F.max(word).alias("hi")).first()
    lo, hi = (ends.lo, ends.hi) if ends.lo is not None else (0, 0)
    rows = rows.withColumn("_word", F.coalesce(word - lo, F.lit(hi - lo + 1)))
    rows = rows.withColumn("_bit", F.coalesce(F.col("doc_id").bitwiseAND(63), F.lit(0)).cast("int"))
    own = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    words = rows.groupBy("grp", F.col("_word").alias("at")).agg(F.bit_or(own).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = write_through(words, "manifest-words")
    totals = words.groupBy("grp").agg(F.sum("n").alias("total"))
    ranks = _before(words, hi - lo + 1).withColumn("_shared", F.col("n") > F.bit_count("bits"))
    ranks = ranks.select("grp", F.col("at").alias("_word"), "bits", "before", "_shared").join(totals, "grp")
    found = rows.join(ranks, ["grp", "_word"])
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("_bit")))
    at = F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below))
    kept = [c for c in rows.columns if c not in ("_word", "_bit")]
    out = found.filter(~F.col("_shared")).select(*kept, at.alias("at"), "total")
    if words.filter(F.col("n") > F.bit_count("bits")).isEmpty():
        return out
    # words in which ids repeat: the rows of such a word are counted one by one, in ranges
    shared = found.filter("_shared").withColumn("_one", F.lit(1).cast("long"))
    order = ["_bit", "digest", "row"]
    ranged = binned(shared, ["grp", "_word", *order], "manifest-shared")
    counted = running_sum(ranged, ["grp", "_word"], "_bin", [F.col(c) for c in order], "_one", "_inside")
    return out.unionByName(counted.select(*kept, (F.col("before") + F.col("_inside")).alias("at"), "total"))


def reduced(slots: list[str], total: int) -> list[list[str]]:
    """The slots and the digests of the levels above them, while the group has more than one node."""
    levels = [slots]
    while total > 1 and len(levels) <= RISE:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
        total = -(-total // FAN)
    return levels


def _slots(rows: pa.Table) -> tuple[int, list[str], list[int]]:
    """The group's total, the digests in their slots, and the row of each slot."""
    at = rows.column("at").to_pylist()
    digests = rows.column("digest").to_pylist()
    slots, source = [""] * len(at), [0] * len(at)
    for row, place in enumerate(at):
        slots[place % PAGE], source[place % PAGE] = digests[row], row
    return rows.column("total")[0].as_py(), slots, source


def _page() -> Column:
    return F.expr(f"at div {PAGE}").alias("page")


def rise(nodes: DataFrame) -> DataFrame:
    """The nodes RISE levels up, or the one node of a group that ends before."""

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        total, slots, _ = _slots(rows)
        levels = reduced(slots, total)
        for _ in range(RISE):
            total = max(1, -(-total // FAN))
        return pa.table({"grp": [key[0].as_py()], "at": [key[1].as_py()], "total": [total], "digest": levels[-1]})

    return nodes.select("grp", "at", "total", "digest").groupBy("grp", _page()).applyInArrow(work, _NODE)


def risen(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the tables of nodes above them; the last has one node for each group."""
    levels = [nodes]
    while len(levels) == 1 or levels[-1].filter("total > 1").limit(1).count():
        levels.append(write_through(rise(levels[-1]), "manifest-nodes"))
    return levels


def _beside(levels: list[list[str]], slot: int) -> list[dict[str, str]]:
    """The siblings of a slot and of the nodes above it, left and right, within its array."""
    out = []
    for level in levels[:-1]:
        first = slot // FAN * FAN
        out.append({"left": "".join(level[first:slot]), "right": "".join(level[slot + 1 : first + FAN])})
        slot //= FAN
    return out


def fall(nodes: DataFrame, paths: DataFrame, last: bool) -> DataFrame:
    """The path of every node below the nodes of ``paths``; of leaves (``last``) what the path proves."""

    def work(rows: pa.Table, above: pa.Table) -> pa.Table:
        total, slots, source = _slots(rows)
        levels = reduced(slots, total)
        top = above.to_pylist()[0]
        if not last:
            path = [_beside(levels, slot) + top["path"] for slot in range(len(slots))]
            at = rows.column("at").take(pa.array(source))
            same = {name: [top[name]] * len(slots) for name in ("grp", "subroot", "root")}
            made = pa.table({"grp": same["grp"], "at": at, "path": path, "subroot": same["subroot"], "root": same["root"]})
            return made.cast(_paths)
        others = rows.column("other").to_pylist()
        proofs, folds = [], []
        for slot, row in enumerate(source):
            path = _beside(levels, slot) + top["path"]
            proofs.append(digest("".join(step["left"] + step["right"] for step in path)))
            node = others[row]
            for step in path:
                node = _folded(step, node)
            folds.append(node)
        return pa.table(
            {
                "doc_id": rows.column("doc_id").take(pa.array(source)),
                "leaf": slots,
                "subroot": [top["subroot"]] * len(slots),
                "root": [top["root"]] * len(slots),
                "proof_sha256": proofs,
                "folded_root": folds,
                "verified": [fold == top["root"] for fold in folds],
            }
        )

    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    _paths = pa.schema(
        [("grp", pa.string()), ("at", pa.int64()), ("path", pa.list_(step)), ("subroot", pa.string()), ("root", pa.string())]
    )
    above = paths.withColumn("page", F.col("at")).groupBy("grp", "page")
    below = nodes.withColumn("page", _page()).groupBy("grp", "page")
    return below.cogroup(above).applyInArrow(work, _PROVED if last else _PATH)


def _folded(step: dict[str, str], node: str) -> str:
    return digest(step["left"] + node + step["right"])


def manifest(rows: DataFrame) -> DataFrame:
    """``leaves`` with their subroot, the root, the digest of their proof and the root folded from ``other``."""
    spark = rows.sparkSession
    groups = risen(write_through(placed(rows), "manifest-placed"))
    subroots = groups[-1].select("grp", "digest").withColumn("_one", F.lit(1).cast("long")).withColumn("_tree", F.lit(""))
    ranked = running_sum(binned(subroots, ["grp"], "manifest-subroots"), ["_tree"], "_bin", [F.col("grp")], "_one", "at")
    total = F.lit(subroots.count()).cast("long")
    ranked = ranked.select(F.col("_tree").alias("grp"), "at", total.alias("total"), "digest", F.col("grp").alias("name"))
    ranked = write_through(ranked, "manifest-ranked")
    tops = risen(ranked.drop("name"))
    nothing = F.from_json(F.lit("[]"), "array<struct<left:string,right:string>>")
    paths = tops[-1].select("grp", "at", nothing.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(tops[:-1]):
        paths = write_through(fall(nodes, paths, False), "manifest-paths")
    first = F.lit(0).cast("long").alias("at")
    paths = ranked.select("at", "name", "digest").join(paths.select("at", "path", "root"), "at")
    paths = paths.select(F.col("name").alias("grp"), first, "path", F.col("digest").alias("subroot"), "root")
    for nodes in reversed(groups[1:-1]):
        paths = write_through(fall(nodes, paths, False), "manifest-paths")
    return fall(groups[0], paths, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _sql() -> str:
    """The manifest in DuckDB: levels by recursion, and CRC-32 bit by bit (its fixed value is the reflected polynomial)."""

    def fields(text: str) -> str:
        named = [*FIELDS[:-1], text]
        return " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(CAST({f} AS VARCHAR)) || ':' || {f} END" for f in named)

    def tree(name: str, start: str) -> str:
        return f"""{name}(grp, lvl, pos, total, h) AS (SELECT {start}
  UNION ALL SELECT grp, lvl + 1, pos // {FAN}, (total + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY pos)) FROM {name}
  WHERE total > 1 GROUP BY grp, lvl, total, pos // {FAN})"""

    def beside(name: str, tier: int) -> str:
        run = f"PARTITION BY grp, lvl, pos // {FAN} ORDER BY pos ROWS BETWEEN"
        return f"""SELECT {tier} + lvl AS lvl, grp, pos, coalesce(string_agg(h, '') OVER before, '') AS l, coalesce(string_agg(h, '') OVER after, '') AS r
  FROM {name} WHERE total > 1 WINDOW before AS ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), after AS ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""

    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    crc = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, unused: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
    return f"""WITH RECURSIVE leaves AS (SELECT doc_id, lang, coalesce('+' || lang, '') AS grp, sha256({fields("text")}) AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN sha256({fields(lower)}) END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY grp) AS total FROM leaves),
{tree("tree", "grp, 0, pos, total, leaf FROM placed")},
subroots AS (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS total FROM tree WHERE total = 1),
{tree("top", "'' AS grp, 0, pos, total, h FROM subroots")},
beside AS ({beside("tree", 0)}), above AS ({beside("top", 1000)}),
steps AS (SELECT id, lvl, l, r FROM placed p JOIN beside b ON b.grp = p.grp AND b.pos = CAST(floor(p.pos / power({FAN}, lvl)) AS BIGINT)
  UNION ALL SELECT id, lvl, l, r FROM placed p JOIN subroots s ON s.grp = p.grp
  JOIN above a ON a.pos = CAST(floor(s.pos / power({FAN}, lvl - 1000)) AS BIGINT)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY lvl) AS k FROM steps),
proofs AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY k)) AS proof FROM numbered GROUP BY id),
fold(id, k, h) AS (SELECT id, 0, coalesce(changed, leaf) FROM placed
  UNION ALL SELECT f.id, f.k + 1, sha256(l || h || r) FROM fold f JOIN numbered n ON n.id = f.id AND n.k = f.k + 1),
folded AS (SELECT id, arg_max(h, k) AS h FROM fold GROUP BY id)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed p JOIN subroots s ON s.grp = p.grp JOIN top t ON t.total = 1 JOIN folded f ON f.id = p.id LEFT JOIN proofs q ON q.id = p.id"""


#: What ``op12_merkle_manifest`` gives.
ORACLE_SQL = _sql()


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and what folding shows where A-Z of every third text were lower-cased."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(chosen, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return manifest(leaves(table(spark, sf_dir, "documents"), tampered))
