"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base spans are the matches of a pattern per kind that pass its check; they are the seed entities. The words around an
instance are its lexical patterns: a label before it (a word and one of ``:=#``) or, without one, the two words before
it and the word on each side; and the one word before it. Candidates have a shape and
may become the kinds of that shape: tokens joined by @, (at) or dots an email, groups of hexadecimal digits joined by
colons an ip, groups of digits joined by spaces, brackets, dots or hyphens all but an email, other tokens with a digit
any kind. They touch no base span, and the longest counts where one lies in another. Nothing but the
scores rejects them. The graph of patterns and instances is scored in ROUNDS rounds by kind: a pattern is as sure as
the mean score of the instances that may be of the kind (seeds 1, others what the round before gave, by the share of
their own patterns, the one-word ones or the others, that speak for the kind, so that a number common everywhere
teaches little), if SUPPORT different instances hold it up, or LONE for a single word; an instance is as sure as one of its patterns being right, where those under EVEN do not
speak. Candidates at SURE or more, in a pattern at SURE or more, become spans of that kind.

Matching is one pass over the texts; after it a row of a small table holds a document's matches, and all else works on
these. Offsets are running sums of the lengths of gaps and matches, in code points. The patterns are written so
that no long run of characters is read again from each of its positions, nor needs a deep stack.

Null texts are empty; a text without matches has no spans. Rows may repeat and ids may be null, each row is its own.
An empty table gives an empty result. Columns but doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import table, write_through

#: The kinds, in order, and what each looks like (possessive, where giving back could not help).
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: What candidates look like, by shape, and the kinds (by number) that a shape may become.
MAIL = r"(?<![\p{L}\p{N}_%+@.-])[\p{L}\p{N}_%+-]++(?:(?:[.@]|\x20?[(\[](?i:at|dot)[)\]]\x20?)[\p{L}\p{N}_%+-]++)++"
HEX = r"(?<![\p{L}0-9:.])[0-9A-Fa-f]*+(?::[0-9A-Fa-f]*+){2,}+"
NUMBER = r"(?<![\p{L}0-9_%@:])\+?+\(?+[0-9]++(?:(?:[()]\x20?[(-]?|\x20-\x20|\x20?\(|[\x20.-])[0-9]++)*+"
TOKEN = r"(?<![A-Za-z0-9._%+@-])[A-Za-z._%+@-]*+[0-9][A-Za-z0-9._%+@-]*+"
SHAPES = {"mail": (MAIL, (0,)), "hex": (HEX, (1,)), "number": (NUMBER, (1, 2, 3)), "token": (TOKEN, (0, 1, 2, 3))}

#: Characters of context, instances behind a pattern and one of a single word, rounds, and the scores to be sure and to speak at all.
CONTEXT, SUPPORT, LONE, ROUNDS, SURE, EVEN = 48, 3, 20, 3, 0.9, 0.5

#: A word that labels what follows.
LABEL = r"([\p{L}]+)\s*[:=#]\s*$"


def _hits(text: Column, pattern: str) -> Column:
    """All matches in order, each with the length of the gap before it and the characters on both sides."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)

    def last(part: Column) -> Column:
        return F.substring(F.coalesce(part, F.lit("")), -CONTEXT, CONTEXT)

    def first(part: Column) -> Column:
        return F.substring(F.coalesce(part, F.lit("")), 1, CONTEXT)

    # contexts go across the neighbouring match, so that they do not depend on how many matches a pattern has;
    # the lambda sees its own element alone, or it would match again for each
    none = F.array(F.lit(""))
    parts = {"gap": gaps, "match": found, "gap_before": F.concat(none, gaps), "before": F.concat(none, found), "gap_after": F.slice(gaps, 2, 1 << 30)}
    each = F.transform(
        F.arrays_zip(*[c.alias(n) for n, c in parts.items()]),
        lambda z: F.struct(
            F.length(z["gap"]).alias("gap"),
            last(F.concat(last(z["gap_before"]), last(z["before"]), last(z["gap"]))).alias("left"),
            first(F.concat(first(z["gap"]), first(z["match"]), first(z["gap_after"]))).alias("head"),
            z["match"].alias("match"),
        ),
    )
    empty = F.array().cast("array<struct<gap:int,left:string,head:string,match:string>>")
    return F.when(text.rlike(pattern), each).otherwise(empty)


def matches(docs: DataFrame) -> DataFrame:
    """row, doc_id and one column of raw matches for each kind and shape; the only pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    looks = {**dict(zip(KINDS, (EMAIL, IP, CARD, PHONE))), **{k: p for k, (p, _) in SHAPES.items()}}
    columns = [_hits(text, p).alias(k) for k, p in looks.items()]
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *columns)
    return write_through(found, "pii-matches")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True for a number whose Luhn sum ends in 0."""
    backwards = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    count = F.length(_digits(match))
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p).cast("int") <= 255))
    if kind == "card":
        return F.when(count.between(14, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return count.between(10, 15)
    if kind == "mail":
        return match.rlike(r"\p{L}")
    if kind == "hex":
        return match.rlike("[0-9A-Fa-f]")
    return F.lit(True)


def spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, match, before, after): valid matches; kind is a number, shapes after kinds."""
    every = None
    for number, kind in enumerate((*KINDS, *SHAPES)):
        hits = found.filter(F.size(kind) > 0).select("row", F.posexplode(kind).alias("i", "hit"))
        hits = hits.select("row", "i", "hit.*").withColumn("size", F.length(F.coalesce("match", F.lit(""))))
        upto = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hits = hits.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(upto))
        hits = hits.withColumn("tail", F.lead("head").over(Window.partitionBy("row").orderBy("i")))
        hits = hits.filter(F.col("match").isNotNull())
        hits = hits.withColumn("start", F.col("end") - F.col("size"))
        if kind in ("hex", "number"):
            hits = hits.filter(~F.coalesce("tail", F.lit("")).rlike(r"^[\p{L}\p{N}_@]"))
        if kind == "number":
            lone = F.when(F.col("match").contains(")"), F.lit("")).otherwise(F.regexp_extract("match", r"^\+?\(", 0))
            hits = hits.withColumn("_lone", F.length(lone)).withColumn("start", F.col("start") + F.col("_lone"))
            hits = hits.withColumn("match", F.when(F.col("_lone") > 0, F.regexp_replace("match", r"^\+?\(", "")).otherwise(F.col("match")))
        if kind in ("mail", "token"):
            hits = hits.withColumn("match", F.regexp_replace("match", "[._%+@-]+$", ""))
            hits = hits.withColumn("end", F.col("start") + F.length("match"))
        hits = hits.filter(_valid(kind, F.col("match")))
        one = hits.select("row", F.lit(number).alias("kind"), "start", "end", "match", F.col("left").alias("before"), F.col("tail").alias("after"))
        every = one if every is None else every.union(one)
    return every


def apart(every: DataFrame) -> DataFrame:
    """The spans, ``kinds`` each may be, without candidates that touch a base span or lie in a longer one."""
    may = F.array(*[F.array(*[F.lit(k) for k in ks]) for ks in [*[(n,) for n in range(len(KINDS))], *[k for _, k in SHAPES.values()]]])
    base = F.col("kind") < len(KINDS)
    order = Window.partitionBy("row").orderBy("start", "kind")
    earlier = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # from the end, as a frame that runs to the end is counted anew for each row
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    later = F.min(F.when(base, F.col("start"))).over(back)
    free = (F.coalesce(earlier, F.lit(0)) <= F.col("start")) & (F.coalesce(later, F.col("end")) >= F.col("end"))
    every = every.withColumn("_free", base | free).filter("_free").drop("_free")
    # one candidate for each place, of all kinds that a shape there allows
    every = every.withColumn("kinds", F.get(may, F.col("kind"))).withColumn("kind", F.least("kind", F.lit(len(KINDS))))
    place = ["row", "start", "end", "kind"]
    rest = [F.first(c).alias(c) for c in ("match", "before", "after")]
    every = every.groupBy(*place).agg(*rest, F.array_distinct(F.flatten(F.collect_list("kinds"))).alias("kinds"))
    wide = Window.partitionBy("row", F.col("kind") < len(KINDS)).orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.max("end").over(wide) >= F.col("end"), F.lit(False))
    return every.withColumn("_inside", inside).filter((F.col("kind") < len(KINDS)) | ~F.col("_inside")).drop("_inside")


def patterns(every: DataFrame) -> DataFrame:
    """The spans with ``pattern``: one row for each lexical pattern that a span stands in."""
    before = F.slice(F.reverse(F.regexp_extract_all(F.lower("before"), F.lit(r"[\p{L}]+"), 0)), 1, 2)
    after = F.slice(F.regexp_extract_all(F.lower(F.coalesce("after", F.lit(""))), F.lit(r"[\p{L}]+"), 0), 1, 1)
    two = F.when(F.size("_b") == 2, F.concat(F.lit("2 "), F.array_join("_b", " ")))
    both = F.when((F.size("_b") > 0) & (F.size("_a") > 0), F.concat_ws(" ", F.lit("1"), F.col("_b")[0], F.lit("_"), F.col("_a")[0]))
    one = F.when(F.size("_b") > 0, F.concat(F.lit("0 "), F.col("_b")[0]))
    label = F.nullif(F.regexp_extract(F.lower("before"), LABEL, 1), F.lit(""))
    named = F.array(F.concat(F.lit("L "), F.col("_label")), one)
    every = every.withColumn("_b", before).withColumn("_a", after).withColumn("_label", label)
    some = F.when(F.col("_label").isNotNull(), named).otherwise(F.array(two, both, one))
    return every.withColumn("pattern", F.explode(F.array_compact(some))).drop("_b", "_a", "_label", "before", "after")


def bootstrap(worded: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, sure) and (match, kind, sure) of the last round, for sure patterns and unseen instances."""
    edges = worded.select("pattern", "match", F.explode("kinds").alias("kind"), (F.col("kind") < len(KINDS)).alias("base"))
    edges = write_through(edges.distinct(), "pii-edges")
    seeds = edges.filter("base").select("pattern", "match", "kind").withColumn("score", F.lit(1.0))
    open_ = edges.filter("not base").select("pattern", "match", "kind")
    # what speaks against a kind in a pattern: base instances of other kinds, and candidates that may be of it
    other = seeds.groupBy("pattern").agg(F.countDistinct("match").alias("known"))
    asked = open_.groupBy("pattern", "kind").agg(F.count("*").alias("asked"))
    lone = F.col("pattern").startswith("0 ")
    places = open_.groupBy("match", "kind").agg(F.count_if(lone).alias("lone_places"), F.count_if(~lone).alias("places"))
    scores = seeds
    for turn in range(rounds):
        held = scores.groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.count("*").alias("support"))
        rated = held.filter(F.col("support") >= F.when(lone, LONE).otherwise(SUPPORT)).join(other, "pattern", "left").join(asked, ["pattern", "kind"], "left")
        degree = F.coalesce("known", F.lit(0)) + F.coalesce("asked", F.lit(0))
        rated = rated.select("pattern", "kind", F.least(F.col("mass") / degree, F.lit(0.99)).alias("sure"))
        rated = write_through(rated, f"pii-patterns-{turn}")
        doubt = F.exp(F.sum(F.log1p(-F.col("sure"))))
        unseen = open_.join(rated.filter(F.col("sure") >= EVEN), ["pattern", "kind"]).groupBy("match", "kind")
        unseen = unseen.agg((1 - doubt).alias("sure"), F.count_if(lone).alias("lone_spoken"), F.count_if(~lone).alias("spoken"))
        unseen = write_through(unseen.join(places, ["match", "kind"]), f"pii-instances-{turn}")
        shares = [F.coalesce(F.try_divide(a, b), F.lit(0.0)) for a, b in ((F.col("spoken"), F.col("places")), (F.col("lone_spoken"), F.col("lone_places")))]
        taught = (F.col("sure") * F.greatest(*shares)).alias("score")
        more = open_.join(unseen, ["match", "kind"]).select("pattern", "match", "kind", taught)
        scores = seeds.unionByName(more)
    return rated.filter(F.col("sure") >= SURE), unseen.filter(F.col("sure") >= SURE)


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, and ``spans``, structs of start, kind (a number), end and base, in order."""
    found = matches(docs)
    every = write_through(apart(spans(found)), "pii-spans")
    worded = write_through(patterns(every), "pii-patterns")
    sure, unseen = bootstrap(worded)
    learnt = worded.filter(F.col("kind") == len(KINDS)).select("row", "start", "end", "match", "pattern", F.explode("kinds").alias("kind"))
    learnt = learnt.join(sure.select("pattern", "kind"), ["pattern", "kind"])
    learnt = learnt.join(unseen.select("match", "kind", "sure"), ["match", "kind"])
    learnt = learnt.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("sure", -F.col("kind"))).alias("kind"))
    base = every.filter(F.col("kind") < len(KINDS)).select("row", "start", "kind", "end", F.lit(True).alias("base"))
    whole = base.unionByName(learnt.withColumn("base", F.lit(False)))
    held = whole.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,base:boolean>>")
    return found.select("row", "doc_id").join(held, "row", "left").withColumn("spans", F.coalesce("spans", none))


def _listed(held: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(held, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of base spans by kind, the digest of base spans, and all spans, of every document."""
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(kinds) - F.size(F.array_remove(kinds, n)) for n in range(len(KINDS))]
    counts = [c.cast("long").alias(f"n_{k}") for c, k in zip(counts, KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
