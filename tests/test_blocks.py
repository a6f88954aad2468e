import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.operators import blocks
from tidegauge.operators.blocks import BLOCK, OWN, POS, ordered_blocks


def skewed(spark):
    """One key holds a third of the rows, most of them in a burst; others are spread or tiny."""
    rng = random.Random(7)
    rows = []
    for i in range(9000):
        if i % 3 == 0:
            # a far outlier, then nearly everything within a short stretch
            at = 10**15 if i == 0 else (rng.randrange(50) if rng.random() < 0.8 else rng.randrange(10**12))
            rows.append(("hot", at, i))
        else:
            rows.append((f"k{rng.randrange(6) if i % 2 else 100 + i}", rng.randrange(10**6), i))
    rows += [("instant", 5, 100_000 + i) for i in range(2000)]
    return spark.createDataFrame(rows, "k string, t long, seq long")


def check(df, keys, order, **options):
    placed = ordered_blocks(df, keys, order, **options)
    own = placed.where(OWN)
    want = df.withColumn("want", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    joined = want.join(own.select("seq", POS, BLOCK), "seq", "full")
    assert joined.where(f"want IS NULL OR {POS} IS NULL OR want <> {POS}").count() == 0
    assert own.count() == df.count()
    return placed


@pytest.mark.parametrize("order", [["t", "seq"], ["seq"]])
def test_positions_and_block_sizes(spark, order):
    df = skewed(spark).cache()
    placed = check(df, ["k"], order, block_rows=200, align=50)
    sizes = placed.groupBy("k", BLOCK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 200
    assert placed.where("k = 'hot'").select(BLOCK).distinct().count() == 15
    assert placed.where("k = 'instant'").select(BLOCK).distinct().count() == 10


def test_halo_holds_the_rows_before_each_block(spark):
    df = skewed(spark).cache()
    placed = check(df, ["k"], ["t", "seq"], block_rows=200, align=50, halo=30).cache()
    begin = F.col(BLOCK) * 200
    assert placed.where(~F.col(OWN)).where(f"{POS} < {BLOCK} * 200 - 30 OR {POS} >= {BLOCK} * 200").count() == 0
    hot = placed.where("k = 'hot'").groupBy(BLOCK).agg(F.min(POS).alias("lo"), F.count("*").alias("n"))
    later = hot.where(f"{BLOCK} > 0")
    assert later.where(F.col("lo") != begin - 30).count() == 0
    assert later.where(f"{BLOCK} < 14 AND n <> 230").count() == 0


def test_start_position_moves_the_blocks(spark):
    df = skewed(spark).withColumn("from", F.when(F.col("k") == "hot", 130).otherwise(F.lit(7)).cast("long"))
    placed = ordered_blocks(df, ["k"], ["seq"], block_rows=200, align=100, start="from")
    hot = placed.where("k = 'hot'").agg(F.min(POS), F.max(POS), F.count("*"), F.sum(F.when(F.col(OWN), 1))).first()
    assert tuple(hot) == (130, 3129, 3000, 3000)
    assert placed.where(f"k = 'hot' AND {POS} div 200 <> {BLOCK}").count() == 0


def test_without_broadcasts_the_rows_are_the_same(spark, monkeypatch):
    """Lookups above their limit are joined by shuffle."""
    monkeypatch.setattr(blocks.F, "broadcast", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(skewed(spark).cache(), ["k"], ["t", "seq"], block_rows=300)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_block_size_grows_with_the_data_to_bound_the_lookups(spark):
    df = skewed(spark).cache()
    placed = ordered_blocks(df, ["k"], ["seq"], block_rows=100, lookup_rows=160)
    # 11,000 rows: blocks of at least 16 * 11000 / 160 = 1100 rows
    assert placed.where("k = 'hot'").select(BLOCK).distinct().count() == 3


def test_small_data_is_one_block_per_key(spark):
    df = skewed(spark).cache()
    placed = check(df, ["k"], ["t", "seq"])
    assert placed.where(f"{BLOCK} <> 0 OR NOT {OWN}").count() == 0


def test_timestamps_order_and_other_types_are_refused(spark):
    df = skewed(spark).withColumn("at", F.timestamp_millis("t")).where("t < 10000000000000").cache()
    check(df, ["k"], ["at", "seq"], block_rows=200)
    with pytest.raises(TypeError):
        ordered_blocks(df.withColumn("at", F.col("t").cast("double")), ["k"], ["at"], block_rows=10).count()


def test_tasks_follow_the_rows_and_not_the_blocks(spark):
    """400 blocks of 5 rows, or as many keys, are no reason for 400 tasks."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(2000).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"))
    placed = check(rows, ["k"], ["seq"], block_rows=5, halo=1)
    assert placed.select("k", BLOCK).distinct().count() == 400
    assert placed.rdd.getNumPartitions() <= most
    tiny = rows.withColumn("k", F.expr("seq div 5"))
    assert check(tiny, ["k"], ["seq"], block_rows=5).rdd.getNumPartitions() <= most


def test_many_rows_without_an_order_are_cut_by_their_hash(spark):
    """Hashes are further apart than a long can tell."""
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, NULL, 'k') AS k", "if(id % 2 = 0, id, NULL) AS place", "id AS seq").cache()
    placed = ordered_blocks(rows, ["k"], ["place"], block_rows=200, halo=10).cache()
    assert placed.groupBy("k", BLOCK).count().agg(F.max("count")).first()[0] <= 210
    own = placed.where(OWN).collect()
    assert sorted(r.seq for r in own) == list(range(3000))
    for key, n in ((None, 1000), ("k", 2000)):
        some = sorted((r for r in own if r.k == key), key=lambda r: r[POS])
        assert [r[POS] for r in some] == list(range(n))
        assert all(r.place is None for r in some[: n // 2])
        assert [r.place for r in some[n // 2 :]] == sorted(r.seq for r in some if r.seq % 2 == 0)


def test_orders_from_end_to_end_of_a_long(spark):
    lowest, highest = -(1 << 63), (1 << 63) - 1
    at = [lowest, lowest + 1, -1, 0, 1, highest - 1, highest]
    at += [lowest + i * ((1 << 64) // 1000) for i in range(1, 1000)] + [highest - i for i in range(2, 700)]
    df = spark.createDataFrame([("k", t, i) for i, t in enumerate(at)], "k string, t long, seq long").cache()
    placed = check(df, ["k"], ["t", "seq"], block_rows=100)
    assert placed.groupBy(BLOCK).count().agg(F.max("count")).first()[0] <= 100
