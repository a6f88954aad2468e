"""Toxicity, quality and decontamination on small hand-made tables."""

import itertools
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, quality, toxicity

DOCS = "doc_id long, text string, lang string, score string, severity string"
LABELS = "doc_id long, quality int, toxic int, text string"


def prose(seed, n=40):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["ta", "ri", "mo", "le", "ku", "sha"]) for _ in range(draw.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = [], []
    for i in range(240):
        words = prose(i).split()
        toxic, good = i % 4 == 0, i % 3 != 0
        if toxic:
            words[5] = words[11] = "Grobian,"
        text = " ".join(words if good else [w + "%%%" for w in words])
        rows.append((i, text, "x", "s", "v"))
        if i < 200:
            labels.append((i, int(good), int(toxic), "extra"))
    rows += [(900, None, None, None, None), (901, "", "", "", ""), (None, prose(3), None, None, None), (902, "grobian " + prose(77, 30000) + " grobian grobian", "", "", "")]
    rows.append(rows[0])
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(None, 1, 1, ""), (5, None, None, "")], LABELS)


def test_toxicity_catches_toxic_rows_and_leaves_others(corpus):
    docs, labels = corpus
    plain_docs = docs.select("doc_id", "text")
    model = toxicity.fit(plain_docs, labels)
    found = toxicity.score(plain_docs, model).collect()
    assert len(found) == docs.count()
    known = [r for r in found if r.doc_id is not None and r.doc_id < 240]
    wrong = [r.doc_id for r in known if r.toxic != (r.doc_id % 4 == 0)]
    assert len(wrong) <= 2
    assert not any(r.toxic for r in found if r.text in (None, ""))
    assert all(0 <= r.severity <= 2 for r in found)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.toxic for r in found)


def test_toxicity_on_held_out_rows(spark):
    """Rows with crc32 of the id mod 4 of 2 are not learnt from: what of them is caught at CUT, and what is called toxic wrongly.

    Measured: 105 of 120 toxic rows caught, 2 of 870 others called toxic.
    """
    folder = "/root/testdata/sf0.1"
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic in (0, 1)").select("doc_id", F.col("toxic").alias("marked"))
    model = toxicity.fit(docs, labels.filter(~held).withColumnRenamed("marked", "toxic"))
    found = toxicity.score(docs, model).join(labels.filter(held), "doc_id").groupBy("marked", "toxic").count().collect()
    counts = {(r.marked, r.toxic): r["count"] for r in found}
    caught, missed = counts.get((1, True), 0), counts.get((1, False), 0)
    wrong, left = counts.get((0, True), 0), counts.get((0, False), 0)
    print(f"held out: {caught} of {caught + missed} toxic rows caught, {wrong} of {wrong + left} others called toxic")
    assert caught + missed and caught / (caught + missed) >= 0.85
    assert wrong / (wrong + left) <= 0.02


def test_thresholds_are_ordered_and_weights_shared():
    draw = np.random.default_rng(1)
    value = draw.integers(0, 4, 600)
    rows = toxicity.Rows(np.ones(600, np.int64), np.zeros(600, np.int64), value.astype(float))
    grades = np.minimum(value, 2)
    weights, theta = toxicity.fit_ordinal(rows, grades, 1, np.ones(600))
    assert weights[0] > 0 and theta[0] < theta[1]
    above = toxicity.sigmoid(value[:, None] * weights[0] - theta)
    assert [round(above[value == g].sum(1).mean()) for g in (0, 1, 2)] == [0, 1, 2]


def test_models_without_examples(spark, corpus):
    docs, labels = corpus
    plain_docs, none = docs.select("doc_id", "text"), labels.filter("doc_id < 0")
    assert toxicity.fit(plain_docs, none) is None and quality.fit(plain_docs, none) is None
    assert {r.severity for r in toxicity.score(plain_docs, None).collect()} == {0.0}
    assert {r.score for r in quality.score(plain_docs, None).collect()} == {0.5}
    assert toxicity.score(plain_docs.limit(0), None).count() == 0


def test_quality_on_rows_not_learnt_from(corpus):
    docs, labels = corpus
    plain_docs = docs.select("doc_id", "text")
    model = quality.fit(plain_docs, labels.filter("doc_id < 160"))
    found = quality.score(plain_docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    apart = [r for r in found if r.doc_id is not None and 160 <= r.doc_id < 240]
    right = sum((r.score >= 0.7) == (r.doc_id % 3 != 0) for r in apart)
    assert right / len(apart) >= 0.95


def test_vectors_come_from_all_texts(spark, corpus):
    """Labelled rows alone do not make the vectors: texts without labels do as well."""
    docs, labels = corpus
    plain_docs = docs.select("doc_id", "text")
    some = labels.filter("doc_id < 160")
    more = spark.createDataFrame([(5000 + i, "ta unheard " * 40) for i in range(50)], "doc_id long, text string")
    before, after = quality.fit(plain_docs, some)[0], quality.fit(plain_docs.union(more), some)[0]
    word = quality.tokens(pa.array(["unheard"]))[0][1:]
    assert word not in before.words and word in after.words
    near = quality.tokens(pa.array(["ta"]))[0][1:]
    assert not np.allclose(before.vectors[before.number(near)], after.vectors[after.number(near)])


def test_contexts_equal_neighbours_counted_one_by_one(spark):
    texts = ["Ab cd ab, x9", "", None, "cd", "ab ab cd 77 ab"]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    streams = [h.tolist() for t in texts for h in [quality.tokens(pa.array([t], pa.string()))[0]]]
    words = np.unique(np.array([h for s in streams for h in s], np.uint64))[::2]
    want = np.zeros((len(words) + 1, quality.WIDTH))
    place = {h: i for i, h in enumerate(words.tolist())}
    for stream in streams:
        for i, h in enumerate(stream):
            for j in range(max(0, i - quality.REACH), min(len(stream), i + quality.REACH + 1)):
                if i != j:
                    want[place.get(h, len(words))] += quality.index_vectors(np.array([stream[j]], np.uint64))[0]
    assert np.array_equal(quality.contexts(table, words), want)
    counted = {r.token % (1 << 64): r.n for r in quality.token_counts(table).collect()}
    assert counted == Counter(h for s in streams for h in s)
    assert not quality.contexts(table.limit(0), words).any()


def test_pooled_features_are_means_of_vectors(monkeypatch):
    texts = [prose(1, 50), None, "", "a a a b", prose(2, 400), "zz"]
    hashes = np.unique(np.concatenate([quality.tokens(pa.array([t]))[0] for t in texts[3:5]]))
    vectors = np.random.default_rng(3).normal(size=(len(hashes) + 1, quality.WIDTH)).astype(np.float32)
    pooling = quality.Pooling(hashes, vectors)
    for piece in (1, 7, quality.PIECE):
        monkeypatch.setattr(quality, "PIECE", piece)
        found = pooling.pooled(pa.array(texts, pa.string()))
        for text, row in zip(texts, found):
            own = quality.tokens(pa.array([text], pa.string()))[0]
            few = np.unique(own)
            want = [vectors[pooling.number(x)].astype(float).mean(0) if len(x) else np.zeros(quality.WIDTH) for x in (own, few)]
            assert np.allclose(row, [*want[0], *want[1], len(few) / max(len(own), 1), np.log1p(len(own))], atol=1e-9)


def test_equal_words_meet_in_bounded_memory():
    """8,000 equal words against an item of 2,000: 16 million hits a seed, on 10,000 diagonals."""
    same = np.full(2000, 77, np.uint64)
    block = decontaminate.Block([(1, same, 0, len(same))])
    tracemalloc.start()
    text, item, start, end, equal = block.overlaps(np.full(8000, 77, np.uint64), np.array([0, 8000]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    # every diagonal with 13 words side by side in the item and the text holds an overlap
    assert len(text) == 8000 + 2000 + 1 - 2 * decontaminate.SPAN and not text.any()
    assert np.array_equal(end - start, equal)


def brute(doc, item):
    """The most equal words of any window on any diagonal, by trying all."""
    a, b = doc.lower().replace(",", " ").split(), item.lower().replace(",", " ").split()
    size = min(decontaminate.WINDOW, len(b))
    best = 0
    for i in range(len(a) - size + 1):
        for j in range(len(b) - size + 1):
            best = max(best, sum(x == y for x, y in zip(a[i : i + size], b[j : j + size])))
    return best >= decontaminate.SIMILARITY * size


def test_decontamination_tolerates_substitutions(spark):
    items = [(i, " ".join(f"w{(i * 97 + k * k * 13) % 5003}" for k in range(24 + i))) for i in range(12)]
    docs = []
    for i, (_, text) in enumerate(items):
        words = text.split()
        words[3] = words[14] = "other"
        docs.append((i, prose(i, 60) + " " + " ".join(words).upper() + ", " + prose(i + 50, 30)))
        broken = [w if k % 2 else "gone" for k, w in enumerate(text.split())]
        docs.append((100 + i, prose(i, 20) + " " + " ".join(broken)))
    docs += [(200, None), (201, ""), (None, items[0][1]), (0, docs[0][1]), (202, prose(9, 20000) + " " + items[4][1])]
    table = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([*items, (50, None), (51, "too short"), (None, "")], "item_id long, text string")
    expected = {(a, i) for a, b in docs for i, text in items if b and len(b) < 5000 and brute(b, text)} | {(202, 4)}
    for most in (1 << 19, 60):
        found = decontaminate.overlaps(table, benchmark, most).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected
        assert len([r for r in found if r.doc_id == 0]) == 2
        kept = decontaminate.clean(table, benchmark, most)
        hit = {a for a, _ in expected}
        assert kept.columns == table.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(a for a, _ in docs if a not in hit)
    assert decontaminate.overlaps(table.limit(0), benchmark).count() == 0
    assert decontaminate.clean(table, benchmark.limit(0)).count() == len(docs)


def test_every_tolerated_substitution_leaves_a_seed():
    for size in range(decontaminate.SPAN, decontaminate.WINDOW + 1):
        changes = size - int(np.ceil(decontaminate.SIMILARITY * size - 1e-9))
        item = np.arange(1, size + 1).astype(np.uint64)
        texts = []
        for changed in itertools.combinations(range(size), changes):
            text = item.copy()
            text[list(changed)] = 1000
            texts.append(text)
        found = decontaminate.Block([(1, item, 0, size)]).overlaps(np.concatenate(texts), np.arange(len(texts) + 1) * size)
        assert found[0].tolist() == list(range(len(texts)))
        assert set(found[4].tolist()) == {size - changes}


def test_short_texts_short_items_and_verbatim_stretches(spark):
    item = [f"v{k}" for k in range(5000)]
    items = [(1, " ".join(item)), (2, "Seven words, that all must be equal"), (3, "seven words that all must be equal"), (4, "lone"), (5, "four words, no more"), (6, "now these are five words")]
    docs = [
        (10, " ".join(item[40:55])),
        (11, " ".join(["x"] * 30 + item[100:113] + ["y"] * 30)),
        (12, " ".join(["x"] * 30 + item[100:112] + ["y"] * 30)),
        (13, "now SEVEN words that all must be equal and seven words that all must be equal"),
        (14, "seven words that nearly all must be equal lonely"),
        (15, "a lone wolf"),
        (16, " ".join(["z"] * 9 + item[2028:2037] + ["q"] * 2 + item[2039:2041] + ["z"] * 9)),
        (17, " ".join([w if k % 5 else "q" for k, w in enumerate(item[2030:2050])])),
        (18, " ".join(item[60:72])),
        (19, " Lone!"),
        (20, "four words no more"),
        (21, "these four words no more"),
        (22, "and now these are FIVE words again"),
        (23, "lone lone"),
    ]
    expected = {(10, 1): (0, 15, 15), (11, 1): (30, 43, 13), (13, 2): (1, 8, 7), (13, 3): (1, 8, 7), (17, 1): (0, 20, 16)}
    expected |= {(19, 4): (0, 1, 1), (20, 5): (0, 4, 4), (22, 6): (1, 6, 5)}
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for most in (1 << 19, 60):
        found = decontaminate.overlaps(table, benchmark, most).collect()
        assert {(r.doc_id, r.item_id): (r.start, r.end, r.equal) for r in found} == expected
        assert {r.doc_id for r in decontaminate.clean(table, benchmark, most).collect()} == {12, 14, 15, 16, 18, 21, 23}
