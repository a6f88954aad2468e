"""Source mixing, SimHash, token store, token counts, substring dedup and the pipeline against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm import common, mix, rans, simhash, substring, tokencount, vocab
from tidegauge.llm.vocab import public

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, source string, text string, size int, target string, key string, row long, hash string, at string"
VOCABULARY = public("word_bpe_49k.json")


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["ta", "Ri", "mo", "lé", "ku", "sha"]) for _ in range(draw.randint(1, 3))) for _ in range(n))


def cases():
    """Nulls, empty and long texts, ties, repeated rows, shared passages, copies that differ a little."""
    shared = prose("shared", 70)
    rows = [(i, "abc"[i % 3], prose(i, 20 + 3 * i)) for i in range(40)]
    rows += [(100 + i, "hot", f"{prose(i, 9)} {shared} {prose(-i, 11)}") for i in range(12)]
    rows += [(200 + i, "hot", shared) for i in range(6)]
    base = prose("near", 400)
    rows += [(300 + i, "a", base + f" tail{i}") for i in range(8)]
    rows += [(400, None, None), (401, None, ""), (402, "a", " \t\n"), (403, "a", "one two"), (None, "a", shared), (None, "c", "x")]
    rows += [(500, "b", prose("long", 30_000)), (501, "b", "z" * 70_000), (502, "c", " ".join(["same"] * 120)), rows[3], rows[3]]
    rows += [(503, "c", "nbsp stays here <|endoftext|> \x1c x"), (504, "zero", "")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return cases()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", "k", 2, "h", "a") for r in rows], DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, bits=2):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    named = defaultdict(list)
    for i, doc in enumerate(ids):
        named[find(i)].append(doc)
    return [min((d for d in named[find(i)] if d is not None), default=None) for i in range(len(prints))]


def test_simhash_equals_brute_force(docs, rows, nothing):
    found = simhash.near_duplicates(docs).collect()
    prints = [fingerprint(r[2]) for r in rows]
    want = components(prints, [r[0] for r in rows])
    got = sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in found), key=repr)
    assert got == sorted(zip([r[0] for r in rows], prints, want), key=repr)
    kept = simhash.one_of_each(docs).collect()
    assert kept and len(kept) == len(set(want))
    assert simhash.one_of_each(docs).columns == docs.columns
    assert simhash.near_duplicates(nothing).count() == simhash.one_of_each(nothing).count() == 0


def test_links_at_exactly_two_bits_and_chains(spark):
    draw = random.Random(5)
    base = draw.getrandbits(64)
    prints = [base, base ^ 3, base ^ 3 ^ (5 << 30), base ^ (7 << 50), draw.getrandbits(64), 0, 1 << 63, (1 << 63) | 1]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(signed)] + [(9, signed[0])], "doc_id long, fingerprint long")
    found = {r.fingerprint: r.component_id for r in simhash.classes(frame).collect()}
    assert [found[p] for p in signed] == components(prints, range(len(prints)))


def crowded(seed=7):
    """Fingerprints of which many share a segment, some a whole neighbourhood, and some are far from all others."""
    draw = random.Random(seed)
    low, high = draw.getrandbits(32), draw.getrandbits(32) << 32
    prints = {low | draw.getrandbits(32) << 32 for _ in range(60)} | {high | draw.getrandbits(32) for _ in range(60)}
    prints |= {low | high ^ (1 << i) ^ (1 << j) for i in range(0, 64, 5) for j in range(0, 64, 7)}
    prints |= {p ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for p in list(prints)[::3]}
    return sorted(prints | {draw.getrandbits(64) for _ in range(40)})


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("bucket", [1, 4, 1000])
def test_links_of_shared_segments_split_or_not(spark, bits, bucket):
    prints = crowded()
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), bits, bucket).collect()
    close = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits}
    links = {(r.a, r.b) for r in found}
    assert links <= close and len(links) == len(found)
    if bucket == 1000:
        assert links == close
    ids = range(len(prints))
    place = {p: i for i, p in enumerate(signed)}
    root = list(ids)
    for _ in ids:
        for a, b in links:
            root[place[a]] = root[place[b]] = min(root[place[a]], root[place[b]])
    assert root == components(prints, ids, bits)


def test_a_table_for_each_segment(spark):
    assert simhash.radii(2) == [1, 0] and simhash.radii(1) == [0, 0] and simhash.radii(3) == [1, 1] and simhash.radii(0) == [0, -1]
    keys = spark.range(1).select(simhash.segment_keys(F.lit(-2).cast("long"), [1, 0]).alias("k")).first().k
    ball = {0xFFFFFFFE ^ flip for flip in [0, *(1 << i for i in range(32))]}
    assert len(keys) == 34 and set(keys) == ball | {1 << 32 | 0xFFFFFFFF}


def without_repeats(rows, length=50):
    first = {}
    words = [WORD.findall(text or "") for _, _, text in rows]
    order = [common.NO_ID if r[0] is None else r[0] for r in rows]
    for some, doc in zip(words, order):
        for i in range(len(some) - length + 1):
            window = tuple(some[i : i + length])
            first[window] = min(first.get(window, doc), doc)
    out = []
    for some, doc, row in zip(words, order, rows):
        gone = set()
        for i in range(len(some) - length + 1):
            if first[tuple(some[i : i + length])] < doc:
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(some) if i not in gone)
        out.append((row[0], len(some), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_substring_dedup_equals_brute_force(docs, rows, nothing):
    found = [tuple(r) for r in substring.substring_dedup(docs).collect()]
    assert sorted(found, key=repr) == sorted(without_repeats(rows), key=repr)
    assert substring.substring_dedup(nothing).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_substring_dedup_on_few_words(spark, seed):
    """Random texts over two words, full of overlapping repeats."""
    draw = random.Random(seed)
    rows = [(i, "a", " ".join(draw.choice("ab") for _ in range(draw.randint(0, 60)))) for i in range(80)]
    frame = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, text string")
    found = [tuple(r) for r in substring.substring_dedup(frame, 8).collect()]
    assert sorted(found, key=repr) == sorted(without_repeats(rows, 8), key=repr)


@pytest.fixture(scope="module")
def plain_ids(rows):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [tokenizer.encode(r[2] or "", add_special_tokens=False).ids for r in rows]


@pytest.mark.parametrize("block", [512, 1 << 18])
def test_token_store_round_trip(spark, docs, rows, plain_ids, block, tmp_path):
    rans.write_store(docs, f"{tmp_path}/store", VOCABULARY, block=block)
    found = rans.stored_documents(spark, f"{tmp_path}/store").orderBy("start").collect()
    want = sorted((len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()), repr(r[0])) for r, ids in zip(rows, plain_ids))
    assert sorted((r.n_tokens, r.ids_crc32, repr(r.doc_id)) for r in found) == want
    keys = [common.NO_ID if r.doc_id is None else r.doc_id for r in found]
    assert keys == sorted(keys)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    assert spark.read.parquet(f"{tmp_path}/store/blocks").agg({"n_ids": "sum"}).first()[0] == sum(r.n_tokens for r in found)


def test_empty_token_store(spark, nothing, tmp_path):
    rans.write_store(nothing, f"{tmp_path}/store", VOCABULARY)
    assert rans.stored_documents(spark, f"{tmp_path}/store").count() == 0


def test_blocks_of_a_store_are_decoded_once(spark, docs, monkeypatch, tmp_path):
    """Only a block that holds both whole documents and pieces of cut ones is decoded for each."""
    rans.write_store(docs, f"{tmp_path}/store", VOCABULARY, block=512)
    blocks = [{d.n_ids < d.n_tokens for d in r.docs} for r in spark.read.parquet(f"{tmp_path}/store/blocks").collect()]
    seen, decoded = [], rans._decoded
    monkeypatch.setattr(rans, "_decoded", lambda some, model: (seen.append(some.count()), decoded(some, model))[1])
    assert rans.stored_documents(spark, f"{tmp_path}/store").count() == docs.count()
    assert {True} in blocks and {False} in blocks
    assert sum(seen) == sum(map(len, blocks)) < 2 * len(blocks)


def test_token_store_takes_small_batches_and_sets_them_back(spark, docs, monkeypatch, tmp_path):
    keys = [f"spark.sql.execution.arrow.{name}PerBatch" for name in ("maxRecords", "maxBytes")]
    before, seen = [spark.conf.get(key) for key in keys], []
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("write_store", "digests"):
        real = getattr(rans, name)
        monkeypatch.setattr(rans, name, lambda *a, real=real, **k: (seen.append([int(spark.conf.get(key)) for key in keys]), real(*a, **k))[1])
    assert rans.op7_token_store(spark, str(tmp_path)).count() == docs.count()
    assert seen == [[rans.ROWS_AT_ONCE, rans.BYTES_AT_ONCE]] * 2
    assert [spark.conf.get(key) for key in keys] == before


def test_ids_counted_in_joined_arrays():
    """Many short arrays are few to count, of bounded size, with every value in its place."""
    found = [np.arange(n, dtype=np.uint16) for n in [1, 2, 3, 50, 0, 4, 4]]
    joined = [x.tolist() for x in rans._gathered(iter(found), 6)]
    assert [len(x) for x in joined] == [6, 50, 8]
    assert sum(joined, []) == np.concatenate(found).tolist()
    assert list(rans._gathered(iter([]), 6)) == []


def test_known_pieces_are_looked_up_once():
    class Places(dict):
        asked = 0

        def get(self, *key):
            Places.asked += 1
            return super().get(*key)

        def __getitem__(self, key):
            Places.asked += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Places.asked += 1
            return super().__contains__(key)

    texts = ["tides rise, tides fall", None, "", "the Tide é 12 <|x|> rises"]
    known = vocab.Vocabulary(VOCABULARY)
    first = known.encode(pa.array(texts))
    known.places, before = Places(known.places), len(known.places)
    again = known.encode(pa.array(texts))
    assert [x.tolist() for x in again] == [x.tolist() for x in first]
    assert Places.asked == before
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert first[0].tolist() == [i for t in texts for i in tokenizer.encode(t or "", add_special_tokens=False).ids]


def test_damaged_block_is_named(spark, docs, tmp_path):
    rans.write_store(docs.filter("doc_id < 5"), f"{tmp_path}/good", VOCABULARY)
    blocks = spark.read.parquet(f"{tmp_path}/good/blocks")
    blocks.withColumn("crc32", blocks.crc32 + 1).write.parquet(f"{tmp_path}/bad/blocks")
    spark.read.parquet(f"{tmp_path}/good/frequencies").write.parquet(f"{tmp_path}/bad/frequencies")
    with pytest.raises(Exception, match="wrong checksum"):
        rans.read_store(spark, f"{tmp_path}/bad").collect()


@pytest.mark.parametrize("chunk,overlap", [(tokencount.CHUNK, tokencount.OVERLAP), (300, 8)])
def test_token_counts_equal_the_library(docs, rows, plain_ids, nothing, chunk, overlap):
    """Small chunks and overlaps make words longer than the overlap, so documents are cut anew."""
    found = tokencount.token_counts(docs, VOCABULARY, chunk, overlap).collect()
    want = sorted((repr(r[0]), len((r[2] or "").encode()), len(ids)) for r, ids in zip(rows, plain_ids))
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == want
    assert tokencount.token_counts(nothing, VOCABULARY).count() == 0


def poured(sizes):
    """Targets by bisection on the words of a unit of weight, at which the capped shares make 150 % of all words."""
    weights, low, high = [(3, 1, 2)[i % 3] for i in range(len(sizes))], 0.0, 2.0 * sum(sizes) + 1
    for _ in range(200):
        unit = (low + high) / 2
        if sum(min(w * unit, 2 * s) for w, s in zip(weights, sizes)) < 1.5 * sum(sizes):
            low = unit
        else:
            high = unit
    return [min(w * high, 2 * s) for w, s in zip(weights, sizes)]


def test_small_sources_take_their_targets_to_the_word(spark):
    """Sources of less than a block, of one and of several, against the words that slots hold, taken one by one."""
    draw = random.Random(3)
    for sizes in ([100, 100, 100], [1, 0, 3000, 7, 128, 129], [draw.randint(0, 900) for _ in range(40)]):
        known = mix.Shares(list(map(str, range(len(sizes)))), sizes, 128)
        assert np.allclose(known.target, poured(sizes))
        for i, size in enumerate(sizes):
            n, took = known.blocks[i], 0
            for t in range(known.slots[i]):
                key = mix.permutation_keys(np.array([i]), np.array([t // n]), mix.SEED)
                block = int(mix.permuted(np.array([t % n]), np.array([n]), key)[0])
                full = min(128, size - 128 * block)
                took += min(known.cut[i], full) if t == known.slots[i] - 1 else full
            assert took == known.words[i] and abs(took - known.target[i]) <= 0.5


def test_draws_deal_every_slot_once(spark):
    slots = [0, 5, 4000, 1000, 2995, 1]
    found = mix.draws(spark, slots, shard=16, book=7).orderBy("shard").collect()
    sizes = defaultdict(int)
    for src, total in enumerate(slots):
        own = [r for r in found if r.src == src]
        assert [t for r in own for t in range(r.before, r.before + r.n)] == list(range(total))
        for r in own:
            sizes[r.shard] += r.n
    assert sorted(sizes) == list(range(501)) and all(14 <= n <= 18 for n in sizes.values())
    # a multinomial's spread: 16 slots at 1/2 have a variance of 4
    hot = [next((r.n for r in found if r.src == 2 and r.shard == s), 0) for s in range(501)]
    assert abs(np.mean(hot) - 8) < 0.1 and 2.5 < np.var(hot) < 5.5
    assert mix.draws(spark, [0, 0]).filter("n > 0").count() == mix.draws(spark, []).count() == 0


def test_mix_meets_targets_and_repeats_itself(spark, docs, rows, nothing):
    table, taken = mix.mix(docs, block=16, shard=32)
    words = {r.row: r.n for r in taken.selectExpr("row", "end - start AS n").groupBy("row").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    found = table.collect()
    assert sorted((repr(r.doc_id), r.size) for r in found) == sorted((repr(r[0]), len(WORD.findall(r[2] or ""))) for r in rows)
    names = sorted({r[1] for r in rows if r[1] is not None}) + [None]
    sizes = [sum(len(WORD.findall(r[2] or "")) for r in rows if r[1] == name) for name in names]
    target = poured(sizes)
    assert abs(sum(target) - 1.5 * sum(sizes)) < 1e-6 and all(t <= 2 * s for t, s in zip(target, sizes))
    for name, size, goal in zip(names, sizes, target):
        some = [r for r in found if r.source == name]
        assert {r.source_size for r in some} == {size} and all(abs(r.target - goal) < 1e-6 for r in some)
        assert abs(sum(words.get(r.row, 0) for r in some) - goal) <= 0.5 + 1e-6
        assert all(words.get(r.row, 0) <= 2 * r.size for r in some)
    again, more = mix.mix(docs.repartition(3), block=16, shard=32)
    count = lambda a, b: sorted(map(repr, a.join(b.groupBy("row").agg({"start": "sum", "end": "sum"}), "row").drop("row", "_bin").collect()))
    assert count(table, taken) == count(again, more)
    empty, none = mix.mix(nothing)
    assert empty.count() == none.count() == 0


def test_resharing_goes_on_until_none_is_above():
    assert mix.fill([10, 1000, 10]) == [20.0, 1490.0, 20.0]
    assert mix.fill([0, 0]) == [0.0, 0.0] and mix.fill([]) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4096])
def test_permutations(n):
    at = np.arange(n)
    one = mix.permuted(at, np.full(n, n), np.full(n, 3, np.uint64))
    two = mix.permuted(at, np.full(n, n), np.full(n, 4, np.uint64))
    assert sorted(one) == sorted(two) == list(range(n))
    assert n < 17 or (one != two).any()


def test_mixed_documents_hold_the_words_taken(docs, rows, nothing):
    _, taken = mix.mix(docs)
    whole = taken.selectExpr("sum(end - start) AS n").first().n
    mixed = mix.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(WORD.findall(r.text)) for r in mixed.collect()) == whole
    assert mix.mixed_documents(nothing).count() == 0


def test_files_of_a_store_hold_few_blocks(spark, tmp_path):
    """Spark's reader holds up to 4,096 rows of a file at once; 450 blocks in a file were too much at 6 GB."""
    rows = [(i, prose(i, 300)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    rans.write_store(docs, f"{tmp_path}/store", VOCABULARY, block=256)
    blocks = spark.read.parquet(f"{tmp_path}/store/blocks").groupBy(F.input_file_name()).count().collect()
    assert sum(r[1] for r in blocks) > 2 * rans.PER_FILE and max(r[1] for r in blocks) <= rans.PER_FILE
    found = rans.stored_documents(spark, f"{tmp_path}/store").orderBy("start").collect()
    tokenizer, start = Tokenizer.from_file(VOCABULARY), 0
    for r, (i, text) in zip(found, rows, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def broadcast_and_generated(df):
    """How many nodes of the plan make rows from lists below a broadcast, and how many do at all."""
    under, found, total = [], 0, 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(re.match(r"[\s:|+*-]*", line)[0])
        under = [d for d in under if d < depth]
        found += "Generate explode" in line and bool(under)
        total += "Generate explode" in line
        if "BroadcastExchange" in line:
            under.append(depth)
    return found, total


def test_slots_and_pieces_of_the_mixing_stage_are_not_sent_to_the_driver(docs):
    """Small files hold draws of which many slots are made; at 6 GB these did not fit the driver."""
    assert broadcast_and_generated(mix.mixed_documents(docs)) == (0, 2)


def test_op1_sends_no_slots_to_the_driver(spark, tmp_path):
    """Long texts in few rows: small files, yet many slots and pieces."""
    rows = [(i, f"s{i % 3}", " ".join(f"{i}w{j}" for j in range(5000 + i))) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = mix.op1_source_mix(spark, str(tmp_path))
    assert broadcast_and_generated(found) == (0, 2)
    taken = found.groupBy("source_size", "target").agg(F.sum("taken").alias("n"), F.sum("size").alias("size")).collect()
    # sources of unlike sizes, so each is a group of its own
    assert len(taken) == 3 and all(r.n == int(r.target + 0.5) and r.size == r.source_size for r in taken)


def test_many_sources_are_mixed_alike(docs, monkeypatch):
    """The table of sources is joined by shuffle where it is large."""
    few = mix.mix(docs, block=16, shard=32)[1].drop("row")
    monkeypatch.setattr(mix, "FEW", 0)
    more = mix.mix(docs, block=16, shard=32)[1].drop("row")
    assert sorted(map(repr, few.collect())) == sorted(map(repr, more.collect()))
    assert broadcast_and_generated(more)[0] == 0


def test_stages_keep_columns_named_like_their_own(docs):
    names = ["_fingerprint", "_row", "_hash", "_doc", "_key", "_spans", "_ROW_"]
    from pyspark.sql import functions as F

    more = docs.select("*", *[F.lit(n).alias(n) for n in names])
    for stage in (simhash.one_of_each, mix.mixed_documents):
        plain, named = stage(docs), stage(more)
        assert named.columns == more.columns
        assert sorted(map(str, named.select(*docs.columns).collect())) == sorted(map(str, plain.collect()))
        assert named.select(*names).distinct().collect() == [tuple(names)]


def thue_morse(n, a="a", b="b"):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


def test_words_made_to_collide_are_told_apart(spark):
    """Polynomial hashes modulo 2**64 give the same for these two words of 1,024 letters, whatever their base."""
    tail = prose("tail", 60)
    texts = [f"{thue_morse(1024)} {tail}", f"{thue_morse(1024, 'b', 'a')} {tail}"]
    tails = " ".join(tail.split()[:49])
    texts += [f"{thue_morse(1024)} {tails}", f"{thue_morse(1024, 'b', 'a')} {tails}"]
    # documents 2 and 3 differ in their first word: no window of theirs is the same
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[2:])], "doc_id long, text string")
    assert [r.n_removed for r in substring.substring_dedup(docs).orderBy("doc_id").collect()] == [0, 0]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:2])], "doc_id long, text string")
    assert [r.n_removed for r in substring.substring_dedup(docs).orderBy("doc_id").collect()] == [0, 60]


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    import corpus_pipeline as pipeline

    folder = "/root/testdata/sf0.001"
    docs = common.table(spark, folder, "documents")
    steps = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        steps[name] = (before, docs)
        if name != "token_output":
            assert docs.columns == before.columns
    before, after = (x.collect() for x in steps["near_duplicates"])
    groups = components([fingerprint(r.text) for r in before], [r.doc_id for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(groups))
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)
    before, after = (x.collect() for x in steps["mixing"])
    sizes = {r.doc_id: len(WORD.findall(r.text or "")) for r in before}
    assert all(0 < len(WORD.findall(r.text)) <= 2 * sizes[r.doc_id] for r in after)
    before, after = (x.collect() for x in steps["token_output"])
    want, start = [], 0
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for r in sorted(before, key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after) == want


def test_pipeline_hands_its_workers_few_rows_together(spark, tmp_path):
    """A batch of 10,000 long texts took more than an executor's memory."""
    import corpus_pipeline as pipeline

    keys = [f"spark.sql.execution.arrow.{name}PerBatch" for name in ("maxRecords", "maxBytes")]
    before = {key: spark.conf.get(key) for key in keys}
    texts = spark.createDataFrame([(i, "a b", "en", "s", 3) for i in range(3)], "doc_id long, text string, lang string, source string, n_chars long")
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def most(batches):
        sizes = [(b.num_rows, b.nbytes) for b in batches]
        yield pa.RecordBatch.from_arrays([pa.array([max(x)]) for x in zip(*sizes)], names=["n", "bytes"])

    for name, stage in pipeline.STAGES:
        try:
            stage(spark, texts, str(tmp_path))
            rows = spark.range(0, 2000, 1, 1)
            assert rows.mapInArrow(most, "n long, bytes long").first()["n"] <= pipeline.ROWS_AT_ONCE, name
            long = rows.select(F.repeat(F.lit("x"), 10_000).alias("text"))
            assert long.mapInArrow(most, "n long, bytes long").first()["bytes"] <= 1.1 * pipeline.BYTES_AT_ONCE, name
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)
    assert pipeline.run(spark, str(tmp_path)).count() == 1
    assert {key: spark.conf.get(key) for key in keys} == before
