"""Merkle manifest, token alignment and embedding dedup against brute force."""

import bisect
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from tidegauge.llm import alignment, manifest, smallworld
from tidegauge.llm.vocab import public

# ---- manifest ----


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def beside(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 8 * 8
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + 8])))
        at //= 8
    return out


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_manifest(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for rows in groups.values():
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
    trees = {lang: levels_of([leaf(r) for r in groups[lang]]) for lang in langs}
    top = levels_of([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for at, row in enumerate(groups[lang]):
            path = beside(trees[lang], at) + beside(top, place)
            chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf((*row[:4], lowered(row[4]) if chosen else row[4]))
            for left, right in path:
                node = H(left + node + right)
            proof = H("".join(a + b for a, b in path))
            out.append((row[0], leaf(row), trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return Counter(out)


DOCUMENTS = "doc_id long, source string, lang string, n_chars long, text string, grp long, at string, total int, row string, digest int"
CLASH = (1, "x", 2, "y", 3)


def manifest_of(spark, folder, rows):
    made = spark.createDataFrame([(*r, *CLASH) for r in rows], DOCUMENTS)
    made.repartition(3).write.parquet(f"{folder}/documents.parquet")
    found = manifest.op12_merkle_manifest(spark, folder).collect()
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r[n] for n in names) for r in found)


def test_manifest_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    ids = rng.sample(range(2000), 1100) + [-5, -(1 << 63), (1 << 63) - 1, 1 << 40, 70_000_000]
    rows = [(i, f"s{i % 3}", "en", i % 7, f"Text {i % 50}") for i in ids]
    rows += [(i, None, "zh-é", None, "É x") for i in range(9)] + [(7000 + i, "s", None, 1, None) for i in range(66)]
    rows += [(3, "s", "de", 1, "One"), (None, None, "", None, ""), (None, None, None, None, None)]
    # repeated rows, one id with many texts, rows without an id
    rows += rows[:5] + [(900_000, "s", "en", 1, f"copy {i}") for i in range(40)] + [(None, "s", "en", 1, f"n {i}") for i in range(30)]
    rows += [(900_000, "s", "en", 1, "copy 3")] * 3
    assert manifest_of(spark, str(tmp_path), rows) == brute_manifest(rows)


def test_the_sql_gives_the_same(tmp_path, spark):
    import duckdb

    rows = [(i, f"s{i % 3}", ["en", "de", None, "é"][i % 7 % 4], i, f"Text É {i}") for i in range(0, 900, 3)] + [(None, None, "en", None, None)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/d")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    found = db.execute(f"SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM ({manifest.ORACLE_SQL})").fetchall()
    assert Counter(found) == brute_manifest(rows)


def test_manifest_of_lone_leaves_and_of_none(spark, tmp_path):
    rows = [(1, "s", "b", 1, "A"), (2, "s", "a", 1, "B"), (3, "s", "é", 1, "C")]
    assert manifest_of(spark, str(tmp_path / "lone"), rows) == brute_manifest(rows)
    one = [(9, "s", "b", 1, "A")]
    found = manifest_of(spark, str(tmp_path / "one"), one)
    assert found == brute_manifest(one)
    assert manifest_of(spark, str(tmp_path / "none"), []) == Counter()


# ---- alignment ----

A = Tokenizer.from_file(public("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public("piece_bpe_32k.model"))


def spelled(library):
    """The bytes of each token, by the library's own spelling of a byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = iter(range(256, 400))
    byte = {chr(b) if b in shown else chr(next(odd)): b for b in range(256)}
    return {i: bytes(byte[c] for c in t) for t, i in library.get_vocab(with_added_tokens=False).items()}


A_BYTES = spelled(A)
B_BYTES = [bytes([int(B.id_to_piece(i)[1:-1], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in range(B.get_piece_size())]


def aligned(text):
    """A's ids, B's ids, the groups and the links (a, b) of one text, from its whole encodings."""
    nothing = [], [], [], []
    if not text:
        return nothing
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes, b_bytes = [A_BYTES[i] for i in a], [B_BYTES[i] for i in b]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return nothing
    a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    common = sorted(set(a_ends) & set(b_ends))
    groups = [([], []) for _ in common]
    for ids, ends, side in ((a, a_ends, 0), (b, b_ends, 1)):
        for i, e in zip(ids, ends):
            groups[bisect.bisect_left(common, e)][side].append(i)
    at = dict(zip(b_ends, b))
    return a, b, groups, [(i, at[e]) for i, e in zip(a, a_ends) if e in at]


def texts_of_every_kind(n, seed=5):
    rng = random.Random(seed)
    parts = list("abz  \n\t  '.,0129<>|sétñ") + [
        " ", " ", "　", "▁", "é", "漢", "字", "😀", "<|endoftext|>", "<s>", "<0x41>", "'s", "\x00", "\x1c", "\x85", "  ", "\r\n", " the", " Hello",
    ]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*made, None, "", " ", "  ", "a" * 5000, " " * 300, "the cat " * 4000, "▁ x", "漢字" * 300]


def test_alignment_equals_whole_encodings(spark, tmp_path):
    texts = texts_of_every_kind(800)
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "the cat", 1, "x"), (0, texts[0], 1, "x")]
    schema = "doc_id long, text string, row int, pairs string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = alignment.op11_token_alignment(spark, str(tmp_path)).collect()
    truth = [aligned(r[1]) for r in rows]
    counts = Counter(pair for t in truth for pair in t[3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = Counter()
    for (i, _, _, _), (a, b, groups, links) in zip(rows, truth):
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == most[p[1]] for p in links)
        want[(i, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), H(told) if a else "")] += 1
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r[n] for n in names) for r in found) == want


def test_alignment_gives_the_groups_and_of_no_rows_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Hello wörld"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.align(docs, public("byte_bpe_50k.json"), public("piece_bpe_32k.model")).collect()}
    _, _, groups, links = aligned("Hello wörld")
    assert found[1].groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert dict(zip(found[1].pairs, found[1].times)) == Counter(a * B.get_piece_size() + b for a, b in links)
    assert (found[2].groups, found[2].pairs, found[2].n_a) == ("", [], 0)
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert alignment.op11_token_alignment(spark, str(tmp_path)).collect() == []


def test_memory_that_starts_anew_gives_the_same(monkeypatch):
    import pyarrow as pa

    texts = pa.array(texts_of_every_kind(60))
    whole = alignment.Aligner(public("byte_bpe_50k.json"), public("piece_bpe_32k.model")).texts(texts)
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    small = alignment.Aligner(public("byte_bpe_50k.json"), public("piece_bpe_32k.model"))
    parts = [small.texts(texts.slice(i, 1)) for i in range(len(texts))]
    assert np.array_equal(np.concatenate([p.links for p in parts]), whole.links)
    assert np.array_equal(np.concatenate([p.spelled for p in parts]), whole.spelled)
    assert np.array_equal(np.concatenate([p.fine for p in parts]), whole.fine)


def test_intervals_coalesce_as_far_as_they_reach():
    starts, ends = np.array([0, 4, 4, 2, 9, 0]), np.array([3, 6, 5, 4, 9, 2])
    assert alignment.coalesced(starts, ends).tolist() == [0, 1, 1, 0, 2, 0]
    a, b = alignment.overlaps((np.array([0, 3]), np.array([3, 5])), (np.array([0, 2, 4]), np.array([2, 4, 5])))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1), (1, 1), (1, 2)]


# ---- embeddings ----


def brute_links(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label) rows."""
    fine = [e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e) for _, e, _ in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    places = defaultdict(list)
    for i, (_, e, label) in enumerate(rows):
        if fine[i] and label is not None:
            places[label, len(e)].append(i)
    for some in places.values():
        x = np.array([rows[i][1] for i in some], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= threshold
        for a, b in zip(*np.nonzero(near)):
            if a != b:
                links[some[a]] += 1
                root[top(some[a])] = top(some[b])
    names = defaultdict(list)
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            names[top(i)].append(v)
    least = [min(names[top(i)], default=None) for i in range(len(rows))]
    return Counter((v, links[i], least[i], v == least[i]) for i, (v, _, _) in enumerate(rows))


def clustered(clusters, size, spread, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return (np.repeat(centres, size, 0) + spread * rng.normal(size=(clusters * size, dim))).astype(np.float32).astype(float)


def found_links(spark, rows, **options):
    schema = "vec_id long, embedding array<float>, label int, class string, weight string, node int"
    made = spark.createDataFrame([(v, e, l, "x", "y", 1) for v, e, l in rows], schema).repartition(3)
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in smallworld.near_duplicates(made, **options).collect())


def test_embedding_links_equal_brute_force(spark):
    vectors = clustered(30, 12, 0.25)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)]
    copy = vectors[0].tolist()
    rows += [(1000 + i, copy, 0) for i in range(50)] + [(2000 + i, copy, None) for i in range(3)]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 24, 0), (3003, [float("nan")] * 24, 0), (3004, [None, 1.0], 0)]
    rows += [(3005, [1.0, 1e30], 1), (3006, [0.0, 1e-30], 1), (3007, [-1.0, 0.0], 1), (3008, [float("inf"), 1.0], 1)]
    rows += [(None, copy, 0), (None, [5.0, 5.0], 2), rows[3], rows[3]]
    want = brute_links(rows)
    assert found_links(spark, rows) == want
    # several shards of a label, in cells of two shards
    assert found_links(spark, rows, size=40) == want
    assert found_links(spark, rows[:0]) == Counter()
    assert found_links(spark, [(1, [1.0], None), (None, None, 1)]) == Counter({(1, 0, 1, True): 1, (None, 0, None, True): 1})


def test_graph_search_and_audits_find_the_links_of_clustered_vectors():
    for clusters, size, spread in ((100, 40, 0.05), (40, 100, 0.05), (16, 256, 0.3), (16, 256, 0.05), (8, 500, 0.1)):
        x = clustered(clusters, size, spread, 64)
        n = len(x)
        shard = smallworld.Shard(np.arange(n), np.ones(n, np.int64), x)
        near = shard.exact @ shard.exact.T >= 0.93
        np.fill_diagonal(near, False)
        found = shard.linked(shard.exact, True, 0.93)
        assert not (found & ~near).any() and found.sum() >= 0.99 * near.sum()
        asked = smallworld.unit(clustered(clusters, 10, spread, 64))
        near = asked @ shard.exact.T >= 0.93
        found = shard.linked(asked, False, 0.93)
        assert not (found & ~near).any() and found.sum() >= 0.99 * near.sum()


def test_a_failed_audit_widens_all_searches():
    """A graph whose edges are gone finds nothing: the audit leads on to the whole shard."""
    x = clustered(60, 10, 0.1, 16)
    shard = smallworld.Shard(np.arange(600), np.ones(600, np.int64), x)
    shard.graph.layers = [np.full_like(layer, -1) for layer in shard.graph.layers]
    near = shard.exact @ shard.exact.T >= 0.93
    np.fill_diagonal(near, False)
    assert near.sum() and np.array_equal(shard.linked(shard.exact, True, 0.93), near)


def test_forest_joins_what_is_linked():
    linked = np.zeros((4, 6), bool)
    linked[0, 5] = linked[1, 5] = linked[2, 3] = True
    roots = smallworld.forest(linked, 6)
    assert roots[6] == roots[7] == roots[5] == 5 and roots[8] == roots[3] == 3 and roots[9] == 9
