"""Personal data against Python's patterns, and nearest neighbours against all cosines."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidegauge.llm import neighbours, pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [d * 2 if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def base(text):
    found = [(m.start(), n, m.end()) for n, k in enumerate(BASE) for m in re.finditer(BASE[k], text or "") if valid(k, m.group())]
    return [f"{pii.KINDS[n]}:{a}:{b}" for a, n, b in sorted(found)]


TEXTS = [
    None, "", "a@b.c_d@e.f x@y z@z.", "a@b@c.d.e, é😀 q@r.st", "1.2.3.4.5 256.1.1.1 0000255.0.0.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (499) 555-6503. +1((((((( +12 34", "+4111111111111111 10.0.0.1@x.y",
    "9" * 30000, "a" * 200000, "a" * 50000 + "@x.y", "1 " * 20000 + "+1 212 555 0199", "٣@x.y 4111 1111",
]


def test_base_spans_are_those_of_the_patterns(spark, tmp_path):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "a@b.cd", 1), (3, TEXTS[3], 1)]
    spark.createDataFrame(rows, "doc_id long, text string, spans int").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    found = pii.op2_personal_data(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in found:
        spans = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(r.spans.split(",")) if spans else True


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"please call me at +1 212 555 {1000 + i} today ok") for i in range(40)]
    rows += [(100, "please call me at 2125559999 today ok"), (101, "we sold about 2125559990 in march")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert [(s.kind, s.start, s.end, s.base) for s in found[100]] == [(3, 18, 28, False)]
    assert found[101] == []
    assert all(len(found[i]) == 1 and found[i][0].base for i in range(40))
    assert pii.find(docs.limit(0)).count() == 0


def test_labels_and_single_words_find_unseen_identifiers(spark):
    """Words around the cue differ from text to text: neither two words nor a word on each side repeat."""
    draw = random.Random(4)

    def other():
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))

    frames = {"label": "{} phone: {} {}", "word": "{} ring {} {}", "neither": "{} the {} {}"}
    rows, unseen = [], {}
    for number, (name, frame) in enumerate(frames.items()):
        seeds = [f"+1 212 555 {1000 * (number + 1) + i}" for i in range(40)]
        if name == "neither":
            seeds = [s if i % 2 else f"user{'x' * i}@example.com" for i, s in enumerate(seeds)]
        rows += [(1000 * number + i, frame.format(other(), s, other())) for i, s in enumerate(seeds)]
        for i in range(4):
            text = frame.format(other(), f"212 777 {1000 * (number + 1) + i}", other())
            rows.append((1000 * number + 500 + i, text))
            unseen[1000 * number + 500 + i] = [] if name == "neither" else [(3, text.index("212"), text.index("212") + 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if not s.base] for r in pii.find(docs).collect()}
    assert found == {i: unseen.get(i, []) for i, _ in rows}


def test_precision_and_recall_of_planted_contexts(spark):
    """Unseen forms in the contexts of their kind among numbers and dotted words elsewhere: what is found, and what is right."""
    draw = random.Random(9)
    filler = ["".join(draw.choice(["ta", "ri", "mo", "le", "ku", "sha"]) for _ in range(3)) for _ in range(150)]
    frames = {
        0: ["write to {} for details", "mail: {}", "reachable under {} at work"],
        1: ["the host answers at {} since monday", "ip = {}", "traffic from {} was blocked"],
        2: ["paid with card number {} last week", "card: {}", "charged to {} on friday"],
        3: ["call me at {} after noon", "tel: {}", "or ring {} instead"],
    }

    def card():
        digits = "4" + "".join(draw.choice("0123456789") for _ in range(14))
        return next(digits + c for c in "0123456789" if valid("card", digits + c))

    def digits(n):
        return "".join(draw.choice("0123456789") for _ in range(n))

    seeds = [lambda: f"{draw.choice(filler)}{digits(3)}@example.com", lambda: f"10.{digits(1)}.{digits(1)}.{draw.randint(1, 99)}", card, lambda: f"+1 212 5{digits(2)} {digits(4)}"]
    forms = [lambda: f"{draw.choice(filler)}{digits(2)}(at)example.com", lambda: f"2001:db8::{digits(4)}", lambda: f"4111-{digits(4)}-{digits(4)}-{digits(4)}", lambda: f"(212) 5{digits(2)}-{digits(4)}"]
    noise = [lambda: f"version 2.{digits(1)}", lambda: f"in {1900 + draw.randint(0, 99)}", lambda: f"costs {digits(4)} coins", lambda: f"order {digits(8)} shipped", lambda: f"see {draw.choice(filler)}.{draw.choice(filler)}"]
    rows, planted = [], set()
    for i in range(2400):
        words = [draw.choice(filler) for _ in range(12)]
        kind = draw.randrange(5)
        unseen = draw.random() < 0.2
        item = "" if kind == 4 else (forms if unseen else seeds)[kind]()
        middle = draw.choice(noise)() if kind == 4 else draw.choice(frames[kind]).format(item)
        text = " ".join([*words[:6], middle, *words[6:], draw.choice(noise)(), draw.choice(filler)])
        if item and unseen and not base(item):
            planted.add((i, kind, text.index(item), text.index(item) + len(item)))
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {(r.doc_id, s.kind, s.start, s.end) for r in pii.find(docs).collect() for s in r.spans if not s.base}
    recall, precision = len(found & planted) / len(planted), len(found & planted) / max(len(found), 1)
    print(f"{len(planted)} planted, recall {recall:.3f}, precision {precision:.3f}", sorted(planted - found)[:5], sorted(found - planted)[:5])
    assert recall >= 0.9 and precision >= 0.95


def test_contexts_find_each_form(spark):
    def card(i):
        digits = f"4111{i:011d}"
        return next(digits + c for c in "0123456789" if valid("card", digits + c))

    contexts = {
        "email": ("please write to {} for details", lambda i: f"user{'abcdefghij'[i % 10] * (i // 10 + 1)}@example.com"),
        "ip": ("the server answers under {} since monday", lambda i: f"10.0.{i}.7"),
        "card": ("she paid using number {} last week", lambda i: card(i)),
        "phone": ("call me at {} today ok", lambda i: f"+1 212 555 {1000 + i}"),
    }
    forms = {
        "email": ["anna.smith@localhost", "anna.smith(at)example.com", "anna [at] example [dot] com", "anna.smith.example.com", "jürgen.weiß@example"],
        "ip": ["2001:db8::8a2e:370:7334", "fe80::1", "300.1.1.1"],
        "card": ["4111 1111 1111 1112", "4111-1111-1111-1113"],
        "phone": ["212 555 0199", "(212) 555-0198", "212.555.0197", "2125550196"],
    }
    rows, expected = [], {}
    for number, kind in enumerate(pii.KINDS):
        frame, seed = contexts[kind]
        rows += [(1000 * number + i, frame.format(seed(i))) for i in range(70)]
        for i, form in enumerate(forms[kind]):
            rows.append((1000 * number + 500 + i, frame.format(form)))
            expected[1000 * number + 500 + i] = [(number, frame.index("{"), frame.index("{") + len(form), False)]
            rows.append((1000 * number + 600 + i, f"nobody knows whether {form} means anything"))
            expected[1000 * number + 600 + i] = []
    # numbers that stand everywhere carry no kind from one context into others
    rows += [(9000 + i, f"chapter {'abcdefgh'[i]} page {k} ends") for i in range(8) for k in range(6)]
    docs = spark.createDataFrame(rows + [(9100, "please write to 5 for details")], "doc_id long, text string").coalesce(1)
    found = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.spans] for r in pii.find(docs).collect()}
    assert {i: found[i] for i in expected} == expected
    assert all(len(found[1000 * n + i]) == 1 and found[1000 * n + i][0][3] for n in range(4) for i in range(70))
    assert not any(found[9000 + i] for i in range(8))


def test_neighbours_are_near_those_of_all_cosines(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 24))
    values = (centres[draw.integers(0, 12, 1500)] + draw.normal(size=(1500, 24))).astype(np.float32)
    values[200:260] = values[100]
    rows = [(i, [float(x) for x in v], "a") for i, v in enumerate(values)]
    rows += [(2000, None, "a"), (2050, [0.0] * 24, "a"), (2100, [float("nan")] * 24, "a"), (2150, [None] + [1.0] * 23, "a"), (None, [1.0] * 24, "a"), (2200, [], "a")]
    rows.append(rows[50])
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    usable = neighbours.vectors(table)
    found = neighbours.search(neighbours.build(usable, size=400), usable.filter("vec_id % 50 = 0"), block=7).collect()
    x = values.astype(float)
    hits = 0
    for q in range(0, 1500, 50):
        score = neighbours.cosines(np.repeat(x[q : q + 1], len(x), 0), x)
        score[q] = -2
        top = np.lexsort((np.arange(len(x)), -score))[:5]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - score[r.vec_id]) < 1e-12 for r in own)
        hits += len(set(top.tolist()) & {r.vec_id for r in own})
    assert hits / 150 >= 0.9
    assert {r.query_id for r in found} == set(range(0, 1500, 50))
    copies = sorted((r.rank, r.vec_id) for r in found if r.query_id == 100)
    assert [v for _, v in copies] == [200, 201, 202, 203, 204]


@pytest.mark.parametrize("clusters, size, spread", [(100, 40, 0.05), (40, 100, 0.05), (16, 256, 0.3), (16, 256, 0.05), (8, 500, 0.1), (400, 10, 0.02)])
def test_a_shard_of_clusters_does_not_fall_apart(clusters, size, spread):
    draw = np.random.default_rng(clusters)
    centres = draw.normal(size=(clusters, 64))
    x = np.repeat(centres, size, 0) + spread * draw.normal(size=(clusters * size, 64))
    shard = neighbours.Shard(np.arange(len(x)), x, 5)
    assert shard.graph._reached().all()
    asked = draw.choice(len(x), 200, replace=False)
    query, found, _ = shard.nearest(asked, x[asked], 5)
    hits = 0
    for i, q in enumerate(asked):
        score = neighbours.cosines(np.repeat(x[q : q + 1], len(x), 0), x)
        score[q] = -2
        hits += len(set(np.argsort(-score)[:5].tolist()) & set(found[query == i].tolist()))
    assert hits / 1000 >= 0.9


def test_a_repeated_query_id_asks_with_its_smallest_vector(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    table = neighbours.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = neighbours.search(neighbours.build(table), table.filter("vec_id = 0"), k=1).collect()
    assert [(r.query_id, r.vec_id) for r in found] == [(0, 2)]


def test_neighbours_of_few_and_none(spark):
    few = neighbours.vectors(spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<double>"))
    found = neighbours.search(neighbours.build(few), few.filter("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    assert neighbours.search(neighbours.build(few.limit(0)), few.limit(0)).count() == 0
