"""Personal data and benchmark passages against plain Python."""

import hashlib
import random
from itertools import combinations
from math import comb

import pytest
from pyspark.sql import functions as F

from curbflow.llm import decontaminate, pii
from curbflow.llm.decontaminate import covers, find_contamination, masks_for, misses_of
from curbflow.llm.pii import find_pii, redact
from curbflow.llm.queries import QUERIES

import brute

TEXTS = [
    None, "", "no data", "a@b.c", "a@b.c_d@e.f x@y z@-.-", "@a.b a@b a@b..c a@b.c.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.0004",
    "4111 1111-1111 1111 and 4111111111111112", "9 9 9", "4111  1111 1111 1111", "+1 (234) 555-7890. +12 +1-2-3-4-5-6-7-8-9 ++1 2345678",
    "é\U0001F600 a@b.c \U0001F600 1.1.1.1", "1" * 30, "12-34-56-78-90-12-34", "x@" + "a." * 3000 + "b", "9 " * 5000, "." * 5000 + "@a.b",
    "00000000000000", "79927398713 0079927398713", "a%+-._@a-b.c-d", "+49 30 1234567\n+49\n30", "4111 1111 1111 1111 " * 3,
]


def test_base_spans_are_the_plain_matches(spark):
    rows = list(enumerate(TEXTS)) + [(None, "a@b.c"), (3, "a@b.c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x")).withColumn("base", F.lit(1))
    got = find_pii(docs).collect()
    assert len(got) == len(rows)
    texts = dict(enumerate(TEXTS))
    for r in got:
        want = brute.base_spans(texts.get(r.doc_id, "a@b.c"))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (r.doc_id, want, r.spans)
        assert r.spans == want or r.spans.startswith(want + ",")
        counts = [sum(s.startswith(kind) for s in want.split(",")) for kind in brute.PII]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
    assert find_pii(docs.limit(0)).collect() == []


def test_given_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op10_pii"](spark, sf_dir).collect():
        assert r.base_sha256 == hashlib.sha256(brute.base_spans(texts[r.doc_id]).encode()).hexdigest()


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(1)
    word = lambda: rng.choice("alpha beta gamma delta omega".split())
    rows = [(i, f"{word()} {word()} contact mail: user{i}@mail{i}.example.org {word()}") for i in range(12)]
    rows += [(50, "hello contact mail: user7@mail7.example.org bye"), (51, "so contact mail: user77@intern99 end"), (52, "room number 77@intern99 end")]
    got = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == "email:20:43"
    assert got[52] == ""
    rows += [(60 + i, f"{word()} contact mail: user{i}@mail{i}.example") for i in range(2)]
    learned = spark.createDataFrame([*rows, (70, "new contact mail: clerk55@mail66.example.org! and contact mail: clerk9@mail8-example-org")], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in find_pii(learned).collect()}
    assert spans[70].startswith("email:18:44") and "ctx_" not in spans[0]
    same_shape = [(i, f"{word()} my host: 10.0.{i}.7 {word()}") for i in range(30)] + [(99, "see my host: 300.0.1.7 now"), (98, "a 300.0.1.9 b")]
    spans = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame(same_shape, "doc_id long, text string")).collect()}
    assert spans[99] == "ctx_ip:13:22" and spans[98] == "" and spans[5].count(":") == 2


def test_contexts_of_whole_spans(spark):
    """Digitless emails, grouped phones and cards, starts of texts and words right after other numbers seed and are found."""
    word = "alpha beta gamma delta omega sigma".split()
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004", "4012 8888 8888 1881", "5105 1051 0510 5100"]
    rows = []
    for i, name in enumerate(word):
        rows += [
            (i, f"{name} write to {name}@example.com soon"), (10 + i, f"{name} call us +1 (017) 555-77{10 + i} soon"),
            (20 + i, f"{name} my card {cards[i]} ends"), (30 + i, f"host: 10.0.0.{i} ends"), (40 + i, f"{name} room1 seat22 10.1.0.{i} ends"),
        ]
    new = {
        100: ("please write to clerk@exämple.com soon", "ctx_email:16:33"), 102: ("please call us +1 (017) 555-771234567890 soon", "ctx_phone:15:40"),
        103: ("so my card 4111 1111 1111 1112 ends", "ctx_card:11:30"),
        104: ("host: 300.0.0.1 ends", "ctx_ip:6:15"), 105: ("now room1 seat22 300.1.0.1 ends", "ctx_ip:17:26"),
    }
    rows += [(k, t) for k, (t, _) in new.items()]
    got = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k] for k in new} == {k: spans for k, (_, spans) in new.items()}
    assert all("ctx_" not in spans for k, spans in got.items() if k < 100)


def test_redaction_joins_overlapping_spans(spark):
    spans = F.array(*[F.struct(F.lit(0).alias("k"), F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in ((7, 9), (1, 3), (2, 4))])
    row = spark.range(1).select(redact(F.lit("\U0001F600bcdefghij"), spans).alias("a"), redact(F.lit("abc"), F.filter(spans, lambda s: F.lit(False))).alias("b"))
    assert tuple(row.first()) == ("\U0001F600[PII]efg[PII]j", "abc")


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def contaminated(spark, docs, items=((1, ITEM),), **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("seed", F.lit(1)).withColumn("item", F.lit("x"))
    tests = spark.createDataFrame(list(items), "item_id long, text string").withColumn("words", F.lit("x"))
    return sorted((r.doc_id, r.item_id, r.equal_words) for r in find_contamination(frame, tests, **options).collect())


def test_exact_and_changed_passages(spark):
    w = ITEM.split()
    changed = lambda *at: " ".join("other" if i in at else x for i, x in enumerate(w))
    docs = [
        (1, f"text before. {ITEM.upper()}! and after"), (2, "x " + ITEM.replace(" ", ", ")), (3, changed(3, 9)), (4, changed(2, 5, 8, 11, 14)),
        (5, " ".join(w[:12])), (6, " ".join(w[2:15])), (7, " ".join(reversed(w))), (8, None), (9, ""), (10, "one two three " * 50),
    ]
    assert contaminated(spark, docs) == [(1, 1, 13), (2, 1, 13), (3, 1, 11), (5, 1, 12), (6, 1, 13)]


@pytest.mark.parametrize("seed_rows", [200_000, 40])
def test_every_pair_of_places_of_two_changes(spark, seed_rows):
    """With two words of thirteen changed, verification passes; the masks have to give a hit for nearly all."""
    w = ITEM.split()[:13]
    docs = [(a * 100 + b, " ".join("zz" if i in (a, b) else x for i, x in enumerate(w))) for a in range(13) for b in range(a)]
    got = contaminated(spark, docs, [(1, " ".join(w))], seed_rows=seed_rows)
    assert len(got) >= 0.6 * len(docs) and all(e == 11 for _, _, e in got)


@pytest.mark.parametrize("seed_rows", [200_000, 40])
def test_every_change_the_rule_admits_is_found(spark, seed_rows):
    """All items of 5 to 13 words with as many words changed as may differ: every document is found, none with one more."""
    items, docs, beyond = [], [], []
    for n in range(5, 14):
        w = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(w)))
        misses = misses_of(n, 0.84)
        assert misses == {5: 0, 6: 0, 13: 2}.get(n, 1) and covers(masks_for(n, misses), n, misses)
        for count, rows in ((misses, docs), (misses + 1, beyond)):
            for gone in combinations(range(n), count):
                rows.append((n * 10_000 + 5000 * (rows is beyond) + len(rows), " ".join("zz" if i in gone else x for i, x in enumerate(w))))
    got = contaminated(spark, docs + beyond, items, seed_rows=seed_rows)
    assert [d for d, _, _ in got] == sorted(d for d, _ in docs) and len([d for d, i, _ in got if i == 13]) == 78
    assert all(d // 10_000 == i and e == i - misses_of(i, 0.84) for d, i, e in got)


def test_masks_for_other_rules():
    for width in range(1, 21):
        for misses in range(width):
            if comb(width, misses) <= 2000:
                assert covers(masks_for(width, misses), width, misses), (width, misses)


def test_short_items_nulls_and_empty_tables(spark):
    docs = [(1, "a b c d e f"), (2, "a b c d x f"), (None, "q a b c d e f"), (1, "nothing"), (4, "p q r")]
    items = [(7, "a b c d e f"), (8, "p q r"), (None, None), (9, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id) for r in find_contamination(frame, tests, min_words=5).collect()) == [(0, 7), (1, 7)]
    assert sorted((r.doc_id or 0, r.item_id) for r in find_contamination(frame, tests).collect()) == [(0, 7), (1, 7), (4, 8)]
    assert find_contamination(frame.limit(0), tests).collect() == []
    assert find_contamination(frame, tests.limit(0)).collect() == []


def test_given_documents_hold_what_a_search_for_exact_runs_finds(spark, sf_dir):
    import regex

    cut = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
    runs = {}
    for r in read("benchmark"):
        w = cut(r.text)
        for k in range(max(1, len(w) - 12)):
            runs.setdefault(tuple(w[k : k + 13]), set()).add(r.item_id)
    want = set()
    for r in read("documents"):
        w = cut(r.text)
        for k in range(len(w) - 12):
            want |= {(r.doc_id, i) for i in runs.get(tuple(w[k : k + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, sf_dir).collect()}
    assert want and want <= got and len(got) <= len(want) + 2


def test_many_candidates_in_one_text_take_time_in_proportion(spark):
    import re
    import time

    text = " ".join(f"w3 {1234500 + i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    (row,) = docs.select(pii.found(F.col("text"), "[0-9]+").alias("m")).collect()
    assert time.perf_counter() - start < 60
    want = [(text[max(0, m.start() - pii.CONTEXT) : m.start()], m.group(), m.start()) for m in re.finditer("[0-9]+", text)]
    assert [tuple(m) for m in row.m] == want


def test_a_long_item_is_compared_around_its_hits(spark):
    import random

    draw = random.Random(2)
    words = [f"w{draw.randrange(3000)}" for _ in range(2000)]
    changed = [w if i % 7 else "other" for i, w in enumerate(words)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = spark.createDataFrame([(7, " ".join(["x"] * 3 + words)), (8, " ".join(changed)), (9, " ".join(words[1500:1513]))], "doc_id long, text string")
    found = {r.doc_id: (r.equal_words, r.window_words, r.item_start, r.doc_start) for r in find_contamination(docs, items).collect()}
    assert found[7] == (13, 13, 0, 3) and found[8][:2] == (12, 13)  # a window between two changed words and one of them
    assert found[9] == (13, 13, 1500, 0) and set(found) == {7, 8, 9}


def test_items_of_one_to_four_words_must_agree_in_full(spark):
    items = spark.createDataFrame([(1, "alpha"), (2, "beta gamma"), (3, "one two three"), (4, "red green blue white"), (5, "")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "an Alpha here"), (2, "beta, gamma"), (3, "one two four three"), (4, "x red green blue white"), (5, "red green blue black"), (6, None),
    ], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in find_contamination(docs, items).collect()) == [(1, 1), (2, 2), (4, 4)]


def test_blocks_of_the_benchmark_are_not_held_together(spark, monkeypatch):
    """Many blocks leave no broadcast in the result's plan, seeds carry no words, and pieces, blocks and equal texts give the same pairs."""
    import random

    draw = random.Random(4)
    words = [f"w{draw.randrange(400)}" for _ in range(300)]
    items = [(i, " ".join(words[20 * i : 20 * i + 9 + i])) for i in range(12)] + [(50, " ".join(words)), (None, " ".join(words[:9])), (51, " ".join(words[:9])), (51, "q")]
    docs = [(i, " ".join(["x"] * i + words[10 * i : 10 * i + 40])) for i in range(25)] + [(None, " ".join(words)), (3, "q")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, find_contamination(frame, tests).collect()))
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 7, raising=False)
    parts = find_contamination(frame, tests, seed_rows=200)
    assert sorted(map(str, parts.collect())) == whole and len(whole) > 40
    assert sum(r.item_id is None for r in parts.collect()) == sum(r.item_id == 0 for r in parts.collect()) > 0
    plan = str(parts._jdf.queryExecution().executedPlan()).partition("Initial Plan")[0]
    assert plan.count("BroadcastExchange") <= 1  # of the ids alone
    pieces = decontaminate.test_pieces(tests.select("item_id", decontaminate.tokens(F.col("text")).alias("item")), 13)
    seeds = decontaminate.test_seeds(pieces, {w: masks_for(w, misses_of(w, 0.84)) for w in (1, 9, 10, 11, 12, 13)})
    assert all(kind in ("bigint", "int") for _, kind in seeds.dtypes)
    assert decontaminate.blocks_of(seeds, 200) > 4 and decontaminate.blocks_of(seeds, 100_000) == 1
