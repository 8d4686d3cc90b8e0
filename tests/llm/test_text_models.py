"""Language by byte contexts and language-model scores: held-out accuracy, exact parts by brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.llm import lm_scoring
from curbflow.llm.common import crc_mod
from curbflow.llm.language_id import ByteTree, Scorer, fit_languages, identify_languages, letters
from curbflow.llm.lm_scoring import END, Counts, MaxEnt, score_texts
from curbflow.llm.queries import QUERIES


def test_code_lengths_are_those_of_a_distribution():
    data = b"   abracadabra abracadabra banana"
    codes = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
    grams = (codes[:-3] << 24) | (codes[1:-2] << 16) | (codes[2:-1] << 8) | codes[3:]
    unique, n = np.unique(grams, return_counts=True)
    tree = ByteTree(unique, n.astype(float))
    for context in (b"abr", b"zzz", b"xab", b"yya"):
        every = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], dtype=np.int64)
        assert 0.2 < np.exp2(-tree.bits(every)).sum() <= 1 + 1e-9
    assert tree.bits(np.array([int.from_bytes(b"abra", "big")])) < 1 < 8 < tree.bits(np.array([int.from_bytes(b"abrz", "big")]))


def test_totals_sum_the_bytes_of_each_text_alone():
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(97, 105, (300, 4)) @ np.array([1 << 24, 1 << 16, 1 << 8, 1]))
    scorer = Scorer({"a": ByteTree(grams, np.ones(len(grams))), "b": ByteTree(grams[:50], np.ones(50))})
    texts = [b" abc ", b" ", b" hgfedcba zzz ", " é ".encode()]
    together = scorer.totals(texts)
    for i, text in enumerate(texts):
        assert scorer.totals([text])[0] == pytest.approx(together[i])
        padded = b"   " + text
        every = np.array([int.from_bytes(padded[k : k + 4], "big") for k in range(len(text))], dtype=np.int64)
        assert [t.bits(every).sum() for t in scorer.trees] == pytest.approx(together[i].tolist())


def test_held_out_languages_are_found(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if got[r.doc_id].held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held) > 0
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_rows(spark):
    rows = [(1, "the cat sat on the mat " * 20, "en", "x"), (2, "der hund und die katze " * 20, "de", "x"), (3, None, "en", "x"),
            (4, "1234 !!! ___", "de", "x"), (5, "the mat", None, "x"), (None, "die katze", None, "x"), (7, "", None, None), (1, "the hund", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = identify_languages(docs, F.lit(False)).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 2, 3, 4, 5, 7]
    found = {(r.doc_id, r.lang_pred) for r in got if r.doc_id != 1}
    assert found == {(None, "de"), (2, "de"), (3, "und"), (4, "und"), (5, "en"), (7, "und")}
    assert {r.lang_pred for r in got if r.doc_id == 1} <= {"en", "de"}
    assert {r.score for r in got if r.lang_pred == "und"} == {0.0}
    unlearned = identify_languages(docs, F.lit(True)).collect()
    assert {r.lang_pred for r in unlearned} == {"und"} and len(unlearned) == len(rows)
    assert identify_languages(docs.limit(0), F.lit(False)).collect() == []
    assert fit_languages(docs.where("lang is null")) == {}
    assert letters("Ab1é!") == " ab é ".encode() and letters("12") == b"" and letters(None) == b""


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def base_of(rows, held):
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    return {i: (len(tokens(t)), sum(w in counts for w in tokens(t)), total, sum(
        math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens(t)
    )) for i, t in rows}


@pytest.mark.parametrize("table_words", [1 << 20, 500])
def test_base_scores_are_exact_and_the_model_is_better(spark, sf_dir, table_words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = base_of(rows, lambda i: zlib.crc32(str(i).encode()) % 5 == 1)
    got = score_texts(docs.withColumn("key", F.lit("x")), crc_mod(F.col("doc_id"), 5) == 1, table_words=table_words).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
    held = [r for r in got if r.held_out]
    if table_words > 500:
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    hashes = np.sort(rng.integers(1, 1 << 63, 3000, dtype=np.uint64))
    counts = rng.integers(1, 500, len(hashes))
    ranks = np.argsort(np.argsort(-counts, kind="stable"), kind="stable")
    table = Counts(int(counts.sum()), len(hashes), hashes, counts, ranks)
    model = MaxEnt(table)
    model.class_weights[:] = rng.standard_normal(model.class_weights.shape) * 0.3
    model.word_weights[:] = rng.standard_normal(model.word_weights.shape) * 0.3
    here = np.append(hashes, END)
    raw = [np.full(len(here), v, dtype=np.uint64) for v in (5, 6, 7)]
    ranks = np.append(ranks, 1 << 30)
    logs = model.log_probs(raw, ranks)
    rare = np.append(counts + 0.5, 0.5) / model.rare_mass
    chance = np.exp(logs) * np.where(ranks < lm_scoring.CLASSES * lm_scoring.SLOTS, 1, rare)
    assert chance.sum() == pytest.approx(1, abs=1e-4)


def test_scores_of_odd_rows(spark):
    rows = [(1, "A b\tc"), (2, None), (3, ""), (None, "a B z"), (1, "A b\tc"), (4, "x " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.coalesce(F.col("doc_id") == 4, F.lit(False))
    got = score_texts(docs, held).collect()
    want = base_of([(n, t) for n, (_, t) in enumerate(rows)], lambda n: n == 5)
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == sorted((n, k, round(b, 6)) for n, k, _, b in want.values())
    assert all(math.isfinite(r.score) for r in got)
    assert score_texts(docs.limit(0), F.lit(False)).collect() == []
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in score_texts(docs, F.lit(True)).collect())


def test_segment_sums_are_plain_sums():
    rng = np.random.default_rng(6)
    keys = np.minimum(rng.geometric(0.02, 3000), 200).astype(np.uint16)
    values = rng.standard_normal((3000, 5))
    order = np.argsort(keys, kind="stable")
    rows, first = np.unique(keys[order], return_index=True)
    want = np.stack([values[keys == r].sum(axis=0) for r in rows])
    assert np.allclose(lm_scoring._segment_sums(values, order, first), want)


def test_rows_of_weights_are_averaged_over_their_own_tokens(spark):
    """A feature that one task alone sees keeps what the task learned, whatever the other tasks read."""
    rare, common = "the red fox runs home " * 40, "many other words stand here " * 400
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string").repartitionByRange(len(texts), "text")
    words = sorted({t for x in (rare, common) for t in tokens(x)})
    hashes = np.array(lm_scoring.token_hashes([" ".join(w.decode() for w in words if w)])[0])
    order = np.argsort(hashes)
    counts = Counts(2225, len(hashes), hashes[order], np.full(len(hashes), 200), order.astype(np.int64))
    alone = lm_scoring.train(frame([rare]), MaxEnt(counts))
    other = lm_scoring.train(frame([common]), MaxEnt(counts))
    both = lm_scoring.train(frame([rare, common]), MaxEnt(counts))
    for name in ("class_weights", "word_weights"):
        a, b, c = (getattr(m, name) for m in (alone, other, both))
        own = a.any(axis=1) & ~b.any(axis=1)
        assert own.sum() >= 5 and np.array_equal(c[own], a[own])


def test_long_text_is_scored_in_bounded_memory_and_alike():
    import pickle
    import tracemalloc

    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(97, 105, (300, 4)) @ np.array([1 << 24, 1 << 16, 1 << 8, 1]))
    scorer = pickle.loads(pickle.dumps(Scorer({"a": ByteTree(grams, np.ones(len(grams))), "b": ByteTree(grams[:50], np.ones(50))})))
    text = b" " + bytes(rng.integers(97, 106, 8 << 20).astype(np.uint8)) + b" "
    tracemalloc.start()
    long = scorer.totals([b" ab ", text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20  # the whole text at once held over 500 MB
    padded = np.frombuffer(b"   " + text, dtype=np.uint8).astype(np.int64)
    every = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    assert [t.bits(every).sum() for t in scorer.trees] == pytest.approx(long[1].tolist(), rel=1e-9)


def test_every_word_of_the_table_has_an_output_of_its_own(spark, monkeypatch):
    """Beyond 1,024 words the grid of classes and slots grows; it was fixed at 32 by 32."""
    seen = []
    monkeypatch.setattr(lm_scoring, "train", lambda texts, model: seen.append(model) or model)
    words = [f"w{i}" for i in range(1500)]
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 50])) for i in range(0, 1500, 10)], "doc_id long, text string")
    got = score_texts(docs, F.lit(False)).collect()
    model = seen[0]
    assert len(got) == 150 and model.classes * model.slots >= 1501
    assert int((model.counts.ranks < model.classes * model.slots).sum()) == 1501


def test_model_probabilities_sum_to_one_over_a_grown_grid():
    rng = np.random.default_rng(7)
    hashes = np.sort(rng.integers(1, 1 << 63, 3000, dtype=np.uint64))
    counts = rng.integers(1, 500, len(hashes))
    ranks = np.argsort(np.argsort(-counts, kind="stable"), kind="stable")
    model = MaxEnt(Counts(int(counts.sum()), len(hashes), hashes, counts, ranks), words=len(hashes))
    assert model.classes * model.slots >= 3000
    model.class_weights[:] = rng.standard_normal(model.class_weights.shape) * 0.3
    model.word_weights[:] = rng.standard_normal(model.word_weights.shape) * 0.3
    raw = [np.full(len(hashes) + 1, v, dtype=np.uint64) for v in (5, 6, 7)]
    logs = model.log_probs(raw, np.append(ranks, 1 << 30))
    chance = np.exp(logs) * np.append(np.ones(len(hashes)), 0.5 / model.rare_mass)
    assert chance.sum() == pytest.approx(1, abs=1e-4)


def test_training_broadcast_leaves_out_zero_weights_of_a_grown_grid():
    import pickle

    rng = np.random.default_rng(8)
    hashes = np.sort(rng.integers(1, 1 << 63, 60000, dtype=np.uint64))
    counts = rng.integers(1, 500, len(hashes))
    ranks = np.argsort(np.argsort(-counts, kind="stable"), kind="stable")
    model = MaxEnt(Counts(int(counts.sum()), len(hashes), hashes, counts, ranks), words=len(hashes))
    weights = model.class_weights.nbytes + model.word_weights.nbytes
    assert len(pickle.dumps(lm_scoring.shipped(model))) < weights / 4
    model.word_weights[3, 1] = 0.5
    assert lm_scoring.shipped(model) is model
