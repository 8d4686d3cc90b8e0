"""Near duplicates, near-equal vectors, repeated passages and components against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.llm import blocks, near_dedup
from curbflow.llm.components import connected_components
from curbflow.llm.embedding_dedup import hadamard, near_vectors, tables_for
from curbflow.llm.near_dedup import near_duplicates
from curbflow.llm.queries import QUERIES
from curbflow.llm.substring_dedup import remove_repeats

import brute


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(7, 7), (None, 3), (50, 50)]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 400)}}
    assert connected_components(df.limit(0), "a", "b").collect() == []


def edited(rng, base, count, vocabulary):
    out = base.split()
    for _ in range(count):
        out[rng.randrange(len(out))] = rng.choice(vocabulary)
    return " ".join(out)


@pytest.fixture(scope="module")
def copies():
    """Copies at all distances around the threshold, short texts, repeats and blanks."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for size in (6, 12, 60, 200):
        base = " ".join(rng.choice(vocabulary) for _ in range(size))
        texts += [base, base.upper(), base.replace(" ", "\n")] + [edited(rng, base, rng.randrange(size // 8 + 2), vocabulary) for _ in range(25)]
    texts += ["a b", "a b", "A  b ", "a", "", None, " \t", None, "x " * 30, "x " * 60, "é ü " * 9]
    return list(enumerate(texts, start=10))


@pytest.mark.parametrize("size, block", [(4, 1024), (5, 3)])
def test_near_duplicates_equal_brute_force(spark, copies, monkeypatch, size, block):
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block * 100)
    docs = spark.createDataFrame(copies, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("key", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, shingle=size).collect()}
    assert got == brute.near_duplicates(copies, size)


def test_near_duplicates_of_odd_ids(spark):
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (5, "k l m n o p"), (5, "a b c d e f"), (6, "k l m n o p")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got.collect()) == [
        (0, None, True), (2, 2, True), (2, 2, True), (5, 2, False), (5, 2, False), (6, 2, False),
    ]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_blocks_bring_every_pair_together_once(spark):
    members = spark.createDataFrame([(g, i) for g, n in ((1, 2), (2, 37), (3, 1)) for i in range(n)], "grp int, id long")
    rows = blocks.block_members(members, "grp", F.col("id"), F.lit(1), 5).collect()
    met = set()
    units = {}
    for r in rows:
        units.setdefault((r._group, r._i, r._j), []).append((r.id, r._b))
    for (group, i, j), held in units.items():
        for a, x in held:
            for b, y in held:
                if a < b and (i == j or x != y):
                    assert (group, a, b) not in met
                    met.add((group, a, b))
    assert len(met) == 1 + 37 * 36 // 2 and {g for g, _, _ in met} == {1, 2}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(9)
    rows = []
    for label in (0, 1, None):
        for base in rng.standard_normal((6, 24)):
            for spread in (0.0, 0.0, 0.05, 0.15, 0.2, 0.21, 0.3):
                rows.append(((base + spread * rng.standard_normal(24)).tolist(), label))
    rows += [(None, 0), ([], 0), ([0.0] * 24, 0), ([None] + [1.0] * 23, 0), ([float("nan")] + [1.0] * 23, 0), ([float("inf")] * 24, 1)]
    rows += [([1.0] * 24, 1), ([3.0] * 24, 1), ([1.0] * 8, 1), ([2.0] * 8, 1)]
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("hashes", [None, 2])
def test_near_vectors_equal_brute_force(spark, vectors, hashes):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df, hashes=hashes).collect()}
    assert got == brute.near_vectors(vectors, 0.98)


def test_near_vectors_of_odd_ids(spark):
    one, other = [1.0, 0.0], [0.0, 1.0]
    rows = [(None, one, 1), (3, one, 1), (3, one, 1), (4, other, 1), (3, other, 1), (9, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect())
    assert got == [(0, 0, None, True), (3, 1, 3, True), (3, 1, 3, True), (3, 1, 3, True), (4, 1, 3, False), (9, 0, 9, True)]
    assert near_vectors(df.limit(0)).collect() == []


def test_rotation_is_orthogonal_and_tables_grow_with_hashes():
    x = np.random.default_rng(1).standard_normal((5, 16))
    assert np.allclose(hadamard(x) @ hadamard(x).T, 16 * x @ x.T)
    assert 4 <= tables_for(64, 1, 0.98) <= tables_for(64, 3, 0.98) < 200


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "\u3042"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, twin = text(60), text(45)
    texts = [text(80), shared + " " + text(30), text(10) + " " + shared, text(25) + "\n" + shared[:150] + "\t" + text(25), twin, twin, twin + " end"]
    texts += ["a " * 70, "b c " * 30, None, "", text(19), text(20), " ".join([text(5)] * 12), shared + " " + shared, twin.upper()]
    return list(enumerate(texts))


@pytest.mark.parametrize("shards", [1, 5])
def test_repeats_equal_brute_force(spark, passages, shards):
    docs = spark.createDataFrame(passages, "doc_id long, text string").withColumn("digest", F.lit("x")).repartition(3)
    rows = remove_repeats(docs, shards=shards).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == brute.repeats(passages, 20)
    for r in rows:
        if r.n_removed:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_repeats_of_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(30))
    rows = [(4, long), (4, long), (None, long), (4, "short text"), (4, "short text"), (None, None)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 0, 0), (0, 30, 30), (4, 2, 0), (4, 2, 0), (4, 30, 0), (4, 30, 30)]
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeats_query_on_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in QUERIES["op9_repeated_passages"](spark, sf_dir).collect())
    assert got == brute.repeats([tuple(r) for r in rows], 20)
