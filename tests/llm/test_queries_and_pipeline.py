"""The registered queries against SQL, and the pipeline against brute force."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from curbflow.llm.oracle import ORACLE
from curbflow.llm.queries import QUERIES

import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_queries_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) and "pipeline" not in oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    want = sorted(map(str, cursor.fetchall()))
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want and want


def test_stages_take_effect_on_the_given_documents(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "mix" or docs.columns == COLUMNS
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "near_dedup":
            want = brute.near_duplicates([tuple(r) for r in before.select("doc_id", "text").collect()], 5)
            assert kept[name] == {i for i, (_, c) in want.items() if i == c}
        if name == "redact_pii":
            assert kept[name] == kept["decontaminate"]
            for r in docs.collect():
                assert brute.base_spans(r.text) == "" and r.n_chars == len(r.text)
    assert kept["mix"] == kept["redact_pii"] and len(kept["decontaminate"]) < len(kept["near_dedup"])


def test_stages_on_odd_rows(spark, sf_dir, tmp_path):
    good = "the house and the garden of the man with the dog in the evening"
    rows = [(1, good, "en", "a", 5), (2, good, "en", "a", 5), (2, good, None, "a", None), (None, good + " x", "en", None, 1), (3, None, "en", "b", 0),
            (4, "", None, "b", 0), (5, "123", "de", "b", 3), (6, "mail me at a@b.example or " + " ".join(reversed(good.split())), "en", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("x"))
    for n, frame in enumerate((docs, docs.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, frame, sf_dir).write.parquet(f"{tmp_path}/{n}{name}")
            frame = spark.read.parquet(f"{tmp_path}/{n}{name}")
            assert name == "mix" or frame.columns == docs.columns
            if name == "redact_pii" and n == 0:
                assert sorted((r.doc_id or 0, "[PII]" in r.text) for r in frame.collect()) == [(0, False), (1, False), (6, True)]
        assert frame.count() == (3 if n == 0 else 0)


def test_columns_named_like_the_pipelines_own_come_back_unchanged(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    for step, names in ((corpus_pipeline.decontaminate, ["_row_key"]), (corpus_pipeline.redact_pii, ["_text_key", "_spans"])):
        named = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
        kept = step(spark, named, sf_dir)
        assert kept.columns == named.columns
        rows = kept.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_workers_give_back_what_a_task_has_freed(spark, monkeypatch):
    from types import SimpleNamespace

    from curbflow.llm import common

    resident = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
    held = [bytes(1000) for _ in range(200_000)]
    last, full = held[-1], resident()
    del held  # the block behind all others is still in use
    common.give_back()
    assert len(last) == 1000 and full - resident() > 100 << 20

    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append("given back"))
    frame = SimpleNamespace(sparkSession=spark, mapInArrow=lambda fn, schema: fn)
    task = common.map_arrow(frame, lambda batches: (b for b in batches), "x long")
    for batch in task(iter([1, 2])):
        seen.append(batch)
    assert seen == [1, 2, "given back"]
