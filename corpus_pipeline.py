"""Corpus pipeline: language, near duplicates, benchmark passages, personal data, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's documents. All but the last return the columns that ``docs`` has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.common import shared_table_path, stage
from curbflow.llm.decontaminate import find_contamination
from curbflow.llm.language_id import UNDETERMINED, fit_languages, predict_language
from curbflow.llm.mixing import mix_sources
from curbflow.llm.near_dedup import near_duplicates
from curbflow.llm.pii import find_pii, redact
from curbflow.operators import lookup_join
from curbflow.operators.lookup import fits_broadcast

MIN_LANGUAGE_SCORE = 0.5
BROADCAST_IDS = 2_000_000

# SQL can't express byte context trees, learned contexts or seeded blocks; tests compare with brute force.
ORACLE_SQL = None


def _free(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that the documents don't use."""
    used = {c.lower() for c in docs.columns}
    while name in used:
        name += "_"
    return name


def _without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose key isn't in ``gone``: texts stay where they are while the keys are few."""
    gone = stage(gone, "pipeline-gone")  # measured and joined: computed once
    few = fits_broadcast(gone, BROADCAST_IDS)
    return docs.join(F.broadcast(gone) if few else gone, key, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the predicted language into ``lang``; texts without letters or without a clear language go."""
    trees = fit_languages(docs.select("lang", "text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    found = predict_language(rows, trees, ["row"])
    sure = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return sure.select(*[
        F.col("lang_pred").alias("lang") if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns
    ])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of every near-duplicate group, and of rows with one id one."""
    judged = near_duplicates(docs.select("doc_id", "text"))
    left = _without(docs, judged.where("not kept").select("doc_id").distinct(), "doc_id")
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if not again:
        return left
    return left.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(left.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a passage of the benchmark; rows without an id are told apart by text."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.sha2(F.coalesce("text", F.lit("")), 256)))
    key = _free(docs, "_row_key")
    keyed = docs.withColumn(key, own)
    hits = find_contamination(keyed.select(key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    return _without(keyed, hits.select(key).distinct(), key).select(*[F.col(f"`{c}`") for c in docs.columns])


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by ``[PII]``; ``n_chars`` follows the text. No document goes."""
    found = find_pii(docs.select("doc_id", "text")).where(F.size("all_spans") > 0)
    key, marks = _free(docs, "_text_key"), _free(docs, "_spans")
    spans = found.groupBy(F.col("text_key").alias(key)).agg(F.first("all_spans").alias(marks))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    marked = lookup_join(keyed, spans, [key])
    clean = F.when(F.col(marks).isNotNull(), redact(F.col("text"), F.col(marks))).otherwise(F.col("text"))
    changed = {"text": clean, "n_chars": F.when(F.col(marks).isNotNull(), F.length(clean)).otherwise(F.col("n_chars")).cast("bigint")}
    return marked.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each remaining document the mix takes."""
    return mix_sources(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = shared_table_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
