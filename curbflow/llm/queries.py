"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.common import crc_mod, shared_table_path
from curbflow.llm.conversation_repair import damage_conversations, repair_conversations
from curbflow.llm.decontaminate import find_contamination
from curbflow.llm.embedding_dedup import near_vectors
from curbflow.llm.language_id import identify_languages
from curbflow.llm.lm_scoring import score_texts
from curbflow.llm.mixing import mix_sources
from curbflow.llm.near_dedup import near_duplicates
from curbflow.llm.pii import find_pii
from curbflow.llm.substring_dedup import remove_repeats
from curbflow.llm.token_alignment import align_tokens
from curbflow.llm.token_files import read_token_files, write_token_files
from curbflow.llm.url_filter import Rule, filter_urls, rule_frame
from curbflow.llm.warc import read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The rules that the url query is asked to apply.
URL_RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_lm_scoring(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)


@query
def op2_language_id(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 4) == 2)


@query
def op3_source_mix(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op4_embedding_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), rule_frame(spark, URL_RULES))


@query
def op6_decontaminate(spark, sf_dir):
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_warc_archive(spark, sf_dir):
    path = shared_table_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).drop("url")


@query
def op8_minhash_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


@query
def op9_repeated_passages(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query
def op10_pii(spark, sf_dir):
    return find_pii(table(spark, sf_dir, "documents")).drop("all_spans", "text_key")


@query
def op11_token_files(spark, sf_dir):
    path = shared_table_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)


@query
def op12_token_alignment(spark, sf_dir):
    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokens(table(spark, sf_dir, "documents"), *files)[0]


@query
def op13_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return repair_conversations(rows, damage_conversations(rows))
