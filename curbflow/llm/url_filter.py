"""URL rules by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import lower_ascii
from curbflow.operators import lookup_join

PREFIX_HEX = 8


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; without ``://`` empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_frame(spark, rules: list[Rule]) -> DataFrame:
    rows = [(r.host, r.path, r.verdict) for r in rules]
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def filter_urls(
    urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``urls``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its
    host and every subdomain, if the path of the url starts with the rule's
    path. Of several the longest wins (characters of host and path, then of
    the host, then block over allow). Without one, ``rule`` is null and the
    verdict ``default``: a list of hashes says nothing of what it lacks.

    Only the expressions that some rule could equal are formed: a url gives
    one for each pair of label count and path length that occurs in the
    rules. They meet the rules by equality of the first 32 bits of SHA-256
    (``lookup_join``: broadcast below a measured size, salted beyond), and
    a meeting counts only if the full digests agree.

    Null, empty and malformed urls have empty host and path and fit no rule.
    Equal rows are judged once and all returned; null ids are kept. Columns
    of ``urls`` beyond the two named are not looked at. Rules with a null or
    empty host, or a null path, are ignored; of equal rules block counts.
    """
    clean = (
        rules.where("host <> '' and path is not null and verdict in ('allow', 'block')")
        .select(lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), "verdict")
        .groupBy("r_host", "r_path").agg(F.max("verdict").alias("verdict"))
        .withColumn("digest", _digest(F.col("r_host"), F.col("r_path")))
    )
    shapes = [
        (r["labels"], r["chars"]) for r in clean.select(
            F.size(F.split("r_host", r"\.")).alias("labels"), F.length("r_path").alias("chars")
        ).distinct().orderBy("labels", "chars").collect()
    ]
    listed = clean.groupBy(F.substring("digest", 1, PREFIX_HEX).alias("prefix")).agg(
        F.collect_list(F.struct(
            "digest", (F.length("r_host") + F.length("r_path")).alias("chars"), F.length("r_host").alias("host_chars"),
            (F.col("verdict") == "block").alias("block"), F.concat("r_host", "r_path").alias("rule"), "verdict",
        )).alias("listed")
    )

    judged = urls.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    judged = judged.groupBy("id", "host", "path").agg(F.count(F.lit(1)).alias("copies"))
    labels = F.size(F.split("host", r"\."))
    digests = [
        F.when(
            (labels >= n) & (F.length("path") >= chars),
            _digest(F.substring_index("host", ".", -n), F.substring("path", 1, chars)),
        )
        for n, chars in shapes
    ]
    expressions = F.array_compact(F.array(*digests)) if digests else F.array().cast("array<string>")
    expanded = judged.select("*", F.explode_outer(expressions).alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_HEX)
    )
    met = lookup_join(expanded, listed, ["prefix"])
    confirmed = F.array_max(F.filter("listed", lambda r: r["digest"] == F.col("digest")).cast(
        "array<struct<digest:string,chars:int,host_chars:int,block:boolean,rule:string,verdict:string>>"
    ))
    best = met.select("id", "host", "path", "copies", confirmed.alias("c")).select(
        "id", "host", "path", "copies",
        F.when(F.col("c").isNotNull(), F.struct("c.chars", "c.host_chars", "c.block", "c.rule", "c.verdict")).alias("c"),
    ).groupBy("id", "host", "path", "copies").agg(F.max("c").alias("c"))
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("id").alias(id_col), "host", "path", F.col("c.rule").alias("rule"),
        F.coalesce("c.verdict", F.lit(default)).alias("verdict"),
    )
