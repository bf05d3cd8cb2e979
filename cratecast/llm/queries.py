"""Registered queries op1 to op13: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .classify import held_out, scored
from .common import read
from .html import extracted
from .jaccard import joined
from .linededup import line_deduped
from .mixing import mixed
from .neardup import near_duplicates
from .pack import packed
from .ranked import search
from .shard import sharded
from .suffix import repeats
from .topk import top_k
from .urlfilter import judged, rules_frame
from .vectorcode import encoded


def op1_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read(spark, sf_dir, "pages"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(read(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(read(spark, sf_dir, "documents"))
    # the target is rounded to 6 digits for comparison with SQL
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "copies", "taken")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(read(spark, sf_dir, "documents"))


def op6_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def op7_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(spark, docs, read(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_deduped(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def op9_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(spark, read(spark, sf_dir, "documents"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "embeddings"))


#: The rules that the query applies.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(read(spark, sf_dir, "pages").select("page_id", "url"), rules_frame(spark, URL_RULES))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_html_templates, op2_embedding_near_dedup, op3_ngram_jaccard, op4_source_mixing, op5_suffix_dedup, op6_length_packing, op7_quality_knn, op8_line_dedup, op9_shard_lookup, op10_exact_topk, op11_vector_codes, op12_url_filter, op13_ranked_search)
}
