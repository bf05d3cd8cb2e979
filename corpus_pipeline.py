"""Cleaning pipeline over documents: classify, line dedup, near-dedup, mix, pack.

Each stage takes (spark, docs, sf_dir), docs with the columns of documents, and
returns a DataFrame; all but the last return the columns of documents. A driver
writes each result as Parquet and reads it as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratecast.llm.classify import scored
from cratecast.llm.common import broadcast_checked, free_names, keep_ids, land, n_words, read
from cratecast.llm.jaccard import joined
from cratecast.llm.linededup import line_deduped
from cratecast.llm.mixing import mixed
from cratecast.llm.pack import packed

#: Near-duplicates are judged on five-word shingles at a similarity of 0.8 or more.
WORDS, PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score below its threshold)."""
    score, predicted = free_names(docs.columns, "score", "predicted")
    kept = scored(spark, docs, read(spark, sf_dir, "labels"), out=(score, predicted)).where(F.col(predicted) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks that an earlier one holds; n_chars follows.

    Copies of a text are shortened alike, so that the near-dedup still sees them as copies; documents that the
    removal leaves without a word are dropped."""
    return line_deduped(docs, alike=True).where((F.col("n_removed") == 0) | (n_words("text") > 0)).select(*docs.columns)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    groups = joined(docs, WORDS, PERCENT)
    gone = land(groups.where("doc_id <> component_id").select("doc_id").distinct(), "pipeline_gone")
    return keep_ids(docs, gone, "doc_id", how="left_anti").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, whole epochs and the sampled rest."""
    t_id, t_copies, t_copy, own = free_names(docs.columns, "t_id", "t_copies", "t_copy", "t_own")
    taken = mixed(docs).where("copies > 0").groupBy(F.struct("doc_id").alias(t_id)).agg(F.max("copies").alias(t_copies))
    taken = land(taken, "pipeline_copies")
    rows = docs.withColumn(own, F.struct("doc_id")).join(broadcast_checked(taken), F.col(own) == F.col(t_id))
    return rows.withColumn(t_copy, F.explode(F.sequence(F.lit(1), t_copies))).select(*[F.col(f"`{c}`") for c in docs.columns])


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every row of the mix."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_dedup),
    ("mixing sources to target weights", source_mixing),
    ("packing", length_packing),
]

#: SQL has no way to fit the classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each landed as Parquet in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
