"""Corpus pipeline: toxicity, near copies, benchmark passages, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  Where SQL can't express a stage (toxicity is fitted, tokens need the
tokenizer), tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm.decontaminate import without_contaminated
from seriesloom.llm.mixing import mixed_documents
from seriesloom.llm.ngram_join import ngram_jaccard
from seriesloom.sources.tables import last_table_only, written
from seriesloom.llm.token_ids import tokenized
from seriesloom.llm.toxicity import train, without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on ``labels``, doesn't reject.

    Rows without a text or without words stay; repeated rows are judged alike; without labels of
    both kinds all rows stay.
    """
    return without_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal and near texts: the one with the smallest id, then the
    smallest hash of the text; rows without an id come last.

    Groups are of texts, so rows that share an id but not a text are told apart, and rows without
    an id are in the group of their text.  Rows without words are in no group and all stay.
    """
    found = ngram_jaccard(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("row_key").alias("text_hash"))
    found = found.select("group_key", rank.alias("kept_rank"))
    kept = found.filter(F.col("group_key").isNotNull()).groupBy("group_key").agg(F.min("kept_rank").alias("kept_rank")).select("kept_rank", F.lit(True).alias("once"))
    kept = kept.unionByName(found.filter(F.col("group_key").isNull()).select("kept_rank", F.lit(False).alias("once")).distinct())
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"), F.xxhash64("text").alias("text_hash"))
    rows = docs.select(F.struct(*docs.columns).alias("kept_row"), own.alias("row_rank"))
    rows = rows.join(kept, rows.row_rank == kept.kept_rank)
    # rows that repeat the kept one stand for one document; this reuses the join's partitioning
    rows = rows.withColumn("row_number", F.row_number().over(Window.partitionBy("row_rank").orderBy("row_rank")))
    return rows.filter((F.col("row_number") == 1) | ~F.col("once")).select("kept_row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window; rows without a text or without words stay."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, in order of its slots: each document once for every pass over its source that takes
    it, the last one cut where the pass ends.

    Rows without words aren't taken; a null source is a source; repeated rows are documents of their own.
    """
    return mixed_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards, read back: (doc_id, start, n_tokens, ids_crc32) of every row, rows without an id first."""
    return tokenized(spark, docs)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", one_of_each_group), ("decontamination", drop_contaminated), ("mixing", mix_sources), ("token_ids", write_token_ids)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with last_table_only(spark):  # a stage's own tables go once its rows are written
            docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
