"""The training-data pipeline over ``documents``: each stage reads what the one before it kept.

Toxic documents go; repeated lines go (their first place stays); one document of
each group of near copies stays; sources are mixed to their target weights, so
a document may stand up to three times or not at all; what is left is encoded.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm import line_dedup, minhash, mixing, queries, toxicity
from tickflow.llm.bpe import Tokenizer
from tickflow.llm.common import written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.toxicity(docs, model) < queries.TOXIC_FROM)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated lines."""
    return line_dedup.dedup_lines(docs, dropped="__dropped").select(*docs.columns)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, as one row; rows without id stay.

    Rows that share an id but not the text are documents of their own. The text with the smallest hash goes by the id, the
    others by numbers above all ids, so they stay only if their group has no other document. Of equal documents the first
    row in the order of the other columns stays.
    """
    unknown = docs.filter("doc_id is null")
    known = docs.filter("doc_id is not null")
    marks = known.select("doc_id", F.xxhash64("text").alias("__mark"))
    several = marks.groupBy("doc_id").agg(F.min("__mark").alias("__first"), F.max("__mark").alias("__last")).filter("__first < __last")
    several = written(several.select(F.col("doc_id").alias("__id"), "__first"), "shared-ids")
    node = F.col("doc_id").cast("long")
    if not several.isEmpty():
        known = known.join(several, F.col("doc_id") == F.col("__id"), "left")
        other = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        node = F.when(F.coalesce(F.xxhash64("text") == F.col("__first"), F.lit(True)), node).otherwise(other)
        known = written(known.select(*docs.columns, node.alias("__node")), "known")
        node = F.col("__node")
    known = known.select(*docs.columns, node.alias("__node"))
    kept = minhash.near_duplicates(known.select(F.col("__node").alias("doc_id"), "text")).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    rest = ", ".join(f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")) or "doc_id"
    known = known.join(kept, F.col("__node") == F.col("__kept"), "left_semi")
    first = known.selectExpr("*", f"row_number() over (partition by __node order by {rest}) __nth").filter("__nth = 1")
    return first.select(*docs.columns).union(unknown)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.encoded_digests(docs, Tokenizer(spark, queries.tokenizer_path()))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("minhash near-dedup", minhash_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: A trained model, hashed signatures, random rounding and BPE are not SQL; tests/llm holds each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; what a stage keeps is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
