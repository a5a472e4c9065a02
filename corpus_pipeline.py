"""From raw documents to encoded training text: five stages, each over all that the one before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.llm import decontaminate, line_dedup, minhash, pieces, quality, simhash
from mediacat.llm.tables import table
from mediacat.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = quality.apply_rules(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*docs.columns)


def line_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share; one that had nothing else goes."""
    found = line_dedup.without_shared_lines(docs)
    return found.where("n_removed = 0 or text rlike '\\\\S'").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8), the document with the smallest id.

    The near copies that SimHash finds (op1's operator, over five words) are verified by their sets of five words. What is
    similar but further apart in its fingerprint is met by MinHash and verified in the same way.

    Rows are numbered as they are stored, so the documents must come from a table or another source of fixed order.
    """
    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    texts = rows.select(F.col("__row").alias("row"), "text")
    near = simhash.near_copies(texts, "row", "text", shingle=minhash.SHINGLE)
    met = near.where("doc_id <> component_id").select(F.col("doc_id").alias("row"), F.col("component_id").alias("other"))
    found = minhash.components(texts, met=met)
    named = rows.select(F.col("__row").alias("row"), "doc_id").join(found, "row")
    # A row without an id is kept only if no row of its group has one.
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    return rows.join(first.select(F.col("first.row").alias("__row")), "__row", "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without test items: long or many hits remove a document, short ones are cut out."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the numbers of their pieces; small slices, since the workers hold what earlier stages left."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(docs, path, keep=["doc_id", "lang", "source"], slice_bytes=2 << 20)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_removal),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The quality score, fingerprints and pieces have no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
