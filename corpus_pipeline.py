"""From raw documents to packed sequences, in five stages.

Each stage is written as Parquet in the shared folder and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolside.llm import near_sets, packing, pii, suffixes, toxicity
from poolside.llm.common import fresh_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go. Labels are joined to the raw documents."""
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; groups are linked by a Jaccard similarity of 0.8 or more of their 5-word shingles.

    SimHash prints of these shingles give the candidates, which are verified; an exact filter adds the pairs that the prints miss.
    """
    return near_sets.first_of_each_group(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that a smaller id has are cut out; documents of which nothing is left go.

    A cut inside a character drops the rest of that character.
    """
    cut = suffixes.remove_repeated(docs, keep_text=True, carry=True, whole_characters=True).where((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_bytes") == 0))
    rows = cut.select(F.col("kept").cast("string").alias("text"), "rest.*")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind; every document stays."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("simhash", without_near_duplicates),
    ("suffix_dedup", without_repeated_passages),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Neither fingerprints, learned scores nor tokens can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
