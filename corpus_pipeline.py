"""From raw documents to packed sequences, stage by stage.

Each stage is one operator on everything that the stage before kept; its result is written as Parquet and read again. All
stages but the last return the columns of ``documents``.

Cases: a null or empty text is judged, compared, mixed and packed as an empty one; of rows that share a key and a text one
stays after exact dedup; rows without a key stay unless an equal text has one; of linked near copies the smallest key stays;
a null language or source is a value of its own; very long texts are read whole by every stage; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import exactdedup, mixing, packing, perplexity, simhash
from tabforge.runtime import new_path

ORACLE_SQL = None
SEQUENCE = 2048


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above their language's threshold."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "quality", "toxic")
    rest = F.struct(*[f"`{c}`" for c in docs.columns if c not in ("doc_id", "text", "lang")]).alias("others")
    judged = perplexity.judge(docs.select("doc_id", "text", "lang", rest), labels, carry=["others", "text"])
    return judged.where("kept").select("doc_id", "text", "lang", "others.*").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exactdedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of 4-word shingles within 4 differing bits link."""
    return simhash.drop_near_duplicates(docs, shingle=4, distance=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences."""
    vocabulary, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.pack(docs, vocabulary, ranks, SEQUENCE)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
