"""From raw documents to packed training sequences: rules, toxicity, near-duplicates, packing.

Each stage takes what the one before kept, as a table with the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from xmlindex.llm import near_dedup, packing, quality, toxicity
from xmlindex.llm.queries import END_ID, SEQUENCE, TOKENIZER, TOXIC_FROM
from xmlindex.llm.support import bound_batches, table
from xmlindex.session import materialize, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and their host's verdict."""
    ship_package()
    return quality.keep_documents(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; learned from the labels of what came in."""
    ship_package()
    bound_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity_score(model) < TOXIC_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    ship_package()
    bound_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in sequences."""
    ship_package()
    bound_batches(spark)
    packed = packing.pack_texts(docs.select("doc_id", "text"), TOKENIZER, capacity=SEQUENCE, end_id=END_ID)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near duplicates", near_duplicates),
    ("best-fit packing", best_fit_packing),
]

# A trained model and a genetic search are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
