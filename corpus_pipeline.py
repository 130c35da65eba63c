"""A corpus from raw documents to token ids.

Each stage is one operator of touchline.llm over all that the one before kept, and is stored before the next one reads
it: quality rules drop junk, the n-gram Jaccard join leaves one document of each near-duplicate group, decontamination
drops documents that hold benchmark passages, the secret scan replaces secrets, and BPE turns the texts into ids.

All stages: an empty table gives an empty one, rows are told apart by id and text, a NULL id is kept like any other, and
columns of any name ride along to the last stage, which has its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import bpe_automaton, decontamination, parity_join, quality_rules, secret_scan
from touchline.llm.support import stored, table

# What counts as a near duplicate in a corpus; the query of the join alone has its own contract (3 words, 90 %).
NEAR_WORDS = 5
NEAR_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. A NULL or empty text has no words and fails; equal rows fare alike."""
    return quality_rules.quality(docs, table(spark, sf_dir, "labels"), keep_columns=True)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group; rows equal in id and text count once.

    NULL, empty and blank texts are near nothing and stay, as do rows without an id."""
    return parity_join.one_of_each_text(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item. A NULL or empty text holds none."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced and n_chars counted anew. A NULL text stays NULL."""
    return secret_scan.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, decoded text and digests of every row; a NULL or empty text has no ids."""
    return bpe_automaton.encode_documents(docs)


STAGES = [
    ("quality rules", keep_good), ("near duplicates", keep_one_of_each), ("decontamination", keep_uncontaminated),
    ("secret scan", replace_secrets), ("bpe encoding", encode),
]

ORACLE_SQL = None  # the token ids and the hashed likelihood ratios have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
