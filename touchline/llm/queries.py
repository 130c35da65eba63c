"""The registered queries of this subpackage: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    bpe_automaton, conversation_repair, decontamination, katz, language_id, parity_join, prefix_trie, quality_rules, secret_scan, suffix_dedup, token_counts,
    token_output, warc,
)
from touchline.llm.oracle import ORACLE_SQL  # noqa: F401
from touchline.llm.support import table
from touchline.session import scratch_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), keep=False)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language_id.identify(documents, language_id.fit(documents))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-store")
    token_output.write_token_store(table(spark, sf_dir, "documents"), folder)
    return token_output.token_digests(spark, folder)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_documents(table(spark, sf_dir, "documents"), keep=False)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), f"{folder}/archives")
    warc.write_index(spark, f"{folder}/archives", f"{folder}/index")
    return warc.read_index(spark, f"{folder}/index").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_components(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    learns = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    return katz.katz_scores(table(spark, sf_dir, "documents"), learns)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 6
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), sharing=conv - conv % 100, head=head)


QUERIES = {
    query.__name__: query
    for query in (
        op1_token_counts, op2_suffix_dedup, op3_secret_scan, op4_language_id, op5_token_output, op6_quality_rules, op7_bpe_automaton, op8_warc, op9_decontamination,
        op10_parity_join, op11_conversation_repair, op12_katz_scores, op13_prefix_trie,
    )
}
