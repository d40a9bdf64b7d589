"""Registered queries of this package: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import contamination, conversation_oracles, fingerprints, language, licenses, lines, minhash, mixing, oracles, personal, quality, repair, secrets, sentencepieces, trie
from .common import read


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates over four-word shingles at Jaccard 0.8."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, percent=80)


def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of its sources."""
    return mixing.mix(read(spark, sf_dir, "documents", "doc_id", "source"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text; a document is a repository, its source the owner."""
    return secrets.secrets(read(spark, sf_dir, "documents", "doc_id", "source", "text")).drop("verdicts")


def op4_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return fingerprints.edited_likeness(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text."""
    return language.languages(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every text."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return contamination.contamination(docs, read(spark, sf_dir, "benchmark", "item_id", "text")).drop("hit_spans")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in every text."""
    return licenses.licenses(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line deduplication by source leaves of every text."""
    return lines.report(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text."""
    return personal.personal_data(read(spark, sf_dir, "documents", "doc_id", "text")).drop("n_iban", "n_social", "scores")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations."""
    return trie.conversation_trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every text, and the text of these ids."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return sentencepieces.digests(sentencepieces.decode(sentencepieces.encode(docs, model), model))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after the damage."""
    return repair.repairs(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_pfair_mixing, op3_secret_scan, op4_scaled_fingerprints, op5_language_id,
        op6_decontamination, op7_license_scan, op8_line_dedup, op9_quality, op10_personal_data, op11_prefix_trie, op12_sentencepiece, op13_conversation_repair,
    )
}
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op2_pfair_mixing": oracles.MIXING,
    "op3_secret_scan": oracles.SECRETS,
    "op6_decontamination": oracles.CONTAMINATION,
    "op7_license_scan": oracles.LICENSES,
    "op8_line_dedup": lines.ORACLE,
    "op10_personal_data": oracles.PERSONAL,
    "op11_prefix_trie": conversation_oracles.TRIE,
    "op13_conversation_repair": conversation_oracles.REPAIR,
}
