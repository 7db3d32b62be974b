"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.collocations import mine_collocations
from tidemart.llm.embedding_dedup import embedding_components
from tidemart.llm.html_extract import extract_main_text
from tidemart.llm.licenses import scan_licenses
from tidemart.llm.mixing import mix_sources
from tidemart.llm.packing import pack_mixture
from tidemart.llm.quality_classifier import score_quality
from tidemart.llm.quality_rules import repetition_rules
from tidemart.llm.simhash import simhash_components
from tidemart.llm.suffix_dedup import remove_repeats
from tidemart.llm.toxicity import score_toxicity
from tidemart.llm.warc import round_trip
from tidemart.llm.whitening import whiten
from tidemart.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digest(pack_mixture(_table(spark, sf_dir, "documents")))


def with_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(_table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_components(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), "kept")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it passes 64 bits; ``deviation_exact`` holds it up to 38 digits."""
    found = whiten(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                        "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(_table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_mixing": op6_mixing,
    "op7_licenses": op7_licenses,
    "op8_simhash": op8_simhash,
    "op9_quality_rules": op9_quality_rules,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_warc": op13_warc,
}
