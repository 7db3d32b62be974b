"""Training-corpus pipeline: five operators of tidemart.llm, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``; all but the last return
the columns of ``docs``. The tables beside ``docs`` are read from ``sf_dir``.

1. quality_classifier: documents that the co-trained model rejects go.
2. simhash_near_dedup: of each group of fingerprints at most 4 bits apart the
   document with the smallest id stays (of repeated rows with that id, one).
3. suffix_array_dedup: bytes in strings of ``PASSAGE_BYTES`` that start elsewhere
   too are cut out of the texts; a character that a cut has split goes as a whole,
   and n_chars is counted anew. No document goes, though a text may become empty.
   Passages of over 50 words are meant: most have at least 275 bytes.
4. source_mixing: sources are brought to their target weights; a document is
   returned as often as the mix takes it.
5. packing: windows of 4096 tokens by deficit round-robin, as pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import write_and_read
from tidemart.llm.mixing import mix_sources
from tidemart.llm.packing import pack_mixture
from tidemart.llm.quality_classifier import keep_good
from tidemart.llm.queries import with_digest
from tidemart.llm.simhash import keep_one
from tidemart.llm.suffix_dedup import remove_repeats

ORACLE_SQL = None
PASSAGE_BYTES = 250
ANCHORS = (32, 128)  # substrings whose smallest hash deals out windows: short ones, and longer ones for large groups


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = remove_repeats(docs, length=PASSAGE_BYTES, anchor=ANCHORS[0], long_anchor=ANCHORS[1], as_text=True, carry=others)
    return cut.select(*(F.col("kept").alias("text") if c == "text" else
                        F.char_length("kept").cast("long").alias("n_chars") if c == "n_chars" else F.col(c)
                        for c in docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c != "doc_id"]
    mixed = mix_sources(docs, carry=others)
    return mixed.where("copies > 0 and size > 0").select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy__")).drop("copy__")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_digest(pack_mixture(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
