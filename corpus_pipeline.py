"""The corpus pipeline: documents in, a tokenised mixture out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and is written as
Parquet and read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tuneprep.llm import langid, mixing, pieces, secret_scan, simhash
from tuneprep.runtime import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a language (no text, or no letter in it) go; ``lang`` is the language found."""
    return langid.drop_undetermined(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of 3 words, 2 bits at most."""
    return simhash.keep_one(docs, "doc_id", "text", simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays. ``n_chars`` follows the text."""
    return mark_length(secret_scan.redact(docs))


def mark_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.selectExpr(
        *[
            f"cast(length(text) as {kind.simpleString()}) as n_chars" if c == "n_chars" else f"`{c}`"
            for c in docs.columns
        ]
    )


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.mix(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture with the piece ids of each text."""
    return pieces.encode_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding", sentencepiece_encoding),
]

#: Trained models and hashes of shingles are beyond SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored in the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{number}")
    return docs
