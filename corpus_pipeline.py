"""From raw documents to token ids: toxic documents go, repeated lines go, one document of each near-duplicate group
stays, sources are mixed to their target weights, and what is left is encoded.

Each stage works on all its predecessor kept, written as Parquet in the shared folder and read again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourcast.llm.bpe import encode_documents, word_bpe_path
from hourcast.llm.jaccard_join import one_of_each_group
from hourcast.llm.line_dedup import without_repeated_lines
from hourcast.llm.mixing import repeated
from hourcast.llm.store import table, written
from hourcast.llm.toxicity import fit, keep_clean


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model fitted on the labelled ones among them does not call toxic."""
    return keep_clean(docs, fit(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three documents hold (the last of them keeps them)."""
    return without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets with a Jaccard similarity of 0.8 or more."""
    return one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids, and the digests of the ids and of their decoding."""
    return encode_documents(docs, word_bpe_path(), ("ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix),
    ("bpe", encode),
]
#: The first stage learns, which SQL cannot express; tests/llm checks every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
