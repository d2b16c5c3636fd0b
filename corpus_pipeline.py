"""A training corpus out of raw documents: language, repeated lines, near copies, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slugline.llm import langid, line_chunks, mixing, packing, simhash
from slugline.llm.common import written
from slugline.llm.queries import SHARE, WEIGHTS, tokenizer_file


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with calibrated confidence; the model learns from `docs`.

    Where no row of `docs` has both a label and a letter there is nothing to learn from: all
    documents that have a letter stay.
    """
    model = langid.fit_languages(docs.select("doc_id", "text", "lang"))
    if not model.languages:
        return langid.with_letters(docs)
    return langid.predict_languages(docs, model).where("NOT rejected").select("row.*")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that an earlier place has; n_chars follows the text."""
    found = line_chunks.remove_repeated_chunks(docs)
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return found.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of three-word shingles, at most three bits apart."""
    return simhash.one_of_each(docs, width=3, max_bits=3, segments=2)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(docs, mixing.mix(docs, WEIGHTS, SHARE))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file(), capacity=2048)


STAGES = [
    ("language", language),
    ("repeated_lines", repeated_lines),
    ("near_copies", near_copies),
    ("mixed_sources", mixed_sources),
    ("packed", packed),
]

# The stages hash, learn and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
