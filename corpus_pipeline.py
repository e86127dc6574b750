"""From raw documents to a training mix: five stages, each one of the operators of bazaarlake.llm.

Every stage works on what the one before has kept, read from Parquet, and its decisions take effect: documents of no known
language go, one of each group of near duplicates stays, repeated strings are cut out, documents that hold test items go, and
the rest is put in training order with the words that the mix takes of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import decontaminate, langid, mixing, suffix_dedup
from bazaarlake.llm import near_copies as jaccard
from bazaarlake.llm.storage import WIDE_ROWS, read, write_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Texts whose best language scores less are in none of the learned languages. Short texts have few n-grams to score with: of a
# text of fewer than SHORT_BYTES the least score falls with its length.
LEAST_LANGUAGE_SCORE, SHORT_BYTES = 0.15, 64


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones among them teach. Null and letterless texts go.

    Where no document has a language, nothing can be told and all with a letter stay.
    """
    docs = docs.select(COLUMNS)
    model = langid.fit(docs.filter(~langid.held_out()))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    # Only the text decides, so texts are named by 128 bits and need not come back from Python.
    named = docs.select(F.md5(F.col("text").cast("binary")).alias("name"), F.octet_length("text").alias("n_bytes"), "text")
    found = langid.predict(named, model, ["name", "n_bytes"])
    least = LEAST_LANGUAGE_SCORE * F.least(F.lit(1.0), F.col("n_bytes") / SHORT_BYTES)
    unknown = found.filter((F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < least)).select("name").distinct()
    unknown = write_table(unknown, "unknown-language", batch_rows=WIDE_ROWS)
    texts = docs.filter("text IS NOT NULL")
    return texts.join(jaccard.small(unknown), F.md5(F.col("text").cast("binary")) == F.col("name"), "left_anti")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Documents meet under the covering SimHash masks of operator 6, and by minima beyond its 4 bits; a Jaccard similarity of 0.8 of
    their 5-word shingles links them.
    """
    return jaccard.keep_one(docs.select(COLUMNS))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that also start earlier; documents of which nothing is left go."""
    kept = suffix_dedup.remove_repeats(docs, ["doc_id", "lang", "source"], as_text=True)
    kept = kept.filter((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_bytes") == 0))
    return kept.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}).select(COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    items = decontaminate.split_items(read(spark, sf_dir, "benchmark", "item_id", "text"))
    return decontaminate.without_leaks(docs.select(COLUMNS), items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, with size, source_size, target, taken, position and positions."""
    return mixing.mix(docs.select(*COLUMNS, mixing.word_count("text").alias("size")))


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_strings", repeated_strings),
    ("benchmark_leaks", benchmark_leaks),
    ("mix", mix),
]

# Fingerprints, kernels and suffix arrays are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table documents; each result but the last is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
