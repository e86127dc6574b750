"""Vocabularies that stay tables: terms and categories numbered by falling frequency, and weights and sparse vectors built from them.

Nothing is gathered on the driver and no vocabulary is cut off. Counts are combined in each task before the shuffle; codes come from
a range sort (operators.ids.ordered_ids) and are joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.operators.ids import ordered_ids

#: Gives a new folder, shared by all executors, for a table between two steps.
Folder = Callable[[str], str]


def codes(values: DataFrame, value: str, folder: Folder) -> DataFrame:
    """(value, n, code): every distinct value that is not NULL, by falling frequency, equal ones in their own order, from 0."""
    counts = values.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    return ordered_ids(counts, [F.col("n").desc(), F.col(value).asc()], F.lit(-1), folder("codes"), "code")


def words(text: Column) -> Column:
    """The lower-case words of a text as the tokenizer of the price model cuts them: at each white space, none behind the last word."""
    return F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+$", ""), r"\s", -1)


def term_frequencies(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf) for every distinct word of every document; a document is a key."""
    return docs.select(key, F.explode(words(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))


def term_weights(docs: DataFrame, key: str, text: str, folder: Folder, min_doc_freq: int = 2) -> DataFrame:
    """(key, term, code, tf, weight): weight is tf * ln((m + 1) / (doc_freq + 1)), 0 below ``min_doc_freq``.

    code is the term's place by document frequency, equal ones in the order of the terms.
    """
    path = folder("frequencies")
    term_frequencies(docs, key, text).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    total = docs.agg(F.count("*")).scalar()
    coded = codes(rows.select("term"), "term", folder)
    idf = F.when(F.col("n") >= min_doc_freq, F.log((total + 1) / (F.col("n") + 1))).otherwise(F.lit(0.0))
    # A written table of terms: rows of a frequent term can be split over tasks.
    path = folder("terms")
    coded.select("term", "code", idf.alias("idf")).write.parquet(path)
    terms = docs.sparkSession.read.parquet(path)
    return rows.join(terms, "term").select(key, "term", "code", "tf", (F.col("tf") * F.col("idf")).alias("weight"))


def sparse_vectors(entries: DataFrame, key: str, code: str = "code", weight: str = "weight") -> DataFrame:
    """(key, indices, weights): the entries of each key by rising code, those of weight 0 left out. A row holds one document's entries."""
    pairs = F.sort_array(F.collect_list(F.when(F.col(weight) != 0, F.struct(code, weight))))
    grouped = entries.groupBy(key).agg(pairs.alias("_pairs"))
    return grouped.select(key, F.col("_pairs")[code].alias("indices"), F.col("_pairs")[weight].alias("weights"))


def category_codes(rows: DataFrame, columns: Sequence[str], folder: Folder, unseen: str = "keep") -> DataFrame:
    """rows with <column>_code for each of the columns: the place of the row's category by falling frequency.

    A row without a category gets the number of categories as its code (``keep``), or is left out (``skip``).
    """
    if unseen not in ("keep", "skip"):
        raise ValueError(f"unknown rule {unseen!r}")
    for column in columns:
        path = folder("categories")
        codes(rows.select(column), column, folder).write.parquet(path)
        known = rows.sparkSession.read.parquet(path)
        table = known.select(F.col(column).alias("_value"), F.col("code").alias(f"{column}_code"))
        if unseen == "skip":
            rows = rows.join(table, F.col(column) == F.col("_value")).drop("_value")
        else:
            number = known.agg(F.count("*")).scalar()
            found = rows.join(table, F.col(column) == F.col("_value"), "left").drop("_value")
            rows = found.withColumn(f"{column}_code", F.coalesce(f"{column}_code", number))
    return rows
