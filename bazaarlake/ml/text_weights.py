"""Document frequency and inverse document frequency per term, without a driver-side vocabulary."""

from __future__ import annotations

from pyspark.ml.feature import Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def term_weights(df: DataFrame, text: str, min_doc_freq: int = 2) -> DataFrame:
    """(term, doc_freq, idf) with idf = ln((m + 1) / (doc_freq + 1)), 0 below ``min_doc_freq``.

    Terms are distinct within a row before they are counted, so the count needs one shuffle with
    partial counts per task.
    """
    words = Tokenizer(inputCol="_text", outputCol="_words").transform(
        df.select(F.coalesce(text, F.lit("")).alias("_text"))
    )
    total = df.agg(F.count("*")).scalar()
    terms = words.select(F.explode_outer(F.array_distinct("_words")).alias("term")).filter("term != ''")
    counts = terms.groupBy("term").agg(F.count("*").alias("doc_freq"))
    idf = F.log((total + 1) / (F.col("doc_freq") + 1))
    return counts.withColumn("idf", F.when(F.col("doc_freq") >= min_doc_freq, idf).otherwise(F.lit(0.0)))
