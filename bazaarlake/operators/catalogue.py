"""Category, URL-list and option operators over listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.operators.skew import lookup_join


def category_completeness(listings: DataFrame, by: str = "category", url: str = "url") -> DataFrame:
    """Products found, products with a URL, and whether every product has one, per category."""
    counts = listings.groupBy(by).agg(
        F.count("*").alias("n_products"), F.count(url).alias("n_with_url")
    )
    return counts.withColumn("is_complete", F.col("n_products") == F.col("n_with_url"))


def option_combinations(df: DataFrame, options: list[str]) -> DataFrame:
    """Every combination of a row's option lists; a listing without a list keeps one row."""
    for name in options:
        df = df.withColumn(name, F.explode_outer(name))
    return df


def one_item_per_url(items: DataFrame) -> DataFrame:
    """URL list with one row per url: a complete one if there is, then the smallest (category, sold).

    Rows are combined before the shuffle.
    """
    order = F.struct(F.col("category").isNull(), F.col("sold").isNull(), "category", "sold")
    return (
        items.groupBy("url")
        .agg(F.min_by(F.struct("category", "sold"), order).alias("item"))
        .select("url", "item.category", "item.sold")
    )


def enrich_by_url(products: DataFrame, items: DataFrame) -> DataFrame:
    """Add category and sold of the URL list to products."""
    return lookup_join(products, one_item_per_url(items), "url")


def not_processed(df: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the processed keys."""
    return lookup_join(df, processed.select(key).distinct(), key, "left_anti")


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of each white-space separated word."""
    words = df.select(F.explode_outer(F.split(text, r"\s+")).alias("word")).filter("word != ''")
    return words.groupBy("word").agg(F.count("*").alias("n"))
