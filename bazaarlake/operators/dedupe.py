"""Keep one offer per product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.operators.skew import may_match


def best_offer(
    df: DataFrame,
    by: str = "product_name",
    price: str = "price",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The highest-priced row per product; NULL prices lose, ties go to the lowest ``tiebreak``.

    Ranking to one row plans to a partial group limit before the shuffle: each task sends at most one
    row per product, so a product that holds a third of all rows costs one row per task.
    Without ``tiebreak`` all other orderable columns decide, which makes the result a function of the
    rows alone.
    """
    if tiebreak is None:
        tiebreak = [
            f.name
            for f in df.schema.fields
            if f.name not in (by, price) and not isinstance(f.dataType, T.MapType)
        ]
    ranked = Window.partitionBy(by).orderBy(
        F.col(price).desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in tiebreak)
    )
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def may_be_best(df: DataFrame, of: DataFrame, by: str = "product_name", price: str = "price") -> DataFrame:
    """The rows of df that have the highest price that ``of`` holds for their product, and few others.

    Ranking sorts whole rows in each task, so wide ones spill. Here a pass over two columns of the offers finds the highest prices
    by hash aggregation, and rows that cannot have one are dropped before anything else of them is made, sorted or sent.
    best_offer gives the same of what is left as of all offers. Products without any price keep their rows.
    """
    offer = F.xxhash64(by, price)
    highest = of.groupBy(by).agg(F.max(price).alias(price)).select(offer.alias("_offer"))
    return may_match(df.withColumn("_offer", offer), highest, "_offer").drop("_offer")


def first_per_group(df: DataFrame, by: str, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in a total order (pages per category)."""
    ranked = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n).drop("_rank")
