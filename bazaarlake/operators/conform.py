"""Union, gap filling, validation and target-schema projection of clean listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import schemas
from bazaarlake import vocabulary as V
from bazaarlake.functions.text import joined_text


def align_stores(store_a: DataFrame, store_b: DataFrame) -> DataFrame:
    """Union by name; columns one store does not have become NULL."""
    return store_a.unionByName(store_b, allowMissingColumns=True)


def fill_with_mean(
    df: DataFrame, columns: Iterable[str] = schemas.MEAN_FILLED, of: DataFrame | None = None
) -> DataFrame:
    """Replace NULLs by the mean of the whole column (the result is double).

    ``of`` is the table whose means count, if df holds only some of its rows. The means are one pre-aggregated row used as a scalar subquery that reads only these columns, so
    no task sees the table and the rows themselves are not shuffled.
    """
    present = [c for c in df.columns if c in set(columns)]
    if not present:
        return df
    means = (df if of is None else of).agg(F.struct(*(F.avg(c).alias(c) for c in present))).scalar()
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), means.getField(c)) for c in present}
    )


def valid_listings(df: DataFrame) -> DataFrame:
    """Rows with a price, a non-empty name, a shop and a description."""
    return df.filter(
        F.col("price").isNotNull()
        & (F.col("product_name") != "")
        & F.col("shop_name").isNotNull()
        & F.col("description").isNotNull()
    )


def fill_with_blank(df: DataFrame, columns: Iterable[str] = schemas.BLANK_FILLED) -> DataFrame:
    return df.na.fill("", list(columns))


def fill_with_no_info(df: DataFrame, columns: Iterable[str] = schemas.NO_INFO_FILLED) -> DataFrame:
    """'no info' for missing text; a blank brand counts as missing."""
    brand = F.when(F.trim("brand") != "", F.col("brand")).otherwise(V.NO_INFO)
    return df.na.fill(V.NO_INFO, list(columns)).withColumn("brand", brand)


def fill_with_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.na.fill(0, list(columns))


def add_text_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "name_description": joined_text("product_name", "description"),
            "augmented_description": joined_text(
                "product_name", "description", "shipping", "country"
            ),
        }
    )


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a target schema by name: bad values and missing columns become NULL."""
    return df.select(
        *(
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in schema.fields
        )
    )
