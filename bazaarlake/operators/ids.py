"""Numeric document ids that continue after the ids already in a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_id(existing: DataFrame, id_column: str = "id") -> DataFrame:
    """One row: the highest id in use, 0 for an empty table."""
    return existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("last_id"))


def top_document(existing: DataFrame, id_column: str = "id") -> DataFrame:
    """The row with the highest id (a top-1, so no global sort)."""
    return existing.orderBy(F.col(id_column).desc()).limit(1)


def increasing_ids(df: DataFrame, base: Column) -> DataFrame:
    """Unique ids above ``base`` without a shuffle; they jump between partitions."""
    return df.withColumn("id", F.monotonically_increasing_id() + base + 1)


def dense_ids(df: DataFrame, key: str, base: Column) -> DataFrame:
    """Ids base+1, base+2, ... in the order of a unique numeric ``key``.

    Rows are cut into key ranges at approximate quantiles; an exact count per range gives every range
    its first id, and rows are numbered inside their range. The cuts only balance the work: the ids
    are the same wherever they fall. There are as many ranges as shuffle partitions, and as the key is unique, a
    range holds at most a few times its share of the rows.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(df.approxQuantile(key, steps, 0.25 / ranges))) if steps else []
    ranged = df.withColumn("_range", _range_number(F.col(key).cast("double"), cuts))
    # One row per range from here to the offsets.
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    position = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn("id", base + F.col("_offset") + position)
        .drop("_range", "_offset")
    )


# monotonically_increasing_id holds the partition above so many bits, the place within it below.
PLACE_BITS = 33


def ordered_ids(df: DataFrame, order: Sequence[Column], base: Column, folder: str, name: str = "id") -> DataFrame:
    """Ids base+1, base+2, ... in any order of any columns; rows that tie get theirs in any order.

    Rows are sorted by ranges and written to ``folder`` with their place in their range; the counts of the ranges, one row
    each, add up to the first id of each range. A range of equal sort values stays together, so add columns that tell rows
    apart where many tie.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_row", F.monotonically_increasing_id()).write.parquet(folder)
    written = df.sparkSession.read.schema(df.schema.add("_row", "long")).parquet(folder)
    part, place = F.shiftright("_row", PLACE_BITS), F.col("_row").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    counts = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row for each partition of the sort.
    numbered = written.join(F.broadcast(offsets), part == F.col("_part"))
    return numbered.withColumn(name, base + F.col("_offset") + place + 1).drop("_row", "_part", "_offset")


def _range_number(value: Column, cuts: list[float]) -> Column:
    """Number of cuts below the value, by binary search over nested comparisons."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    upper = _range_number(value, cuts[middle + 1 :]) + (middle + 1)
    return F.when(value > cuts[middle], upper).otherwise(_range_number(value, cuts[:middle]))
