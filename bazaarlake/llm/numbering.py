"""Positions 0, 1, 2, ... in an order over a whole table, without a task that sees all rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarlake.llm.storage import drop_table, write_table

# monotonically_increasing_id holds the partition above so many bits, the place within it below.
PLACE_BITS = 33


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """rows with the column ``name``: the position, from 0, of each row in its group (all rows, if no column is named).

    Rows are sorted by ranges of (group, order), so a group of any size is cut into many ranges. Ties are broken by
    the place at which a row was written first: repeated rows are dealt out like any others, and which of them
    comes first is left open. The table of first positions has one row per range and group that meets it.
    """
    written = write_table(rows.withColumn("_row", F.monotonically_increasing_id()), "numbering-rows")
    keys = [*(F.col(c).asc_nulls_first() for c in group), *order, F.col("_row").asc()]
    ranged = written.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = write_table(ranged.withColumn("_row", F.monotonically_increasing_id()), "numbering-ranges")
    part = F.shiftright("_row", PLACE_BITS)
    place = F.col("_row").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    met = ranged.groupBy(part.alias("_part"), *group).agg(F.count("*").alias("_n"), F.min(place).alias("_first"))
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    names = {c: f"_group_{i}" for i, c in enumerate(group)}
    starts = met.select("_part", before.alias("_before"), *(F.col(c).alias(n) for c, n in names.items()))
    starts = write_table(starts, "numbering-starts")
    same = F.col("_part") == part
    for c, n in names.items():
        same &= F.col(c).eqNullSafe(F.col(n))
    drop_table(written)
    return ranged.join(starts, same).select(*rows.columns, (F.col("_before") + place).alias(name))
