"""Joins and scans that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lookup_join(
    left: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left", salts: int = 0
) -> DataFrame:
    """Equi-join against a lookup with at most one row per key; nothing runs while the plan is built.

    Spark broadcasts a side under its threshold; beyond it, adaptive execution splits the partitions of hot keys. Where it
    cannot (the lookup side is an aggregate on the join keys, whose partitioning it must keep), ``salts`` spreads the rows of
    every key over so many tasks by their input partition, and repeats the lookup that often.
    ``how`` may be inner, left, left_semi or left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    for key in keys:
        if left.schema[key].dataType != lookup.schema[key].dataType:
            raise TypeError(f"join column {key!r} has different types on the two sides")
    if salts < 2:
        return left.join(lookup, keys, how)
    spread = left.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")


def may_match(rows: DataFrame, keys: DataFrame, on: str, slots: int = 1 << 26) -> DataFrame:
    """The rows whose key may be among ``keys``: all that match, and few others while the keys are fewer than the slots.

    A join of a small batch with a large table shuffles the whole table. Bitmaps of the slots (hashes) that the batch takes have a
    fixed size, a bit a slot at most, so every task gets them and drops what cannot match before the shuffle. Null matches nothing.
    """

    def placed(key):
        slot = F.pmod(F.xxhash64(key), F.lit(slots)) + 1  # the bitmap functions count from one
        # Never null, which Spark must see: else it adds filters that make the key twice more.
        places = {"_bitmap": F.bitmap_bucket_number(slot), "_place": F.bitmap_bit_position(slot)}
        return [F.coalesce(c, F.lit(0)).alias(name) for name, c in places.items()]

    taken = keys.filter(F.col(on).isNotNull()).select(*placed(on)).groupBy("_bitmap").agg(F.bitmap_construct_agg("_place").alias("_taken"))
    byte = F.substring("_taken", F.expr("int(_place div 8) + 1"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.expr("int(_place % 8)"))
    found = rows.filter(F.col(on).isNotNull()).select("*", *placed(on)).join(F.broadcast(taken), "_bitmap")
    return found.filter(bit == 1).select(*rows.columns)


def spread_scan(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer splits than cores over all cores.

    Row-local text parsing is CPU-bound, so a table stored as one small file would be parsed by one
    task. Tables with at least one split per core are returned unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
