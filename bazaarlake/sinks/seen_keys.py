"""Keys that have been processed, for batches that must not read what came before.

Every key has a slot, a hash of it. Bitmaps of 32 768 slots tell which slots are taken, so a key whose slot is free
is new without another look. Only keys with a taken slot are compared with the stored keys, and only in the hash
buckets in which there are any. Both tables grow batch by batch and are merged in levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.sinks.keyed_table import KeyedTable

BITMAP_SLOTS = 32_768


class SeenKeys:
    """Keys of one type below ``path``. With ``slots`` several times the number of keys most new keys meet a free slot;
    with fewer more of them are compared, and the answers stay the same. Null is no key.
    """

    def __init__(self, spark: SparkSession, path: str, slots: int = 1 << 30, buckets: int = 16, fanout: int = 4) -> None:
        if slots % buckets:
            raise ValueError("slots have to be a multiple of the buckets")
        self.slots, self.buckets, path = slots, buckets, path.rstrip("/")
        self.bitmaps = KeyedTable(spark, f"{path}/bitmaps", "bitmap", buckets=buckets, fanout=fanout)
        self.keys = KeyedTable(spark, f"{path}/keys", "key", buckets=buckets, fanout=fanout)

    def _placed(self, rows: DataFrame, key: str) -> DataFrame:
        """The different keys with their bitmap, their place in it and their bucket in the table of keys."""
        slot = F.pmod(F.xxhash64("key"), F.lit(self.slots))
        keys = rows.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct().withColumn("_slot", slot)
        # The bitmap functions count from one.
        places = {"bitmap": F.bitmap_bucket_number(F.col("_slot") + 1), "place": F.bitmap_bit_position(F.col("_slot") + 1)}
        return keys.withColumns(places | {"key_bucket": F.pmod("_slot", F.lit(self.buckets)).cast("int")}).drop("_slot")

    def add(self, rows: DataFrame, key: str, epoch: int) -> None:
        """Record the keys of a batch. A batch that is run again changes nothing."""
        placed = self._placed(rows, key)
        self.keys.upsert(placed.select("key"), epoch)
        taken = placed.groupBy("bitmap").agg(F.bitmap_construct_agg("place").alias("taken"))
        if self.bitmaps.manifest()["schema"] is not None:
            before = self.bitmaps.rows().select("bitmap", F.col("taken").alias("before"))
            both = F.array_compact(F.array("taken", "before"))
            opened = taken.join(before, "bitmap", "left").select("bitmap", F.explode(both).alias("part"))
            taken = opened.groupBy("bitmap").agg(F.bitmap_or_agg("part").alias("taken"))
        self.bitmaps.upsert(taken, epoch)

    def compact(self) -> int:
        """Merge the runs of both tables; the number of merges."""
        return self.keys.compact() + self.bitmaps.compact()

    def suspects(self, rows: DataFrame, key: str) -> DataFrame:
        """(key, key_bucket) of the different keys whose slot is taken."""
        byte = F.substring("taken", F.expr("int(place div 8) + 1"), F.lit(1))
        bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.expr("int(place % 8)"))
        met = self._placed(rows, key).join(self.bitmaps.rows().select("bitmap", "taken"), "bitmap")
        return met.filter(bit == 1).select("key", "key_bucket")

    def missing(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows whose key has not been recorded, and those without a key."""
        if self.keys.manifest()["schema"] is None or self.bitmaps.manifest()["schema"] is None:
            return rows
        suspects = self.suspects(rows, key)
        # No more numbers than there are buckets.
        buckets = [r.key_bucket for r in suspects.select("key_bucket").distinct().collect()]
        if not buckets:
            return rows
        stored = self.keys.lookup_buckets(buckets).select("key")
        present = suspects.join(stored, "key", "left_semi").select(F.col("key").alias("_present"))
        return rows.join(present, F.col(key) == F.col("_present"), "left_anti")
