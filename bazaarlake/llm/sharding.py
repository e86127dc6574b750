"""Shards by jump consistent hashing.

The stable key of a row and the number of shards decide its shard; no ring table is kept. With one shard more, a row stays
or goes to the new shard, so only 1/(n + 1) of the rows move.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.duck import crc32_sql
from bazaarlake.llm.numbering import numbered

SHARDS = 24
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
LAW = "key"
# Fixed values of the method: the multiplier of its generator of 64 bits, of which the upper 31 are drawn from.
MULTIPLIER, DRAWN_BITS = 2862933555777941757, 31


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard (0 to shards - 1) of each unsigned 64-bit key.

    A key's generator draws the next number of shards at which it would jump; the last jump below ``shards`` holds. Some
    ln(shards) draws are made on the mean.
    """
    if shards < 1:
        raise ValueError("there must be a shard at least")
    state, found = keys.astype(np.uint64), np.zeros(len(keys), np.int64)
    at, active = np.zeros(len(keys), np.int64), np.arange(len(keys))
    while len(active):
        found[active] = at[active]
        state[active] = state[active] * np.uint64(MULTIPLIER) + np.uint64(1)
        drawn = (state[active] >> np.uint64(64 - DRAWN_BITS)).astype(np.float64) + 1
        at[active] = ((found[active] + 1) * (float(1 << DRAWN_BITS) / drawn)).astype(np.int64)
        active = active[at[active] < shards]
    return found


def stable_key(column: Column) -> Column:
    """A signed number of 64 bits from a key's text, the same in every run and on every system; null counts as an empty text."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a row with this key; only the key goes to Python."""

    @F.pandas_udf("int")
    def jumped(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy().view(np.uint64), shards).astype(np.int32))

    return jumped(stable_key(key))


def place(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """docs with shard and grown_shard, the shard with one more; columns of these names are replaced. No shuffle."""
    return docs.withColumns({"shard": shard_of(F.col(key), shards), "grown_shard": shard_of(F.col(key), shards + 1)})


def slots(placed: DataFrame, order: list[str]) -> DataFrame:
    """Rows with shard, and with slot: the position in the shard by the named columns, nulls first, from 0 without gaps."""
    return numbered(placed, ["shard"], [F.col(c).asc_nulls_first() for c in order], "slot")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of docs (doc_id, text).

    Equal doc_ids share a shard whatever their texts are, and so do all rows without a doc_id; equal texts under
    different ids do not. A null text is empty. Repeated rows stay and get slots of their own. Of an empty table nothing comes.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
    )
    return slots(place(rows, shards), ["doc_id", "size", "text_crc32"])


def moves(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """The rows that go to the new shard when one is appended; all others stay where they are."""
    return place(docs, shards, key).filter("shard <> grown_shard")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, key: str = "doc_id") -> None:
    """All rows with all columns as Parquet in folders shard=0, shard=1, ...; a shard is cut into files by a hash of its rows."""
    placed = place(docs, shards, key).drop("grown_shard")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A third of all rows may have one key: each shard is dealt over several tasks.
    salt = F.pmod(F.xxhash64(*docs.columns), F.lit(max(1, parts // shards)))
    placed.repartition("shard", salt).write.mode("errorifexists").partitionBy("shard").parquet(folder)


def jump_sql(key: str, shards: int) -> str:
    """DuckDB: the shard of an unsigned 64-bit key (as HUGEINT). Draws are listed until the last one below ``shards``."""
    step = f"(s.k * {MULTIPLIER} + 1) % 18446744073709551616"
    drawn = f"CAST(floor((s.j + 1) * (2147483648.0::DOUBLE / (CAST({step} AS UHUGEINT) // 8589934592 + 1)::DOUBLE)) AS BIGINT)"
    start = f"{{'k': CAST({key} AS UHUGEINT), 'b': -1::BIGINT, 'j': 0::BIGINT}}"
    # b is the last jump that holds, j the next one; once j is beyond the shards nothing changes.
    move = f"CASE WHEN s.j >= {shards} THEN s ELSE {{'k': {step}, 'b': s.j, 'j': {drawn}}} END"
    return f"list_reduce(list_transform(range({shards + 1}), lambda i: {start}), lambda s, i: {move}).b"


SQL = f"""
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
keyed AS (
  SELECT doc_id, length(hx) // 2 + {ROW_BYTES} AS size, {crc32_sql("hx")} AS text_crc32,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS UBIGINT) AS key FROM bytes),
placed AS (
  SELECT *, CAST({jump_sql("key", SHARDS)} AS INTEGER) AS shard, CAST({jump_sql("key", SHARDS + 1)} AS INTEGER) AS grown_shard
  FROM keyed)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, '{LAW}' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM placed
"""
