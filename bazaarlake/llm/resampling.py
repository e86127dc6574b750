"""Importance resampling towards a target distribution, over hashed bags of word runs.

Each feature (a run of words) falls into the bucket of its CRC-32. The CRCs of a task's distinct features are computed
together: features of equal length form a matrix of bytes, whose columns update the CRCs of all its rows at once. A bucket's
gain is the logarithm of how much likelier it is in the target than in the corpus; a document's weight is the sum of
the gains of its features, and Gumbel noise drawn from its id turns weights into a sample without replacement.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.duck import crc32_sql
from bazaarlake.llm.numbering import numbered
from bazaarlake.llm.storage import write_table
from bazaarlake.llm.text import LOWER, pieces

#: Letters a to z, digits and everything beyond ASCII, in bytes of UTF-8.
WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Distinct features that a task holds at once, and features of documents that it holds before they are weighed.
HELD = 200_000


def _table() -> np.ndarray:
    """What a byte adds to a CRC-32."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = crc >> np.uint32(1) ^ np.where(crc & 1, np.uint32(0xEDB88320), np.uint32(0))
    return crc


def crc32_of(features: Sequence[bytes]) -> np.ndarray:
    """The CRC-32 of each byte string: strings of equal length are one matrix, updated column by column."""
    table, found = _table(), np.zeros(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    ends = np.r_[np.flatnonzero(np.diff(lengths[order])) + 1, len(order)] if len(order) else []
    start = 0
    for end in ends:
        own = order[start:end]
        matrix = np.frombuffer(b"".join([features[i] for i in own.tolist()]), np.uint8).reshape(len(own), -1)
        crc = np.full(len(own), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(matrix.T):
            crc = table[(crc ^ column) & np.uint32(255)] ^ crc >> np.uint32(8)
        found[own] = crc ^ np.uint32(0xFFFFFFFF)
        start = end
    return found


def feature_lists(text: str | None, longest: int = LONGEST) -> Iterator[list[bytes]]:
    """The features of a whole text in lists of bounded length: all runs of 1 to ``longest`` words; A-Z only is lower-cased."""
    before: list[bytes] = []
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").translate(LOWER)):
        words = WORD_BYTES.findall(piece)
        found = list(words)
        for k in range(2, longest + 1):
            # Runs that end in this piece; they may start in the pieces before.
            row = before[len(before) - (k - 1) if len(before) >= k else 0 :] + words
            found += [b" ".join(row[i : i + k]) for i in range(len(row) - k + 1)]
        before = (before + words)[len(before) + len(words) - (longest - 1) if len(before) + len(words) >= longest else 0 :]
        yield found


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of docs (text) fall into each bucket. Each task gives one row per bucket at most."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(buckets, np.int64), Counter()

        def add() -> None:
            places = (crc32_of(list(held)) % np.uint32(buckets)).astype(np.int64)
            np.add.at(total, places, np.fromiter(held.values(), np.int64, len(held)))
            held.clear()

        for batch in batches:
            for text in batch.column("text"):
                for found in feature_lists(text.as_py(), longest):
                    held.update(found)
                    if len(held) > HELD:
                        add()
        add()
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(scan, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(buckets, np.int64)
    # One row per bucket.
    for row in counted.collect():
        found[row.bucket] = row.n
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths, rounded down; every bucket counts one more than it holds."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    found = [
        math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array(found, np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, keep: Sequence[str], longest: int = LONGEST) -> DataFrame:
    """The columns to keep, n_features, n_words and weight of every row of docs (text); a null text has no feature."""
    # One number per bucket.
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kept = [c for c in keep if c not in ("n_features", "n_words", "weight")]

    def weights(texts: Iterable[str | None], rows: int) -> np.ndarray:
        """Rows of n_features, n_words, weight."""
        result, known, held, size = np.zeros((rows, 3), np.int64), {}, [], 0

        def add() -> None:
            new = list(set().union(*(found for _, found in held)) - known.keys())
            known.update(zip(new, shared.value[crc32_of(new) % np.uint32(len(gain))].tolist(), strict=True))
            for row, found in held:
                result[row] += (len(found), sum(b" " not in f for f in found) if longest > 1 else len(found), sum(map(known.__getitem__, found)))
            held.clear()
            if len(known) > HELD:
                known.clear()

        for row, text in enumerate(texts):
            for found in feature_lists(text, longest):
                held.append((row, found))
                size += len(found)
                if size > HELD:
                    add()
                    size = 0
        add()
        return result

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = weights((t.as_py() for t in batch.column("text")), batch.num_rows)
            columns = [batch.column(c) for c in kept] + [pa.array(c) for c in found.T]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_features", "n_words", "weight"])

    schema = docs.select(kept).schema.add("n_features", "long").add("n_words", "long").add("weight", "long")
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(apply, schema)


def noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the id; a null id counts as an empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """The columns to keep (with doc_id), n_features, weight, score and rank of every row of docs (doc_id, text).

    The counts of docs and of target (text) cover all their rows, repeated ones too. Of the N rows with ``least_words`` words,
    floor(percent * N / 100) are drawn, those with the highest scores, ties to the smaller doc_id; a null id comes
    last. rank counts the drawn from 1 and is null elsewhere. Rows that agree in score and id are drawn by their number
    of features, then in any order. Null and empty texts have weight 0. An empty target or table is counted as zeros.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    scored = weigh(docs, gain, keep, longest).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = write_table(scored, "resampling-scores")
    able = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    ranked = numbered(scored.filter(able), [], order, "rank")
    drawn = scored.filter(able).count() * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("n_words")


def _lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


SQL = f"""
WITH texts AS (
  SELECT true AS of_corpus, row_number() OVER () AS row_id, doc_id,
    regexp_extract_all({_lowered("text")}, '{WORD}') AS words FROM documents
  UNION ALL
  SELECT false, NULL, NULL, regexp_extract_all({_lowered("text")}, '{WORD}') FROM benchmark),
used AS (SELECT of_corpus, row_id, unnest(words) AS word FROM texts),
hashed AS (SELECT word, hex(encode(word)) AS hx FROM (SELECT DISTINCT word FROM used)),
placed AS (SELECT word, {crc32_sql("hx")} % {BUCKETS} AS bucket FROM hashed),
counted AS (
  SELECT bucket, count(*) FILTER (of_corpus) AS s, count(*) FILTER (NOT of_corpus) AS t
  FROM used JOIN placed USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain FROM counted),
weights AS (
  SELECT row_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM used JOIN placed USING (word) JOIN gain USING (bucket) WHERE of_corpus GROUP BY row_id),
scored AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')),
      1, 8) AS BIGINT)::DOUBLE + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (row_id) WHERE of_corpus),
ranked AS (
  SELECT *, CASE WHEN n_features >= {LEAST_WORDS} THEN row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS}
      ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place,
    count(*) FILTER (n_features >= {LEAST_WORDS}) OVER () * {PERCENT} // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked
"""
