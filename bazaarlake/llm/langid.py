"""Language identification by a string kernel.

The kernel of two texts is the number of n-grams (blended: all lengths together, presence only) that both hold, divided
by the geometric mean of their own numbers. Landmark texts span its Nyström feature space, in which one-versus-rest
kernel ridge regression learns the languages. As the kernel is a scalar product of presence vectors, the product of landmarks,
Nyström projection and regression weights is one matrix: texts are scored by multiplying batches of presence
vectors with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.storage import write_table

LENGTHS = (2, 3, 4)
# n-grams are told apart by a hash of so many bits.
HASH_BITS = 16
# The classifier is fitted on at most so many documents of each language, and so many in all.
SAMPLE_PER_LANGUAGE = 400
SAMPLE_ROWS = 8000
LANDMARKS = 256
RIDGE = 0.1
BATCH = 64
PIECE = 1 << 18
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    languages: list[str]
    #: One row per n-gram hash, one column per language.
    weights: np.ndarray


def mark_presence(text: str, row: np.ndarray) -> None:
    """Set the cells of all n-grams of a text's lower-case UTF-8 bytes; texts are read in overlapping pieces."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    for at in range(0, len(data), PIECE):
        part = data[at : at + PIECE + max(LENGTHS) - 1]
        code = np.zeros(len(part), np.uint32)
        for n in range(1, max(LENGTHS) + 1):
            if len(part) < n:
                break
            code = code[: len(part) - n + 1] << np.uint32(8) | part[n - 1 :]
            if n in LENGTHS:
                mixed = (code ^ np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
                row[(mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - HASH_BITS)] = 1


def sample(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text_hash and rank of the documents to fit on: for each language those with the lowest hashes of their ids.

    Documents of one id are told apart, and ordered, by a hash of their text; what repeats in full counts once.
    """
    ids = docs.select("doc_id", "lang", F.xxhash64("text").alias("text_hash")).withColumn("hash", F.xxhash64("doc_id"))
    rank = F.dense_rank().over(W.partitionBy("lang").orderBy("hash", "doc_id", "text_hash"))
    chosen = ids.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_PER_LANGUAGE)
    return chosen.select("doc_id", "lang", "text_hash", "rank").distinct().orderBy("rank", "lang").limit(SAMPLE_ROWS)


def fit(docs: DataFrame) -> Model:
    """Fit on docs (doc_id, text, lang), all of which may be learned from."""
    docs = docs.filter("text IS NOT NULL AND lang IS NOT NULL")
    chosen = write_table(sample(docs), "langid-sample")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for text in batch.column("text"):
                row = np.zeros(1 << HASH_BITS, np.uint8)
                mark_presence(text.as_py(), row)
                packed.append(np.packbits(row).tobytes())
            columns = [batch.column("lang"), batch.column("rank"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "rank", "bits"])

    texts = docs.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.xxhash64("text").alias("_hash"), "text")
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_lang") == F.col("lang")) & (F.col("_hash") == F.col("text_hash"))
    # A language and a rank name one text, however often it stands in the table: at most SAMPLE_ROWS rows of 8 KB.
    texts = texts.join(chosen, same).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    rows = texts.mapInArrow(presence, "lang string, rank int, bits binary").toPandas()
    if len(rows) > SAMPLE_ROWS:
        raise AssertionError(f"a sample of {len(rows)} documents")
    rows = rows.sort_values(["rank", "lang", "bits"], kind="stable").reset_index(drop=True)
    languages = sorted(set(rows["lang"]))
    if not languages:
        return Model([], np.zeros((1 << HASH_BITS, 0), np.float32))
    unit = lambda bits: (b := np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.float32)) / max(1.0, float(b.sum())) ** 0.5
    landmarks = np.stack([unit(b) for b in rows["bits"][:LANDMARKS]])
    kernel = np.concatenate(
        [np.stack([unit(b) for b in rows["bits"][i : i + BATCH]]) @ landmarks.T for i in range(0, len(rows), BATCH)]
    ).astype(float)
    values, vectors = np.linalg.eigh(kernel[: len(landmarks)])
    kept = values > 1e-6 * values.max()
    project = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel @ project
    targets = (rows["lang"].to_numpy()[:, None] == np.array(languages)[None, :]).astype(float)
    ridge = features.T @ features + RIDGE * np.eye(features.shape[1])
    return Model(languages, (landmarks.T @ (project @ np.linalg.solve(ridge, features.T @ targets))).astype(np.float32))


def predict(docs: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """The columns to keep, lang_pred and score (0 to 1) of every row of docs; only the text is looked at.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing could be learned.
    """
    languages = model.languages
    # 2^HASH_BITS rows of one number per language.
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    def scores(texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [i for i, t in enumerate(texts) if languages and t and LETTER.search(t)]
        names, best = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for at in range(0, len(known), BATCH):
            part = known[at : at + BATCH]
            rows = np.zeros((len(part), 1 << HASH_BITS), np.float32)
            for row, i in zip(rows, part, strict=True):
                mark_presence(texts[i], row)
            result = rows @ shared.value / np.sqrt(np.maximum(1, rows.sum(axis=1)))[:, None]
            for i, values in zip(part, result, strict=True):
                names[i], best[i] = languages[int(values.argmax())], float(np.clip(values.max(), 0, 1))
        return names, best

    kept = [c for c in keep if c not in ("lang_pred", "score")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, best = scores(batch.column("text").to_pylist())
            columns = [batch.column(c) for c in kept] + [pa.array(names, pa.string()), pa.array(best, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    fields = [*(docs.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.select(*{*kept, "text"}).mapInArrow(apply, T.StructType(fields))


def held_out(doc_id: str = "doc_id"):
    """The documents that are not learned from; null ids are among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs (doc_id, text, lang), learned from the rest.

    Of languages with the same score the first by name is predicted. Repeated rows stay; an empty table gives an empty result.
    """
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    found = predict(docs, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
