"""Toxicity by class-conditional Kneser-Ney models over characters.

Two interpolated Kneser-Ney models of the same order, one of toxic and one of ordinary texts, share their backoff: the
lower orders are continuation counts of both classes together, so an expression that one class has hardly seen costs
the same in both. A text's score compares its length-normalised log-likelihoods.

Symbols are the characters of the lower-cased text, of any script; white space is one blank. The models are written tables of
all n-grams that were seen, so they grow with the labelled texts. Texts are kept in blocks: a block asks for the n-grams
that it holds, each once, and the answers meet the block again. Blocks lie in buckets by their number, so texts
are not moved for that.

An n-gram that no class has seen differs between the classes by the weight of its context's backoff alone, and not at
all if the context is new to both. So the tables have a row for every n-gram seen and one for every context.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import drop_table, shared_folder, write_table

ORDER = 4
DISCOUNT = 0.75
# Symbols over which the likelihoods are compared; a text counts by its most toxic window.
WINDOW = 32
# A block closes when it has so many characters; a longer text is a block of its own.
BLOCK = 1 << 23
# N-grams are handled for so many symbols at once; n-grams and windows of a text go on across them.
PIECE = 1 << 20
# Calibration sees scores in steps of 1 / STEPS.
STEPS = 100
MIX = np.uint64(0x9E3779B97F4A7C15)


def symbols(text: str | None) -> str:
    """The lower-cased words of a text with a blank before, between and after them; one blank if there are none."""
    words = " ".join((text or "").lower().split())
    return f" {words} " if words else " "


def pieces(texts: list[str | None], order: int, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number and number of symbols of each run, symbols that end an n-gram after the order - 1 before it).

    The last array has a row for every n-gram: its code points. A long text gives several runs, in order.
    """
    numbers, lengths, runs, held, size = [], [], [], 0, size or PIECE
    for number, text in enumerate(texts):
        line = " " * (order - 1) + symbols(text)
        for at in range(0, len(line) - order + 1, size):
            run = line[at : at + size + order - 1]
            numbers, lengths, runs, held = [*numbers, number], [*lengths, len(run) - order + 1], [*runs, run], held + len(run)
            if held >= size:
                yield _windows(numbers, lengths, runs, order)
                numbers, lengths, runs, held = [], [], [], 0
    if runs:
        yield _windows(numbers, lengths, runs, order)


def _windows(numbers: list[int], lengths: list[int], runs: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
    every = np.lib.stride_tricks.sliding_window_view(codes, order)
    # The windows that begin in the last order - 1 symbols of a run would end in the next one.
    at = np.arange(sum(lengths)) + np.repeat(np.arange(len(lengths)) * (order - 1), lengths)
    return np.array(numbers), np.array(lengths), every[at]


def keys(rows: np.ndarray) -> np.ndarray:
    """64 bits for each row of code points."""
    key = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        key = (key ^ column) * MIX
        key ^= key >> np.uint64(32)
    return key


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's n-gram, and the different n-grams in order of their first row."""
    number, _ = pd.factorize(keys(rows))
    first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))
    return number, rows[first]


def _strings(rows: np.ndarray) -> pa.Array:
    """Rows of code points as text."""
    n, text = rows.shape[1], np.ascontiguousarray(rows).tobytes().decode("utf-32-le")
    return pa.array([text[i : i + n] for i in range(0, len(text), n)], pa.string())


def _codes(texts: pa.Array, n: int) -> np.ndarray:
    """Texts of n symbols each as rows of code points."""
    return np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, n)


def pack_blocks(docs: DataFrame, size: int | None = None) -> DataFrame:
    """(block, doc_ids, sizes, packed): texts of some megabytes as one Zstandard frame, written in buckets by block."""
    size = size or BLOCK

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0

        def block() -> pa.RecordBatch:
            whole = zstandard.ZstdCompressor(level=6).compress(b"".join(texts))
            columns = [[uuid.uuid4().int >> 65], [ids], [[len(t) for t in texts]], [whole]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(*c) for c in zip(columns, types)], names=["block", "doc_ids", "sizes", "packed"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(doc_id)
                texts.append((text.as_py() or "").encode())
                held += len(texts[-1])
                if held >= size:
                    yield block()
                    ids, texts, held = [], [], 0
        if ids:
            yield block()

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, "block long, doc_ids array<long>, sizes array<long>, packed binary"
    )
    spark, name = docs.sparkSession, f"toxic_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed.write.bucketBy(buckets, "block").option("path", shared_folder(spark, "toxic-blocks")).saveAsTable(name)
    return spark.table(name)


def _unpack(table: pa.Table | pa.RecordBatch, row: int) -> list[str]:
    whole = zstandard.ZstdDecompressor().decompress(table.column("packed")[row].as_py())
    ends = np.cumsum(table.column("sizes")[row].as_py())
    return [whole[a:b].decode() for a, b in zip(np.r_[0, ends[:-1]], ends)]


def count_grams(blocks: DataFrame, train: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ordinary, toxic) counts over the texts with a label: counted per block, then added up."""
    places = blocks.select("block", F.posexplode("doc_ids").alias("place", "doc_id"))
    # Labels grow with the documents, so they are never broadcast; only numbers move here.
    labelled = places.join(train.hint("merge"), "doc_id").select(F.col("block").alias("of_block"), "place", "toxic")
    names = ["gram", "ordinary", "toxic"]

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        found, counts = [np.zeros((0, order), np.uint32)], [np.zeros((2, 0), np.int64)]
        if len(left) and len(right):
            texts, toxic = _unpack(left, 0), right.column("toxic").to_numpy()
            for texts_at, lengths, rows in pieces([texts[i] for i in right.column("place").to_pylist()], order):
                number, grams = distinct(rows)
                of_toxic = np.repeat(toxic[texts_at], lengths) == 1
                found.append(grams)
                counts.append(np.stack([np.bincount(number[of_toxic == c], minlength=len(grams)) for c in (False, True)]))
        number, grams = distinct(np.concatenate(found))
        sums = [np.bincount(number, c, len(grams)).astype(np.int64) for c in np.concatenate(counts, axis=1)]
        return pa.Table.from_arrays([_strings(grams), pa.array(sums[0]), pa.array(sums[1])], names=names)

    met = blocks.select("block", "sizes", "packed").groupBy("block").cogroup(labelled.groupBy("of_block"))
    return met.applyInArrow(count, "gram string, ordinary long, toxic long").groupBy("gram").agg(
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")
    )


def _interpolate(count: Column, total: Column, types: Column, lower: Column, discount: float) -> Column:
    """Kneser-Ney chance from counts; a context without counts takes the lower order as it is."""
    return F.when(total > 0, F.greatest(count - discount, F.lit(0)) / total + discount * types / total * lower).otherwise(lower)


def _context(n: int) -> Column:
    return F.substring("gram", 1, n - 1).alias("context")


def shared_model(grams: DataFrame, order: int, discount: float) -> DataFrame:
    """(gram, lower): interpolated Kneser-Ney chances of the n-grams one shorter than the given ones (gram).

    Counts are those of different longer n-grams, of both classes together; below one symbol chances are even among all
    symbols and one for those never seen.
    """
    suffix, counts = F.substring("gram", 2, order).alias("gram"), [grams.select("gram")]
    for _ in range(1, order):
        counts.append(counts[-1].groupBy(suffix).agg(F.count("*").alias("count")))
    result = None
    for n, counted in enumerate(reversed(counts[1:]), start=1):
        if n == 1:
            sums = counted.agg(F.sum("count").alias("total"), F.count("*").alias("types"))
            # One row of sums.
            known = counted.crossJoin(F.broadcast(sums)).withColumn("lower", 1 / (F.col("types") + 1))
        else:
            sums = counted.groupBy(_context(n)).agg(F.sum("count").alias("total"), F.count("*").alias("types"))
            known = counted.withColumn("context", _context(n)).join(sums, "context").withColumn("suffix", F.substring("gram", 2, n))
            known = known.join(result.withColumnRenamed("gram", "suffix"), "suffix")
        chance = _interpolate(F.col("count"), F.col("total"), F.col("types"), F.col("lower"), discount)
        result = known.select("gram", chance.alias("lower"))
    return result


def log_ratios(counts: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> DataFrame:
    """(part, ratio): log P(symbol | toxic, context) - log P(symbol | ordinary, context).

    For every n-gram of counts (gram, ordinary, toxic), and for every context (one symbol less) with any symbol that was not
    seen after it. P_class = (count - D)+ / context + D * types / context * P_shared.
    """
    classes = ("toxic", "ordinary")
    split = counts.withColumn("context", _context(order)).withColumn("suffix", F.substring("gram", 2, order))
    sums = [F.sum(c).alias(f"{c}_total") for c in classes] + [F.count_if(F.col(c) > 0).alias(f"{c}_types") for c in classes]
    contexts = split.groupBy("context").agg(*sums)

    def difference(of_class) -> Column:
        return reduce(lambda a, b: a - b, [F.log(of_class(c)) for c in classes])

    def chance(c: str) -> Column:
        return _interpolate(F.col(c), F.col(f"{c}_total"), F.col(f"{c}_types"), F.col("lower"), discount)

    def backoff(c: str) -> Column:
        return _interpolate(F.lit(0.0), F.col(f"{c}_total"), F.col(f"{c}_types"), F.lit(1.0), discount)

    shared = shared_model(counts, order, discount).withColumnRenamed("gram", "suffix")
    known = split.join(contexts, "context").join(shared, "suffix").select(F.col("gram").alias("part"), difference(chance).alias("ratio"))
    return known.unionByName(contexts.select(F.col("context").alias("part"), difference(backoff).alias("ratio")))


def wanted_parts(blocks: DataFrame, order: int = ORDER) -> DataFrame:
    """(block, part): the different n-grams of each block, and the contexts of these."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = [distinct(rows)[1] for _, _, rows in pieces(_unpack(batch, row), order)]
                grams = distinct(np.concatenate(found))[1]
                for part in (grams, distinct(grams[:, :-1])[1]):
                    block = pa.array(np.full(len(part), batch.column("block")[row].as_py()), pa.int64())
                    yield pa.RecordBatch.from_arrays([block, _strings(part)], names=["block", "part"])

    return blocks.select("block", "sizes", "packed").mapInArrow(ask, "block long, part string")


def worst_window(runs: Iterator[np.ndarray], window: int) -> tuple[float, float]:
    """Mean of all values, and the highest mean of any run of ``window``; fewer values are taken as filled up with zeros."""
    best, held, total, seen = -np.inf, np.zeros(0), 0.0, 0
    for run in runs:
        values = np.r_[held, run]
        total, seen = total + float(run.sum()), seen + len(run)
        if len(values) >= window:
            sums = np.cumsum(np.r_[0.0, values])
            best = max(best, float((sums[window:] - sums[:-window]).max()))
        held = values[max(0, len(values) - window + 1) :]
    return total / max(1, seen), (best if seen >= window else total) / window


def block_ratios(texts: list[str], parts: pa.Array, ratios: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of a text, log-ratios of its n-grams), in order; a long text comes in several runs."""
    long, values = np.array([len(p) for p in parts.to_pylist()], np.int64) == order, []
    for chosen, n in ((long, order), (~long, order - 1)):
        known = keys(_codes(parts.filter(pa.array(chosen)), n))
        sort = np.argsort(known)
        values.append((np.r_[known[sort], np.uint64(0)], np.r_[ratios[chosen][sort], 0.0]))

    def look_up(rows: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        asked = keys(rows)
        at = np.searchsorted(table[0][:-1], asked)
        hit = (at < len(table[0]) - 1) & (table[0][at] == asked)
        return hit, np.where(hit, table[1][at], 0.0)

    for texts_at, lengths, rows in pieces(texts, order):
        number, grams = distinct(rows)
        (hit, ratio), (_, of_context) = look_up(grams, values[0]), look_up(grams[:, :-1], values[1])
        of_row = np.where(hit, ratio, of_context)[number]
        yield from zip(texts_at.tolist(), np.split(of_row, np.cumsum(lengths)[:-1]))


def raw_scores(blocks: DataFrame, model: DataFrame, order: int = ORDER, window: int = WINDOW) -> DataFrame:
    """doc_id and the length-normalised log-likelihood ratio of every whole text and of its most toxic window."""
    answers = wanted_parts(blocks, order).join(model, "part").withColumnRenamed("block", "of_block")

    def score_block(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, scores = _unpack(left, 0), []
        runs = block_ratios(texts, right.column("part").combine_chunks(), right.column("ratio").to_numpy(), order)
        current = next(runs, None)
        for number in range(len(texts)):

            def own(number: int = number) -> Iterator[np.ndarray]:
                nonlocal current
                while current is not None and current[0] == number:
                    yield current[1]
                    current = next(runs, None)

            scores.append(worst_window(own(), window))
        whole, worst = np.array(scores).T
        columns = [pa.array(left.column("doc_ids")[0].as_py(), pa.int64()), pa.array(whole), pa.array(worst)]
        return pa.Table.from_arrays(columns, names=["doc_id", "whole", "worst"])

    met = blocks.select("block", "doc_ids", "sizes", "packed").groupBy("block").cogroup(answers.groupBy("of_block"))
    return met.applyInArrow(score_block, "doc_id long, whole double, worst double")


def fit_logistic(values: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through counts of the two classes at some values (Newton steps)."""
    weights = np.zeros(2)
    x, n = np.stack([values, np.ones_like(values)], axis=1), ordinary + toxic
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (toxic - n * p) - ridge * weights * [1, 0]
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag([ridge, 1e-6])
        weights = weights + np.linalg.solve(hessian, gradient)
    return float(weights[0]), float(weights[1])


def score(docs: DataFrame, labels: DataFrame, order: int = ORDER, window: int = WINDOW, discount: float = DISCOUNT) -> DataFrame:
    """doc_id, held_out, score, predicted, whole and worst for every row of docs (doc_id, text).

    Learned from the rows of labels (doc_id, toxic) with toxic 0 or 1 and a document, except where
    crc32(doc_id) mod 5 is 0. Of several labels of a doc_id the highest counts. ``whole`` and ``worst`` are the mean
    log-ratios of the whole text and of its most toxic window; the score is a logistic curve over ``worst``, fitted to the
    same training rows. Null and empty texts get the score of a text without words; null doc_ids are held out; repeated
    rows stay. Without any training row every score is 0.5.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    held_out = F.coalesce(remainder == 0, F.lit(True))
    train = labels.filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out)
    train = write_table(train, "toxic-labels")
    blocks = pack_blocks(docs)
    counts = write_table(count_grams(blocks, train, order), "toxic-counts")
    model = write_table(log_ratios(counts, order, discount), "toxic-model")
    raw = write_table(raw_scores(blocks, model, order, window), "toxic-raw")
    # Log-ratios are bounded, so the number of steps is.
    step = F.round(F.col("worst") * STEPS).alias("bin")
    bins = raw.join(train, "doc_id").groupBy(step).pivot("toxic", [0, 1]).count().na.fill(0).toPandas()
    for table in (train, blocks, counts, model):
        drop_table(table)
    slope, shift = fit_logistic(*(bins[c].to_numpy(float) for c in ("bin", "0", "1"))) if len(bins) else (0.0, 0.0)
    chance = 1 / (1 + F.exp(-(F.col("worst") * (slope * STEPS) + shift)))
    scored = raw.select("doc_id", held_out.alias("held_out"), chance.alias("score"), "whole", "worst")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "whole", "worst")
