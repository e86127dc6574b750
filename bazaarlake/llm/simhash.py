"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint is compared under bit masks. Every bit position gets a non-zero vector of ``radius + 1`` bits; the mask of
each non-zero vector v keeps the positions whose vector has an odd scalar product with v. The positions in which two
fingerprints within the radius differ give at most ``radius`` linear equations in ``radius + 1`` unknowns, so some v is
orthogonal to all of them: under its mask the two are equal. No pair within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.components import components
from bazaarlake.llm.storage import drop_table, write_table
from bazaarlake.llm.text import LOWER, WORDS, pieces

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
# Fingerprints that share a masked value are compared in one task up to this number; beyond it they are masked again.
# A mask leaves about half of the bits free, so after two masks some 16 bits are free and a second group has no more
# than about 2^16 fingerprints, however many there are in all.
GROUP_ROWS = 4096


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set if it is set in over half the hashes of the word shingles. 0 if there are no words."""
    ones, n, words = np.zeros(64, np.int64), 0, []
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").translate(LOWER)):
        words = words[-(shingle_words - 1) :] if shingle_words > 1 and n else words
        words = words + WORDS.findall(piece)
        if len(words) >= shingle_words:
            counted = _bits(words, shingle_words)
            ones, n = ones + counted[0], n + counted[1]
    if not n and words:
        ones, n = _bits(words, len(words))
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0]) if n else 0


def _bits(words: list[bytes], k: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of the shingles of k words, and their number."""
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    return _ones(hashes), len(hashes)


def _ones(hashes: np.ndarray) -> np.ndarray:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):
        part = hashes[at : at + 255].view(np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(part, axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return ones


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of hashes made already: a bit is set if it is set in over half of them. 0 if there are none."""
    return int(np.packbits(_ones(hashes) * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash (64 bits, to tell rows with equal doc_ids apart) and fp of every row; a null text counts as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle_words) for t in batch.column("text")]
            signed = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), signed], names=["doc_id", "text_hash", "fp"]
            )

    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return hashed.mapInArrow(scan, "doc_id long, text_hash long, fp long")


def masks(radius: int, positions: list[int], tries: int = 1) -> list[int]:
    """Covering masks over some bit positions; of several draws of the vectors the one whose smallest mask is largest.

    Any vectors cover; evenly drawn ones make all masks keep about half of the positions.
    """
    count, best = 2 ** (radius + 1) - 1, []
    for seed in range(tries):
        rng = np.random.default_rng(seed)
        drawn = np.concatenate([rng.permutation(count) + 1 for _ in range(-(-len(positions) // count))])
        vectors = list(zip(positions, drawn.tolist(), strict=False))
        found = [sum(1 << p for p, m in vectors if (m & v).bit_count() % 2) for v in range(1, count + 1)]
        best = max(best, found, key=lambda ms: min((m.bit_count() for m in ms), default=-1))
    return best


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_in_group(group: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """Links that connect what is connected within the radius: a search that drops what it has reached.

    A dense group is reached in a few steps, so only scattered groups cost the square of their size.
    """
    links, left = [], group
    while len(left) > 1:
        seed, left = left[0], left[1:]
        reached = [seed]
        while reached and len(left):
            near = np.bitwise_count(left ^ reached.pop()) <= radius
            if near.any():
                hits = left[near]
                links.append((seed, hits))
                reached.extend(hits)
                left = left[~near]
    return links


def _link(accept: int, limit: float):
    """Arrow function over rows (tbl, masked, fp) sorted by these: rows (tbl, a, b).

    Links have tbl -1. The rows of a group beyond the limit are given out again, as (tbl, masked, fp), for more masks.
    At most ``limit`` rows of an unfinished group are held.
    """
    def rows(tbl, a, b):
        columns = [np.asarray(tbl, np.int32), np.asarray(a).astype(np.int64), np.asarray(b).astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tbl", "a", "b"])

    def groups(tbl, key, fp) -> Iterator[pa.RecordBatch]:
        """Whole groups."""
        starts = np.flatnonzero(np.r_[True, (tbl[1:] != tbl[:-1]) | (key[1:] != key[:-1])])
        sizes = np.diff(np.r_[starts, len(tbl)])
        # Most groups are pairs; larger ones give a link less than they have members.
        pair = starts[sizes == 2]
        pair = pair[np.bitwise_count((fp[pair] ^ fp[np.minimum(pair + 1, len(fp) - 1)]).view(np.uint64)) <= accept]
        a, b, over = [fp[pair]], [fp[pair + 1]], []
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            if size > limit:
                over.append(slice(start, start + size))
                continue
            for seed, hits in near_in_group(fp[start : start + size].view(np.uint64), accept):
                a.append(np.full(len(hits), seed).view(np.int64))
                b.append(hits.view(np.int64))
        if a and sum(map(len, a)):
            a, b = np.concatenate(a), np.concatenate(b)
            yield rows(np.full(len(a), -1), a, b)
        for s in over:
            yield rows(tbl[s], key[s], fp[s])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tuple(np.zeros(0, t) for t in (np.int32, np.int64, np.int64))
        spilling = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("tbl", "masked", "fp")]
            if spilling is not None:
                rest = np.flatnonzero((new[0] != spilling[0]) | (new[1] != spilling[1]))
                stop = rest[0] if len(rest) else len(new[0])
                if stop:
                    yield rows(*(c[:stop] for c in new))
                new = [c[stop:] for c in new]
            tbl, key, fp = (np.concatenate(pair) for pair in zip(held, new, strict=True))
            if not len(tbl):
                continue
            spilling = None
            last = len(tbl) - 1 - int(np.argmax(((tbl != tbl[-1]) | (key != key[-1]))[::-1])) + 1
            last = 0 if (tbl[0], key[0]) == (tbl[-1], key[-1]) else last
            if last:
                yield from groups(tbl[:last], key[:last], fp[:last])
            held = (tbl[last:], key[last:], fp[last:])
            if len(held[0]) > limit:
                yield rows(*held)
                spilling, held = (held[0][0], held[1][0]), tuple(c[:0] for c in held)
        if len(held[0]):
            yield from groups(*held)

    return link


def links(fps: DataFrame, radius: int, accept: int, group_rows: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp), see near_duplicates."""
    first = masks(radius, list(range(64)), 100)

    def grouped(df: DataFrame, limit: float) -> DataFrame:
        dealt = df.repartition("tbl", "masked").sortWithinPartitions("tbl", "masked", "fp")
        return dealt.mapInArrow(_link(accept, limit), "tbl int, a long, b long")

    values = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in first))
    found = write_table(grouped(fps.select(F.posexplode(values).alias("tbl", "masked"), "fp"), group_rows), "links")

    def mask_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of large groups under masks that cover all that is accepted, as it is in smaller groups."""
        fuller = {}
        for batch in batches:
            tbl, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tbl", "fp"))
            for t in np.unique(tbl).tolist():
                if t not in fuller:
                    free = masks(accept, [p for p in range(64) if not first[t] >> p & 1])
                    fuller[t] = np.array([_signed(first[t] | m) for m in free])
                own, number = fp[tbl == t], len(fuller[t])
                for at in range(0, len(own), 1024):
                    part = own[at : at + 1024]
                    sub = np.tile(np.arange(t * number, (t + 1) * number, dtype=np.int32), len(part))
                    arrays = [sub, (part[:, None] & fuller[t]).ravel(), np.repeat(part, number)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names=["tbl", "masked", "fp"])

    large = found.filter("tbl >= 0").select("tbl", F.col("b").alias("fp")).mapInArrow(mask_again, "tbl int, masked long, fp long")
    edges = found.filter("tbl < 0").union(grouped(large, float("inf")))
    return edges.select("a", "b")


def near_duplicates(
    docs: DataFrame,
    radius: int = RADIUS,
    shingle_words: int = SHINGLE_WORDS,
    accept: int | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """doc_id, text_hash, fp and component_id of every row of docs (doc_id, text).

    Fingerprints that differ in ``accept`` bits at most (default: ``radius``) are linked if they meet in a table. Up to
    ``radius`` bits they always do; beyond it most still do, with a chance that halves with each further bit.
    component_id is the smallest doc_id that links reach. Equal
    fingerprints are one node, so copies cost nothing more. Null doc_ids are never the smallest (a component of
    only such rows has a null id); null and empty texts share fingerprint 0 and are linked like any other; repeated rows stay.
    An empty table gives an empty result.
    """
    marked = write_table(fingerprints(docs, shingle_words), "fingerprints")
    count = marked.count()
    nodes = write_table(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes", count)
    roots = components(links(nodes.select("fp"), radius, radius if accept is None else accept, group_rows))
    linked = write_table(nodes.join(roots, F.col("fp") == F.col("node")).select("fp", "first", "root"), "linked", count)
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(write_table(least, "least", count), "root").select("fp", "component_id")
    alone = nodes.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("first").alias("component_id"))
    found = write_table(named.union(alone), "components", count)
    drop_table(nodes)
    return marked.join(found, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int, shingle_words: int, accept: int) -> DataFrame:
    """One row of each component of near duplicates, with all its columns: the one with the smallest doc_id.

    Rows with the same doc_id are told apart by a hash of their text; rows without a doc_id come last.
    """
    # A component without any doc_id is named by its fingerprints alone, which are all it has.
    name = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    return keep_rows(docs, near_duplicates(docs, radius, shingle_words, accept), name, "fp")


def keep_rows(docs: DataFrame, grouped: DataFrame, name: list, last: str) -> DataFrame:
    """The rows of docs that come first (by doc_id, text_hash and the column ``last``) in their group of ``grouped``."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", last)
    kept = grouped.groupBy(*name).agg(F.min(order).alias("k"))
    kept = write_table(kept.select(F.col("k.doc_id").alias("id"), F.col("k.text_hash").alias("hash")).distinct(), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_hash"))
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_hash") == F.col("hash"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["row_id", "row_hash"]).select("row.*")
