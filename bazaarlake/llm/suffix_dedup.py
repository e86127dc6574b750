"""Removal of repeated strings of LENGTH bytes, by suffix arrays over the places where texts agree.

1. Texts are cut into fragments by anchors (see `anchors`): equal strings lie in fragments with the same anchor. Equal
   fragments are copies; all but the earliest are repeats as a whole. They are combined in each task before the shuffle, so
   that a passage which very many documents share is one row of each task.
2. Anchors with different fragments are the places where texts agree only in part. Their distinct fragments are
   fetched and put together, one text for each anchor, and suffix arrays (see `suffix_array`) bring equal strings side by
   side. Of equal strings all but the earliest are repeats.
3. The repeats of a document are merged and cut out.

Documents are numbered first, in the order of doc_id and then of a hash of 128 bits; the number tells them apart and orders them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.anchors import LENGTH, runs
from bazaarlake.llm.storage import WIDE_ROWS, write_table
from bazaarlake.llm.suffix_array import suffix_orders

# Anchors that a task combines before it passes them on.
COMBINED_ROWS = 250_000
# Anchors with more bytes are first reduced to the strings whose hash repeats in them.
PLAIN_BYTES = 4096
# Bytes that are given to one call for suffix arrays.
BATCH_BYTES = 800_000
# Fragments that a task cuts before it passes them on.
CUT_ROWS = 10_000
# Documents of one range are numbered within so many bits.
NUMBER_BITS = 40
# Bytes of one anchor that a task holds; beyond it, its strings are dealt out one by one.
HELD_BYTES = 16 << 20

# span: start and the number of starts (0: a repeat, whose bytes are counted in `fragment`) in one number.
CANDIDATES = "key long, fragment long, doc long, span long"
# kind 0: a repeat; 1: a fragment to be compared; 2: a single string (key and fragment are its hash).
RESULTS = "kind int, key long, fragment long, doc long, start long, length long"
FRAGMENTS = "key long, doc long, start long, data binary"


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _merge(doc, start, length) -> tuple[np.ndarray, ...]:
    """Intervals of the same document that overlap or touch as one."""
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], (start + length)[by]
    if not len(doc):
        return doc, start, end
    fresh = np.r_[True, doc[1:] != doc[:-1]]
    # Ends so far, per document: documents are put one after the other on one line.
    offset = np.cumsum(fresh) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + offset)
    begin = np.flatnonzero(fresh | np.r_[True, (start + offset)[1:] > reach[:-1]])
    return doc[begin], start[begin], (reach - offset)[np.r_[begin[1:], len(doc)] - 1] - start[begin]


def _numbered(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns to keep, _doc, _bytes and _packed (the text compressed with Zstandard) of every row, written.

    _doc numbers documents in the order of doc_id, nulls last, and then of a hash of 128 bits of the text; rows that repeat both
    have one number. Rows without a doc_id are cut into ranges by the hash.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass")
                rows.append((len(data), xxhash.xxh3_128_digest(data), compressor.compress(data)))
            sizes, digests, packed = zip(*rows, strict=True) if rows else ((), (), ())
            made = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())]
            columns = [*(batch.column(c) for c in ("_id", *keep)), *made]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", *keep, "_bytes", "_digest", "_packed"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, TaskContext.get().partitionId() << NUMBER_BITS
        for batch in batches:
            numbers = []
            for row in zip(batch.column("_id").to_pylist(), batch.column("_digest").to_pylist(), strict=True):
                count += row != last
                numbers.append(count)
                last = row
            columns = [*(batch.column(c) for c in (*keep, "_bytes", "_packed")), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "_bytes", "_packed", "_doc"])

    docs = docs.withColumn("_id", F.col("doc_id").cast("long"))
    kept = [docs.schema[c] for c in keep]
    size, text = T.StructField("_bytes", T.LongType()), T.StructField("_packed", T.BinaryType())
    fields = [docs.schema["_id"], *kept, size, T.StructField("_digest", T.BinaryType()), text]
    packed = docs.select(*dict.fromkeys(["_id", *keep, "text"])).mapInArrow(pack, T.StructType(fields))
    order = [F.col("_id").asc_nulls_last(), F.col("_digest").asc()]
    # Texts are packed twice, for the cuts of the ranges and for the ranges; that costs less than writing them in between.
    ranges = packed.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranges.mapInArrow(number, T.StructType([*kept, size, text, T.StructField("_doc", T.LongType())]))
    numbered = write_table(numbered, "suffix-texts", batch_rows=WIDE_ROWS)
    return numbered


def _candidates(texts: DataFrame) -> DataFrame:
    """CANDIDATES: one row per fragment that no other of the task equals and precedes, and the repeats found on the way."""

    def combine(rows) -> Iterator[pa.RecordBatch]:
        key, fragment, doc, span = (np.concatenate(c) for c in zip(*rows, strict=True))
        by = np.lexsort((span, doc, fragment, key))
        key, fragment, doc, span = key[by], fragment[by], doc[by], span[by]
        first = np.r_[True, (key[1:] != key[:-1]) | (fragment[1:] != fragment[:-1])]
        head = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        later = (doc != doc[head]) | (span >> 7 != span[head] >> 7)
        yield _batch(CANDIDATES, key[~later], fragment[~later], doc[~later], span[~later])
        doc, start, length = _merge(doc[later], span[later] >> 7, (span[later] & 127) + LENGTH - 1)
        # Any key will do for these: it only spreads them.
        yield _batch(CANDIDATES, (doc * 0x9E3779B1) ^ (start * 0x85EBCA77), length, doc, start << 7)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, decompressor = [], 0, zstandard.ZstdDecompressor()
        for batch in batches:
            columns = (batch.column(c) for c in ("_doc", "_packed"))
            for number, packed in zip(*columns, strict=True):
                data = decompressor.decompress(packed.as_py())
                for key, fragment, start, count in runs(data):
                    rows.append((key, fragment, np.full(len(key), number.as_py()), start << 7 | count))
                    size += len(key)
                if size >= COMBINED_ROWS:
                    yield from combine(rows)
                    rows, size = [], 0
        if rows:
            yield from combine(rows)

    return texts.filter(F.col("_bytes") >= LENGTH).select("_doc", "_packed").mapInArrow(scan, CANDIDATES)


def _resolve(candidates: DataFrame) -> DataFrame:
    """RESULTS: the repeats among equal fragments, and the earliest of each fragment of an anchor that has several."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The earliest row of the fragment that is still open, and whether it has been asked for.
        held, asked = None, False
        for batch in batches:
            key, fragment, doc, span = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            known = (span & 127) == 0
            if known.any():
                columns = doc[known], span[known] >> 7, fragment[known]
                zero = np.zeros(len(columns[0]), np.int64)
                yield _batch(RESULTS, zero, zero, zero, *columns)
            rows = [c[~known] for c in (key, fragment, doc, span)]
            if not len(rows[0]):
                continue
            carried = held is not None and held[0] == rows[0][0]
            if carried:
                rows = [np.r_[h, c] for h, c in zip(held, rows, strict=True)]
            key, fragment, doc, span = rows
            anchor = np.r_[True, key[1:] != key[:-1]]
            first = anchor | np.r_[True, fragment[1:] != fragment[:-1]]
            head = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
            later = (doc != doc[head]) | (span >> 7 != span[head] >> 7)
            number = np.cumsum(anchor) - 1
            several = np.bincount(number, first) > 1
            several[0] |= carried and asked
            wanted = first & several[number]
            if carried and asked:
                wanted[0] = False
            for kind, chosen in ((0, later), (1, wanted)):
                if chosen.any():
                    s = span[chosen]
                    columns = key[chosen], fragment[chosen], doc[chosen], s >> 7, (s & 127) + LENGTH - 1
                    yield _batch(RESULTS, np.full(len(s), kind), *columns)
            held = tuple(c[head[-1]] for c in rows)
            asked = bool(several[number[-1]])

    dealt = candidates.repartition("key").sortWithinPartitions("key", "fragment", "doc", "span")
    return dealt.mapInArrow(stream, RESULTS)


def _fragments(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """FRAGMENTS: the bytes of the fragments that are to be compared."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for number, packed, wanted in zip(*batch.columns, strict=True):
                data = decompressor.decompress(packed.as_py())
                for w in wanted.as_py():
                    piece = data[w["start"] : w["start"] + w["length"]]
                    rows.append((w["key"], number.as_py(), w["start"], piece))
                if len(rows) >= CUT_ROWS:
                    yield _batch(FRAGMENTS, *zip(*rows, strict=True))
                    rows = []
            if rows:
                yield _batch(FRAGMENTS, *zip(*rows, strict=True))

    wanted = requests.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "length")).alias("_wanted"))
    # Both sides grow with the documents: joined by a shuffle at every size.
    joined = texts.join(wanted.hint("merge"), F.col("_doc") == F.col("doc")).select("_doc", "_packed", "_wanted")
    return joined.mapInArrow(cut, FRAGMENTS)


def string_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the LENGTH bytes from each position on."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(data) + 1, 0x9E3779B97F4A7C15, np.uint64))
        sums = np.cumsum(np.r_[np.uint64(0), (data.astype(np.uint64) + np.uint64(7)) * powers[:-1]])
        # Sums are compared after they are brought to the same power.
        return (sums[LENGTH:] - sums[:-LENGTH]) * powers[::-1][LENGTH:]


def _trim(pieces: list[tuple]) -> list[tuple]:
    """The parts of fragments (data, doc, start) whose strings have a hash that occurs again among them."""
    data = np.frombuffer(b"".join(p[0] for p in pieces), np.uint8)
    sizes = np.array([len(p[0]) for p in pieces])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(pieces)), sizes)[: len(data) - LENGTH + 1]
    inside = np.arange(len(owner)) + LENGTH <= ends[owner]
    hashes = string_hashes(data)
    _, place, times = np.unique(hashes[inside], return_inverse=True, return_counts=True)
    again = np.zeros(len(owner), bool)
    again[np.flatnonzero(inside)[times[place] > 1]] = True
    begin = np.flatnonzero(again & np.r_[True, ~again[:-1] | (owner[1:] != owner[:-1])])
    stop = np.flatnonzero(again & np.r_[~again[1:] | (owner[1:] != owner[:-1]), True]) + LENGTH
    found = []
    for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
        whole, doc, start = pieces[owner[a]]
        at = a - int(ends[owner[a]]) + len(whole)
        found.append((whole[at : at + b - a], doc, start + at))
    return found


def _distinct(pieces: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The earliest of equal pieces, and the intervals of the others."""
    kept, repeats = {}, []
    for piece in sorted(pieces, key=lambda p: p[1:3]):
        first = kept.setdefault(piece[0], piece)
        if first[1:] != piece[1:]:
            repeats.append((*piece[1:], len(piece[0])))
    return list(kept.values()), repeats


def repeats_among(anchors: list[list[tuple]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Intervals (doc, start, length) of repeated strings among the pieces of each anchor, from suffix arrays."""
    anchors = [a for a in anchors if len(a) > 1]
    if not anchors:
        return
    pieces = [p for a in anchors for p in a]
    # Behind each piece stands 1, and a 0 behind the last one of an anchor.
    sizes = np.array([len(p[0]) + 1 for p in pieces])
    last = np.zeros(len(pieces), bool)
    last[np.cumsum([len(a) for a in anchors]) - 1] = True
    room = sizes + last
    begin = np.cumsum(room) - room
    text = np.ones(int(room.sum()), np.int64)
    text[(begin + room - 1)[last]] = 0
    for at, piece in zip(begin.tolist(), pieces, strict=True):
        text[at : at + len(piece[0])] = np.frombuffer(piece[0], np.uint8)
        text[at : at + len(piece[0])] += 2
    starts = begin[np.r_[True, last[:-1]]]
    order = suffix_orders(text, starts)
    owner = np.repeat(np.arange(len(pieces)), room)
    inside = np.arange(len(text)) + LENGTH <= (begin + sizes - 1)[owner]
    hashes = np.r_[string_hashes(text), np.zeros(LENGTH - 1, np.uint64)]
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(inside[a] & inside[b] & (hashes[a] == hashes[b]))
    reach = np.arange(LENGTH)
    equal = np.zeros(len(order), bool)
    for at in range(0, len(near), 1 << 14):
        part = near[at : at + (1 << 14)]
        equal[part + 1] = (text[a[part][:, None] + reach] == text[b[part][:, None] + reach]).all(axis=1)
    strings = np.flatnonzero(equal | np.r_[equal[1:], False])
    number, at = np.cumsum(~equal)[strings], order[strings]
    doc, start = (np.array([p[k] for p in pieces], np.int64)[owner[at]] for k in (1, 2))
    start = start + at - begin[owner[at]]
    by = np.lexsort((start, doc, number))
    number, doc, start = number[by], doc[by], start[by]
    head = np.maximum.accumulate(np.where(np.r_[True, number[1:] != number[:-1]][: len(number)], np.arange(len(number)), 0))
    later = (doc != doc[head]) | (start != start[head])
    if later.any():
        yield _merge(doc[later], start[later], np.full(int(later.sum()), LENGTH))


def _single_strings(pieces: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Every distinct string of the pieces, earliest first, as (hash, hash, doc, start), and the repeats."""
    kept, repeats = {}, []
    for data, doc, start in sorted(pieces, key=lambda p: p[1:3]):
        for at in range(len(data) - LENGTH + 1):
            value = xxhash.xxh3_128_digest(data[at : at + LENGTH])
            first = kept.setdefault(value, (doc, start + at))
            if first != (doc, start + at):
                repeats.append((doc, start + at, LENGTH))
    split = [(*np.frombuffer(v, np.int64).tolist(), *place) for v, place in kept.items()]
    return split, repeats


def _compare(fragments: DataFrame, held_bytes: int) -> DataFrame:
    """RESULTS of the strings that different fragments of an anchor share (kind 0), and single strings of very large anchors (kind 2)."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, size, dealt = None, [], 0, False
        ready: list[list[tuple]] = []
        filled = 0

        def spans(doc, start, length):
            zero = np.zeros(len(doc), np.int64)
            return _batch(RESULTS, zero, zero, zero, doc, start, length)

        def deal(pieces):
            strings, repeats = _single_strings(pieces)
            h1, h2, doc, start = zip(*strings, strict=True)
            yield _batch(RESULTS, [2] * len(doc), h1, h2, doc, start, [LENGTH] * len(doc))
            if repeats:
                yield spans(*zip(*repeats, strict=True))

        def close(pieces, size, dealt):
            nonlocal filled
            if dealt:
                yield from deal(pieces) if pieces else ()
                return
            if size > PLAIN_BYTES:
                pieces, repeats = _distinct(_trim(pieces))
                if repeats:
                    yield spans(*zip(*repeats, strict=True))
            if len(pieces) > 1:
                ready.append(pieces)
                filled += sum(len(p[0]) + 2 for p in pieces)
            if filled >= BATCH_BYTES:
                for found in repeats_among(ready):
                    yield spans(*found)
                ready.clear()
                filled = 0

        for batch in batches:
            for value, doc, start, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if value != key:
                    yield from close(pieces, size, dealt)
                    key, pieces, size, dealt = value, [], 0, False
                pieces.append((data, doc, start))
                size += len(data)
                if size > held_bytes:
                    yield from deal(pieces)
                    pieces, size, dealt = [], 0, True
        yield from close(pieces, size, dealt)
        for found in repeats_among(ready):
            yield spans(*found)

    return fragments.repartition("key").sortWithinPartitions("key").mapInArrow(stream, RESULTS)


def repeats(texts: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """RESULTS of kind 0: intervals that together are all bytes of a string that also starts earlier."""
    first = write_table(_resolve(_candidates(texts)), "suffix-runs", batch_rows=WIDE_ROWS)
    requests = first.filter("kind = 1")
    second = write_table(_compare(_fragments(texts, requests), held_bytes), "suffix-repeats", batch_rows=WIDE_ROWS)
    strings = second.filter("kind = 2").select(
        "key", "fragment", "doc", F.expr("shiftleft(start, 7) | 1").alias("span")
    )
    third = _resolve(strings)
    return first.union(second).union(third).filter("kind = 0").select("doc", "start", "length")


def remove_repeats(
    docs: DataFrame, keep: Sequence[str], as_text: bool = False, held_bytes: int = HELD_BYTES
) -> DataFrame:
    """The columns to keep of every row of docs (doc_id, text), ``kept`` (the remaining bytes), n_bytes, n_removed and n_spans.

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a row with a smaller doc_id, or at an earlier place in the
    same row. Rows without a doc_id come behind all others; of rows with equal ids, or none, and different texts, those come first whose
    text has the smaller hash (128 bits). Rows that repeat doc_id and text are one document and are judged alike. Null texts count as empty. Strings never cross rows and are judged on the whole input. With ``as_text`` kept is a string, without the
    rest of characters that were cut in two.
    """
    columns = [c for c in keep if c not in ("kept", "n_bytes", "n_removed", "n_spans")]
    texts = _numbered(docs, columns)
    spans = repeats(texts, held_bytes).groupBy(F.col("doc").alias("_span_doc"))
    spans = spans.agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_spans"))
    joined = texts.join(spans.hint("merge"), F.col("_doc") == F.col("_span_doc"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, counts = [], []
            for packed, spans in zip(batch.column("_packed"), batch.column("_spans"), strict=True):
                data, left, at, removed, number = decompressor.decompress(packed.as_py()), [], 0, 0, 0
                end = -1
                for span in spans.as_py() or []:
                    start, stop = span["start"], span["start"] + span["length"]
                    if start > end:
                        number += 1
                        left.append(data[max(end, 0) : start])
                        removed += stop - start
                    else:
                        removed += max(0, stop - end)
                    end = max(end, stop)
                left.append(data[max(end, 0) :])
                kept.append(b"".join(left))
                counts.append((len(data), removed, number))
            texts = [k.decode("utf-8", "ignore") for k in kept] if as_text else kept
            arrays = [pa.array(texts, pa.string() if as_text else pa.binary()), *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True))]
            names = [*columns, "kept", "n_bytes", "n_removed", "n_spans"]
            if counts:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *arrays], names=names)

    fields = [*(docs.schema[c] for c in columns), T.StructField("kept", T.StringType() if as_text else T.BinaryType())]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    return joined.select(*columns, "_packed", "_spans").mapInArrow(cut, T.StructType(fields))
