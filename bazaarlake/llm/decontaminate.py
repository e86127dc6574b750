"""Benchmark decontamination: training passages query a BM25 index of the test items.

Item weights are divided by the item's own total, so a passage's score is the share of the item's weight that it holds.
Passages go through three steps. Block-max WAND retrieves every item above the threshold: sums of block maxima, taken for many
passages at once, skip the blocks of items that cannot reach it, and the lists of the other blocks are walked from pivot to
pivot. The exact word sequences of question and answer decide.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import write_table
from bazaarlake.llm.text import pieces

K1, B = 1.2, 0.75
THRESHOLD = 0.5
# Word sequences that question and answer are compared by, and the share of them that must be found.
SEQUENCE_WORDS = 5
PART_OVERLAP = 0.6
WHOLE_OVERLAP = 0.8
# Items of one index, which is broadcast; larger test sets get several indexes, one pass over the passages for each.
INDEX_ITEMS = 10_000
BLOCKS = 64
# Passages have at least twice so many words, and twice those of the longest item.
STRIDE_WORDS = 64
BATCH_WORDS = 1 << 17

#: ASCII letters in lower case; other ASCII characters but digits are blanks.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256))

HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, overlap double"


def plain_bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(PLAIN)


def sequences(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """The sequences of SEQUENCE_WORDS words; of shorter texts the whole."""
    n = min(SEQUENCE_WORDS, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Inverted index of up to INDEX_ITEMS items, cut into blocks of items with their maxima."""

    def __init__(self, items: pd.DataFrame, df: dict[bytes, int], total: int, mean_words: float):
        self.ids = items["item_id"].tolist()
        self.questions = [plain_bytes(t).split() for t in items["question"]]
        self.answers = [plain_bytes(t).split() for t in items["answer"]]
        self.block_items = max(2, math.ceil(len(self.ids) / BLOCKS))
        lists: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for number, words in enumerate(q + a for q, a in zip(self.questions, self.answers, strict=True)):
            counts: dict[bytes, int] = defaultdict(int)
            for word in words:
                counts[word] += 1
            length = K1 * (1 - B + B * len(words) / mean_words)
            weights = {
                word: math.log(1 + (total - df[word] + 0.5) / (df[word] + 0.5)) * n * (K1 + 1) / (n + length)
                for word, n in counts.items()
            }
            own = sum(weights.values())
            for word, weight in weights.items():
                lists[word].append((number, weight / own))
        self.terms = {word: i for i, word in enumerate(lists)}
        blocks = max(1, math.ceil(len(self.ids) / self.block_items))
        # The part of each posting list that lies in a block, and its highest weight.
        self.postings: list[dict[int, list[tuple[int, float]]]] = [{} for _ in range(blocks)]
        self.block_highest = np.zeros((len(lists), blocks), np.float32)
        for term, postings in enumerate(lists.values()):
            for item, weight in postings:
                block = item // self.block_items
                self.postings[block].setdefault(term, []).append((item, weight))
                self.block_highest[term, block] = max(self.block_highest[term, block], weight)
        longest = max((len(q) + len(a) for q, a in zip(self.questions, self.answers, strict=True)), default=0)
        self.stride = max(STRIDE_WORDS, longest)

    def retrieve(self, terms: list[int], blocks: list[int], threshold: float) -> list[tuple[int, float]]:
        """Every item of some blocks whose summed weights of the terms reach the threshold, with its score.

        Within a block, lists are walked by WAND: the item at which the maxima of the lists up to it reach the threshold is the
        next that can, and lists before it are moved there.
        """
        found = []
        for block in blocks:
            lists = [self.postings[block][t] for t in terms if t in self.postings[block]]
            highest = [max(w for _, w in postings) for postings in lists]
            at = [0] * len(lists)
            while True:
                order = sorted((postings[at[k]][0], k) for k, postings in enumerate(lists) if at[k] < len(postings))
                reach, pivot = 0.0, None
                for item, k in order:
                    reach += highest[k]
                    if reach * (1 + 1e-9) >= threshold:
                        pivot = item
                        break
                if pivot is None:
                    break
                if order[0][0] == pivot:
                    score = sum(lists[k][at[k]][1] for item, k in order if item == pivot)
                    if score >= threshold:
                        found.append((pivot, score))
                for item, k in order:
                    if item > pivot or (item == pivot and order[0][0] != pivot):
                        continue
                    while at[k] < len(lists[k]) and lists[k][at[k]][0] < pivot + (order[0][0] == pivot):
                        at[k] += 1
        return found

    def verify(self, words: list[bytes], number: int) -> tuple[float, float | None, float]:
        """Shares of the question's, the answer's and all word sequences of an item that the words hold."""
        grams: dict[int, set] = {}

        def held(wanted: set) -> int:
            size = len(next(iter(wanted)))
            if size not in grams:
                grams[size] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
            return len(wanted & grams[size])

        parts = [sequences(p) for p in (self.questions[number], self.answers[number])]
        hits = [held(p) if p else 0 for p in parts]
        shares = [h / len(p) if p else None for h, p in zip(hits, parts, strict=True)]
        return shares[0] or 0.0, shares[1], sum(hits) / max(1, sum(map(len, parts)))


def _passages(texts: list[str | None], stride: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the text, words) in runs that overlap by one stride, so that no passage is cut."""
    for number, text in enumerate(texts):
        tail: list[bytes] = []
        for piece in pieces(plain_bytes(text)):
            words = tail + piece.split()
            yield number, words
            tail = words[-stride:]


def search(texts: list[str | None], index: Index, threshold: float) -> Iterator[tuple[int, int, float, list[bytes]]]:
    """(number of the text, item, score, words of the passage) of every passage and item above the threshold.

    A passage has two strides of words and the next one starts a stride later, so each item lies whole in one.
    """
    stride, get = index.stride, index.terms.get
    held, size = [], 0

    def flush():
        lengths = np.array([max(1, math.ceil(len(w) / stride)) for _, w in held])
        first = np.concatenate([[0], np.cumsum(lengths)])
        terms = np.fromiter((t for _, words in held for t in map(get, words, repeat(-1))), np.int64, size)
        window = np.concatenate([np.arange(len(w)) // stride + f for (_, w), f in zip(held, first, strict=False)])
        starts = np.repeat(first[:-1], [len(w) for _, w in held])
        known = terms >= 0
        terms, window, starts = terms[known], window[known], starts[known]
        back = window > starts
        codes = np.unique(np.r_[window * len(index.terms) + terms, (window[back] - 1) * len(index.terms) + terms[back]])
        if not len(codes):
            return
        window, terms = codes // len(index.terms), codes % len(index.terms)
        begins = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        ends = np.r_[begins[1:], len(window)]
        bounds = np.add.reduceat(index.block_highest[terms], begins, axis=0) >= threshold * (1 - 1e-4)
        for i in np.flatnonzero(bounds.any(axis=1)):
            hits = index.retrieve(terms[begins[i] : ends[i]].tolist(), np.flatnonzero(bounds[i]).tolist(), threshold)
            if hits:
                run = int(np.searchsorted(first, window[begins[i]], "right")) - 1
                number, words = held[run]
                start = (int(window[begins[i]]) - int(first[run])) * stride
                for item, score in hits:
                    yield number, item, score, words[start : start + 2 * stride]

    for number, words in _passages(texts, stride):
        if words:
            held.append((number, words))
            size += len(words)
        if size >= BATCH_WORDS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def leaks(texts: list[str | None], index: Index, threshold: float) -> Iterator[tuple[int, int, tuple]]:
    """(number of the text, item, (whole overlap, score, question and answer overlap)) of the passages that count."""
    for number, item, score, words in search(texts, index, threshold):
        question, answer, whole = index.verify(words, item)
        parts = [s for s, p in ((question, index.questions[item]), (answer, index.answers[item])) if p]
        if whole >= WHOLE_OVERLAP or (parts and min(parts) >= PART_OVERLAP):
            yield number, item, (whole, score, question, answer)


def _index_parts(items: DataFrame) -> Iterator[Index]:
    """Indexes of at most about INDEX_ITEMS items each; statistics are those of all items."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("question").to_pylist(), batch.column("answer").to_pylist(), strict=True)
            words = [plain_bytes(q).split() + plain_bytes(a).split() for q, a in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(words, pa.list_(pa.binary()))], names=["item_id", "words"])

    items = write_table(items.select("item_id", "question", "answer"), "benchmark")
    words = write_table(items.mapInArrow(tokens, "item_id long, words array<binary>"), "benchmark-words")
    total, length = words.agg(F.count("*"), F.avg(F.size("words"))).first()
    number = max(1, math.ceil(total / INDEX_ITEMS))
    df = words.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    part = F.pmod(F.xxhash64("item_id"), F.lit(number))
    for i in range(number):
        used = words.filter(part == i).select(F.explode("words").alias("word")).distinct()
        counts = {bytes(r["word"]): r["count"] for r in df.join(used, "word").toLocalIterator()}
        chosen = items.filter(part == i).toPandas()
        if counts:
            yield Index(chosen, counts, total, length or 1.0)


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and test item that it holds, with its best passage: HITS.

    Items are (item_id, question, answer); either text may be null. A passage that the index returns counts if it
    holds PART_OVERLAP of the word sequences of the question and of the answer, where there are any, or WHOLE_OVERLAP of all.
    Null and empty texts hold nothing; repeated rows give a row each; no items, no rows. Nothing is shuffled.
    """
    result = None
    for index in _index_parts(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids, best = batch.column("doc_id").to_pylist(), {}
                for number, item, row in leaks(batch.column("text").to_pylist(), index, threshold):
                    if (number, item) not in best or row[:2] > best[number, item][:2]:
                        best[number, item] = row
                rows = [(ids[n], index.ids[i], s, q, a, w) for (n, i), (w, s, q, a) in best.items()]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.float64()]
                names = [part.split()[0] for part in HITS.split(", ")]
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        found = docs.select("doc_id", "text").mapInArrow(scan, HITS)
        result = found if result is None else result.union(found)
    return docs.sparkSession.createDataFrame([], HITS) if result is None else result


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that hold no test item; see find_leaks. Nothing is shuffled."""
    for index in _index_parts(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = {number for number, _, _ in leaks(batch.column("text").to_pylist(), shared.value, threshold)}
                yield batch.filter(pa.array([i not in found for i in range(batch.num_rows)]))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs


def split_items(benchmark: DataFrame) -> DataFrame:
    """Items of a benchmark without separate columns (item_id, text): the last sentence is the answer, if there are two."""
    text = F.coalesce("text", F.lit(""))
    cut = r"(?s)^(.*[.?!])\s+(\S.*?)\s*$"
    answer = F.nullif(F.regexp_extract(text, cut, 2), F.lit(""))
    return benchmark.select(
        "item_id", F.when(answer.isNull(), text).otherwise(F.regexp_extract(text, cut, 1)).alias("question"), answer.alias("answer")
    )
