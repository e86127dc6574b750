import random

import pytest
import xxhash

from bazaarlake.llm import suffix_dedup

LENGTH = 100


def plain(rows):
    """Kept bytes, removed bytes and spans of each row, from all strings of LENGTH bytes."""
    # Rows of one id, or of none, are ordered by the hash of their text.
    texts = [((i is None, i or 0, xxhash.xxh3_128_digest((t or "").encode())), (t or "").encode()) for i, t in rows]
    first = {}
    for i, data in texts:
        for s in range(len(data) - LENGTH + 1):
            w = data[s : s + LENGTH]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for (i, data), row in zip(texts, rows):
        gone = bytearray(len(data))
        for s in range(len(data) - LENGTH + 1):
            if first[data[s : s + LENGTH]] < (i, s):
                gone[s : s + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((row[0], kept, len(data), sum(gone), spans))
    return sorted(out, key=str)


def made(rng):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(30) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 60)
            parts += [p[cut:] if rng.random() < 0.5 else p, prose(rng.randrange(0, 20))]
        rows.append((rng.randrange(100_000), " ".join(parts)))
    rows += [(200_000 + i, rows[i][1]) for i in range(6)]
    rows += [(300_000, "ab" * 400), (300_001, "x" * 350), (300_002, "x" * 99), (300_003, "x" * 100)]
    rows += [(None, rows[0][1]), (None, passages[0]), (7, ""), (8, None), (200_000, passages[1] + passages[1]), rows[3], rows[3]]
    rows += [(400_000, passages[2][:-1] + "é" + passages[2])]
    return rows


@pytest.mark.parametrize("held, combined, plain_bytes, batch", [(16 << 20, 250_000, 4096, 800_000), (600, 50, 4096, 900), (16 << 20, 250_000, 300, 700)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, held, combined, plain_bytes, batch):
    monkeypatch.setattr(suffix_dedup, "COMBINED_ROWS", combined)
    monkeypatch.setattr(suffix_dedup, "PLAIN_BYTES", plain_bytes)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    rows = made(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, ["doc_id"], held_bytes=held).collect()
    got = sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got), key=str)
    assert got == plain(rows)


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, kept string")
    assert suffix_dedup.remove_repeats(docs, ["doc_id", "kept"]).columns == ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
    assert suffix_dedup.remove_repeats(docs, ["doc_id"]).count() == 0


def test_thousands_of_rows_without_ids_and_with_one_id(spark):
    rng = random.Random(6)
    clean = lambda: "".join(rng.choice("abcdefghijklmnop ") for _ in range(160))
    passage = clean()
    rows = [(None if n % 2 else 7, clean()) for n in range(3000)]
    rows += [(None if n % 2 else 7, clean() + passage + clean()) for n in range(1000)]
    rows += [(None, rows[1][1]), (7, rows[0][1]), (2**63 - 1, passage), *rows[3990:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(docs, ["doc_id"]).collect()
    got = sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got), key=str)
    assert got == plain(rows)


def test_wide_rows_reach_python_in_small_batches(spark):
    from collections.abc import Iterator

    import pyarrow as pa

    from bazaarlake.llm import storage

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(storage.BATCH_SETTING)
    found = storage.write_table(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long"), "sizes", batch_rows=storage.WIDE_ROWS)
    assert [r.n for r in found.collect()] == [1000] * 5
    assert spark.conf.get(storage.BATCH_SETTING) == before
