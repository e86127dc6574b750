import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from bazaarlake.llm import sharding
from bazaarlake.llm.numbering import numbered

ROWS = [
    *((i, f"text {i % 9}") for i in range(600)),
    *((None, f"no id {i}") for i in range(300)),
    *((7, "same id and text") for _ in range(200)),
    (8, None),
    (8, ""),
    (-1, "é \U0001f600"),
    (2**63 - 1, "long " * 5_000),
]
COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "_row": F.lit(1)})


def test_shards_equal_sql(spark, sql):
    names, want = sql(sharding.SQL, documents=docs(spark))
    got = [tuple(r[c] for c in COLUMNS) for r in sharding.assign(docs(spark)).collect()]
    want = [tuple(r[names.index(c)] for c in COLUMNS) for r in want]
    assert sorted(got, key=str) == sorted(want, key=str)
    sizes = Counter((r[0], r[1], r[2]) for r in got)
    assert sizes == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS)


def test_slots_have_no_gaps(spark):
    slots = {}
    for r in sharding.assign(docs(spark)).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_one_key_at_a_time():
    keys = np.random.default_rng(3).integers(0, 1 << 64, 3000, np.uint64, endpoint=False)
    keys[:3] = 0, 1, 2**64 - 1
    for shards in (1, 2, 24, 25, 1000):
        assert sharding.jump(keys, shards).tolist() == [plain_jump(k, shards) for k in keys.tolist()]


def test_an_appended_shard_takes_its_part_and_nothing_else_moves():
    keys = np.random.default_rng(4).integers(0, 1 << 64, 100_000, np.uint64, endpoint=False)
    for shards in (1, 10, 24):
        before, after = sharding.jump(keys, shards), sharding.jump(keys, shards + 1)
        moved = before != after
        assert (after[moved] == shards).all()
        assert abs(moved.mean() * (shards + 1) - 1) < 0.1
        counts = np.bincount(after)
        assert counts.min() > 0.9 * len(keys) / (shards + 1)


def test_moves_and_written_shards(spark, tmp_path):
    folder = str(tmp_path / "shards")
    given = docs(spark).drop("shard")
    sharding.write_shards(given, folder)
    back = spark.read.parquet(folder)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(ROWS)
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in sharding.place(given).collect()}
    assert all(r.grown_shard == 24 for r in sharding.moves(given).collect())


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_positions_over_a_whole_table_and_in_groups(spark):
    rows = spark.createDataFrame([(i % 3 if i % 5 else None, i % 4) for i in range(500)], "g int, v int")
    found = numbered(rows, [], [F.col("v").desc()], "n").collect()
    assert sorted(r.n for r in found) == list(range(500))
    assert [r.v for r in sorted(found, key=lambda r: r.n)] == sorted((i % 4 for i in range(500)), reverse=True)
    groups = {}
    for r in numbered(rows, ["g"], [F.col("v").asc()], "n").collect():
        groups.setdefault(r.g, []).append((r.n, r.v))
    for own in groups.values():
        assert [n for n, _ in sorted(own)] == list(range(len(own)))
        assert [v for _, v in sorted(own)] == sorted(v for _, v in own)
