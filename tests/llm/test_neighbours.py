import numpy as np
import pytest

from bazaarlake.llm import neighbours


def exact(rows, queries, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in {(i, tuple(v)) for i, v in usable if i in queries}:
        x = np.array(x)
        scores = [(-float((v * x).sum() / (np.sqrt((v * v).sum()) * np.sqrt((x * x).sum()))), i) for i, v in usable if i != q and len(v) == len(x)]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("block_rows", [65_536, 150])
def test_recall_and_scores(spark, monkeypatch, block_rows):
    # Without coalescing, groups of the two sides meet only if they are dealt alike.
    monkeypatch.setattr(spark.conf, "get", lambda *a, get=spark.conf.get: "40" if a[0] == "spark.sql.shuffle.partitions" else get(*a))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        recall_and_scores(spark, block_rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def recall_and_scores(spark, block_rows):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(neighbours.nearest(df, df.filter("vec_id % 10 = 0"), 5, block_rows))
    want = exact(rows, set(range(0, 4000, 10)), 5)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    best = {q: dict(v) for q, v in exact(rows, set(want), 3999).items()}
    assert all(abs(best[q][i] - s) < 1e-12 for q in got for i, s in got[q])


def test_ties_copies_and_unusable_vectors(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 2.0, 0.0]
    rows = [(i, one) for i in range(0, 40)] + [(100 + i, two) for i in range(3)]
    rows += [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 0.0]), (203, [float("nan"), 1.0, 0.0]), (204, [float("inf"), 1.0, 0.0]), (205, [])]
    rows += [(300, [1.0, 1.0]), (350, [2.0, 2.0]), (None, one), (500, [1e-30, 0.0, 0.0]), (550, [3e30, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed("x", "rank")
    got = found(neighbours.nearest(df, df.filter("vec_id % 50 = 0"), 5))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and all(abs(s - 1) < 1e-12 for _, s in got[0])
    assert [i for i, _ in got[100]] == [101, 102, 0, 1, 2]
    assert [i for i, _ in got[300]] == [350] and [i for i, _ in got[350]] == [300]
    assert 200 not in got and [i for i, _ in got[500]] == [0, 1, 2, 3, 4]


def test_empty_tables_and_repeated_queries(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (0, [1.0, 2.0])], schema)
    assert neighbours.nearest(empty, empty).count() == 0
    assert neighbours.nearest(some, empty).count() == 0
    assert [(r.query_id, r.vec_id) for r in neighbours.nearest(some, some.filter("vec_id = 0")).collect()] == [(0, 1)]
