import hashlib
import math
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import mixing

ROWS = [
    *((i, "w " * (i % 7 + 1), "big") for i in range(300)),
    *((1000 + i, "a b c", "small") for i in range(3)),
    (2000, "one " * 5000, "long"),
    *((3000 + i, "x y", None) for i in range(10)),
    (None, "no id here", "big"),
    (5, "w w w w w w", "big"),
    (5, "w w w w w w", "big"),
    (4000, None, "empty"),
    (4001, " \t\n", "empty"),
    (4002, "tab\tand\x0bline\nand\u00a0joined", "Änder"),
]


def plain_targets(sizes):
    """Share by weight, stop at three times the size, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, Fraction(0)), Fraction(sum(sizes.values())), set(names)
    while left and open_:
        total = sum(weight[s] for s in open_)
        target = {s: t + left * weight[s] / total if s in open_ else t for s, t in target.items()}
        left = sum(max(Fraction(0), target[s] - 3 * sizes[s]) for s in names)
        full = {s for s in open_ if target[s] >= 3 * sizes[s]}
        target = {s: min(t, Fraction(3 * sizes[s])) for s, t in target.items()}
        open_ -= full
    return target


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))


def sized(docs):
    return docs.select("doc_id", "source", mixing.word_count("text").alias("size"))


@pytest.mark.parametrize("range_rows", [2000, 7])
def test_targets_and_taken_words(docs, range_rows):
    rows = mixing.mix(sized(docs), range_rows=range_rows).collect()
    assert len(rows) == len(ROWS)
    sizes = {}
    for _, t, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        assert len(r.positions) == math.ceil(r.taken / r.size if r.size else 0)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)


def test_rows_equal_sql_and_reruns(docs, sql):
    placed = lambda d: d.select("doc_id", "source", mixing.word_count("text").alias("size"), mixing.place_of().alias("place"))
    got = mixing.mix(placed(docs), F.col("place"), range_rows=5).withColumn("position", F.round("position", 6))
    names, want = sql(mixing.SQL, documents=docs.drop("target"))
    first = sorted(map(tuple, got.select(names).collect()), key=str)
    assert first == sorted(want, key=str)
    again = mixing.mix(placed(docs.repartition(3)), F.col("place"), range_rows=5).withColumn("position", F.round("position", 6))
    assert first == sorted(map(tuple, again.select(names).collect()), key=str)


def test_positions_rise_and_invert_the_schedule(docs):
    rows = mixing.mix(sized(docs), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))).collect()
    found = [r.position for r in rows if r.position is not None]
    assert found == sorted(found) and all(0 <= p <= 1 for p in found)
    assert all(r.position is None for r in rows[len(found) :])
    order = sorted((r for r in rows if r.source == "big"), key=lambda r: (hashlib.md5(str(r.doc_id if r.doc_id is not None else "").encode()).hexdigest()))
    assert [r.position for r in order if r.position is not None] == sorted(r.position for r in order if r.position is not None)


def test_inverse_of_integrated_weights(spark):
    knots, weights = (0.0, 0.25, 1.0), (0.0, 2.0, 0.5)
    area = lambda t: sum(
        (min(t, b) - a) * (wa + (wa + (wb - wa) * (min(t, b) - a) / (b - a))) / 2
        for a, b, wa, wb in zip(knots, knots[1:], weights, weights[1:])
        if t > a
    )
    for share in (0.0, 0.01, 0.2, 0.5, 0.99, 1.0):
        t = spark.sql(f"SELECT {mixing.position_sql(f'CAST({share} AS DOUBLE)', '1', knots, [weights])} AS t").first()["t"]
        assert math.isclose(area(t) / area(1.0), share, abs_tol=1e-9)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(empty).count() == 0


def test_rows_without_ids_are_spread(spark):
    docs = spark.createDataFrame([(None if i % 3 else i, f"text {i} " * (i % 5), "s") for i in range(3000)], "doc_id long, text string, source string")
    assert docs.select(mixing.place_of()).distinct().count() >= 2400
    rows = mixing.mix(docs.select("doc_id", "text", "source", mixing.word_count("text").alias("size")), range_rows=50).collect()
    again = mixing.mix(docs.repartition(5).select("doc_id", "text", "source", mixing.word_count("text").alias("size")), range_rows=7).collect()
    assert len(rows) == 3000 and sorted(map(str, rows)) == sorted(map(str, again))
    positions = [r.position for r in rows if r.position is not None]
    assert positions == sorted(positions) and abs(sum(r.taken for r in rows) - rows[0].target) <= 0.5
