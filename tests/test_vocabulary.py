import math
import uuid
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarlake.ml import vocabulary
from bazaarlake.operators import ids
from bazaarlake.sinks import files

TEXTS = [(1, "a b a C"), (2, "b c  "), (3, None), (4, ""), (5, "a\tb\n\nz")]


@pytest.fixture
def folder(tmp_path):
    return lambda name: f"{tmp_path}/{name}-{uuid.uuid4().hex}"


def test_weights_equal_plain_counts(spark, folder):
    docs = spark.createDataFrame(TEXTS, "k long, t string")
    got = {(r.k, r.term): (r.code, r.tf, r.weight) for r in vocabulary.term_weights(docs, "k", "t", folder).collect()}
    words = {1: ["a", "b", "a", "c"], 2: ["b", "c"], 3: [""], 4: [""], 5: ["a", "b", "", "z"]}
    frequency = Counter(t for own in words.values() for t in set(own))
    order = sorted(frequency, key=lambda t: (-frequency[t], t))
    want = {}
    for k, own in words.items():
        for term, tf in Counter(own).items():
            n = frequency[term]
            want[k, term] = (order.index(term), tf, tf * math.log(6 / (n + 1)) if n >= 2 else 0.0)
    assert got.keys() == want.keys()
    for key, (code, tf, weight) in want.items():
        assert got[key][:2] == (code, tf) and math.isclose(got[key][2], weight)
    vectors = {r.k: (r.indices, r.weights) for r in vocabulary.sparse_vectors(vocabulary.term_weights(docs, "k", "t", folder), "k").collect()}
    for k in words:
        entries = sorted((c, w) for (d, _), (c, _, w) in want.items() if d == k and w)
        assert vectors[k][0] == [c for c, _ in entries]


def test_category_rules(spark, folder):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y"), (4, None)], "k int, c string")
    kept = {r.k: r.c_code for r in vocabulary.category_codes(rows, ["c"], folder).collect()}
    assert kept == {1: 1, 2: 0, 3: 0, 4: 2}
    assert {r.k for r in vocabulary.category_codes(rows, ["c"], folder, "skip").collect()} == {1, 2, 3}
    with pytest.raises(ValueError):
        vocabulary.category_codes(rows, ["c"], folder, "error")


def test_ids_in_any_order(spark, folder):
    rows = [(f"name {i % 7}" if i % 5 else None, i % 11, i) for i in range(400)]
    df = spark.createDataFrame(rows, "n string, p int, k int").repartition(5)
    order = [F.col("n").asc_nulls_last(), F.col("p").desc(), F.col("k").asc()]
    got = {r.k: r.id for r in ids.ordered_ids(df, order, F.lit(1000), folder("ids")).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -r[1], r[2]))
    assert got == {r[2]: 1001 + i for i, r in enumerate(want)}
    assert ids.ordered_ids(df.limit(0), order, F.lit(0), folder("none")).count() == 0


def test_retention_drops_what_its_catalogue_says(spark, folder):
    path = folder("daily")
    rows = [(i, datetime(2024, 5, 1 + i % 6, 12)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, ts timestamp")
    files.write_daily_table(df, path)
    files.write_daily_table(df.limit(3), path, prefix="other-")
    as_of = F.lit(datetime(2024, 5, 6, 1))
    first = {r.index_name: (r.n_rows, r.is_expired) for r in files.apply_retention(spark, path, df.schema, as_of).collect()}
    assert first == {f"logstash-2024.05.0{d}": (10, d < 4) for d in range(1, 7)}
    again = files.apply_retention(spark, path, df.schema, as_of).collect()
    assert {r.index_name for r in again} == {f"logstash-2024.05.0{d}" for d in (4, 5, 6)} and not any(r.is_expired for r in again)
    left = {r.index_name: r.n_rows for r in files.daily_counts(spark, path, df.schema).collect()}
    assert {k for k in left if k.startswith("logstash")} == {r.index_name for r in again} and sum(v for k, v in left.items() if k.startswith("other")) == 3
