import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from bazaarlake.llm import resampling

WORDS = ["a", "be", "See", "d9", "naïve", "ÉTÉ", "x_y", "don't", "日本語", "\x7fq", "w" * 70, "zz-top"]
RNG = random.Random(5)
ROWS = [
    *((i, " ".join(RNG.choices(WORDS, k=RNG.randint(0, 60)))) for i in range(300)),
    *((None, "one two three " * 10) for _ in range(50)),
    *((None, f"one two three {i} " * 10) for i in range(50)),
    *((3, "same id and text " * 6) for _ in range(9)),
    (4, None),
    (5, ""),
    (6, "... --- ..."),
    (7, "w" * 20_000),
    (8, "many words " * 120_000),
]
TARGET = ["See the naïve ÉTÉ", "be be be", None, "", "日本語 " * 30]


def tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"weight": F.lit("clash"), "rank": F.lit(0)})
    return docs, spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")


def features(text, longest):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return [zlib.crc32(f.encode()) % 10_000 for f in runs], len(words)


def plain(longest=1):
    docs = [(i, *features(t, longest)) for i, t in ROWS]
    s, t = Counter(b for d in docs for b in d[1]), Counter(b for x in TARGET for b in features(x, longest)[0])
    s_all, t_all = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in s}
    rows = []
    for i, found, n in docs:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [(*r[:4], k + 1) for k, r in enumerate(able[: 10 * len(able) // 100])]
    return Counter([*drawn, *((*r[:4], None) for r in able[len(drawn) :]), *((*r[:4], None) for r in rows if r[4] < 20)])


def found(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_crc_matrix_equals_one_string_at_a_time():
    rng = random.Random(6)
    strings = [rng.randbytes(rng.randint(0, 40)) for _ in range(2000)] + [b"", b"\0", b"\0\0", rng.randbytes(5000)]
    assert resampling.crc32_of(strings).tolist() == [zlib.crc32(s) for s in strings]
    assert resampling.crc32_of([]).tolist() == []


def test_sample_equals_plain_and_sql(spark, sql):
    docs, target = tables(spark)
    got = found(resampling.resample(docs, target))
    assert got == plain()
    names, rows = sql(resampling.SQL, documents=docs, benchmark=target)
    assert got == Counter(tuple(r[names.index(c)] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in rows)


def test_runs_of_words_over_pieces(spark, monkeypatch):
    docs, target = tables(spark)
    assert found(resampling.resample(docs, target, longest=3)) == plain(3)
    monkeypatch.setattr(resampling, "pieces", lambda data: [w + b" " for w in data.split(b" ")])
    for longest in (1, 2, 3):
        text = "a b c d e"
        runs = [f for part in resampling.feature_lists(text, longest) for f in part]
        words = text.encode().split()
        assert Counter(runs) == Counter(b" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(6 - k))


def test_kept_columns_and_empty_tables(spark):
    docs, target = tables(spark)
    kept = resampling.resample(docs, target, keep=["doc_id", "text"])
    assert kept.columns == ["doc_id", "text", "n_features", "weight", "score", "rank"] and kept.count() == len(ROWS)
    assert resampling.resample(docs.limit(0), target).collect() == []
    assert resampling.resample(docs, target.limit(0)).count() == len(ROWS)
