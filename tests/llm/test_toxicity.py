import math
import random
import zlib
from collections import Counter

import numpy as np

from bazaarlake.llm import toxicity


def rows(n=300):
    rng = random.Random(4)
    plain, bad = "on the red hill a man ran to an old tree and sat".split(), ["zorkface", "quibblex", "wazzock"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        toxic = int(rng.random() < 0.3)
        for _ in range(rng.randrange(1, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_accuracy_and_contract(spark):
    docs, labels = rows()
    docs += [(1000, None), (1001, ""), (1002, "the red hill " * 60_000), (1003, "the hill " * 50_000 + "zorkface"), (None, "quibblex you wazzock"), docs[5]]
    labels += [(5, 0), (7777, 1), (None, 1), (8, None), (9, 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS toxic", "2 AS score")
    got = toxicity.score(frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    for i, _ in docs:
        assert by[i].held_out == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= by[i].score <= 1 and by[i].predicted == int(by[i].score >= 0.5)
    held = [(by[i].predicted, t) for i, t in labels[:300] if by[i].held_out]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) > 0.95
    assert by[1000].score == by[1001].score and by[1002].predicted == 0 and by[1003].predicted == 1 and by[None].predicted == 1


def plain_ratios(counts, order, d):
    """Kneser-Ney by recursion: ratio(gram) for any n-gram; counts are Counters of n-grams of the two classes."""
    types = [{g[order - n :] for g in set(counts[0]) | set(counts[1])} for n in range(order + 1)]
    letters = len(types[1]) + 1

    def spread(cells, gram, lower):
        context = [c for g, c in cells.items() if g[:-1] == gram[:-1]]
        if not sum(context):
            return lower
        return max(cells[gram] - d, 0) / sum(context) + d * sum(c > 0 for c in context) / sum(context) * lower

    def shared(gram):
        if not gram:
            return 1 / letters
        return spread(Counter(g[1:] for g in types[len(gram) + 1]), gram, shared(gram[1:]))

    return lambda gram: math.log(spread(counts[1], gram, shared(gram[1:])) / spread(counts[0], gram, shared(gram[1:])))


def test_scores_equal_plain_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 60)
    monkeypatch.setattr(toxicity, "PIECE", 16)
    rng, order, d, window = random.Random(3), 3, 0.75, 8
    words = ["ab", "ba", "абв", "д7", "7", "国𝄞"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(30)]
    docs += [(30, None), (31, ""), (32, "nothing seen"), (33, "AB\n\tb국")]
    labels = [(i, rng.randrange(2)) for i in range(20)]
    train = spark.createDataFrame(labels, "doc_id long, toxic int")
    blocks = toxicity.pack_blocks(spark.createDataFrame(docs, "doc_id long, text string"), 60)
    counts = toxicity.count_grams(blocks, train, order)
    model = toxicity.log_ratios(counts, order, d)
    got = {r.doc_id: r for r in toxicity.raw_scores(blocks, model, order, window).collect()}

    def grams(text):
        line = " " * (order - 1) + (" " + " ".join((text or "").lower().split()) + " " if (text or "").split() else " ")
        return [line[i : i + order] for i in range(len(line) - order + 1)]

    plain = {0: Counter(), 1: Counter()}
    for i, toxic in labels:
        plain[toxic].update(grams(docs[i][1]))
    assert {r.gram: (r.ordinary, r.toxic) for r in counts.collect()} == {g: (plain[0][g], plain[1][g]) for g in {*plain[0], *plain[1]}}
    ratio = plain_ratios(plain, order, d)
    for i, text in docs:
        values = [ratio(g) for g in grams(text)]
        runs = [sum(values[k : k + window]) for k in range(len(values) - window + 1)] or [sum(values)]
        assert math.isclose(got[i].whole, sum(values) / len(values), abs_tol=1e-9)
        assert math.isclose(got[i].worst, max(runs) / window, abs_tol=1e-9)


def test_scripts_and_digits_are_told_apart(spark):
    rng = random.Random(8)
    plain, bad = "дом кот мир 1234 год 中国 سلام".split(), ["дурок", "1d10t", "坏人", "سلاخ"]
    docs = [(i, " ".join([rng.choice(plain) for _ in range(30)] + [rng.choice(bad)] * (i % 3 == 0))) for i in range(400)]
    got = toxicity.score(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int"),
    ).collect()
    held = [r.predicted == int(r.doc_id % 3 == 0) for r in got if r.held_out]
    assert len(held) > 50 and np.mean(held) > 0.97


def test_texts_do_not_move_to_meet_the_model(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    blocks = toxicity.pack_blocks(docs, 40)
    model = spark.createDataFrame([("text", 1.0)], "part string, ratio double")
    plan = toxicity.raw_scores(blocks, model)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert "Bucketed: true" in plan and "FlatMapCoGroupsInArrow" in plan
    assert not any("packed" in line for line in exchanges)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, none).collect()] == [0.5]
    assert toxicity.score(docs.limit(0), none).count() == 0
