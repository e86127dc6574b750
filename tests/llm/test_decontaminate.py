import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import decontaminate as D


def prose(rng, n):
    return " ".join(rng.choice("abcdefghij") + rng.choice("lmnop") + rng.choice(["", "x", "yz"]) for _ in range(n))


def made():
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randrange(8, 60)) + "? " + prose(rng, rng.randrange(1, 12)) + ".") for i in range(60)]
    docs = [(i, prose(rng, rng.randrange(0, 400))) for i in range(80)]
    leaks = set()
    for i in range(80, 140):
        item, text = rng.choice(items)
        if i % 3 == 0:
            text = text.upper().replace("? ", " --\n")
        docs.append((i, f"{prose(rng, rng.randrange(0, 300))} {text} {prose(rng, rng.randrange(0, 300))}"))
        leaks.add((i, item))
    return docs, items, leaks


def plain_hits(docs, items):
    """Every document and item whose sequences overlap enough, without any index."""
    out = set()
    for i, text in docs:
        words = D.plain_bytes(text).split()
        for item, question, answer in items:
            parts = [D.sequences(D.plain_bytes(p).split()) for p in (question, answer)]
            held = [sum(any(tuple(words[k : k + len(s)]) == s for k in range(len(words))) for s in p) for p in parts]
            shares = [h / len(p) for h, p in zip(held, parts) if p]
            whole = sum(held) / max(1, sum(map(len, parts)))
            if shares and (whole >= D.WHOLE_OVERLAP or min(shares) >= D.PART_OVERLAP):
                out.add((i, item))
    return out


@pytest.mark.parametrize("index_items", [10_000, 20])
def test_leaks_equal_brute_force(spark, monkeypatch, index_items):
    monkeypatch.setattr(D, "INDEX_ITEMS", index_items)
    docs, items, leaks = made()
    docs += [(500, None), (501, ""), (None, items[0][1]), docs[100], (502, "filler word " * 70_000 + items[1][1] + " more" * 500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    benchmark = spark.createDataFrame([*items, (900, None), (901, "")], "item_id long, text string")
    split = D.split_items(benchmark)
    got = Counter((r.doc_id, r.item_id) for r in D.find_leaks(frame, split).collect())
    want = plain_hits(docs[:140], [tuple(r) for r in split.collect()])
    assert leaks <= want
    assert set(got) == want | {(None, 0), (502, 1)}
    assert got[(docs[100][0], next(iter(i for d, i in want if d == docs[100][0])))] == 2
    kept = D.without_leaks(frame, split)
    assert kept.columns == frame.columns
    gone = {d for d, _ in got}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d not in gone), key=str)


def test_wand_returns_all_items_above_the_threshold():
    rng = random.Random(5)
    import pandas as pd

    items = pd.DataFrame([(i, prose(rng, rng.randrange(3, 30)), None) for i in range(300)], columns=["item_id", "question", "answer"])
    df = Counter(w for t in items["question"] for w in set(D.plain_bytes(t).split()))
    index = D.Index(items, df, 300, 16.0)
    for _ in range(200):
        words = set(D.plain_bytes(prose(rng, rng.randrange(1, 60))).split()) & set(index.terms)
        terms = sorted(index.terms[w] for w in words)
        scores = Counter()
        for postings in index.postings:
            for t in terms:
                for n, w in postings.get(t, []):
                    scores[n] += w
        blocks = list(range(len(index.postings)))
        for threshold in (0.3, 0.6):
            assert sorted(n for n, _ in index.retrieve(terms, blocks, threshold)) == sorted(n for n, s in scores.items() if s >= threshold)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    items = D.split_items(spark.createDataFrame([], "item_id long, text string"))
    assert D.find_leaks(docs, items).count() == 0 and D.without_leaks(docs, items).count() == 1
    some = D.split_items(spark.createDataFrame([(1, "One two three four five six. Seven.")], "item_id long, text string"))
    assert [tuple(r) for r in some.collect()] == [(1, "One two three four five six.", "Seven.")]
    assert D.find_leaks(docs.limit(0), some).count() == 0
