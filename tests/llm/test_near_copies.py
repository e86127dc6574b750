import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import near_copies


def plain_set(text, k=5):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_groups(rows):
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return group


def edited(rng, words, changes):
    """The words with some replaced, at least five places apart so that each costs five shingles."""
    words = list(words)
    for at in rng.sample(range(5, len(words) - 5, 6), changes):
        words[at] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def made(rng):
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for n in (60, 200, 450):
        for _ in range(25):
            base = prose(n)
            # A share c of the shingles changed gives a similarity of (1 - c) / (1 + c): from 0.72 to 0.99.
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, edited(rng, base, rng.randrange(1, max(2, n // 32))))]
    return rows


def test_every_pair_of_the_least_similarity_is_linked_and_no_other(spark):
    rows = made(random.Random(2))
    between = [jaccard(plain_set(a[1]), plain_set(b[1])) for a, b in zip(rows[::2], rows[1::2], strict=True)]
    assert sum(0.8 <= s < 0.86 for s in between) >= 5 and sum(s < 0.8 for s in between) >= 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    )
    group = plain_groups(rows)
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert kept == set(group)


@pytest.mark.parametrize("hinted", [500_000, 0])
def test_components_equal_brute_force(spark, monkeypatch, hinted):
    monkeypatch.setattr(near_copies, "BROADCAST_ROWS", hinted)
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = [(i, edited(rng, base, rng.randrange(0, 16))) for i in range(60)]
    rows += [(100 + i, t) for i, t in made(rng)[:40]]
    rows += [(900, None), (901, ""), (902, " \t"), (903, "Two Words"), (904, "two  words"), (None, "nothing else is like this"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_copies.near_copies(docs).collect()
    group = plain_groups(rows)
    least = {g: min((i for (i, _), h in zip(rows, group, strict=True) if g == h and i is not None), default=None) for g in group}
    assert Counter((r.doc_id, r.component_id) for r in found) == Counter((i, least[g]) for (i, _), g in zip(rows, group, strict=True))


def test_empty_table(spark):
    assert near_copies.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts_are_read_in_pieces():
    words = [f"word{i}" for i in range(300_000)]
    assert len(near_copies.shingles(" ".join(words))) == len(words) - 4


def test_texts_of_one_template_are_not_compared_pair_by_pair(spark, monkeypatch):
    rng = random.Random(9)
    compared, verified = [], near_copies._verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(near_copies, "_verified", counted)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    # Some 6 to 17 edits in 150 words: similarities of about 0.2 to 0.7 to each other, of 0.4 to 0.8 to the template.
    rows = [(i, edited(rng, base, rng.randrange(6, 18))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    assert sum(compared) < 5 * len(rows)
    # Every pair, by a matrix of shared shingles.
    sets = [plain_set(t) for _, t in rows]
    number = {s: i for i, s in enumerate(sorted(set().union(*sets)))}
    held = np.zeros((len(rows), len(number)), np.float32)
    for i, own in enumerate(sets):
        held[i, [number[s] for s in own]] = 1
    both, size = held @ held.T, held.sum(axis=1)
    near = 5 * both >= 4 * (size[:, None] + size[None, :] - both)
    least = np.arange(len(rows))
    while True:
        new = np.array([least[row].min() for row in near])
        if (new == least).all():
            break
        least = new
    assert found == dict(enumerate(least.tolist()))


def test_one_of_each_group_stays_with_all_columns(spark):
    rng = random.Random(10)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(80))
    rows = [(5, base), (3, base), (3, base), (None, base), (None, "alone here"), (None, "alone here"), (9, None), (8, ""), (7, "x y"), (7, "another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "_id": F.lit("clash"), "node": F.lit(2)})
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(3, base), (None, "alone here"), (8, ""), (7, "x y"), (7, "another text")])


def test_near_fingerprints_meet_without_any_band(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "band_keys", lambda hashes, scramblers: [])
    rng = random.Random(11)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(3000)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, edited(rng, base, 1))]
    rows += [(len(rows), "unlike any other text"), (len(rows) + 1, "nor like this one")]
    found = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fps = [near_copies.majority(near_copies.shingles(t)) for _, t in rows]
    near = [(a, a + 1) for a in range(0, 24, 2) if (fps[a] ^ fps[a + 1]).bit_count() <= near_copies.RADIUS]
    assert len(near) >= 6
    assert all(found[a] == found[b] == a for a, b in near)
    assert found[24] == 24 and found[25] == 25
