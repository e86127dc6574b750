import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from bazaarlake.llm import simhash
from bazaarlake.llm.components import components


def plain_fingerprint(text, k=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}
    for a in nodes:
        for b in nodes:
            if near(a, b):
                x, y = root[a], root[b]
                if x != y:
                    root = {n: min(x, y) if r in (x, y) else r for n, r in root.items()}
    return root


def expected(rows, radius=4):
    fps = {plain_fingerprint(t) for _, t in rows}
    root = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= radius)
    least = {}
    for i, t in rows:
        r = root[plain_fingerprint(t)]
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, plain_fingerprint(t), least.get(root[plain_fingerprint(t)])) for i, t in rows]


@pytest.mark.parametrize("text", ["", None, " \t", "One", "a B c", "a b c d", "x y " * 3000, "é É z   q w", "a " * 700000])
def test_fingerprint_equals_plain_form(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    for radius in (1, 4, 6):
        masks = simhash.masks(radius, list(range(64)))
        for _ in range(500):
            bits = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(not bits & m for m in masks)


def test_masks_keep_about_half_of_the_bits():
    for radius in (4, 5, 6):
        assert all(24 <= m.bit_count() <= 44 for m in simhash.masks(radius, list(range(64)), 100))


def test_random_fingerprints_stay_apart(spark):
    rng = random.Random(9)
    fps = [rng.getrandbits(63) for _ in range(3000)]
    fps += [f ^ 0b111111 << 9 for f in fps[:30]] + [f ^ 0x5555 for f in fps[30:60]]
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 5, 9, 4096).collect()
    known = set(fps)
    assert all(e.a in known and e.b in known and (e.a ^ e.b).bit_count() <= 9 for e in edges)
    assert len({(e.a, e.b) for e in edges}) >= 40


def test_spark_hash_is_the_same(spark):
    value = spark.sql("SELECT xxhash64('abc de') AS h").first()["h"] & (1 << 64) - 1
    assert value == xxhash.xxh64_intdigest("abc de", 42)


@pytest.mark.parametrize("group_rows", [4096, 9])
def test_components_equal_brute_force(spark, group_rows):
    rng = random.Random(7)
    base = [" ".join(rng.choice("abcdefgh") * 2 + str(rng.randrange(40)) for _ in range(300)) for _ in range(4)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(80):
        words = base[0 if i % 3 else i % 4].split()
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = "new" + str(rng.randrange(99))
        rows.append((1000 - i, " ".join(words)))
    rows += [(5000, None), (4999, ""), (None, "only this"), (4998, "Only THIS"), (7, rows[7][1]), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x"))
    got = simhash.near_duplicates(docs, group_rows=group_rows).collect()
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str)
    assert got == sorted(expected(rows), key=str)


def test_scattered_fingerprints_in_one_group_are_masked_again(spark):
    rng = random.Random(3)
    # All fingerprints share 40 bits, so that groups go beyond the limit.
    fps = sorted({rng.getrandbits(24) << 20 for _ in range(150)})
    fps += [f ^ 0b1111 << 30 for f in fps[:20]] + [f ^ 0b11111 << 21 for f in fps[20:30]]
    df = spark.createDataFrame([(f,) for f in set(fps)], "fp long")
    for limit in (5, 4096):
        edges = simhash.links(df, 4, 4, limit).collect()
        assert all((e.a ^ e.b).bit_count() <= 4 for e in edges)
        nodes = set(fps)
        want = plain_components(nodes, lambda a, b: (a ^ b).bit_count() <= 4)
        linked = {(e.a, e.b) for e in edges} | {(e.b, e.a) for e in edges}
        got = plain_components(nodes, lambda a, b: (a, b) in linked)
        assert got == want


def test_group_size_does_not_change_links_beyond_the_radius(spark):
    rng = random.Random(11)
    # All fingerprints share the bits of one mask, and pairs differ in 3 to 5 others: more than masks of radius 1 cover.
    mask = simhash.masks(1, list(range(64)), 100)[0]
    free = [b for b in range(63) if not mask >> b & 1]
    fps = [sum(1 << b for b in free if rng.random() < 0.5) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in rng.sample(free, 3 + i % 3)) for i, f in enumerate(fps)]
    df = spark.createDataFrame([(f,) for f in set(fps)], "fp long")
    got = []
    for limit in (9, 4096):
        linked = {frozenset((e.a, e.b)) for e in simhash.links(df, 1, 5, limit).collect()}
        got.append(plain_components(set(fps), lambda a, b: frozenset((a, b)) in linked))
    assert got[0] == got[1] and len(set(got[1].values())) <= 60


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs, 4, 5, 4).count() == 0


def test_components_of_chain_star_and_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 130)), [500]]


def test_keep_one_keeps_smallest_id_and_all_columns(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text, "x"), (2, text, "y"), (2, text, "y"), (9, "other words " * 9, None), (None, text, "z"), (None, "alone " * 8, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash string")
    got = simhash.keep_one(docs, 4, 5, 4)
    assert got.columns == ["doc_id", "text", "_hash"]
    assert sorted(got.collect(), key=str) == sorted([rows[1], rows[3], rows[5]], key=str)
