import random
import zlib

import numpy as np

from bazaarlake.llm import langid

WORDS = {"xa": "alor beni coru duma erat fomi", "yb": "schnurk grabt pfeltz knurr strompf zwick"}


def rows(n=240):
    rng = random.Random(2)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        words = [rng.choice(WORDS[lang].split()) + rng.choice(["", "s", "en", ","]) for _ in range(rng.randrange(3, 60))]
        out.append((i, " ".join(words), lang))
    return out


def test_held_out_accuracy_and_contract(spark):
    made = rows()
    made += [(1000, None, "xa"), (1001, "", "xa"), (1002, "12 34 !!", "yb"), (1003, "alor beni " * 80_000, None), (None, "coru duma", "xa"), (3, made[3][1], made[3][2])]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "'z' AS lang_pred")
    got = langid.identify(docs).collect()
    assert len(got) == len(made)
    by = {r.doc_id: r for r in got}
    for i, text, lang in made:
        assert by[i].held_out == (i is None or zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= by[i].score <= 1
    held = [(by[i].lang_pred, lang) for i, _, lang in made[:240] if by[i].held_out]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) > 0.95
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by[1003].lang_pred == "xa" and by[None].lang_pred == "xa"


def test_prediction_sees_only_the_text(spark):
    made = rows()
    schema = "doc_id long, text string, lang string"
    first = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spark.createDataFrame(made, schema)).collect()}
    changed = [(i, t, "no" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in made]
    second = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spark.createDataFrame(changed, schema)).collect()}
    assert first == second


def test_kernel_of_presence_vectors():
    a, b = np.zeros(1 << langid.HASH_BITS, np.uint8), np.zeros(1 << langid.HASH_BITS, np.uint8)
    langid.mark_presence("abcabc", a)
    langid.mark_presence("ABC", b)
    # Presence only: ab, bc, ca, abc, bca, cab, abca, bcab, cabc and ab, bc, abc.
    assert a.sum() == 9 and b.sum() == 3 and (a & b).sum() == 3
    whole, parts = np.zeros_like(a), np.zeros_like(a)
    text = "".join(random.Random(1).choice("abcdefghijkl") for _ in range(5000))
    langid.mark_presence(text, whole)
    old, langid.PIECE = langid.PIECE, 700
    try:
        langid.mark_presence(text, parts)
    finally:
        langid.PIECE = old
    assert (whole == parts).all()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(docs).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0


def plain_scores(train, texts, languages):
    """One-versus-rest kernel ridge regression over sets of n-gram cells, without features or a model matrix."""

    def cells(text):
        row = np.zeros(1 << langid.HASH_BITS, np.uint8)
        langid.mark_presence(text, row)
        return frozenset(np.flatnonzero(row).tolist())

    kernel = lambda a, b: len(a & b) / max(1, len(a) * len(b)) ** 0.5
    known = [cells(t) for _, t, _ in train]
    gram = np.array([[kernel(a, b) for b in known] for a in known])
    targets = np.array([[lang == x for x in languages] for _, _, lang in train], float)
    dual = np.linalg.solve(gram + langid.RIDGE * np.eye(len(known)), targets)
    return np.array([[kernel(cells(t), b) for b in known] for t in texts]) @ dual


def test_scores_equal_plain_kernel_ridge_regression(spark):
    # As many documents as landmarks at most: the Nyström features are exact.
    made = rows(200)
    train = [r for r in made if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    assert len(train) <= langid.LANDMARKS
    found = langid.identify(spark.createDataFrame(made, "doc_id long, text string, lang string")).collect()
    languages = sorted(WORDS)
    want = dict(zip([r[0] for r in made], plain_scores(train, [r[1] for r in made], languages), strict=True))
    for r in found:
        values = want[r.doc_id]
        assert abs(r.score - min(1, max(0, values.max()))) < 1e-4
        if abs(values[0] - values[1]) > 1e-3:
            assert r.lang_pred == languages[int(values.argmax())]


def test_an_id_that_many_rows_share(spark):
    made = rows(300)
    shared = next(i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % 4 != 2)
    made += [(shared, f"alor beni coru {i}", "xa") for i in range(1500)] + [(shared, "alor beni", "xa")] * 500
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string").repartition(4)
    chosen = langid.sample(docs).collect()
    assert len(chosen) <= 2 * langid.SAMPLE_PER_LANGUAGE
    assert len({(r.lang, r["rank"]) for r in chosen}) == len(chosen)
    assert np.mean([r.lang_pred == lang for r, (_, _, lang) in zip(sorted(langid.identify(docs).collect(), key=lambda r: r.doc_id)[:300], made, strict=False)]) > 0.95
