import random

import corpus_pipeline
import pytest

from bazaarlake.llm import langid, mixing
from bazaarlake.llm.storage import WIDE_ROWS

COLUMNS = corpus_pipeline.COLUMNS
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture
def sf(spark, tmp_path):
    rng = random.Random(8)
    word = {"en": "th er on an re he in ed".split(), "fr": "eau ou ai que ment tre é è".split()}
    prose = lambda lang, n: " ".join("".join(rng.choice(word[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(n))
    clean = [(i, prose(lang := rng.choice(["en", "fr"]), 120), lang, f"s{i % 3}") for i in range(60)]
    near = clean[4][1].split()
    near[50] = "changed"
    passage = prose("en", 30)
    items = [(i, prose("en", 20) + ". " + prose("en", 5) + ".") for i in range(5)]
    rows = [
        *clean,
        *((100 + i, clean[i][1], clean[i][2], "s0") for i in range(5)),
        (200, " ".join(near), clean[4][2], "s1"),
        (300, "12345 67890 !!", "en", "s1"),
        (301, None, "en", None),
        (400, prose("en", 60) + " " + passage + " " + prose("en", 60), "en", "s2"),
        (401, prose("en", 60) + " " + passage + " " + prose("en", 60), "en", "s2"),
        *((500 + i, prose("en", 70) + " " + text + " " + prose("en", 70), "en", None) for i, text in items),
        (None, prose("fr", 100), None, "s0"),
    ]
    rows = [(i, t, lang, s, len(t or ""), "clash") for i, t, lang, s in rows]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, passage


def test_each_stage_takes_what_it_should(spark, sf):
    folder, rows, passage = sf
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.collect()}
    everything = {r[0] for r in rows}
    gone = [{300, 301}, {100, 101, 102, 103, 104, 200}, set(), {500, 501, 502, 503, 504}]
    for (_, stage), lost in zip(corpus_pipeline.STAGES[:-1], gone, strict=True):
        docs = corpus_pipeline.write_table(stage(spark, docs, folder), "test")
        assert docs.columns == COLUMNS
        everything -= lost
        assert ids(docs) == everything and docs.count() == len(everything)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert passage in texts[400] and passage not in texts[401] and len(texts[401]) < len(texts[400])
    assert texts[0] == rows[0][1]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in mixed} == everything
    for source in {r.source for r in mixed}:
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
        assert all(r.taken <= mixing.MOST_REPEATS * r.size for r in own)


def test_run_equals_its_stages(spark, sf):
    folder, _, _ = sf
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.write_table(stage(spark, docs, folder), "test")
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_language_stage_gets_no_text_back_from_python(spark, sf, monkeypatch):
    kept, batches, predict, write = [], [], langid.predict, corpus_pipeline.write_table
    monkeypatch.setattr(langid, "predict", lambda docs, model, keep: kept.append(keep) or predict(docs, model, keep))
    monkeypatch.setattr(
        corpus_pipeline, "write_table", lambda df, purpose, **limits: batches.append(limits.get("batch_rows")) or write(df, purpose, **limits)
    )
    docs = spark.read.parquet(f"{sf[0]}/documents.parquet").select(COLUMNS)
    found = corpus_pipeline.language(spark, docs, sf[0])
    assert kept and "text" not in kept[0] and batches == [WIDE_ROWS]
    ids = {r.doc_id for r in found.collect()}
    assert found.columns == COLUMNS and not ids & {300, 301} and {0, 100, 400, None} <= ids
