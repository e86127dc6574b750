import re

import pytest

from bazaarlake.sinks.seen_keys import SeenKeys


def frame(spark, keys):
    return spark.createDataFrame([(k, f"text {k}") for k in keys], "name string, text string")


def names(df):
    return sorted(r.name or "" for r in df.collect())


@pytest.mark.parametrize("slots", [8, 1 << 20])
def test_batches_are_processed_once(spark, tmp_path, slots):
    seen, known = SeenKeys(spark, str(tmp_path / "seen"), slots=slots, buckets=4, fanout=2), set()
    batches = [[f"k{i}" for i in range(a, b)] for a, b in ((0, 40), (30, 60), (0, 10), (55, 90))]
    for epoch, keys in enumerate(batches):
        coming = frame(spark, [*keys, keys[0], None])
        new = [k for k in [*keys, keys[0]] if k not in known]
        assert names(seen.missing(coming, "name")) == sorted([*new, ""])
        for _ in range(2):
            seen.add(coming, "name", epoch)
        known |= set(keys)
        seen.compact()
    assert names(seen.missing(frame(spark, sorted(known) + ["other"]), "name")) == ["other"]


def test_only_buckets_of_taken_slots_are_opened(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path / "seen"), slots=1 << 24, buckets=8)
    seen.add(frame(spark, [f"old{i}" for i in range(500)]), "name", 0)
    assert not any("/keys/" in f for f in seen.missing(frame(spark, ["new1", "new2"]), "name").inputFiles())
    found = seen.missing(frame(spark, ["new1", "old7"]), "name")
    opened = {m for f in found.inputFiles() for m in re.findall(r"/keys/.*/bucket=(\d+)/", f)}
    assert len(opened) == 1 and names(found) == ["new1"]


def test_settings(spark, tmp_path):
    with pytest.raises(ValueError):
        SeenKeys(spark, str(tmp_path), slots=100, buckets=16)
    empty = SeenKeys(spark, str(tmp_path))
    assert names(empty.missing(frame(spark, ["a"]), "name")) == ["a"]
