"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import (
    conversations,
    decontaminate,
    langid,
    licenses,
    mixing,
    neighbours,
    resampling,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    url_rules,
    warc,
)
from bazaarlake.llm.storage import read, write_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query()
def op1_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


@query()
def op2_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.identify(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query()
def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item that it holds."""
    items = decontaminate.split_items(read(spark, sf_dir, "benchmark", "item_id", "text"))
    return decontaminate.find_leaks(read(spark, sf_dir, "documents", "doc_id", "text"), items)


@query()
def op4_toxic_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


@query()
def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings."""
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op6_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in the documents."""
    return licenses.scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text"))


@query(warc.SQL)
def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable bundles and read back."""
    back = warc.archive_round_trip(spark, read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(mixing.SQL)
def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the order of their training positions."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    size = mixing.word_count("text").alias("size")
    sized = write_table(docs.select("doc_id", "source", size, mixing.place_of().alias("place")), "sizes")
    return mixing.mix(sized, F.col("place")).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position")
    )


@query(url_rules.SQL)
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the site rules, then by the pattern rules."""
    return url_rules.judge(read(spark, sf_dir, "pages", "page_id", "url"))


@query(conversations.SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage and its cheapest repair."""
    return conversations.repair_damaged(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@query(sharding.SQL)
def op12_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(read(spark, sf_dir, "documents", "doc_id", "text"))


@query(resampling.SQL)
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark, and the rank of the drawn ones."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return resampling.resample(docs, read(spark, sf_dir, "benchmark", "text"))
