"""Mixing sources to target weights: a time-varying curriculum (DataFrame functions only).

Every source gets a target number of words. Its weight schedule over the training time is integrated in closed
form; a document's place in its source's cumulative word demand, divided by the target, is the share of that
integral at which it is due, so inverting the integral gives its training position. Documents are range-sorted
by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaarlake.llm.storage import write_table

WORD = r"[^\x20\x09-\x0D]+"
# No document is taken more often than this.
MOST_REPEATS = 3
# Knots of the training time from 0 to 1, and the weights there; sources take the schedules in turn, by rank.
KNOTS = (0.0, 0.5, 1.0)
SCHEDULES = ((1.5, 1.25, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
# Rows of a source that one task numbers; larger sources are cut into as many ranges as they need.
RANGE_ROWS = 2_000
# Ranges of one source, whose sums are added up in one task.
MOST_RANGES = 100_000


def word_count(text: str | Column) -> Column:
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The MD5 of the doc_id by which documents are ordered; without one, of the MD5 of the text."""
    content = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), content).cast("binary"))


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: source, source_rank, source_size and target.

    Sources ordered by code point, null last, weigh 1, 2, 3, 1, ... and share the words of all sources. A target
    stops at MOST_REPEATS times its source's size and the excess goes to the others by weight. In the order of
    limit by weight, the level that an open source gets per weight, if all before it are at their limits, rises as
    long as the next one would be above its limit and falls afterwards: the final level is the largest.
    The windows run over one narrow row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    totals = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
        .withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("_weight", (F.pmod(F.col("source_rank") - 1, F.lit(3)) + 1).cast("double"))
        .withColumn("_limit", (F.col("source_size") * MOST_REPEATS).cast("double"))
    )
    by_limit = W.orderBy(F.col("_limit") / F.col("_weight"), "source_rank")
    before = F.coalesce(F.sum("_limit").over(by_limit.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("_weight").over(by_limit.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy())
    levels = totals.withColumn("_level", (total - before) / open_weight)
    level = F.max("_level").over(W.partitionBy())
    return levels.withColumn("target", F.least("_limit", F.col("_weight") * level)).select(
        "source", "source_rank", "source_rows", "source_size", "target"
    )


def position_sql(share: str, rank: str, knots: Sequence[float], schedules: Sequence[Sequence[float]]) -> str:
    """SQL for the training time at which a source's integrated schedule reaches a share of its whole integral.

    Within a segment the weight is a + m x, so x solves a x + m x^2 / 2 = y.
    """
    cases = []
    for number, weights in enumerate(schedules):
        parts = []
        for t0, t1, a, b in zip(knots, knots[1:], weights, weights[1:], strict=False):
            parts.append((t0, a, (b - a) / (t1 - t0), (a + b) / 2 * (t1 - t0)))
        whole, done, branches = sum(p[3] for p in parts), 0.0, []
        for t0, a, slope, area in parts:
            if area == 0:
                continue
            left = f"({share} * CAST({whole!r} AS DOUBLE) - CAST({done!r} AS DOUBLE))"
            root = f"sqrt(CAST({a * a!r} AS DOUBLE) + CAST({2 * slope!r} AS DOUBLE) * {left})"
            step = f"CASE WHEN {left} <= 0 THEN 0 ELSE 2 * {left} / (CAST({a!r} AS DOUBLE) + {root}) END"
            done += area
            branches.append((f"{share} * CAST({whole!r} AS DOUBLE) <= CAST({done!r} AS DOUBLE)", f"CAST({t0!r} AS DOUBLE) + {step}"))
        inner = " ".join(f"WHEN {test} THEN {value}" for test, value in branches[:-1])
        inner = f"CASE {inner} ELSE {branches[-1][1]} END" if inner else branches[-1][1]
        cases.append(f"WHEN ({rank} - 1) % {len(schedules)} = {number} THEN {inner}")
    return f"CASE {' '.join(cases)} END"


def mix(
    sized: DataFrame,
    order_key: Column | None = None,
    knots: Sequence[float] = KNOTS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add source_size, target, taken and position to documents with doc_id, source and size, and range-sort them.

    A source's documents are taken in the order of the MD5 of their doc_id: all of them as often as the rounded
    target holds the whole source, then once more from the start until the target is reached, where the last
    document gives only the words that are still due. ``position`` is the training time of the first copy;
    ``positions`` has one for each copy. Documents of which nothing is taken come last, with a null position.

    The running word counts need no task to hold a whole source: a source is cut into ranges of its MD5 order, about
    ``range_rows`` documents each, or MOST_RANGES of them; the sums of the ranges are added up first, documents only within a range.
    Null texts have size 0. Repeated doc_ids are kept; rows that agree in doc_id and size are interchangeable. Rows without a doc_id
    take their place by a hash of all their columns. The results are the same in every run. An empty table gives an empty result. Other columns are carried along.
    """
    carried = [c for c in sized.columns if c not in ("source_size", "target", "taken", "position", "positions")]
    targets = write_table(source_targets(sized.select("source", "size")), "targets")
    # Rows without a doc_id are spread by what they hold.
    content = F.xxhash64(*(F.col(c) for c in carried)).cast("string")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), content).cast("binary")) if order_key is None else order_key
    ranges = F.least(F.ceil(F.col("_t.source_rows") / range_rows), F.lit(MOST_RANGES))
    hashed = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    rows = (
        sized.select(*carried, key.alias("_key"))
        .alias("_d")
        .join(targets.alias("_t"), F.col("_d.source").eqNullSafe(F.col("_t.source")))
        .select(
            *(F.col(f"_d.`{c}`") for c in carried),
            "_key",
            F.col("_t.source_rank").alias("_rank"),
            F.col("_t.source_size").alias("source_size"),
            F.col("_t.target").alias("target"),
            F.floor(hashed * ranges / F.lit(4294967296)).alias("_range"),
        )
    )
    sums = rows.groupBy("_rank", "_range").agg(F.sum("size").alias("_sum"))
    starts = sums.select(
        "_rank",
        "_range",
        F.coalesce(
            F.sum("_sum").over(W.partitionBy("_rank").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    within = W.partitionBy("_rank", "_range").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        rows.join(write_table(starts, "starts"), ["_rank", "_range"])
        .withColumn("_start", F.col("_before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .withColumn("_due", F.round("target").cast("long"))
        .withColumn("_whole", F.expr("CASE WHEN source_size > 0 THEN _due DIV source_size ELSE 0 END"))
        .withColumn("_left", F.col("_due") - F.col("_whole") * F.col("source_size"))
        .withColumn(
            "taken",
            F.col("_whole") * F.col("size")
            + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left") - F.col("_start"))),
        )
    )
    copies = F.expr(f"filter(sequence(0, {MOST_REPEATS - 1}), e -> size > 0 AND e * source_size + _start < _due)")
    share = "CAST(e * source_size + _start AS DOUBLE) / CAST(_due AS DOUBLE)"
    return (
        placed.withColumn("_copies", copies)
        .withColumn("positions", F.expr(f"transform(_copies, e -> {position_sql(share, '_rank', knots, schedules)})"))
        .withColumn("position", F.try_element_at("positions", F.lit(1)))
        .select(*carried, "source_size", "target", "taken", "position", "positions")
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS place FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS source_rank FROM sized GROUP BY source),
limits AS (
  SELECT *, CAST((source_rank - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(source_size * {MOST_REPEATS} AS DOUBLE) AS most
  FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source_rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limits),
targets AS (SELECT *, least(most, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.source_rank, CAST(round(t.target) AS BIGINT) AS due,
    CAST(coalesce(sum(d.size) OVER (PARTITION BY t.source_rank
      ORDER BY d.place, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size > 0 THEN (due // source_size) * size
    + greatest(0, least(size, due % source_size - start)) ELSE 0 END AS taken,
  CASE WHEN size > 0 AND start < due THEN round(
    {position_sql("(CAST(start AS DOUBLE) / CAST(due AS DOUBLE))", "source_rank", KNOTS, SCHEDULES)}, 6) END AS position
FROM placed
"""
