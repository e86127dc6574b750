"""URL filters: pattern rules indexed by their rarest literal token.

A rule is ``host/path``: it fits that host and its subdomains where the path starts with the rule's path; ``*`` stands
for any characters. Of a rule's literal tokens the one that the fewest URLs hold is its index key; a URL's tokens fetch
the candidate rules, and only those run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.storage import write_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    pattern: str
    verdict: str
    #: Rules of the first level decide before all others; within a level the longest pattern does.
    level: int = 2


SITE_RULES = (
    Rule("org/", "allow", 1),
    Rule("example.org/es/", "block", 1),
    Rule("example.org/en/1", "block", 1),
    Rule("com/fr/", "allow", 1),
    Rule("com/de/", "block", 1),
)
PATTERN_RULES = (
    Rule("adult-*/", "block"),
    Rule("ads-*/", "block"),
    Rule("spam-*/", "block"),
    Rule("casino-*/", "block"),
    Rule("cheap-pills.*/", "block"),
    Rule("free-bets.*/", "block"),
    Rule("*/ads/*", "block"),
    Rule("*/login/*", "block"),
)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null and for texts without ``://``."""
    at = F.expr(f"instr({url}, '://')")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def regex_of(pattern: str) -> str:
    """Regular expression over host and path joined; valid for Java and RE2."""
    host, slash, path = pattern.partition("/")
    glob = lambda text, any_: any_.join(re.sub(r"([^A-Za-z0-9/_~])", r"\\\1", p) for p in text.split("*"))
    return f"(?s)^(?:[^/]*\\.)?{glob(host, '[^/]*')}{slash}{glob(path, '.*')}"


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every URL which the rule fits must hold whole: not next to ``*`` and not at the open end."""
    text = pattern.translate(str.maketrans(UPPER, LOWER))
    return sorted(
        {m[0] for m in re.finditer("[a-z0-9]+", text) if text[m.start() - 1 : m.start()] != "*" and text[m.end() : m.end() + 1] not in ("", "*")}
    )


def index_rules(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rules with their regular expression and index token; rules without a literal token get the empty one."""
    spark = urls.sparkSession
    listed = spark.createDataFrame(
        [(r.pattern, r.verdict, r.level, regex_of(r.pattern), literal_tokens(r.pattern) or [""]) for r in rules],
        "pattern string, verdict string, level int, regex string, tokens array<string>",
    )
    wanted = listed.select(F.explode("tokens").alias("token")).distinct()
    held = urls.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").count()
    choices = listed.select("*", F.explode("tokens").alias("token")).join(held, "token", "left")
    rank = F.struct(F.coalesce("count", F.lit(0)), "token")
    return choices.groupBy("pattern", "verdict", "level", "regex").agg(F.min_by("token", rank).alias("token"))


def judge(pages: DataFrame, rules: Sequence[Rule] = SITE_RULES + PATTERN_RULES, default: str = "allow") -> DataFrame:
    """Host, path, rule, pattern_rule and verdict for every row of pages (page_id, url).

    ``rule`` is the longest fitting rule of the first level, ``pattern_rule`` the longest fitting one of the others; the
    verdict is that of the first of them that there is, else ``default``. Each distinct host and path is judged
    once, and verdicts are joined back, so frequent URLs cost nothing more. Null URLs and texts without ``://`` have
    empty host and path. Repeated rows stay. Which side of a join is broadcast is left to Spark's size limit.
    """
    host, path = host_and_path("url")
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    # An empty token for the rules without a literal one.
    lowered = F.translate(F.concat("host", "path"), UPPER, LOWER)
    tokens = F.array_distinct(F.split(lowered, "[^a-z0-9]+", -1))
    with_empty = F.array_union(tokens, F.array(F.lit("")))
    urls = parsed.select("host", "path").distinct().withColumn("tokens", with_empty)
    index = index_rules(urls, rules)
    fits = (
        urls.select("host", "path", F.explode("tokens").alias("token"))
        .join(index, "token")
        .filter(F.rlike(F.concat("host", "path"), F.col("regex")))
    )
    length = F.struct(F.length("pattern"), "pattern")
    best = lambda value, test: F.max_by(F.when(test, F.col(value)), F.when(test, length))
    first, other = F.col("level") == 1, F.col("level") > 1
    verdicts = fits.groupBy("host", "path").agg(
        best("pattern", first).alias("rule"),
        best("verdict", first).alias("_first"),
        best("pattern", other).alias("pattern_rule"),
        best("verdict", other).alias("_other"),
    )
    # Against a written table the rows of one host and path, such as those of all URLs without a host, can be split over tasks.
    verdicts = write_table(verdicts, "url-verdicts")
    return parsed.join(verdicts, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", "pattern_rule", F.coalesce("_first", "_other", F.lit(default)).alias("verdict")
    )


def _values(rules: Sequence[Rule]) -> str:
    return ", ".join(f"('{r.pattern}', '{r.verdict}', {r.level}, '{regex_of(r.pattern)}')" for r in rules)


SQL = f"""
WITH parsed AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM parsed),
rules(pattern, verdict, level, regex) AS (VALUES {_values(SITE_RULES + PATTERN_RULES)}),
fits AS (
  SELECT u.host, u.path, arg_max(pattern, (length(pattern), pattern)) FILTER (level = 1) AS rule,
    arg_max(verdict, (length(pattern), pattern)) FILTER (level = 1) AS first,
    arg_max(pattern, (length(pattern), pattern)) FILTER (level > 1) AS pattern_rule,
    arg_max(verdict, (length(pattern), pattern)) FILTER (level > 1) AS other
  FROM (SELECT DISTINCT host, path FROM cut) u JOIN rules ON regexp_matches(u.host || u.path, regex) GROUP BY ALL)
SELECT page_id, c.host, c.path, rule, pattern_rule, coalesce(first, other, 'allow') AS verdict
FROM cut c LEFT JOIN fits f ON c.host = f.host AND c.path = f.path
"""
