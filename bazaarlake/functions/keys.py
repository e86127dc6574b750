"""Keys: variant match keys, ids inside URLs, partition keys of the storage layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake import vocabulary as V


def match_key(c: Column) -> Column:
    """Order-free key of an option text: 'Màu:Xanh, Size:L' and 'Xanh - L' are both 'l_xanh'."""

    def value(token: Column) -> Column:
        after_colon = F.when(
            F.instr(token, ":") > 0, F.regexp_replace(token, r"(?s)^[^:]*:", "")
        ).otherwise(token)
        return F.regexp_replace(after_colon, r"[^\p{L}\p{N}_]", "")

    tokens = F.transform(F.split(F.lower(c), r"[,;\-]\s*"), value)
    key = F.array_join(F.array_sort(F.filter(tokens, lambda t: t != "")), "_")
    return F.when(c.isNull() | (c == ""), V.DEFAULT_MATCH_KEY).otherwise(key)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def item_id(url: Column) -> Column:
    """Number after '-i' in a product URL, '' when there is none."""
    return F.regexp_extract(url, "-i([0-9]+)", 1)


def absolute_url(href: Column, scheme: str = "https:", host: str = "") -> Column:
    """Absolute form of '//host/path' and '/path' links; other links stay as they are."""
    return (
        F.when(href.startswith("//"), F.concat(F.lit(scheme), href))
        .when(href.startswith("/"), F.concat(F.lit(f"{scheme}//{host}"), href))
        .otherwise(href)
    )


def raw_week(ts: Column) -> Column:
    """'MMyyyy_w' with w = day of month // 7 + 1 (days 1-6 are week 1; not ISO weeks)."""
    week = F.floor(F.dayofmonth(ts) / 7) + 1
    return F.concat_ws("_", F.date_format(ts, "MMyyyy"), week.cast("string"))


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "ddMMyyyy")


def daily_index(ts: Column, prefix: str = "logstash-") -> Column:
    return F.concat(F.lit(prefix), F.date_format(ts, "yyyy.MM.dd"))


def listing_key(*columns: str) -> Column:
    """Stable 64-bit document id of a natural key, the same on every replay."""
    return F.xxhash64(*columns)
