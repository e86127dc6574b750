"""Fields cut out of a listing's description and shop text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake import vocabulary as V
from bazaarlake.functions import text
from bazaarlake.functions.numbers import to_double, to_int


def header_text(desc: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    """Reduced description before the free-text marker: breadcrumb and labelled fields."""
    return F.regexp_replace(desc, f"{labels.description}(.*)", "")


def labelled(header: Column, label: str, end: str = "/") -> Column:
    return F.regexp_extract(header, f"{label}: (.+?){end}", 1)


def labelled_words(header: Column, label: str, end: str = "/") -> Column:
    return text.letters_only(labelled(header, label, end))


def free_text(desc: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    """Normalised words after the free-text marker, whose spaces may be runs of other characters outside the kept alphabet."""
    gap = f"(?: |{V.SPECIAL})"
    marker = gap.join(labels.description.split(" "))
    return text.normalise(F.regexp_extract(desc, f"(?s){marker}(.*)", 1))


def breadcrumb_top(desc: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    return F.regexp_extract(desc, f"{labels.breadcrumb_root}-(.+?)-", 1)


def breadcrumb_path(desc: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    return F.regexp_extract(desc, f"{labels.breadcrumb_root}-(.+)-//", 1)


def path_top(path: Column) -> Column:
    """First part of 'a/b/c'; '' when the path has a single part."""
    return F.regexp_extract(path, "(.+?)/", 1)


def path_levels(path: Column, separator: str, depth: int) -> Column:
    """First ``depth`` parts joined ' / ', or 'no info' when the path is shorter or missing."""
    parts = F.split(path, separator)
    return F.when(
        F.size(parts) >= depth, F.array_join(F.slice(parts, 1, depth), V.LEVEL_SEPARATOR)
    ).otherwise(V.NO_INFO)


def category_path(*levels: Column) -> Column:
    return F.concat_ws("/", *levels)


def line_after(shop: Column, label: str) -> Column:
    """The full line below a label line."""
    return F.regexp_extract(shop, f"{label}\n(.+)\n", 1)


def shop_name_a(shop: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    """First line that is not the badge."""
    return F.regexp_extract(F.regexp_replace(shop, rf"{labels.badge}\+?\n", ""), "(.+?)\n", 1)


def shop_name_b(shop: Column) -> Column:
    """The second line."""
    return F.regexp_extract(shop, "\n(.+?)\n", 1)


def badge_tier(shop: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    """'2' for the plus badge, '1' for the plain badge, '0' without one."""
    return (
        F.when(shop.startswith(f"{labels.badge}+\n"), "2")
        .when(shop.startswith(f"{labels.badge}\n"), "1")
        .otherwise("0")
    )


def last_line_after(shop: Column, label: str) -> Column:
    """Like ``line_after`` for a label whose value may be the last line."""
    return F.regexp_extract(shop, f"{label}\n(.+)", 1)


def percent_after(shop: Column, label: str) -> Column:
    """'97%' below the label as 0.97."""
    return to_double(F.replace(line_after(shop, label), F.lit("%"), F.lit(""))) / 100


def age_months(joined: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    """Shop age in months from its 'joined' line: years count 12, months 1, everything else 0."""
    number = to_int(F.regexp_extract(joined, "[0-9]+", 0))
    return (
        F.when(joined.contains(labels.year), number * 12)
        .when(joined.contains(labels.month), number)
        .otherwise(0)
    )


def rating_lines(block: Column) -> Column:
    """struct(avg_rating, num_review, num_sold) from a multi-line block.

    Six lines carry all three values, four lines only the sold count, other shapes nothing.
    """
    lines = F.split(block, "\n")
    full, short = F.size(lines) == 6, F.size(lines) == 4
    return F.struct(
        F.when(full, F.get(lines, 0)).alias("avg_rating"),
        F.when(full, F.get(lines, 1)).alias("num_review"),
        F.when(full | short, F.get(lines, 3)).alias("num_sold"),
    )
