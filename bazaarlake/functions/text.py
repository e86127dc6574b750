"""Normalisation of listing text: Column in, Column out, all inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake import vocabulary as V
from bazaarlake.functions.numbers import to_int, to_long


def _rewrite(c: Column, pattern: str, replacement: str) -> Column:
    """Apply one rule in its fastest form.

    Plain text is replaced as text. Alternatives that all begin with a plain character are guarded by a
    look at that character, so that most positions fail at one test.
    """
    if not set(pattern) & set(".*?+|()[]{}^$\\"):
        return F.replace(c, F.lit(pattern), F.lit(replacement))
    first = {alternative[:1] for alternative in pattern.split("|")}
    if len(first) > 1 and not first & set(".*?+()[]{}^$\\"):
        pattern = f"(?=[{''.join(sorted(first))}])(?:{pattern})"
    return F.regexp_replace(c, pattern, replacement)


def apply_rules(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda acc, rule: _rewrite(acc, *rule), rules, c)


def _ranges(characters: str) -> str:
    """Character-class body of a set of characters, neighbours joined to ranges."""
    points = sorted({ord(c) for c in characters})
    starts = [p for p in points if p - 1 not in points]
    ends = [p for p in points if p + 1 not in points]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True))


# V.SPECIAL split by character range. java.util.regex tests the members of a class one after the other,
# so the long accented class is only asked about characters that are not ASCII, and the ASCII ones are
# listed singly, which makes their class one bit set.
_ASCII_KEPT = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_ ")
_ASCII_SPECIAL = "".join(f"\\x{i:02x}" for i in range(128) if chr(i) not in _ASCII_KEPT)
_OTHER_SPECIAL = rf"(?![\x00-\x7f])[^{_ranges(V.ACCENTED + V.ACCENTED.upper())}]"


def letters_only(c: Column, by: str = " ") -> Column:
    """Replace every run of characters outside the kept alphabet."""
    ascii_marked = F.regexp_replace(c, _OTHER_SPECIAL, "#")
    return F.regexp_replace(ascii_marked, f"[{_ASCII_SPECIAL}]+", by)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " {2,}", " "))


def normalise(c: Column) -> Column:
    return squeeze(letters_only(c))


def name_a(c: Column, labels: V.StoreALabels = V.STORE_A) -> Column:
    """Lower case, without badge line and [promotion] blocks, normalised."""
    rules = ((rf"{labels.badge.lower()}\+?\n", " "), (r"\[.*?\]", " "))
    return normalise(apply_rules(F.lower(c), rules))


def name_b(c: Column) -> Column:
    """Lower case, without [promotion] and (remark) blocks, normalised."""
    return normalise(apply_rules(F.lower(c), ((r"\[.*?\]", " "), (r"\(.*?\)", " "))))


def price_a(c: Column) -> Column:
    """'₫99.000 - ₫150.000' is 150000: the text after the last currency mark."""
    # No point is left, so there is no decimal tail to drop.
    return F.replace(F.regexp_replace(c, f".*{V.CURRENCY}", ""), F.lit("."), F.lit("")).try_cast("bigint")


def price_b(c: Column) -> Column:
    """'₫1,234,000' is 1234000."""
    return to_long(F.translate(c, f"{V.CURRENCY},", ""))


def brand_b(c: Column, labels: V.StoreBLabels = V.STORE_B) -> Column:
    return normalise(F.regexp_replace(F.lower(c), labels.no_brand, V.NO_INFO))


def review_count_b(c: Column, labels: V.StoreBLabels = V.STORE_B) -> Column:
    return to_int(apply_rules(F.lower(c), ((labels.no_ratings, "0"), (labels.ratings, ""))))


def attrs_a(c: Column) -> Column:
    """Option JSON text as plain words."""
    return F.trim(letters_only(F.lower(c)))


def attrs_b(c: Column) -> Column:
    """Option map as plain words, in map order."""
    return normalise(F.lower(c.cast("string")))


def markup_a(c: Column) -> Column:
    """Description HTML of store A reduced to 'root-level-level-//label: value/...' text."""
    reduced = squeeze(apply_rules(F.lower(c), V.SLASHED_CATEGORIES + V.MARKUP_RULES))
    return apply_rules(reduced, (("</>", "/"), ("<.*?>", "")))


def markup_b(c: Column) -> Column:
    """Description HTML of store B as plain words."""
    return normalise(apply_rules(F.lower(c), V.MARKUP_RULES + (("</>", " "), ("<.*?>", " "))))


def shipping_fee(c: Column) -> Column:
    """First run of digits once marks are deleted ('₫15.000 - ₫30.000' is '15000')."""
    return F.regexp_extract(letters_only(F.lower(c), ""), "[0-9]+", 0)


def unfused(c: Column) -> Column:
    """The same value, in a projection that Spark does not fuse with its neighbours.

    Fused text rules are one method of far more than the 8000 bytes up to which the JVM compiles methods, so it would interpret
    them for every row. A projection with a higher-order function is generated by itself, in small methods.
    """
    return F.get(F.transform(F.array(c), lambda x: x), 0)


def joined_text(*columns: str) -> Column:
    return F.concat_ws(" ", *columns)


def non_blank(c: Column) -> Column:
    """The text when it holds anything but white space, else NULL."""
    return F.when(c.rlike(r"\S"), c)


def strip(c: Column) -> Column:
    """Trim every ASCII white space, not only spaces."""
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))
