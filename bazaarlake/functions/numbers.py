"""Text-to-number and numeric Column functions. Casts are tolerant: bad text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_long(c: Column) -> Column:
    """Whole number, dropping a decimal tail ('3.7' is 3)."""
    return F.regexp_replace(c, r"\.[0-9]*$", "").try_cast("bigint")


def to_int(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[0-9]*$", "").try_cast("int")


def abbreviated_count(c: Column) -> Column:
    """'3,2k' is 3200, '15k' is 15000, '1,234' is 1234; anything else is NULL."""
    thousands = F.translate(F.regexp_replace(c, "k$", ""), ",", ".").try_cast("decimal(18,6)") * 1000
    return F.when(c.endswith("k"), thousands.try_cast("int")).otherwise(
        to_int(F.translate(c, ",", ""))
    )


def share_percent(part: Column, total: Column) -> Column:
    """Share of a total in percent with one decimal (half up); 0 when the total is 0."""
    tenths = F.floor((part * 2000 + total) / (total * 2))
    return F.when(total > 0, tenths / 10).otherwise(F.lit(0.0))


def log_price(price: Column) -> Column:
    """log10 of a positive price; NULL otherwise."""
    return F.when(price > 0, F.log10(price))


def unlog_price(log_value: Column) -> Column:
    return F.pow(F.lit(10.0), log_value)


def log_base10(c: Column) -> Column:
    return F.log(10.0, c)


def first_number(*candidates: Column) -> Column:
    """First candidate of digits only, as bigint; 0 when there is none."""
    digits = (F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint")) for c in candidates)
    return F.coalesce(*digits, F.lit(0).cast("bigint"))
