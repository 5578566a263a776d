"""Amounts: Brazilian and mixed number text to DECIMAL(18,2), and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _brazilian(text: Column) -> Column:
    """Thousands dots out, decimal comma to point."""
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def parse_money_br(text: Column) -> Column:
    """``1.234,56`` style text. Thousands dots go, the comma becomes the decimal point, other marks are dropped."""
    plain = _brazilian(text)
    # Nearly all amounts cast at once; only the others are searched for stray marks.
    return F.coalesce(plain.try_cast(MONEY), F.regexp_replace(plain, r"[^0-9.\-]", "").try_cast(MONEY))


def parse_number_auto(text: Column, to: str = MONEY) -> Column:
    """Number text whose decimal mark is whichever separator stands last; blanks and null words give null."""
    text = F.trim(text)
    last_comma = F.locate(",", F.reverse(text))
    last_dot = F.locate(".", F.reverse(text))
    plain = (
        F.when(F.lower(text).isin("", "nan", "none", "nat"), F.lit(None))
        .when((last_comma > 0) & ((last_dot == 0) | (last_comma < last_dot)), _brazilian(text))
        .when(last_comma > 0, F.replace(text, F.lit(","), F.lit("")))
        .otherwise(text)
    )
    return plain.try_cast(to)


def money_text(amount: Column) -> Column:
    """Two decimals with a comma, no thousands mark."""
    return F.replace(amount.cast(MONEY).cast("string"), F.lit("."), F.lit(","))
