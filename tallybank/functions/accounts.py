"""Account keys. They stay text, so leading zeros and long numbers survive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybank.functions.money import parse_number_auto


def _without_float_tail(text: Column) -> Column:
    # A number read as float is digits and exactly ".0"; that tail has to go before the dots do, or
    # 12345.0 becomes 123450. A structured account such as 1.00000 is left alone.
    text = F.trim(text)
    return F.when(text.endswith(".0"), F.regexp_replace(text, r"^(\d+)\.0$", "$1")).otherwise(text)


def clean_account(text: Column) -> Column:
    """Ledger or trial-balance account without dots and dashes."""
    return F.trim(F.replace(F.replace(_without_float_tail(text), F.lit("."), F.lit("")), F.lit("-"), F.lit("")))


def clean_counterparty(text: Column) -> Column:
    """Counter-account: letters and digits only; blanks and the word nan are null."""
    kept = F.regexp_replace(_without_float_tail(text), r"[^A-Za-z0-9]", "")
    return F.when(~kept.isin("", "nan"), kept)


def int_string(text: Column) -> Column:
    """Whole number as plain digits, blank when the text is not one."""
    number = parse_number_auto(text, "decimal(38,6)")
    whole = F.when(number == F.floor(number), F.floor(number).cast("string"))
    return F.coalesce(whole, F.lit(""))


def counterparty_account(text: Column) -> Column:
    """Leading digits of a counter-account, null if it starts otherwise."""
    return F.nullif(F.regexp_extract(text, r"^(\d+)", 1), F.lit(""))


def counterparty_label(text: Column) -> Column:
    """What follows the leading digits."""
    return F.nullif(F.regexp_extract(text, r"^\d+(.*)", 1), F.lit(""))
