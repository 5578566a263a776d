"""Predicates the audit tests are built from."""

from __future__ import annotations

import re
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybank.functions.text import accent_pattern, fold_plain

SHORT_NAME = 5


def contains_any(text: Column, words, drop_blank: bool = True, wildcards: bool = False) -> Column:
    """True where lower-cased text holds one of the words. ``wildcards`` lets % and _ act as in LIKE."""
    words = [str(w).lower() for w in words]
    if drop_blank:
        words = [w for w in words if w.strip()]
    if not words:
        return F.lit(False)
    text = F.lower(text)
    if wildcards:
        return reduce(or_, [text.like(f"%{w}%") for w in words])
    # One alternation: a chain of searches for each list makes generated code too long to be compiled.
    return text.rlike("|".join(re.escape(w) for w in words))


def names_pattern(names, spell=re.escape) -> str | None:
    """One pattern for a list of names: short single words need word boundaries, the rest match anywhere.
    Names are folded, then spelled out as patterns by ``spell``."""
    parts = []
    for name in names:
        plain = fold_plain(str(name)).strip().lower()
        if not plain:
            continue
        body = spell(plain)
        short = len(plain.split()) == 1 and len(plain) <= SHORT_NAME
        parts.append(rf"(?<![\p{{L}}\p{{N}}_]){body}(?![\p{{L}}\p{{N}}_])" if short else body)
    return "|".join(parts) or None


def matches_names(text: Column, names, fold: bool = True) -> Column:
    """True where a name occurs. With ``fold`` accents of the text do not matter: the pattern accepts the
    accented forms of each letter, which saves folding the texts."""
    plain = names_pattern(names)
    if plain is None:
        return F.lit(False)
    text = F.lower(text)
    if not fold:
        return text.rlike(plain)
    latin1 = names_pattern(names, lambda name: accent_pattern(name, latin1=True))
    return (F.when(text.rlike(r"[^\x00-\xFF]"), text.rlike(names_pattern(names, accent_pattern)))
            .otherwise(text.rlike(latin1)))


def nonworking_day(date: Column, holidays, weekend_years=None) -> Column:
    """Weekend or listed holiday (dd/MM/yyyy). ``weekend_years`` limits weekends to those years."""
    days = [datetime.strptime(h, "%d/%m/%Y").date() for h in holidays]
    weekend = F.weekday(date) >= 5
    if weekend_years is not None:
        weekend = weekend & F.year(date).isin(*weekend_years)
    return (weekend | date.isin(*days)) if days else weekend


def round_value(amount: Column) -> Column:
    """At least 10 in size, no cents, multiple of 10."""
    size = F.abs(amount)
    return (size >= 10) & (F.pmod(size, F.lit(10)) == 0)


def differs_null_safe(text: Column, values) -> Column:
    """True where trimmed lower-case text is none of the values; null counts as different."""
    text = F.trim(F.lower(text))
    return reduce(lambda a, b: a & b, [~text.eqNullSafe(F.lit(v)) for v in values])
