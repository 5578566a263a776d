"""Rubric scores of explanation texts, as sums of native column terms."""

from __future__ import annotations

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Points, thresholds and terms of the rubrics.
LETTERS = ("A", "B", "C", "D", "E")
LENGTH_STEPS = ((3500, 20), (2500, 15), (1800, 10))
GOOD_MARK, BAD_MARK, WARNING = "✅", "❌", "⚠️"
FIRST_KEYCAP, SECOND_KEYCAP = "1️⃣", "2️⃣"
LAW_TERMS = (("art.", "artigo"), ("lei",), ("constituição", "cf"), ("princípio",))
LANGUAGE_TERMS = (
    ("regra", "norma"), ("gramática", "gramatical"), ("semântica", "sintaxe"),
    ("bechara", "cunha", "luft"), ("classe", "função"), ("interpretação", "compreensão"),
)
TECHNICAL_TERMS = ("classe gramatical", "função sintática", "concordância", "regência", "colocação",
                   "figura de linguagem")
COMPACT_TERMS = ("regra", "gramática", "semântica", "sintaxe", "interpretação")
SUMMARY_HEADINGS = ("TEMA:", "EXPLICAÇÃO OBJETIVA:", "MOTIVO DA RESPOSTA CORRETA:", "RESUMO PARA MEMORIZAÇÃO:")
SUMMARY_BAD_TERMS = ("não foi possível", "informação insuficiente", "erro", "n/a")
LONG_ACCEPT, SUMMARY_ACCEPT = 65, 60


def _has(text: Column, *terms: str) -> Column:
    return reduce(or_, [F.contains(text, F.lit(t)) for t in terms])


def _points(condition: Column, points: int) -> Column:
    return F.when(condition, points).otherwise(0)


def _total(terms) -> Column:
    return F.least(reduce(add, terms), F.lit(100)).cast("long")


def _steps(value: Column, steps) -> Column:
    """Points of the first (highest) step reached."""
    return F.coalesce(*[F.when(value >= bound, points) for bound, points in steps], F.lit(0))


def _marks(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{GOOD_MARK}{BAD_MARK}]"))


def _long_form(text: Column, term_groups) -> list[Column]:
    """The part the law and language rubrics share."""
    upper, lower = F.upper(text), F.lower(text)
    structure = reduce(and_, [
        _has(upper, "IDENTIFICAÇÃO") | _has(text, FIRST_KEYCAP),
        _has(upper, "CONCEITOS") | _has(text, SECOND_KEYCAP),
        _has(upper, "GABARITO"),
    ])
    return [
        _steps(F.length(text), LENGTH_STEPS),
        *[_points(_has(upper, f"ALTERNATIVA {x}"), 12) for x in LETTERS],
        _steps(_marks(text), ((5, 10), (3, 5))),
        *[_points(_has(lower, *group), 2) for group in term_groups],
        _points(structure, 10),
        _points(_has(lower, "pegadinha") | _has(text, WARNING), 8),
    ]


def score_law(text: Column) -> Column:
    return _total(_long_form(text, LAW_TERMS))


def score_language(text: Column) -> Column:
    return _total(_long_form(text, LANGUAGE_TERMS) + [_points(_has(F.lower(text), *TECHNICAL_TERMS), 5)])


def score_compact(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    upper, lower = F.upper(text), F.lower(text)
    return _total([
        _steps(F.length(text), ((2000, 20),)),
        *[_points(_has(upper, f"ALTERNATIVA {x}") | _has(text, f"{x}:"), 12) for x in LETTERS],
        F.least(_marks(text) * 2, F.lit(10)),
        _points(_has(upper, "GABARITO"), 10),
        *[_points(_has(lower, term), 5) for term in COMPACT_TERMS],
    ])


def score_summary(text: Column) -> Column:
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    size, lower = F.length(text), F.lower(text)
    return _total([
        F.when(size.between(300, 1800), 30).when(size.between(200, 2200), 20).when(size > 100, 10).otherwise(0),
        *[_points(_has(text, heading), 10) for heading in SUMMARY_HEADINGS],
        _points(_has(text, "\n"), 10),
        _points(~_has(lower, *SUMMARY_BAD_TERMS), 10),
        _points(_has(text, SUMMARY_HEADINGS[-1]) & (word_count(text) >= 40), 10),
    ])


def word_count(text: Column) -> Column:
    """Words between white space; an empty text has none."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def is_error_text(text: Column) -> Column:
    return F.startswith(text, F.lit(BAD_MARK))
