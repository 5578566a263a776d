"""Literal edge cases of the column functions."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybank.functions import accounts, dates, money, text
from tallybank.functions import predicates as P
from tallybank.operators import pages, scoring, study


def evaluate(spark, values, build, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in frame.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def test_money_br(spark):
    given_texts = ["1.234,56", "-10,00", "", "   ", "abc", None, "R$ 1.234,56", "1-2"]
    expected = [Decimal("1234.56"), Decimal("-10.00"), None, None, None, None, Decimal("1234.56"), None]
    assert evaluate(spark, given_texts, money.parse_money_br) == expected


def test_number_auto(spark):
    given_texts = ["1.234,56", "1,234.56", "1234,5", "1234.5", "nan", "x", "", None, "1.234.567,8", "NaT"]
    expected = [Decimal("1234.56"), Decimal("1234.56"), Decimal("1234.50"), Decimal("1234.50"), None, None, None,
                None, Decimal("1234567.80"), None]
    assert evaluate(spark, given_texts, money.parse_number_auto) == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=2), min_size=1, max_size=20))
def test_money_text_round_trip(spark, amounts):
    back = evaluate(spark, amounts, lambda c: money.parse_money_br(money.money_text(c)), "decimal(18,2)")
    assert back == [Decimal(a).quantize(Decimal("0.01")) for a in amounts]


def test_dates(spark):
    new_year = dt.date(2025, 12, 31)
    given_texts = ["31/12/2025", "2025-12-31", "2025-12-31 10:00:00", "45/01/2025", "Conta:", " ", None, "05/03/2025",
                   " 5/3/2025 "]
    expected = [new_year] * 3 + [None] * 4 + [dt.date(2025, 3, 5)] * 2
    assert evaluate(spark, given_texts, dates.parse_date) == expected
    safe = evaluate(spark, ["45658", "45658.0", "31.12.2025", "31-12-2025", "31/12/25", "x"], dates.parse_date_safe)
    assert safe == [dt.date(2025, 1, 1)] * 2 + [new_year] * 3 + [None]
    assert evaluate(spark, [new_year, None], dates.date_text, "date") == ["31/12/2025", ""]


def test_fold(spark):
    given_texts = ["Variação - Câmbio/Ágio nº 5!", None, "ﬁm…de", "straße", "Áb", "plain text", "½"]
    assert evaluate(spark, given_texts, text.fold_ascii_upper) == [
        "VARIACAO CAMBIO AGIO NO 5", None, "FIM DE", "STRAE", "AB", "PLAIN TEXT", "12"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x24F), max_size=30), min_size=1,
                max_size=20))
def test_fold_agrees_with_decomposition_and_is_idempotent(spark, texts):
    once = evaluate(spark, texts, text.fold_ascii)
    assert once == [text.fold_plain(t) for t in texts]
    assert evaluate(spark, once, text.fold_ascii) == once


def test_accounts(spark):
    assert evaluate(spark, ["1.02-3", "12345.0", "00123", None, "1.00000"], accounts.clean_account) == [
        "1023", "12345", "00123", None, "100000"]
    assert evaluate(spark, ["1-000.05", "nan", "", None, "12 Caixa"], accounts.clean_counterparty) == [
        "100005", None, None, None, "12Caixa"]
    assert evaluate(spark, ["00123", "1e3", "abc", None, "12.5"], accounts.int_string) == ["123", "1000", "", "", ""]
    assert evaluate(spark, ["123Caixa", "Caixa", "77"], accounts.counterparty_account) == ["123", None, "77"]
    assert evaluate(spark, ["123Caixa", "Caixa", "77"], accounts.counterparty_label) == ["Caixa", None, None]


def test_null_words_and_answers(spark):
    assert evaluate(spark, ["nan", "None", " ", "x", None], text.null_words) == [None, None, None, "x", None]
    assert evaluate(spark, ["nan", "x", None], lambda c: text.null_words(c, "")) == ["", "x", ""]
    assert evaluate(spark, ["Alternativa: c", "b", "Alternativa D "], text.normalize_answer) == ["C", "B", "D"]


def test_names_for_files_and_html(spark):
    assert evaluate(spark, ["Direito - Atos: ç/é.x"], text.slug) == ["Direito___Atos_çé.x"]
    assert evaluate(spark, ["a b/ç.x-1"], text.safe_file_name) == ["a_b_ç.x-1"]
    assert evaluate(spark, ["<a href='x'>&\"", None], text.html_escape) == [
        "&lt;a href=&#39;x&#39;&gt;&amp;&quot;", "N/A"]


def test_nonworking_day(spark):
    days = [dt.date(2025, 9, 7), dt.date(2025, 9, 8), dt.date(2025, 11, 20), None, dt.date(2024, 9, 7)]
    holidays = ("20/11/2025",)
    assert evaluate(spark, days, lambda c: P.nonworking_day(c, holidays), "date") == [True, False, True, None, True]
    limited = evaluate(spark, days, lambda c: P.nonworking_day(c, holidays, (2025,)), "date")
    assert limited == [True, False, True, None, False]


def test_round_value(spark):
    amounts = [Decimal(a) if a else None for a in ("120.00", "-50.00", "9.00", "125.00", "120.01", None, "0")]
    assert evaluate(spark, amounts, P.round_value, "decimal(18,2)") == [True, True, False, False, False, None, False]


def test_names(spark):
    texts = ["pagto lima", "limao", "ZELIA PRADO", "zélia prado", "LIMÁ", "de lima.", None, "ze\u0301lia prādo",
             "élima", "\u0142 lima"]
    names = ("Lima", "Zélia Prado")
    assert evaluate(spark, texts, lambda c: P.matches_names(c, names)) == [
        True, False, True, True, True, True, None, True, False, True]
    plain = evaluate(spark, texts, lambda c: P.matches_names(c, names, fold=False))
    assert plain == [True, False, True, False, False, True, None, False, False, True]
    assert evaluate(spark, texts[:1], lambda c: P.matches_names(c, ())) == [False]


def test_contains_any(spark):
    texts = ["Conforme pedido", "nada", None]
    assert evaluate(spark, texts, lambda c: P.contains_any(c, ["PEDIDO"])) == [True, False, None]
    assert evaluate(spark, texts, lambda c: P.contains_any(c, ["x.y", "n.da", "z"])) == [False, False, None]
    assert evaluate(spark, texts, lambda c: P.contains_any(c, ["n_da"], wildcards=True)) == [False, True, None]
    assert evaluate(spark, texts, lambda c: P.contains_any(c, [""])) == [False, False, False]
    assert evaluate(spark, texts, lambda c: P.contains_any(c, [""], drop_blank=False)) == [True, True, None]


def test_mock_sentences(spark):
    sentences = ["Você marcou a resposta A, mas a alternativa correta é C.", "Correto! Você marcou a resposta B.",
                 "nada"]
    assert evaluate(spark, sentences, pages.chosen_answer) == ["A", "B", None]
    assert evaluate(spark, sentences, pages.correct_answer) == ["C", "B", None]
    assert evaluate(spark, ["a\n\n\n\nb"], pages.tidy_comment) == ["a\n\nb"]


@pytest.mark.parametrize("scorer, cases", [
    (scoring.score_law, {"": 0, "x" * 1799: 0, "x" * 1800: 10, "x" * 2500: 15, "x" * 3500: 20,
                         "alternativa a ALTERNATIVA E": 24, "✅❌✅": 5, "✅" * 5: 10, "artigo": 2, "cf": 2,
                         "⚠️": 8, "1️⃣ conceitos gabarito": 10}),
    (scoring.score_language, {"": 0, "regra": 2, "concordância": 5, "função sintática": 7}),
    (scoring.score_compact, {"": 0, "x" * 1999: 0, "x" * 2000: 20, "A: B:": 24, "✅✅": 4, "✅" * 9: 10,
                             "gabarito": 10, "regra sintaxe": 10}),
    (scoring.score_summary, {"": 10, "x" * 101: 20, "x" * 199: 20, "x" * 200: 30, "x" * 299: 30, "x" * 300: 40,
                             "x" * 1800: 40, "x" * 1801: 30, "x" * 2201: 20, "erro": 0, "TEMA:\na": 30}),
])
def test_scores_at_thresholds(spark, scorer, cases):
    assert evaluate(spark, list(cases), scorer) == list(cases.values())


def test_comment_fallback(spark):
    got = evaluate(spark, [None, "nan", " N/A ", "texto"], lambda c: study.summary_or_fallback(c, F.lit("resumo")))
    assert got == [study.NO_COMMENT_SUMMARY] * 3 + ["resumo"]


def test_prompt(spark):
    build = lambda c: study.render_prompt("{{x}} {a}/{b}", a=c, b=F.lit(None))
    assert evaluate(spark, ["1"], build) == ["{x} 1/N/A"]


def test_rich_text_closes_bold(spark):
    assert evaluate(spark, ["**a** <b>\n\nc"], study.rich_text) == ["<b>a</b> &lt;b&gt;</p><p>c"]
