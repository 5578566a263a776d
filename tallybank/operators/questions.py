"""Question tables: wide and long form, normalised records, keys, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.functions.text import normalize_answer, null_words, strip_unsafe
from tallybank.operators.pages import option_text
from tallybank.operators.schema import QUESTION_COLUMNS, with_absent

LETTERS = ("A", "B", "C", "D", "E")
NOT_GIVEN = "N/A"
# Words of a wrong result, and of a missing comment.
WRONG_RESULTS = ("errada", "incorreta", "wrong", "false")
WRONG_RESULTS_SHORT = ("errada", "incorreta")
NO_COMMENT = ("", "n/a", "nan", "none")
# Fixed value: critical chi-square for four degrees of freedom at 95 %.
CHI_SQUARE_LIMIT = 9.49


# --- shape -----------------------------------------------------------------------------------


def widen_options(questions: DataFrame, letters=LETTERS) -> DataFrame:
    """``options`` array to Alternativa_* columns, row by row, without a shuffle."""
    wide = questions.withColumns({
        f"Alternativa_{x}": F.coalesce(option_text("options", x), F.lit("")) for x in letters})
    return wide.drop("options")


def pivot_options(options: DataFrame, key: str, order: str, letters=LETTERS) -> DataFrame:
    """(key, letter, text) rows to one row per question; the last of equal letters stays.
    Letters are given, so one job is enough, and rows shrink to one per letter before the shuffle."""
    wide = options.groupBy(key).pivot("letter", list(letters)).agg(F.max_by("text", order))
    return wide.select(key, *[F.coalesce(F.col(x), F.lit("")).alias(f"Alternativa_{x}") for x in letters])


def export_questions(questions: DataFrame, letters=LETTERS) -> DataFrame:
    """Fixed column order; absent columns are blank and missing fields read N/A."""
    alternatives = [f"Alternativa_{x}" for x in letters]
    full = with_absent(questions, [*QUESTION_COLUMNS, *alternatives])
    return full.select(*[F.coalesce(c, F.lit(NOT_GIVEN)).alias(c) for c in QUESTION_COLUMNS],
                       *[F.coalesce(c, F.lit("")).alias(c) for c in alternatives])


def text_or(name: str, columns, default: str | None) -> Column:
    """Trimmed text of a column; ``default`` when the column is absent or holds a null word."""
    if name not in columns:
        return F.lit(default).cast("string")
    value = null_words(F.trim(F.col(name).cast("string")))
    return value if default is None else F.coalesce(value, F.lit(default))


def question_record(questions: DataFrame, number: str, subject: str = NOT_GIVEN) -> DataFrame:
    """Normalised record: defaults filled, answer as a bare capital, generated id where it is missing."""
    have = questions.columns
    named = {
        "banca": "Banca", "ano": "Ano", "orgao": "Orgao", "prova": "Prova", "assunto": "Assunto",
        "enunciado": "Enunciado", "alt_a": "Alternativa_A", "alt_b": "Alternativa_B",
        "alt_c": "Alternativa_C", "alt_d": "Alternativa_D", "alt_e": "Alternativa_E",
    }
    own_id = F.concat(F.lit("Q"), F.col(number).cast("string"))
    return questions.select(
        F.coalesce(text_or("ID_Questao", have, None), own_id).alias("id_questao"),
        text_or("Disciplina", have, subject).alias("disciplina"),
        *[text_or(column, have, NOT_GIVEN).alias(field) for field, column in named.items()],
        normalize_answer(text_or("Resposta_Correta", have, NOT_GIVEN)).alias("gabarito"),
    )


def content_key(*columns: str) -> Column:
    """MD5 of the texts joined by a double bar; a null counts as empty text."""
    return F.md5(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def output_name(number: Column, record_prefix: str = "orgao", prefix_length: int | None = None) -> Column:
    """``Q001_<year>_<body>_<topic>_GAB<answer>`` from a normalised record, unsafe characters removed."""
    topic = F.substring(F.replace(F.replace("assunto", F.lit(" "), F.lit("_")), F.lit("/"), F.lit("-")), 1, 40)
    label = F.col(record_prefix)
    if prefix_length is not None:
        # Board variant: shortened board before the year.
        label = F.substring(F.replace(label, F.lit(" "), F.lit("_")), 1, prefix_length)
        parts = (label, F.col("ano"))
    else:
        parts = (F.col("ano"), label)
    name = F.concat_ws("_", F.format_string("Q%03d", number), *parts, topic,
                       F.concat(F.lit("GAB"), F.col("gabarito")))
    return strip_unsafe(name)


# --- selection -------------------------------------------------------------------------------


def wrong_answers(questions: DataFrame, words=WRONG_RESULTS) -> DataFrame:
    return questions.filter(F.lower("Resultado").isin(*words))


def pick_items(listing: DataFrame, number: str, choice: str) -> DataFrame:
    """``TODOS`` for all, or 1-based numbers such as ``1, 4``; numbers that do not exist are ignored."""
    if choice.strip().upper() == "TODOS":
        return listing
    wanted = [int(part) for part in choice.split(",")]
    return listing.filter(F.col(number).isin(*wanted))


# --- profiles --------------------------------------------------------------------------------


def value_shares(frame: DataFrame, column: str) -> DataFrame:
    """(value, n, pct of all rows). Rows are counted per value first; the total is the sum of those counts."""
    counts = frame.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (counts.filter(F.col("value").isNotNull())
            .select("value", "n", F.round(F.col("n") * 100.0 / total, 1).alias("pct")))


def top_values(frame: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts go by value."""
    counts = (frame.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
              .agg(F.count("*").alias("n")))
    return counts.orderBy(F.desc("n"), "value").limit(k)


def bank_profile(questions: DataFrame) -> DataFrame:
    """Exact distinct counts and the first board, in one row."""
    return questions.agg(
        F.count("*").alias("total"),
        F.count_distinct("Banca").alias("bancas"),
        F.count_distinct("Ano").alias("anos"),
        F.count_distinct("Orgao").alias("orgaos"),
        F.count_distinct("Assunto").alias("assuntos"),
        F.min_by("Banca", "ID_Questao").alias("primeira_banca"),
    )


def chi_square(frame: DataFrame, column: str, letters=None, categories: int = 5) -> DataFrame:
    """Uniformity of answers: expected is rows/categories. Only letters that occur add a term, unless
    ``letters`` are given, in which case an absent letter adds its full expected count."""
    counts = frame.groupBy(column).agg(F.count("*").alias("n"))
    observed = F.when(F.col(column).isNotNull(), F.col("n").cast("double"))
    sums = counts.agg(F.sum("n").cast("double").alias("total"), F.sum(observed * observed).alias("squares"),
                      F.sum(observed).alias("seen"), F.count(observed).alias("k"))
    expected = F.col("total") / categories
    # Sum of (o-e)^2/e over k letters, written on sums so that one pass is enough.
    statistic = F.col("squares") / expected - 2 * F.col("seen") + F.col("k") * expected
    if letters is not None:
        statistic = statistic + (len(letters) - F.col("k")) * expected
    return sums.select(
        F.round(expected, 1).alias("expected"),
        F.round(statistic, 2).alias("chi_square"),
        (statistic < CHI_SQUARE_LIMIT).alias("uniform"),
    )


def answered_rate(questions: DataFrame) -> DataFrame:
    """Questions with a known answer, out of all."""
    found = F.count_if(F.coalesce("Resposta_Correta", F.lit(NOT_GIVEN)) != NOT_GIVEN)
    return questions.agg(found.alias("found"), F.count("*").alias("total"))


def mock_score(questions: DataFrame) -> DataFrame:
    return questions.agg(F.count_if(F.col("Resultado") == "Certa").alias("certas"),
                         F.count_if(F.col("Resultado") == "Errada").alias("erradas"),
                         F.count("*").alias("total"))
