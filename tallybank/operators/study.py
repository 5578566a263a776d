"""Study material: prompts, attempts, run figures and booklets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.functions.text import html_escape
from tallybank.operators.questions import LETTERS, NO_COMMENT
from tallybank.operators.scoring import is_error_text, word_count

# Planning figures per model name part (first that fits counts), and speech figures.
MODEL_FIGURES = (
    ("3-5-haiku", 10, 0.0008),
    ("haiku-4-5", 15, 0.001),
    ("3-5-sonnet", 20, 0.003),
    ("sonnet-4-5", 30, 0.004),
)
DEFAULT_FIGURES = (20, 0.003)
WORDS_PER_MINUTE = 150
NEURAL_PER_MILLION, STANDARD_PER_MILLION = 16, 4
CHARS_PER_TOKEN = 4
COST_PER_1000_TOKENS = 0.018
# Fixed value: the text that stands for the summary of a question without a comment.
NO_COMMENT_SUMMARY = """TEMA:
Não identificado

EXPLICAÇÃO OBJETIVA:
Não há comentário do professor disponível para resumir.

MOTIVO DA RESPOSTA CORRETA:
Não foi possível gerar a explicação sem o comentário.

RESUMO PARA MEMORIZAÇÃO:
Questão sem comentário do professor.
"""

SCORE_BASE = 1000


def render_prompt(template: str, **values: Column) -> Column:
    """Template with ``{name}`` places filled from columns; ``{{`` and ``}}`` stand for braces."""
    parts = []
    for piece in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        if piece in ("{{", "}}"):
            parts.append(F.lit(piece[0]))
        elif piece.startswith("{") and piece.endswith("}"):
            parts.append(F.coalesce(values[piece[1:-1]].cast("string"), F.lit("N/A")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def lacks_comment(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(*NO_COMMENT), F.lit(True))


def summary_or_fallback(comment: Column, summary: Column) -> Column:
    """The fixed text where there was no comment to summarise."""
    return F.when(lacks_comment(comment), F.lit(NO_COMMENT_SUMMARY)).otherwise(summary)


# --- attempts --------------------------------------------------------------------------------


def best_attempt(attempts: DataFrame, key: str, accept: int, carry=()) -> DataFrame:
    """(key, attempt, score, carried numbers) of the first attempt that scores at least ``accept``, else of the last.

    Attempt and score travel as one whole number, so the grouping works on fixed-width values and
    shrinks every key to one row before the shuffle; texts are not moved at all. ``carry`` names
    numeric columns of the chosen attempt to bring along.
    """
    packed = F.col("attempt") * SCORE_BASE + F.col("score")
    good = F.when(F.col("score") >= accept, packed)
    chosen = F.coalesce(F.min(good), F.max(packed))
    carried = [F.when(F.min(good).isNotNull(), F.min_by(c, good)).otherwise(F.max_by(c, packed)).alias(c) for c in carry]
    picked = attempts.groupBy(key).agg(chosen.alias("packed"), *carried)
    return picked.select(key, F.floor(F.col("packed") / SCORE_BASE).cast("long").alias("attempt"),
                         F.pmod("packed", F.lit(SCORE_BASE)).cast("long").alias("score"), *carry)


def with_attempt_text(picked: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    """The chosen attempts with their texts."""
    return picked.join(attempts.select(key, "attempt", "text"), [key, "attempt"])


def run_summary(results: DataFrame, unit_cost: float, text: str = "text") -> DataFrame:
    """Successes, errors and their shares, and the cost of the successes."""
    error = F.coalesce(is_error_text(F.col(text)), F.lit(True))
    total, bad = F.count("*"), F.count_if(error)
    good = total - bad
    return results.agg(
        total.alias("total"), good.alias("successes"), bad.alias("errors"),
        F.round(F.try_divide(good * 100.0, total), 1).alias("success_pct"),
        F.round(F.try_divide(bad * 100.0, total), 1).alias("error_pct"),
        F.round(good * F.lit(unit_cost).cast("double"), 2).alias("cost"),
    )


def mean_seconds(results: DataFrame, started: str, ended: str) -> DataFrame:
    """Elapsed time of a run and its mean per item."""
    elapsed = F.unix_micros(F.max(ended)) - F.unix_micros(F.min(started))
    return results.agg((elapsed / 1e6).alias("seconds"),
                       F.try_divide(elapsed / 1e6, F.count("*")).alias("mean_seconds"))


def _figure(model: Column, which: int) -> Column:
    cases = [F.when(F.contains(F.lower(model), F.lit(part)), F.lit(figures[which]))
             for part, *figures in MODEL_FIGURES]
    return F.coalesce(*cases, F.lit(DEFAULT_FIGURES[which]))


def run_estimate(n: Column, model: Column) -> tuple[Column, Column]:
    """(minutes, cost) of analysing ``n`` questions with a model."""
    return (F.round(n * _figure(model, 0) / 60.0, 1).alias("minutes"),
            F.round(n * _figure(model, 1), 2).alias("cost"))


def speech_stats(text: Column, neural: Column) -> list[Column]:
    """Words, spoken minutes, speech cost, tokens and token cost of a text."""
    chars = F.length(text)
    tokens = F.floor(chars / CHARS_PER_TOKEN)
    price = F.when(neural, NEURAL_PER_MILLION).otherwise(STANDARD_PER_MILLION)
    return [
        word_count(text).alias("words"),
        F.round(word_count(text) / WORDS_PER_MINUTE, 1).alias("minutes"),
        F.round(chars / 1e6 * price, 6).alias("speech_cost"),
        tokens.alias("tokens"),
        F.round(tokens / 1000 * COST_PER_1000_TOKENS, 6).alias("token_cost"),
    ]


# --- booklets --------------------------------------------------------------------------------


def line_breaks(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("<br/>"))


def rich_text(text: Column) -> Column:
    """Escaped text with paragraphs, line breaks and **bold** pairs as tags."""
    safe = html_escape(text)
    paragraphs = F.replace(safe, F.lit("\n\n"), F.lit("</p><p>"))
    return F.regexp_replace(line_breaks(paragraphs), r"\*\*(.+?)\*\*", "<b>$1</b>")


def option_html(letter: str, text: Column, answer: Column) -> Column:
    css = F.when(F.upper(answer) == letter, "alt correta").otherwise("alt")
    safe = html_escape(F.coalesce(text, F.lit("")), quotes=False)
    return F.concat(F.lit('<div class="'), css, F.lit(f'"><b>{letter})</b> '), safe, F.lit("</div>"))


def fragment_html(number: Column, statement: Column, options: dict[str, Column], answer: Column,
                  analysis: Column) -> Column:
    """One question of a booklet."""
    blocks = [option_html(x, options[x], answer) for x in LETTERS if x in options]
    return F.concat(
        F.lit('<div class="questao"><div class="num">QUESTÃO '), number.cast("string"),
        F.lit('</div><div class="enunciado">'), html_escape(statement, quotes=False),
        F.lit('</div><div class="alternativas">'), *blocks,
        F.lit('</div><div class="analise">'), line_breaks(html_escape(analysis, quotes=False)),
        F.lit("</div></div>"),
    )


def booklet(fragments: DataFrame, key: str, number: str = "number", fragment: str = "fragment",
            *, volume_size: int) -> DataFrame:
    """(key, volume, questions, body): fragments joined in question order.

    A booklet is cut into volumes of ``volume_size`` question numbers, from 1 on. Numbers must be unique within a
    booklet: a number given twice, or a null one, ends the job with an error that names it. So no group that is joined
    holds more fragments than that. The error comes from counts, before anything is gathered.
    """
    volume = (F.floor((F.col(number) - 1) / volume_size) + 1).cast("long").alias("volume")
    dealt = fragments.select(key, volume, number, fragment).repartition(key, "volume")
    single = dealt.groupBy(key, "volume", number).agg(F.count("*").alias("n"), F.first(fragment).alias(fragment))
    wrong = F.concat(F.lit("question number "), F.coalesce(F.col(number).cast("string"), F.lit("null")), F.lit(" of booklet "),
                     F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(" is not unique"))
    checked = single.withColumn(fragment, F.when((F.col("n") == 1) & F.col(number).isNotNull(), F.col(fragment))
                                .otherwise(F.raise_error(wrong).cast("string")))
    ordered = F.array_sort(F.collect_list(F.struct(number, fragment)))
    parts = F.transform(ordered, lambda p: p[fragment])
    return (checked.groupBy(key, "volume")
            .agg(F.count("*").alias("questions"), F.array_join(parts, "\n").alias("body")))


def text_report(statement: Column, options: Column, answer: Column, comment: Column, summary: Column) -> Column:
    """Plain-text page of one question."""
    rule, thin = "=" * 50, "-" * 50
    pieces = [F.lit(f"{rule}\nANÁLISE DE QUESTÃO\n{rule}")]
    for title, value in (("ENUNCIADO", statement), ("ALTERNATIVAS", options), ("RESPOSTA CORRETA", answer),
                         ("COMENTÁRIO DO PROFESSOR", comment)):
        pieces.append(F.concat(F.lit(f"\n{title}\n"), F.coalesce(value, F.lit("N/A"))))
    pieces += [F.lit(f"\n{thin}\nRESUMO GERADO PELA IA\n{thin}\n"), F.coalesce(summary, F.lit("N/A")), F.lit(f"\n{rule}")]
    return F.concat_ws("\n", *pieces)
