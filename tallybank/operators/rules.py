"""The audit tests: each is a name, the columns it needs, and a condition."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybank.config import AuditConfig
from tallybank.functions.predicates import (
    contains_any, differs_null_safe, matches_names, nonworking_day, round_value)

# Boolean helper columns that the stateful tests read; audit() adds them when needed.
REPEATED = "__repeated"
TRIPLICATE = "__triplicate"
SAMPLED = "__sampled"
REVERSED = "__reversed"

TEXT_COLUMNS = ("GRUPO_CONTA", "CLASS_CONTA", "CLASS_CTP", "GRUPO_CTP", "HISTORICO")


@dataclass(frozen=True)
class Rule:
    name: str
    requires: tuple[str, ...]
    build: Callable[[AuditConfig], Column]
    helper: str | None = None


def _text(words: str) -> Callable[[AuditConfig], Column]:
    return lambda cfg: contains_any(F.col("HISTORICO"), getattr(cfg, words))


def _nonzero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)) != 0


def _in(name: str, values) -> Column:
    return F.col(name).isin(*values)


def _asset_or_outside(cfg: AuditConfig) -> Column:
    asset_debit = _nonzero("DEBITO") & _in("GRUPO_CONTA", cfg.asset_groups)
    # A null group makes the second half null, so such rows are not marked.
    outside_credit = _nonzero("CREDITO") & ~_in("GRUPO_CONTA", cfg.credit_excluded_groups)
    return asset_debit | outside_credit


def _negative_cash(cfg: AuditConfig) -> Column:
    return ((F.col("MOVIMENTO") < 0) & _in("GRUPO_CONTA", cfg.cash_groups)
            & _in("CLASS_CTP", cfg.result_classes) & F.month("DATA").isin(*cfg.cash_months))


RULES: dict[str, Rule] = {r.name: r for r in (
    Rule("TESTE_1_1", ("DATA",), lambda cfg: F.col("DATA").isNull()),
    Rule("TESTE_1_2", ("DATA",), lambda cfg: nonworking_day(F.col("DATA"), cfg.holidays, cfg.weekend_years)),
    Rule("TESTE_1_3", ("HISTORICO",), lambda cfg: F.col("HISTORICO").isNull()),
    Rule("TESTE_1_4", ("HISTORICO",), _text("instruction_words")),
    Rule("TESTE_1_5", ("HISTORICO",), _text("adjustment_words")),
    Rule("TESTE_1_6", ("HISTORICO",), _text("reversal_words")),
    Rule("TESTE_1_7", ("HISTORICO",), _text("misc_words")),
    Rule("TESTE_1_8", ("HISTORICO",),
         lambda cfg: matches_names(F.col("HISTORICO"), cfg.watch_names, cfg.fold_names)),
    Rule("TESTE_2_1", ("CONTA", "MOVIMENTO", "CLASS_CTP"),
         lambda cfg: F.col(REPEATED) & _in("CLASS_CTP", cfg.result_classes), REPEATED),
    Rule("TESTE_3_1", ("MOVIMENTO",), lambda cfg: round_value(F.col("MOVIMENTO"))),
    Rule("TESTE_4_1", ("HISTORICO", "MOVIMENTO", "DATA"), lambda cfg: F.col(TRIPLICATE), TRIPLICATE),
    Rule("TESTE_5_1", (), lambda cfg: F.col(SAMPLED), SAMPLED),
    Rule("TESTE_6_1", ("MOVIMENTO", "GRUPO_CONTA"),
         lambda cfg: (F.col("MOVIMENTO") > cfg.large_amount) & _in("GRUPO_CONTA", cfg.large_revenue_groups)),
    Rule("TESTE_7_1", ("CLASS_CONTA",), lambda cfg: _in("CLASS_CONTA", cfg.result_classes)),
    Rule("TESTE_7_2", ("DEBITO", "GRUPO_CONTA", "GRUPO_CTP"),
         lambda cfg: (F.col("DEBITO") != 0) & _in("GRUPO_CONTA", cfg.asset_groups)
         & _in("GRUPO_CTP", cfg.revenue_groups)),
    Rule("TESTE_7_3", ("DATA", "CONTA", "MOVIMENTO"), lambda cfg: F.col(REVERSED), REVERSED),
    Rule("TESTE_7_4", ("DEBITO", "CREDITO", "GRUPO_CONTA"), _asset_or_outside),
    Rule("TESTE_7_5", ("CREDITO", "GRUPO_CONTA", "GRUPO_CTP"),
         lambda cfg: (F.col("CREDITO") != 0) & _in("GRUPO_CONTA", cfg.receivable_revenue_groups)
         & differs_null_safe(F.col("GRUPO_CTP"), cfg.receivable_groups)),
    Rule("TESTE_7_6", ("HISTORICO", "GRUPO_CONTA"),
         lambda cfg: contains_any(F.col("HISTORICO"), cfg.fx_words)
         & ~_in("GRUPO_CONTA", cfg.fx_excluded_groups)),
    Rule("TESTE_7_7", ("MOVIMENTO", "GRUPO_CONTA", "CLASS_CTP", "DATA"), _negative_cash),
    Rule("TESTE_7_9", ("HISTORICO",),
         lambda cfg: contains_any(F.col("HISTORICO"), cfg.exposed_names, drop_blank=cfg.drop_blank_names)),
)}


def rule_mark(name: str, cfg: AuditConfig) -> Column:
    """``SIM`` where the test hits, else null."""
    return F.when(RULES[name].build(cfg), F.lit("SIM")).alias(name)
