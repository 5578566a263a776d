"""Audit configuration: which tests run, their word lists and their group lists."""

from __future__ import annotations

import dataclasses
import json
import re
from dataclasses import dataclass, field

# Test names, the tests switched on as shipped, and their descriptions.
TEST_NAMES = (
    "TESTE_1_1", "TESTE_1_2", "TESTE_1_3", "TESTE_1_4", "TESTE_1_5", "TESTE_1_6", "TESTE_1_7",
    "TESTE_1_8", "TESTE_2_1", "TESTE_3_1", "TESTE_4_1", "TESTE_5_1", "TESTE_6_1", "TESTE_7_1",
    "TESTE_7_2", "TESTE_7_3", "TESTE_7_4", "TESTE_7_5", "TESTE_7_6", "TESTE_7_7", "TESTE_7_9",
)
SHIPPED_TESTS = ("TESTE_1_3", "TESTE_1_4", "TESTE_1_5", "TESTE_1_7", "TESTE_1_8")
DESCRIPTIONS = {
    "TESTE_1_1": "Data nula",
    "TESTE_1_2": "Feriados/Fins de semana",
    "TESTE_1_3": "Histórico nulo",
    "TESTE_1_4": "Histórico com palavras específicas",
    "TESTE_1_5": "Histórico com ajuste/acerto",
    "TESTE_1_6": "Histórico com reversão/estorno",
    "TESTE_1_7": "Histórico com outros/diversas",
    "TESTE_1_8": "Histórico com nomes específicos",
    "TESTE_2_1": "Sequência de lançamentos",
    "TESTE_3_1": "Valor redondo",
    "TESTE_4_1": "Sequência por histórico/movimento/data",
    "TESTE_6_1": "Movimento alto com receitas",
    "TESTE_7_1": "Classe conta resultado",
    "TESTE_7_2": "Débito imobilizado com receitas",
    "TESTE_7_3": "Teste sempre nulo",
    "TESTE_7_4": "Débito/Crédito em contas específicas",
    "TESTE_7_5": "Crédito receitas sem contas a receber",
    "TESTE_7_6": "Variação cambial",
    "TESTE_7_7": "Movimento negativo em caixa",
    "TESTE_7_9": "Pessoas politicamente expostas",
}
NO_DESCRIPTION = "Descrição não disponível"

# 2025 holidays, dd/MM/yyyy.
HOLIDAYS_2025 = (
    "01/01/2025", "20/01/2025", "13/02/2025", "29/03/2025", "21/04/2025", "23/04/2025", "01/05/2025",
    "30/05/2025", "07/09/2025", "12/10/2025", "02/11/2025", "15/11/2025", "20/11/2025", "25/12/2025",
)

# Two names glued together by a missing comma show up as a lower-case letter followed by a capital.
_GLUED = re.compile(r"[a-zà-ÿ][A-ZÀ-Þ]")


class ConfigError(ValueError):
    """The audit configuration names an unknown test or holds a broken list."""


def _lowered(values) -> tuple[str, ...]:
    return tuple(str(v).strip().lower() for v in values)


@dataclass(frozen=True)
class AuditConfig:
    """Everything an audit run depends on. Lists are compared lower-cased and trimmed."""

    active: tuple[str, ...] = SHIPPED_TESTS

    # Word lists and group lists of the tests.
    instruction_words: tuple[str, ...] = (
        "segundo", "acordo", "ordem", "mail", "conforme", "controller", "pedido")
    adjustment_words: tuple[str, ...] = ("ajuste", "acerto")
    reversal_words: tuple[str, ...] = ("reversao", "reversão", "estorno")
    misc_words: tuple[str, ...] = ("outros", "outras", "desconhecidos", "diversos")
    fx_words: tuple[str, ...] = ("variacao cambial", "variação cambial", "cambial")
    watch_names: tuple[str, ...] = ()
    exposed_names: tuple[str, ...] = ()
    result_classes: tuple[str, ...] = ("Resultado",)
    large_revenue_groups: tuple[str, ...] = ("Receita líquida", "Receitas financeiras")
    revenue_groups: tuple[str, ...] = ("Outras receitas", "Receitas financeiras", "Receita bruta")
    asset_groups: tuple[str, ...] = ("Imobilizado",)
    credit_excluded_groups: tuple[str, ...] = ("Caixa e equivalentes de caixa", "Fornecedores")
    receivable_revenue_groups: tuple[str, ...] = ("Receita líquida", "Receitas financeiras")
    receivable_groups: tuple[str, ...] = ("Contas a receber",)
    fx_excluded_groups: tuple[str, ...] = ("Emprestimos", "Partes relacionadas")
    cash_groups: tuple[str, ...] = ("Caixa e equivalentes de caixa",)

    large_amount: int = 30000
    cash_months: tuple[int, ...] = (1, 2)
    holidays: tuple[str, ...] = HOLIDAYS_2025
    # None flags weekends of every year; (2025,) keeps to the years a hand-typed list covers.
    weekend_years: tuple[int, ...] | None = None
    # True adds the national holidays of every year, movable ones too, to the listed days.
    national_feasts: bool = False
    base_day: str = "2025-12-31"
    follow_month: str = "2026-01"
    sample_size: int = 25
    sample_seed: int = 42
    # True folds accents on the text as well as on the names it is searched for.
    fold_names: bool = True
    # False lets a blank name match every text.
    drop_blank_names: bool = True

    _lists: tuple[str, ...] = field(default=(
        "result_classes", "large_revenue_groups", "revenue_groups", "asset_groups",
        "credit_excluded_groups", "receivable_revenue_groups", "receivable_groups",
        "fx_excluded_groups", "cash_groups"), init=False, repr=False)

    def __post_init__(self):
        unknown = [t for t in self.active if t not in TEST_NAMES]
        if unknown:
            raise ConfigError(f"unknown tests: {unknown}")
        for name in self._lists:
            glued = [v for v in getattr(self, name) if _GLUED.search(v)]
            if glued:
                raise ConfigError(f"{name}: two names run together in {glued}")
            object.__setattr__(self, name, _lowered(getattr(self, name)))
        for name in ("instruction_words", "adjustment_words", "reversal_words", "misc_words", "fx_words"):
            words = _lowered(getattr(self, name))
            if "" in words:
                raise ConfigError(f"{name}: a blank word matches every text")
            object.__setattr__(self, name, words)
        # Evaluation order is catalogue order, whatever order the caller used.
        object.__setattr__(self, "active", tuple(t for t in TEST_NAMES if t in self.active))

    def replace(self, **changes) -> "AuditConfig":
        return dataclasses.replace(self, **changes)

    def to_json(self) -> str:
        values = {f.name: getattr(self, f.name) for f in dataclasses.fields(self) if f.init}
        return json.dumps(values, ensure_ascii=False, indent=2)

    @classmethod
    def from_json(cls, text: str) -> "AuditConfig":
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()}
        return cls(**values)


ALL_TESTS = AuditConfig(active=TEST_NAMES)


def catalog_rows(cfg: AuditConfig) -> list[tuple[str, str, str, str]]:
    """(TESTE, STATUS, CATEGORIA, DESCRICAO) for every known test."""
    return [
        (name,
         "ATIVO" if name in cfg.active else "INATIVO",
         "HISTORICO" if name.startswith("TESTE_1") else "CLASSIFICACAO",
         DESCRIPTIONS.get(name, NO_DESCRIPTION))
        for name in TEST_NAMES
    ]


def config_markdown(cfg: AuditConfig, elapsed_seconds: float | None = None) -> str:
    """A readable page with the active tests and their lists."""
    lines = ["# Audit configuration", ""]
    if elapsed_seconds is not None:
        lines += [f"Elapsed: {elapsed_seconds:.2f} s", ""]
    for title, wanted in (("Active tests", "ATIVO"), ("Inactive tests", "INATIVO")):
        lines += [f"## {title}", ""]
        lines += [f"- **{name}**: {text}" for name, status, _, text in catalog_rows(cfg) if status == wanted]
        lines.append("")
    lines += ["## Lists", ""]
    for f in dataclasses.fields(cfg):
        value = getattr(cfg, f.name)
        if f.init and f.name != "active" and isinstance(value, tuple):
            lines.append(f"- {f.name}: {', '.join(map(str, value))}")
    return "\n".join(lines) + "\n"
