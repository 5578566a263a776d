"""Column names, required columns, renames and projections."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column layouts and renames of the ledger, trial balance and question tables.
LEDGER_RENAMES = {"Conta.1": "CONTA", "Conta_1": "CONTA", "C/PARTIDA": "CONTRAPARTIDA"}
BALANCE_RENAMES = {"N° da conta": "CONTA", "Grupo": "GRUPO", "Ativo | Passivo | PL | Resultado": "CTP"}
LEDGER_COLUMNS = ("Conta", "CONTA", "Descrição", "DATA", "CONTRAPARTIDA", "DEBITO", "CREDITO", "MOVIMENTO",
                  "HISTORICO")
SILVER_COLUMNS = LEDGER_COLUMNS + ("GRUPO_CONTA", "CLASS_CONTA", "CONTA_CHAVE", "CONTRAPARTIDA_CHAVE",
                                   "GRUPO_CTP", "CLASS_CTP")
QUESTION_COLUMNS = ("ID_Questao", "Indice_Pagina", "Ano", "Banca", "Orgao", "Prova", "Disciplina", "Assunto",
                    "Enunciado", "Resposta_Correta")
MOCK_COLUMNS = ("Numero_Questao", "Resultado", "Enunciado", "Resposta_Marcada", "Resposta_Correta",
                "Comentario_Professor")


def clean_name(name: str) -> str:
    """Repair a header cell: byte-order mark, quotes, doubly encoded text, accents, separators."""
    name = name.strip().lstrip("﻿").replace("ï»¿", "")
    for charset in ("latin-1", "cp1252"):
        try:
            # Text written as UTF-8 and read as a single-byte charset turns back this way.
            name = name.encode(charset).decode("utf-8")
            break
        except UnicodeError:
            continue
    name = name.lstrip("﻿").replace('"', "").replace("'", "").strip()
    name = re.sub(r"[ .\-]", "_", name)
    return "".join(c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn")


def distinct_names(names: list[str]) -> list[str]:
    """Names that differ only by case get a number, so each stays addressable."""
    seen: dict[str, int] = {}
    result = []
    for name in names:
        count = seen.get(name.lower(), 0)
        seen[name.lower()] = count + 1
        result.append(name if count == 0 else f"{name}_{count}")
    return result


def clean_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*distinct_names([clean_name(c) for c in frame.columns]))


def missing_columns(frame: DataFrame, names) -> list[str]:
    return [n for n in names if n not in frame.columns]


def has_columns(frame: DataFrame, names) -> bool:
    return not missing_columns(frame, names)


def require_columns(frame: DataFrame, names, error: type[Exception] = ValueError) -> None:
    absent = missing_columns(frame, names)
    if absent:
        raise error(f"missing columns: {absent}")


def ordered(frame: DataFrame, names) -> DataFrame:
    """Exactly these columns in this order; raises when one is absent."""
    require_columns(frame, names)
    return frame.select(*[F.col(f"`{n}`") for n in names])


def with_absent(frame: DataFrame, names, value: str = "") -> DataFrame:
    """Add text columns that are not there yet."""
    return frame.withColumns({n: F.lit(value) for n in missing_columns(frame, names)})


def alternative_columns(names) -> list[str]:
    """Answer-option columns among the names, whatever their case."""
    return [n for n in names if "alternativa" in n.lower() or n.lower().startswith("alt_")]
