"""From raw ledger and trial balance to the classified silver table, with quality counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.functions.accounts import clean_account, clean_counterparty
from tallybank.functions.dates import parse_date_safe
from tallybank.functions.money import MONEY, parse_number_auto
from tallybank.functions.text import fold_ascii_upper
from tallybank.operators.joins import first_seen
from tallybank.operators.schema import BALANCE_RENAMES, LEDGER_RENAMES
from tallybank.sources.staging import stored

AMOUNTS = ("MOVIMENTO", "DEBITO", "CREDITO")


def is_text(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.StringType)


def as_money(frame: DataFrame, name: str, parse) -> F.Column:
    """Text is parsed; a numeric column is only rounded to cents, never re-read as local text."""
    return parse(F.col(name)) if is_text(frame, name) else F.col(name).try_cast(MONEY)


def as_date(frame: DataFrame, name: str, parse) -> F.Column:
    return parse(F.col(name)) if is_text(frame, name) else F.col(name).cast("date")


def clean_balance(balance: DataFrame, order: str = "ORD") -> DataFrame:
    """Account dimension: cleaned key, group and class, first row per key."""
    balance = balance.withColumnsRenamed(BALANCE_RENAMES)
    keyed = balance.select(clean_account(F.col("CONTA")).alias("CONTA_CHAVE"), "GRUPO", "CTP", order)
    return first_seen(keyed.filter(F.col("CONTA_CHAVE").isNotNull()), ["CONTA_CHAVE"], order)


def clean_ledger(ledger: DataFrame) -> DataFrame:
    """Typed and cleaned ledger rows; unreadable dates and amounts become null, none are dropped."""
    ledger = ledger.withColumnsRenamed(LEDGER_RENAMES)
    changes = {
        "DATA": as_date(ledger, "DATA", parse_date_safe),
        "CONTA": clean_account(F.col("CONTA")),
        "CONTRAPARTIDA": clean_counterparty(F.col("CONTRAPARTIDA")),
        "HISTORICO": fold_ascii_upper(F.col("HISTORICO")),
    }
    changes |= {c: as_money(ledger, c, parse_number_auto) for c in AMOUNTS if c in ledger.columns}
    return ledger.withColumns(changes)


def classify(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Attach group and class of the account and of the counter-account. Row count never changes.

    Spark broadcasts the accounts if their measured size allows it; beyond that both sides shuffle, and adaptive
    execution splits keys that are too frequent in the ledger.
    """
    frame = ledger.withColumns({
        "CONTA_CHAVE": clean_account(F.col("CONTA")),
        "CONTRAPARTIDA_CHAVE": clean_counterparty(F.col("CONTRAPARTIDA")),
    })
    for key, group, kind in (("CONTA_CHAVE", "GRUPO_CONTA", "CLASS_CONTA"),
                             ("CONTRAPARTIDA_CHAVE", "GRUPO_CTP", "CLASS_CTP")):
        side = accounts.alias("side")
        frame = (frame.alias("rows")
                 .join(side, F.col(f"rows.{key}") == F.col("side.CONTA_CHAVE"), "left")
                 .select("rows.*", F.col("side.GRUPO").alias(group), F.col("side.CTP").alias(kind)))
    return frame


def build_silver(ledger: DataFrame, balance: DataFrame, order: str = "ORD") -> DataFrame:
    """Cleaned and classified ledger. Of a balance account listed twice the first by ``order`` counts; ``read_balance``
    supplies the order of the rows in their files. The accounts are stored first, so that their size is known when the lookups
    are planned."""
    return classify(clean_ledger(ledger), stored(clean_balance(balance, order)))


# --- quality ---------------------------------------------------------------------------------


def null_profile(frame: DataFrame) -> DataFrame:
    """(coluna, linhas_totais, nulos_qtd, nulos_pct) from a single pass."""
    names = frame.columns
    counted = frame.agg(F.count("*").alias("linhas_totais"),
                        *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"n{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("coluna"), F.col(f"n{i}").alias("nulos_qtd"))
                      for i, n in enumerate(names)])
    share = F.round(F.try_divide(F.col("nulos_qtd") * 100.0, F.col("linhas_totais")), 2)
    return (counted.select("linhas_totais", F.inline(pairs))
            .select("coluna", "linhas_totais", "nulos_qtd", share.alias("nulos_pct")))


def schema_profile(frame: DataFrame) -> DataFrame:
    """(coluna, tipo, linhas): declared types with the number of filled values per column."""
    kinds = F.create_map(*[F.lit(x) for pair in frame.dtypes for x in pair])
    profile = null_profile(frame)
    return profile.select("coluna", kinds[F.col("coluna")].alias("tipo"),
                          (F.col("linhas_totais") - F.col("nulos_qtd")).alias("preenchidos"))


def load_quality(raw_dates: F.Column, date: F.Column) -> list[F.Column]:
    """Counters of a load: dates, amounts and lookups, for one ``agg`` over the silver table."""
    blank = raw_dates.isNull() | (F.trim(raw_dates) == "")
    return [
        F.count("*").alias("linhas"),
        F.count_if(date.isNotNull()).alias("datas_validas"),
        F.count_if(blank).alias("datas_vazias"),
        F.count_if(date.isNull() & ~blank).alias("datas_invalidas"),
        F.count("DEBITO").alias("debito_preenchido"),
        F.count_if(F.col("DEBITO").isNull()).alias("debito_nulo"),
        F.count("CREDITO").alias("credito_preenchido"),
        F.count_if(F.col("CREDITO").isNull()).alias("credito_nulo"),
        F.count_if(F.col("DEBITO").isNull() & F.col("CREDITO").isNull()).alias("sem_debito_credito"),
        F.count_if(F.col("MOVIMENTO") == 0).alias("movimento_zero"),
        F.count_if(F.col("GRUPO_CONTA").isNull()).alias("grupo_conta_vazio"),
        F.count_if(F.col("CLASS_CONTA").isNull()).alias("class_conta_vazio"),
        F.count_if(F.col("GRUPO_CTP").isNull()).alias("grupo_ctp_vazio"),
        F.count_if(F.col("CLASS_CTP").isNull()).alias("class_ctp_vazio"),
    ]
