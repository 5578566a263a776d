"""Queries over the ledger: cleaning, classification, audit tests, summaries and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybank.config import TEST_NAMES, AuditConfig, catalog_rows
from tallybank.functions.accounts import (
    clean_account, clean_counterparty, counterparty_account, counterparty_label, int_string)
from tallybank.functions.dates import date_text, excel_serial_date, is_br_date, parse_date
from tallybank.functions.feasts import feast_days
from tallybank.functions.money import parse_money_br, parse_number_auto
from tallybank.functions.text import fold_ascii_upper, normalize_text, null_words
from tallybank.operators import audit as A
from tallybank.operators import silver as S
from tallybank.operators.joins import first_seen
from tallybank.operators.names import name_matches
from tallybank.operators.sampling import audit_sample
from tallybank.operators.schema import clean_names
from tallybank.plans.adapters import (
    BALANCE_SQL, LEDGER_SQL, PARTY_SQL, WATCH_SQL, balance, ledger, party_texts, spread, table, watch_list)
from tallybank.plans.registry import query
from tallybank.sources.ledger import (
    read_balance, read_calendar, read_ledger, read_silver, read_text_table, revalidate)
from tallybank.sources.run_log import read_run_log, write_gold_logged
from tallybank.sources.sinks import (
    export_sheets, folder_inventory, write_gold_csv, write_silver_csv, write_silver_parquet)
from tallybank.sources.staging import staging_folder, stored

# Invented names and dates inside the period of the given tables.
WATCH_NAMES = ("Lima", "Zélia Prado")
EXPOSED_NAMES = ("", "Prado", "Odete Brum")
HOLIDAYS = ("25/12/1996", "01/05/1997", "07/09/1998", "15/01/1997")
SHIPPED = AuditConfig(watch_names=WATCH_NAMES)
FULL = AuditConfig(active=TEST_NAMES, watch_names=WATCH_NAMES, exposed_names=EXPOSED_NAMES, holidays=HOLIDAYS,
                   base_day="1996-12-31", follow_month="1997-01")

# --- SQL counterparts ------------------------------------------------------------------------


def _sql_date(text):
    return f"CAST(coalesce(try_strptime({text}, '%d/%m/%Y'), try_strptime({text}, '%Y-%m-%d')) AS DATE)"


def _sql_money(text):
    return f"TRY_CAST(replace(replace({text}, '.', ''), ',', '.') AS DECIMAL(18,2))"


LEDGER = f"WITH ledger AS ({LEDGER_SQL})"
PREPARED = f"""{LEDGER}, prepared AS (
  SELECT {_sql_date('DATA')} AS DATA, CONTA, CONTRAPARTIDA, {_sql_money('MOVIMENTO')} AS MOVIMENTO,
    {_sql_money('DEBITO')} AS DEBITO, {_sql_money('CREDITO')} AS CREDITO, lower(trim(HISTORICO)) AS HISTORICO, DATA AS RAW
  FROM ledger)"""
CLASSIFIED = f"""{PREPARED}, balance AS ({BALANCE_SQL}),
accounts AS (SELECT CONTA AS k, arg_min(GRUPO, ORD) AS GRUPO, arg_min(CTP, ORD) AS CTP FROM balance GROUP BY 1),
classified AS (
  SELECT p.*, lower(trim(a.GRUPO)) AS GRUPO_CONTA, lower(trim(a.CTP)) AS CLASS_CONTA,
    lower(trim(c.GRUPO)) AS GRUPO_CTP, lower(trim(c.CTP)) AS CLASS_CTP
  FROM prepared p LEFT JOIN accounts a ON replace(replace(p.CONTA, '.', ''), '-', '') = a.k
    LEFT JOIN accounts c ON replace(p.CONTRAPARTIDA, '-', '') = c.k)"""


def _sql_words(words):
    return "(" + " OR ".join(f"contains(HISTORICO, '{w}')" for w in words) + ")"


def _sql_in(column, values):
    return f"{column} IN (" + ", ".join(f"'{v}'" for v in values) + ")"


BASE = ("DATA", "CONTA", "CONTRAPARTIDA", "MOVIMENTO", "DEBITO", "CREDITO", "HISTORICO")
CLASSES = ("GRUPO_CONTA", "CLASS_CONTA", "GRUPO_CTP", "CLASS_CTP")


def _sql_hash(columns):
    return "md5(concat_ws('|', '42', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + "))"


SQL_RULES = {
    "TESTE_1_1": "DATA IS NULL",
    "TESTE_1_2": "(isodow(DATA) >= 6 OR CAST(DATA AS VARCHAR) IN "
                 "('1996-12-25', '1997-05-01', '1998-09-07', '1997-01-15'))",
    "TESTE_1_3": "HISTORICO IS NULL",
    "TESTE_1_4": _sql_words(FULL.instruction_words),
    "TESTE_1_5": _sql_words(FULL.adjustment_words),
    "TESTE_1_6": _sql_words(FULL.reversal_words),
    "TESTE_1_7": _sql_words(FULL.misc_words),
    "TESTE_1_8": r"regexp_matches(strip_accents(HISTORICO), '\blima\b|zelia prado')",
    "TESTE_2_1": f"(seq2 > 1 AND {_sql_in('CLASS_CTP', FULL.result_classes)})",
    "TESTE_3_1": "(abs(MOVIMENTO) >= 10 AND abs(MOVIMENTO) % 10 = 0)",
    "TESTE_4_1": "seq4 >= 3",
    "TESTE_5_1": "seq5 <= 25",
    "TESTE_6_1": f"(MOVIMENTO > 30000 AND {_sql_in('GRUPO_CONTA', FULL.large_revenue_groups)})",
    "TESTE_7_1": _sql_in("CLASS_CONTA", FULL.result_classes),
    "TESTE_7_2": f"(DEBITO <> 0 AND {_sql_in('GRUPO_CONTA', FULL.asset_groups)} "
                 f"AND {_sql_in('GRUPO_CTP', FULL.revenue_groups)})",
    "TESTE_7_3": "(DATA >= DATE '1997-01-01' AND DATA < DATE '1997-02-01' AND posted)",
    "TESTE_7_4": f"((coalesce(DEBITO, 0) <> 0 AND {_sql_in('GRUPO_CONTA', FULL.asset_groups)}) OR "
                 f"(coalesce(CREDITO, 0) <> 0 AND NOT {_sql_in('GRUPO_CONTA', FULL.credit_excluded_groups)}))",
    "TESTE_7_5": f"(CREDITO <> 0 AND {_sql_in('GRUPO_CONTA', FULL.receivable_revenue_groups)} "
                 "AND GRUPO_CTP IS DISTINCT FROM 'contas a receber')",
    "TESTE_7_6": f"({_sql_words(FULL.fx_words)} AND NOT {_sql_in('GRUPO_CONTA', FULL.fx_excluded_groups)})",
    "TESTE_7_7": f"(MOVIMENTO < 0 AND {_sql_in('GRUPO_CONTA', FULL.cash_groups)} "
                 f"AND {_sql_in('CLASS_CTP', FULL.result_classes)} AND month(DATA) IN (1, 2))",
    "TESTE_7_9": "(contains(HISTORICO, 'prado') OR contains(HISTORICO, 'odete brum'))",
}


SQL_ROW_HASH = "md5(concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in sorted(BASE + CLASSES)) + "))"
SQL_ORDER = f"""coalesce(date_diff('day', DATE '0001-01-01', DATA) + 1, 0),
  CAST(concat('0x', substr({SQL_ROW_HASH}, 1, 9)) AS BIGINT),
  coalesce({_sql_in('CLASS_CTP', FULL.result_classes)}, FALSE), {SQL_ROW_HASH}"""


RANKED = f"""{CLASSIFIED}, posted AS (
  SELECT DISTINCT CONTA AS bc, MOVIMENTO AS bm, TRUE AS posted FROM classified WHERE DATA = DATE '1996-12-31'),
joined AS (
  SELECT t.*, coalesce(b.posted, FALSE) AS posted,
    row_number() OVER (PARTITION BY CONTA, MOVIMENTO ORDER BY {SQL_ORDER}) AS seq2
  FROM classified t LEFT JOIN posted b ON t.CONTA = b.bc AND t.MOVIMENTO = b.bm),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY HISTORICO, MOVIMENTO, DATA
    ORDER BY {SQL_ORDER}, seq2 > 1) AS seq4 FROM joined),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY {_sql_hash(BASE + CLASSES)}, seq2 > 1, seq4 >= 3) AS seq5 FROM counted)"""
MARKED = RANKED + ", marked AS (SELECT *, " + ", ".join(
    f"CASE WHEN {SQL_RULES[t]} THEN 'SIM' END AS {t}" for t in TEST_NAMES) + " FROM ranked)"
SQL_SHIPPED = MARKED + f""", flagged AS (SELECT *, CASE WHEN coalesce({', '.join(SHIPPED.active)}) IS NULL
  THEN 'RETIRAR' ELSE 'MANTER' END AS FLAG FROM marked)"""
SQL_FULL = MARKED + f""", flagged AS (SELECT *, CASE WHEN coalesce({', '.join(TEST_NAMES)}) IS NULL
  THEN 'RETIRAR' ELSE 'MANTER' END AS FLAG FROM marked)"""


# --- Spark frames ----------------------------------------------------------------------------


def prepared(spark, sf):
    return A.prepare_ledger(ledger(spark, sf))


def classified(spark, sf):
    # Of a stored dimension the planner knows the size, so a small one is broadcast before the ledger is shuffled for it.
    accounts = stored(S.clean_balance(balance(spark, sf)))
    frame = A.prepare_ledger(S.classify(ledger(spark, sf), accounts))
    return frame.select(*BASE, *CLASSES)


def shipped_audit(spark, sf):
    return A.run_audit(ledger(spark, sf), SHIPPED)


def full_audit(spark, sf):
    # Sample, base day and ranking each pass over the silver table, so it is computed once.
    return A.run_audit(stored(classified(spark, sf)), FULL, prepared=True, narrow=True)


def _iso(column):
    return column.cast("string")


def row_view(frame):
    return frame.select(_iso(F.col("DATA")).alias("data"), F.col("CONTA").alias("conta"),
                        F.col("MOVIMENTO").cast("double").alias("movimento"), F.col("HISTORICO").alias("historico"))


SQL_ROW_VIEW = ("SELECT CAST(DATA AS VARCHAR) AS data, CONTA AS conta, CAST(MOVIMENTO AS DOUBLE) AS movimento, "
                "HISTORICO AS historico FROM ")

# --- sources and sinks -----------------------------------------------------------------------


@query("ledger_scan", f"""{LEDGER} SELECT CONTA, count(*) AS n, count(DATA) AS with_date,
  count(CONTRAPARTIDA) AS with_counterparty, count(DEBITO) AS debits, count(CREDITO) AS credits
  FROM ledger GROUP BY CONTA""")
def ledger_scan(spark, sf):
    return ledger(spark, sf).groupBy("CONTA").agg(
        F.count("*").alias("n"), F.count("DATA").alias("with_date"),
        F.count("CONTRAPARTIDA").alias("with_counterparty"), F.count("DEBITO").alias("debits"),
        F.count("CREDITO").alias("credits"))


def order_days(spark, sf):
    """Calendar of weekend days on which orders were placed, day-first text."""
    day = F.col("o_orderdate").cast("date")
    return (table(spark, sf, "orders").select(day.alias("day")).filter(F.weekday("day") >= 5)
            .select(date_text(F.col("day")).alias("DATA")).distinct())


SQL_ORDER_DAYS = """SELECT DISTINCT strftime(o_orderdate, '%d/%m/%Y') AS DATA FROM orders
  WHERE isodow(o_orderdate) >= 6"""


@query("calendar_scan", f"""{PREPARED}, calendar AS ({SQL_ORDER_DAYS})
  SELECT CAST(DATA AS VARCHAR) AS data, count(*) AS n FROM prepared
  WHERE strftime(DATA, '%d/%m/%Y') IN (SELECT DATA FROM calendar) GROUP BY 1""")
def calendar_scan(spark, sf):
    """Postings on days of a calendar table."""
    calendar = order_days(spark, sf).select(parse_date(F.col("DATA")).alias("DATA"))
    return (prepared(spark, sf).join(calendar, "DATA", "left_semi")
            .groupBy(_iso(F.col("DATA")).alias("data")).agg(F.count("*").alias("n")))


@query("calendar_union", f"""SELECT DATA AS data, count(*) AS listed FROM (
  {SQL_ORDER_DAYS} UNION ALL SELECT unnest(['25/12/1996', '01/05/1997', '07/09/1998', '15/01/1997']))
  GROUP BY 1""")
def calendar_union(spark, sf):
    """Weekend days and holidays in one calendar."""
    holidays = spark.createDataFrame([(h,) for h in HOLIDAYS], "DATA string")
    return (order_days(spark, sf).unionByName(holidays)
            .groupBy(F.col("DATA").alias("data")).agg(F.count("*").alias("listed")))


@query("silver_revalidate", f"""{LEDGER}, valid AS (
  SELECT *, {_sql_date('DATA')} AS d FROM ledger)
  SELECT strftime(d, '%d/%m/%Y') AS data, CONTA AS conta, CAST({_sql_money('MOVIMENTO')} AS DOUBLE) AS movimento,
    CAST({_sql_money('DEBITO')} AS DOUBLE) AS debito, CAST({_sql_money('CREDITO')} AS DOUBLE) AS credito
  FROM valid WHERE d IS NOT NULL""")
def silver_revalidate(spark, sf):
    frame = revalidate(ledger(spark, sf))
    return frame.select(F.col("DATA").alias("data"), F.col("CONTA").alias("conta"),
                        *[F.col(c).cast("double").alias(c.lower()) for c in ("MOVIMENTO", "DEBITO", "CREDITO")])


def out_path(spark, name):
    """A new folder for what a query writes, in the shared folder of the session."""
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


SQL_TEXT_ROWS = """SELECT CAST(DATA AS VARCHAR) AS data, CONTA AS conta, CONTRAPARTIDA AS contrapartida,
  CAST(MOVIMENTO AS VARCHAR) AS movimento, HISTORICO AS historico"""


def text_rows(frame):
    return frame.select(*[F.col(c).alias(c.lower()) for c in ("DATA", "CONTA", "CONTRAPARTIDA", "MOVIMENTO", "HISTORICO")])


@query("export_capped", f"""{SQL_SHIPPED} {SQL_TEXT_ROWS} FROM flagged WHERE FLAG = 'MANTER'""")
def export_capped(spark, sf):
    """The kept rows written in files of at most 10,000 rows, and read back whole."""
    path = out_path(spark, "sheets")
    export_sheets(A.export_projection(shipped_audit(spark, sf), BASE), path, 10_000)
    return text_rows(read_text_table(spark, path, encoding="UTF-8"))


@query("gold_csv", f"""{SQL_SHIPPED} {SQL_TEXT_ROWS} FROM flagged WHERE FLAG = 'MANTER'""")
def gold_csv(spark, sf):
    """The kept rows written as the audit result, and read back."""
    path = out_path(spark, "gold")
    write_gold_csv(A.export_projection(shipped_audit(spark, sf), BASE), path)
    return text_rows(read_text_table(spark, path, encoding="UTF-8"))


@query("ledger_read", f"{LEDGER} SELECT * FROM ledger")
def ledger_read(spark, sf):
    """The ledger written as Latin-1 text with odd headers, and read by the ledger reader."""
    path = out_path(spark, "bronze")
    odd = ledger(spark, sf).withColumnsRenamed({"CONTRAPARTIDA": "'CONTRAPARTIDA'", "CREDITO": "CREDITO "})
    odd.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return read_ledger(spark, path)


@query("calendar_read", f"""WITH calendar AS ({SQL_ORDER_DAYS}) SELECT DATA AS data FROM calendar""")
def calendar_read(spark, sf):
    """A calendar written as text beside another column, and read by the calendar reader."""
    path = out_path(spark, "calendar")
    order_days(spark, sf).withColumn("OBS", F.lit("x")).write.option("header", True).option("sep", ";").csv(path)
    return read_calendar(spark, path).select(F.col("DATA").alias("data"))


@query("silver_csv", f"""{PREPARED} SELECT strftime(DATA, '%d/%m/%Y') AS data, CONTA AS conta,
  CAST(MOVIMENTO AS DOUBLE) AS movimento, CAST(DEBITO AS DOUBLE) AS debito, CAST(CREDITO AS DOUBLE) AS credito,
  HISTORICO AS historico FROM prepared WHERE DATA IS NOT NULL""")
def silver_csv(spark, sf):
    """The typed ledger written as silver text and read back; rows without a date go."""
    path = out_path(spark, "silver")
    write_silver_csv(prepared(spark, sf), path)
    back = read_silver(spark, path)
    return back.select(F.col("DATA").alias("data"), F.col("CONTA").alias("conta"),
                       *[F.col(c).cast("double").alias(c.lower()) for c in ("MOVIMENTO", "DEBITO", "CREDITO")],
                       F.col("HISTORICO").alias("historico"))


@query("folder_inventory", """SELECT count(DISTINCT l_returnflag) AS files, TRUE AS sized FROM lineitem""")
def folder_inventory_query(spark, sf):
    """Files of a folder with one file for each return flag."""
    path = out_path(spark, "inventory")
    flags = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    flags.repartition(1).write.partitionBy("l_returnflag").parquet(path)
    found = folder_inventory(spark, path, "*.parquet")
    return found.select("files", (F.col("mean_mb") <= F.col("total_mb")).alias("sized"))


@query("silver_parquet", f"""{PREPARED} SELECT coalesce(strftime(DATA, '%Y-%m'), 'none') AS mes, count(*) AS n,
  CAST(coalesce(sum(MOVIMENTO), 0) AS DOUBLE) AS movimento FROM prepared GROUP BY 1""")
def silver_parquet(spark, sf):
    """The typed ledger written by month and summed from what was written."""
    path = out_path(spark, "silver")
    write_silver_parquet(prepared(spark, sf), path)
    return spark.read.parquet(path).groupBy(F.col("MES").cast("string").alias("mes")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("MOVIMENTO"), F.lit(0)).cast("double").alias("movimento"))


# The ledger in raw dress: every date layout, odd headers, amounts with a comma or a point, account tails.
RAW_DATES = ("dd/MM/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "d/M/yyyy", "dd.MM.yyyy", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy H:mm:ss")
RAW_SQL = f"""WITH raw AS (
  SELECT CAST(o_orderdate AS DATE) AS day, l_orderkey, l_linenumber, l_suppkey, o_custkey, l_extendedprice AS price, p_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
balance AS ({BALANCE_SQL}), accounts AS (
  SELECT CONTA AS k, arg_min(GRUPO, ORD) AS GRUPO, arg_min(CTP, ORD) AS CTP FROM balance GROUP BY 1)"""


def raw_ledger(spark, sf):
    order, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)")
    day = F.col("o_orderdate").cast("date")
    kind = order % (len(RAW_DATES) + 2)
    text = F.when(kind == len(RAW_DATES), F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"))
    for i, layout in enumerate(RAW_DATES):
        text = F.when(kind == i, F.date_format(day, layout)).otherwise(text)
    lines = spread(table(spark, sf, "lineitem"), (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"))
    rows = (lines.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")))
    return rows.select(
        text.alias("\ufeffDATA"),
        F.concat(F.lit("1."), F.lpad((F.col("o_custkey") % 50).cast("string"), 5, "0")).alias("CONTA"),
        F.concat(F.lit("1-"), F.lpad((F.col("l_suppkey") % 60).cast("string"), 5, "0")).alias("C/PARTIDA"),
        F.when(order % 2 == 0, price.cast("string")).otherwise(
            F.concat(F.regexp_replace(F.format_number(price, 2).substr(F.lit(1), F.length(F.format_number(price, 2)) - 3), ",", "."),
                     F.lit(","), F.substring_index(price.cast("string"), ".", -1))).alias("MOVIMENTO"),
        F.lit(None).cast("string").alias("DEBITO"), F.lit(None).cast("string").alias("CREDITO"),
        F.when(F.col("l_linenumber") != 3, F.col("p_name")).alias("HISTORICO"))


@query("silver_build", f"""{RAW_SQL} SELECT
  CASE WHEN l_orderkey % {len(RAW_DATES) + 2} < {len(RAW_DATES) + 1} THEN CAST(day AS VARCHAR) END AS data,
  concat('1', lpad(CAST(o_custkey % 50 AS VARCHAR), 5, '0')) AS conta,
  CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS movimento,
  CASE WHEN l_linenumber <> 3 THEN upper(p_name) END AS historico,
  a.GRUPO AS grupo_conta, a.CTP AS class_conta, c.GRUPO AS grupo_ctp, c.CTP AS class_ctp
FROM raw LEFT JOIN accounts a ON concat('1', lpad(CAST(o_custkey % 50 AS VARCHAR), 5, '0')) = a.k
  LEFT JOIN accounts c ON concat('1', lpad(CAST(l_suppkey % 60 AS VARCHAR), 5, '0')) = c.k""")
def silver_build(spark, sf):
    """Raw ledger and balance, written as text (the balance in files that follow its order), read and built to the silver table."""
    raw, accounts = out_path(spark, "raw"), out_path(spark, "balance")
    raw_ledger(spark, sf).write.option("header", True).option("sep", ";").csv(raw)
    (balance(spark, sf).repartitionByRange("ORD").sortWithinPartitions("ORD").drop("ORD").withColumnRenamed("GRUPO", "Grupo")
     .write.option("header", True).option("sep", ";").csv(accounts))
    frame = S.build_silver(read_ledger(spark, raw), read_balance(spark, accounts))
    return frame.select(_iso(F.col("DATA")).alias("data"), F.regexp_replace("CONTA", r"\.", "").alias("conta"),
                        F.col("MOVIMENTO").cast("double").alias("movimento"), F.col("HISTORICO").alias("historico"),
                        *[F.col(c).alias(c.lower()) for c in CLASSES])


@query("rule_catalog", f"""{SQL_SHIPPED}, hits AS (UNPIVOT (SELECT {', '.join(
    f'count({t}) AS {t}' for t in SHIPPED.active)} FROM flagged) ON COLUMNS(*) INTO NAME t VALUE h),
  catalog(TESTE, STATUS, CATEGORIA, DESCRICAO) AS (VALUES {', '.join(map(str, catalog_rows(SHIPPED)))})
  SELECT catalog.*, h AS hits FROM catalog LEFT JOIN hits ON t = TESTE""")
def rule_catalog(spark, sf):
    return A.rule_catalog(shipped_audit(spark, sf), SHIPPED)


# --- schema ----------------------------------------------------------------------------------

ODD_NAMES = ("ï»¿Data", "Conta.1", "LanÃ§amento", "Descrição da conta", "C-Partida", "'DEBITO'", "CREDITO ")


@query("clean_names", f"""{LEDGER} SELECT DATA AS "Data", CONTA AS "Conta_1", MOVIMENTO AS "Lancamento",
  HISTORICO AS "Descricao_da_conta", CONTRAPARTIDA AS "C_Partida", DEBITO, CREDITO FROM ledger""")
def clean_names_query(spark, sf):
    raw = ledger(spark, sf).select("DATA", "CONTA", "MOVIMENTO", "HISTORICO", "CONTRAPARTIDA", "DEBITO", "CREDITO")
    return clean_names(raw.toDF(*ODD_NAMES))


@query("gold_export", f"""{SQL_SHIPPED} SELECT CAST(DATA AS VARCHAR) AS DATA, CONTA, CONTRAPARTIDA,
  CAST(MOVIMENTO AS DOUBLE) AS MOVIMENTO, CAST(DEBITO AS DOUBLE) AS DEBITO, CAST(CREDITO AS DOUBLE) AS CREDITO,
  HISTORICO, {', '.join(SHIPPED.active)} FROM flagged WHERE FLAG = 'MANTER'""")
def gold_export(spark, sf):
    frame = A.export_projection(shipped_audit(spark, sf), BASE)
    return frame.withColumns({"DATA": _iso(F.col("DATA")), **{
        c: F.col(c).cast("double") for c in ("MOVIMENTO", "DEBITO", "CREDITO")}})


# --- cleaning --------------------------------------------------------------------------------


@query("parse_date", f"""{LEDGER} SELECT DATA AS raw, CAST({_sql_date('DATA')} AS VARCHAR) AS iso,
  coalesce(strftime({_sql_date('DATA')}, '%d/%m/%Y'), '') AS day_first, count(*) AS n FROM ledger GROUP BY 1, 2, 3""")
def parse_date_query(spark, sf):
    date = parse_date(F.col("DATA"))
    return (ledger(spark, sf).groupBy(F.col("DATA").alias("raw")).agg(F.count("*").alias("n"))
            .select("raw", _iso(parse_date(F.col("raw"))).alias("iso"),
                    date_text(parse_date(F.col("raw"))).alias("day_first"), "n"))


@query("excel_serial_date", """SELECT l_orderkey AS k, l_linenumber AS line,
  CAST(date_diff('day', DATE '1899-12-30', CAST(l_shipdate AS DATE)) AS VARCHAR) AS serial,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS iso FROM lineitem""")
def excel_serial(spark, sf):
    serial = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1899-12-30").cast("date")).cast("string")
    return (table(spark, sf, "lineitem").withColumn("serial", serial)
            .select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), "serial",
                    _iso(excel_serial_date(F.col("serial"))).alias("iso")))


@query("parse_money_br", f"""{LEDGER} SELECT MOVIMENTO AS raw, CAST({_sql_money('MOVIMENTO')} AS DOUBLE) AS amount,
  CAST({_sql_money('DEBITO')} AS DOUBLE) AS marked FROM ledger""")
def parse_money(spark, sf):
    return ledger(spark, sf).select(
        F.col("MOVIMENTO").alias("raw"), parse_money_br(F.col("MOVIMENTO")).cast("double").alias("amount"),
        parse_money_br(F.concat(F.lit("R$ "), F.col("DEBITO"))).cast("double").alias("marked"))


@query("parse_number_auto", """SELECT l_orderkey AS k, l_linenumber AS line,
  CASE l_partkey % 4 WHEN 3 THEN NULL
    ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount FROM lineitem""")
def number_auto(spark, sf):
    """Prices written four ways: Brazilian, English with thousands mark, plain, and a null word."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    english = F.format_number(price, 2)
    brazilian = F.concat(F.replace(F.regexp_extract(english, r"^(.*)\.", 1), F.lit(","), F.lit(".")), F.lit(","),
                         F.right(english, F.lit(2)))
    text = (F.when(F.col("l_partkey") % 4 == 0, brazilian).when(F.col("l_partkey") % 4 == 1, english)
            .when(F.col("l_partkey") % 4 == 2, price.cast("string")).otherwise("nan"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"),
        parse_number_auto(text).cast("double").alias("amount"))


@query("normalize_text", "SELECT doc_id, lower(trim(concat('  ', text, ' '))) AS t FROM documents")
def normalize(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", normalize_text(F.concat(F.lit("  "), "text", F.lit(" "))).alias("t"))


@query("fold_text", r"""SELECT doc_id, upper(trim(regexp_replace(regexp_replace(strip_accents(
    regexp_replace(text, '[/\-]+', ' ', 'g')), '[^\x00-\x7F]', '', 'g'), '[^A-Za-z0-9]+', ' ', 'g'))) AS t
  FROM documents""")
def fold(spark, sf):
    docs = spread(table(spark, sf, "documents"), ("doc_id", "text"))
    return docs.select("doc_id", fold_ascii_upper(F.col("text")).alias("t"))


@query("clean_account", f"""{LEDGER} SELECT replace(CONTA, '.', '') AS conta,
  replace(CONTRAPARTIDA, '-', '') AS contrapartida, CAST(CAST(replace(CONTA, '.', '') AS BIGINT) AS VARCHAR) AS digits,
  replace(CONTA, '.', '') AS from_float, count(*) AS n FROM ledger GROUP BY ALL""")
def accounts(spark, sf):
    key = clean_account(F.col("CONTA"))
    return ledger(spark, sf).groupBy(
        key.alias("conta"), clean_counterparty(F.col("CONTRAPARTIDA")).alias("contrapartida"),
        int_string(key).alias("digits"), clean_account(F.concat(key, F.lit(".0"))).alias("from_float"),
    ).agg(F.count("*").alias("n"))


@query("split_counterparty", f"""{LEDGER} SELECT concat(replace(CONTRAPARTIDA, '-', ''), 'F', substr(CONTA, 3)) AS raw,
  replace(CONTRAPARTIDA, '-', '') AS account,
  CASE WHEN CONTRAPARTIDA IS NOT NULL THEN concat('F', substr(CONTA, 3)) END AS label, count(*) AS n
  FROM ledger GROUP BY ALL""")
def split_counterparty(spark, sf):
    digits = F.coalesce(clean_counterparty(F.col("CONTRAPARTIDA")), F.lit(""))
    raw = F.concat(digits, F.lit("F"), F.substring("CONTA", 3, 5))
    return (ledger(spark, sf).groupBy(raw.alias("raw")).agg(F.count("*").alias("n"))
            .select("raw", counterparty_account(F.col("raw")).alias("account"),
                    counterparty_label(F.col("raw")).alias("label"), "n"))


@query("null_sentinels", f"""{LEDGER}, worded AS (SELECT coalesce(CONTRAPARTIDA, 'nan') AS c,
    coalesce(HISTORICO, 'None') AS h FROM ledger)
  SELECT CASE WHEN c <> 'nan' THEN c END AS contrapartida, count(*) AS n,
    count(*) FILTER (WHERE h = 'None') AS blanked FROM worded GROUP BY 1""")
def null_sentinels(spark, sf):
    worded = ledger(spark, sf).select(F.coalesce("CONTRAPARTIDA", F.lit("nan")).alias("c"),
                                      F.coalesce("HISTORICO", F.lit("None")).alias("h"))
    return worded.groupBy(null_words(F.col("c")).alias("contrapartida")).agg(
        F.count("*").alias("n"), F.count_if(null_words(F.col("h"), "") == "").alias("blanked"))


# --- lookups and quality ---------------------------------------------------------------------


@query("classify_account", f"""{CLASSIFIED} SELECT CONTA, GRUPO_CONTA, CLASS_CONTA, count(*) AS n
  FROM classified GROUP BY ALL""")
def classify_account(spark, sf):
    return (classified(spark, sf).groupBy("CONTA", "GRUPO_CONTA", "CLASS_CONTA")
            .agg(F.count("*").alias("n")))


@query("classify_counterparty", f"""{CLASSIFIED} SELECT CONTRAPARTIDA, GRUPO_CTP, CLASS_CTP, count(*) AS n
  FROM classified GROUP BY ALL""")
def classify_counterparty(spark, sf):
    return (classified(spark, sf).groupBy("CONTRAPARTIDA", "GRUPO_CTP", "CLASS_CTP")
            .agg(F.count("*").alias("n")))


@query("first_seen", f"""WITH balance AS ({BALANCE_SQL}) SELECT CONTA, arg_min(GRUPO, ORD) AS GRUPO,
  arg_min(CTP, ORD) AS CTP FROM balance GROUP BY CONTA""")
def first_seen_query(spark, sf):
    return first_seen(balance(spark, sf), ["CONTA"], "ORD")


@query("class_domain", f"""{CLASSIFIED} SELECT DISTINCT GRUPO_CTP AS value FROM classified
  ORDER BY 1 NULLS FIRST""")
def class_domain(spark, sf):
    return A.class_domain(classified(spark, sf).withColumnRenamed("GRUPO_CTP", "value"), "value")


def _sql_nulls(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, count(*) AS linhas_totais, count(*) - count({c}) AS nulos_qtd, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS nulos_pct FROM {source}" for c in columns)


@query("null_profile", f"{CLASSIFIED} "
       f"{_sql_nulls(BASE + CLASSES, 'classified')}")
def null_profile(spark, sf):
    return S.null_profile(classified(spark, sf))


@query("schema_profile", f"{CLASSIFIED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, '{t}' AS tipo, count({c}) AS preenchidos FROM classified" for c, t in (
        ("DATA", "date"), ("CONTA", "string"), ("CONTRAPARTIDA", "string"), ("MOVIMENTO", "decimal(18,2)"),
        ("DEBITO", "decimal(18,2)"), ("CREDITO", "decimal(18,2)"), ("HISTORICO", "string"),
        ("GRUPO_CONTA", "string"), ("CLASS_CONTA", "string"), ("GRUPO_CTP", "string"), ("CLASS_CTP", "string"))))
def schema_profile(spark, sf):
    return S.schema_profile(classified(spark, sf))


@query("load_quality", f"""{CLASSIFIED}
  SELECT count(*) AS linhas, count(DATA) AS datas_validas,
    count(*) FILTER (WHERE RAW IS NULL OR trim(RAW) = '') AS datas_vazias,
    count(*) FILTER (WHERE DATA IS NULL AND trim(RAW) <> '') AS datas_invalidas,
    count(DEBITO) AS debito_preenchido, count(*) - count(DEBITO) AS debito_nulo,
    count(CREDITO) AS credito_preenchido, count(*) - count(CREDITO) AS credito_nulo,
    count(*) FILTER (WHERE DEBITO IS NULL AND CREDITO IS NULL) AS sem_debito_credito,
    count(*) FILTER (WHERE MOVIMENTO = 0) AS movimento_zero,
    count(*) - count(GRUPO_CONTA) AS grupo_conta_vazio, count(*) - count(CLASS_CONTA) AS class_conta_vazio,
    count(*) - count(GRUPO_CTP) AS grupo_ctp_vazio, count(*) - count(CLASS_CTP) AS class_ctp_vazio
  FROM classified""")
def load_quality(spark, sf):
    raw = ledger(spark, sf).withColumn("RAW", F.col("DATA"))
    frame = A.prepare_ledger(S.classify(raw, stored(S.clean_balance(balance(spark, sf)))))
    return frame.agg(*S.load_quality(F.col("RAW"), F.col("DATA")))


@query("date_diagnosis", f"""{LEDGER} SELECT
  count(*) FILTER (WHERE regexp_matches(DATA, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$')) AS br,
  count(*) FILTER (WHERE regexp_matches(DATA, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')) AS iso,
  count(*) FILTER (WHERE DATA IS NULL OR DATA = '') AS empty,
  count(*) FILTER (WHERE DATA <> '' AND NOT regexp_matches(DATA, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$')
    AND NOT regexp_matches(DATA, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')) AS other FROM ledger""")
def date_diagnosis(spark, sf):
    date = F.col("DATA")
    br, iso = is_br_date(date), F.coalesce(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    empty = date.isNull() | (date == "")
    return ledger(spark, sf).agg(F.count_if(br).alias("br"), F.count_if(iso).alias("iso"),
                                 F.count_if(empty).alias("empty"),
                                 F.count_if(~empty & ~br & ~iso).alias("other"))


@query("debit_credit_fill", f"""{PREPARED} SELECT CONTA, count(DEBITO) AS debits, count(CREDITO) AS credits,
  count(*) FILTER (WHERE DEBITO IS NULL AND CREDITO IS NULL) AS neither,
  CAST(coalesce(sum(DEBITO), 0) AS DOUBLE) AS debit_total, CAST(coalesce(sum(CREDITO), 0) AS DOUBLE) AS credit_total
  FROM prepared GROUP BY CONTA""")
def debit_credit_fill(spark, sf):
    return prepared(spark, sf).groupBy("CONTA").agg(
        F.count("DEBITO").alias("debits"), F.count("CREDITO").alias("credits"),
        F.count_if(F.col("DEBITO").isNull() & F.col("CREDITO").isNull()).alias("neither"),
        F.coalesce(F.sum("DEBITO"), F.lit(0)).cast("double").alias("debit_total"),
        F.coalesce(F.sum("CREDITO"), F.lit(0)).cast("double").alias("credit_total"))


# --- audit tests, one at a time --------------------------------------------------------------

SINGLE_TESTS = {
    "null_date": "TESTE_1_1", "nonworking_day": "TESTE_1_2", "null_text": "TESTE_1_3",
    "kw_instruction": "TESTE_1_4", "kw_adjustment": "TESTE_1_5", "kw_reversal": "TESTE_1_6",
    "kw_misc": "TESTE_1_7", "watchlist_names": "TESTE_1_8", "repeat_result": "TESTE_2_1",
    "round_value": "TESTE_3_1", "large_revenue": "TESTE_6_1", "result_class": "TESTE_7_1",
    "asset_vs_revenue": "TESTE_7_2", "reversal_next_month": "TESTE_7_3", "credit_outside": "TESTE_7_4",
    "revenue_no_receivable": "TESTE_7_5", "fx_words": "TESTE_7_6", "negative_cash": "TESTE_7_7",
    "pep_names": "TESTE_7_9",
}


def _single(test):
    def job(spark, sf):
        result = A.run_audit(classified(spark, sf), FULL.replace(active=(test,)), prepared=True)
        return row_view(result.frame.filter(F.col("FLAG") == A.KEEP))
    return job


for _name, _test in SINGLE_TESTS.items():
    query(_name, f"{RANKED} {SQL_ROW_VIEW} ranked WHERE {SQL_RULES[_test]}")(_single(_test))


@query("listed_names", f"""WITH texts AS (SELECT DISTINCT HISTORICO AS text FROM ({PARTY_SQL})), names AS (SELECT DISTINCT name FROM ({WATCH_SQL}))
  SELECT text, name FROM texts JOIN names ON contains(lower(strip_accents(text)), lower(strip_accents(name)))""")
def listed_names(spark, sf):
    """Every name of a watch list made from the customers, in every text that tells a party."""
    return name_matches(party_texts(spark, sf), "HISTORICO", watch_list(spark, sf))


@query("listed_names_plain", f"""WITH texts AS (SELECT DISTINCT HISTORICO AS text FROM ({PARTY_SQL})), names AS (SELECT DISTINCT name FROM ({WATCH_SQL}))
  SELECT text, name FROM texts JOIN names ON contains(lower(text), lower(name))""")
def listed_names_plain(spark, sf):
    """The same where accents count."""
    return name_matches(party_texts(spark, sf), "HISTORICO", watch_list(spark, sf), fold=False)


@query("audit_by_name_lists", f"""{PREPARED}, names AS (SELECT DISTINCT lower(split_part(p_name, ' ', 2)) AS name FROM part)
  SELECT HISTORICO, count(*) AS n, CASE WHEN any_value(regexp_matches(HISTORICO, '(^|[^a-z])(' || short || ')([^a-z]|$)')
      OR regexp_matches(HISTORICO, long)) THEN 'SIM' END AS listed,
    CASE WHEN any_value(contains(HISTORICO, 'prado') OR contains(HISTORICO, 'odete brum')) THEN 'SIM' END AS exposed
  FROM prepared, (SELECT string_agg(name, '|') FILTER (WHERE length(name) <= 5) AS short,
    string_agg(name, '|') FILTER (WHERE length(name) > 5) AS long FROM names)
  GROUP BY HISTORICO""")
def audit_by_name_lists(spark, sf):
    """Tests 1_8 and 7_9 with their names as tables: the second words of the parts, and the exposed names."""
    words = table(spark, sf, "part").select(F.element_at(F.split("p_name", " "), 2).alias("word"))
    exposed = table(spark, sf, "region").select(F.explode(F.array(*[F.lit(n) for n in EXPOSED_NAMES])).alias("name"))
    cfg = FULL.replace(active=("TESTE_1_8", "TESTE_7_9"))
    result = A.run_audit(prepared(spark, sf), cfg, prepared=True, name_lists={"TESTE_1_8": (words, "word"), "TESTE_7_9": (exposed, "name")})
    return result.frame.groupBy("HISTORICO").agg(
        F.count("*").alias("n"), F.max("TESTE_1_8").alias("listed"), F.max("TESTE_7_9").alias("exposed"))


@query("listed_weekends", f"""{PREPARED} {SQL_ROW_VIEW} prepared
  WHERE (isodow(DATA) >= 6 AND year(DATA) = 1997)
    OR CAST(DATA AS VARCHAR) IN ('1996-12-25', '1997-05-01', '1998-09-07', '1997-01-15')""")
def listed_weekends(spark, sf):
    """Non-working days where weekends count in the listed years only."""
    cfg = FULL.replace(active=("TESTE_1_2",), weekend_years=(1997,))
    return row_view(A.run_audit(prepared(spark, sf), cfg, prepared=True).frame.filter(F.col("FLAG") == A.KEEP))


# The rule of Gauss for 1900 to 2099, another way to Easter than the library's.
SQL_FEASTS = """years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderdate IS NOT NULL),
parts AS (SELECT y, y % 19 AS a, (19 * (y % 19) + 24) % 30 AS d FROM years),
weeks AS (SELECT y, a, d, (2 * (y % 4) + 4 * (y % 7) + 6 * d + 5) % 7 AS e FROM parts),
easters AS (SELECT y, make_date(y, 3, 22) + CAST(d + e - CASE WHEN e = 6 AND (d = 29 OR (d = 28 AND a > 10)) THEN 7 ELSE 0 END
  AS INTEGER) AS easter FROM weeks),
feasts AS (
  SELECT y, make_date(y, m, d) AS day, FALSE AS movable FROM years,
    (VALUES (1, 1, 1), (4, 21, 1), (5, 1, 1), (9, 7, 1), (10, 12, 1980), (11, 2, 1), (11, 15, 1), (11, 20, 2024),
            (12, 25, 1)) t(m, d, since) WHERE y >= since
  UNION ALL SELECT y, easter + after, TRUE FROM easters, (VALUES (-48), (-47), (-2), (60)) t(after))"""


@query("feast_days", f"""WITH {SQL_FEASTS}
  SELECT y AS year, CAST(day AS VARCHAR) AS data, movable FROM feasts""")
def feast_days_query(spark, sf):
    """National holidays of the years in which orders were placed."""
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"))
    return feast_days(years, "y").select("year", _iso(F.col("day")).alias("data"), "movable")


@query("nonworking_feasts", f"""{PREPARED}, {SQL_FEASTS} {SQL_ROW_VIEW} prepared
  WHERE isodow(DATA) >= 6 OR DATA IN (SELECT day FROM feasts)""")
def nonworking_feasts(spark, sf):
    """Test 1_2 by weekends and the national holidays of every year, with no list of days."""
    cfg = FULL.replace(active=("TESTE_1_2",), holidays=(), national_feasts=True)
    return row_view(A.run_audit(prepared(spark, sf), cfg, prepared=True).frame.filter(F.col("FLAG") == A.KEEP))


def closing_days(spark, sf):
    """A calendar made from the orders: each 13th on which one was placed, day-first text, days repeated."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").filter(F.day(day) == 13).select(date_text(day).alias("DATA"))


@query("nonworking_calendar", f"""{PREPARED} {SQL_ROW_VIEW} prepared
  WHERE (isodow(DATA) >= 6 AND year(DATA) = 1997) OR (day(DATA) = 13 AND DATA IN (SELECT CAST(o_orderdate AS DATE) FROM orders))""")
def nonworking_calendar(spark, sf):
    """Test 1_2 with a calendar file besides the weekends of one year."""
    path = out_path(spark, "closing")
    closing_days(spark, sf).write.option("header", True).csv(path)
    cfg = FULL.replace(active=("TESTE_1_2",), holidays=(), weekend_years=(1997,))
    result = A.run_audit(prepared(spark, sf), cfg, prepared=True, calendar=read_calendar(spark, path))
    return row_view(result.frame.filter(F.col("FLAG") == A.KEEP))


@query("calendar_hits", f"""{PREPARED}, {SQL_FEASTS} SELECT 'TESTE_1_2' AS TESTE, count(*) FILTER (WHERE hit) AS hits,
  round(count(*) FILTER (WHERE hit) * 100.0 / count(*), 2) AS pct FROM (SELECT isodow(DATA) >= 6
    OR DATA IN (SELECT day FROM feasts)
    OR (day(DATA) = 13 AND DATA IN (SELECT CAST(o_orderdate AS DATE) FROM orders)) AS hit FROM prepared)""")
def calendar_hits(spark, sf):
    """Hits of test 1_2 by weekends, national holidays and a calendar, from one pass."""
    cfg = FULL.replace(active=("TESTE_1_2",), holidays=(), national_feasts=True)
    return A.count_hits(prepared(spark, sf), cfg, prepared=True, calendar=closing_days(spark, sf))


@query("triplicate_entry", f"""{RANKED} SELECT CAST(DATA AS VARCHAR) AS data, count(*) AS marks FROM ranked
  WHERE seq4 >= 3 GROUP BY 1""")
def triplicate_entry(spark, sf):
    return A.triplicate_counts(prepared(spark, sf)).select(_iso(F.col("DATA")).alias("data"), "marks")


@query("repeat_seq", f"""{RANKED} SELECT CONTA AS conta, count(*) FILTER (WHERE seq2 > 1) AS repeats
  FROM ranked GROUP BY 1""")
def repeat_seq(spark, sf):
    return A.repeat_counts(prepared(spark, sf)).select(F.col("CONTA").alias("conta"), "repeats")


@query("audit_sample", f"{PREPARED} {SQL_ROW_VIEW} (SELECT * FROM prepared ORDER BY {_sql_hash(BASE)} LIMIT 25)")
def audit_sample_query(spark, sf):
    return row_view(audit_sample(prepared(spark, sf), FULL.sample_size, FULL.sample_seed, BASE))


# --- whole audits ----------------------------------------------------------------------------

SQL_SUMMARY = """SELECT f AS "FLAG", count(*) FILTER (WHERE FLAG = f) AS n,
  round(count(*) FILTER (WHERE FLAG = f) * 100.0 / count(*), 2) AS pct
  FROM flagged, (SELECT unnest(['MANTER', 'RETIRAR']) AS f) GROUP BY f"""


@query("flag_summary", f"{SQL_SHIPPED} {SQL_SUMMARY}")
def flag_summary(spark, sf):
    """Shipped configuration end to end."""
    return A.flag_summary(shipped_audit(spark, sf).frame)


@query("rule_hits", f"""{SQL_FULL} SELECT t AS TESTE, h AS hits, round(h * 100.0 / total, 2) AS pct FROM (
  UNPIVOT (SELECT count(*) AS total, {', '.join(f'count({t}) AS {t}' for t in TEST_NAMES)} FROM flagged)
  ON {', '.join(TEST_NAMES)} INTO NAME t VALUE h)""")
def rule_hits(spark, sf):
    """All 21 tests, hits of each."""
    return A.count_hits(classified(spark, sf), FULL, prepared=True)


@query("run_log", f"""{SQL_FULL} SELECT figure, CAST(value AS BIGINT) AS value FROM (
  UNPIVOT (SELECT count(*) AS linhas, count(*) FILTER (WHERE FLAG = 'MANTER') AS mantidas,
    count(*) FILTER (WHERE FLAG = 'RETIRAR') AS retiradas, count(DATA) AS datas_validas,
    count(*) FILTER (WHERE DATA IS NULL) AS datas_vazias, {', '.join(f'count({t}) AS {t}' for t in TEST_NAMES)} FROM flagged)
  ON COLUMNS(*) INTO NAME figure VALUE value)""")
def run_log(spark, sf):
    """Figures of a run with all tests, taken while its result is written."""
    result, log = full_audit(spark, sf), out_path(spark, "run-log")
    write_gold_logged(result, BASE + CLASSES, out_path(spark, "gold"), log, "all-tests")
    return read_run_log(spark, log).where("run_id = 'all-tests'").select("figure", "value")


@query("audit_flag", f"""{SQL_FULL} SELECT CONTA, count(*) FILTER (WHERE FLAG = 'MANTER') AS kept,
  count(*) FILTER (WHERE FLAG = 'RETIRAR') AS dropped FROM flagged GROUP BY CONTA""")
def audit_flag(spark, sf):
    """All 21 tests, kept and dropped rows per account."""
    return full_audit(spark, sf).frame.groupBy("CONTA").agg(
        F.count_if(F.col("FLAG") == A.KEEP).alias("kept"), F.count_if(F.col("FLAG") == A.DROP).alias("dropped"))


@query("audit_rows", f"""{SQL_FULL} SELECT CAST(DATA AS VARCHAR) AS "DATA", CONTA, CONTRAPARTIDA,
  CAST(MOVIMENTO AS DOUBLE) AS MOVIMENTO, HISTORICO, GRUPO_CONTA, CLASS_CTP, {', '.join(TEST_NAMES)}, FLAG
  FROM flagged""")
def audit_rows(spark, sf):
    """All 21 tests, every ledger row with its marks."""
    frame = full_audit(spark, sf).frame
    return frame.select(_iso(F.col("DATA")).alias("DATA"), "CONTA", "CONTRAPARTIDA",
                        F.col("MOVIMENTO").cast("double").alias("MOVIMENTO"), "HISTORICO", "GRUPO_CONTA",
                        "CLASS_CTP", *TEST_NAMES, "FLAG")
