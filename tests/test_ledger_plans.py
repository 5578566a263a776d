"""Code of the ledger plans stays small enough to be compiled, and small lookups don't move the ledger."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from tallybank.functions.dates import date_text, parse_date
from tallybank.operators import audit as A
from tallybank.operators import silver as S
from tallybank.plans import ledger_queries as L
from tallybank.plans.registry import QUERIES
from tallybank.sources.staging import stored


def plan_text(frame, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


def test_code_that_parses_worked_out_dates_is_compiled(spark, small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("silver_revalidate", "nonworking_day", "listed_weekends"):
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan_text(QUERIES[name](spark, small), "codegen"))]
            assert sizes and max(sizes) < 8000, (name, sizes)  # the JVM never compiles longer methods
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_dates_that_are_cast_are_those_a_formatter_reads(spark):
    texts = ["1/2/2024", " 31/12/1999 ", "31/02/2024", "29/02/2024", "00/01/2024", "1/13/2024", "01/01/0000", "1/2/24", "2024-1-2", "2024-02-30", "2024-01-02\n",
             "1/2/2024\n", "2024-01-02x", "2024-01-02 23:59:59", "2024-01-02 24:00:00", "2024-01-02T00:00:00", "", None, "Conta:", "+2024-01-02", "1//2024"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    text = F.trim("t")
    told = F.coalesce(*[F.when(text.rlike(shape), F.try_to_date(text, layout)) for shape, layout in (
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
        (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"))])
    odd = frame.where(~parse_date(F.col("t")).eqNullSafe(told))
    assert odd.collect() == []
    day = F.col("d")
    days = spark.sql("SELECT explode(array(DATE'0000-01-01', DATE'0033-04-03', DATE'2024-02-29', DATE'9999-12-31', DATE'+12024-02-03', NULL)) AS d")
    assert days.where(~date_text(day).eqNullSafe(F.coalesce(F.date_format(day, "dd/MM/yyyy"), F.lit("")))).collect() == []


def test_small_lookups_are_broadcast_without_moving_the_ledger(spark, small):
    plan = plan_text(L.classified(spark, small), "formatted")
    assert "LeftOuter" in plan and "SortMergeJoin LeftOuter" not in plan
    ledger = spark.createDataFrame([("1", "1", "x")], "CONTA string, CONTRAPARTIDA string, HISTORICO string").withColumn("DATA", F.lit("1/1/2024"))
    accounts = spark.createDataFrame([("1", "g", "c", 1)], "CONTA string, GRUPO string, CTP string, ORD int")
    assert "SortMergeJoin" not in plan_text(S.build_silver(ledger, accounts), "formatted")


def test_stored_rows_are_read_by_column(spark):
    frame = stored(spark.range(10).selectExpr("id", "CAST(id AS STRING) AS t"))
    assert "ReadSchema: struct<id:bigint>" in plan_text(frame.select("id"), "formatted")
    assert frame.count() == 10
    assert A.DROP  # the audits of all tests read their ledger this way
