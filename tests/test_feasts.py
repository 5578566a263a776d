"""Holidays of any year, and calendars that an audit is given."""

import datetime as dt

import pytest
from dateutil.easter import easter as known_easter
from pyspark.sql import functions as F

from tallybank.config import AuditConfig
from tallybank.functions import feasts as H
from tallybank.operators import audit as A


def test_easter_of_eight_centuries(spark):
    got = spark.range(1583, 2400).select("id", H.easter(F.col("id")).alias("day")).collect()
    assert len(got) == 817 and all(r["day"] == known_easter(r["id"]) for r in got)


def test_feast_days_of_years(spark):
    years = spark.createDataFrame([(1979,), (1980,), (2024,), (2024,), (None,)], "y int")
    got = {(r["year"], r["day"]) for r in H.feast_days(years, "y").collect()}
    assert {y for y, _ in got} == {1979, 1980, 2024}
    assert len([1 for y, _ in got if y == 1979]) == 11 and len([1 for y, _ in got if y == 2024]) == 13
    assert {(2024, dt.date(2024, 2, 12)), (2024, dt.date(2024, 2, 13)), (2024, dt.date(2024, 3, 29)), (2024, dt.date(2024, 5, 30))} <= got
    assert (1979, dt.date(1979, 10, 12)) not in got and (1980, dt.date(1980, 10, 12)) in got


def test_feasts_of_all_years_are_listed(spark):
    days = A.listed_days(spark.range(1), AuditConfig(national_feasts=True), None)
    got = days.agg(F.count("*"), F.min("__day"), F.max("__day"), F.countDistinct(F.year("__day"))).first()
    # Feasts that meet on one day (Good Friday on 21 April, for one) are one day.
    assert got[1:] == (dt.date(1, 1, 1), dt.date(9999, 12, 25), 9999) and 100_000 < got[0] < 130_000
    assert A.listed_days(spark.range(1), AuditConfig(), None) is None


ROWS = [(1, dt.date(1997, 3, 28)), (2, dt.date(1997, 3, 27)), (3, dt.date(1997, 3, 29)), (4, None), (5, dt.date(1997, 4, 2))]


def hit(audit):
    return {r["n"] for r in audit.frame.where("FLAG = 'MANTER'").collect()}


@pytest.mark.parametrize(("feasts", "days", "expected"), [
    (False, None, {3}), (True, None, {1, 3}), (True, [], {1, 3}),
    (False, ["02/04/1997", "1997-04-02", "Conta:", None, "27/03/1997"], {2, 3, 5})])
def test_audit_by_feasts_and_calendar(spark, feasts, days, expected):
    ledger = spark.createDataFrame(ROWS, "n int, DATA date")
    calendar = None if days is None else spark.createDataFrame([(d, 0) for d in days], "DATA string, n int")
    cfg = AuditConfig(active=("TESTE_1_2",), holidays=(), national_feasts=feasts)
    assert hit(A.run_audit(ledger, cfg, prepared=True, calendar=calendar)) == expected
    assert [r["hits"] for r in A.count_hits(ledger, cfg, prepared=True, calendar=calendar).collect()] == [len(expected)]
    assert AuditConfig.from_json(cfg.to_json()) == cfg


def test_calendar_moves_no_ledger_row(spark):
    ledger = spark.createDataFrame(ROWS, "n int, DATA date")
    calendar = spark.createDataFrame([("02/04/1997",)], "DATA string")
    result = A.run_audit(ledger, AuditConfig(active=("TESTE_1_2",)), prepared=True, calendar=calendar)
    assert result.frame.columns == ["n", "DATA", "TESTE_1_2", "FLAG"]
    plan = result.frame._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
