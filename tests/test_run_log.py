"""Figures that are taken while the audit's result is written."""

import pytest

from tallybank.config import AuditConfig
from tallybank.operators import audit as A
from tallybank.plans import ledger_queries as L
from tallybank.sources.run_log import read_run_log, write_gold_logged

CFG = AuditConfig(active=("TESTE_1_1", "TESTE_1_3", "TESTE_3_1", "TESTE_7_1"))


@pytest.fixture(scope="module")
def ledger(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ledger") / "t")
    L.prepared(spark, small).write.parquet(path)
    return spark.read.parquet(path)


def figures_of(spark, log, run):
    return {r["figure"]: r["value"] for r in read_run_log(spark, log).where(f"run_id = '{run}'").collect()}


def test_figures_equal_the_summaries_and_runs_are_kept(spark, ledger, tmp_path):
    log = str(tmp_path / "log")
    audit = A.run_audit(ledger, CFG, prepared=True)
    for run in ("a", "b"):
        write_gold_logged(audit, ledger.columns, str(tmp_path / run), log, run)
    got = figures_of(spark, log, "b")
    assert got == figures_of(spark, log, "a") and read_run_log(spark, log).count() == 2 * len(got)
    assert {t: got[t] for t in audit.tests} == {r["TESTE"]: r["hits"] for r in A.rule_hits(audit).collect()}
    flags = {r["FLAG"]: r["n"] for r in A.flag_summary(audit.frame).collect()}
    assert (got["mantidas"], got["retiradas"]) == (flags["MANTER"], flags["RETIRAR"])
    assert got["linhas"] == got["datas_validas"] + got["datas_vazias"] == ledger.count()
    assert spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "b")).count() == got["mantidas"]
    # The account's class is absent here, so its test is skipped.
    assert got["TESTE_7_1"] is None and list(audit.skipped) == ["TESTE_7_1"]


def test_one_job_reads_the_ledger(spark, ledger, tmp_path):
    context = spark.sparkContext
    context.setJobGroup("logged", "gold and log")
    try:
        write_gold_logged(A.run_audit(ledger, CFG, prepared=True), ledger.columns, str(tmp_path / "g"), str(tmp_path / "l"), "a")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # The other job writes the figures.
    assert len(context.statusTracker().getJobIdsForGroup("logged")) == 2


@pytest.mark.parametrize("known", [True, False])
def test_a_ledger_without_rows_has_zeros(spark, ledger, tmp_path, known):
    # The optimizer sees that the first is empty; that no row passes the other's filter shows when it runs.
    empty = ledger.where("1 = 0") if known else ledger.where("HISTORICO = 'none of them'")
    write_gold_logged(A.run_audit(empty, CFG, prepared=True), ledger.columns, str(tmp_path / "g"), str(tmp_path / "l"), "a")
    got = figures_of(spark, str(tmp_path / "l"), "a")
    assert got["linhas"] == got["TESTE_1_3"] == 0 and got["TESTE_7_1"] is None


def test_a_failed_write_leaves_no_figures(spark, ledger, tmp_path):
    broken = ledger.selectExpr("*", "CAST(raise_error('no') AS STRING) AS bad")
    with pytest.raises(Exception, match="no"):
        write_gold_logged(A.run_audit(broken, CFG, prepared=True), broken.columns, str(tmp_path / "g"), str(tmp_path / "l"), "a")
    assert not (tmp_path / "l").exists()
