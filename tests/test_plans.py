"""Physical plans: shuffles, scans and Python calls stay as few as intended."""

import contextlib
import io
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybank.config import TEST_NAMES, AuditConfig
from tallybank.operators import audit as A
from tallybank.operators import pages as P
from tallybank.operators import silver as S
from tallybank.operators.questions import widen_options
from tallybank.plans import adapters as D
from tallybank.plans import ledger_queries as L


def plan_of(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def silver(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "t")
    L.classified(spark, small).write.parquet(path)
    return spark.read.parquet(path)


def test_shipped_audit_neither_shuffles_nor_reads_unused_columns(silver):
    audit = A.run_audit(silver, AuditConfig(watch_names=("Lima",)), prepared=True)
    assert "Exchange" not in plan_of(audit.frame)
    summary = plan_of(A.flag_summary(audit.frame))
    assert re.findall(r"ReadSchema: (.*)", summary) == ["struct<HISTORICO:string>"]
    # One single-row exchange of partial counts.
    assert len(re.findall(r"\(\d+\) Exchange\n", summary)) == 1


def test_full_audit_shuffles_the_ledger_three_times(silver):
    plan = plan_of(A.run_audit(silver, L.FULL, prepared=True).frame)
    # Three for the two rankings; the fourth brings together the distinct keys of the base day.
    assert len(re.findall(r"\(\d+\) Exchange\n", plan)) == 4
    assert len(re.findall(r"Scan parquet", plan.split("\n\n")[0])) == 2  # the ledger and the base-day keys
    assert len(re.findall(r"\(\d+\) BroadcastExchange\n", plan)) == 1


def test_narrow_audit_shuffles_candidate_rows_only(silver):
    frame = A.run_audit(silver, L.FULL, prepared=True, narrow=True).frame
    plan = plan_of(frame)
    # Whole numbers of all rows are shuffled once; bitmaps and keys of the base day are small.
    exchanged = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan)
    narrow = [e for e in exchanged if "HISTORICO" not in e]
    wide = [e for e in exchanged if "HISTORICO" in e]
    assert len(wide) == 3 and all(re.match(r"(kind|bucket|__conta|_groupingexpression)#", e) for e in narrow)
    assert plan.split("\n\n")[0].count("Window") == 4
    every = A.run_audit(silver, L.FULL, prepared=True).frame
    assert Counter(map(tuple, frame.collect())) == Counter(map(tuple, every.collect()))


def test_counting_hits_takes_one_pass_and_whole_numbers(silver):
    plan = plan_of(A.count_hits(silver, L.FULL, prepared=True))
    assert "Window" not in plan and "SortAggregate" not in plan
    assert len(re.findall(r"Scan parquet", plan.split("\n\n")[0])) == 1
    # One shuffle of pre-aggregated groups, and one of partial sums.
    assert len(re.findall(r"\(\d+\) Exchange\n", plan)) == 2


def test_planning_starts_no_job(spark, small):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "none")
    try:
        A.run_audit(L.classified(spark, small), L.FULL.replace(active=[t for t in TEST_NAMES if t != "TESTE_5_1"]), True)
        A.count_hits(L.classified(spark, small), L.FULL, prepared=True)
        assert not tracker.getJobIdsForGroup("planning") or all(
            tracker.getJobInfo(j) is None or tracker.getJobInfo(j).status != "RUNNING"
            for j in tracker.getJobIdsForGroup("planning"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hits_counted_and_marked_agree(spark, silver):
    audit = A.run_audit(silver, L.FULL, prepared=True)
    assert A.rule_hits(audit).collect() == A.count_hits(silver, L.FULL, prepared=True).collect()


def test_base_day_filter_reaches_the_scan(silver):
    keys = silver.filter(F.col("DATA") == F.lit("1996-12-31").cast("date")).select("CONTA", "MOVIMENTO")
    plan = plan_of(keys)
    assert "EqualTo(DATA,1996-12-31)" in plan and "HISTORICO" not in plan


def test_lookup_is_broadcast_only_while_it_is_small(spark, small):
    ledger, accounts = D.ledger(spark, small), S.clean_balance(D.balance(spark, small))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = plan_of(S.classify(ledger, accounts).select("GRUPO_CONTA", "GRUPO_CTP"))
        assert beyond.count("SortMergeJoin LeftOuter") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_links_and_answer_keys_never_leave_their_row(spark):
    pages = spark.createDataFrame([(1, "<a href=x>js-question-item</a>")], "page_id long, html string")
    for frame in (P.mock_links(pages), P.extract_answer_key(P.read_pages(pages)), P.page_anchors(pages)):
        plan = plan_of(frame)
        assert "Exchange" not in plan and len(re.findall(r"\(\d+\) ArrowEvalPython\n", plan)) == 1


def test_each_page_is_parsed_once_and_questions_need_no_shuffle(spark):
    pages = spark.createDataFrame([(1, "<p>js-question-item</p>")], "page_id long, html string")
    plan = plan_of(widen_options(P.extract_questions(P.read_pages(pages))))
    assert len(re.findall(r"\(\d+\) ArrowEvalPython\n", plan)) == 1
    assert "Exchange" not in plan
