"""Audit tests, ranking under skew, sampling, lookups and exports on small literal ledgers."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybank.config import TEST_NAMES, AuditConfig, ConfigError, catalog_rows, config_markdown
from tallybank.operators import audit as A
from tallybank.operators import silver as S
from tallybank.operators.ranking import RepeatMark, mark_repeats
from tallybank.operators.rules import RULES
from tallybank.operators.sampling import audit_sample, mark_sample, sample_cut

SCHEMA = ("DATA date, CONTA string, CONTRAPARTIDA string, MOVIMENTO decimal(18,2), DEBITO decimal(18,2), "
          "CREDITO decimal(18,2), HISTORICO string, GRUPO_CONTA string, CLASS_CONTA string, GRUPO_CTP string, "
          "CLASS_CTP string")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def money(x):
    return None if x is None else Decimal(x).quantize(Decimal("0.01"))


def rows(spark, *given):
    data = []
    for g in given:
        g = {k: money(v) if k in ("MOVIMENTO", "DEBITO", "CREDITO") else v for k, v in g.items()}
        data.append(tuple(g.get(n) for n in NAMES))
    return spark.createDataFrame(data, SCHEMA)


def hits(spark, test, given, **changes):
    cfg = AuditConfig(active=(test,), **changes)
    frame = A.run_audit(rows(spark, *given).coalesce(1), cfg, prepared=True).frame
    return [r[test] == "SIM" for r in frame.collect()]


def test_credit_outside(spark):
    given = [{"CREDITO": 5}, {"DEBITO": 5, "GRUPO_CONTA": "imobilizado"}, {"CREDITO": 5, "GRUPO_CONTA": "fornecedores"},
             {"CREDITO": 5, "GRUPO_CONTA": "outro"}, {"CREDITO": 0, "GRUPO_CONTA": "outro"}]
    assert hits(spark, "TESTE_7_4", given) == [False, True, False, True, False]


def test_revenue_without_receivable(spark):
    revenue = {"GRUPO_CONTA": "receitas financeiras"}
    given = [{**revenue, "CREDITO": 5}, {**revenue, "CREDITO": 5, "GRUPO_CTP": " Contas a Receber "},
             {**revenue, "CREDITO": 0}, revenue, {"CREDITO": 5, "GRUPO_CONTA": "outro"}]
    assert hits(spark, "TESTE_7_5", given) == [True, False, False, False, False]


def test_large_revenue_uses_both_names(spark):
    given = [{"MOVIMENTO": 30001, "GRUPO_CONTA": g} for g in ("receita líquida", "receitas financeiras", "outro")]
    assert hits(spark, "TESTE_6_1", given + [{"MOVIMENTO": 30000, "GRUPO_CONTA": "receita líquida"}]) == [
        True, True, False, False]


def test_fx_words_need_a_known_group(spark):
    given = [{"HISTORICO": "variação cambial", "GRUPO_CONTA": g} for g in ("x", "emprestimos", None)]
    assert hits(spark, "TESTE_7_6", given) == [True, False, False]


def test_negative_cash(spark):
    cash = {"GRUPO_CONTA": "caixa e equivalentes de caixa", "CLASS_CTP": "resultado"}
    given = [{**cash, "MOVIMENTO": -1, "DATA": dt.date(2025, m, 5)} for m in (1, 2, 3)]
    assert hits(spark, "TESTE_7_7", given + [{**cash, "MOVIMENTO": -1}]) == [True, True, False, False]


def test_blank_exposed_name(spark):
    given = [{"HISTORICO": "a"}, {}]
    assert hits(spark, "TESTE_7_9", given, exposed_names=("",)) == [False, False]
    assert hits(spark, "TESTE_7_9", given, exposed_names=("",), drop_blank_names=False) == [True, False]


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_reversal(spark, broadcast):
    base, follow = dt.date(2025, 12, 31), dt.date(2026, 1, 31)
    given = [{"DATA": base, "CONTA": "1", "MOVIMENTO": 7}] * 2 + [
        {"DATA": follow, "CONTA": "1", "MOVIMENTO": 7}, {"DATA": dt.date(2026, 2, 1), "CONTA": "1", "MOVIMENTO": 7},
        {"DATA": follow, "CONTA": "2", "MOVIMENTO": 7}, {"DATA": follow, "MOVIMENTO": 7},
        {"DATA": base, "MOVIMENTO": 7}, {"CONTA": "1", "MOVIMENTO": 7}]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        cfg = AuditConfig(active=("TESTE_7_3",))
        frame = A.run_audit(rows(spark, *given), cfg, prepared=True).frame
        found = [(r["DATA"], r["CONTA"]) for r in frame.collect() if r["TESTE_7_3"]]
        assert found == [(follow, "1")] and frame.count() == len(given)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_triplicates(spark):
    for size, marks in ((2, 0), (3, 1), (5, 3)):
        given = [{"MOVIMENTO": 5, "DATA": dt.date(2025, 1, 2)}] * size
        assert sum(hits(spark, "TESTE_4_1", given)) == marks


def test_flag(spark):
    frame = rows(spark, {"HISTORICO": "ajuste"}, {"HISTORICO": "nada"})
    flags = lambda cfg: [r["FLAG"] for r in A.run_audit(frame, cfg).frame.orderBy("HISTORICO").collect()]
    assert flags(AuditConfig()) == ["MANTER", "RETIRAR"]
    assert flags(AuditConfig(active=())) == ["MANTER", "MANTER"]


def test_missing_column_skips_the_test_and_reports_it(spark):
    frame = rows(spark, {"HISTORICO": "ajuste"}).drop("CLASS_CTP", "MOVIMENTO")
    result = A.run_audit(frame, AuditConfig(active=TEST_NAMES), prepared=True)
    assert result.skipped["TESTE_7_3"] == ["MOVIMENTO"]
    assert result.skipped["TESTE_2_1"] == ["MOVIMENTO", "CLASS_CTP"]
    assert "TESTE_7_3" not in result.frame.columns and "FLAG" in result.frame.columns
    assert not result.frame.isEmpty()


def random_ledger(spark, partitions, copies=400, others=800):
    """A third of the rows are copies of one row, another part shares its keys."""
    rng = random.Random(7)
    hot = {"CONTA": "1", "MOVIMENTO": 0, "DATA": dt.date(2025, 1, 1), "CLASS_CTP": "resultado"}
    given = [hot] * copies + [
        {"CONTA": rng.choice("12"), "MOVIMENTO": rng.choice((0, 10)), "DATA": dt.date(2025, 1, rng.randint(1, 3)),
         "HISTORICO": rng.choice((None, "a", "b")), "CLASS_CTP": rng.choice(("resultado", "pl")),
         "CONTRAPARTIDA": rng.choice(("x", "y", None))} for _ in range(others)]
    rng.shuffle(given)
    return rows(spark, *given).repartition(partitions)


def brute_marks(frame, keys, order, nth):
    groups = {}
    for r in frame.collect():
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    marked = Counter()
    low = lambda v: (v is not None, v if v is not None else 0)
    for group in groups.values():
        group.sort(key=lambda r: [low(r[c]) for c in order])
        marked.update(tuple(r) for r in group[nth - 1:])
    return marked


@pytest.mark.parametrize("partitions", [1, 16])
def test_marks_match_brute_force_under_skew(spark, partitions):
    frame = random_ledger(spark, partitions)
    frame = A.with_row_order(frame, AuditConfig(), frame.columns)
    for keys, nth in ((A.REPEAT_KEYS, 2), (A.TRIPLICATE_KEYS, 3)):
        order = (A.ORDER, A.ROW_HASH)
        marked = mark_repeats(frame, [RepeatMark(keys, order, nth, "m")])
        assert marked.count() == frame.count()
        got = Counter(tuple(r)[:-1] for r in marked.collect() if r["m"])
        assert got == brute_marks(frame, keys, order, nth)


def test_whole_audit_is_the_same_for_any_partitioning_and_rule_order(spark):
    cfg = AuditConfig(active=tuple(reversed(TEST_NAMES)), base_day="2025-01-01", follow_month="2025-01",
                      sample_size=40)
    results = []
    for partitions in (1, 4, 16):
        frame = A.run_audit(random_ledger(spark, partitions), cfg, prepared=True).frame
        results.append(Counter(map(tuple, frame.collect())))
    assert results[0] == results[1] == results[2]


def test_counts_without_ranking_agree_with_marks(spark):
    frame = random_ledger(spark, 4)
    result = A.run_audit(frame, AuditConfig(active=("TESTE_4_1",)), prepared=True).frame
    marks = result.filter(F.col("TESTE_4_1") == "SIM").count()
    assert marks == A.triplicate_counts(frame).agg(F.sum("marks")).head()[0]
    cfg = AuditConfig(active=("TESTE_1_3", "TESTE_2_1", "TESTE_4_1"))
    expected = sorted(map(tuple, A.rule_hits(A.run_audit(frame, cfg, prepared=True)).collect()))
    assert sorted(map(tuple, A.count_hits(frame, cfg, prepared=True).collect())) == expected


@pytest.mark.parametrize("size", [1, 450, 1200])
def test_sample_size_is_exact_even_among_copies(spark, size):
    frame = random_ledger(spark, 4)
    columns = frame.columns
    marked = mark_sample(frame, "m", sample_cut(frame, size, 42, columns), 42, columns)
    got = Counter(tuple(r)[:-1] for r in marked.collect() if r["m"])
    assert sum(got.values()) == min(size, 1200)
    assert got == Counter(map(tuple, audit_sample(frame, size, 42).collect()))


def test_summaries_add_up(spark):
    audit = A.run_audit(random_ledger(spark, 4), AuditConfig(active=("TESTE_1_3", "TESTE_3_1")), prepared=True)
    summary = {r["FLAG"]: r["n"] for r in A.flag_summary(audit.frame).collect()}
    assert sum(summary.values()) == 1200
    empty = A.run_audit(rows(spark, {}).limit(0), AuditConfig(), prepared=True)
    assert [(r["n"], r["pct"]) for r in A.flag_summary(empty.frame).collect()] == [(0, None), (0, None)]
    assert {r["TESTE"]: r["hits"] for r in A.rule_hits(audit).collect()}["TESTE_3_1"] > 0


def test_export_keeps_order_and_drops_helpers(spark):
    audit = A.run_audit(rows(spark, {"HISTORICO": "ajuste"}).withColumn("LINHA_SEQ", F.lit(1)), AuditConfig(),
                        prepared=True)
    out = A.export_projection(audit, ["HISTORICO", "CONTA"])
    assert out.columns[:2] == ["HISTORICO", "CONTA"]
    assert "FLAG" not in out.columns and "LINHA_SEQ" not in out.columns and out.count() == 1


def test_numeric_amounts_are_not_read_as_text(spark):
    frame = spark.createDataFrame([(1234.56, "1.234,56")], "MOVIMENTO double, DEBITO string")
    row = A.prepare_ledger(frame).head()
    assert row["MOVIMENTO"] == row["DEBITO"] == Decimal("1234.56")


def test_lookup_takes_the_first_row_and_keeps_all_ledger_rows(spark):
    ledger = spark.createDataFrame([("1.01", "2-02"), ("1.01", None), ("9.99", "101")] * 20,
                                   "CONTA string, CONTRAPARTIDA string")
    balance = spark.createDataFrame([(2, "1.01", "late", "L"), (1, "101", "first", "F"), (3, "202", "other", "O")],
                                    "ORD int, CONTA string, GRUPO string, CTP string")
    out = S.classify(ledger, S.clean_balance(balance))
    assert out.count() == 60
    got = {(r["CONTA"], r["CONTRAPARTIDA"]): (r["GRUPO_CONTA"], r["CLASS_CTP"]) for r in out.collect()}
    assert got == {("1.01", "2-02"): ("first", "O"), ("1.01", None): ("first", None), ("9.99", "101"): (None, "F")}


def test_silver_build_keeps_nulls(spark):
    ledger = spark.createDataFrame([("45658", "12345.0", None, "1,5", None, None, None)],
                                   "DATA string, CONTA string, CONTRAPARTIDA string, MOVIMENTO string, "
                                   "DEBITO string, CREDITO string, HISTORICO string")
    row = S.clean_ledger(ledger).head()
    assert (row["DATA"], row["CONTA"], row["MOVIMENTO"], row["HISTORICO"]) == (
        dt.date(2025, 1, 1), "12345", Decimal("1.50"), None)


def test_row_tests_also_run_on_a_stream(spark, tmp_path):
    rows(spark, {"HISTORICO": "ajuste"}, {"HISTORICO": "nada"}).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    marked = A.run_audit(stream, AuditConfig()).frame
    sink = marked.writeStream.format("memory").queryName("marked").start()
    sink.processAllAvailable()
    sink.stop()
    assert {(r["HISTORICO"], r["FLAG"]) for r in spark.table("marked").collect()} == {
        ("ajuste", "MANTER"), ("nada", "RETIRAR")}


def test_config():
    with pytest.raises(ConfigError, match="unknown"):
        AuditConfig(active=("TESTE_9_9",))
    with pytest.raises(ConfigError, match="run together"):
        AuditConfig(large_revenue_groups=("Receita líquidaReceitas financeiras",))
    with pytest.raises(ConfigError, match="blank"):
        AuditConfig(misc_words=("outros", " "))
    cfg = AuditConfig(active=("TESTE_7_9", "TESTE_1_1"), watch_names=("Lima",))
    assert cfg.active == ("TESTE_1_1", "TESTE_7_9")
    assert AuditConfig.from_json(cfg.to_json()) == cfg
    assert set(RULES) == set(TEST_NAMES)
    catalog = {r[0]: r[1:] for r in catalog_rows(cfg)}
    assert catalog["TESTE_1_1"] == ("ATIVO", "HISTORICO", "Data nula")
    assert catalog["TESTE_5_1"] == ("INATIVO", "CLASSIFICACAO", "Descrição não disponível")
    assert "Lima" in config_markdown(cfg, 1.5)
