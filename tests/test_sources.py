"""Readers, writers, cache, inventory and column names."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.operators import schema as N
from tallybank.operators.silver import clean_balance
from tallybank.sources import cache, ledger, sinks
from tallybank.sources.staging import staged, staging_folder

TEXT = "Conta.1;Descrição;DATA;MOVIMENTO\n1.01;Ação à vista;31/12/2025;1.234,56\n1.02;;Conta:;-5,00\n"


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "iso-8859-1", "utf-16"])
def test_read_ledger_finds_the_encoding(spark, tmp_path, encoding):
    (tmp_path / "a.csv").write_bytes(TEXT.replace("Conta.1", "CONTA").encode(encoding))
    frame = ledger.read_ledger(spark, str(tmp_path))
    assert frame.columns == ["CONTA", "Descricao", "DATA", "MOVIMENTO"]
    assert [r["Descricao"] for r in frame.orderBy("CONTA").collect()] == ["Ação à vista", None]
    assert {t for _, t in frame.dtypes} == {"string"}


def test_files_of_two_encodings_in_one_folder(spark, tmp_path):
    for name in ("utf-8", "iso-8859-1"):
        (tmp_path / f"{name}.csv").write_bytes(f"CONTA;TEXTO\n{name};ação\n".encode(name))
    assert {r["TEXTO"] for r in ledger.read_ledger(spark, str(tmp_path)).collect()} == {"ação"}


def test_read_ledger_needs_the_account_and_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("X;Y\n1;2\n")
    with pytest.raises(ledger.LedgerReadError, match="CONTA"):
        ledger.read_ledger(spark, str(tmp_path / "a.csv"))
    (tmp_path / "b.csv").write_text("CONTA;Y\n")
    with pytest.raises(ledger.LedgerReadError, match="no rows"):
        ledger.read_ledger(spark, str(tmp_path / "b.csv"))


def test_two_byte_files_are_told_apart(spark, tmp_path):
    for name, head in (("u8", b"\xef\xbb\xbfa"), ("le", b"\xff\xfea\0"), ("be", b"\xfe\xff\0a"), ("none", b"abc")):
        (tmp_path / name).write_bytes(head)
    found = ledger.two_byte_files(spark, str(tmp_path))
    assert {f.rsplit("/", 1)[-1]: k for f, k in found.items()} == {"le": "UTF-16LE", "be": "UTF-16BE"}


def test_two_byte_and_one_byte_files_in_one_folder(spark, tmp_path):
    for name in ("utf-8", "utf-16", "iso-8859-1"):
        (tmp_path / f"{name}.csv").write_bytes(f"CONTA;TEXTO\n{name};ação\n".encode(name))
    got = {(r["CONTA"], r["TEXTO"]) for r in ledger.read_ledger(spark, str(tmp_path)).collect()}
    assert got == {("utf-8", "ação"), ("utf-16", "ação"), ("iso-8859-1", "ação")}


def test_balance_keeps_the_order_of_its_file(spark, tmp_path):
    lines = [f"{i % 7};g{i};c{i}" for i in range(5000)]
    (tmp_path / "b.csv").write_text("CONTA;GRUPO;CTP\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        accounts = {r["CONTA_CHAVE"]: r["GRUPO"] for r in clean_balance(ledger.read_balance(spark, str(tmp_path))).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert accounts == {str(i): f"g{i}" for i in range(7)}


def test_calendar_is_optional(spark, tmp_path):
    assert ledger.read_calendar(spark, None).columns == ["DATA"]
    assert ledger.read_calendar(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(Exception, match="no-such-store"):
        ledger.read_calendar(spark, "no-such-store://a/b.csv")
    (tmp_path / "c.csv").write_text("DATA\n01/01/2025\n")
    assert [r["DATA"] for r in ledger.read_calendar(spark, str(tmp_path / "c.csv")).collect()] == ["01/01/2025"]


def silver(spark):
    return spark.createDataFrame(
        [(dt.date(2025, 1, 2), "001", Decimal("1234.50"), " Ativo "), (None, "002", None, None)],
        "DATA date, CONTA string, MOVIMENTO decimal(18,2), CLASS_CONTA string")


def test_silver_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "silver")
    sinks.write_silver_csv(silver(spark), path)
    back = ledger.read_silver(spark, path)
    row = back.collect()
    assert len(row) == 1 and row[0].asDict() == {
        "DATA": "02/01/2025", "CONTA": "001", "MOVIMENTO": Decimal("1234.50"), "CLASS_CONTA": "Ativo"}


def test_silver_parquet_is_split_by_month(spark, tmp_path):
    path = str(tmp_path / "silver")
    sinks.write_silver_parquet(silver(spark), path)
    back = spark.read.parquet(path)
    assert {r["MES"] for r in back.collect()} == {"2025-01", "none"}


def test_gold_csv_and_sheets(spark, tmp_path):
    path, sheets = str(tmp_path / "gold"), tmp_path / "sheets"
    sinks.write_gold_csv(silver(spark), path)
    assert spark.read.option("header", True).option("sep", ";").csv(path).count() == 2
    sinks.export_sheets(spark.range(25).repartition(1), str(sheets), rows_per_file=10)
    files = list(sheets.glob("part-*.csv"))
    assert sorted(len(f.read_text().splitlines()) - 1 for f in files) == [5, 10, 10]


def test_inventory(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.pdf").write_bytes(b"x" * 524288)
    (tmp_path / "log.txt").write_text("x")
    row = sinks.folder_inventory(spark, str(tmp_path), "*.pdf").head()
    assert (row["files"], row["total_mb"], row["mean_mb"]) == (4, 2.0, 0.5)


def test_cache_grows_by_misses_only(spark, tmp_path):
    path = str(tmp_path / "cache")
    first = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, text string")
    cache.append_to_cache(first, path)
    more = spark.createDataFrame([("b", "x"), ("c", "3"), ("c", "3")], "key string, text string")
    cache.append_to_cache(more, path)
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, stored.collect())) == [("a", "1"), ("b", "2"), ("c", "3")]
    work = spark.createDataFrame([("a",), ("z",)], "key string")
    assert [r["key"] for r in cache.cache_hits(work, stored).collect()] == ["a"]
    assert [r["key"] for r in cache.cache_misses(work, stored).collect()] == ["z"]


def test_keyed_cache_keeps_the_first_of_each_key_and_is_not_shuffled(spark, tmp_path):
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("text", T.StringType())])
    store = cache.KeyedCache(str(tmp_path / "keyed"), schema, buckets=4)
    rows = lambda *given: spark.createDataFrame(list(given), "key string, text string")
    work = spark.createDataFrame([("a",), ("z",), (None,), ("c",)], "key string")
    assert store.rows(spark).count() == 0 and store.misses(work).count() == 4
    store.append(rows(("b", "2"), ("a", "9"), ("a", "1"), (None, "0")), 5, ["text"])
    store.append(rows(("a", "0"), ("c", "3"), ("c", "4"), ("c", "4")), 6, ["text"])
    late = rows(("c", "late"), ("d", "late")).selectExpr("*", "4L AS stored_in")  # as of a run that looked before the others wrote
    late.repartition(4, "key").write.mode("append").format("parquet").option("path", store.path).bucketBy(4, "key").saveAsTable(store.name)
    want = [("a", "1"), ("b", "2"), ("c", "late"), ("d", "late")]
    assert sorted(map(tuple, store.rows(spark).collect())) == want
    assert sorted(map(tuple, store.hits(work).collect())) == [("a", "1"), ("c", "late")]
    assert sorted((r["key"] for r in store.misses(work).collect()), key=str) == [None, "z"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (store.hits(work), store.misses(work)):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan or "Bucketed: true" in plan
        assert "Exchange" not in store.rows(spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(f"DROP TABLE {store.name}")  # another session learns of the table by its folder
    assert sorted(map(tuple, store.rows(spark).collect())) == want


def test_staging_uses_the_folder_of_the_session(spark):
    folder = staging_folder(spark)
    assert folder == staging_folder(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    frame = staged(spark.range(5).withColumn("d", F.lit(Decimal("1.50"))))
    plan = frame._jdf.queryExecution().analyzed().toString()
    assert frame.count() == 5 and "LogicalRDD" in plan and "Range" not in plan


def test_names():
    assert N.clean_name("ï»¿Data do LanÃ§amento") == "Data_do_Lancamento"
    assert N.clean_name(' "Saldo-1.2" ') == "Saldo_1_2"
    assert N.distinct_names(["Conta", "CONTA", "x", "conta"]) == ["Conta", "CONTA_1", "x", "conta_2"]
    assert N.alternative_columns(["Alternativa_A", "ALT_b", "Ano"]) == ["Alternativa_A", "ALT_b"]


def test_projection_helpers(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    assert N.ordered(frame, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing columns: \\['c'\\]"):
        N.ordered(frame, ["c"])
    assert N.with_absent(frame, ["c", "a"]).head()["c"] == ""
    assert N.has_columns(frame, ["a"]) and not N.has_columns(frame, ["z"])
