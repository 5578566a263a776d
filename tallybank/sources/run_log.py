"""The log of audit runs: figures taken while the result is written, kept as a table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybank.operators.audit import DROP, KEEP, Audit, export_projection
from tallybank.sources.sinks import write_gold_csv

LOG_SCHEMA = "run_id string, figure string, value long"


def run_figures(audit: Audit) -> dict[str, Column]:
    """Totals, flags, dates and the hits of every test that ran, as counters over the marked rows."""
    figures = {"linhas": F.count("*"), "mantidas": F.count_if(F.col("FLAG") == KEEP),
               "retiradas": F.count_if(F.col("FLAG") == DROP)}
    if "DATA" in audit.frame.columns:
        figures |= {"datas_validas": F.count("DATA"), "datas_vazias": F.count_if(F.col("DATA").isNull())}
    return figures | {t: F.count(t) for t in audit.tests}


def write_gold_logged(audit: Audit, original_columns, path: str, log: str, run_id: str) -> None:
    """Write the kept rows, and append the figures of the run to the table ``log``, without a second pass over the ledger.

    The counters are observed behind the last shuffle, in the tasks that write; Spark counts each of these once, however
    often it is tried. A test that was skipped is logged with a null. A ledger without rows has zeros. A run whose write
    fails leaves no figures.
    """
    spark = audit.frame.sparkSession
    figures = run_figures(audit)
    seen = Observation()
    watched = audit.frame.observe(seen, *[column.alias(name) for name, column in figures.items()])
    write_gold_csv(export_projection(replace(audit, frame=watched), original_columns), path)
    rows = [(run_id, name, int(seen.get[name])) for name in figures] + [(run_id, name, None) for name in audit.skipped]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log)


def read_run_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(log)
