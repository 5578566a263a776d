"""Writers for silver and gold tables, and the output-folder inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.functions.money import money_text

BOM = "﻿"
# Rows that a spreadsheet holds.
SHEET_ROWS = 1_000_000


def localized(frame: DataFrame) -> DataFrame:
    """Decimals and doubles as text with a decimal comma; dates day-first."""
    columns = []
    for f in frame.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            value = money_text(value)
        elif isinstance(f.dataType, T.DateType):
            value = F.date_format(value, "dd/MM/yyyy")
        columns.append(value.alias(f.name))
    return frame.select(*columns)


def write_silver_csv(frame: DataFrame, path: str, bom: bool = True) -> None:
    """Semicolon text with decimal commas; the first header cell carries the byte-order mark."""
    out = localized(frame)
    if bom:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    (out.write.mode("overwrite").option("header", True).option("sep", ";")
     .option("encoding", "UTF-8").option("lineSep", "\n").csv(path))


def write_silver_parquet(frame: DataFrame, path: str) -> None:
    """The same table in columnar form, split by posting month so that date filters skip files."""
    month = F.coalesce(F.date_format("DATA", "yyyy-MM"), F.lit("none"))
    frame.withColumn("MES", month).write.mode("overwrite").partitionBy("MES").parquet(path)


def write_gold_csv(frame: DataFrame, path: str, files: int | None = None) -> None:
    """Audit result. ``files`` asks for fewer output files and only suits small results."""
    out = frame if files is None else frame.coalesce(files)
    (out.write.mode("overwrite").option("header", True).option("sep", ";")
     .option("encoding", "UTF-8").csv(path))


def export_sheets(frame: DataFrame, path: str, rows_per_file: int = SHEET_ROWS) -> None:
    """Write every row, in files that each fit a spreadsheet."""
    (frame.write.mode("overwrite").option("header", True).option("sep", ";").option("encoding", "UTF-8")
     .option("maxRecordsPerFile", rows_per_file).csv(path))


def folder_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Number of files, their total and mean size in MB. File contents are never read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", True).load(path).select("length"))
    total = F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024)
    return files.agg(
        F.count("*").alias("files"),
        F.round(total, 2).alias("total_mb"),
        F.round(F.try_divide(total, F.count("*")), 2).alias("mean_mb"),
    )
