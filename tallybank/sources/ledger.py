"""Readers for ledger, trial-balance, calendar and silver files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.functions.dates import date_text, parse_date
from tallybank.functions.money import parse_money_br
from tallybank.functions.text import NON_ASCII
from tallybank.operators.schema import clean_names, require_columns

SEPARATOR = ";"
CALENDAR_SCHEMA = T.StructType([T.StructField("DATA", T.StringType())])
AMOUNTS = ("MOVIMENTO", "DEBITO", "CREDITO")


class LedgerReadError(ValueError):
    """The file has no rows or lacks the account column."""


def two_byte_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Files under a path that begin with the byte-order mark of UTF-16, with their encoding. Only names reach the
    driver; the files are read once for it, so callers who know the encoding should say it."""
    head = F.hex(F.substring(F.col("value").cast("binary"), 1, 2))
    kind = F.when(head == "FFFE", "UTF-16LE").when(head == "FEFF", "UTF-16BE")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), kind.alias("kind"),
                                         F.col("_metadata.file_block_start").alias("start"))
    found = lines.where("kind IS NOT NULL AND start = 0").groupBy("file").agg(F.min("kind").alias("kind"))
    return {r["file"]: r["kind"] for r in found.collect()}


def _one_slash(file: str) -> str:
    """A file's address with one slash after the scheme, as Spark writes it both ways."""
    return re.sub(r"^(\w+):/+", r"\1:/", file)


def _csv(spark: SparkSession, path, sep: str, encoding: str, multiline: bool, order: str | None) -> DataFrame:
    # Everything is read as text: no inference pass, leading zeros survive, and files stay
    # splittable unless the caller says that values contain line breaks.
    frame = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
             .option("multiLine", multiline).csv(path))
    if order:
        # Numbers rise within a split, so file, split and number together follow the rows of each file.
        place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
        frame = frame.withColumn(order, place)
    return clean_names(frame)


def utf8_where_valid(text: Column) -> Column:
    """Text read byte by byte as ISO-8859-1: bytes that form valid UTF-8 become that, others stay."""
    bytes_again = F.encode(text, "ISO-8859-1").cast("string")
    return F.when(text.rlike(NON_ASCII), F.coalesce(F.try_validate_utf8(bytes_again), text)).otherwise(text)


def read_text_table(spark: SparkSession, path: str, sep: str = SEPARATOR, encoding: str | None = None,
                    multiline: bool = False, order: str | None = None) -> DataFrame:
    """Delimited text with a header, all columns as strings and names cleaned.

    Without an explicit encoding each file is taken for itself: those with a byte-order mark of UTF-16 are read as such,
    and whole, as lines of two-byte text can't be found byte by byte. All others are read losslessly as ISO-8859-1, and
    each value that is valid UTF-8 is read as such. ``order`` names a column to add that sorts rows as in their files.
    """
    if encoding and encoding != "UTF-8":
        return _csv(spark, path, sep, encoding, multiline or encoding.startswith("UTF-16"), order)
    wide = {} if encoding else two_byte_files(spark, path)
    parts = [_csv(spark, sorted(f for f, k in wide.items() if k == kind), sep, kind, True, order)
             for kind in sorted(set(wide.values()))]
    known = {_one_slash(f) for f in wide}
    plain = path if not wide else [f for f in spark.read.text(path).inputFiles() if _one_slash(f) not in known]
    if plain:
        frame = _csv(spark, plain, sep, "ISO-8859-1", multiline, order)
        parts.append(frame.select(*[utf8_where_valid(F.col(f"`{c}`")).alias(c) if c != order else F.col(f"`{c}`")
                                    for c in frame.columns]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_ledger(spark: SparkSession, path: str, sep: str = SEPARATOR, **options) -> DataFrame:
    """A ledger as text; refused without its account column or without rows."""
    frame = read_text_table(spark, path, sep, **options)
    require_columns(frame, ["CONTA"], LedgerReadError)
    if frame.isEmpty():
        raise LedgerReadError(f"no rows in {path}")
    return frame


def read_balance(spark: SparkSession, path: str, sep: str = SEPARATOR, **options) -> DataFrame:
    """A trial balance as text, with the order of its rows in ``ORD``."""
    return read_text_table(spark, path, sep, order="ORD", **options)


def read_calendar(spark: SparkSession, path: str | None, sep: str = SEPARATOR) -> DataFrame:
    """Calendar days as text. Without a path, at an absent path or without the column the frame is empty; any other
    trouble is the caller's to see."""
    empty = spark.createDataFrame([], CALENDAR_SCHEMA)
    if not path:
        return empty
    try:
        frame = read_text_table(spark, path, sep)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    return frame.select(F.col("DATA").cast("string")) if "DATA" in frame.columns else empty


def revalidate(frame: DataFrame) -> DataFrame:
    """Check a silver table read back as text: rows without a valid day-first date go, amounts become
    decimals and class columns are trimmed."""
    date = parse_date(F.col("DATA"))
    kept = frame.filter(date.isNotNull()).withColumn("DATA", date_text(date))
    changes = {c: parse_money_br(F.col(c)) for c in AMOUNTS if c in frame.columns}
    changes |= {c: F.trim(c) for c in ("CLASS_CTP", "CLASS_CONTA", "GRUPO_CONTA", "GRUPO_CTP")
                if c in frame.columns}
    return kept.withColumns(changes)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return revalidate(read_text_table(spark, path, encoding="UTF-8"))
