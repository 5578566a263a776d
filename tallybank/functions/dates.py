"""Dates: text in several layouts to DATE, and back to day-first text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each layout is tried only on text of its own shape, so a failed parse (which costs an
# exception inside the JVM) happens only for impossible dates such as 45/01/2025.
LEDGER_LAYOUTS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}\z", "d/M/yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
)
DAY_FIRST_LAYOUTS = (
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "d/M/yyyy H:mm:ss"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"),
)
EXCEL_EPOCH = "1899-12-30"
BR_DATE = r"^\d{2}/\d{2}/\d{4}$"


def _day_first(text: Column) -> Column:
    month = F.substring_index(F.substring_index(text, "/", 2), "/", -1)
    return F.concat_ws("-", F.right(text, F.lit(4)), month, F.substring_index(text, "/", 1)).try_cast("date")


# The layouts nearly all rows have: text of their shape is cast, which costs a fraction of a formatter.
CAST_LAYOUTS = {"d/M/yyyy": _day_first, "yyyy-M-d": lambda text: text.try_cast("date")}


def parse_date(text: Column, layouts=LEDGER_LAYOUTS) -> Column:
    """First layout that fits; null when none does."""
    def first(text: Column) -> Column:
        return F.coalesce(*[F.when(text.rlike(shape), CAST_LAYOUTS[layout](text) if layout in CAST_LAYOUTS else F.try_to_date(text, layout))
                            for shape, layout in layouts])

    # The text is bound once. Written out in every branch, a worked-out text made code of more than 8,000 bytes, which the
    # JVM never compiles.
    return F.get(F.transform(F.array(F.trim(text)), first), F.lit(0))


def excel_serial_date(text: Column) -> Column:
    """Days since 1899-12-30 written as a number, e.g. 45658 or 45658.0."""
    text = F.trim(text)
    days = F.when(text.rlike(r"^\d{1,6}(\.\d+)?$"), F.floor(text.try_cast("double")).cast("int"))
    return F.date_add(F.lit(EXCEL_EPOCH).cast("date"), days)


def parse_date_safe(text: Column) -> Column:
    """Ledger layouts, then spreadsheet serials, then other day-first layouts."""
    return F.coalesce(parse_date(text), excel_serial_date(text), parse_date(text, DAY_FIRST_LAYOUTS))


def date_text(date: Column, missing: str | None = "") -> Column:
    """dd/MM/yyyy, with ``missing`` for null."""
    iso = date.cast("string")
    day_first = F.concat_ws("/", F.right(iso, F.lit(2)), F.substring(iso, 6, 2), F.left(iso, F.lit(4)))
    # Years 0 to 9999 are written with four digits; a formatter, which costs more, is left for others.
    text = F.when(F.length(iso) == 10, day_first).otherwise(F.date_format(date, "dd/MM/yyyy"))
    return text if missing is None else F.coalesce(text, F.lit(missing))


def is_br_date(text: Column) -> Column:
    return F.coalesce(text.rlike(BR_DATE), F.lit(False))
