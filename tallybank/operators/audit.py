"""Running the audit: typed ledger in, one marked and flagged row out per ledger row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.config import AuditConfig, catalog_rows
from tallybank.functions.dates import parse_date
from tallybank.functions.feasts import feast_days
from tallybank.functions.money import parse_money_br
from tallybank.functions.text import normalize_text
from tallybank.operators.names import mark_named
from tallybank.operators.ranking import Recurring, RepeatMark, mark_repeats, repeats_per_key, split_recurring
from tallybank.operators.rules import (
    REPEATED, REVERSED, RULES, SAMPLED, TEXT_COLUMNS, TRIPLICATE, rule_mark)
from tallybank.operators.sampling import mark_sample, sample_cut
from tallybank.operators.silver import AMOUNTS, as_date, as_money

KEEP, DROP = "MANTER", "RETIRAR"
REPEAT_KEYS = ("CONTA", "MOVIMENTO")
TRIPLICATE_KEYS = ("HISTORICO", "MOVIMENTO", "DATA")
# Within a group the earliest posting comes first; a hash of the row settles ties. Day, hash and whether the row is
# against a result account are packed into one whole number, so groups are ordered and reduced by fixed-width values.
ORDER, ROW_HASH = "__order", "__row_hash"
ORDER_HASH_BITS = 36
# Tests that look for names, and whether accents are folded for them.
NAME_TESTS = {"TESTE_1_8": lambda cfg: cfg.fold_names, "TESTE_7_9": lambda cfg: False}
# The test of non-working days, and the mark of those that a calendar table lists.
NONWORKING, LISTED_DAY = "TESTE_1_2", "__listed_day"
# Columns that are never exported.
HELPER_COLUMNS = ("FLAG", "LINHA_SEQ", "LINHA_SEQ_TESTE4", "Semana_Resumida", "VALOR_REDONDO")


@dataclass(frozen=True)
class Audit:
    """Result of a run: the marked rows, the tests that ran, and those skipped for missing columns."""

    frame: DataFrame
    tests: tuple[str, ...]
    skipped: dict[str, list[str]]


def prepare_ledger(frame: DataFrame) -> DataFrame:
    """Date, amounts and compared texts in the types the tests work on."""
    changes = {c: as_money(frame, c, parse_money_br) for c in AMOUNTS if c in frame.columns}
    if "DATA" in frame.columns:
        changes["DATA"] = as_date(frame, "DATA", parse_date)
    changes |= {c: normalize_text(F.col(c).cast("string")) for c in TEXT_COLUMNS if c in frame.columns}
    return frame.withColumns(changes)


def runnable_tests(columns, cfg: AuditConfig) -> tuple[tuple[str, ...], dict[str, list[str]]]:
    """Active tests whose columns exist, and the absent columns of the others."""
    skipped = {t: absent for t in cfg.active if (absent := [c for c in RULES[t].requires if c not in columns])}
    return tuple(t for t in cfg.active if t not in skipped), skipped


def with_row_order(frame: DataFrame, cfg: AuditConfig, columns) -> DataFrame:
    """Add the packed order of a row and the hash of the named columns. Rows that tie on both are copies."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sorted(columns)]
    row_hash = F.md5(F.concat_ws("|", *cells))
    lead = F.conv(F.substring(F.col(ROW_HASH), 1, ORDER_HASH_BITS // 4), 16, 10).cast("long")
    # Days from year 1 to 9999 take 22 bits; a row without a date comes first.
    day = F.coalesce(F.datediff("DATA", F.lit("0001-01-01").cast("date")) + 1, F.lit(0)) if "DATA" in frame.columns else F.lit(0)
    result = against_result(cfg).cast("long") if "CLASS_CTP" in frame.columns else F.lit(0)
    packed = (day.cast("long") * (1 << ORDER_HASH_BITS) + lead) * 2 + result
    return frame.withColumn(ROW_HASH, row_hash).withColumn(ORDER, packed)


def against_result(cfg: AuditConfig) -> Column:
    return F.coalesce(F.col("CLASS_CTP").isin(*cfg.result_classes), F.lit(False))


def _posted(cfg: AuditConfig) -> Column:
    """Rows of the base day with an account and an amount."""
    return (F.col("DATA") == F.lit(cfg.base_day).cast("date")) & F.col("CONTA").isNotNull() & F.col("MOVIMENTO").isNotNull()


def _follows(cfg: AuditConfig) -> Column:
    month_start = F.lit(cfg.follow_month + "-01").cast("date")
    return F.coalesce((F.col("DATA") >= month_start) & (F.col("DATA") < F.add_months(month_start, 1)), F.lit(False))


def mark_reversals(frame: DataFrame, cfg: AuditConfig, ledger: DataFrame | None = None) -> DataFrame:
    """Mark rows of the following month whose account and amount were posted on the base day. ``ledger`` holds the
    postings of that day, if ``frame`` is only a part of it."""
    follows = _follows(cfg)
    # Distinct keys need no other column, so lookups that the ledger went through drop out of this side.
    posted = ((frame if ledger is None else ledger).filter(_posted(cfg))
              .select(F.col("CONTA").alias("__conta"), F.col("MOVIMENTO").alias("__movimento")).distinct())
    joined = frame.join(posted, (F.col("CONTA") == F.col("__conta")) & (F.col("MOVIMENTO") == F.col("__movimento")), "left")
    marked = joined.withColumn(REVERSED, follows & F.col("__conta").isNotNull())
    return marked.select(*frame.columns, REVERSED)


def listed_days(frame: DataFrame, cfg: AuditConfig, calendar: DataFrame | None) -> DataFrame | None:
    """Days of a calendar, a frame with a column ``DATA`` of dates or text, and the national holidays of all years if the
    configuration asks for them. Days that come twice count once, and those that can't be read are left out."""
    parts = []
    if calendar is not None:
        parts.append(calendar.select(as_date(calendar, "DATA", parse_date).alias("__day")))
    if cfg.national_feasts:
        parts.append(feast_days(frame.sparkSession.range(1, 10000), "id").select(F.col("day").alias("__day")))
    return reduce(DataFrame.unionByName, parts).where(F.year("__day").between(1, 9999)).distinct() if parts else None


def mark_listed_days(frame: DataFrame, days: DataFrame, out: str) -> DataFrame:
    """Mark rows whose day is listed. A lookup reads each row's date once, where a condition that works out Easter would
    repeat the parsing of the date in every term."""
    # Whatever is listed, years 1 to 9999 have 3,652,059 days, so this side has a bound.
    joined = frame.join(F.broadcast(days), F.col("DATA") == F.col("__day"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in frame.columns], F.col("__day").isNotNull().alias(out))


def run_audit(frame: DataFrame, cfg: AuditConfig, prepared: bool = False,
              name_lists: dict[str, tuple[DataFrame, str]] | None = None, narrow: bool = False,
              calendar: DataFrame | None = None) -> Audit:
    """Apply the active tests and set ``FLAG``. Columns exist only for tests that ran, and ranking,
    sampling or joins are planned only for tests that need them.

    ``name_lists`` gives a test of names (1_8, 7_9) its names as a table and column instead of the list in ``cfg``; they
    are looked up by an index, so the list may be of any length.

    ``calendar`` holds non-working days (column ``DATA``) that test 1_2 looks up besides weekends and listed holidays.

    With ``narrow`` the tests of repeated and reversed rows move only rows that may be hit: a first pass finds the keys
    that recur. It pays where the ledger is stored, as it is read once more for it, and repeats are few."""
    if unknown := set(name_lists or {}) - set(NAME_TESTS):
        raise ValueError(f"not tests of names: {sorted(unknown)}")
    source = frame if prepared else prepare_ledger(frame)
    tests, skipped = runnable_tests(source.columns, cfg)
    helpers = {RULES[t].helper for t in tests}
    marked, others = source, None
    repeats, kinds = [], []
    if REPEATED in helpers:
        repeats.append(RepeatMark(REPEAT_KEYS, (ORDER, ROW_HASH), 2, REPEATED))
        # Only rows against result accounts are marked, but the first of a group may be any row of it.
        kinds.append(Recurring(REPEAT_KEYS, 2))
    if TRIPLICATE in helpers:
        repeats.append(RepeatMark(TRIPLICATE_KEYS, (ORDER, ROW_HASH), 3, TRIPLICATE))
        kinds.append(Recurring(TRIPLICATE_KEYS, 3))
    if REVERSED in helpers:
        kinds.append(Recurring(REPEAT_KEYS, 1, among=_posted(cfg), where=_follows(cfg)))
    if narrow and kinds:
        marked, others = split_recurring(source, kinds)
    if REVERSED in helpers:
        marked = mark_reversals(marked, cfg, source)
    if repeats:
        marked = mark_repeats(with_row_order(marked, cfg, source.columns), repeats)
        marked = marked.drop(ORDER, ROW_HASH)
    if others is not None:
        unmarked = [F.lit(False).alias(c) for c in marked.columns if c not in source.columns]
        marked = marked.unionByName(others.select(*source.columns, *unmarked))
    if SAMPLED in helpers:
        cut = sample_cut(source, cfg.sample_size, cfg.sample_seed, source.columns)
        marked = mark_sample(marked, SAMPLED, cut, cfg.sample_seed, source.columns, [m.out for m in repeats])
    lists = {t: held for t, held in (name_lists or {}).items() if t in tests}
    for test, (names, column) in lists.items():
        marked = mark_named(marked, "HISTORICO", names, column, f"__named_{test}", NAME_TESTS[test](cfg))
    days = listed_days(source, cfg, calendar) if NONWORKING in tests else None
    if days is not None:
        marked = mark_listed_days(marked, days, LISTED_DAY)
    marks = [F.when(F.col(f"__named_{t}"), F.lit("SIM")).alias(t) if t in lists
             else F.when(RULES[t].build(cfg) | F.col(LISTED_DAY), F.lit("SIM")).alias(t) if t == NONWORKING and days is not None
             else rule_mark(t, cfg) for t in tests]
    marked = marked.select(*source.columns, *marks)
    if tests:
        no_hit = F.coalesce(*[F.col(t) for t in tests]).isNull()
        marked = marked.withColumn("FLAG", F.when(no_hit, F.lit(DROP)).otherwise(F.lit(KEEP)))
    else:
        marked = marked.withColumn("FLAG", F.lit(KEEP))
    return Audit(marked, tests, skipped)


# --- summaries -------------------------------------------------------------------------------


def _percent(part, whole):
    return F.round(F.try_divide(part * 100.0, whole), 2)


def flag_summary(frame: DataFrame) -> DataFrame:
    """(FLAG, n, pct) for kept and dropped rows, from one pass."""
    totals = frame.agg(F.count("*").alias("total"),
                       F.count_if(F.col("FLAG") == KEEP).alias("kept"),
                       F.count_if(F.col("FLAG") == DROP).alias("dropped"))
    lines = F.array(F.struct(F.lit(KEEP).alias("FLAG"), F.col("kept").alias("n")),
                    F.struct(F.lit(DROP).alias("FLAG"), F.col("dropped").alias("n")))
    return (totals.select("total", F.inline(lines))
            .select("FLAG", "n", _percent(F.col("n"), F.col("total")).alias("pct")))


def _hit_lines(totals: DataFrame, tests) -> DataFrame:
    lines = F.array(*[F.struct(F.lit(t).alias("TESTE"), F.col(t).alias("hits")) for t in tests])
    return (totals.select("total", F.inline(lines))
            .select("TESTE", "hits", _percent(F.col("hits"), F.col("total")).alias("pct")))


def rule_hits(audit: Audit) -> DataFrame:
    """(TESTE, hits, pct) for every test that ran, from one pass."""
    totals = audit.frame.agg(F.count("*").alias("total"), *[F.count(t).alias(t) for t in audit.tests])
    return _hit_lines(totals, audit.tests)


def count_hits(frame: DataFrame, cfg: AuditConfig, prepared: bool = False, calendar: DataFrame | None = None) -> DataFrame:
    """The same figures when only they are wanted: one pass over the ledger, in which nothing is ranked.

    Each row is counted for itself, and once more for each group that the two tests of repeated rows look at. All are
    reduced to one row per group before the shuffle, by whole numbers, so groups of any size stay cheap: of n repeated
    rows n-1 or n-2 are hits, less the first row where it would have been one. Rows of the base day and of the month after
    it meet by account and amount, so reversals need no second look at the ledger. The sample has its size.
    """
    source = frame if prepared else prepare_ledger(frame)
    tests, _ = runnable_tests(source.columns, cfg)
    grouped = [t for t in tests if RULES[t].helper in (REPEATED, TRIPLICATE, SAMPLED, REVERSED)]
    plain = [t for t in tests if t not in grouped]
    marked = run_audit(source, cfg.replace(active=tuple(plain)), prepared=True, calendar=calendar).frame
    helpers = {RULES[t].helper: t for t in grouped}
    nothing = [F.lit(None).cast("string"), F.lit(None).cast("decimal(18,2)"), F.lit(None).cast("date")]

    def part(kind: int, text=None, amount=None, day=None) -> Column:
        own = [c if c is not None else n for c, n in zip((text, amount, day), nothing)]
        return F.struct(F.lit(kind).alias("kind"), *[c.alias(n) for c, n in zip(own, ("text", "amount", "day"))])

    parts = [part(0)]
    result, order = F.lit(False), F.lit(0).cast("long")
    posted, follows = F.lit(False), F.lit(False)
    if REVERSED in helpers:
        posted, follows = F.coalesce(_posted(cfg), F.lit(False)), _follows(cfg)
        parts.append(F.when(posted | follows, part(3, F.col("CONTA"), F.col("MOVIMENTO"))))
    if REPEATED in helpers:
        parts.append(part(1, F.col("CONTA"), F.col("MOVIMENTO")))
        marked = with_row_order(marked, cfg, source.columns)
        result, order = against_result(cfg), F.col(ORDER)
    if TRIPLICATE in helpers:
        parts.append(part(2, F.col("HISTORICO"), F.col("MOVIMENTO"), F.col("DATA")))
    rows = marked.select(*[F.col(t).isNotNull().alias(t) for t in plain], result.alias("result"), order.alias("order"),
                         posted.alias("posted"), follows.alias("follows"), F.inline(F.array_compact(F.array(*parts))))
    groups = rows.groupBy("kind", "text", "amount", "day").agg(
        F.count("*").alias("rows"), F.count_if("result").alias("results"), F.min("order").alias("first"),
        F.max("posted").alias("posted"), F.count_if("follows").alias("follows"),
        *[F.count_if(F.col(t) & (F.col("kind") == 0)).alias(t) for t in plain])
    whole = F.col("kind") == 0
    sums = {t: F.sum(F.when(whole, F.col(t))) for t in plain}
    if REPEATED in helpers:
        sums[helpers[REPEATED]] = F.sum(F.when(F.col("kind") == 1, F.col("results") - F.pmod("first", F.lit(2))))
    if TRIPLICATE in helpers:
        sums[helpers[TRIPLICATE]] = F.sum(F.when(F.col("kind") == 2, F.greatest(F.col("rows") - 2, F.lit(0))))
    if REVERSED in helpers:
        sums[helpers[REVERSED]] = F.sum(F.when((F.col("kind") == 3) & F.col("posted"), F.col("follows")))
    if SAMPLED in helpers:
        sums[helpers[SAMPLED]] = F.sum(F.when(whole, F.least(F.col("rows"), F.lit(cfg.sample_size))))
    totals = groups.agg(F.coalesce(F.sum(F.when(whole, F.col("rows"))), F.lit(0)).alias("total"),
                        *[F.coalesce(sums[t], F.lit(0)).alias(t) for t in tests])
    return _hit_lines(totals, tests)


def rule_catalog(audit: Audit, cfg: AuditConfig) -> DataFrame:
    """Catalogue of all tests with the hits of those that ran."""
    hits = rule_hits(audit)
    catalog = hits.sparkSession.createDataFrame(
        catalog_rows(cfg), "TESTE string, STATUS string, CATEGORIA string, DESCRICAO string")
    return catalog.join(F.broadcast(hits.select("TESTE", "hits")), "TESTE", "left")


def repeat_counts(prepared: DataFrame) -> DataFrame:
    """Repeated postings per account, counted without ranking any row."""
    per_key = repeats_per_key(prepared, list(REPEAT_KEYS), 2)
    return per_key.groupBy("CONTA").agg(F.sum("n").alias("repeats"))


def triplicate_counts(prepared: DataFrame) -> DataFrame:
    """Third and later equal postings per day, counted without ranking any row."""
    per_key = repeats_per_key(prepared, list(TRIPLICATE_KEYS), 3)
    return per_key.groupBy("DATA").agg(F.sum("n").alias("marks")).filter(F.col("marks") > 0)


# --- export ----------------------------------------------------------------------------------


def export_projection(audit: Audit, original_columns) -> DataFrame:
    """Kept rows only: original columns in their order, then the new ones, without helper columns."""
    kept = audit.frame.filter(F.col("FLAG") == KEEP)
    present = [c for c in original_columns if c in kept.columns]
    added = [c for c in kept.columns if c not in original_columns]
    names = [c for c in present + added if c not in HELPER_COLUMNS]
    names = [c for c in names if kept.schema[c].dataType.simpleString() != "void"]
    return kept.select(*[F.col(f"`{c}`") for c in names])


def class_domain(frame: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a class column."""
    return frame.select(column).distinct().orderBy(column)
