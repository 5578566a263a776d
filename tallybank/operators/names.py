"""Names of a long list in texts: an inverted index of name parts, and a join with the parts of the texts.

A pattern of all names is tried at every position of every text, so it fits lists of some dozens. Here each name is
indexed under the one of its parts that fewest other names have, texts are taken apart in the same way, both meet in a join,
and the whole name is verified where they meet. The plan does not grow with the list.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.functions.predicates import SHORT_NAME
from tallybank.functions.text import accent_pattern, fold_ascii
from tallybank.sources.staging import staged

WORD = r"\p{L}\p{N}\p{M}_"
#: Letters of the words on both sides of a gap that make a part, and letters of a part within a word.
SIDE, GRAM = 3, 6


def _runs(text: Column, fold: bool) -> Column:
    """Words of lower-case text. They are told apart before accents go, as some signs turn into letters then."""
    spaced = F.regexp_replace(text, f"[^{WORD}]+", " ")
    return F.array_remove(F.split(fold_ascii(spaced) if fold else spaced, " "), "")


def _gaps(runs: Column, left: int, right: int) -> Column:
    """Parts at the gaps between words: the last letters before and the first ones after."""
    pairs = F.transform(F.slice(runs, 1, F.size(runs) - 1), lambda run, at: F.concat(
        F.lit(f"q{left}{right}:"), F.right(run, F.lit(left)), F.lit("|"), F.left(F.get(runs, at + 1), F.lit(right))))
    return F.when(F.size(runs) > 1, pairs).otherwise(F.array().cast("array<string>"))


def _grams(runs: Column, length: int) -> Column:
    long_enough = F.filter(runs, lambda run: F.length(run) >= length)
    return F.flatten(F.transform(long_enough, lambda run: F.transform(
        F.sequence(F.lit(1), F.length(run) - (length - 1)), lambda at: F.concat(F.lit(f"g{length}:"), run.substr(at, F.lit(length))))))


def _whole_words(runs: Column) -> Column:
    return F.transform(runs, lambda run: F.concat(F.lit("e:"), run))


#: Kinds of parts, and how a text's words give all its parts of a kind.
KINDS = ({f"q{i}{j}": (lambda runs, i=i, j=j: _gaps(runs, i, j)) for i in range(1, SIDE + 1) for j in range(1, SIDE + 1)}
         | {f"g{n}": (lambda runs, n=n: _grams(runs, n)) for n in range(1, GRAM + 1)}
         | {"e": _whole_words, "x": lambda runs: F.array(F.lit("x:"))})


def _is_short(plain: Column) -> Column:
    """A single word of few letters, which counts only between word boundaries."""
    return ~plain.rlike(r"\s") & (F.length(plain) <= SHORT_NAME)


def _parts_of_name(plain: Column, runs: Column, fold: bool) -> Column:
    """All parts a name may be indexed under. Each is in every text that holds the name."""
    def at_gaps(run, at):
        after = F.get(runs, at + 1)
        left, right = F.least(F.length(run), F.lit(SIDE)), F.least(F.length(after), F.lit(SIDE))
        return F.concat(F.lit("q"), left.cast("string"), right.cast("string"), F.lit(":"), F.right(run, left), F.lit("|"), F.left(after, right))

    run = F.get(runs, F.lit(0))
    within = F.least(F.length(run), F.lit(GRAM))
    grams = F.transform(F.sequence(F.lit(1), F.length(run) - within + 1), lambda at: F.concat(
        F.lit("g"), within.cast("string"), F.lit(":"), run.substr(at, within)))
    bounded = _is_short(plain) if fold else F.lit(False)
    return (F.when(F.size(runs) == 0, F.array(F.lit("x:")))
            .when(F.size(runs) > 1, F.concat(F.transform(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), at_gaps), _grams(runs, GRAM)))
            .when(bounded, F.array(F.concat(F.lit("e:"), run))).otherwise(grams))


def index_names(names: DataFrame, column: str = "name", fold: bool = True) -> DataFrame:
    """(name, plain, part), one row for each name that is not blank: the part that fewest names of the list have."""
    name = F.col(f"`{column}`").cast("string")
    plain = F.lower(F.regexp_replace(fold_ascii(name), r"^\s+|\s+$", "")) if fold else F.lower(name)
    listed = names.select(name.alias("name"), plain.alias("plain")).where(F.trim("plain") != "").distinct()
    parts = listed.withColumn("runs", _runs(F.col("plain"), False)).select(
        "name", "plain", F.explode(F.array_distinct(_parts_of_name(F.col("plain"), F.col("runs"), fold))).alias("part"))
    parts = staged(parts)
    seen = parts.groupBy("part").agg(F.count("*").alias("names"))
    best = F.min_by("part", F.struct("names", -F.length("part"), "part"))
    return parts.join(seen, "part").groupBy("name", "plain").agg(best.alias("part"))


def _holds(text: Column, plain: Column, fold: bool) -> Column:
    """Whether lower-case text holds the whole name: as in ``matches_names`` with ``fold``, else as a plain substring."""
    if not fold:
        return F.contains(text, plain)
    letters = F.create_map(*[F.lit(x) for c in string.ascii_lowercase for x in (c, accent_pattern(c))])
    spelled = F.array_join(F.transform(F.split(plain, ""), lambda c: F.coalesce(
        F.element_at(letters, c), F.concat(F.lit("\\Q"), c, F.lit("\\E")))), "")
    edge = r"[\p{L}\p{N}_]"
    return F.regexp_like(text, F.when(_is_short(plain), F.concat(F.lit(f"(?<!{edge})"), spelled, F.lit(f"(?!{edge})"))).otherwise(spelled))


def name_matches(texts: DataFrame, text_column: str, names: DataFrame, name_column: str = "name", fold: bool = True) -> DataFrame:
    """(text, name): every name of the list in every distinct text.

    With ``fold`` accents don't matter and single words of few letters count only between word boundaries; without, names
    are found as they are, in any case. Blank names and null texts are left out. Each text meets a name once, as a name
    has one part; names without a letter or digit meet every text. Only the kinds of parts reach the driver.
    """
    index = staged(index_names(names, name_column, fold))
    used = sorted(r[0] for r in index.select(F.substring_index("part", ":", 1)).distinct().collect())
    distinct = texts.select(F.col(f"`{text_column}`").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    runs = distinct.withColumn("runs", _runs(F.lower("text"), fold))
    parts = F.flatten(F.array(*[KINDS[kind](F.col("runs")) for kind in used])) if used else F.array().cast("array<string>")
    met = runs.select("text", F.explode(F.array_distinct(parts)).alias("part")).join(index, "part")
    return met.where(_holds(F.lower("text"), F.col("plain"), fold)).select("text", "name")


def mark_named(frame: DataFrame, text_column: str, names: DataFrame, name_column: str, out: str, fold: bool = True) -> DataFrame:
    """The frame with a boolean column ``out``: whether the text holds a name of the list."""
    named = name_matches(frame, text_column, names, name_column, fold).select(F.col("text").alias("__named")).distinct()
    marked = frame.join(named, F.col(f"`{text_column}`") == F.col("__named"), "left")
    return marked.withColumn(out, F.col("__named").isNotNull()).drop("__named")
