"""URL filters: rules by host and path; beyond them naive Bayes over words that Viterbi finds in host and path."""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybank.llm.common import BATCH_ROWS, lasting

# The rules of the production list (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
# Words that mark unwanted hosts, a small prior of the class to block.
SEED_WORDS = ("ads adult bet bets betting casino cheap gamble jackpot loan lottery pill pills poker porn prize sex slots "
              "spam tracker viagra xxx").split()
#: Words longer than this are not looked for in names.
LONGEST_WORD = 20
#: A seed word counts as often as this among the unigrams, so that names are split at it.
SEED_COUNT = 100
#: A seed word counts as so many hosts to block.
SEED_HOSTS = 2
#: Each word is smoothed by so many hosts in the proportions of both classes, so an unknown word weighs nothing.
SMOOTHING = 1.0
#: A word of a host is one example, shared over the classes in parts of this size.
PARTS = 1_000_000
#: Keys with a share of all rows of at least one in so many are frequent; there are no more than that.
FREQUENT = 10_000
#: Words of so many letters are 26 + 26^2 + 26^3 at most.
SHORT_WORD = 3


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty without ://."""
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule fits its host and the subdomains of it if the
    path starts with its path. The list is a parameter and becomes part of the plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _pieces(text: Column) -> Column:
    """Runs of letters a-z, each once as often as it occurs."""
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: w != "")


def unigrams(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """(word, n): words a-z of all page texts, tags, scripts and styles left out."""
    plain = F.regexp_replace(F.col(html_column).cast("string"),
                             r"(?s)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>", " ")
    words = pages.select(F.explode(_pieces(plain)).alias("word")).where(F.length("word") <= LONGEST_WORD)
    return words.groupBy("word").agg(F.count("*").alias("n"))


def viterbi(piece: str, known: Sequence[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest split of a piece into words. known: (start, end, count). A stretch of L letters that no word covers
    counts as a word with a chance of 1 in total x 10^L; of equal splits the one with the longer last word wins."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    ending: dict[int, list[tuple[int, int]]] = {}
    for start, end, count in known:
        ending.setdefault(end, []).append((start, count))
    for end in range(1, len(piece) + 1):
        choices = {s: -math.log(total) - (end - s) * math.log(10) for s in range(max(0, end - LONGEST_WORD), end)}
        choices.update({s: math.log(c / total) for s, c in ending.get(end, ())})
        best.append(max(((best[s][0] + chance, -s) for s, chance in choices.items())))
        best[-1] = (best[-1][0], -best[-1][1])
    out, at = [], len(piece)
    while at:
        out.append(piece[best[at][1]:at])
        at = best[at][1]
    return out[::-1]


def segmented(pieces: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(piece, words) for distinct pieces. Only words that are part of a piece meet it, by a join on the word."""
    spots = pieces.select("piece", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("start"))
    spots = spots.select("piece", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("piece") - F.col("start") + 1))).alias("size"))
    spots = spots.withColumn("word", F.substring(F.col("piece"), F.col("start"), F.col("size")))
    short = F.length("word") <= SHORT_WORD         # every piece has them, and they are few: sent to the tasks
    found = spots.where(short).join(F.broadcast(counts.where(short)), "word").unionByName(
        spots.where(~short).join(counts.where(~short), "word"))
    met = found.groupBy("piece").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("s"), (F.col("start") - 1 + F.col("size")).alias("e"), "n"))
        .alias("known"))
    rows = pieces.join(met, "piece", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                words = [viterbi(p, [(k["s"], k["e"], k["n"]) for k in known or ()], total)
                         for p, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, type=pa.list_(pa.string()))],
                                                 names=["piece", "words"])

    return rows.select("piece", "known").mapInArrow(run, "piece string, words array<string>")


def meet(rows: DataFrame, facts: DataFrame, on: Sequence[str], times: str) -> DataFrame:
    """Inner join of rows with facts, one for each key; `times` counts the rows of a key. Facts of frequent keys, at most
    FREQUENT, are sent to the tasks, so no key gathers its rows in one task; the other keys meet by a shuffle."""
    total = facts.agg(F.sum(times).alias("n")).first()["n"] or 0
    frequent = F.col(times) * FREQUENT >= total
    often, seldom = F.broadcast(facts.where(frequent).drop(times)), facts.where(~frequent).drop(times)
    rest = rows.join(F.broadcast(facts.where(frequent).select(*on)), list(on), "left_anti")
    return rows.join(often, list(on)).unionByName(rest.join(seldom, list(on)))


def rule_words(rules: Sequence[tuple[str, str, str]]) -> list[str]:
    return sorted({w for host, path, _ in rules for w in re.split("[^a-z]+", (host + path).lower()) if w})


def _sum(frame: DataFrame, *columns: str) -> list[int]:
    return [int(v or 0) for v in frame.agg(*[F.sum(c) for c in columns]).first()]


def judged(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
           rules: Sequence[tuple[str, str, str]] = RULES, seeds: Sequence[str] = SEED_WORDS) -> DataFrame:
    """(id, host, path, rule, verdict, block_odds), one row for each row of `pages`.

    Where no rule fits, naive Bayes decides: letters of host and path are split into words by the unigrams of all page
    texts and the seeds. Examples to block are the urls that a rule blocks, examples to allow all others. A word of a host
    is one example, shared over the classes as the distinct urls of the host that hold it are, so a host of many pages
    has no more say than others. A host never judges itself: its own examples are taken out of the counts of its words.
    Words that the rules name don't count, as they would only repeat the rules. block_odds is the log odds of blocking,
    for all urls, with or without a rule. A null url or one without :// has an empty host and path, and is judged by the
    prior alone. Repeated rows and null ids come back as they are.
    """
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    urls = pages.select(pages[id_column].alias("__id"), host_of(pages[url_column]).alias("host"),
                        path_of(pages[url_column]).alias("path"))
    bad = F.when(says == "block", 1).otherwise(0)
    distinct = lasting(urls.groupBy("host", "path").agg(F.count("*").alias("times"))
                       .select("host", "path", "times", bad.alias("bad")))
    own = F.filter(F.concat(_pieces(F.col("host")), _pieces(F.col("path"))), lambda w: ~w.isin(rule_words(rules)))
    tokens = distinct.select("host", "path", "bad", F.explode(own).alias("piece"))
    seeded = pages.sparkSession.createDataFrame([(w, SEED_COUNT) for w in seeds], "word string, n long")
    counts = lasting(unigrams(pages, html_column).unionByName(seeded).groupBy("word").agg(F.sum("n").alias("n")))
    pieces = lasting(tokens.groupBy("piece").agg(F.count("*").alias("times")))
    words = lasting(segmented(pieces, counts, max(1, *_sum(counts, "n"))).join(pieces, "piece"))
    spoken = meet(tokens, words, ["piece"], "times").select("host", "path", "bad", F.explode("words").alias("word"))

    examples = lasting(spoken.groupBy("host", "word").agg(F.count("*").alias("times"), F.sum("bad").alias("bad"))
                       .withColumn("own_bad", F.expr(f"{PARTS} * bad div times")))
    shared = examples.select("word", F.lit(1).alias("hosts"), F.col("own_bad").alias("bad"),
                             (PARTS - F.col("own_bad")).alias("good"))
    prior_examples = seeded.select("word", F.lit(0).alias("hosts"), F.lit(SEED_HOSTS * PARTS).cast("long").alias("bad"),
                                   F.lit(0).cast("long").alias("good"))
    model = lasting(shared.unionByName(prior_examples).groupBy("word").agg(
        F.sum("hosts").alias("hosts"), F.sum("bad").alias("all_bad"), F.sum("good").alias("all_good")))
    n_bad, n_good = (n / PARTS + 1 for n in _sum(model, "all_bad", "all_good"))
    share = n_bad / (n_bad + n_good)
    others_bad = (F.col("all_bad") - F.col("own_bad")) / PARTS
    others_good = (F.col("all_good") - (PARTS - F.col("own_bad"))) / PARTS
    odds = (F.log(others_bad + SMOOTHING * share) - F.log(others_good + SMOOTHING * (1 - share))
            - math.log(n_bad / n_good)).alias("odds")
    by_host = lasting(meet(examples.select("host", "word", "times", "own_bad"), model, ["word"], "hosts")
                      .select("host", "word", "times", odds))
    scored = meet(spoken.select("host", "path", "word"), by_host, ["host", "word"], "times").groupBy("host", "path").agg(
        F.sum("odds").alias("odds"))

    hosts = distinct.groupBy("host").agg(F.expr(f"{PARTS} * sum(bad) div count(*)").alias("bad"))
    bad_hosts, = _sum(hosts, "bad")
    prior = math.log((bad_hosts / PARTS + 1) / (hosts.count() - bad_hosts / PARTS + 1))
    known = lasting(distinct.select("host", "path", "times").join(scored, ["host", "path"], "left").select(
        "host", "path", "times", (F.coalesce("odds", F.lit(0.0)) + prior).alias("block_odds")))
    by_model = F.when(F.col("block_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return meet(urls, known, ["host", "path"], "times").select(
        F.col("__id").alias(id_column), "host", "path", rule.alias("rule"), F.coalesce(says, by_model).alias("verdict"),
        "block_odds")
