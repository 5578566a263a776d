"""The order of a notebook's pages and questions, from the links to the next page.

A reader turns one page after the other. Here all pages of all notebooks find their place at once, by list ranking: each
page knows the page before it, and in each round every page takes over what the page it looks at knows, so the distance
it sees doubles. A chain of n pages is placed after log2(n) rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybank.operators.pages import read_anchors
from tallybank.sources.staging import staged

#: How the walk through a notebook goes on after a page: to a page, or it ends there.
LAST, DANGLING, CYCLE, MERGED = "last", "dangling", "cycle", "merged"


def absolute_url(href: Column, base: Column) -> Column:
    """Address that a link on the page ``base`` leads to, without its fragment."""
    href = F.regexp_replace(F.trim(href), "#.*$", "")
    host = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(F.length(bare) == F.length(host), F.concat(host, F.lit("/"))).otherwise(F.regexp_replace(bare, "[^/]*$", ""))
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^[^:]*:", 0), href))
            .when(href.startswith("/"), F.concat(host, href))
            .when(href == "", F.regexp_replace(base, "#.*$", ""))
            .when(href.startswith("?"), F.concat(bare, href)).otherwise(F.concat(folder, href)))


def next_links(pages: DataFrame) -> DataFrame:
    """(url, next) of pages (page_id, url, html): where the page's first link to a next page leads, null if there is none or
    it is disabled. Of several pages with one address the first by page_id counts."""
    one = pages.where("url IS NOT NULL").groupBy("url").agg(F.min_by("html", "page_id").alias("html"))
    turn = F.get(F.filter("read.links", lambda a: a["turn"]), F.lit(0))
    read = read_anchors(one).select("url", turn.alias("turn"))
    led = read.where(F.col("turn").isNotNull() & ~F.col("turn.off")).select("url", absolute_url(F.col("turn.href"), F.col("url")).alias("next"))
    return one.select("url").join(led, "url", "left")


def _placed(before: DataFrame, rounds: int) -> DataFrame:
    """(id, jump, far, steps, least) of pages (id, before): `far` is the furthest page known before a page and `steps` the
    distance; `jump` stays set only in cycles, where `least` is the least page.

    At most one page looks at a page, so a round is one aggregate that brings both together. Staged rows keep the size that
    the planner worked out for them: it takes the product of both sides of a join, and numbers that square in every round
    outgrow the driver, where those of an aggregate only double.
    """
    state = staged(before.select("id", F.col("before").alias("jump"), F.coalesce("before", "id").alias("far"),
                                 F.col("before").isNotNull().cast("long").alias("steps"), F.least("id", "before").alias("least")))
    fields, left = ("jump", "far", "steps", "least"), None
    for done in range(rounds):
        still = state.where("jump IS NOT NULL").count()
        # While a chain is unfinished each round finishes some page, so what is left are cycles; they end when seen whole.
        if not still or (still == left and 1 << done >= still):
            break
        left = still
        own = state.select("id", F.struct(*fields).alias("own"), F.lit(None).cast("struct<id:bigint,steps:bigint,least:bigint>").alias("asks"))
        asking = state.where("jump IS NOT NULL").select(
            F.col("jump").alias("id"), F.lit(None).cast(own.schema["own"].dataType).alias("own"), F.struct("id", "steps", "least").alias("asks"))
        met = own.unionByName(asking).groupBy("id").agg(
            *[F.max(f"own.{c}").alias(c) for c in fields], *[F.max(f"asks.{c}").alias(f"their_{c}") for c in ("id", "steps", "least")])
        finished = F.when(F.col("jump").isNull(), F.struct("id", *fields))
        moved = F.when(F.col("their_id").isNotNull(), F.struct(
            F.col("their_id").alias("id"), "jump", "far", (F.col("their_steps") + F.col("steps")).alias("steps"),
            F.least("their_least", "least").alias("least")))
        state = staged(met.select(F.inline(F.array_compact(F.array(finished, moved)))))
    return state


def order_pages(links: DataFrame) -> DataFrame:
    """(notebook, url, position, ends) of pages (url, next), one row for each address.

    A notebook is named by its first page, to which no page leads; positions count from 1. `ends` says why the walk stops
    after a page, else it is null: the page is the `last`, its link is `dangling` (no such page is there), it closes a
    `cycle`, or it is `merged`: its next page follows another page too, the one with the least address, and stands in that
    one's notebook. A cycle is cut before its least address.
    """
    # Pages are numbered in the order of their addresses, so that the rounds move whole numbers only.
    pages = staged(links.where("url IS NOT NULL").groupBy("url").agg(F.min("next").alias("next")).orderBy("url").withColumn("id", F.monotonically_increasing_id()))
    rounds = max(pages.count() - 1, 1).bit_length() + 1
    led = staged(pages.join(pages.select(F.col("url").alias("next"), F.col("id").alias("next_id")), "next", "left").select(
        "id", "next_id", F.col("next").isNotNull().alias("leads")))
    before = led.where("next_id IS NOT NULL").groupBy(F.col("next_id").alias("id")).agg(F.min("id").alias("before"))
    chain = staged(led.select("id").join(before, "id", "left"))
    placed = _placed(chain, rounds)
    cycles = placed.where("jump IS NOT NULL").select("id", "least")
    cut = chain.join(cycles, "id").select("id", F.when(F.col("id") != F.col("least"), F.col("before")).alias("before"))
    inside = _placed(cut, rounds)
    places = placed.where("jump IS NULL").withColumn("round", F.lit(False)).unionByName(inside.withColumn("round", F.lit(True)))
    follows = chain.where("before IS NOT NULL").select(F.col("id").alias("next_id"), F.col("before").alias("follows"))
    ends = led.join(follows, "next_id", "left").select("id", "next_id", "leads", "follows")
    found = places.join(ends, "id").select(
        "id", F.col("far").alias("first"), (F.col("steps") + 1).alias("position"),
        F.when(~F.col("leads"), LAST).when(F.col("next_id").isNull(), DANGLING)
        .when(F.col("follows") != F.col("id"), MERGED)
        .when(F.col("round") & (F.col("next_id") == F.col("far")), CYCLE).alias("ends"))
    names = pages.select(F.col("id").alias("first"), F.col("url").alias("notebook"))
    return found.join(pages.select("id", "url"), "id").join(names, "first").select("notebook", "url", "position", "ends")


def number_questions(order: DataFrame, counts: DataFrame) -> DataFrame:
    """The ordered pages with `questions`, their number of questions from (url, questions), and `before`, the number of those
    on earlier pages of the notebook. A window runs over pages, not over questions."""
    earlier = Window.partitionBy("notebook").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return order.join(counts, "url", "left").withColumn("questions", F.coalesce("questions", F.lit(0)).cast("long")).withColumn(
        "before", F.coalesce(F.sum("questions").over(earlier), F.lit(0)))
