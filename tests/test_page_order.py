"""Pages in the order of their next links."""

import contextlib
import io
import random
import re

from pyspark.sql import functions as F

from tallybank.operators.page_order import absolute_url, next_links, number_questions, order_pages


def plan_text(frame, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()


def walked(links):
    """The same by turning one page after the other."""
    before = {}
    for url, after in sorted(links.items()):
        if after in links:
            before.setdefault(after, url)
    out, seen = {}, set()
    heads = sorted(u for u in links if u not in before)
    for head in [*heads, *sorted(links)]:
        at, place = head, 1
        while at not in seen:
            seen.add(at)
            after = links[at]
            ends = "last" if after is None else "dangling" if after not in links else "merged" if before[after] != at else None
            ends = "cycle" if ends is None and after == head else ends
            out[at] = (head, place, ends)
            if ends:
                break
            at, place = after, place + 1
    return out


def test_order_of_chains_cycles_and_odd_links(spark):
    rng = random.Random(7)
    links = {f"p{i}": f"p{i + 1}" for i in range(200)} | {"p200": None}
    links |= {f"c{i:02d}": f"c{(i + 1) % 33:02d}" for i in range(33)} | {"self": "self", "d0": "d1", "d1": "nowhere"}
    links |= {"a0": "a1", "a1": "a2", "a2": "a1", "z": "a1", "one": None}
    links |= {f"r{i}": rng.choice([None, "gone", f"r{rng.randrange(120)}"]) for i in range(120)}
    frame = spark.createDataFrame(list(links.items()), "url string, next string")
    got = {r["url"]: (r["notebook"], r["position"], r["ends"]) for r in order_pages(frame).collect()}
    assert got == walked(links)
    assert order_pages(frame.where("false")).count() == 0


def test_rounds_keep_planned_sizes_small(spark):
    # The planner's size of staged rows once squared in every round: 25 rounds of it make numbers of tens of MB.
    links = spark.range(100).selectExpr("format_string('p%04d', id) AS url", "IF(id % 50 = 49, format_string('p%04d', id - 49), format_string('p%04d', id + 1)) AS next")
    order = order_pages(links.unionByName(spark.range(100).selectExpr("format_string('q%04d', id) AS url", "format_string('q%04d', id + 1) AS next")))
    size = re.search(r"sizeInBytes=(\S+) (\S+?)[,)]", plan_text(order, "cost"))
    assert size and (size[2] in ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB") or float(size[1].replace("E+", "e")) < 1e80)
    rows = order.groupBy("notebook").agg(F.max("position").alias("n"), F.max("ends").alias("ends")).collect()
    assert sorted(map(tuple, rows)) == [("p0000", 50, "cycle"), ("p0050", 50, "cycle"), ("q0000", 100, "dangling")]


def test_pages_without_address_have_no_place(spark):
    frame = spark.createDataFrame([(None, "a"), ("a", "b"), ("b", None)], "url string, next string")
    assert sorted((r["notebook"], r["url"], r["position"]) for r in order_pages(frame).collect()) == [("a", "a", 1), ("a", "b", 2)]


def test_next_links_of_pages(spark):
    pages = [(1, "http://h/a/b?x=1", '<a href="q">no</a><a rel="next" href="?page=2">n</a><a rel=next href=z>'), (2, "u", "no links"),
             (3, "http://h/c", '<a class="btn next disabled" href="/d">'), (4, "http://h/a/b?x=1", "<a rel=next href=/later>"), (5, None, "<a rel=next href=x>"),
             (6, "http://h", '<a class="page-next" href="d#x">'), (7, "http://h/e", "<a rel=next>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r["url"]: r["next"] for r in next_links(frame).collect()} == {
        "http://h/a/b?x=1": "http://h/a/b?page=2", "u": None, "http://h/c": None, "http://h": "http://h/d", "http://h/e": None}


def test_addresses_of_links(spark):
    cases = [("x", "https://h.org/a/b?q", "https://h.org/a/x"), ("/x", "https://h.org/a/b", "https://h.org/x"), ("//o/x", "https://h.org/a", "https://o/x"),
             ("?p=2", "https://h.org/a?p=1", "https://h.org/a?p=2"), ("", "https://h.org/a?p=1#f", "https://h.org/a?p=1"), ("http://o/#y", "https://h.org", "http://o/"),
             ("x", "https://h.org", "https://h.org/x")]
    frame = spark.createDataFrame([(h, b, w) for h, b, w in cases], "h string, b string, w string")
    assert frame.where(absolute_url(F.col("h"), F.col("b")) != F.col("w")).collect() == []


def test_questions_are_numbered_over_pages(spark):
    order = order_pages(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None)], "url string, next string"))
    counts = spark.createDataFrame([("a", 3), ("c", 2)], "url string, questions int")
    got = sorted((r["url"], r["position"], r["questions"], r["before"]) for r in number_questions(order, counts).collect())
    assert got == [("a", 1, 3, 0), ("b", 2, 0, 3), ("c", 3, 2, 3)]
