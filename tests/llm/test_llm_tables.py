"""Operators that bring several tables or rows together, and the pipeline."""

import collections
import itertools
import math
import random
import re
import zlib
from urllib.parse import urlsplit

import duckdb
import numpy as np
import pytest

import brute
import corpus_pipeline
from tallybank.llm import chunks, decontaminate, langid, license_texts, licenses, quality, queries, repetition, secret_scan, urls
from tallybank.llm.registry import QUERIES, SQL
from tools.check_sql import rows_of

assert queries


# --- licenses ----------------------------------------------------------------------------------

def test_licenses_as_by_sql(spark, small):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    result = db.execute(SQL["op2_license_scan"])
    frame = QUERIES["op2_license_scan"](spark, small)
    assert rows_of(frame.columns, frame.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_license_scan_runs_without_python(spark, small):
    plan = QUERIES["op2_license_scan"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_licenses_in_other_dress(spark):
    mit, isc = (next(t for n, t in licenses.KNOWN if n == name) for name in ("MIT", "ISC"))
    wrapped = "\n".join(re.findall(r".{1,50}(?:\s|$)", mit)).replace("sublicense", "sub-license")
    texts = ["Copyright (c) 2021 Some One <a@b.c>\n\n" + wrapped.upper(), "/* © 1999, 2003 Somebody */\n" + isc + "\n",
             mit.replace("free of charge", "for a charge"), "A text.\n  # licensed under the apache licence, version 2.0\nReleased under the MIT License!\n",
             None, "", "Copyright 2020 by Me\n", isc + " And more."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "'x' AS digest", "'y' AS license")
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan(docs).collect()}
    assert got == {0: ("MIT", ""), 1: ("ISC", "ISC"), 2: (None, ""), 3: (None, "Apache-2.0,MIT"), 4: (None, ""), 5: (None, ""),
                   6: (None, ""), 7: (None, "")}


def test_license_scan_of_odd_rows(odd_docs, no_docs):
    assert licenses.scan(odd_docs).count() == odd_docs.count() and licenses.scan(no_docs).count() == 0
    assert {r["license"] for r in licenses.scan(odd_docs, known=()).collect()} == {None}


def test_licenses_with_titles_and_whole_texts(spark):
    bsd2, isc, zero = (next(t for n, t in licenses.KNOWN if n == name) for name in ("BSD-2-Clause", "ISC", "0BSD"))
    bsd3 = next(t for n, t in licenses.KNOWN if n == "BSD-3-Clause")
    texts = license_texts
    head = "{}\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n{}\n"
    rows = [("BSD-3-Clause", head.format("BSD 3-Clause License", bsd3)), ("ISC", head.format("ISC License", isc)),
            ("BSD-3-Clause", head.format("New BSD License", re.sub(r"(?<= )\d\. ", "\n* ", bsd3))),
            ("0BSD", head.format("BSD Zero Clause License", zero)), ("BSD-2-Clause", head.format("", bsd2)),
            ("Apache-2.0", texts.APACHE_2_0.replace("[yyyy] [name of copyright owner]", "2020 Some One")),
            ("Apache-2.0", texts.APACHE_2_0.split("   APPENDIX")[0]), ("GPL-2.0", texts.GPL_2_0), ("GPL-3.0", texts.GPL_3_0.upper()),
            ("GPL-3.0", texts.GPL_3_0.split("END OF TERMS")[0]), ("LGPL-2.1", texts.LGPL_2_1), ("LGPL-3.0", texts.LGPL_3_0),
            ("MPL-2.0", "\r\n".join(texts.MPL_2_0.split("\n"))), ("CC0-1.0", texts.CC0_1_0), ("Unlicense", texts.UNLICENSE),
            (None, "Some title\n" + isc), (None, texts.MPL_2_0 + "More."), (None, "ISC License"), (None, "MIT")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id int, text string")
    got = {r["doc_id"]: tuple(r) for r in licenses.scan(docs).collect()}
    assert [got[i][2] for i in range(len(rows))] == [n for n, _ in rows]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id int, text string)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (_, t) in enumerate(rows)])
    assert {r[0]: r for r in db.execute(licenses.scan_sql()).fetchall()} == got


# --- quality -----------------------------------------------------------------------------------

def test_quality_of_held_out_rows(spark, small):
    got = {r["doc_id"]: r for r in QUERIES["op3_quality_classifier"](spark, small).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.7) for d, r in got.items())
    labels = [(r["quality"], got[r["doc_id"]]) for r in spark.read.parquet(f"{small}/labels.parquet").collect()]
    tested = [(q, r) for q, r in labels if r["held_out"]]
    good, bad = ([r["score"] for q, r in tested if q == v] for v in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.9
    assert np.mean([r["predicted"] == q for q, r in tested]) > 0.85


def test_quality_never_reads_held_out_labels(spark, documents, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality "
                               "ELSE quality END AS quality", "toxic")
    a, b = quality.fit(documents, labels), quality.fit(documents.withColumn("l_id", documents["doc_id"] * 0), turned)
    assert np.array_equal(a.weights, b.weights) and (a.slope, a.offset, a.bias) == (b.slope, b.offset, b.bias)


def test_descent_solves_the_dual():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(200)]
    labels = np.array([1 if 3 in r or 5 in r else -1 for r in rows])
    weights, bias = quality.descend(rows, np.ones(40), np.full(200, 1 / np.sqrt(8)), labels)
    assert np.mean(np.sign([weights[r].sum() / np.sqrt(8) + bias for r in rows]) == labels) > 0.95


def test_quality_without_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score(odd_docs, quality.fit(odd_docs, none)).collect()
    assert len(rows) == odd_docs.count() and {r["score"] for r in rows} == {0.5}
    odd = spark.createDataFrame([(i % 12, i % 2) for i in range(24)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(odd_docs, odd)
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd_docs, model).collect())
    assert quality.score(no_docs, model).count() == 0 and quality.fit(no_docs, odd).slope == 0
    assert model.score(None) == model.score("")


def test_sample_is_bounded(spark, monkeypatch):
    """An id on many rows has one in the sample, and labels without a document take no place."""
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 10)
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(i, f"t {i}") for i in range(2, 40)] + [(2, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    got = quality.sample(docs, labels).collect()
    assert len(got) == len({r["id"] for r in got}) == 10 and all(0 < r["id"] < 40 for r in got)
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 1000)
    got = quality.sample(docs, labels).collect()
    assert {r["id"] for r in got} == {i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_descent_equals_a_second_solver():
    """The dual optimum by projected gradient on all rows at once."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(80)]
    labels = np.array([1 if (3 in r) ^ (rng.random() < 0.1) else -1 for r in rows])
    ratios, scales = rng.normal(size=30), np.full(80, 0.4)
    x = np.zeros((80, 31))
    for i, r in enumerate(rows):
        x[i, r], x[i, 30] = ratios[r] * 0.4, 1.0
    gram = (x * labels[:, None]) @ (x * labels[:, None]).T
    cost = np.array([80 / (2 * (labels == y).sum()) for y in labels]) * quality.COST
    alpha = np.zeros(80)
    for _ in range(40_000):
        alpha = np.clip(alpha - (gram @ alpha - 1) / np.linalg.norm(gram, 2), 0, cost)

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - labels * (x @ w))).sum()
    weights, bias = quality.descend(rows, ratios, scales, labels)
    assert loss(np.append(weights, bias)) <= loss(x.T @ (alpha * labels)) * 1.01


# --- decontamination ---------------------------------------------------------------------------

def test_decontamination_as_by_brute_force(spark, small, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op4_decontamination"](spark, small).collect()}
    want = {(d, i): v for d, t in texts.items() for i, v in brute.window_matches(t, items).items()}
    assert got.keys() == want.keys() and len(want) > 0
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_changed_passages(texts):
    rng = random.Random(4)
    words = [w for t in list(texts.values())[:40] for w in t.split()]
    items = [(n, " ".join(rng.choice(words) for _ in range(size))) for n, size in enumerate((15, 30, 50, 60, 200))]
    index, seen = decontaminate.Index(items), 0
    for _ in range(60):
        n, text = rng.choice(items)
        own = text.split()
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(own))
            own[at:at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(3)
        around = [rng.choice(words) for _ in range(80)]
        whole = " ".join(around[:40] + own + around[40:]).upper()
        want = brute.window_matches(whole, items)
        assert {r[0]: pytest.approx(r[4]) for r in index.search(whole)} == want
        seen += len(want)
    assert seen > 20


def test_texts_shorter_than_the_item(spark, texts):
    rng = random.Random(5)
    words = [w for t in list(texts.values())[:40] for w in t.split()]
    items = [(n, " ".join(rng.choice(words) for _ in range(size))) for n, size in enumerate((15, 30, 50, 59, 200, 6))]
    index, seen = decontaminate.Index(items), 0
    for n, text in items:
        own = brute.plain_words(text)
        for cut in range(1, 12):
            for at in {0, len(own) - cut, len(own) // 2}:
                short = own[:at] + own[at + cut:]
                a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (own, short))
                got = {r[0]: r for r in index.search(" ".join(short))}
                if len(short) > 4 and len(a & b) / len(a | b) >= 0.8:
                    assert got[n][1:3] == (0, len(short)) and got[n][4] >= 0.8
                    seen += 1
                else:
                    assert n not in got
    assert seen > 40
    own = items[3][1].split()
    docs = spark.createDataFrame([(1, " ".join(own[:-1])), (2, " ".join(own[:30]))], "doc_id int, text string")
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()] == [(1, 3)]
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark).collect()] == [2]


def test_blocks_find_all_prints_in_the_radius():
    rng = random.Random(6)
    index = decontaminate.Index([(i, " ".join(f"a{rng.random()}" for _ in range(20))) for i in range(50)])
    size = len(index.words[0])
    for _ in range(50):
        probe = int(index.prints[rng.randrange(50)])
        for b in rng.sample(range(64), decontaminate.RADIUS):
            probe ^= 1 << b
        want = [(i, (int(p) ^ probe).bit_count()) for i, p in enumerate(index.prints)]
        assert index.near(size, probe) == [(i, d) for i, d in want if d <= decontaminate.RADIUS
                                           and len(index.words[i]) == size]


def test_decontamination_in_rounds(spark, small, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    whole = sorted(decontaminate.contaminated(documents, benchmark).collect(), key=str)
    monkeypatch.setattr(decontaminate, "ROUND_WORDS", 900)
    assert sorted(decontaminate.contaminated(documents, benchmark).collect(), key=str) == whole
    hit = {r["doc_id"] for r in whole}
    clean = decontaminate.keep_clean(documents, benchmark)
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == {r["doc_id"] for r in documents.collect()} - hit


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "The same text again and again in one more line."),
                                   (None, "the SAME text, again and again in one more line!"), (6, "word0x0 word1x1 word2x2 word3x3 word4x4 word5x5")],
                                  "item_id int, text string")
    got = collections.Counter((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(odd_docs, items).collect())
    assert got == {(5, 4): 3, (5, None): 3, (6, 4): 1, (6, None): 1, (7, 6): 1, (8, 6): 1}
    assert decontaminate.keep_clean(odd_docs, items).columns == odd_docs.columns
    assert decontaminate.contaminated(no_docs, items).count() == decontaminate.keep_clean(no_docs, items).count() == 0
    assert decontaminate.contaminated(odd_docs, items.where("false")).count() == 0
    assert decontaminate.keep_clean(odd_docs, items.where("false")).count() == odd_docs.count()


# --- chunks ------------------------------------------------------------------------------------

def test_passages_as_by_brute_force(spark, small, texts):
    places = collections.defaultdict(list)
    for doc, text in texts.items():
        ends = chunks.boundaries(text.encode()) if text else []
        raw, start = text.encode(), 0
        for end in ends:
            places[raw[start:end]].append((doc, len(raw[:start].decode()), len(raw[:end].decode())))
            start = end
    marked = collections.defaultdict(list)
    for found in places.values():
        if len({d for d, _, _ in found}) > 1:
            for doc, a, b in found:
                marked[doc].append((a, b, min(found)[0]))
    want = set()
    for doc, spans in marked.items():
        runs = []
        for a, b, first in sorted(spans):
            if runs and runs[-1][1] >= a:
                runs[-1] = (runs[-1][0], b, min(runs[-1][2], first))
            else:
                runs.append((a, b, first))
        want |= {(doc, a, b, f, f == doc) for a, b, f in runs if b - a >= chunks.PASSAGE_CHARS}
    got = QUERIES["op6_substring_dedup"](spark, small).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 0


def test_boundaries_resist_insertions(texts):
    text = max(texts.values(), key=len)
    plain = {tuple(d) for d in chunks.chunks_of(text)[2].tolist()}
    for at in (0, 1, len(text) // 3, len(text) - 5):
        moved = {tuple(d) for d in chunks.chunks_of(text[:at] + "zq inserted " + text[at:])[2].tolist()}
        assert len(plain - moved) <= 4
    assert chunks.boundaries(b"x" * 5000).max() == 5000 and np.diff(chunks.boundaries(b"x" * 5000)).max() <= chunks.LONGEST


def test_gear_hash_looks_at_its_window_only():
    codes = np.random.default_rng(1).integers(0, 256, 300).astype(np.uint8)
    table, hashes = chunks.gear_table().astype(object), chunks.gear_hashes(codes)
    for i in range(300):
        want = sum(int(table[codes[i - k]]) << k for k in range(min(chunks.WINDOW, i + 1))) % 2**32
        assert int(hashes[i]) == want


def test_every_passage_of_fifty_words_is_found(spark, texts):
    rng = random.Random(7)
    words = [w for t in list(texts.values())[:60] for w in t.split()]

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))
    passages = [some(51) for _ in range(60)]
    rows = [(2 * i + k, some(40) + ("\n" if k else " ") + p + " " + some(30)) for i, p in enumerate(passages) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = chunks.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["first_id"]) for r in got} == {(d, d - d % 2) for d, _ in rows}
    cut = {r["doc_id"]: len(r["text"]) for r in chunks.without_repeats(docs).collect()}
    assert all(cut[d] == len(t) if d % 2 == 0 else cut[d] < len(t) - 80 for d, t in rows)


def test_passages_of_odd_rows(odd_docs, no_docs):
    got = {(r["doc_id"], r["first_id"], r["is_first"]) for r in chunks.repeated_passages(odd_docs).collect()}
    assert got == {(7, 7, True), (8, 7, False)}
    out = chunks.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert chunks.repeated_passages(no_docs).count() == chunks.without_repeats(no_docs).count() == 0


def test_passages_within_documents(spark, small, texts):
    rng = random.Random(9)
    words = [w for t in list(texts.values())[:60] for w in t.split()]

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))
    passage, gaps = some(60), [some(30) for _ in range(4)]
    rows = [(1, gaps[0] + "\n" + passage + "\n" + gaps[1] + "\n" + passage + "\n" + gaps[2] + "\n" + passage), (2, gaps[3]),
            (2, gaps[3]), (None, (some(40) + "\n") * 3), (3, None), (4, "")]
    rows += rows[:1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS owner", "1 AS start")
    got = sorted(tuple(r) for r in chunks.all_passages(docs).collect())
    assert [(r[0], *r[3:]) for r in got] == [(1, 1, True, "within"), (1, 1, False, "within"), (1, 1, False, "within")]
    text = rows[0][1]
    at = [m.start() for m in re.finditer(re.escape(passage), text)]
    assert len(at) == 3 and all(abs(r[1] - a) < 130 and r[2] - r[1] > len(passage) - 200 for r, a in zip(got, at))
    out = chunks.without_repeats(docs).collect()
    assert [r["text"] for r in out if r["doc_id"] != 1].count(gaps[3]) == 2
    cut = [r["text"] for r in out if r["doc_id"] == 1]
    assert cut == [text[:got[1][1]] + text[got[1][2]:got[2][1]] + text[got[2][2]:]] * 2
    assert [r["text"] for r in out if r["doc_id"] is None] == [rows[3][1]]


def test_passages_of_both_scopes_as_by_brute_force(spark, small, texts):
    got = [tuple(r) for r in QUERIES["op6_substring_dedup_scopes"](spark, small).collect()]
    assert {r[:5] for r in got if r[5] == "across"} == {tuple(r) for r in QUERIES["op6_substring_dedup"](spark, small).collect()}
    want = set()
    for doc, text in texts.items():
        spans, start = [], 0
        for end in chunks.boundaries(text.encode()).tolist() if text else []:
            spans.append((start, end))
            start = end
        held = [text.encode()[a:b] for a, b in spans]
        for again, run in itertools.groupby(range(len(held)), lambda i: held.count(held[i]) > 1):
            run = list(run)
            a, b = (len(text.encode()[:p].decode()) for p in (spans[run[0]][0], spans[run[-1]][1]))
            if again and b - a >= chunks.PASSAGE_CHARS:
                want.add((doc, a, b, doc, not set(held[:run[0]]) & {held[i] for i in run}, "within"))
    assert {r for r in got if r[5] == "within"} == want and want and len(set(got)) == len(got)


# --- urls --------------------------------------------------------------------------------------

def judged_plainly(pages):
    """(host, path, rule, verdict, odds) of each page, by dictionaries."""
    def rule(host, path):
        fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    unigrams = collections.Counter({w: urls.SEED_COUNT for w in urls.SEED_WORDS})
    for _, html in pages:
        plain = re.sub(r"(?s)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>", " ", html or "")
        unigrams.update(w for w in re.split("[^a-z]+", plain.lower()) if w and len(w) <= urls.LONGEST_WORD)
    total = sum(unigrams.values())

    def words(host, path):
        for piece in re.split("[^a-z]+", host + " " + path.lower()):
            if piece and piece not in {"net", "example", "en", "com", "de", "org", "fr"}:
                known = [(i, j, unigrams[piece[i:j]]) for i in range(len(piece)) for j in range(i + 1, len(piece) + 1)
                         if piece[i:j] in unigrams]
                yield from urls.viterbi(piece, known, total)
    places = [(urlsplit(u).netloc.lower(), urlsplit(u).path) for u, _ in pages]
    held, at_host = {p: list(words(*p)) for p in places}, collections.defaultdict(list)
    for place, own in held.items():
        at_host[place[0]].append(rule(*place)[1] == "block")
        for w in own:
            at_host[place[0], w].append(rule(*place)[1] == "block")
    examples = {k: 1_000_000 * sum(v) // len(v) / 1_000_000 for k, v in at_host.items()}
    bad = collections.Counter({w: float(urls.SEED_HOSTS) for w in urls.SEED_WORDS})
    good = collections.Counter()
    for key, part in examples.items():
        if isinstance(key, tuple):
            bad[key[1]] += part
            good[key[1]] += 1 - part
    n_bad, n_good = sum(bad.values()) + 1, sum(good.values()) + 1
    share = n_bad / (n_bad + n_good)
    hosts = [v for k, v in examples.items() if isinstance(k, str)]
    prior = math.log((sum(hosts) + 1) / (len(hosts) - sum(hosts) + 1))
    out = []
    for host, path in places:
        odds = prior
        for w in held[host, path]:
            own = examples[host, w]
            odds += (math.log(bad[w] - own + share) - math.log(good[w] - (1 - own) + 1 - share) - math.log(n_bad / n_good))
        name, says = rule(host, path)
        out.append((host, path, name, says or ("block" if odds > 0 else "allow"), odds))
    return out


def test_urls_as_by_brute_force(spark, small):
    pages = {r["page_id"]: (r["url"], r["html"]) for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in QUERIES["op9_url_filter"](spark, small).collect()}
    assert got.keys() == pages.keys()
    for page, want in zip(pages, judged_plainly(list(pages.values())), strict=True):
        row = got[page]
        assert (row["host"], row["path"], row["rule"]) == want[:3] and row["block_odds"] == pytest.approx(want[4], abs=1e-6)
        assert row["verdict"] == want[3]


def test_url_words_are_learned_from_rules(spark, monkeypatch):
    """`fizz` is no seed; other hosts of that name are blocked by a rule, so a host that has it run together with another
    word is blocked too. A host's own pages don't judge it, and a word of many allowed hosts outweighs one seed."""
    monkeypatch.setattr(urls, "FREQUENT", 5)         # so that most keys meet by a shuffle here
    rows = [(i, f"s://fizz-n{c}.net/p") for i, c in enumerate("abcdefgh")]
    rows += [(20 + i, f"s://garden{c}.com/p") for i, c in enumerate("abcdefgh")] + [(30, "s://buzzfizz.com/"), (31, "s://onlyhere.com/x")]
    rows += [(32, "s://onlyhere.com/de/y"), (33, "s://cheapgarden.com/")] + [(34, "s://buzzfizz.com/")] * 50
    pages = spark.createDataFrame(rows, "page_id int, url string").selectExpr("*", "'fizz buzz garden only here' AS html")
    got = urls.judged(pages).collect()
    by = {r["page_id"]: r["verdict"] for r in got}
    assert len(got) == len(rows) and by[30] == by[34] == "block" and by[31] == by[32] == by[20] == by[33] == "allow"


def test_viterbi_is_the_best_of_all_splits():
    rng = random.Random(8)
    for _ in range(60):
        piece = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))
        counts = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))): rng.randrange(1, 500) for _ in range(6)}
        known = [(i, j, counts[piece[i:j]]) for i in range(len(piece)) for j in range(i + 1, len(piece) + 1) if piece[i:j] in counts]

        def chance(words):
            return sum(math.log(counts[w] / 1000) if w in counts else -math.log(1000) - len(w) * math.log(10) for w in words)
        splits = [[piece[a:b] for a, b in zip((0, *cuts), (*cuts, len(piece)))]
                  for n in range(len(piece)) for cuts in itertools.combinations(range(1, len(piece)), n)]
        assert chance(urls.viterbi(piece, known, 1000)) == pytest.approx(max(map(chance, splits)))


def test_odd_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://WWW.Example.NET?x=/en/"), (5, "a://b://c/d"), (6, "https://x.net/"),
            (7, "https://notnet/"), (8, "//x.org/fr/"), (9, "s://EXAMPLE.net/en/#f"), (9, "s://EXAMPLE.net/en/#f"), (None, "s://ä.org/fr/x"),
            (10, "s://cheapcasinopoker.example.com/"), (11, "s://" + "a" * 300 + ".com/"), (12, "x\n://h\n1/p\n2?q")]
    pages = spark.createDataFrame(rows, "page_id int, url string").selectExpr(
        "*", "'<p>the things are here and the page is good</p>' AS html", "'x' AS host", "'y' AS piece", "'z' AS word", "1 AS bad")
    got = urls.judged(pages).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert by[1] == by[2] == by[3] == by[8] == ("", "", None, "allow")
    assert by[4] == ("www.example.net", "", None, "allow") and by[5][:2] == ("b:", "//c/d") and by[6][2:] == ("net/", "block")
    assert by[7][2:] == (None, "allow") and by[9][2:] == ("example.net/en/", "allow") and by[None][2:] == ("org/fr/", "allow")
    assert by[10][3] == "block" and by[12][:2] == ("h\n1", "/p\n2")
    assert urls.judged(pages.where("false")).count() == 0


# --- languages ---------------------------------------------------------------------------------

def test_languages_as_by_brute_force(spark, small, documents):
    names, model = langid.text_model(langid.trigram_counts(documents))
    pages = langid.page_rows(spark.read.parquet(f"{small}/pages.parquet"))
    rows = pages.collect()
    got = {r["id"]: r for r in langid.identify(pages, names, model).collect()}
    evidence = [model[langid.buckets(r["text"])].astype(float).sum(axis=0) * langid.TEMPER for r in rows]
    vote = [int(np.argmax(e)) for e in evidence]

    def smoothed(counts, above):
        return (counts + langid.STRENGTH * above) / (counts.sum() + langid.STRENGTH)

    def votes(**same):
        out = np.zeros(len(names))
        for r, v in zip(rows, vote):
            out[v] += all(r[k] == x for k, x in same.items())
        return out
    base = (votes() + 1) / (votes() + 1).sum()
    said = np.full((len(names), len(names)), langid.SMOOTHING)
    for r, v in zip(rows, vote):
        if r["declared"] in names:
            said[names.index(r["declared"]), v] += 1
    said = np.log(said / said.sum(axis=0))
    for r, e, v in zip(rows, evidence, vote):
        suffix = smoothed(votes(suffix=r["suffix"]), base)
        domain = smoothed(votes(suffix=r["suffix"], domain=r["domain"]), suffix)
        own = votes(suffix=r["suffix"], domain=r["domain"], host=r["host"])
        own[v] -= 1
        posterior = e + np.log(smoothed(own, domain)) + (said[names.index(r["declared"])] if r["declared"] in names else 0)
        assert (got[r["id"]]["text_lang"], got[r["id"]]["lang"]) == (names[v], names[int(np.argmax(posterior))])
        assert got[r["id"]]["confidence"] == pytest.approx(1 / np.exp(posterior - posterior.max()).sum())


def test_languages_of_documents(spark, small, documents):
    got = {r["doc_id"]: r["lang"] for r in QUERIES["op10_language_id"](spark, small).collect() if r["doc_id"] is not None}
    right = [got[r["doc_id"]] == r["lang"] for r in documents.collect()]
    assert len(got) == len(right) and np.mean(right) > 0.98


def test_markup_and_host_decide_where_the_text_does_not(spark, documents):
    names, model = langid.text_model(langid.trigram_counts(documents))
    text = {r["lang"]: r["text"] for r in documents.orderBy("n_chars").collect()}
    rows = [(i, "http://a.example.de/x", f"<html lang='de-AT'><p>{text['de']}</p>") for i in range(30)]
    rows += [(100, "http://a.example.de/y", "<p>1 2 3</p>"), (101, "http://b.example.de/", ""), (102, None, "<HTML data-x=1 LANG=fr>"),
             (103, "http://a.example.de/z", f"<html lang=\"de\">{text['fr'] * 5}"), (None, None, None), (100, "http://a.example.de/y", "<p>1 2 3</p>")]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").selectExpr("*", "1 AS evidence", "2 AS vote")
    got = langid.identify(langid.page_rows(pages), names, model).collect()
    by = {r["id"]: r for r in got}
    assert len(got) == len(rows) and by[100]["lang"] == by[101]["lang"] == "de" and by[103]["lang"] == "fr"
    assert by[102]["declared"] == "fr" and by[None]["lang"] is not None and by[101]["text_lang"] is None
    assert 0 < by[101]["confidence"] < by[5]["confidence"] <= 1
    assert langid.identify(langid.page_rows(pages.where("false")), names, model).count() == 0
    assert {r["lang"] for r in langid.identify(langid.page_rows(pages), *langid.text_model(langid.trigram_counts(
        documents.where("false")))).collect()} == {None}


def test_languages_of_odd_rows(odd_docs, documents):
    names, model = langid.text_model(langid.trigram_counts(documents))
    rows = langid.identify(langid.document_rows(odd_docs), names, model).collect()
    assert len(rows) == odd_docs.count() and all(r["lang"] in names for r in rows)


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline_as_by_brute_force(spark, small, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {d: t for d, t in texts.items() if repetition.coverage(t).kept}
    kept = {d: kept[d] for d, _, c in brute.groups([(d, brute.fingerprint(t)) for d, t in kept.items()]) if d == c}
    kept = {d: t for d, t in kept.items() if not brute.window_matches(t, items)}
    other = brute.tokenizer()
    structured = secret_scan.Structured(sum(map(secret_scan.pair_counts, kept.values())))
    want = {}
    for d, t in kept.items():
        spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in filter(None, brute.base_secrets(t).split(","))))
        spans += [(a, b) for a, k, b in secret_scan.secrets_of(t, structured) if k == 3]
        out, at = "", 0
        for a, b in sorted(spans):
            if a >= at:
                out += t[at:a] + "[REDACTED]"
            at = max(at, b)
        want[d] = brute.ids_digest(other.encode_ordinary(out + t[at:]))
    got = QUERIES["pipeline"](spark, small).collect()
    assert {r["doc_id"]: r["ids_sha256"] for r in got} == want and len(got) == len(want) < len(texts)


def test_stages_keep_the_columns(spark, small, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, small)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() == docs.count()
