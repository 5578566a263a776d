"""Whitening, the join on n-grams and the Merkle manifest."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from brute import lower
from tallybank.llm import merkle, ngram_join, queries, spectrum, whitening
from tallybank.llm.registry import QUERIES, SQL
from tools.check_sql import rows_of

assert queries


# --- eigenpairs and whitening ------------------------------------------------------------------

@pytest.mark.parametrize("values", [[3, 3, 3, 1, 1, 0, 0], [1, 1 + 1e-12, 1 - 1e-13, .5], [5] * 40, [1, 1e-3, 1e-6, 1e-9, 1e-13], [2]])
def test_slices_find_eigenpairs_and_their_numbers(values):
    size = len(values)
    turn = np.linalg.qr(np.random.default_rng(4).standard_normal((size, size)))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = spectrum.leading(matrix, 32, 1e-11 * np.trace(matrix))
    want = [v for v in sorted(values, reverse=True) if v > 1e-10][:32]
    assert np.abs(found - want).max() < 1e-12 * size and np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * size


def test_counts_of_eigenvalues():
    matrix = np.random.default_rng(1).standard_normal((30, 30))
    matrix += matrix.T
    values = np.linalg.eigvalsh(matrix)
    assert all(spectrum.count_above(matrix, s) == (values > s).sum() for s in np.linspace(-15, 15, 60))
    assert spectrum.count_above(np.array([[0., 1], [1, 0]]), 0.0) == 1 and spectrum.count_above(np.zeros((3, 3)), 0.0) == 0


def whitened_plainly(vectors, components=32):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviations = [int(d) for d in ((n * x - sums) ** 2).sum(axis=1)]
    y = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x], dtype=float)
    cov = y.T @ y / n
    values, turn = (a[..., ::-1] for a in np.linalg.eigh(cov))
    keep = [i for i in range(min(components, len(values))) if values[i] > 1e-11 * np.trace(cov)]
    return deviations, y @ turn[:, keep] / np.sqrt(values[keep]), values[keep] / np.trace(cov)


def test_whitening_as_by_dense_eigenvectors(spark, small):
    rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}
    deviations, white, explained = whitened_plainly(list(rows.values()))
    got = collections.defaultdict(dict)
    for r in QUERIES["op11_embedding_whitening"](spark, small).collect():
        got[r["vec_id"]][r["component"]] = r
    assert got.keys() == rows.keys()
    table = np.array([[got[i][c + 1]["whitened"] for c in range(white.shape[1])] for i in rows])
    sign = np.sign((table * white).sum(axis=0))
    assert np.abs(table * sign - white).max() < 1e-6
    assert [got[i][1]["deviation"] for i in rows] == deviations and {r["n"] for g in got.values() for r in g.values()} == {len(rows)}
    first = next(iter(got.values()))
    assert np.abs([first[c + 1]["explained"] - e for c, e in enumerate(explained)]).max() < 1e-10 and first[1]["identity_error"] < 1e-8


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (2, None), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 1.0]), (5, [1.0, inf, 1.0]), (6, []), (7, [1.0, 2.0]),
            (None, [4.0, -5.0, 6.0]), (8, [0.0, 0.0, 3.0]), (8, [0.0, 0.0, 3.0]), (9, [2.0, 1.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS n", "1 AS component").repartition(3)
    got = whitening.whiten(frame).collect()
    usable = [v for _, v in rows if v and len(v) == 3 and None not in v and np.isfinite(v).all()]
    deviations, white, _ = whitened_plainly(usable)
    assert collections.Counter(r["vec_id"] for r in got if r["component"] == 1) == {1: 1, None: 1, 8: 2, 9: 1}
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviations)
    for c in range(white.shape[1]):
        mine = sorted(r["whitened"] for r in got if r["component"] == c + 1)
        assert min(np.abs(np.array(mine) - sorted(s * white[:, c])).max() for s in (1, -1)) < 1e-9
    assert whitening.whiten(frame.where("false")).count() == 0 and whitening.whiten(frame.where("vec_id = 8")).count() == 0


def test_whitening_of_large_entries_is_exact(spark):
    rows = [(i, [float(10 ** 12 * (i % 3)), float(i)]) for i in range(7)] + [(7, [3e38, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    got = {r["vec_id"]: r for r in whitening.whiten(frame.where("vec_id < 7")).where("component = 1").collect()}
    deviations, _, _ = whitened_plainly([v for _, v in frame.where("vec_id < 7").orderBy("vec_id").collect()])
    assert [int(got[i]["deviation_exact"]) for i in range(7)] == deviations and got[1]["deviation"] is None
    assert whitening.whiten(frame).count() == 8  # beside such an entry the second component is rounding


# --- n-gram join -------------------------------------------------------------------------------

def grams(text):
    words = lower(text).encode().split()
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def similar_plainly(rows):
    sets, parent = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    holders = collections.defaultdict(list)
    for i, held in enumerate(sets):
        for g in held:
            holders[g].append(i)
    for i, held in enumerate(sets):
        for j, both in collections.Counter(j for g in held for j in holders[g] if j > i).items():
            if 100 * both >= 80 * (len(held) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)].append(key)
    return sorted(((key, len(sets[i]), min(least[find(i)], default=None)) for i, (key, _) in enumerate(rows)), key=str)


def triples(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_similar_documents_as_by_all_pairs(spark, small, texts):
    assert triples(QUERIES["op12_ngram_jaccard_join"](spark, small)) == similar_plainly(list(texts.items()))


@pytest.mark.parametrize("block", [1 << 21, 300])
def test_groups_of_near_copies_chains_and_odd_rows(spark, monkeypatch, odd_docs, no_docs, block):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", block)
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):  # a group of near copies: many pairs link, many do not
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(120)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(f"c{j}" for j in range(5 * i, 5 * i + 80))) for i in range(12)]          # a chain
    rows += [(300 + i, " ".join(base[:60] + [f"u{i}_{j}" for j in range(200)])) for i in range(20)]      # a shared passage only
    rows += [(400, "A b C"), (401, "a B c"), (402, "a b"), (403, ""), (404, None), (405, " \n"), (None, "a b c"), (None, base[0]), (406, "a b c"),
             (406, "a b c"), (407, "one two three four five"), (408, "one two three four five one two three four five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert triples(ngram_join.similar_documents(docs)) == similar_plainly(rows)
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert triples(ngram_join.similar_documents(odd_docs)) == similar_plainly(odd) and ngram_join.similar_documents(no_docs).count() == 0


def test_hashes_of_words_tell_texts_apart():
    a, b, c, d, e = ngram_join.shingle_sets(["a b", "A\tb ", "ab", None, "é a b c d e f"])
    assert a.tolist() == b.tolist() != c.tolist() and not len(d) and len(e) == 3
    many = list(ngram_join.shingle_sets([f"{i:x}" for i in range(200_000)], 1))
    assert len(np.unique(np.concatenate(many))) == 200_000


# --- Merkle manifest ---------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_plainly(rows):
    def framed(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def climb(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, at):
        for level in levels[:-1]:
            run = level[at // 16 * 16:at // 16 * 16 + 16]
            yield run[:at % 16], run[at % 16 + 1:]
            at //= 16
    leaves = collections.defaultdict(list)
    for doc, source, lang, n, text in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        other = lower(text) if hit and text is not None else text
        leaf, changed = (sha(*map(framed, (doc, source, lang, n, t))) for t in (text, other))
        leaves[source].append((doc is not None, doc or 0, leaf, changed, doc))
    order = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(leaves[s])]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for at, (_, _, leaf, changed, doc) in enumerate(sorted(leaves[s])):
            steps = [*path(trees[s], at), *path(top, place)]
            node = changed
            for before, after in steps:
                node = sha(*before, node, *after)
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], sha(*(d for b, a in steps for d in b + a)), node, node == top[-1][0]))
    return sorted(out, key=str)


def proofs(docs):
    return sorted(map(tuple, merkle.tamper_check(docs).collect()), key=str)


def test_manifest_as_by_sql(spark, small):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    result = db.execute(SQL["op13_merkle_manifest"])
    frame = QUERIES["op13_merkle_manifest"](spark, small)
    assert rows_of(frame.columns, frame.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_manifest_of_trees_of_all_heights(spark):
    rows = [(i, source, "en", None, f"Text {i} É") for source, n in (("a", 1), ("b", 16), ("c", 17), ("é", 300), (None, 3), ("", 2), ("-", 1))
            for i in range(n)] + [(i, f"s{i}", None, i, None) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id int, source string, lang string, n_chars int, text string").repartition(7)
    got = proofs(docs)
    assert got == manifest_plainly(rows) and {g[-1] for g in got} == {True, False}


def test_manifest_of_one_row_and_of_odd_rows(spark, odd_docs, no_docs):
    one = spark.createDataFrame([(7, "s", None, 1, "x")], "doc_id int, source string, lang string, n_chars int, text string")
    assert proofs(one) == manifest_plainly([(7, "s", None, 1, "x")]) and proofs(no_docs) == []
    rows = [tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in odd_docs.collect()]
    assert proofs(odd_docs) == manifest_plainly(rows)
