import collections
import itertools
import random

import numpy as np
import pytest

from brute import fingerprint, groups
from tallybank.llm import golay, simhash
from tallybank.llm.components import components


def triples(frame):
    return sorted(frame.select("doc_id", "fingerprint", "component_id").collect(), key=str)


def test_golay_neighbours_share_an_index():
    words = np.random.default_rng(3).integers(0, 1 << 23, 20_000)
    near = golay.near_indices(words)
    for bit in range(23):
        other = golay.near_indices(words ^ (1 << bit))
        assert (near[:, :1] == other).any(axis=1).all() and (other[:, :1] == near).any(axis=1).all()


def test_golay_indices_are_the_codewords_within_four_bits():
    rng = random.Random(1)
    for _ in range(20):
        word = rng.randrange(1 << 23)
        want = {(word ^ sum(1 << b for b in bits)) >> 11 for n in range(5) for bits in itertools.combinations(range(23), n)
                if golay.syndromes(np.array([word ^ sum(1 << b for b in bits)]))[0] == 0}
        assert {i for i in golay.near_indices(np.array([word]))[0].tolist() if i >= 0} == want


def signed(prints):
    return sorted(int(np.uint64(p).view(np.int64)) for p in prints)


def roots(spark, prints):
    got = {r["node"]: r["root"] for r in components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))).collect()}
    return {p: got.get(p, p) for p in prints}


@pytest.mark.parametrize("large", [2, 256])
def test_links_connect_all_within_three_bits(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE_KEY", large)
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for n in (1, 2, 3, 4, 5, 6):
            q = p
            for b in rng.sample(range(64), n):
                q ^= 1 << b
            prints.add(q)
    prints = signed(prints)
    pairs = [(a, b) for a, b in itertools.combinations(prints, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    want = {p: p for p in prints}
    for _ in range(10):
        for a, b in pairs:
            want[a] = want[b] = min(want[a], want[b])
    assert roots(spark, prints) == want and len(pairs) > 100
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).selectExpr("id AS fp"), max_bits=4)


def test_a_dense_group_makes_few_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE_KEY", 64)
    rng = random.Random(9)
    base, loose = rng.getrandbits(64), rng.sample(range(64), 14)
    prints = set()
    while len(prints) < 3000:
        q = base
        for b in rng.sample(loose, rng.randrange(8)):
            q ^= 1 << b
        prints.add(q)
    prints = signed(prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = simhash.links(frame).count()
    words = np.array(prints).view(np.uint64)
    pairs = sum(int((np.bitwise_count(words[i + 1:] ^ w) <= 3).sum()) for i, w in enumerate(words))
    assert set(roots(spark, prints).values()) == {min(prints)} and found < pairs / 2, (found, pairs)


def loose_group(size):
    """Fingerprints of near copies of one text: 120 words, of which 1 to 3 are changed."""
    rng = random.Random(size)
    base, prints = [f"w{rng.randrange(5000)}".encode() for _ in range(120)], set()
    while len(prints) < size:
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(120)] = f"x{rng.randrange(10 ** 6)}".encode()
        prints.add(simhash.fingerprint(words))
    return np.array(sorted(prints))


@pytest.mark.parametrize("size", [1500, 3000])
def test_comparisons_in_a_loose_group(size):
    fps = loose_group(size)
    rows, keys = simhash._keys(fps)
    large = np.bincount(keys)[keys] >= simhash.LARGE_KEY
    pieces = simhash._pieces(fps[rows[large]], keys[large])
    cut = collections.defaultdict(list)
    for row, key, own in [*zip(rows[~large].tolist(), keys[~large].tolist(), itertools.repeat(-1)),
                          *((r, k, p) for r, k, ps in zip(rows[large].tolist(), keys[large].tolist(), pieces.tolist()) for p in ps)]:
        cut[key, own].append(fps[row])
    forest = simhash._Forest()
    compared = sum(simhash._connect(np.array(held), 3, forest) for held in cut.values())
    want = simhash._Forest()
    simhash._connect(fps, 3, want)
    assert [forest.root(f) for f in fps.tolist()] == [want.root(f) for f in fps.tolist()]
    print(size, compared, size * (size - 1) // 2)
    assert compared < 3 * size * (size - 1) // 2


def test_pieces_have_one_in_common():
    rng = random.Random(8)
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        fps = np.array([a, b], dtype=np.uint64).view(np.int64)
        rows, keys = simhash._keys(fps)
        pieces = simhash._pieces(fps[rows], keys)
        sides = [{(k, p) for k, ps in zip(keys[rows == i].tolist(), pieces[rows == i].tolist()) for p in ps} for i in (0, 1)]
        assert sides[0] & sides[1]


def test_an_id_with_two_texts_loses_no_group(spark):
    other = "quite another text that shares no word with the first one at all"
    rows = [(3, "one text of some words"), (5, "one text of some words"), (5, other), (9, other), (9, other), (None, other)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((tuple(r) for r in kept), key=str) == [(3, "one text of some words"), (5, other), (None, other)]
    twice = [(1, other)] * 5 + [(2, other)]
    kept = simhash.keep_one(spark.createDataFrame(twice, "doc_id long, text string").repartition(3)).collect()
    assert [tuple(r) for r in kept] == [(1, other)]


def test_components_of_paths_stars_and_rings(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (200, 202)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "lo long, hi long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{200 + i: 200 for i in range(3)}}
    assert components(spark.createDataFrame([], "lo long, hi long")).collect() == []


def test_documents_as_by_brute_force(documents, texts):
    got = triples(simhash.near_duplicates(documents))
    assert [tuple(r) for r in got] == sorted(groups([(d, fingerprint(t)) for d, t in texts.items()]), key=str)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], fingerprint(r["text"])) for r in odd_docs.select("doc_id", "text").collect()]
    got = triples(simhash.near_duplicates(odd_docs))
    assert [tuple(r) for r in got] == sorted(groups(rows), key=str)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays(odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [0, 3, 4, 5, 7, 9, 10, 11, 12, 13, 14] and ids.count(None) == 2
    assert simhash.keep_one(no_docs).count() == 0
