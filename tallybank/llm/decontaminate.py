"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact verification."""

from __future__ import annotations

import math
import string
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import filter_texts, flat_map_texts, lasting

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: At similarity 0.8 two windows differ in about 10 of 64 bits, with a deviation of 3.
RADIUS = 20
#: One block more than the radius: whatever 20 bits differ, some block is the same.
BLOCKS = RADIUS + 1
#: Words of benchmark items that are sent to the tasks at a time; more items are searched in further rounds.
ROUND_WORDS = 1_000_000

_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
_FILTER_BITS = 20
_WINDOWS = 512


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case, parted at ASCII white space and punctuation; null texts have none."""
    return text.lower().encode().translate(_PLAIN).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Rolling hash of each run of five words."""
    n = len(hashes) - SHINGLE_WORDS + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for i in range(1, SHINGLE_WORDS):
        out = out * _BASE + hashes[i:n + i]
    return out


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the words in the windows: a bit is set if it is set in over half the word hashes."""
    out = []
    for at in range(0, len(starts), _WINDOWS):
        held = np.ascontiguousarray(hashes[starts[at:at + _WINDOWS, None] + np.arange(size)])
        bits = np.unpackbits(held.view(np.uint8), bitorder="little").reshape(len(held), size, 64)
        out.append(np.packbits(2 * bits.sum(axis=1, dtype=np.int32) > size, axis=1, bitorder="little").view("<u8")[:, 0])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingle_counts(words: list[bytes]) -> Counter:
    return Counter(zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False))


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity; a shingle weighs as often as it occurs."""
    both = sum((a & b).values())
    return both / (a.total() + b.total() - both)


def least_shared(n: int, similarity: float, other: int | None = None) -> int:
    """Shingles that two texts of n shingles, or of n and another number, share at least at that similarity."""
    return math.ceil((n + (n if other is None else other)) * similarity / (1 + similarity) - 1e-9)


class Index:
    """Items of one round: their fingerprints by size and block, and their shingles."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY):
        self.similarity = similarity
        self.ids, self.words, self.counts = [], [], []
        self.blocks: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        hashes, owners, prints = [], [], []
        for item_id, text in items:
            words = plain_words(text)
            if len(words) < SHINGLE_WORDS:
                continue
            number = len(self.ids)
            self.ids.append(item_id)
            self.words.append(words)
            self.counts.append(shingle_counts(words))
            own = word_hashes(words)
            prints.append(window_fingerprints(own, np.zeros(1, dtype=np.int64), len(words))[0])
            hashes.append(np.unique(shingle_hashes(own)))
            owners.append(np.full(len(hashes[-1]), number))
            for block in range(BLOCKS):
                self.blocks[len(words), block, self._part(int(prints[-1]), block)].append(number)
        self.prints = np.array(prints, dtype=np.uint64)
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.needs = np.array([least_shared(n - SHINGLE_WORDS + 1, similarity) for n in self.sizes], dtype=np.int64)
        all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        order = np.argsort(all_hashes, kind="stable")
        self.owners = (np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64))[order]
        self.shingles, self.first = np.unique(all_hashes[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.maybe[(self.shingles >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    @staticmethod
    def _part(fingerprint: int, block: int) -> int:
        return (fingerprint >> _SHIFTS[block]) & ((1 << (_SHIFTS[block + 1] - _SHIFTS[block])) - 1)

    def _hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of shingles that are in some item, and their numbers."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.shingles, hashes[at]), len(self.shingles) - 1)
        found = self.shingles[place] == hashes[at]
        return at[found], place[found]

    def near(self, size: int, fingerprint: int) -> list[tuple[int, int]]:
        """(item, bits) of all items of that size whose fingerprint differs in at most RADIUS bits."""
        met = {i for b in range(BLOCKS) for i in self.blocks.get((size, b, self._part(fingerprint, b)), ())}
        bits = [(i, int(self.prints[i] ^ np.uint64(fingerprint)).bit_count()) for i in sorted(met)]
        return [(i, d) for i, d in bits if d <= RADIUS]

    def _needs_of_short(self, n: int) -> np.ndarray:
        """What a text of n shingles shares at least with each item of more words."""
        sizes = self.sizes - SHINGLE_WORDS + 1
        least = np.ceil((sizes + n) * self.similarity / (1 + self.similarity) - 1e-9).astype(np.int64)
        return np.where(sizes > n, least, self.needs)

    def search(self, text: str | None) -> list[tuple]:
        """(item_id, start_word, n_words, distance, similarity): for each item found, its most similar window, the
        first of equal ones. A text with fewer words than the item is one window.

        A window as similar as asked shares `least_shared` shingles with its item, so only windows with that many
        shingles of the benchmark get a fingerprint; no window that could pass is left out by this.
        """
        words = plain_words(text)
        if len(words) < SHINGLE_WORDS or not self.ids:
            return []
        hashes = word_hashes(words)
        positions, numbers = self._hits(shingle_hashes(hashes))
        if not len(positions):
            return []
        counts = self.first[numbers + 1] - self.first[numbers]
        offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        shared = np.bincount(self.owners[np.repeat(self.first[numbers], counts) + offsets], minlength=len(self.ids))
        running = np.zeros(len(words) - SHINGLE_WORDS + 2, dtype=np.int64)
        running[positions + 1] = 1
        running = np.cumsum(running)
        best: dict[int, tuple] = {}
        whole = len(words) - SHINGLE_WORDS + 1
        for size in np.unique(self.sizes[shared >= np.minimum(self.needs, self._needs_of_short(whole))]).tolist():
            width = min(size, len(words))
            n = width - SHINGLE_WORDS + 1
            needed = least_shared(n, self.similarity, size - SHINGLE_WORDS + 1)
            starts = np.flatnonzero(running[n:] - running[:-n] >= needed)
            for start, fingerprint in zip(starts.tolist(), window_fingerprints(hashes, starts, width).tolist(),
                                          strict=True):
                near = self.near(size, fingerprint)
                held = shingle_counts(words[start:start + width]) if near else None
                for item, distance in near:
                    alike = weighted_similarity(held, self.counts[item])
                    if alike >= self.similarity and alike > best.get(item, (0.0,))[0]:
                        best[item] = (alike, start, width, distance)
        return [(self.ids[i], start, size, distance, alike)
                for i, (alike, start, size, distance) in sorted(best.items())]


def _rounds(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[list[tuple]]:
    """Items in lists of bounded size; the driver holds one of them at a time."""
    held, size = [], 0
    rows = benchmark.select(item_column, F.col(text_column).cast("string")).where(F.col(text_column).isNotNull())
    for item_id, text in rows.toLocalIterator():
        held.append((item_id, text))
        size += 1 + len(text) // 2
        if size >= ROUND_WORDS:
            yield held
            held, size = [], 0
    yield held


_BUILT: dict[str, Index] = {}                    # in a Python worker: the index of the round it works on


def _index_maker(docs: DataFrame, items: list[tuple], similarity: float):
    """A function for tasks that gives the index of the items, built once in each worker."""
    sent, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def get() -> Index:
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = Index(sent.value, similarity)
        return _BUILT[name]
    return get


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_column: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, item_id, start_word, n_words, distance, similarity): every benchmark item found in every document.

    A window with as many words as the item, or the whole of a text with fewer, matches it if their fingerprints differ in at most RADIUS bits and the
    weighted similarity of their five-word shingles is `similarity` or more. One row for each row of `docs` and item,
    with the most similar window. Items and texts of fewer than five words, and null ones, match nothing; repeated rows
    and equal items are reported each. The items travel to the documents in rounds of bounded size, so the documents
    are never shuffled.
    """
    made = T.StructType([T.StructField("item_id", benchmark.schema[item_column].dataType),
                         T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType()),
                         T.StructField("distance", T.IntegerType()), T.StructField("similarity", T.DoubleType())])
    found, rounds = None, 0
    for items in _rounds(benchmark, item_column, item_text):
        if rounds and not items:
            break
        get = _index_maker(docs, items, similarity)

        def start(get=get):
            return lambda texts: map(get().search, texts)
        part = flat_map_texts(docs, [id_column], text_column, made, start)
        rounds += 1
        if rounds > 1:                          # rounds after the first end before the next one is sent
            part = lasting(part)
        found = part if found is None else found.unionByName(part)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
               item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns as they are, in which no benchmark item is found."""
    for items in _rounds(benchmark, item_column, item_text):
        if items:
            get = _index_maker(docs, items, similarity)

            def start(get=get):
                return lambda texts: [not get().search(t) for t in texts]
            docs = filter_texts(docs, text_column, start)
    return docs
