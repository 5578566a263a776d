"""Near-duplicate documents by SimHash fingerprints and Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm import golay
from tallybank.llm.common import free_name, lasting, lower_words_of, map_texts
from tallybank.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: The three parts of a fingerprint: shift and width. Each fits a Golay word of 23 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Pairs of parts. Three differing bits leave at most one of them in each part of some pair.
SEGMENT_PAIRS = ((0, 1), (0, 2), (1, 2))
#: Bits that name a key: the pair of parts and a codeword of each.
KEY_BITS = 26
#: Fingerprints under one key from which on it is cut into smaller ones by pieces of the third part.
LARGE_KEY = 1024
#: Three differing bits leave one of so many pieces the same.
PIECES = MAX_BITS + 1
_SLICE = 1 << 16


def fingerprint(words: list[bytes], shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash as a signed number: a bit is set if it is set in over half the shingle hashes."""
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = np.array(hashes[at:at + _SLICE], dtype="<u8").view(np.uint8)
        ones += np.add.reduce(np.unpackbits(part, bitorder="little").reshape(-1, 64), axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp) of every row; null and empty texts have fingerprint 0."""
    def start():
        return lambda texts: [(fingerprint(lower_words_of(t), shingle),) for t in texts]
    return map_texts(docs, [id_column], text_column, T.StructType([T.StructField("fp", T.LongType())]), start)


def _keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of a fingerprint, key), each once: for a pair of parts, the nearest codeword of one part with every near
    codeword of the other."""
    words = fps.view(np.uint64)
    near = [golay.near_indices(((words >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64)) for s, w in SEGMENTS]
    found = []
    for number, (a, b) in enumerate(SEGMENT_PAIRS):
        for first, second in ((near[a][:, :1], near[b]), (near[a], near[b][:, :1])):
            key = (np.int64(number) << 24) | (first << 12) | second
            rows = np.broadcast_to(np.arange(len(fps))[:, None], key.shape)
            valid = (first >= 0) & (second >= 0)
            found.append((rows[valid] << KEY_BITS) | key[valid])
    both = np.unique(np.concatenate(found))
    return both >> KEY_BITS, both & ((1 << KEY_BITS) - 1)


def _pieces(fps: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each fingerprint under a large key, `PIECES` numbers: a piece of the part that the key leaves out, with its place.
    Fingerprints within MAX_BITS have at least one number in common."""
    parts = np.array([[s, w] for pair in SEGMENT_PAIRS for s, w in (next(SEGMENTS[i] for i in range(3) if i not in pair),)])
    shift, width = parts[keys >> 24].T
    part = (fps.view(np.uint64) >> shift.astype(np.uint64)).astype(np.int64) & ((1 << width) - 1)
    cuts = [(i * width // PIECES, (i + 1) * width // PIECES) for i in range(PIECES)]
    return np.stack([(((part >> low) & ((1 << (high - low)) - 1)) << 2) | i for i, (low, high) in enumerate(cuts)], axis=1)


def _keyed(distinct: DataFrame, large: np.ndarray | None) -> DataFrame:
    """(fp, key) of distinct fingerprints; large keys (bits of `large`) with a piece of the third part in their upper bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = np.asarray(batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False), dtype=np.int64)
                rows, keys = _keys(fps)
                kept = fps[rows]
                if large is not None:
                    cut = (large[keys >> 3] >> (keys & 7).astype(np.uint8)) & 1 == 1
                    pieces = _pieces(kept[cut], keys[cut]) + 1
                    kept = np.concatenate([kept[~cut], np.repeat(kept[cut], PIECES)])
                    keys = np.concatenate([keys[~cut], (np.repeat(keys[cut], PIECES) | (pieces.ravel() << KEY_BITS))])
                yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(keys)], names=["fp", "key"])

    return distinct.select("fp").mapInArrow(run, "fp long, key long")


def large_keys(distinct: DataFrame) -> np.ndarray | None:
    """Bitmap of the keys with LARGE_KEY fingerprints or more, None if there are none. It has 2 ** KEY_BITS bits, so 8 MB
    whatever the input."""
    counts = _keyed(distinct, None).groupBy("key").count().where(F.col("count") >= LARGE_KEY)
    bits = counts.groupBy((F.col("key") / (1 << 15)).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("key") % (1 << 15)).alias("bits")).toArrow()
    if not bits.num_rows:
        return None
    whole = np.zeros((1 << KEY_BITS) // 8, dtype=np.uint8)
    for bucket, part in zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist(), strict=True):
        whole[bucket << 12:(bucket + 1) << 12] = np.frombuffer(part, dtype=np.uint8)
    return whole


class _Forest:
    """Roots of fingerprints that links connect: the least of each tree."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def root(self, node: int) -> int:
        above, path = self.above, []
        while (up := above.get(node, node)) != node:
            path.append(node)
            node = up
        for p in path:
            above[p] = node
        return node

    def link(self, a: int, b: int) -> None:
        a, b = sorted((self.root(a), self.root(b)))
        self.above[b] = a


def _connect(fps: np.ndarray, max_bits: int, forest: _Forest) -> int:
    """Connect the fingerprints of one key; the number of comparisons. Each is compared with those that nothing has reached yet, so a group that hangs
    together shrinks as it is walked through; only what stays apart is compared pair by pair."""
    rest, compared = fps, 0
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            compared += len(rest)
            near = np.bitwise_count((rest ^ node).view(np.uint64)) <= max_bits
            if near.any():
                found = rest[near]
                for other in found.tolist():
                    forest.link(int(node), other)
                reached.extend(found)
                rest = rest[~near]
    return compared


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(lo, hi): links of distinct fingerprints (column fp) that connect all that `max_bits` or fewer differing bits
    connect, 3 at most.

    At most 3 differing bits leave a pair of parts with at most one in each (pigeonhole). There the nearest codeword of
    either in one part is near the other, so both have a key of 24 bits in common, and are compared under it. A large key,
    as large groups of near copies have, is cut by pieces of the third part, one of which they have in common too. Each task
    keeps a forest of what it has connected, and hands on one link for each fingerprint of a tree.
    """
    if max_bits > MAX_BITS:
        raise ValueError("the parts guarantee three bits at most")
    large = large_keys(distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held, held_key = _Forest(), [], None
        for batch in batches:
            keys, fps = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            if not len(keys):
                continue
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for low, high in zip(edges, edges[1:]):
                if held and keys[low] != held_key:
                    _connect(np.concatenate(held), max_bits, forest)
                    held = []
                if high < len(keys) and not held:
                    if high - low > 1:
                        _connect(fps[low:high], max_bits, forest)
                    continue
                held_key = keys[low]
                held.append(fps[low:high])
        if held:
            _connect(np.concatenate(held), max_bits, forest)
        nodes = list(forest.above)
        roots = np.array([forest.root(n) for n in nodes], dtype=np.int64)
        nodes = np.array(nodes, dtype=np.int64)
        moved = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(roots[moved]), pa.array(nodes[moved])], names=["lo", "hi"])

    dealt = _keyed(distinct, large).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "lo long, hi long").distinct()


def _rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, and the other columns) of distinct fingerprints."""
    rooted = components(links(distinct, max_bits)).select(F.col("node").alias("fp"), "root")
    return distinct.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint, component_id), one row for each row of `docs`.

    Fingerprints link at `max_bits` or fewer differing bits; component_id is the smallest id reachable. Copies share a
    fingerprint and are reduced to it before any join. Null and empty texts have fingerprint 0, linked like any other.
    Rows with a null id keep it; their component has the smallest id that is not null, or null without one. Repeated
    rows come back as often as they are there. An empty table gives an empty result.
    """
    marked = lasting(fingerprints(docs, id_column, text_column, shingle))
    distinct = lasting(marked.groupBy("fp").agg(F.min(id_column).alias("least")))
    members = _rooted(distinct, max_bits)
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = members.select("fp", "root").join(least, "root").select(F.col("fp").alias("c_fp"), "component_id")
    return marked.join(by_fp, F.col("fp") == F.col("c_fp")).select(
        id_column, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` without all but one of each group of near duplicates: the row with the smallest id stays, of
    several with that id the one with the least hash of all its columns, and of equal rows one.

    Rows are told apart by id and hash, so an id with two texts may lose one of them and every group keeps a row. Rows
    without an id can't be told apart and stay. Texts move only for the join with the rows to drop.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(F.col(f"`{id_column}`").alias("m_id"), row.alias("m_row"), F.col(f"`{text_column}`").alias("m_text"))
    made = T.StructType([T.StructField("fp", T.LongType())])
    marked = lasting(map_texts(keyed, ["m_id", "m_row"], "m_text", made,
                               lambda: lambda texts: [(fingerprint(lower_words_of(t), shingle),) for t in texts]))
    first = F.min(F.when(F.col("m_id").isNotNull(), F.struct("m_id", "m_row"))).alias("first")
    members = _rooted(lasting(marked.groupBy("fp").agg(first)), max_bits)
    stays = members.groupBy("root").agg(F.min("first").alias("first")).where("first IS NOT NULL").select("first.*")
    rows = lasting(marked.where("m_id IS NOT NULL").groupBy("m_id", "m_row").agg(F.count("*").alias("copies")))
    drop = lasting(rows.join(stays, ["m_id", "m_row"], "left_anti").select("m_id", "m_row"))
    own = free_name(docs.columns, "row")
    hashed = docs.withColumn(own, row)
    kept = hashed.join(drop, (hashed[id_column] == drop["m_id"]) & (hashed[own] == drop["m_row"]), "left_anti")
    repeated = lasting(rows.join(stays, ["m_id", "m_row"], "left_semi").where("copies > 1").select("m_id", "m_row"))
    if repeated.isEmpty():
        return kept.drop(own)
    same = (kept[id_column] == repeated["m_id"]) & (kept[own] == repeated["m_row"])
    once = kept.join(repeated, same, "left_anti")
    return once.unionByName(kept.join(repeated, same, "left_semi").dropDuplicates([id_column, own])).drop(own)
