"""Documents that share most of their word n-grams: a grouped prefix join on Jaccard similarity.

All n-grams have one order, rare ones first. Two sets with the wanted similarity share an n-gram among the first few of
each (the prefix). Sets with the same prefix and size form a group; groups meet under the n-grams of their prefixes, and
the members of pairs of groups that can reach the similarity are verified on their whole sets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import ASCII_LOWER, arrow_schema, lasting, table_of_bounded_rows
from tallybank.llm.components import components

SHINGLE_WORDS = 5
#: Least share, in hundredths, of the n-grams of two documents that are in both.
PERCENT = 80
#: N-grams that are counted in one piece of memory, and that a task holds before it deals them out.
BUCKET_GRAMS = BLOCK_GRAMS = 1 << 21
LEAST_BUCKETS = 256
_BLOCK_DOCS = 60_000
_MULTIPLIER, _BYTE_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_ROWS = 2048
#: Bytes of text that are hashed at once, if a single text isn't longer.
_BYTES = 1 << 20


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX_1
    h = (h ^ (h >> np.uint64(27))) * _MIX_2
    return h ^ (h >> np.uint64(31))


@functools.cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte multiplier, and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_BYTE_MULTIPLIER), -1, 1 << 64))
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(length, k))]) for k in (_BYTE_MULTIPLIER, inverse))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, 64-bit hashes) of the words of bytes that end in a space: polynomials in the bytes, from running sums."""
    gap = _SPACES[data]
    change = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        change = np.concatenate([[0], change])
    starts, ends = change[::2], change[1::2]
    up, down = _powers(1 << max(20, (len(data) - 1).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])])
    return starts, _mixed((sums[ends] - sums[starts]) * down[starts])


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    made = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        made = made * _MULTIPLIER + words[i:len(words) - size + 1 + i]
    return _mixed(made)


def _sets_of(texts: list[bytes], width: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, words = _word_hashes(data)
    at = np.searchsorted(starts, begins)
    last = np.repeat(at[1:], np.diff(at)) - width
    made, sets = _folded(words, width) if len(words) >= width else np.empty(0, np.uint64), []
    whole = np.flatnonzero(np.arange(len(made)) <= last[:len(made)])
    made = made[whole]
    edges = np.searchsorted(whole, at).tolist()
    for low, high in zip(edges, edges[1:]):
        made[low:high].sort()
    fresh = np.ones(len(made), dtype=bool)
    fresh[1:] = made[1:] != made[:-1]
    fresh[[e for e in edges if e < len(made)]] = True
    for place, (low, high) in enumerate(zip(edges, edges[1:])):
        few = at[place + 1] - at[place]
        sets.append(made[low:high][fresh[low:high]] if few >= width or not few else _folded(words[at[place]:at[place + 1]], few))
    return sets


def shingle_sets(texts: list[str | None], width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its distinct n-grams, ascending. A text of fewer words is one n-gram."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode().translate(ASCII_LOWER))
        size += len(held[-1]) + 1
        if size >= _BYTES:
            yield from _sets_of(held, width)
            held, size = [], 0
    if held:
        yield from _sets_of(held, width)


def prefix_length(n: int) -> int:
    """Of sets of `n`, two that reach the similarity share one of so many first n-grams."""
    return n - (n * PERCENT + 99) // 100 + 1


def _runs(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows with the same value in a column, of batches sorted by it."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(place).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for low, high in zip(cuts, cuts[1:]):
            if held and values[low] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = int(values[low])
            held.append(batch.slice(low, high - low))
    if held:
        yield key, pa.Table.from_batches(held)


def _joined(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, how many of each row) of a column of packed numbers."""
    parts = [p or b"" for p in column.to_pylist()]
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), dtype=kind), np.array([len(p) // size for p in parts], dtype=np.int64)


#: Kinds of rows that travel: n-grams of a block in a bucket; where a block holds n-grams twice or more; documents.
_GRAMS, _TWICE, _DOC = range(3)


def _travelling(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("key", T.LongType()), T.StructField("block", T.LongType()), T.StructField("kind", T.IntegerType()),
                         T.StructField("id", id_type), T.StructField("n", T.IntegerType()), T.StructField("doc", T.IntegerType()),
                         T.StructField("set", T.BinaryType()), T.StructField("mark", T.LongType()),
                         *[T.StructField(c, T.BinaryType()) for c in ("grams", "docs", "totals", "many", "many_totals")]])


def _batch(kinds: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(rows, f.type) if f.name not in columns else columns[f.name].cast(f.type)
                                       for f in kinds], schema=kinds)


def _blocks(batches: Iterator[pa.RecordBatch], kinds: pa.Schema, bits: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text, mark) as blocks: one row for each document, and the n-grams of the distinct sets by bucket.

    An n-gram's first `bits` bits are its bucket and the next 32 its name there. Two n-grams under one name only look more
    frequent and bring a pair to verify. What several sets of a block hold goes to the bucket once, with their number.
    """
    shift = np.uint64(32 - bits)
    number, part = 0, TaskContext.get().partitionId()
    first = part << 32
    sets: dict[bytes, int] = {}
    held: list[np.ndarray] = []
    size = 0

    def passing() -> int:
        """Bucket whose task hands a block's other rows on."""
        return (part * 7919 + number) % (1 << bits)

    def deal() -> Iterator[pa.RecordBatch]:
        names = np.concatenate(held) >> shift
        docs = np.repeat(np.arange(len(held), dtype=np.uint16), [len(h) for h in held])
        order = np.argsort(names, kind="stable")
        names, docs = names[order], docs[order]
        starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        counts = np.diff(np.append(starts, len(names)))
        single = np.repeat(counts == 1, counts)
        many, many_counts = names[starts[counts > 1]], counts[counts > 1].astype(np.uint32)
        twice = (names[~single], docs[~single])
        names, docs = names[single], docs[single]
        edges = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)
        at, at_many = np.searchsorted(names, edges).tolist(), np.searchsorted(many, edges).tolist()
        low, low_many = names.astype(np.uint32).tobytes(), many.astype(np.uint32).tobytes()
        docs, many_counts = docs.tobytes(), many_counts.tobytes()
        used = [b for b in range(1 << bits) if at[b + 1] > at[b] or at_many[b + 1] > at_many[b]]

        def cut(data: bytes, places: list[int], width: int) -> pa.Array:
            return pa.array([data[width * places[b]:width * places[b + 1]] for b in used], pa.binary())
        rows = len(used)
        yield _batch(kinds, rows, key=pa.array(used), block=pa.array([first + number] * rows), kind=pa.array([_GRAMS] * rows),
                     grams=cut(low, at, 4), docs=cut(docs, at, 2), many=cut(low_many, at_many, 4),
                     many_totals=cut(many_counts, at_many, 4))
        if len(twice[0]):
            yield _batch(kinds, 1, key=pa.array([passing()]), block=pa.array([first + number]), kind=pa.array([_TWICE]),
                         grams=pa.array([twice[0].tobytes()]), docs=pa.array([twice[1].tobytes()]))

    for whole in batches:
        for start in range(0, whole.num_rows, _ROWS):
            batch, rows = whole.slice(start, _ROWS), []
            for grams in shingle_sets(batch.column(1).to_pylist(), width):
                if size >= BLOCK_GRAMS or len(held) >= _BLOCK_DOCS:
                    yield from deal()
                    number, size, held = number + 1, 0, []
                    sets.clear()
                name = xxhash.xxh128_digest(grams.tobytes()) if len(grams) else None
                if name is not None and name not in sets:
                    sets[name] = len(held)
                    held.append(grams)
                    size += len(grams)
                rows.append((first + number, passing(), len(grams), sets.get(name, -1), name))
            block, key, n, doc, name = zip(*rows)
            yield _batch(kinds, len(rows), key=pa.array(key), block=pa.array(block), kind=pa.array([_DOC] * len(rows)), id=batch.column(0),
                         n=pa.array(n), doc=pa.array(doc), set=pa.array(name, pa.binary()), mark=batch.column(2))
    if held:
        yield from deal()


def _counted(batches: Iterator[pa.RecordBatch], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of each bucket's n-grams those of two sets or more go back to their blocks, with the number of sets. Other rows pass."""
    for bucket, rows in _runs(batches, 0):
        kind = rows.column("kind").to_numpy()
        yield from rows.filter(pa.array(kind != _GRAMS)).to_batches()
        rows = rows.filter(pa.array(kind == _GRAMS))
        if not rows.num_rows:
            continue
        (grams, each), (docs, _) = _joined(rows.column("grams"), "<u4"), _joined(rows.column("docs"), "<u2")
        (many, each_many), (counts, _) = _joined(rows.column("many"), "<u4"), _joined(rows.column("many_totals"), "<u4")
        _, place = np.unique(np.concatenate([grams, many]), return_inverse=True)
        totals = np.bincount(place, weights=np.concatenate([np.ones(len(grams)), counts]))[place]
        totals = np.minimum(totals, 0xFFFFFFFF).astype(np.uint32)
        totals, many_totals = totals[:len(grams)], totals[len(grams):]
        shared = totals > 1
        names, many = ((np.uint64(bucket) << np.uint64(32)) | g.astype(np.uint64) for g in (grams[shared], many))
        at = np.concatenate([[0], np.cumsum(np.bincount(np.repeat(np.arange(len(each)), each)[shared], minlength=len(each)))])
        at_many = np.concatenate([[0], np.cumsum(each_many)])

        def cut(data: np.ndarray, places: np.ndarray) -> pa.Array:
            return pa.array([data[a:b].tobytes() for a, b in zip(places, places[1:])], pa.binary())
        made = _batch(kinds, rows.num_rows, key=rows.column("key").combine_chunks(), block=rows.column("block").combine_chunks(),
                      kind=rows.column("kind").combine_chunks(), grams=cut(names, at), docs=cut(docs[shared], at),
                      totals=cut(totals[shared], at), many=cut(many, at_many), many_totals=cut(many_totals, at_many))
        yield made.filter(pa.array((np.diff(at) > 0) | (each_many > 0)))


def _prefixes(batches: Iterator[pa.RecordBatch], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The documents of each block; those whose prefix holds n-grams of other sets with these, rare ones first, and with
    `alone`, the number of n-grams that no other set has and that come before them."""
    for _, rows in _runs(batches, 1):
        kind = rows.column("kind").to_numpy()
        back, twice, docs = (rows.filter(pa.array(kind == k)) for k in (_GRAMS, _TWICE, _DOC))
        names, owners = _joined(back.column("grams"), "<u8")[0], _joined(back.column("docs"), "<u2")[0]
        totals = _joined(back.column("totals"), "<u4")[0]
        many, many_totals = _joined(back.column("many"), "<u8")[0], _joined(back.column("many_totals"), "<u4")[0]
        order = np.argsort(many)
        again = _joined(twice.column("grams"), "<u8")[0]
        found = order[np.searchsorted(many, again, sorter=order)] if len(again) else np.empty(0, dtype=np.int64)
        names = np.concatenate([names, again])
        owners = np.concatenate([owners, _joined(twice.column("docs"), "<u2")[0]]).astype(np.int64)
        totals = np.concatenate([totals, many_totals[found]])
        order = np.lexsort((names, totals, owners))
        names = names[order].astype(np.int64)
        at = np.searchsorted(owners[order], np.arange(_BLOCK_DOCS + 2)).tolist()
        done, alone, prefix = set(), [], []
        for n, doc in zip(docs.column("n").to_pylist(), docs.column("doc").to_pylist(), strict=True):
            rare = n - (at[doc + 1] - at[doc]) if doc >= 0 else 0
            if doc < 0 or doc in done or rare >= prefix_length(n):
                alone.append(None)
                prefix.append(None)
                continue
            done.add(doc)
            alone.append(rare)
            prefix.append(names[at[doc]:at[doc] + prefix_length(n) - rare])
        yield pa.RecordBatch.from_arrays([*[docs.column(c).combine_chunks().cast(kinds.field(c).type) for c in ("id", "n", "set", "mark")],
                                          pa.array(alone, kinds.field("alone").type), pa.array(prefix, kinds.field("prefix").type)],
                                         schema=kinds)


def prefixed(docs: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """(id, n, set, mark, alone, prefix), one row for each row: size and digest of its set of n-grams, a hash of its text,
    and the prefix where it can meet another set's.

    N-grams are counted over all documents: each is sent to its bucket in six bytes, and comes back to its block only if
    another set has it. Buckets grow in number with the text, so each fits in memory.
    """
    text = F.col(f"`{text_column}`").cast("string")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(31, max(LEAST_BUCKETS, size // (6 * BUCKET_GRAMS)).bit_length() - 1)
    moving = _travelling(rows.schema["id"].dataType)
    made = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n", T.IntegerType()), T.StructField("set", T.BinaryType()),
                         T.StructField("mark", T.LongType()), T.StructField("alone", T.IntegerType()),
                         T.StructField("prefix", T.ArrayType(T.LongType()))])
    kinds, out = arrow_schema(moving), arrow_schema(made)
    dealt = rows.mapInArrow(lambda b: _blocks(b, kinds, bits, width), moving)
    counted = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _counted(b, kinds), moving)
    return counted.repartition("block").sortWithinPartitions("block").mapInArrow(lambda b: _prefixes(b, out), made)


def _whole_sets(docs: DataFrame, text_column: str, sets: DataFrame, width: int) -> DataFrame:
    """(set, grams) of the given sets, worked out again from one text of each."""
    text = F.col(f"`{text_column}`").cast("string")
    wanted = table_of_bounded_rows(sets.select("mark").distinct())
    texts = docs.select(text.alias("text")).where("text IS NOT NULL").withColumn("mark", F.xxhash64("text")).join(
        wanted, "mark", "left_semi").select("text").distinct()
    schema = T.StructType([T.StructField("set", T.BinaryType()), T.StructField("grams", T.ArrayType(T.LongType()))])
    kinds = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                found = list(shingle_sets(whole.column(0).slice(at, _ROWS).to_pylist(), width))
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh128_digest(g.tobytes()) for g in found], kinds.field(0).type),
                                                  pa.array([g.view(np.int64) for g in found], kinds.field(1).type)], schema=kinds)
    return lasting(texts.mapInArrow(run, schema).groupBy("set").agg(F.first("grams").alias("grams")))


def _alike(both: Column, n: Column, m: Column) -> Column:
    """Whether sets of n and m with so many in both reach the similarity."""
    return (100 + PERCENT) * both >= PERCENT * (n + m)


def _verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """(lo, hi): those of the pairs (lo, hi) that reach the similarity on their whole sets."""
    for side in ("lo", "hi"):
        pairs = pairs.join(whole.select(F.col("set").alias(side), F.col("grams").alias(f"{side}_grams")), side)
    both = F.size(F.array_intersect("lo_grams", "hi_grams"))
    return pairs.where(_alike(both, F.size("lo_grams"), F.size("hi_grams"))).select("lo", "hi")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")]


def _postings(groups: DataFrame) -> DataFrame:
    """Rows (gram, room, and the columns but the prefix): `room` is the most that a group can share with another when this
    n-gram is the first in both."""
    here = groups.select(*[c for c in groups.columns if c != "prefix"], F.posexplode("prefix").alias("place", "gram"))
    return here.withColumn("room", F.col("n") - F.col("alone") - F.col("place")).drop("place")


def links(sets: DataFrame, whole: DataFrame) -> DataFrame:
    """(lo, hi): verified links of sets (set, n, alone, prefix) that connect all that links connect.

    First each group under an n-gram meets one group there, the one with the fewest n-grams of its own; what this connects
    has one root. After that only groups under different roots meet, and of these only the ones with room for the
    similarity beside the smallest set there. So large groups of near copies aren't paired with each other, and no link
    between two roots is lost. Members of one group meet its first one in the same way.
    """
    own_prefix = F.md5(F.concat_ws(",", F.col("n").cast("string"), F.col("prefix").cast("array<string>")).cast("binary"))
    grouped = lasting(sets.withColumn("grp", F.when(F.col("alone") == 0, own_prefix).otherwise(F.hex("set"))))
    groups = grouped.groupBy("grp", "n", "alone", "prefix").agg(F.min("set").alias("head"))
    postings = lasting(_postings(groups))
    pivot = F.min_by(F.struct("grp", "n", "head", "room"), F.struct(F.col("alone") / F.col("n"), F.col("grp"))).alias("pivot")
    pivots = postings.groupBy("gram").agg(F.count("*").alias("lists"), pivot).where("lists > 1").drop("lists")
    meets = postings.join(pivots, "gram").where((F.col("grp") != F.col("pivot.grp")) & _alike(
        F.least("room", "pivot.room"), F.col("n"), F.col("pivot.n"))).select("grp", F.col("pivot.head").alias("other")).distinct()
    inside = grouped.join(groups.select("grp", "head"), "grp").where(F.col("set") != F.col("head"))
    stars = grouped.select("grp", "set").join(meets, "grp").select(*_ordered("set", "other")).unionByName(
        inside.select(*_ordered("set", "head"))).distinct()
    stars = lasting(_verified(stars, whole))
    roots = components(stars).select(F.col("node").alias("set"), "root")
    rooted = lasting(grouped.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")))
    cells = lasting(_postings(rooted.select("grp", "root", "n", "alone", "prefix").distinct()))
    mixed = F.min("root") != F.max("root")
    least = cells.groupBy("gram").agg(F.min("n").alias("least"), mixed.alias("mixed")).where("mixed").drop("mixed")
    open_cells = lasting(cells.join(least, "gram").where(_alike(F.col("room"), F.col("n"), F.col("least"))).drop("least"))
    still = open_cells.groupBy("gram").agg(mixed.alias("mixed")).where("mixed").select("gram")
    open_cells = lasting(open_cells.join(still, "gram", "left_semi").select("gram", "grp", "root", "n", "room"))
    left, right = (open_cells.select(*[F.col(c).alias(f"{side}_{c}") for c in open_cells.columns]) for side in "ab")
    meets = left.join(right, (F.col("a_gram") == F.col("b_gram")) & (F.col("a_root") < F.col("b_root")) & _alike(
        F.least("a_room", "b_room"), F.col("a_n"), F.col("b_n"))).select("a_grp", "a_root", "b_grp", "b_root").distinct()
    for side in "ab":
        members = rooted.select(F.col("grp").alias(f"{side}_grp"), F.col("root").alias(f"{side}_root"), F.col("set").alias(side))
        meets = meets.join(members, [f"{side}_grp", f"{side}_root"])
    return stars.unionByName(_verified(meets.select(*_ordered("a", "b")).distinct(), whole))


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(id, n_shingles, component_id), one row for each row of `docs`.

    Sets hold the distinct n-grams of a text, or its whole sequence of words as one. Two rows link when PERCENT hundredths
    of the n-grams of either are in both; component_id is the smallest id reachable. Equal sets are one set from the start.
    Texts without words (null and empty ones too) have no n-grams and link with nothing. Rows with a null id take part; a
    component without any other id has none. Repeated rows come back as often as they are there; other columns aren't read.
    N-grams are compared by 64-bit hashes. An empty table gives an empty result.
    """
    rows = lasting(prefixed(docs, id_column, text_column, width))
    out = [F.col("id").alias(id_column), F.col("n").cast("long").alias("n_shingles")]
    classes = lasting(rows.where("set IS NOT NULL").groupBy("set").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.min("mark").alias("mark"), F.max("n").alias("n"),
        F.max("alone").alias("alone"), F.max("prefix").alias("prefix")))
    sets = classes.where("prefix IS NOT NULL")
    linked = components(links(sets.select("set", "n", "alone", "prefix"), _whole_sets(docs, text_column, sets, width)))
    rooted = classes.select("set", "least", "copies").join(linked.select(F.col("node").alias("set"), "root"), "set", "left")
    rooted = lasting(rooted.where("copies > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "set")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = table_of_bounded_rows(rooted.join(least, "root").select("set", "component_id", F.lit(True).alias("known")))
    some = rows.where("set IS NOT NULL").join(known, "set", "left").select(
        *out, F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return some.unionByName(rows.where("set IS NULL").select(*out, F.col("id").alias("component_id")))
