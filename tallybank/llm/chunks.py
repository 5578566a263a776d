"""Repeated passages by content-defined chunks: boundaries follow a gear rolling hash, copies share chunk digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import BATCH_ROWS, arrow_schema, flat_map_texts, free_name

#: Bytes that decide about a boundary: only these, so an insertion moves no boundary behind them.
WINDOW = 16
#: One byte in so many is a candidate, and the least distance to the candidate before it.
SPACING, APART = 16, 16
#: A chunk without a boundary in so many bytes is cut there.
LONGEST = 1024
#: A boundary moves on to the start of the next word if that is so near, else to the next character.
WORD_REACH = 64
#: Code points that neighbouring repeated chunks must have together to be a repeated passage.
PASSAGE_CHARS = 100


def gear_table() -> np.ndarray:
    """256 numbers of 32 bits, by a mixing rule from the byte."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = gear_table()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def gear_hashes(codes: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[byte i-k] << k over the last WINDOW bytes, by doubling the window."""
    h = _GEAR[codes]
    width = 1
    while width < WINDOW:
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h, width = more, 2 * width
    return h


def boundaries(raw: bytes) -> np.ndarray:
    """Ends of the chunks in bytes, strictly rising; the last one is the length."""
    codes = np.frombuffer(raw, dtype=np.uint8)
    size = len(codes)
    marks = np.flatnonzero((gear_hashes(codes) >> np.uint32(16)) < (1 << 16) // SPACING) + 1
    if len(marks):
        marks = marks[np.concatenate(([True], np.diff(marks) >= APART))]
        words = np.flatnonzero(_SPACE[codes[:-1]] & ~_SPACE[codes[1:]]) + 1
        characters = np.flatnonzero((codes & 0xC0) != 0x80)
        heads = np.append(words, size)[np.searchsorted(words, marks)]
        near = heads - marks <= WORD_REACH
        marks = np.where(near, heads, np.append(characters, size)[np.searchsorted(characters, marks)])
    cuts = np.unique(np.append(marks, size))
    gaps = np.diff(np.concatenate(([0], cuts)))
    if (gaps > LONGEST).any():
        starts = cuts - gaps
        extra = np.concatenate([np.arange(s + LONGEST, e, LONGEST) for s, e in
                                zip(starts[gaps > LONGEST], cuts[gaps > LONGEST], strict=True)])
        characters = np.flatnonzero((codes & 0xC0) != 0x80)
        extra = np.append(characters, size)[np.searchsorted(characters, extra)]
        cuts = np.unique(np.concatenate((cuts, extra)))
    return cuts


def chunks_of(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, digest) of all chunks: code points, and two 64-bit halves. Null and empty texts have none."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    ends = boundaries(raw)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh3_128_digest
    halves = np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]),
                           dtype="<i8").reshape(-1, 2)
    if len(raw) != len(text):
        place = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
        starts, ends = place[starts], place[ends]
    return starts, ends, halves


def chunked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(owner, start, end, d1, d2), one row for each chunk of each text; one pass, no shuffle."""
    schema = T.StructType([T.StructField("owner", docs.schema[id_column].dataType),
                           T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                           T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])
    kinds = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS // 8):
                batch = whole.slice(at, BATCH_ROWS // 8)
                found = [chunks_of(t) for t in batch.column(1).to_pylist()]
                owner = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found])))
                halves = np.concatenate([f[2] for f in found])
                yield pa.RecordBatch.from_arrays(
                    [owner.cast(kinds.field(0).type), pa.array(np.concatenate([f[0] for f in found]).astype(np.int32)),
                     pa.array(np.concatenate([f[1] for f in found]).astype(np.int32)),
                     pa.array(halves[:, 0]), pa.array(halves[:, 1])], schema=kinds)

    rows = docs.where(docs[id_column].isNotNull()).select(
        docs[id_column].alias("__id"), docs[text_column].cast("string").alias("__text"))
    return rows.mapInArrow(run, schema)


def repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(owner, start, end, first): the chunks that are in two documents or more; `first` is the smallest id with it.

    Digests are pre-aggregated before their shuffle, so a chunk in a third of all documents is one row a task. The join
    back is split at run time where a digest is frequent.
    """
    rows = chunked(docs, id_column, text_column)
    shared = (rows.groupBy("d1", "d2").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
              .where(F.col("first") < F.col("last")).select("d1", "d2", "first"))
    return rows.join(shared, ["d1", "d2"]).select("owner", "start", "end", "first")


def _in_runs(chunks: DataFrame) -> DataFrame:
    """The chunks with the number of their run of neighbours within the document."""
    ordered = Window.partitionBy("owner").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = chunks.withColumn("opens", F.coalesce((F.col("start") > before).cast("int"), F.lit(0)))
    return marked.withColumn("run", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      least_chars: int = PASSAGE_CHARS) -> DataFrame:
    """(id, start, end, first_id, is_first): passages that repeat across documents, one row for each place of each.

    A passage is a run of neighbouring chunks, each in at least one more document, of `least_chars` code points or more.
    first_id is the smallest id with one of its chunks; is_first tells that no smaller id has any of them. Rows without
    an id are left out, rows repeated under one id count as one document, null and empty texts have no passages.
    """
    runs = _in_runs(repeated_chunks(docs, id_column, text_column)).groupBy("owner", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first_id"))
    return runs.where(F.col("end") - F.col("start") >= least_chars).select(
        F.col("owner").alias(id_column), "start", "end", "first_id", (F.col("first_id") == F.col("owner")).alias("is_first"))


def repeats_in(text: str | None, least_chars: int = PASSAGE_CHARS) -> tuple[list[tuple[int, int, bool]], list[tuple[int, int]]]:
    """((start, end, is_first) of the passages that repeat within the text, (start, end) of their chunks at later places).

    A passage is a run of neighbouring chunks, each at another place of the text too; is_first tells that none of them
    is at a place before the run.
    """
    starts, ends, halves = chunks_of(text)
    if len(np.unique(halves[:, 0])) == len(starts):
        return [], []
    _, first, kind, count = np.unique(halves, axis=0, return_index=True, return_inverse=True, return_counts=True)
    kind = kind.reshape(-1)
    first = first[kind]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], count[kind] > 1, [0]))))
    passages, later = [], []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if ends[b - 1] - starts[a] >= least_chars:
            passages.append((int(starts[a]), int(ends[b - 1]), bool((first[a:b] >= a).all())))
            later += [(int(starts[i]), int(ends[i])) for i in range(a, b) if first[i] < i]
    return passages, later


def passages_within(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    least_chars: int = PASSAGE_CHARS) -> DataFrame:
    """(id, start, end, first_id, is_first): passages that repeat within one text, one row for each place of each.

    first_id is the id itself; is_first tells that no chunk of the passage comes before it in the text. Rows without an
    id are left out, and equal rows come once. One pass; only the rows found are shuffled.
    """
    made = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("is_first", T.BooleanType())])
    rows = docs.where(docs[id_column].isNotNull()).select(
        docs[id_column].alias("__id"), docs[text_column].cast("string").alias("__own"))
    found = flat_map_texts(rows, ["__id"], "__own", made, lambda: lambda texts: (repeats_in(t, least_chars)[0] for t in texts))
    return found.distinct().select(F.col("__id").alias(id_column), "start", "end", F.col("__id").alias("first_id"), "is_first")


def all_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 least_chars: int = PASSAGE_CHARS) -> DataFrame:
    """(id, start, end, first_id, is_first, scope): passages that repeat across documents and, in rows of their own,
    passages that repeat within one. A passage that does both has rows of both scopes."""
    across = repeated_passages(docs, id_column, text_column, least_chars).withColumn("scope", F.lit("across"))
    within = passages_within(docs, id_column, text_column, least_chars).withColumn("scope", F.lit("within"))
    return across.unionByName(within)


def _cut(text: str | None, spans: list) -> str | None:
    if not spans or text is None:
        return text
    out, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            out.append(text[at:start])
        at = max(at, end)
    return "".join(out) + text[at:]


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    least_chars: int = PASSAGE_CHARS) -> DataFrame:
    """All rows of `docs` with repeated passages cut from their texts, except where an id has the first copy of a chunk.

    Of a passage that repeats within a text the first place of each chunk stays. Rows without an id stay as they are.
    """
    runs = _in_runs(repeated_chunks(docs, id_column, text_column))
    whole = Window.partitionBy("owner", "run")
    long = runs.withColumn("chars", F.max("end").over(whole) - F.min("start").over(whole))
    spans, owner = free_name(docs.columns, "spans"), free_name(docs.columns, "owner")
    cut = (long.where((F.col("chars") >= least_chars) & (F.col("first") < F.col("owner")))
           .groupBy(F.col("owner").alias(owner)).agg(F.collect_set(F.struct("start", "end")).alias(spans)))
    joined = docs.join(cut, docs[id_column] == cut[owner], "left").drop(owner)
    names = docs.columns
    place, by = names.index(text_column), names.index(id_column)

    def shortened(owner, text: str | None, across: list | None) -> str | None:
        if owner is None or not text:
            return text
        return _cut(text, [(s["start"], s["end"]) for s in across or ()] + repeats_in(text, least_chars)[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            found = columns.pop().to_pylist()
            rows = zip(columns[by].to_pylist(), columns[place].to_pylist(), found, strict=True)
            columns[place] = pa.array([shortened(*r) for r in rows], type=columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)
