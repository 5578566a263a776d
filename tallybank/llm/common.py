"""Helpers shared by the operators on documents."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
ASCII_LOWER = bytes(range(256)).lower()
#: Rows that travel to the JVM in one Arrow batch at most.
BATCH_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that executors and driver share: the one the session names. A session on one machine, as in tests,
    that names none gets one of its own; on a cluster that is refused."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get(CHECKPOINT_DIR, None)
        if not named and not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store holds it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def lasting(frame: DataFrame) -> DataFrame:
    """The frame, computed once into the folder that the session names in `spark.checkpoint.dir`.

    Later passes and retries after a lost executor read those files.
    """
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


#: Rows of a side table that are sent to every task at most; a larger one is joined by a shuffle.
SENT_ROWS = 100_000


def table_of_bounded_rows(frame: DataFrame) -> DataFrame:
    """The frame, computed once, and marked to be sent to every task if it is counted to have few rows."""
    frame = lasting(frame)
    return F.broadcast(frame) if frame.count() <= SENT_ROWS else frame


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` as UTF-8; bytes.split() parts at exactly these six characters."""
    return text.encode().split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The same words with A-Z in lower case."""
    return text.encode().translate(ASCII_LOWER).split() if text else []


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def flat_map_texts(frame: DataFrame, keep: list[str], text: str, made: T.StructType,
                   start: Callable[[], Callable[[list], Iterable[list[tuple]]]]) -> DataFrame:
    """For each row, any number of rows made from its text, beside its columns `keep`; one pass, no shuffle.

    `start()` runs once in each task and returns a function from a list of texts to a list of tuples for each of them.
    Only the named columns are read, so other columns may have any name. A name in `made` must not be in `keep`.
    """
    clash = {f.name.lower() for f in made} & {k.lower() for k in keep}
    if clash:
        raise ValueError(f"columns of that name exist: {sorted(clash)}")
    schema = T.StructType([T.StructField(k, frame.schema[k].dataType) for k in keep] + list(made.fields))
    kinds = arrow_schema(schema)
    n_kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                rows, source = [], []
                for i, found in enumerate(make(batch.column(n_kept).to_pylist())):
                    rows += found
                    source += [i] * len(found)
                columns = [batch.column(i).take(pa.array(source, type=pa.int64())).cast(kinds.field(i).type)
                           for i in range(n_kept)]
                columns += [pa.array([r[i] for r in rows], type=kinds.field(n_kept + i).type)
                            for i in range(len(made.fields))]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    selected = frame.select(*[frame[k] for k in keep], frame[text].cast("string").alias("__text"))
    return selected.mapInArrow(run, schema)


def map_texts(frame: DataFrame, keep: list[str], text: str, made: T.StructType,
              start: Callable[[], Callable[[list], Iterable[tuple]]]) -> DataFrame:
    """The same with one tuple, and so one row, for each text."""
    def each():
        make = start()
        return lambda texts: ([row] for row in make(texts))
    return flat_map_texts(frame, keep, text, made, each)


def free_name(taken: Iterable[str], wish: str) -> str:
    """The wished column name, lengthened until no column has it."""
    names = {t.lower() for t in taken}
    while wish.lower() in names:
        wish += "_"
    return wish


def filter_texts(docs: DataFrame, text: str, start: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text passes; one pass, no shuffle.

    `start()` runs once in each task and returns a function from a list of texts to one boolean for each of them.
    """
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = start()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                yield batch.filter(pa.array(passes(batch.column(place).to_pylist()), type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def rewrite_texts(docs: DataFrame, text: str, length: str | None,
                  start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows of `docs` with new texts, and with their lengths in code points in the column `length` if it is there.

    `start()` runs once in each task and returns a function from a list of texts to the list of new ones.
    """
    place = docs.columns.index(text)
    count = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                old, columns = batch.column(place).to_pylist(), list(batch.columns)
                new = make(old)
                columns[place] = pa.array(new, type=batch.schema.field(place).type)
                if count is not None:
                    sizes = [s if a is b or a == b else len(b)
                             for a, b, s in zip(old, new, columns[count].to_pylist(), strict=True)]
                    columns[count] = pa.array(sizes, type=batch.schema.field(count).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
