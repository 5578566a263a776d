"""Frames computed once so that several passes can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """The folder, shared by all executors, that the session names in ``spark.checkpoint.dir``. A session on one
    machine that names none gets a temporary one; on a cluster that is refused."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get(CHECKPOINT_DIR, None)
        if not named and not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallybank-"))
    return context.getCheckpointDir()


def staged(frame: DataFrame) -> DataFrame:
    """The frame, computed into the shared folder. A lost executor costs a re-read instead of the work before; Spark
    deletes the files once nothing refers to them, where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    staging_folder(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder as Parquet and read back. Later passes read only the columns they need, and the
    planner knows the size of the rows that are there, where ``staged`` keeps its estimate. The files stay in the folder."""
    path = f"{staging_folder(frame.sparkSession)}/stored-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
