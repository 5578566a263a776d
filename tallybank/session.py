"""Session settings the jobs are written for."""

from __future__ import annotations

import os
import site
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Page texts can be long, so few of them travel to Python at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


#: Parts that the jobs deal their input tables into; unset, the layout of the files decides.
INPUT_PARTITIONS = "spark.tallybank.inputPartitions"


def local_session(cores: int | str = 8, partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and measurements on one machine."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("tallybank")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
               .config("spark.sql.shuffle.partitions", str(partitions)).config(INPUT_PARTITIONS, str(cores)))
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers of a session, once, unless it is installed or on their PYTHONPATH anyway."""
    context = spark.sparkContext
    package = os.path.dirname(os.path.realpath(__file__))
    root = os.path.dirname(package)
    there = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    if root in map(os.path.realpath, filter(None, there)) or getattr(context, "_tallybank_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tallybank-"), "tallybank.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    context._tallybank_shipped = True
