"""Table of finished analyses: what is already there, what is still to do."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that says which run stored a row.
VERSION = "stored_in"


def cache_hits(work: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Work items together with their stored analysis. Keys are unique in the cache."""
    return work.join(cache, key, "inner")


def cache_misses(work: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Work items without a stored analysis. Only the cache's key column is read."""
    return work.join(cache.select(key), key, "left_anti")


def first_of_each(rows: DataFrame, key: str, first: list[str]) -> DataFrame:
    """One row for each key: the least by the columns ``first``, then by the hash of the row, so never an arbitrary one."""
    values = [c for c in rows.columns if c != key]
    order = F.struct(*first, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    picked = F.min_by(F.struct(*[F.col(f"`{c}`") for c in values]), order).alias("picked")
    return rows.groupBy(key).agg(picked).select(key, *[F.col(f"picked.`{c}`").alias(c) for c in values])


@dataclass(frozen=True)
class KeyedCache:
    """Analyses stored under ``path`` in ``buckets`` by the hash of their key.

    Lookups move the work items to the buckets and leave the stored rows where they are. Each append adds files and never
    rewrites any, under the version its caller names (a run number or a time). Two runs that store a key at the same time
    leave two rows of it: readers take the one with the least version, then the least hash, in any order of files.
    """

    path: str
    schema: T.StructType
    key: str = "key"
    buckets: int = 64

    @property
    def name(self) -> str:
        return "cache_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]

    def stored(self, spark: SparkSession) -> DataFrame:
        """All rows as stored, with their version. The table is made known to the session if it isn't yet."""
        if not spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            spark.sql(f"CREATE TABLE {self.name} ({columns}, `{VERSION}` bigint) USING parquet OPTIONS (path '{self.path}') "
                      f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS")
        return spark.table(self.name)

    def rows(self, spark: SparkSession) -> DataFrame:
        """One row for each key, without any shuffle."""
        return first_of_each(self.stored(spark), self.key, [VERSION]).select(*self.schema.names)

    def hits(self, work: DataFrame) -> DataFrame:
        return cache_hits(work, self.rows(work.sparkSession), self.key)

    def misses(self, work: DataFrame) -> DataFrame:
        return cache_misses(work, self.stored(work.sparkSession), self.key)

    def append(self, results: DataFrame, version: int, first: list[str] | None = None) -> None:
        """Store results for keys that aren't there yet, one row for each key: the least by ``first``, then by hash. Rows
        without a key are left out."""
        spark = results.sparkSession
        fresh = first_of_each(results.where(F.col(self.key).isNotNull()), self.key, first or [])
        fresh = cache_misses(fresh, self.stored(spark), self.key).select(*self.schema.names, F.lit(version).cast("long").alias(VERSION))
        # Each task writes the rows of its buckets only, so an append adds one file to a bucket at most.
        (fresh.repartition(self.buckets, self.key).write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, self.key).saveAsTable(self.name))


def append_to_cache(results: DataFrame, path: str, key: str = "key") -> None:
    """Add results for keys that a plain folder of rows does not hold yet, one row for each key, the least by hash."""
    spark = results.sparkSession
    results = first_of_each(results, key, [])
    try:
        results = cache_misses(results, spark.read.parquet(path), key)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    results.write.mode("append").parquet(path)
