"""Measurement rows stored by cast, so that work on casts moves no rows.

``{path}/ordinary`` is bucketed by cast: all rows of a cast lie in one bucket, and windows and joins by cast run on the
buckets as they are. Casts above ``layout.MAX_ROWS_PER_CAST`` would make one bucket the work of one task; their rows lie
in ``{path}/large``, which is not bucketed, and are cut into chunks when they are used. ``{path}/layout`` says how
many buckets there are and which columns, so a copy can be read in any session.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from plumbline.operators import layout
from plumbline.schema import CAST
from plumbline.sources.files import prepared

BUCKETS = 200


@dataclass(frozen=True)
class StoredCasts:
    """Rows by cast: those of ordinary casts, and those of large casts, if there are any."""

    ordinary: DataFrame
    large: DataFrame | None

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> StoredCasts:
        """Apply something that works on single rows."""
        return StoredCasts(fn(self.ordinary), None if self.large is None else fn(self.large))

    def rows(self) -> DataFrame:
        return self.ordinary if self.large is None else self.ordinary.unionByName(self.large)


def _name(path: str) -> str:
    return "by_cast_" + hashlib.sha256(path.encode()).hexdigest()[:24]


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """A task that writes one bucket needs no sort by bucket, which would spill whole rows.

    Spark leaves that sort out where a task may have several files open, and sorts only what comes beyond these.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_by_cast(df: DataFrame, path: str, buckets: int = BUCKETS, max_rows: int | None = None) -> None:
    """Store rows by cast in a new folder. Rows without a cast take part in no test and are left out."""
    spark, rows = df.sparkSession, df.filter(df[CAST].isNotNull())
    ids = layout.large_casts(rows, max_rows)
    ordinary = rows if ids is None else rows.join(ids, CAST, "left_anti")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    # One file per bucket; a bucket holds many ordinary casts.
    with _unsorted(spark):
        ordinary.repartition(buckets, CAST).write.bucketBy(buckets, CAST).options(
            path=f"{path}/ordinary", compression="zstd").saveAsTable(_name(path))
    if ids is not None:
        rows.join(ids, CAST, "left_semi").write.parquet(f"{path}/large")
    told = spark.createDataFrame([(buckets, df.schema.json(), ids is not None)], "buckets int, columns string, large boolean")
    told.write.json(f"{path}/layout")


def read_by_cast(spark: SparkSession, path: str) -> StoredCasts:
    """A copy that ``write_by_cast`` made."""
    prepared(spark)
    told = spark.read.schema("buckets int, columns string, large boolean").json(f"{path}/layout").first()
    schema = T.StructType.fromJson(json.loads(told["columns"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet CLUSTERED BY ({CAST}) "
        f"INTO {told['buckets']} BUCKETS LOCATION '{path}/ordinary'")
    large = spark.read.schema(schema).parquet(f"{path}/large") if told["large"] else None
    return StoredCasts(spark.table(_name(path)), large)
