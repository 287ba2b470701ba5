"""Outputs of an incremental job as a log of batches over a base, by bucket of the cast.

``{out}/{kind}/entry=N/bucket=K``: batch b writes entry 2 b; a base that holds everything up to batch b is entry 2 b + 1. A
base counts once its marker ``{out}/bases/N`` is there, and a batch once its part of the index is, which it writes
last. The index has a cast's entries, so the latest output of a cast and its earlier rows are found by joins within
the buckets of the casts in question. Compaction writes a new base with only what counts, sets the marker, and
then deletes the entries it replaces; stopped at any point, it can be run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plumbline.operators.lookups import is_small
from plumbline.schema import CAST
from plumbline.sources.files import JSON_FILES, prepared

BUCKET, ENTRY = "bucket", "entry"
BUCKETS = 32
INDEX, ROWS = "index", "rows"
FORMATS = {"documents": "json"}  # all others are parquet
WRITERS, MAX_WRITERS = "spark.sql.maxConcurrentOutputFileWriters", 64  # with more buckets a task sorts the rows of the rest


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    out: str
    buckets: int

    @staticmethod
    def open(spark: SparkSession, out: str, buckets: int | None = None) -> Store:
        """A store keeps the number of buckets it was begun with."""
        prepared(spark)
        new = Store(spark, out, buckets or BUCKETS)
        path = f"{out}/layout"
        if not new._exists(path):
            spark.createDataFrame([(new.buckets,)], "buckets int").write.mode("overwrite").parquet(path)
        return Store(spark, out, spark.read.schema("buckets int").parquet(path).first()[0])

    # ------------------------------------------------------------ files

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._files(path).exists(self._path(path))

    def _names(self, path: str) -> list[str]:
        """Names in a folder; folders of a store hold one name per entry since the base."""
        return [f.getPath().getName() for f in self._files(path).listStatus(self._path(path))] if self._exists(path) else []

    def entries(self, kind: str) -> list[int]:
        return sorted(int(n.removeprefix(f"{ENTRY}=")) for n in self._names(f"{self.out}/{kind}") if n.startswith(f"{ENTRY}="))

    def base(self) -> int:
        """The newest base that is whole, -1 without one."""
        return max((int(n) for n in self._names(f"{self.out}/bases") if n.isdigit()), default=-1)

    # ------------------------------------------------------------ tables

    def bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(CAST), F.lit(self.buckets)).cast("int")

    def put(self, df: DataFrame, kind: str, entry: int) -> None:
        """Write a table with a cast column as an entry, replacing what an earlier attempt left.

        Small buckets share a task and large ones are split at run time. A task keeps the files of its few buckets
        open, so wide rows are not sorted by bucket.
        """
        rows = df.withColumn(BUCKET, self.bucket()).hint("rebalance", F.col(BUCKET))
        fmt, conf = FORMATS.get(kind, "parquet"), df.sparkSession.conf
        before = conf.get(WRITERS)
        conf.set(WRITERS, str(min(self.buckets, MAX_WRITERS)))
        try:
            rows.write.partitionBy(BUCKET).mode("overwrite").format(fmt).options(
                **(JSON_FILES if fmt == "json" else {})).save(f"{self.out}/{kind}/{ENTRY}={entry}")
        finally:
            conf.set(WRITERS, before)

    def get(self, kind: str, schema: T.StructType | None = None, before: int | None = None) -> DataFrame:
        """The entries since the base with ``entry`` and ``bucket``; other bases are not finished."""
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(T.StructType([*schema, T.StructField(ENTRY, T.LongType()), T.StructField(BUCKET, T.IntegerType())]))
        base = self.base()
        entry = F.col(ENTRY)
        rows = reader.format(FORMATS.get(kind, "parquet")).load(f"{self.out}/{kind}").filter(
            (entry == base) | (entry > base) & (entry % 2 == 0))
        return rows if before is None else rows.filter(entry < before)

    def index(self, before: int | None = None) -> DataFrame:
        """(cast, bucket, latest): the last entry of every cast."""
        found = self.get(INDEX, T.StructType([T.StructField(CAST, T.StringType())]), before)
        return found.groupBy(CAST, BUCKET).agg(F.max(ENTRY).alias("latest"))

    def earlier_rows(self, new: DataFrame, entry: int, casts: DataFrame | None = None) -> DataFrame:
        """The rows that earlier batches hold of the casts of a batch (``casts``). Only their buckets are read."""
        casts = (new.select(CAST).distinct() if casts is None else casts).withColumn(BUCKET, self.bucket())
        touched = [r[0] for r in casts.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        rows = self.get(ROWS, new.schema, entry).filter(F.col(BUCKET).isin(touched))
        if is_small(casts):
            casts = F.broadcast(casts)
        return rows.join(casts, [BUCKET, CAST], "left_semi").select(*new.columns)

    def has_earlier(self, entry: int) -> bool:
        """Whether there may be rows of earlier batches."""
        return any(e < entry for e in self.entries(ROWS))

    def current(self, kind: str) -> DataFrame:
        """What counts of an output: of every cast, what its latest batch wrote.

        All of the newest batch counts, so only what is older meets the index.
        """
        rows = self.get(kind)
        base = self.base()
        indexed = [e for e in self.entries(INDEX) if e == base or e > base and e % 2 == 0]
        newest = max(indexed, default=-1)
        # Without the mark of a whole table (a stopped attempt, a committer that leaves none) the index decides.
        if newest >= 0 and self._exists(f"{self.out}/{INDEX}/{ENTRY}={newest}/_SUCCESS"):
            last = rows.filter((F.col(ENTRY) == newest) & F.col(CAST).isNotNull()).drop(ENTRY, BUCKET)
            rows = rows.filter(F.col(ENTRY) < newest)
        else:
            last = None
        if last is not None and newest == min(indexed):
            return last
        found = rows.join(self.index(), [CAST, BUCKET])
        found = found.filter(F.col(ENTRY) == F.col("latest")).drop(ENTRY, BUCKET, "latest")
        return found if last is None else found.unionByName(last)

    def compact(self, entry: int) -> None:
        """Make ``entry`` (odd) the base of all entries before it, and delete what it replaces."""
        kinds = [n for n in self._names(self.out) if n not in ("bases", "layout", INDEX)]
        for kind in kinds:
            if any(e < entry for e in self.entries(kind)):
                whole = self.get(kind).drop(ENTRY, BUCKET) if kind == ROWS else self.current(kind)
                self.put(whole, kind, entry)
        self.put(self.index().select(CAST), INDEX, entry)
        marker = self._path(f"{self.out}/bases/{entry}")
        self._files(self.out).create(marker, True).close()
        self.clean()

    def clean(self) -> None:
        """Delete the entries and markers that the base replaces."""
        base, files = self.base(), self._files(self.out)
        for kind in self._names(self.out):
            for e in self.entries(kind):
                if e < base:
                    files.delete(self._path(f"{self.out}/{kind}/{ENTRY}={e}"), True)
        for name in self._names(f"{self.out}/bases"):
            if name.isdigit() and int(name) < base:
                files.delete(self._path(f"{self.out}/bases/{name}"), False)
