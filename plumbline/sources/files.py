"""Readers and writers. Every reader has a fixed schema; nothing is inferred from data."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from plumbline import schema as S


# Rows here are wide. Past these limits one generated method would hold the work on all columns, and the
# JVM never compiles a method of more than 8000 bytes; Spark's per-expression code is several times faster.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.maxFields": "40",
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings this library relies on."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def no_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL, once, at the door: in Spark NaN compares as larger than any number."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in doubles})


def _read(spark: SparkSession, path, fmt: str, schema: T.StructType) -> DataFrame:
    return prepared(spark).read.schema(schema).format(fmt).load(path)


def read_ctd_data(spark: SparkSession, path, fmt: str = "parquet", iso_text: bool | None = None) -> DataFrame:
    """Measurement rows. ``iso_text``: times are ISO strings (the default for JSON)."""
    as_text = fmt == "json" if iso_text is None else iso_text
    df = no_nan(_read(spark, path, fmt, S.ctd_data_schema("string" if as_text else "timestamp")))
    if not as_text:
        return df
    from plumbline.operators.timecols import to_utc

    return to_utc(df)


def read_casts(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, S.casts_schema())


def read_metadata(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, S.metadata_schema())


def read_manual_qc(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, S.manual_qc_schema())


def read_stations(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, S.stations_schema()).withColumnsRenamed(
        {"name": "station", "depth": "station_depth"})


def read_grey_list(spark: SparkSession, path) -> DataFrame:
    """Override rules with their line order as ``seq``, from one file, several, or a folder.

    Files count in the order of their names and lines in the order of the file, however the files are split or dealt to
    tasks: lines are numbered within each block of a file, and blocks by the sizes of those before.
    """
    rules = prepared(spark).read.schema(S.grey_list_schema()).csv(path, header=True, escape='"')
    lines = rules.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__line"))
    place = ["__file", "__block"]
    numbered = lines.withColumn("__at", F.row_number().over(W.partitionBy(*place).orderBy("__line")))
    before = W.orderBy(*place).rowsBetween(W.unboundedPreceding, -1)  # one row per block of a file
    starts = lines.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).select(
        *place, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    out = numbered.join(starts, place).withColumn("seq", F.col("__start") + F.col("__at") - 1)
    return out.select(*rules.columns, "seq")


def read_id_list(spark: SparkSession, path) -> DataFrame:
    """Cast ids from text lines; ``#`` starts a comment."""
    return (
        spark.read.text(path)
        .select(F.trim(F.split("value", "#")[0]).alias(S.CAST))
        .filter(F.col(S.CAST) != "")
    )


# JSON names every column in every row: compressed it takes a small part of the disk. Readers know files by their ending.
JSON_FILES = {"compression": "gzip"}
ROWS_PER_FILE = 1_000_000  # one task reads a compressed file


def write_snapshot(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Copy of a table, such as the rows and metadata of a regression suite, as parquet or as compressed JSON lines."""
    lines = JSON_FILES | {"zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(ROWS_PER_FILE)}
    options = lines if fmt == "json" else {}
    df.write.mode(mode).format(fmt).options(**options).save(path)


def flags_json(
    casts: DataFrame, qced: DataFrame, rows_per_document: int = 100_000, sized: DataFrame | None = None
) -> DataFrame:
    """Upload documents ``{cast: {...}, ctd_data: [{...}]}`` per cast.

    A cast with more than ``rows_per_document`` rows gives several documents, each with the cast header
    and a share of the rows; ``part`` numbers them. Together they hold every row exactly once. The number of
    parts follows from the cast's own rows only, so its documents are the same whatever else is in the run.
    ``sized``: rows of the same casts with less work in their plan, for counting.
    """
    columns = [
        c for c in qced.columns
        if c == S.PK or (c.endswith(("_flag", "_flag_level_1")) and c not in S.NOT_UPLOADED)
    ]
    rows = qced.select(S.CAST, F.struct(*columns).alias("row"))
    counted = qced if sized is None else sized
    counts = counted.groupBy(S.CAST).agg(F.ceil(F.count(F.lit(1)) / rows_per_document).cast("int").alias("parts"))
    several = counts.filter("parts > 1")
    rows = rows.join(several, S.CAST, "left")
    part = F.pmod(F.xxhash64(f"row.{S.PK}"), F.coalesce(F.col("parts"), F.lit(1))).cast("int")
    documents = (
        rows.withColumn("part", part)
        .groupBy(S.CAST, "part")
        .agg(F.sort_array(F.collect_list("row")).alias("ctd_data"))
    )
    header = F.struct("ctd_cast_pk", S.CAST, "processing_stage", F.coalesce("process_error", F.lit("")).alias("process_error"))
    body = F.to_json(F.struct(F.col("cast"), "ctd_data"), {"ignoreNullFields": "false"})
    return (
        casts.select(S.CAST, "ctd_cast_pk", header.alias("cast"))
        .join(documents, S.CAST, "left")
        .withColumn("ctd_data", F.coalesce("ctd_data", F.array().cast(documents.schema["ctd_data"].dataType)))
        .select("ctd_cast_pk", S.CAST, F.coalesce("part", F.lit(0)).alias("part"), body.alias("json"))
    )


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per line."""
    documents.select(F.col("json").alias("value")).write.mode(mode).text(path)


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="plumbline-")


_JOB: ContextVar[str | None] = ContextVar("job", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables: that of the job, else ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    configured = _JOB.get() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file://" + os.path.abspath(_local_folder())


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables of a job go to a folder of its own, which is deleted at the end.

    Everything the job returns must be written by then.
    """
    path = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _JOB.set(path)
    try:
        yield path
    finally:
        _JOB.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
