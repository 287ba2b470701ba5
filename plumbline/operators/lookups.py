"""Joins of measurement rows with side tables on keys other than the cast."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plumbline.schema import PK
from plumbline.sources.files import shared_folder

BROADCAST_ROWS = 100_000
HEAVY_KEYS = 1024  # keys that the sketch reports at most
COUNTERS = 16_384  # of the sketch: a key with more than about one in 2,400 rows is found
PARTS = 16  # of a key with as many rows as a partition should hold; more parts, more even


def written(table: DataFrame, name: str) -> DataFrame:
    """Write a small table that several steps use to the shared folder and read it back: it is computed once."""
    path = f"{shared_folder(table.sparkSession)}/{name}-{uuid.uuid4().hex}"
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``rows`` rows; reads no more than one row beyond that."""
    return table.limit(rows + 1).count() <= rows


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> list[dict]:
    """Hashes of the keys that many rows share, with the number of parts that each is to be split into.

    A sketch of fixed size, merged from all tasks, counts the keys; at most HEAVY_KEYS numbers reach the driver. A key
    with a share s of the rows gets s * PARTS * partitions parts, so its rows spread like those of all others.
    """
    sketch = df.agg(
        F.expr(f"approx_top_k({_hash(keys)}, {HEAVY_KEYS}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [(t["item"], math.ceil(t["count"] / sketch["n"] * partitions * PARTS)) for t in sketch["top"] or []]
    return [{"qc_key": key, "qc_parts": n} for key, n in parts if n >= PARTS]


def _hash(keys: Sequence[str]) -> str:
    return f"xxhash64({', '.join(f'`{k}`' for k in keys)})"


def lookup(
    df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", rows: int = BROADCAST_ROWS,
    spread_by: str = PK, small: bool | None = None,
) -> DataFrame:
    """Join a table with unique keys: broadcast when it is small, else shuffled.

    In the shuffled form the keys that hold a large part of the rows, such as a station or a device, are split into
    parts by their measured share; all other keys stay as they are. ``small`` says so where the rows of the
    table do not tell its size.
    """
    keys = list(keys)
    if is_small(table, rows) if small is None else small:
        return df.join(F.broadcast(table), keys, how)
    heavy = heavy_keys(df.select(*keys), keys)
    if not heavy:
        return df.join(table, keys, how)
    # A constant of the plan with at most HEAVY_KEYS rows.
    parts = F.broadcast(df.sparkSession.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(heavy)), "array<struct<qc_key: long, qc_parts: int>>"))))
    split = lambda d: d.withColumn("qc_key", F.expr(_hash(keys))).join(parts, "qc_key", "left").drop("qc_key")
    part = F.pmod(F.xxhash64(F.col(spread_by), F.lit(1)), F.coalesce("qc_parts", F.lit(1))).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("qc_parts", F.lit(1)) - 1))
    return (
        split(df).withColumn("qc_part", part).drop("qc_parts")
        .join(split(table).withColumn("qc_part", copies).drop("qc_parts"), [*keys, "qc_part"], how)
        .drop("qc_part")
    )
