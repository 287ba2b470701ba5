"""Time columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from plumbline.schema import TIME_COLUMNS


def to_utc(df: DataFrame, columns: Iterable[str] = TIME_COLUMNS) -> DataFrame:
    """Parse ISO text (or zone-less timestamps) to timestamps; unreadable text gives NULL.

    The session time zone must be UTC, which ``sources.files`` sets.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema}
    new = {}
    for c in columns:
        if c in types:
            new[c] = F.try_to_timestamp(c) if types[c] == "string" else F.col(c).cast("timestamp")
    return df.withColumns(new)
