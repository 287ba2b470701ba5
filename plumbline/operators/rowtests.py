"""Tests that need one row only. They also run on a stream."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.config import GrossRange, QueryRule
from plumbline.functions import flags
from plumbline.schema import BAD_VALUE, FAIL


def gross_range(df: DataFrame, spans: dict[str, GrossRange]) -> DataFrame:
    return df.withColumns({f"{v}_qartod_gross_range_test": flags.gross_range(F.col(v), s) for v, s in spans.items()})


def bad_value(
    df: DataFrame, variables: Iterable[str], mapping: Sequence[tuple[int, Sequence[float]]] = ((FAIL, (BAD_VALUE,)),)
) -> DataFrame:
    """Flag missing and vendor-marked values. Must come before ``null_sentinels``."""
    return df.withColumns({f"{v}_hakai_bad_value_test": flags.bad_value(F.col(v), mapping) for v in variables})


def null_sentinels(df: DataFrame, values: Sequence[float] = (BAD_VALUE,)) -> DataFrame:
    """Replace vendor marks and NaN in every floating-point column by NULL."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: flags.without_bad_values(F.col(f"`{c}`"), values) for c in doubles})


def query_flags(df: DataFrame, rules: Sequence[QueryRule]) -> DataFrame:
    """One column per flag named by the rules."""
    columns = dict.fromkeys(c for r in rules for c in r.columns)
    return df.withColumns({c: flags.query_flag(c, rules) for c in columns})
