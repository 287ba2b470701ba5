"""How casts are laid out for ordered and whole-group work.

Ordinary casts: one shuffle on the cast id, then plain windows, which all share it.

A cast may also hold a large part of the table. ``per_cast`` counts rows per cast once; the casts above a
fixed limit are cut into depth-ordered chunks of about that size, whatever the table holds besides, and
every helper below combines the chunks through small per-chunk tables. No task ever holds a whole large
cast and the result does not depend on where the cuts are. Ids and cuts are tables, never lists on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.operators.lookups import written
from plumbline.schema import CAST, CHUNK, DEPTH, DIRECTION, MEASURED_AT, PK, PROFILE, QC_GROUP, STATIC_TIME

if TYPE_CHECKING:
    from plumbline.sources.stored import StoredCasts

MAX_ROWS_PER_CAST = 1_000_000  # casts up to this size stay whole; a chunk of a larger one holds about so many rows
_SAMPLES_PER_CHUNK = 64


def assign_qc_group(df: DataFrame) -> DataFrame:
    """Keep profiles and timed static rows; add the static time (0 for profiles) to the group key."""
    static = F.col(DIRECTION) == "s"
    return df.filter(
        F.col(CAST).isNotNull()
        & F.col(DIRECTION).isin("d", "u", "s")
        & (~static | F.col(MEASURED_AT).isNotNull())
    ).withColumn(
        STATIC_TIME, F.when(static, F.unix_micros(F.col(MEASURED_AT).cast("timestamp"))).otherwise(F.lit(0))
    )


def depth_key() -> Column:
    """Comparable position of a row in its profile; a missing depth sorts last."""
    return F.struct(F.coalesce(F.col(DEPTH), F.lit(float("inf"))).alias("depth"), F.col(PK).alias("pk"))


def depth_order() -> list[Column]:
    return [F.col(DEPTH).asc_nulls_last(), F.col(PK).asc()]


# ---------------------------------------------------------------- large casts


ROWS = "qc_rows"  # number of rows of a cast


def large_casts(df: DataFrame, max_rows: int | None = None) -> DataFrame | None:
    """Ids of the casts with more than ``max_rows`` rows; None when there are none.

    One narrow aggregate over the key column, or none if ``df`` has casts with their number of rows (``qc_rows``); the
    driver only learns whether there is such a cast.
    """
    limit = max_rows or MAX_ROWS_PER_CAST
    counts = df if ROWS in df.columns else df.groupBy(CAST).agg(F.count(F.lit(1)).alias(ROWS))
    large = counts.filter(F.col(ROWS) > limit).select(CAST)
    return None if large.isEmpty() else written(large, "large-casts")


def rank_in(cuts: Column, key: Column) -> Column:
    """Number of sorted cuts at or below key, by bisection."""

    def step(s: Column, _: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        mid = F.shiftright(lo + hi, 1)
        return F.when(
            lo < hi,
            F.when(
                F.element_at(cuts, mid + 1) <= key, F.struct((mid + 1).alias("lo"), hi.alias("hi"))
            ).otherwise(F.struct(lo.alias("lo"), mid.alias("hi"))),
        ).otherwise(s)

    n = F.coalesce(F.size(cuts), F.lit(0))
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))
    steps = F.ceil(F.log2(n + F.lit(1))).cast("int") + 1  # enough halvings for so many cuts
    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["lo"])


def with_chunks(df: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Number each row's chunk: consecutive depth ranges of about rows_per_chunk rows per profile.

    The cuts come from a sample fixed by a hash of the row key, so re-runs and lost executors give
    the same cuts. Rows without a depth get odd chunk numbers, after all others of the profile.
    """
    step = max(1, rows_per_chunk // _SAMPLES_PER_CHUNK)
    every = max(1, rows_per_chunk // step)
    sample = df.filter(F.pmod(F.xxhash64(PK), F.lit(step)) == 0).select(*PROFILE, depth_key().alias("cut"))
    place = F.row_number().over(W.partitionBy(*PROFILE).orderBy("cut"))
    cuts = written(
        sample.withColumn("place", place)
        .filter(F.col("place") % every == 0)
        .groupBy(*PROFILE)
        .agg(F.sort_array(F.collect_list("cut")).alias("cuts")), "cuts")
    chunk = F.when(F.col("cuts").isNull(), F.lit(0)).otherwise(rank_in(F.col("cuts"), depth_key()))
    return (
        df.join(cuts, PROFILE, "left")  # a few profiles: broadcast or split at run time, by their real size
        .withColumn(CHUNK, chunk * 2 + F.col(DEPTH).isNull().cast("int"))
        .drop("cuts")
    )


def per_cast(
    df: DataFrame | StoredCasts,
    fn: Callable[[DataFrame], DataFrame],
    max_rows: int | None = None,
    sized: DataFrame | None = None,
    tables: Sequence[DataFrame] = (),
) -> DataFrame:
    """Apply an operator that works on whole casts, cutting the large ones.

    ``sized``: the same rows with less work in their plan, for counting, or the casts with their ``qc_rows``.
    ``tables``: tables with one row per cast, left joined to the result. For ordinary casts this join
    uses the partitioning that is there; of the cut ones only the few matching rows take part.
    Rows that are stored by cast (``sources.stored``) are neither counted nor moved.
    """
    if isinstance(df, DataFrame):
        ids = large_casts(df if sized is None else sized, max_rows)
        ordinary = (df if ids is None else df.join(ids, CAST, "left_anti")).repartition(CAST)
        large = None if ids is None else df.join(ids, CAST, "left_semi")
    else:
        ordinary, large = df.ordinary, df.large
        ids = None if large is None else written(large.select(CAST).distinct(), "large-casts")
    out = fn(ordinary)
    for table in tables:  # left joins keep the partitioning by cast
        out = out.join(table, CAST, "left")
    if large is None:
        return out
    cut = with_chunks(large, max_rows or MAX_ROWS_PER_CAST)
    cut = fn(cut.repartition(CAST, DIRECTION, CHUNK))
    for table in tables:
        cut = cut.join(table.join(ids, CAST, "left_semi"), CAST, "left")
    return out.unionByName(cut.drop(CHUNK))


# ------------------------------------------------- whole groups and neighbours
#
# Each helper adds columns to ``df``. For cut casts it first builds a small table from ``source``: rows
# with the same chunks and the columns in question but a shorter plan (``df`` itself by default). Steps
# that follow each other share one source, so the plan grows by a constant per step.


def _chunk(df: DataFrame) -> list[str]:
    return [CHUNK] if CHUNK in df.columns else []


def totals(
    df: DataFrame,
    group: Sequence[str],
    aggregates: dict[str, Column],
    per_cast: dict[str, Column] | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add aggregates over each whole group; ``per_cast`` are aggregates of those over the cast.

    Group columns must not be NULL.
    """
    group, per_cast = list(group), per_cast or {}
    if not _chunk(df):
        w = W.partitionBy(*group)
        out = df.withColumns({name: agg.over(w) for name, agg in aggregates.items()})
        return out.withColumns({name: agg.over(W.partitionBy(CAST)) for name, agg in per_cast.items()})
    rows = df if source is None else source
    full = rows.groupBy(*group).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    full = full.withColumns({name: agg.over(W.partitionBy(CAST)) for name, agg in per_cast.items()})
    if set(group) <= set(PROFILE):
        return df.join(full, group, "left")
    present = rows.select(*group, CHUNK).distinct().join(full, group)
    return df.join(present, [*group, CHUNK], "left")


def neighbours(
    df: DataFrame,
    fields: dict[str, Column],
    before: str | None,
    after: str | None,
    group: Sequence[str] = QC_GROUP,
    source: DataFrame | None = None,
    fields_after: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the fields of the row above (``before``) and below (``after``) in depth order as structs.

    The struct is NULL where there is no such row. ``fields_after``: other fields of the row below.
    """
    record = F.struct(*[c.alias(n) for n, c in fields.items()])
    following = F.struct(*[c.alias(n) for n, c in (fields_after or fields).items()])
    w = W.partitionBy(*group, *_chunk(df)).orderBy(*depth_order())
    new = {}
    if before:
        new[before] = F.lag(record).over(w)
    if after:
        new[after] = F.lead(following).over(w)
    out = df.withColumns(new)
    if not _chunk(df):
        return out
    across = W.partitionBy(*group).orderBy(CHUNK)
    edges = (
        (df if source is None else source).groupBy(*group, CHUNK)
        .agg(F.min_by(following, depth_key()).alias("first"), F.max_by(record, depth_key()).alias("last"))
        .select(
            *group, CHUNK,
            F.lag("last").over(across).alias("edge_before"), F.lead("first").over(across).alias("edge_after"))
    )
    out = out.join(edges, [*group, CHUNK], "left")
    if before:
        out = out.withColumn(before, F.coalesce(before, "edge_before"))
    if after:
        out = out.withColumn(after, F.coalesce(after, "edge_after"))
    return out.drop("edge_before", "edge_after")


def max_from_bottom(
    df: DataFrame, column: str, name: str, group: Sequence[str] = PROFILE, source: DataFrame | None = None
) -> DataFrame:
    """Add the running maximum of a column from the deepest row up to the current one."""
    upward = [F.col(DEPTH).desc_nulls_last(), F.col(PK).desc()]
    w = W.partitionBy(*group, *_chunk(df)).orderBy(*upward).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = df.withColumn(name, F.max(column).over(w))
    if not _chunk(df):
        return out
    # Rows without depth (odd chunks) count as the shallowest, hence the order of chunks.
    deeper = (
        W.partitionBy(*group)
        .orderBy((F.col(CHUNK) % 2).asc(), F.col(CHUNK).desc())
        .rowsBetween(W.unboundedPreceding, -1)
    )
    carried = (
        (df if source is None else source).groupBy(*group, CHUNK)
        .agg(F.max(column).alias("chunk_max"))
        .select(*group, CHUNK, F.max("chunk_max").over(deeper).alias("carried"))
    )
    out = out.join(carried, [*group, CHUNK], "left")
    return out.withColumn(name, F.greatest(name, "carried")).drop("carried")


# ------------------------------------------------------------------------ halo

HALO = "qc_halo"


def ordered(df: DataFrame, group: Sequence[str] = QC_GROUP) -> W:
    """Window over the rows of a profile, or of the chunk of a cut one, in depth order."""
    return W.partitionBy(*group, *_chunk(df)).orderBy(*depth_order())


def with_halo(df: DataFrame, back: int, ahead: int, group: Sequence[str] = QC_GROUP) -> DataFrame:
    """Give every chunk copies of the ``back`` rows before and the ``ahead`` rows after it, marked in ``qc_halo``.

    The copies may come from more than one chunk, where chunks are smaller than the halo. Only the rows at the ends
    of chunks are copied: a row is numbered within its profile by the sizes of the chunks before and its place
    from the end of its own, and meets the chunks that begin (or end) within reach by blocks of numbers.
    """
    rows, keys = df.withColumn(HALO, F.lit(False)), [*group, CHUNK]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    until = W.partitionBy(*group).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, W.currentRow)
    chunks = sizes.withColumn("stop", F.sum("n").over(until)).withColumn("start", F.col("stop") - F.col("n"))
    chunks = written(chunks, "chunk-sizes")
    names, out = df.columns, rows
    for reach, edge in ((back, "start"), (ahead, "stop")):
        if not reach:
            continue
        order = depth_order() if edge == "stop" else [F.col(DEPTH).desc_nulls_first(), F.col(PK).desc()]
        place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        ends = df.withColumn("place", place).filter(F.col("place") <= reach).join(
            chunks.select(*keys, F.col("start" if edge == "stop" else "stop").alias("corner")), keys)
        # Numbers from 0: a row before a chunk's start, or at or after a chunk's stop.
        number = F.col("corner") + F.col("place") - 1 if edge == "stop" else F.col("corner") - F.col("place")
        block = lambda c: F.floor(c / reach).cast("long")
        near = F.array(block(F.col("number")), block(F.col("number")) + (1 if edge == "start" else -1))
        ends = ends.withColumn("number", number).withColumn("block", F.explode(near)).drop(CHUNK, "place", "corner")
        targets = chunks.select(*group, CHUNK, F.col(edge).alias("edge"), block(F.col(edge)).alias("block"))
        gap = F.col("edge") - F.col("number") if edge == "start" else F.col("number") - F.col("edge") + 1
        reached = ends.join(targets, [*group, "block"]).filter(gap.between(1, reach))
        out = out.unionByName(reached.select(*names).withColumn(HALO, F.lit(True)))
    return out


def with_user_tests(df: DataFrame, tests: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply tests that may look ``back`` and ``ahead`` a stated number of rows (attributes of the test, 0 by default).

    Rows of whole casts are passed on as they are. Cut casts are written once, and their chunks get the widest halo of
    all tests; the copies go again afterwards, so a test's own windows (``ordered``) see what they see in a whole cast.
    """
    back, ahead = (max((getattr(t, side, 0) for t in tests), default=0) for side in ("back", "ahead"))
    cut = bool(_chunk(df)) and (back or ahead)
    out = df
    if cut:
        out = with_halo(written(df, "cut-casts"), back, ahead).repartition(CAST, DIRECTION, CHUNK)
    for test in tests:
        out = test(out)
    return out.filter(~F.col(HALO)).drop(HALO) if cut else out
