"""Review reports over casts, manual reviews and stations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.operators.layout import rank_in
from plumbline.operators.lookups import lookup, written
from plumbline.schema import CAST, DEPTH

STATION_FLAG = "depth_in_station_range_test"


def manual_qc_status(
    casts: DataFrame, manual_qc: DataFrame, min_drops: int = 2, qced_only: bool = False
) -> DataFrame:
    """Per (organization, work_area, station): drops, reviewed drops, count per flag, last reviewed drop."""
    flags = [c for c in [*casts.columns, *manual_qc.columns] if "_flag" in c]
    keys = ["organization", "work_area", "station"]
    both = casts.join(manual_qc, ["work_area", CAST], "full")
    both = both.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    reviewed = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in flags])
    out = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_drops"),
        F.count_if(reviewed).alias("n_qced"),
        *[F.count(c).alias(c) for c in flags],
        F.max(F.when(reviewed, F.col("start_dt"))).alias("last_drop_qced"),
    )
    out = out.filter(F.col("n_drops") >= min_drops)
    if qced_only:
        out = out.filter("n_qced > 0")
    return out.select(*keys, "n_drops", "n_qced", (F.col("n_drops") - F.col("n_qced")).alias("n_not_qced"),
                      *flags, "last_drop_qced")


FEW_VALUES = 10_000  # distinct values of a group that one task ranks
CUTS = 64


def lower_median(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Discrete median per group, exact, without ranking a group in one task.

    Distinct values are counted first. Then rounds of histograms narrow each group to the bin that holds its middle rank,
    until no group has more than FEW_VALUES values left, which are ranked. The bins of a round are cut by a mergeable
    quantile sketch of the values that are left, so each round leaves about one in CUTS however the values lie.
    """
    group = list(group)
    w = W.partitionBy(*group)
    values = written(
        df.filter(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n")), "values")
    ranks = values.groupBy(*group).agg(F.floor((F.sum("n") + 1) / 2).alias("rank"), F.count(F.lit(1)).alias("left"))
    ranks = written(ranks, "ranks")
    while (ranks.agg(F.max("left")).first()[0] or 0) > FEW_VALUES:
        shares = [i / CUTS for i in range(1, CUTS)]
        cuts = values.groupBy(*group).agg(F.array_distinct(F.percentile_approx("value", shares, 100 * CUTS)).alias("cuts"))
        # The groups are few next to the values; a group with very many of them is split by the join.
        binned = written(
            lookup(values, cuts, group, spread_by="value").withColumn("bin", rank_in(F.col("cuts"), F.col("value"))).drop("cuts"), "bins")
        bins = binned.groupBy(*group, "bin").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("left"))
        upto = F.sum("n").over(w.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow))
        middle = (
            bins.withColumn("upto", upto).join(ranks.drop("left"), group)
            .filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
            .select(*group, "bin", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "left"))
        ranks = written(middle, "ranks")
        values = written(lookup(binned, ranks.select(*group, "bin", F.lit(True).alias("middle")), [*group, "bin"], spread_by="value")
                         .filter("middle").select(*group, "value", "n"), "values")
        ranks = ranks.drop("bin")
    within = w.orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        values.withColumn("upto", F.sum("n").over(within)).join(ranks, group)
        .filter(F.col("upto") >= F.col("rank"))
        .groupBy(*group).agg(F.min("value").alias(name))
    )


def station_flag_review(data: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations with casts flagged as too deep, next to the statistics of all their casts.

    Deepest rows per (station, cast) are found once; whether a cast was flagged comes with them.
    """
    flagged = F.col("temperature_flag").like(f"%{STATION_FLAG}%")
    # One row per station and cast, written: everything below reads it, so the data are read once.
    drops = written(data.groupBy("station", CAST).agg(
        F.max(DEPTH).alias("max_depth"),
        F.max(F.when(flagged, F.col(DEPTH))).alias("flagged_max_depth"),
        F.coalesce(F.max(flagged), F.lit(False)).alias("flagged"),
    ), "drops")
    bad = F.when(F.col("flagged"), F.col("flagged_max_depth"))
    known = F.col("station").isNotNull()  # totals are looked up by station, so not for rows without one
    per_station = drops.groupBy("station").agg(
        F.count_if("flagged").alias("flagged_profiles_count"),
        F.when(known, F.count(F.lit(1))).alias("total_drops_count"),
        F.avg(bad).alias("flagged_avg_max_depth"),
        F.when(known, F.avg("max_depth")).alias("total_avg_max_depth"),
        F.stddev_samp(bad).alias("flagged_std_max_depth"),
        F.when(known, F.stddev_samp("max_depth")).alias("total_std_max_depth"),
    ).filter("flagged_profiles_count > 0")
    reviewed = drops.join(per_station.filter(known).select("station"), "station", "left_semi")
    median = lower_median(reviewed, ["station"], "max_depth", "total_median_max_depth")
    return (
        lookup(per_station.join(median, "station", "left"), stations, ["station"], spread_by="station")
        .orderBy(F.desc("flagged_profiles_count"), "station")
    )


def location_review(casts: DataFrame) -> DataFrame:
    """Casts flagged by position, estuaries apart: counts and mean position."""
    code = F.col("location_flag_level_1")
    area = F.when(F.col("work_area") == "ESTUARY", "estuary").otherwise("other")
    return casts.filter(code.isin(3, 4)).groupBy(area.alias("area_class")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(code == 3).alias("n_suspect"),
        F.count_if(code == 4).alias("n_fail"),
        F.avg("latitude").alias("mean_latitude"),
        F.avg("longitude").alias("mean_longitude"),
    )


def location_offsets(casts: DataFrame) -> DataFrame:
    """Line from the cast to its station for every cast flagged by position."""
    return casts.filter(F.col("location_flag_level_1").isin(3, 4)).select(
        CAST, "station", "latitude", "longitude", "station_latitude", "station_longitude")


def compare_stations(a: DataFrame, b: DataFrame, columns: Sequence[str], tol: float = 2.0) -> DataFrame:
    """Stations of two lists whose cells differ: both values per differing cell and the depth difference.

    ``beyond_tolerance`` marks depth differences larger than ``tol``.
    """
    both = a.alias("a").join(b.alias("b"), "station")

    def differs(c: str) -> Column:
        return ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))

    cells = []
    for c in columns:
        cells += [F.when(differs(c), F.col(f"{s}.{c}")).alias(f"{c}_{n}") for s, n in (("a", "first"), ("b", "second"))]
    delta = F.when(differs("station_depth"), F.col("a.station_depth") - F.col("b.station_depth"))
    return (
        both.filter(reduce(lambda x, y: x | y, [differs(c) for c in columns]))
        .select("station", *cells, delta.alias("delta_depth"))
        .withColumn("beyond_tolerance", F.coalesce(F.abs("delta_depth") > tol, F.lit(False)))
    )
