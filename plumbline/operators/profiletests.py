"""Tests over one profile, in depth order or as a whole.

Each takes rows laid out by ``layout.per_cast``; run them inside it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.config import Attenuated, Inversion
from plumbline.functions import flags
from plumbline.operators import layout
from plumbline.operators.casttests import Facts
from plumbline.schema import (
    CAST, DEPTH, DIRECTION, FAIL, GOOD, MEASURED_AT, MISSING, PROFILE, SUSPECT, UNKNOWN,
)

# Choices where the published test definitions leave room.
FIRST_ROW_OF_PROFILE = GOOD  # rate of change without a row before
MISSING_NEIGHBOUR = GOOD  # rate of change next to a missing value
SINGLE_POINT = UNKNOWN  # density inversion of a lone row
# Rate of change: timestamps differ by whole seconds rounded down with their sign, so a step back of 0.3 s counts as
# one second; rows at the same time are compared with the threshold itself, as if one second lay between them.
ROUND_DOWN_WITH_SIGN = True
SECONDS_AT_SAME_TIME = 1
STDDEV_DIGITS = 9  # averages are rounded before they are compared


def _seconds_between(df: DataFrame, time: str, before: Column) -> Column:
    """Whole seconds between two timestamps, or the plain difference of a numeric clock; never zero."""
    if isinstance(df.schema[time].dataType, (T.TimestampType, T.TimestampNTZType)):
        micros = [F.unix_micros(c.cast("timestamp")) for c in (F.col(time), before)]
        apart = micros[0] - micros[1]
        seconds = F.abs(F.floor((apart if ROUND_DOWN_WITH_SIGN else F.abs(apart)) / F.lit(1_000_000)))
    else:
        seconds = F.abs(F.col(time) - before)
    return F.when(seconds == 0, SECONDS_AT_SAME_TIME).otherwise(seconds)


def _rate_flag(df: DataFrame, var: str, time: str, threshold: float, before: str) -> Column:
    value, prev = F.col(var), F.col(f"{before}.{var}")
    too_fast = F.abs(value - prev) > F.lit(float(threshold)) * _seconds_between(df, time, F.col(f"{before}.at"))
    return (
        F.when(value.isNull(), MISSING)
        .when(F.col(before).isNull(), FIRST_ROW_OF_PROFILE)
        .when(prev.isNull(), MISSING_NEIGHBOUR)
        .when(too_fast, SUSPECT)
        .otherwise(GOOD)
    )


def _inversion_flag(density: str, limits: Inversion, before: str, after: str) -> Column:
    here, depth = F.col(density), F.col(DEPTH)

    def step(other: str, sign: int) -> Column:
        return (
            F.signum((depth - F.col(f"{other}.{DEPTH}")) * sign) * (here - F.col(f"{other}.{density}")) * sign
        )

    drop = F.least(step(before, 1), step(after, -1))  # ignores a missing side
    return (
        F.when(here.isNull() | depth.isNull(), MISSING)
        .when(F.col(before).isNull() & F.col(after).isNull(), SINGLE_POINT)
        .when(drop < limits.fail, FAIL)
        .when(drop < limits.suspect, SUSPECT)
        .otherwise(GOOD)
    )


def neighbour_tests(
    df: DataFrame,
    rates: Mapping[str, float],
    inversions: Mapping[str, Inversion],
    time: str = MEASURED_AT,
) -> DataFrame:
    """Rate of change against the row above and density inversion against both neighbours, in one pass."""
    before, after = "qc_before", "qc_after"
    fields = {v: F.col(v) for v in dict.fromkeys([*rates, *inversions, *([DEPTH] if inversions else [])])}
    if rates:
        fields["at"] = F.col(time)
    below = {v: F.col(v) for v in [*inversions, DEPTH]}
    out = layout.neighbours(df, fields, before, after if inversions else None, fields_after=below)
    new = {f"{v}_qartod_rate_of_change_test": _rate_flag(df, v, time, t, before) for v, t in rates.items()}
    new |= {
        f"{v}_qartod_density_inversion_test": _inversion_flag(v, lim, before, after) for v, lim in inversions.items()
    }
    return out.withColumns(new).drop(before, after)


def rate_of_change(df: DataFrame, var: str, threshold: float, time: str = MEASURED_AT) -> DataFrame:
    return neighbour_tests(df, {var: threshold}, {}, time)


def density_inversion(df: DataFrame, density: str, limits: Inversion) -> DataFrame:
    return neighbour_tests(df, {}, {density: limits})


def _spread(t: Attenuated, var: str, value: Column | None = None, of: str = "") -> tuple[dict[str, Column], Column]:
    """The totals that an attenuated-signal test needs, and its spread from them."""
    value = F.col(var) if value is None else value
    if t.check == "range":
        names = f"qc_max_{var}{of}", f"qc_min_{var}{of}"
        return {names[0]: F.max(value), names[1]: F.min(value)}, F.col(names[0]) - F.col(names[1])
    if t.check == "std":
        return {f"qc_std_{var}{of}": F.stddev_pop(value)}, F.round(f"qc_std_{var}{of}", STDDEV_DIGITS)
    raise ValueError(f"unknown check {t.check!r} for {var}")


def _spread_flag(t: Attenuated, spread: Column) -> Column:
    return F.when(spread < t.fail, FAIL).when(spread < t.suspect, SUSPECT).otherwise(GOOD)


ATTENUATED_WORDS = "qc_attenuated"


def profile_facts(df: DataFrame, attenuated: Mapping[str, Attenuated], counted: str | None = None) -> Facts:
    """The attenuated-signal verdicts of a cast's profiles, by pre-aggregated sums only.

    The verdicts of each direction are packed; ``attenuated_flags`` gives rows their columns. ``qc_any`` is the
    cast's number of values of ``counted`` and ``qc_rows`` that of its rows.
    """
    totals = {"qc_any": F.count(f"qc_of_{counted}") if counted else F.lit(0), layout.ROWS: F.count("qc_direction")}
    words: dict[str, Column] = {}
    for d in ("d", "u"):
        codes = {}
        for var, t in attenuated.items():
            parts, spread = _spread(t, var, F.when(F.col("qc_direction") == d, F.col(f"qc_of_{var}")), f"_{d}")
            totals |= parts
            codes[f"{var}_{d}"] = _spread_flag(t, spread)
        words |= {f"{w}_{d}": c for w, c in flags.packed(codes, ATTENUATED_WORDS).items()}
    names = dict.fromkeys([*attenuated, *([counted] if counted else [])])
    rows = df.select(CAST, F.col(DIRECTION).alias("qc_direction"), *[F.col(v).alias(f"qc_of_{v}") for v in names])
    return Facts(rows, totals, {"qc_any": F.col("qc_any"), layout.ROWS: F.col(layout.ROWS), **words})


def attenuated_flags(
    df: DataFrame, attenuated: Mapping[str, Attenuated], valued: Mapping[str, str]
) -> tuple[DataFrame, list[str], dict[str, str]]:
    """The words of a row's direction from joined ``profile_facts``, which go; their names, and the SQL of the
    attenuated-signal column of every variable. ``valued`` is the SQL of whether a variable has a value."""
    if not attenuated:
        return df, [], {}
    names = sorted(c[:-2] for c in df.columns if c.startswith(ATTENUATED_WORDS) and c.endswith("_d"))
    own = lambda w: F.when(F.col(DIRECTION) == "d", F.col(f"{w}_d")).when(F.col(DIRECTION) != "s", F.col(f"{w}_u"))
    out = df.withColumns({w: own(w) for w in names}).drop(*[f"{w}_{d}" for w in names for d in ("d", "u")])
    codes = flags.unpacked(list(attenuated), ATTENUATED_WORDS)
    # Static rows have no words.
    return out, names, {
        f"{v}_qartod_attenuated_signal_test": f"IF({names[0]} IS NULL, NULL, IF({valued[v]}, {codes[v]}, {MISSING}))"
        for v in attenuated}


def whole_profile_tests(
    df: DataFrame,
    attenuated: Mapping[str, Attenuated] | None = None,
    inversion_flag: str | None = None,
    count_per_cast: str | None = None,
) -> DataFrame:
    """Tests on totals of a profile, sharing one pass: attenuated signal and bottom hit.

    ``count_per_cast`` also leaves the cast's number of values of that column as ``qc_any``.
    """
    attenuated = attenuated or {}
    parts, per_cast, new = {}, {}, {}
    for var, t in attenuated.items():
        totals, spread = _spread(t, var)
        parts |= totals
        flag = F.when(F.col(var).isNull(), MISSING).otherwise(_spread_flag(t, spread))
        new[f"{var}_qartod_attenuated_signal_test"] = F.when(F.col(DIRECTION) != "s", flag)
    if inversion_flag:
        code = F.col(inversion_flag)
        parts["qc_last"] = F.max_by(code, F.when(code.isNotNull(), layout.depth_key()))
        parts["qc_deepest_good"] = F.max(F.when(code == GOOD, F.col(DEPTH)))
        per_cast["qc_hit"] = F.max(F.col("qc_last").isin(SUSPECT, FAIL))
        below = F.col("qc_hit") & (F.col(DEPTH) > F.col("qc_deepest_good"))
        new["bottom_hit_test"] = F.when(below, FAIL).otherwise(GOOD)
    if count_per_cast:
        parts["qc_n"] = F.count(count_per_cast)
        per_cast["qc_any"] = F.max("qc_n")
    out = layout.totals(df, PROFILE, parts, per_cast)
    return out.withColumns(new).drop(*parts, "qc_hit")


def attenuated_signal(df: DataFrame, tests: Mapping[str, Attenuated]) -> DataFrame:
    """One verdict per profile from its spread; static rows have none (NULL)."""
    return whole_profile_tests(df, attenuated=tests)


def bottom_hit(df: DataFrame, flag: str = "sigma0_qartod_density_inversion_test") -> DataFrame:
    """FAIL below the deepest good row of every direction of a cast whose deepest row is an inversion."""
    return whole_profile_tests(df, inversion_flag=flag)


def par_shadow(
    df: DataFrame, var: str = "par", min_par: float = 5.0, source: DataFrame | None = None
) -> DataFrame:
    """SUSPECT where light is weaker than somewhere deeper; UNKNOWN for casts without the sensor."""
    if "qc_any" not in df.columns:
        df = whole_profile_tests(df, count_per_cast=var)
    return shadow_flag(layout.max_from_bottom(df, var, "qc_deeper_max", source=source), var, min_par)


def shadow_flag(df: DataFrame, var: str = "par", min_par: float = 5.0) -> DataFrame:
    """``par_shadow_test`` from the largest value below (``qc_deeper_max``) and the cast's number of values (``qc_any``)."""
    shaded = (F.col(var) < F.col("qc_deeper_max")) & (F.col("qc_deeper_max") > min_par)
    flag = F.when(F.col("qc_any") == 0, UNKNOWN).when(shaded, SUSPECT).otherwise(GOOD)
    return df.withColumn("par_shadow_test", flag).drop("qc_deeper_max", "qc_any")


def spike(df: DataFrame, tests: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Distance of a value from the mean of its two neighbours (documented only, off by default)."""
    out = layout.neighbours(df, {v: F.col(v) for v in tests}, "qc_before", "qc_after")
    new = {}
    for var, (suspect, fail) in tests.items():
        value, prev, nxt = F.col(var), F.col(f"qc_before.{var}"), F.col(f"qc_after.{var}")
        jump = F.abs(value - (prev + nxt) / 2)
        new[f"{var}_qartod_spike_test"] = (
            F.when(value.isNull(), MISSING)
            .when(F.col("qc_before").isNull() | F.col("qc_after").isNull(), UNKNOWN)
            .when(jump > fail, FAIL)
            .when(jump > suspect, SUSPECT)
            .otherwise(GOOD)
        )
    return out.withColumns(new).drop("qc_before", "qc_after")
