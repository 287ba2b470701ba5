"""DuckDB SQL for the registered queries, written from the test definitions on its own."""

from __future__ import annotations

from checks.adapter import VIEWS, ctes
from plumbline.functions import density

# The test parameters, spelled out here as well, so that a wrong number in the library shows.
GROSS = {  # fail span, suspect span
    "conductivity": ((-0.1, 100), (0, 100)), "depth": ((0, 12000), (0, 12000)), "dissolved_oxygen_ml_l": ((0, 20), (1, 15)),
    "dissolved_oxygen_percent": ((-1, 200), (0, 170)), "flc": ((-0.5, 150), (-0.1, 80)), "par": ((-2, 100000), (-1, 50000)),
    "pressure": ((0, 12000), (0, 12000)), "rinko_do_ml_l": ((0, 20), (1, 15)), "salinity": ((0, 45), (2, 42)),
    "temperature": ((-2, 100), (-2, 40)), "turbidity": ((-0.1, 10000), (0, 1000)),
}
RATES = {"dissolved_oxygen_ml_l": 3, "dissolved_oxygen_percent": 30, "rinko_do_ml_l": 3, "salinity": 5, "temperature": 5}
ATTENUATED = {  # suspect, fail, kind
    "c_star_at": (0.002, 0.0001, "range"), "dissolved_oxygen_ml_l": (0.1, 0.01, "range"),
    "dissolved_oxygen_percent": (0.1, 0.01, "range"), "par": (0.05, 0.02, "std"), "rinko_do_ml_l": (0.1, 0.01, "range"),
    "turbidity": (0.01, 0.001, "range"),
}
SPIKE = {
    "dissolved_oxygen_ml_l": (0.5, 1.0), "dissolved_oxygen_percent": (20.0, 40.0), "rinko_do_ml_l": (0.5, 1.0),
    "c_star_at": (0.5, 1.0), "salinity": (0.5, 1.0),
}
SUBMERGED = [  # where, measured variable, flag columns
    ("Mid", "par", ["par_hakai_sensor_mid_submerged_test"]),
    ("Bottom", "par", ["par_hakai_sensor_bottom_submerged_test"]),
    ("Bottom", "dissolved_oxygen_ml_l", [
        "dissolved_oxygen_percent_hakai_sensor_bottom_submerged_test",
        "dissolved_oxygen_ml_l_hakai_sensor_bottom_submerged_test"]),
]
TESTED = sorted({*GROSS, *ATTENUATED, "sigma0"})
CAP = ["dissolved_oxygen_ml_l", "rinko_do_ml_l"]
NO_SOAK = ["dissolved_oxygen_ml_l", "temperature", "conductivity", "salinity"]
SENTINEL = "CAST(-9.99e-29 AS DOUBLE)"
GROUP = "PARTITION BY hakai_id, direction_flag, qc_time"
PROFILE = "PARTITION BY hakai_id, direction_flag"


def num(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def with_(*parts: str, views: tuple[str, ...] = ("ctd_profile",)) -> str:
    """WITH list (last part is the SELECT)."""
    return "WITH " + ",\n".join([ctes(*views), *parts[:-1]]) + "\n" + parts[-1]


def bad_sql(v: str) -> str:
    return f"CASE WHEN {v} = {SENTINEL} THEN 4 WHEN {v} IS NULL THEN 9 ELSE 1 END AS {v}_hakai_bad_value_test"


def gross_sql(v: str) -> str:
    (fl, fh), (sl, sh) = GROSS[v]
    return (
        f"CASE WHEN {v} IS NULL THEN 9 WHEN {v} < {num(fl)} OR {v} > {num(fh)} THEN 4 "
        f"WHEN {v} < {num(sl)} OR {v} > {num(sh)} THEN 3 ELSE 1 END AS {v}_qartod_gross_range_test"
    )


FLAGGED = "flagged AS (SELECT *, CASE WHEN direction_flag = 's' THEN epoch_us(measurement_dt) ELSE 0 END AS qc_time, " + ", ".join(
    bad_sql(v) for v in TESTED) + " FROM ctd_profile WHERE direction_flag IN ('d', 'u', 's'))"
CLEAN = (
    "clean AS (SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN {v} = {SENTINEL} THEN NULL ELSE {v} END AS {v}" for v in TESTED)
    + ") FROM flagged)"
)


def rate_sql(v: str, time: str = "elapsed_s", threshold: float | None = None, seconds: str | None = None) -> str:
    thr = num(float(RATES[v] if threshold is None else threshold))
    dt = seconds or f"abs({time} - lag({time}) OVER g)"
    dt = f"(CASE WHEN {dt} = 0 THEN 1 ELSE {dt} END)"  # rows at the same time are compared with the threshold itself
    return (
        f"CASE WHEN {v} IS NULL THEN 9 WHEN abs({v} - lag({v}) OVER g) > {thr} * {dt} THEN 3 ELSE 1 END "
        f"AS {v}_qartod_rate_of_change_test"
    )


INVERSION = """CASE WHEN sigma0 IS NULL THEN 9
  WHEN count(*) OVER (PARTITION BY hakai_id, direction_flag, qc_time) = 1 THEN 2
  WHEN (sign(depth - lag(depth) OVER g) * (sigma0 - lag(sigma0) OVER g)) < -0.03e0
    OR (sign(lead(depth) OVER g - depth) * (lead(sigma0) OVER g - sigma0)) < -0.03e0 THEN 4
  WHEN (sign(depth - lag(depth) OVER g) * (sigma0 - lag(sigma0) OVER g)) < -0.005e0
    OR (sign(lead(depth) OVER g - depth) * (lead(sigma0) OVER g - sigma0)) < -0.005e0 THEN 3
  ELSE 1 END AS sigma0_qartod_density_inversion_test"""
G = f"WINDOW g AS ({GROUP} ORDER BY depth, ctd_data_pk)"


def attenuated_sql(v: str) -> str:
    suspect, fail, kind = ATTENUATED[v]
    spread = (
        f"(max({v}) OVER p - min({v}) OVER p)" if kind == "range" else f"round(stddev_pop({v}) OVER p, 9)")
    return (
        f"CASE WHEN direction_flag = 's' THEN NULL WHEN {v} IS NULL THEN 9 WHEN {spread} < {num(fail)} THEN 4 "
        f"WHEN {spread} < {num(suspect)} THEN 3 ELSE 1 END AS {v}_qartod_attenuated_signal_test"
    )


# Attenuated signal looks at profiles; static rows of a cast form their own partition and are left NULL.
P = f"WINDOW p AS ({PROFILE})"

BOTTOM = f"""hits AS (
  SELECT hakai_id, bool_or(last_flag IN (3, 4)) AS hit FROM (
    SELECT hakai_id, direction_flag, arg_max(sigma0_qartod_density_inversion_test, (depth, ctd_data_pk)) AS last_flag
    FROM inversions GROUP BY hakai_id, direction_flag) x GROUP BY hakai_id),
good_depths AS (
  SELECT hakai_id, direction_flag, max(depth) AS deepest_good FROM inversions
  WHERE sigma0_qartod_density_inversion_test = 1 GROUP BY hakai_id, direction_flag)"""
BOTTOM_JOIN = """LEFT JOIN hits USING (hakai_id) LEFT JOIN good_depths USING (hakai_id, direction_flag)"""
BOTTOM_FLAG = "CASE WHEN hit AND depth > deepest_good THEN 4 ELSE 1 END AS bottom_hit_test"

SHADOW = """CASE WHEN count(par) OVER (PARTITION BY hakai_id) = 0 THEN 2
  WHEN par < max(par) OVER up AND max(par) OVER up > 5 THEN 3 ELSE 1 END AS par_shadow_test"""
UP = f"WINDOW up AS ({PROFILE} ORDER BY depth DESC, ctd_data_pk DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def cap_cte(v: str, source: str = "clean") -> str:
    return f"""cap_{v} AS (
  SELECT hakai_id, CASE
    WHEN sum(CASE WHEN n = 0 AND ptp IS NULL THEN 1 ELSE 0 END) = count(*) THEN 9
    WHEN coalesce(nullif(sum(CASE WHEN ptp > 0 THEN 1 ELSE 0 END), 0) < 30, false)
      OR sum(CASE WHEN (n = 0 AND ptp IS NULL) OR n = 1 THEN 1 ELSE 0 END) = count(*) THEN 2
    WHEN avg(CASE WHEN ptp > 0.5e0 AND n > 1 THEN 1.0e0 ELSE 0.0e0 END) > 0.5 THEN 4
    WHEN avg(CASE WHEN ptp > 0.2e0 AND n > 1 THEN 1.0e0 ELSE 0.0e0 END) > 0.5 THEN 3
    ELSE 1 END AS {v}_hakai_do_cap_test
  FROM (SELECT hakai_id, bin, count(m) AS n, CASE WHEN count(m) = count(*) THEN max(m) - min(m) END AS ptp
    FROM (SELECT hakai_id, direction_flag, round_even(depth, 0) AS bin, round(avg({v}), 9) AS m
      FROM {source} GROUP BY hakai_id, direction_flag, round_even(depth, 0)) a
    GROUP BY hakai_id, bin) b
  GROUP BY hakai_id)"""


STATION = """depths AS (
  SELECT hakai_id, station, CASE
    WHEN station_depth IS NULL THEN 2
    WHEN max_depth > station_depth * 1.25e0 AND max_depth > station_depth + 50 THEN 4
    WHEN max_depth > station_depth * 1.1e0 AND max_depth > station_depth + 30 THEN 3
    ELSE 1 END AS depth_in_station_range_test
  FROM (SELECT hakai_id, station, max(depth) AS max_depth FROM clean WHERE station IS NOT NULL GROUP BY hakai_id, station) m
  LEFT JOIN stations USING (station))"""


def query_sql() -> str:
    return ", ".join(
        f"CASE WHEN organization = 'NATURE TRUST' AND sensors_submerged = '{where}' AND {v} IS NOT NULL THEN 4 ELSE 1 END AS {c}"
        for where, v, columns in SUBMERGED for c in columns)


def log_sql() -> str:
    warned = "lower(process_log) LIKE '%warning%'"
    slow = "contains(process_log, 'WARNING!!! Slower Oxygen Sensor RBR CODAstandard are not recommended for profiling applications.')"
    soak = "contains(process_log, 'WARNING! NO SOAK DETECTED, SUSPICIOUS DATA QUALITY')"
    short = "contains(process_log, 'Static Measurement is considered SUSPICIOUS due to the lowered thredholds')"
    cols = [
        f"CASE WHEN {warned} AND {slow} AND cast_type IS DISTINCT FROM 'Static' THEN 3 END AS dissolved_oxygen_ml_l_hakai_slow_oxygen_sensor_test"]
    cols += [f"CASE WHEN {warned} AND {soak} THEN 3 END AS {v}_hakai_no_soak_test" for v in NO_SOAK]
    cols += [f"CASE WHEN {warned} AND {short} THEN 3 END AS hakai_short_static_deployment_test"]
    return "SELECT hakai_id, " + ", ".join(cols) + " FROM casts"


def code_sql(c: str) -> str:
    return f"CASE {c} WHEN 'AV' THEN 1 WHEN 'SVC' THEN 3 WHEN 'SVD' THEN 4 WHEN 'MV' THEN 9 ELSE 2 END"


MANUAL = ["dissolved_oxygen_ml_l", "par", "absolute_salinity"]
MANUAL_SELECT = "SELECT hakai_id, " + ", ".join(
    f"{code_sql(v + '_flag')} AS {v}_manual_qc_flag" for v in MANUAL) + " FROM manual_qc"

DEFAULTS = [
    "bottom_hit_test", "depth_in_station_range_test", "pressure_qartod_gross_range_test",
    "depth_qartod_gross_range_test", "hakai_short_static_deployment_test",
]
EXTRA = {
    "temperature": ["sigma0_qartod_density_inversion_test", "temperature_hakai_no_soak_test"],
    "salinity": ["sigma0_qartod_density_inversion_test", "salinity_hakai_no_soak_test", "absolute_salinity_manual_qc_flag"],
    "conductivity": ["sigma0_qartod_density_inversion_test", "conductivity_hakai_no_soak_test"],
    "sigma0": ["sigma0_qartod_density_inversion_test"],
    "dissolved_oxygen_ml_l": [
        "dissolved_oxygen_ml_l_hakai_do_cap_test", "dissolved_oxygen_ml_l_hakai_no_soak_test",
        "dissolved_oxygen_ml_l_hakai_slow_oxygen_sensor_test", "dissolved_oxygen_ml_l_hakai_sensor_bottom_submerged_test",
        "dissolved_oxygen_ml_l_manual_qc_flag"],
    "dissolved_oxygen_percent": [
        "dissolved_oxygen_ml_l_hakai_do_cap_test", "dissolved_oxygen_ml_l_hakai_no_soak_test",
        "dissolved_oxygen_percent_hakai_sensor_bottom_submerged_test"],
    "rinko_do_ml_l": ["rinko_do_ml_l_hakai_do_cap_test"],
    "par": ["par_hakai_sensor_mid_submerged_test", "par_hakai_sensor_bottom_submerged_test", "par_manual_qc_flag"],
}


def sources(v: str) -> list[str]:
    found = [*DEFAULTS, f"{v}_hakai_bad_value_test", *EXTRA.get(v, [])]
    found += [f"{v}_qartod_{n}" for n, has in (
        ("gross_range_test", GROSS), ("rate_of_change_test", RATES), ("attenuated_signal_test", ATTENUATED)) if v in has]
    return list(dict.fromkeys(found))


OLD = {"par", "dissolved_oxygen_ml_l", "temperature"}


def level_sql(v: str, cols: list[str], source_value: str | None = None) -> str:
    value = source_value or v
    counted = ", ".join(f"CASE WHEN {c} IN (1, 3, 4) THEN {c} END" for c in cols)
    worst = f"greatest({counted})" if len(cols) > 1 else counted
    texts = ", ".join(f"CASE {c} WHEN 4 THEN 'SVD: {c}' WHEN 3 THEN 'SVC: {c}' END" for c in cols)
    text = f"nullif(array_to_string(list_reverse_sort(list_filter([{texts}], lambda x: x IS NOT NULL)), '; '), '')"
    old1, old2 = (f"{v}_flag_level_1", f"{v}_flag") if v in OLD else ("CAST(NULL AS INTEGER)", "CAST(NULL AS VARCHAR)")
    some = f"{value} IS NOT NULL AND {worst} IS NOT NULL"
    return (f"CASE WHEN {some} THEN {worst} ELSE {old1} END AS {v}_new_level_1, "
            f"CASE WHEN {some} THEN {text} ELSE {old2} END AS {v}_new_text")


GREY_HIT = """hit AS (
  SELECT ctd_data_pk, r.seq, trim(v.name) AS var, r.flag_type,
    CASE r.flag_type WHEN 3 THEN 'SVC' WHEN 4 THEN 'SVD' END || ': Hakai Grey List - ' || comments || coalesce(' flagged by ' || flagged_by, '') AS text
  FROM {source} d JOIN grey_list r
    ON d.device_model = r.device_model AND d.device_sn = r.device_sn
    AND d.measurement_dt >= r.start_datetime_range AND d.measurement_dt <= r.stop
    AND (r.hakai_id IS NULL OR list_contains(string_split(r.hakai_id, ','), d.hakai_id))
    AND (r.query IS NULL OR (r.seq = 4 AND d.depth > 30 AND d.par IS NOT NULL))
  CROSS JOIN LATERAL (SELECT unnest(string_split(r.data_type, ',')) AS name) v)""".replace("r.stop", "r.end_datetime_range")
GREY_VARS = ["dissolved_oxygen_ml_l", "par", "turbidity", "flc"]


def grey_folds() -> str:
    return ",\n".join(
        f"hit_{v} AS (SELECT ctd_data_pk, arg_max(flag_type, seq) AS code_{v}, string_agg(text, '; ' ORDER BY seq) AS text_{v} "
        f"FROM hit WHERE var = '{v}' GROUP BY ctd_data_pk)" for v in GREY_VARS)


GREY_JOIN = " ".join(f"LEFT JOIN hit_{v} USING (ctd_data_pk)" for v in GREY_VARS)


def grey_level(v: str, old1: str, old2: str, to1: str, to2: str) -> str:
    if v not in GREY_VARS:
        return f"{old1} AS {to1}, {old2} AS {to2}"
    return (f"coalesce(code_{v}, {old1}) AS {to1}, CASE WHEN code_{v} IS NULL THEN {old2} "
            f"ELSE coalesce({old2} || '; ', '') || text_{v} END AS {to2}, coalesce(code_{v}, 1) AS {v}_grey_list_test")


RUN_VIEWS = ("ctd_profile", "casts", "manual_qc", "stations", "grey_list")


def run_ctes() -> list[str]:
    """Every step of a run, ending in ``qced`` (one row per kept measurement row)."""
    inversions = f"inversions AS (SELECT *, {INVERSION}, " + ", ".join(rate_sql(v) for v in RATES) + f" FROM clean {G})"
    tests = (
        "tests AS (SELECT i.*, " + BOTTOM_FLAG + ", " + SHADOW + ", "
        + ", ".join(gross_sql(v) for v in GROSS) + ", " + query_sql() + ", "
        + ", ".join(attenuated_sql(v) for v in ATTENUATED)
        + f" FROM inversions i {BOTTOM_JOIN} {P}, up AS ({UP.split('AS (', 1)[1]})"
    )
    joined = (
        "joined AS (SELECT t.*, depth_in_station_range_test, "
        + ", ".join(f"{v}_hakai_do_cap_test" for v in CAP)
        + ", l.* EXCLUDE (hakai_id), m.* EXCLUDE (hakai_id) FROM tests t JOIN depths USING (hakai_id, station) "
        + " ".join(f"LEFT JOIN cap_{v} USING (hakai_id)" for v in CAP)
        + " LEFT JOIN logs l USING (hakai_id) LEFT JOIN manual m USING (hakai_id))"
    )
    levels = "levels AS (SELECT *, " + ", ".join(level_sql(v, sources(v)) for v in TESTED) + " FROM joined)"
    overridden = "overridden AS (SELECT *, " + ", ".join(
        grey_level(v, f"{v}_new_level_1", f"{v}_new_text", f"{v}_grey_level_1", f"{v}_final_text") for v in TESTED
    ) + f" FROM levels {GREY_JOIN})"
    qced = "qced AS (SELECT *, " + ", ".join(
        f"CASE WHEN {v}_hakai_bad_value_test IN (3, 4, 9) THEN {v}_hakai_bad_value_test ELSE {v}_grey_level_1 END AS {v}_final_level_1"
        for v in TESTED) + " FROM overridden)"
    steps = [
        FLAGGED, CLEAN, inversions, BOTTOM, tests, STATION, *[cap_cte(v) for v in CAP], f"logs AS ({log_sql()})",
        f"manual AS ({MANUAL_SELECT})", joined, levels, GREY_HIT.format(source="levels"), grey_folds(), overridden, qced,
    ]
    # Steps that several others read are computed once.
    shared = ("clean AS (", "inversions AS (", "levels AS (", "hit AS (")
    return [s.replace(" AS (", " AS MATERIALIZED (", 1) if s.startswith(shared) else s for s in steps]


FINAL_FLAGS = ", ".join(f"{v}_final_level_1 AS {v}_flag_level_1, {v}_final_text AS {v}_flag" for v in TESTED)
DROP = "work_area, station, device_sn, hakai_id"
MESSAGES = [
    ("bottom_hit_test = 4 AND direction_flag = 'd'", "Instrument likely hit bottom"),
    ("location_flag_level_1 = 4", "Drop is far from station"),
    ("depth_in_station_range_test = 4", "Drop is too deep for that station"),
    ("sigma0_qartod_density_inversion_test = 4 AND coalesce(bottom_hit_test, 1) <> 4 AND direction_flag = 'd'",
     "A significant density inversion is present in the profile"),
    ("rinko_do_ml_l_hakai_do_cap_test = 4",
     "Secondary oxygen instrument Rinko seems to have been deployed with the cap on the unit."),
    ("dissolved_oxygen_ml_l_hakai_do_cap_test = 4",
     "Oxygen instrument seems to have been deployed with the cap on the unit."),
    ("salinity_qartod_gross_range_test = 4", "Salinity out of range"),
    ("temperature_qartod_gross_range_test = 4", "Temperature out of range"),
    ("dissolved_oxygen_ml_l_qartod_gross_range_test = 4", "Dissolved Oxygen out of range"),
    ("rinko_do_ml_l_qartod_gross_range_test = 4", "Secondary Oxygen out of range"),
]


def alerts_sql(min_date: str) -> str:
    found = "\nUNION ".join(
        f"SELECT DISTINCT {DROP}, '{m}' AS message FROM qced WHERE start_dt > TIMESTAMP '{min_date}' AND {p}"
        for p, m in MESSAGES)
    return with_(
        *run_ctes(), f"found AS ({found})",
        "SELECT f.work_area, f.station, f.device_sn, f.hakai_id, f.message, c.cast_type AS cast_cast_type, "
        "c.processing_stage AS cast_processing_stage FROM found f LEFT JOIN casts c ON f.hakai_id = c.hakai_id",
        views=RUN_VIEWS)


def spike_sql(v: str) -> str:
    suspect, fail = SPIKE[v]
    jump = f"abs({v} - (lag({v}) OVER g + lead({v}) OVER g) / 2)"
    return (
        f"CASE WHEN {v} IS NULL THEN 9 WHEN lag(ctd_data_pk) OVER g IS NULL OR lead(ctd_data_pk) OVER g IS NULL THEN 2 "
        f"WHEN {jump} > {num(fail)} THEN 4 WHEN {jump} > {num(suspect)} THEN 3 ELSE 1 END AS {v}_qartod_spike_test"
    )


def poly(table: dict, x: str, y: str, z: str | None) -> str:
    """Plain sum of monomials."""
    def power(v: str, n: int) -> str:
        return f" * pow({v}, {n})" if n else ""

    return "(" + " + ".join(
        f"{num(float(c))}{power(x, i)}{power(y, j)}{power(z, k) if z else ''}" for (i, j, k), c in table.items() if z or not k) + ")"


def density_steps() -> list[str]:
    """Potential temperature by plain Newton steps to convergence, then enthalpy and specific volume."""
    d = density
    slope = {(i, j - 1, k): j * float(c) for (i, j, k), c in d._ENTROPY.items() if j}

    def newton(n: int) -> str:
        entropy = poly(d._ENTROPY, "x", f"(pt{n - 1}/40)", None)
        rate = poly(slope, "x", f"(pt{n - 1}/40)", None)
        return f"n{n} AS (SELECT *, pt{n - 1} - ({entropy} - wanted) / ({rate} / 40) AS pt{n} FROM n{n - 1})"

    vol = "sqrt(0.0248826675584615e0 * sa + 0.5971840214030754e0)"
    return [
        FLAGGED, CLEAN,
        "base AS (SELECT ctd_data_pk, CASE WHEN pressure IS NOT NULL THEN salinity * (35.16504e0 / 35) END AS sa, "
        "temperature AS t, pressure AS p, sqrt(0.0248826675584615e0 * salinity * (35.16504e0 / 35)) AS x FROM clean)",
        f"n0 AS (SELECT *, t AS pt0, {poly(d._ENTROPY, 'x', '(t/40)', '(p/10000)')} AS wanted FROM base)",
        newton(1), newton(2), newton(3), newton(4),
        f"ct AS (SELECT *, {poly(d._ENTHALPY, 'x', '(pt4/40)', None)} / 3991.86795711963e0 AS ct FROM n4)",
        "SELECT ctd_data_pk, round(sa, 6) AS absolute_salinity, round(ct, 6) AS conservative_temperature, "
        f"round(1 / {poly(d._VOLUME, vol, '(ct/40)', '(p/10000)')}, 5) AS density, "
        f"round(1 / {poly(d._VOLUME, vol, '(ct/40)', None)} - 1000, 5) AS sigma0 FROM ct",
    ]


def batch_steps() -> list[str]:
    """A run over the casts of the default stages with sigma0 derived instead of given."""
    flagged, clean, *steps, _ = density_steps()
    vol = "sqrt(0.0248826675584615e0 * sa + 0.5971840214030754e0)"
    return [
        f"raw AS ({VIEWS['ctd_profile'].format(S='VARCHAR')})",
        flagged.replace("flagged AS", "flagged0 AS").replace("FROM ctd_profile", "FROM raw"),
        clean.replace("clean AS", "clean0 AS").replace("FROM flagged", "FROM flagged0"),
        *[step.replace("FROM clean)", "FROM clean0)") for step in steps],
        f"derived AS (SELECT ctd_data_pk, 1 / {poly(density._VOLUME, vol, '(ct/40)', None)} - 1000 AS s0 FROM ct)",
        "ctd_profile AS (SELECT raw.* REPLACE (s0 AS sigma0) FROM raw LEFT JOIN derived USING (ctd_data_pk) WHERE hakai_id IN "
        "(SELECT hakai_id FROM casts WHERE processing_stage IN ('8_binAvg', '8_rbr_processed')))",
        *run_ctes(),
    ]


def pk(*cols: str) -> str:
    return "SELECT ctd_data_pk, " + ", ".join(cols)


INVERSIONS = f"inversions AS (SELECT *, {INVERSION} FROM clean {G})"


def oracle_sql() -> dict[str, str]:
    grey_apply = ", ".join(
        grey_level(v, f"{v}_flag_level_1" if v in OLD else "CAST(NULL AS INTEGER)",
                   f"{v}_flag" if v in OLD else "CAST(NULL AS VARCHAR)", f"{v}_flag_level_1", f"{v}_flag")
        for v in GREY_VARS)
    slice_sources = ["dissolved_oxygen_ml_l_qartod_gross_range_test", "dissolved_oxygen_ml_l_hakai_bad_value_test"]
    slice_cte = (
        "flags AS (SELECT *, " + gross_sql("dissolved_oxygen_ml_l") + " FROM clean), folded AS (SELECT *, "
        + level_sql("dissolved_oxygen_ml_l", slice_sources) + " FROM flags)")
    upload_cols = ", ".join(
        f"CAST({v}_final_level_1 AS VARCHAR) AS {v}_flag_level_1, nullif({v}_final_text, '') AS {v}_flag"
        for v in TESTED if v in OLD)
    stage_new = "CASE WHEN processing_stage IN ('8_binAvg', '8_rbr_processed') THEN '9_qc_auto' ELSE processing_stage END"
    qced_flags = with_(*run_ctes(), f"SELECT ctd_data_pk, hakai_id, {FINAL_FLAGS} FROM qced", views=RUN_VIEWS)
    lists = ("first_list", "second_list")

    def cell(c: str) -> str:
        return (f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN a.{c} END AS {c}_first, "
                f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN b.{c} END AS {c}_second")

    compared = ("latitude", "longitude", "station_depth")
    km = ("2 * 6371000.0e0 * asin(sqrt(sin(radians(station_latitude - latitude)/2) * sin(radians(station_latitude - latitude)/2) + "
          "cos(radians(latitude)) * cos(radians(station_latitude)) * sin(radians(station_longitude - longitude)/2) * sin(radians(station_longitude - longitude)/2)))")
    out = {
        "bad_value": with_(pk(*[bad_sql(v) for v in TESTED]) + " FROM ctd_profile"),
        "null_sentinels": with_(FLAGGED, CLEAN, pk(*TESTED) + " FROM clean"),
        "gross_range": with_(FLAGGED, CLEAN, pk(*[gross_sql(v) for v in GROSS]) + " FROM clean"),
        "qc_groups": with_(
            FLAGGED,
            "SELECT hakai_id, direction_flag, qc_time, count(*) AS n FROM flagged GROUP BY hakai_id, direction_flag, qc_time"),
        "query_flags": with_(FLAGGED, CLEAN, f"SELECT ctd_data_pk, {query_sql()} FROM clean"),
        "rate_of_change": with_(FLAGGED, CLEAN, pk(*[rate_sql(v) for v in RATES]) + f" FROM clean {G}"),
        "rate_of_change_timestamps": with_(
            FLAGGED, CLEAN,
            pk(*[rate_sql(v, threshold=1e-7,
                          seconds="abs(floor((epoch_us(measurement_dt) - lag(epoch_us(measurement_dt)) OVER g) / 1000000))")
                 for v in ("temperature", "salinity")]) + f" FROM clean {G}"),
        "density_inversion": with_(FLAGGED, CLEAN, pk(INVERSION) + f" FROM clean {G}"),
        "attenuated_signal": with_(FLAGGED, CLEAN, pk(*[attenuated_sql(v) for v in ATTENUATED]) + f" FROM clean {P}"),
        "bottom_hit": with_(FLAGGED, CLEAN, INVERSIONS, BOTTOM, pk(BOTTOM_FLAG) + f" FROM inversions {BOTTOM_JOIN}"),
        "par_shadow": with_(FLAGGED, CLEAN, pk(SHADOW) + f" FROM clean {UP}"),
        "do_cap": with_(
            FLAGGED, CLEAN, *[cap_cte(v) for v in CAP],
            "SELECT hakai_id, " + ", ".join(f"{v}_hakai_do_cap_test" for v in CAP)
            + f" FROM cap_{CAP[0]} JOIN cap_{CAP[1]} USING (hakai_id)"),
        "do_cap_rows": with_(
            FLAGGED, CLEAN, *[cap_cte(v) for v in CAP],
            "SELECT ctd_data_pk, " + ", ".join(f"{v}_hakai_do_cap_test" for v in CAP)
            + " FROM clean " + " ".join(f"LEFT JOIN cap_{v} USING (hakai_id)" for v in CAP)),
        "station_depth": with_(
            FLAGGED, CLEAN, STATION,
            "SELECT ctd_data_pk, depth_in_station_range_test FROM clean JOIN depths USING (hakai_id, station)",
            views=("ctd_profile", "stations")),
        "process_log_flags": with_(log_sql(), views=("casts",)),
        "manual_qc_rows": with_(
            FLAGGED, f"manual AS ({MANUAL_SELECT})",
            pk(*[f"{v}_manual_qc_flag" for v in MANUAL]) + " FROM flagged LEFT JOIN manual USING (hakai_id)",
            views=("ctd_profile", "manual_qc")),
        "grey_list_matches": with_(
            FLAGGED, CLEAN, GREY_HIT.format(source="clean"), "SELECT DISTINCT ctd_data_pk, seq FROM hit",
            views=("ctd_profile", "grey_list")),
        "grey_list": with_(
            FLAGGED, CLEAN, GREY_HIT.format(source="clean"), grey_folds(),
            f"SELECT ctd_data_pk, {grey_apply} FROM clean {GREY_JOIN}", views=("ctd_profile", "grey_list")),
        "flag_summary": with_(
            FLAGGED, CLEAN, slice_cte,
            "SELECT dissolved_oxygen_ml_l_new_level_1 AS flag_level_1, dissolved_oxygen_ml_l_new_text AS flag, count(*) AS n "
            "FROM folded GROUP BY 1, 2"),
        "aggregate_flags": with_(
            FLAGGED, CLEAN, slice_cte,
            "SELECT ctd_data_pk, dissolved_oxygen_ml_l_new_level_1 AS dissolved_oxygen_ml_l_flag_level_1, "
            "dissolved_oxygen_ml_l_new_text AS dissolved_oxygen_ml_l_flag FROM folded"),
        "override_bad": with_(
            FLAGGED, CLEAN,
            "SELECT ctd_data_pk, CASE WHEN temperature_hakai_bad_value_test IN (3, 4, 9) THEN temperature_hakai_bad_value_test "
            "ELSE temperature_flag_level_1 END AS temperature_flag_level_1, CASE WHEN temperature_hakai_bad_value_test = 4 "
            "THEN 'SVD: temperature_hakai_bad_value_test' ELSE temperature_flag END AS temperature_flag FROM clean"),
        "finalize_flags": with_(
            "SELECT ctd_data_pk, CAST(temperature_flag_level_1 AS VARCHAR) AS temperature_flag_level_1, "
            "nullif(temperature_flag, '') AS temperature_flag FROM ctd_profile"),
        "qc_run": qced_flags,
        "qc_run_tests": with_(
            *run_ctes(),
            pk("bottom_hit_test", "par_shadow_test", "depth_in_station_range_test", "sigma0_qartod_density_inversion_test",
               *[f"{v}_hakai_do_cap_test" for v in CAP], *[f"{v}_qartod_rate_of_change_test" for v in RATES],
               *[f"{v}_qartod_attenuated_signal_test" for v in ATTENUATED], *[f"{v}_grey_list_test" for v in GREY_VARS],
               *[f"{v}_manual_qc_flag" for v in MANUAL], "hakai_short_static_deployment_test")
            + " FROM qced", views=RUN_VIEWS),
        "upload_documents": with_(
            *run_ctes(),
            f"SELECT c.ctd_cast_pk, q.hakai_id, {stage_new} AS processing_stage, coalesce(process_error, '') AS process_error, "
            f"q.ctd_data_pk, {upload_cols} FROM qced q JOIN casts c ON q.hakai_id = c.hakai_id", views=RUN_VIEWS),
        "alerts": alerts_sql("2013-01-01 00:00:00"),
        "select_casts_stage": with_(
            "SELECT hakai_id, ctd_cast_pk, processing_stage FROM casts WHERE processing_stage IN ('8_binAvg', '8_rbr_processed')",
            views=("casts",)),
        "select_casts_ids": with_(
            "SELECT hakai_id, ctd_cast_pk, processing_stage FROM casts WHERE hakai_id IN ('C1_A', 'C5_R', 'C9_N')",
            views=("casts",)),
        "select_casts_list": with_(
            "SELECT hakai_id, ctd_cast_pk, processing_stage FROM casts JOIN (SELECT DISTINCT concat('C', s_suppkey, '_R') AS hakai_id "
            "FROM supplier WHERE s_suppkey % 4 <> 3) USING (hakai_id)", views=("casts",)),
        "rows_for_casts": with_(
            "SELECT ctd_data_pk, depth FROM ctd_profile WHERE hakai_id IN (SELECT hakai_id FROM casts "
            "WHERE processing_stage IN ('8_binAvg', '8_rbr_processed'))", views=("ctd_profile", "casts")),
        "missing_ids": with_(
            "SELECT id AS hakai_id FROM (SELECT concat('C', s_suppkey, '_', f) AS id FROM supplier, (VALUES ('A'), ('X')) t(f)) x "
            "WHERE id NOT IN (SELECT hakai_id FROM ctd_profile)"),
        "id_list": "SELECT concat('C', s_suppkey, '_R') AS hakai_id FROM supplier WHERE s_suppkey % 4 <> 3",
        "advance_stage": with_(
            f"SELECT hakai_id, {stage_new} AS processing_stage, coalesce(process_error, '') AS process_error FROM casts",
            views=("casts",)),
        "to_utc": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate - INTERVAL 7 HOUR END AS start_dt FROM orders",
        "manual_qc_status": with_(
            "both_tables AS (SELECT c.organization, c.work_area, c.station, c.start_dt, m.dissolved_oxygen_ml_l_flag AS f1, "
            "m.par_flag AS f2, m.absolute_salinity_flag AS f3, m.hakai_id IS NOT NULL AND (f1 IS NOT NULL OR f2 IS NOT NULL OR f3 IS NOT NULL) AS q "
            "FROM casts c LEFT JOIN manual_qc m ON c.work_area = m.work_area AND c.hakai_id = m.hakai_id "
            "WHERE c.organization IS NOT NULL AND c.work_area IS NOT NULL AND c.station IS NOT NULL)",
            "SELECT organization, work_area, station, count(*) AS n_drops, count(*) FILTER (WHERE q) AS n_qced, "
            "count(*) - count(*) FILTER (WHERE q) AS n_not_qced, count(f1) AS dissolved_oxygen_ml_l_flag, count(f2) AS par_flag, "
            "count(f3) AS absolute_salinity_flag, strftime(max(start_dt) FILTER (WHERE q), '%Y-%m-%d') AS last_drop_qced "
            "FROM both_tables GROUP BY organization, work_area, station HAVING count(*) >= 2",
            views=("casts", "manual_qc")),
        "station_flag_review": with_(
            *run_ctes(),
            "total AS (SELECT station, hakai_id, max(depth) AS max_depth FROM qced GROUP BY station, hakai_id)",
            "bad AS (SELECT station, hakai_id, max(depth) AS max_depth FROM qced WHERE temperature_final_text LIKE '%depth_in_station_range_test%' GROUP BY station, hakai_id)",
            "totals AS (SELECT station, count(hakai_id) AS total_drops_count, avg(max_depth) AS total_avg_max_depth, "
            "stddev_samp(max_depth) AS total_std_max_depth, quantile_disc(max_depth, 0.5) AS total_median_max_depth FROM total GROUP BY station)",
            "bads AS (SELECT station, count(hakai_id) AS flagged_profiles_count, avg(max_depth) AS flagged_avg_max_depth, "
            "stddev_samp(max_depth) AS flagged_std_max_depth FROM bad GROUP BY station)",
            "SELECT b.station, flagged_profiles_count, total_drops_count, round(flagged_avg_max_depth, 6) AS flagged_avg_max_depth, "
            "round(total_avg_max_depth, 6) AS total_avg_max_depth, round(flagged_std_max_depth, 6) AS flagged_std_max_depth, "
            "round(total_std_max_depth, 6) AS total_std_max_depth, total_median_max_depth, station_depth "
            "FROM bads b LEFT JOIN totals t ON b.station = t.station LEFT JOIN stations s ON b.station = s.station",
            views=RUN_VIEWS),
        "location_review": with_(
            "SELECT CASE WHEN work_area = 'ESTUARY' THEN 'estuary' ELSE 'other' END AS area_class, count(*) AS n, "
            "count(*) FILTER (WHERE location_flag_level_1 = 3) AS n_suspect, count(*) FILTER (WHERE location_flag_level_1 = 4) AS n_fail, "
            "round(avg(latitude), 6) AS mean_latitude, round(avg(longitude), 6) AS mean_longitude FROM casts "
            "WHERE location_flag_level_1 IN (3, 4) GROUP BY 1", views=("casts",)),
        "location_offsets": with_(
            "SELECT hakai_id, station, latitude, longitude, station_latitude, station_longitude FROM casts "
            "WHERE location_flag_level_1 IN (3, 4)", views=("casts",)),
        "compare_stations": with_(
            "SELECT station, " + ", ".join(cell(c) for c in compared) + ", CASE WHEN a.station_depth IS DISTINCT FROM b.station_depth "
            "THEN a.station_depth - b.station_depth END AS delta_depth, coalesce(abs(a.station_depth - b.station_depth) > 2, false) AS beyond_tolerance "
            "FROM first_list a JOIN second_list b USING (station) WHERE "
            + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in compared), views=lists),
        "spike": with_(FLAGGED, CLEAN, pk(*[spike_sql(v) for v in SPIKE]) + f" FROM clean {G}"),
        "location": with_(
            f"SELECT hakai_id, CASE WHEN latitude IS NULL OR longitude IS NULL THEN 9 WHEN longitude > 180 OR longitude < -180 THEN 4 "
            f"WHEN {km} > 3000 THEN 3 ELSE 1 END AS location_test FROM casts", views=("casts",)),
        "live_row_tests": with_(
            FLAGGED, CLEAN,
            pk(*[f"{v}_hakai_bad_value_test" for v in TESTED], *[gross_sql(v) for v in GROSS], query_sql()) + " FROM clean"),
        "snapshot": with_(
            "SELECT ctd_data_pk, hakai_id, direction_flag, depth, temperature FROM ctd_profile"),
        "incremental_run": qced_flags,
        "incremental_late_rows": qced_flags,
    }
    all_flags = ", ".join(
        f"CAST({v}_final_level_1 AS VARCHAR) AS {v}_flag_level_1, nullif({v}_final_text, '') AS {v}_flag" for v in TESTED)
    out["batch_run"] = with_(
        *batch_steps(), f"SELECT hakai_id, '9_qc_auto' AS processing_stage, ctd_data_pk, {all_flags} FROM qced",
        views=[v for v in RUN_VIEWS if v != "ctd_profile"])
    out["grey_list_csv"] = out["grey_list_files"] = out["grey_list"]
    out["grey_list_many"] = with_(
        FLAGGED, CLEAN,
        "many AS (SELECT o_orderkey AS seq, CAST(o_orderdate AS TIMESTAMP) AS first_time, CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 45 AS INTEGER)) AS last_time, "
        "concat('M', o_custkey % 4) AS device_model, concat('0', o_custkey % 8) AS device_sn, "
        "CASE WHEN o_orderkey % 9 = 0 THEN [concat('C', o_custkey % 100, '_A'), 'C3_R'] END AS casts, o_orderkey % 7 = 0 AS deep FROM orders)",
        "SELECT ctd_data_pk, count(*) AS n, min(seq) AS first, max(seq) AS last FROM clean d JOIN many r "
        "ON d.device_model = r.device_model AND d.device_sn = r.device_sn AND d.measurement_dt BETWEEN first_time AND last_time "
        "AND (casts IS NULL OR list_contains(casts, d.hakai_id)) AND (NOT deep OR depth > 25) GROUP BY ctd_data_pk")
    out["position_choice"] = with_(
        "SELECT hakai_id, CASE WHEN ctd_cast_pk % 3 <> 0 THEN station_latitude ELSE latitude END AS position_latitude, "
        "CASE WHEN ctd_cast_pk % 3 <> 0 THEN station_longitude ELSE longitude END AS position_longitude FROM casts", views=("casts",))
    near = f"OVER ({GROUP} ORDER BY depth, ctd_data_pk ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)"
    out["user_test"] = with_(
        FLAGGED, CLEAN,
        pk(f"CASE WHEN conductivity IS NULL THEN 9 WHEN count(conductivity) {near} >= 4 "
           f"AND max(conductivity) {near} - min(conductivity) {near} < 0.02e0 THEN 3 ELSE 1 END AS conductivity_hakai_steady_test")
        + " FROM clean")
    out["stored_by_cast"] = with_(
        FLAGGED, CLEAN, f"inversions AS (SELECT *, {INVERSION}, {rate_sql('temperature')} FROM clean {G})", BOTTOM,
        pk("temperature_qartod_rate_of_change_test", BOTTOM_FLAG, SHADOW) + f" FROM inversions i {BOTTOM_JOIN} {UP}")
    live = [(p, m) for p, m in MESSAGES if p.startswith("location") or "gross_range" in p]
    out["live_alerts"] = with_(
        FLAGGED, CLEAN, "tested AS (SELECT *, " + ", ".join(gross_sql(v) for v in GROSS) + " FROM clean)",
        "found AS (" + " UNION ".join(
            f"SELECT DISTINCT {DROP}, '{m}' AS message FROM tested WHERE start_dt > TIMESTAMP '2013-01-01 00:00:00' AND {p}" for p, m in live) + ")",
        "SELECT f.work_area, f.station, f.device_sn, f.hakai_id, f.message, c.cast_type AS cast_cast_type, "
        "c.processing_stage AS cast_processing_stage FROM found f LEFT JOIN casts c ON f.hakai_id = c.hakai_id",
        views=("ctd_profile", "casts"))
    out["station_review_order"] = with_(
        *run_ctes(),
        "bad AS (SELECT DISTINCT station, hakai_id FROM qced WHERE temperature_final_text LIKE '%depth_in_station_range_test%')",
        "SELECT station, count(*) AS flagged_profiles_count, row_number() OVER (ORDER BY count(*) DESC, station) AS place FROM bad GROUP BY station",
        views=RUN_VIEWS)
    out["snapshot_json"] = with_(
        "SELECT ctd_data_pk, hakai_id, depth, temperature, CAST(epoch(measurement_dt) AS BIGINT) AS measured_at FROM ctd_profile")
    out["casts_read"] = with_(
        "SELECT hakai_id, ctd_cast_pk, organization, processing_stage, cast_type, CAST(NULL AS VARCHAR) AS cruise FROM casts", views=("casts",))
    out["metadata_read"] = with_("SELECT hakai_id, cast_type, process_log FROM casts", views=("casts",))
    out["manual_qc_read"] = with_(
        "SELECT hakai_id, dissolved_oxygen_ml_l_flag, par_flag, absolute_salinity_flag, CAST(NULL AS VARCHAR) AS density_flag FROM manual_qc",
        views=("manual_qc",))
    out["stations_read"] = with_("SELECT station, station_depth FROM stations", views=("stations",))
    out["derived_density"] = with_(*density_steps())
    return out
