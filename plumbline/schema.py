"""Flag codes, column names and table schemas.

The column names are a data contract shared with the files this library reads and writes.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Level-1 codes, their text, and the vendor's bad-value mark.
GOOD, UNKNOWN, SUSPECT, FAIL, MISSING = 1, 2, 3, 4, 9
FLAG_TEXT = {GOOD: "AV", UNKNOWN: "NA", SUSPECT: "SVC", FAIL: "SVD", MISSING: "MV"}
BAD_VALUE = -9.99e-29

CAST = "hakai_id"
PK = "ctd_data_pk"
DIRECTION = "direction_flag"
DEPTH = "depth"
MEASURED_AT = "measurement_dt"

# Added while a run is laid out, see operators/layout.py.
STATIC_TIME = "qc_time"
CHUNK = "qc_chunk"
PROFILE = [CAST, DIRECTION]
QC_GROUP = [CAST, DIRECTION, STATIC_TIME]

# Field lists of the input tables.
CAST_FIELDS = [
    "ctd_cast_pk", "organization", "hakai_id", "processing_stage", "process_error", "cruise", "vessel",
    "operators", "comments", "cast_type", "no_cast", "bottle_drop", "processing_software_version",
]
MEASURED = [
    "conductivity", "temperature", "depth", "pressure", "par", "flc", "turbidity", "ph", "salinity",
    "spec_cond", "dissolved_oxygen_ml_l", "rinko_do_ml_l", "dissolved_oxygen_percent", "oxygen_voltage",
    "c_star_at", "sos_un", "backscatter_beta", "cdom_ppb",
]
MANUAL_QC_VARIABLES = [
    "conductivity", "temperature", "depth", "pressure", "par", "flc", "turbidity", "salinity", "spec_cond",
    "dissolved_oxygen_ml_l", "dissolved_oxygen_percent", "absolute_salinity", "conservative_temperature",
    "density", "c_star_at", "rinko_do_ml_l",
]
TIME_COLUMNS = ["start_dt", "bottom_dt", "end_dt", "measurement_dt"]
NOT_UPLOADED = ["direction_flag", "process_flag", "process_flag_level_1", "location_flag", "location_flag_level_1"]


def level1(variable: str) -> str:
    return f"{variable}_flag_level_1"


def level2(variable: str) -> str:
    return f"{variable}_flag"


def ctd_data_schema(time_type: str = "timestamp") -> T.StructType:
    """The 90 columns of the measurement table; ``time_type="string"`` for raw ISO text."""
    parts = ["ctd_file_pk long, ctd_cast_pk long, organization string, hakai_id string, ctd_data_pk long"]
    parts += [f"{c} string" for c in (
        "filename", "device_model", "device_sn", "device_firmware", "sensors_submerged",
        "file_processing_stage", "work_area", "cruise", "station")]
    parts += ["cast_number int, station_longitude double, station_latitude double, distance_from_station double",
              "latitude double, longitude double, location_flag string, location_flag_level_1 int",
              "process_flag string, process_flag_level_1 int"]
    parts += [f"{c} {time_type}" for c in TIME_COLUMNS[:3]]
    parts += ["duration string, start_depth double, bottom_depth double, target_depth double, drop_speed double",
              f"vessel string, direction_flag string, measurement_dt {time_type}, descent_rate double"]
    parts += [f"{v} double, {level2(v)} string, {level1(v)} int" for v in MEASURED]
    return T.StructType.fromDDL(", ".join(parts))


def casts_schema() -> T.StructType:
    return T.StructType.fromDDL(", ".join(
        f"{c} {'long' if c == 'ctd_cast_pk' else 'string'}" for c in CAST_FIELDS))


def metadata_schema() -> T.StructType:
    return T.StructType.fromDDL("hakai_id string, cast_type string, process_log string")


def manual_qc_schema() -> T.StructType:
    return T.StructType.fromDDL("hakai_id string, " + ", ".join(f"{level2(v)} string" for v in MANUAL_QC_VARIABLES))


def stations_schema() -> T.StructType:
    return T.StructType.fromDDL("name string, depth double, latitude double, longitude double")


def grey_list_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "start_datetime_range timestamp, end_datetime_range timestamp, device_model string, device_sn string, "
        "hakai_id string, query string, data_type string, flag_type int, comments string, flagged_by string")
