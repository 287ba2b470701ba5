"""Profile-shaped views over the provided tables.

One SQL text per view serves both engines; only the name of the text type differs.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.schema import PK
from plumbline.sources.files import prepared

# One cast per (supplier, return flag). Values are shaped so that every test reaches its branches.
PROFILE_SQL = """
SELECT (((l_orderkey*10 + l_linenumber)*100000 + l_partkey)*10000 + l_suppkey)*100 + CAST(l_quantity AS BIGINT) AS ctd_data_pk,
  concat('C', CAST(l_suppkey AS {S}), '_', l_returnflag) AS hakai_id,
  CASE WHEN l_partkey % 50 = 0 THEN 's' WHEN l_linestatus='F' THEN 'd' ELSE 'u' END AS direction_flag,
  CASE WHEN l_suppkey % 20 = 19 THEN NULL ELSE concat('ST', CAST(l_suppkey % 40 AS {S})) END AS station,
  CASE WHEN l_suppkey % 6 = 0 THEN 'NATURE TRUST' ELSE 'HAKAI' END AS organization,
  concat('W', CAST(l_suppkey % 3 AS {S})) AS work_area,
  CASE l_suppkey % 4 WHEN 0 THEN 'Mid' WHEN 2 THEN 'Bottom' WHEN 1 THEN 'Full' ELSE NULL END AS sensors_submerged,
  concat('M', CAST(l_suppkey % 4 AS {S})) AS device_model,
  concat('0', CAST(l_suppkey % 8 AS {S})) AS device_sn,
  CAST(concat('20', CAST(10 + l_suppkey % 10 AS {S}), '-03-01 00:00:00') AS TIMESTAMP) AS start_dt,
  CAST(l_shipdate AS TIMESTAMP) AS measurement_dt,
  depth * 4 AS elapsed_s,
  depth,
  CASE WHEN l_suppkey % 9 = 4 THEN 4 WHEN l_suppkey % 9 = 5 THEN 3 ELSE 1 END AS location_flag_level_1,
  CASE WHEN l_partkey % 43 = 0 THEN NULL WHEN l_partkey % 211 = 0 THEN -1.0e0 WHEN l_partkey % 223 = 0 THEN 12500.0e0
       ELSE depth * 1.01e0 END AS pressure,
  CASE WHEN l_partkey % 47 = 0 THEN NULL WHEN l_partkey % 53 = 0 THEN CAST(-9.99e-29 AS DOUBLE)
       WHEN l_partkey % 89 = 0 THEN 41.0e0 WHEN l_partkey % 83 = 0 THEN 101.0e0
       ELSE 12.0e0 - 0.05e0*depth + l_tax END AS temperature,
  CASE WHEN l_partkey % 59 = 0 THEN NULL WHEN l_partkey % 79 = 0 THEN 1.0e0 WHEN l_partkey % 73 = 0 THEN 46.0e0
       ELSE 28.0e0 + 0.05e0*depth + l_discount END AS salinity,
  CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN l_partkey % 71 = 0 THEN -0.05e0 WHEN l_partkey % 67 = 0 THEN -0.2e0
       ELSE 3.0e0 + 0.01e0*depth END AS conductivity,
  CASE WHEN l_partkey % 63 = 0 THEN NULL WHEN l_partkey % 69 = 0 THEN 90.0e0 WHEN l_partkey % 74 = 0 THEN 160.0e0
       ELSE 10.0e0*l_discount END AS flc,
  CASE WHEN l_partkey % 77 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN 0.5e0
       WHEN l_suppkey % 13 = 1 THEN 0.5e0 + 0.05e0*l_discount
       WHEN l_partkey % 109 = 0 THEN 1500.0e0 ELSE l_extendedprice/1000.0e0 END AS turbidity,
  CASE WHEN l_partkey % 81 = 0 THEN NULL WHEN l_suppkey % 13 = 2 THEN 4.5e0
       WHEN l_suppkey % 13 = 3 THEN 4.5e0 + 0.01e0*l_discount ELSE 4.5e0 + l_tax END AS c_star_at,
  CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN CAST(-9.99e-29 AS DOUBLE)
       WHEN l_partkey % 97 = 0 THEN 25.0e0 WHEN l_partkey % 101 = 0 THEN 0.5e0
       WHEN l_suppkey % 17 = 0 THEN 6.0e0 WHEN l_suppkey % 17 = 1 THEN 6.0e0 + 0.5e0*l_discount
       ELSE 8.0e0 - 0.05e0*depth + (l_discount - 0.05e0)
         + CASE WHEN l_linestatus='O' AND l_suppkey % 11 = 0 THEN 1.5e0 WHEN l_linestatus='O' AND l_suppkey % 7 = 0 THEN 0.35e0 ELSE 0.0e0 END
  END AS dissolved_oxygen_ml_l,
  CASE WHEN l_suppkey % 16 = 3 OR l_partkey % 33 = 0 THEN NULL
       ELSE 7.5e0 - 0.04e0*depth + l_tax
         + CASE WHEN l_linestatus='O' AND l_suppkey % 16 = 5 THEN 2.0e0 WHEN l_linestatus='O' AND l_suppkey % 16 = 9 THEN 0.4e0 ELSE 0.0e0 END
  END AS rinko_do_ml_l,
  CASE WHEN l_partkey % 39 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN 180.0e0 WHEN l_partkey % 107 = 0 THEN 210.0e0
       WHEN l_suppkey % 17 = 2 THEN 90.0e0 ELSE 100.0e0 - depth + 20.0e0*l_discount END AS dissolved_oxygen_percent,
  CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_suppkey % 21 = 4 THEN 0.04e0*l_tax WHEN l_suppkey % 21 = 5 THEN l_tax
       WHEN l_suppkey % 3 = 0 AND depth < 5 THEN 6.0e0 ELSE 200.0e0/depth END AS par,
  CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_suppkey % 5 = 0 AND depth >= 48 THEN 24.0e0 - 0.1e0*(depth - 48)
       ELSE 22.0e0 + 0.06e0*depth + CASE WHEN l_suppkey % 9 = 0 THEN 0.2e0 ELSE 0.01e0 END * l_tax END AS sigma0,
  CASE WHEN l_partkey % 7 = 0 THEN 'AV: earlier run' ELSE NULL END AS par_flag,
  CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE NULL END AS par_flag_level_1,
  CASE WHEN l_partkey % 11 = 0 THEN 'SVC: earlier run' ELSE NULL END AS dissolved_oxygen_ml_l_flag,
  CASE WHEN l_partkey % 11 = 0 THEN 3 ELSE NULL END AS dissolved_oxygen_ml_l_flag_level_1,
  CASE WHEN l_partkey % 47 = 0 THEN 'NA: no value' WHEN l_partkey % 13 = 0 THEN '' ELSE NULL END AS temperature_flag,
  CASE WHEN l_partkey % 47 = 0 THEN 2 ELSE NULL END AS temperature_flag_level_1,
  CASE WHEN l_partkey % 13 = 0 THEN 'AV' ELSE NULL END AS location_flag
FROM (SELECT *, l_quantity + (l_partkey % 1000)/1000.0e0 AS depth FROM lineitem) li
"""

CASTS_SQL = """
SELECT DISTINCT concat('C', CAST(l_suppkey AS {S}), '_', l_returnflag) AS hakai_id,
  l_suppkey AS ctd_cast_pk, CASE WHEN l_suppkey % 6 = 0 THEN 'NATURE TRUST' ELSE 'HAKAI' END AS organization,
  CASE WHEN l_suppkey % 9 = 5 THEN 'ESTUARY' ELSE concat('W', CAST(l_suppkey % 3 AS {S})) END AS work_area,
  CASE WHEN l_suppkey % 20 = 19 THEN NULL ELSE concat('ST', CAST(l_suppkey % 40 AS {S})) END AS station,
  CASE l_suppkey % 4 WHEN 0 THEN '8_binAvg' WHEN 1 THEN '8_rbr_processed' WHEN 2 THEN '9_qc_auto' ELSE '10_qc_pi' END AS processing_stage,
  CASE WHEN l_suppkey % 10 = 7 THEN 'no calibration' ELSE NULL END AS process_error,
  CASE WHEN l_suppkey % 24 = 1 THEN 'Static' WHEN l_suppkey % 24 = 13 THEN NULL ELSE 'Dynamic' END AS cast_type,
  CASE l_suppkey % 12 WHEN 1 THEN 'WARNING!!! Slower Oxygen Sensor RBR CODAstandard are not recommended for profiling applications.'
    WHEN 2 THEN 'WARNING! NO SOAK DETECTED, SUSPICIOUS DATA QUALITY'
    WHEN 3 THEN 'warning: Static Measurement is considered SUSPICIOUS due to the lowered thredholds'
    WHEN 4 THEN 'Static Measurement is considered SUSPICIOUS due to the lowered thredholds'
    WHEN 5 THEN 'ok' ELSE NULL END AS process_log,
  CASE WHEN l_suppkey % 7 IN (2, 3) THEN 4 WHEN l_suppkey % 9 IN (4, 5) THEN 3 ELSE 1 END AS location_flag_level_1,
  CAST(concat('20', CAST(10 + l_suppkey % 10 AS {S}), '-03-01 00:00:00') AS TIMESTAMP) AS start_dt,
  CASE WHEN l_suppkey % 31 = 30 THEN NULL ELSE 50.0e0 + (l_suppkey % 50)/100.0e0 END AS latitude,
  CASE WHEN l_suppkey % 53 = 52 THEN 190.0e0 ELSE -125.0e0 - (l_suppkey % 20)/100.0e0 END AS longitude,
  50.0e0 + (l_suppkey % 40)/100.0e0 AS station_latitude,
  -125.0e0 - (l_suppkey % 20)/100.0e0 AS station_longitude
FROM lineitem
"""

MANUAL_QC_SQL = """
SELECT DISTINCT concat('C', CAST(l_suppkey AS {S}), '_', l_returnflag) AS hakai_id, concat('W', CAST(l_suppkey % 3 AS {S})) AS work_area,
  CASE l_suppkey % 15 WHEN 0 THEN 'SVD' WHEN 3 THEN 'SVC' WHEN 6 THEN 'AV' WHEN 9 THEN 'NA' ELSE NULL END AS dissolved_oxygen_ml_l_flag,
  CASE WHEN l_suppkey % 15 = 0 THEN 'SVC' WHEN l_suppkey % 15 = 12 THEN 'MV' ELSE NULL END AS par_flag,
  CASE WHEN l_suppkey % 30 = 3 THEN 'SVD' ELSE NULL END AS absolute_salinity_flag
FROM lineitem WHERE l_suppkey % 3 = 0
"""

STATIONS_SQL = """
SELECT DISTINCT concat('ST', CAST(s_suppkey % 40 AS {S})) AS station,
  CASE s_suppkey % 10 WHEN 8 THEN NULL WHEN 1 THEN 0.5e0 WHEN 2 THEN 15.0e0 ELSE 100.0e0 END AS station_depth
FROM supplier WHERE s_suppkey % 20 <> 19 AND s_suppkey % 40 <> 33
"""

# Two station lists that differ in some cells; keyed by supplier.
STATION_LIST_SQL = """
SELECT concat('P', CAST(s_suppkey AS {S})) AS station,
  {lat} AS latitude, -125.0e0 - (s_suppkey % 20)/100.0e0 AS longitude, {depth} AS station_depth
FROM supplier WHERE {where}
"""
FIRST_LIST = dict(lat="50.0e0 + (s_suppkey % 50)/100.0e0", depth="round(abs(s_acctbal)/50, 1)", where="s_suppkey % 10 <> 9")
SECOND_LIST = dict(
    lat="50.0e0 + (s_suppkey % 50)/100.0e0 + CASE WHEN s_suppkey % 8 = 0 THEN 0.5e0 ELSE 0.0e0 END",
    depth="CASE s_suppkey % 6 WHEN 1 THEN NULL WHEN 2 THEN round(abs(s_acctbal)/50, 1) + 1.5e0"
    " WHEN 3 THEN round(abs(s_acctbal)/50, 1) - 7.0e0 ELSE round(abs(s_acctbal)/50, 1) END",
    where="s_suppkey % 10 <> 8",
)

# Rules overlap on purpose; a later one wins. Rule 5 names a variable no table has.
GREY_SQL = """
SELECT * FROM (VALUES
  (1, TIMESTAMP '1996-01-01 00:00:00', TIMESTAMP '1997-01-01 00:00:00', 'M0', '00', CAST(NULL AS {S}), CAST(NULL AS {S}), 'dissolved_oxygen_ml_l', 4, 'Bad cable', 'A. Reviewer'),
  (2, TIMESTAMP '1996-06-01 00:00:00', TIMESTAMP '1998-01-01 00:00:00', 'M0', '00', NULL, NULL, 'dissolved_oxygen_ml_l,par', 3, 'High values, check', 'A. Reviewer'),
  (3, TIMESTAMP '1995-01-01 00:00:00', TIMESTAMP '2002-01-01 00:00:00', 'M1', '01', 'C1_A,C9_R,C17_N', NULL, 'turbidity', 4, 'Bad calibration', NULL),
  (4, TIMESTAMP '1995-01-01 00:00:00', TIMESTAMP '2002-01-01 00:00:00', 'M2', '02', NULL, 'depth > 30 AND par IS NOT NULL', 'par,flc', 4, 'Negative PAR value', 'B. Other'),
  (5, TIMESTAMP '1995-01-01 00:00:00', TIMESTAMP '2002-01-01 00:00:00', 'M3', '03', NULL, NULL, 'no_such_sensor', 4, 'Unknown sensor', 'B. Other')
) t(seq, start_datetime_range, end_datetime_range, device_model, device_sn, hakai_id, query, data_type, flag_type, comments, flagged_by)
"""

VIEWS = {
    "ctd_profile": PROFILE_SQL,
    "casts": CASTS_SQL,
    "manual_qc": MANUAL_QC_SQL,
    "stations": STATIONS_SQL,
    "grey_list": GREY_SQL,
    "first_list": STATION_LIST_SQL.format(S="{S}", **FIRST_LIST),
    "second_list": STATION_LIST_SQL.format(S="{S}", **SECOND_LIST),
}


#: Views of distinct rows that are functions of these columns: the columns are made distinct first, while rows are narrow.
KEYS = {"casts": ["l_suppkey", "l_returnflag"], "manual_qc": ["l_suppkey", "l_returnflag"]}


#: The row key, whose SQL goes beyond 64 bits from order 9,223,372 on, and the whole number in it.
KEY_SQL = PROFILE_SQL.partition("SELECT ")[2].partition(f" AS {PK}")[0]
QUANTITY_SQL = "CAST(l_quantity AS BIGINT)"


@contextmanager
def _wrapping(spark: SparkSession) -> Iterator[None]:
    """Arithmetic of columns that are made meanwhile wraps around, as the JVM's does, and raises no error."""
    name = "spark.sql.ansi.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_key(base: DataFrame) -> DataFrame:
    """Add the row key by its SQL: the number itself where it fits in 64 bits, else its last 64 bits."""
    rows = base.withColumn("qc_quantity", F.expr(QUANTITY_SQL))
    with _wrapping(base.sparkSession):
        return rows.withColumn(PK, F.expr(KEY_SQL.replace(QUANTITY_SQL, "qc_quantity"))).drop("qc_quantity")


def view(spark: SparkSession, sf_dir: str, name: str, source: DataFrame | None = None) -> DataFrame:
    """A view as a DataFrame; ``source`` replaces the table it reads (for streams and skewed tests)."""
    prepared(spark)
    table = "supplier" if "FROM supplier" in VIEWS[name] else "lineitem"
    sql = VIEWS[name].format(S="STRING")
    if name == "grey_list":
        return spark.sql(sql)
    base = source if source is not None else spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if name in KEYS:
        base = base.select(*KEYS[name]).distinct()
    if name == "ctd_profile":
        base, sql = with_key(base), sql.replace(KEY_SQL, PK)
    # The table goes in as an argument, so no view of this name is left behind in the session.
    return spark.sql(sql.replace(f"FROM {table}", "FROM {base}"), base=base)


def ctes(*names: str) -> str:
    """The views as DuckDB common table expressions."""
    return ",\n".join(f"{n} AS ({VIEWS[n].format(S='VARCHAR')})" for n in names)
