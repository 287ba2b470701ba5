"""Orders so large that the row key goes beyond 64 bits: its last 64 bits count, and every row is there."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import oracles
from checks.adapter import KEY_SQL, QUANTITY_SQL, view, with_key
from checks.compare import compare

SQL = oracles.oracle_sql()
HUGE = KEY_SQL.replace("l_orderkey", "CAST(l_orderkey AS HUGEINT)")
TWO_63, TWO_64 = (f"CAST('{2**n}' AS HUGEINT)" for n in (63, 64))
WRAPPED = f"CAST((({HUGE}) + {TWO_63}) % {TWO_64} - {TWO_63} AS BIGINT)"


def orders(spark, first, rows=400):
    """Rows of few casts, each at a depth of its own, on orders from a number on."""
    return spark.range(rows, numPartitions=2).selectExpr(
        f"{first} + id AS l_orderkey", "7 * id + 1 AS l_partkey", "id % 9 AS l_suppkey", "CAST(1 + id % 7 AS INT) AS l_linenumber",
        "CAST(1 + id % 50 AS DOUBLE) AS l_quantity", "1000.0D + id AS l_extendedprice", "(id % 11) / 100.0D AS l_discount",
        "(id % 9) / 100.0D AS l_tax", "substr('ANR', CAST(1 + id % 3 AS INT), 1) AS l_returnflag",
        "substr('FO', CAST(1 + id % 2 AS INT), 1) AS l_linestatus",
        "CAST(timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(CAST(3 * id AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Half of the keys fit, and half do not."""
    folder = str(tmp_path_factory.mktemp("large-keys"))
    orders(spark, 9_223_372 - 200).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(9).selectExpr("id AS s_suppkey", "0.0D AS s_acctbal").write.parquet(f"{folder}/supplier.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    return con, folder


@pytest.mark.parametrize("name", [
    "incremental_late_rows", "incremental_run", "stored_by_cast", "batch_run", "upload_documents", "qc_run", "station_flag_review"])
def test_query(spark, tables, name):
    con, folder = tables
    sql = SQL[name]
    assert KEY_SQL in sql
    assert compare(spark, con, folder, entry.queries()[name], sql.replace(KEY_SQL, WRAPPED)) is None


@pytest.mark.parametrize("first", [0, 9_223_372 - 200, 54_000_000, 10**15])
def test_keys(spark, first):
    rows = orders(spark, first)
    got = view(spark, "", "ctd_profile", rows).select("ctd_data_pk", F.round("elapsed_s", 3).alias("at"))
    want = []
    for r in rows.collect():
        key = (((r.l_orderkey * 10 + r.l_linenumber) * 100000 + r.l_partkey) * 10000 + r.l_suppkey) * 100 + int(r.l_quantity)
        want.append(((key + 2**63) % 2**64 - 2**63, round(4 * (r.l_quantity + r.l_partkey % 1000 / 1000), 3)))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len({k for k, _ in want}) == len(want)


def test_only_the_key_wraps(spark):
    """The session's arithmetic stays as it is, and what is no whole number is still an error."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    keyed = with_key(orders(spark, 54_000_000).withColumn("l_quantity", F.lit(float("nan"))))
    assert spark.conf.get("spark.sql.ansi.enabled") == before == "true"
    with pytest.raises(Exception, match="CAST_OVERFLOW|cannot be cast"):
        keyed.select("ctd_data_pk").collect()
    assert QUANTITY_SQL in KEY_SQL
