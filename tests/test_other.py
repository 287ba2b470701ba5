import json
import uuid

import pytest
from pyspark.sql import functions as F

from plumbline import schema as S
from plumbline.config import QCConfig
from plumbline.functions import density
from plumbline.operators import casttests, greylist, lookups, timecols
from plumbline.plans import reports, run, selection
from plumbline.sources import files


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_schema_has_all_columns(spark):
    assert len(S.ctd_data_schema()) == 90 and len(S.casts_schema()) == 13 and len(S.manual_qc_schema()) == 17


def test_density_published_values(spark):
    """Check values of the public TEOS-10 documentation."""
    sa = [34.7118, 34.8915, 35.0256, 34.8472, 34.7366, 34.7324]
    t = [28.7856, 28.4329, 22.8103, 10.2600, 6.8863, 4.4036]
    p = [10, 50, 125, 250, 600, 1000]
    ct = [28.809919826700281, 28.439227816091140, 22.786176893078498, 10.226189266620782, 6.827213633479988, 4.323575748610455]
    data = [(a / density.SALINITY_FACTOR, b, float(c)) for a, b, c in zip(sa, t, p)] + [(-9.99e-29, 5.0, 1.0), (35.0, 5.0, None)]
    rows = density.derive_density(spark.createDataFrame(data, "salinity double, temperature double, pressure double")).collect()
    assert [r["conservative temperature"] for r in rows[:6]] == pytest.approx(ct, abs=1e-9)
    at = spark.createDataFrame(list(zip(sa, [28.8099, 28.4392, 22.7862, 10.2262, 6.8272, 4.3236], map(float, p))), "s double, c double, p double")
    got = at.select(density.density_from(F.col("s"), F.col("c"), F.col("p")).alias("rho"),
                    (density.density_from(F.col("s"), F.col("c"), F.lit(0.0)) - 1000).alias("sig")).collect()
    assert [r.rho for r in got] == pytest.approx(
        [1021.839935738108, 1022.262457966867, 1024.427195413316, 1027.790152759127, 1029.837779000189, 1032.002453224572], abs=1e-8)
    assert [r.sig for r in got] == pytest.approx(
        [21.797900819337656, 22.052215404397316, 23.892985307893923, 26.667608665972011, 27.107380455119710, 27.409748977090885], abs=1e-8)
    assert rows[6]["density"] is None and rows[7]["sigma0"] is None


def test_id_list(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text("# head\n\na_1 # why\n  b_2\n#c_3\nd_4\n")
    assert sorted(r[0] for r in files.read_id_list(spark, str(path)).collect()) == ["a_1", "b_2", "d_4"]


GREY = """start_datetime_range,end_datetime_range,device_model,device_sn,hakai_id,query,data_type,flag_type,comments,flagged_by
2020-01-01T00:00:00.000Z,2020-02-01T00:00:00.000Z,M,007,,,"par,flc",4,"Bad, really",Someone
2020-01-15T00:00:00.000Z,2020-03-01T00:00:00.000Z,M,007,"c1,c2",depth > 5,par,3,Second,
"""


def test_grey_list(spark, tmp_path):
    path = tmp_path / "grey.csv"
    path.write_text(GREY)
    rules = files.read_grey_list(spark, str(path))
    assert [r.device_sn for r in rules.collect()] == ["007", "007"]
    data = [(1, "c1", "2020-01-01 00:00:00", 9.0, None), (2, "c1", "2020-01-20 00:00:00", 9.0, "SVC: t"),
            (3, "c1", "2020-01-20 00:00:00", 2.0, None), (4, "c3", "2020-02-20 00:00:00", 9.0, "old"),
            (5, "c2", "2020-03-01 00:00:00", 9.0, None), (6, "c2", None, 9.0, None)]
    df = spark.createDataFrame(data, "ctd_data_pk long, hakai_id string, measurement_dt string, depth double, par_flag string")
    df = timecols.to_utc(df).selectExpr("*", "'M' device_model", "'007' device_sn", "1.0D par", "1.0D flc", "1 par_flag_level_1")
    rows = {r.ctd_data_pk: r for r in greylist.apply_grey_list(df, rules).collect()}
    first, second = "SVD: Hakai Grey List - Bad, really flagged by Someone", "SVC: Hakai Grey List - Second"
    assert {k: (r.par_flag_level_1, r.par_flag, r.par_grey_list_test) for k, r in rows.items()} == {
        1: (4, first, 4), 2: (3, f"SVC: t; {first}; {second}", 3), 3: (4, first, 4), 4: (1, "old", 1),
        5: (3, second, 3), 6: (1, None, 1)}
    assert [rows[k].flc_flag_level_1 for k in range(1, 7)] == [4, 4, 4, None, None, None]
    assert sorted(map(tuple, greylist.match_grey_list(df, rules).collect())) == sorted(
        [(1, 0), (2, 0), (2, 1), (3, 0), (5, 1)])


def test_lookup_gives_the_same_beyond_the_broadcast_size(spark):
    df = spark.range(1000).selectExpr("id as ctd_data_pk", "if(id % 3 = 0, 'hot', string(id % 7)) as k")
    table = spark.createDataFrame([("hot", 1), ("1", 2), ("2", 3)], "k string, v int")
    a, b = (sorted(map(tuple, lookups.lookup(df, table, ["k"], rows=n).collect()), key=str) for n in (100, 2))
    assert a == b and len(a) == 1000
    assert "BroadcastHashJoin" in lookups.lookup(df, table, ["k"], rows=100)._jdf.queryExecution().toString()


def test_documents_are_whole_when_a_cast_is_split(spark):
    rows = spark.range(500).selectExpr(
        "id as ctd_data_pk", "if(id < 400, 'big', 'small') as hakai_id", "'x' as par_flag", "'4' as par_flag_level_1",
        "'d' as direction_flag", "'p' as process_flag")
    casts = spark.createDataFrame([(1, "big", "s", None), (2, "small", "s", "e"), (3, "none", "s", None)],
                                  "ctd_cast_pk long, hakai_id string, processing_stage string, process_error string")
    docs = files.flags_json(casts, rows, rows_per_document=150).collect()
    parsed = [json.loads(d.json) for d in docs]
    assert sum(d.hakai_id == "big" for d in docs) == 3 and sum(d.hakai_id == "small" for d in docs) == 1
    assert sorted(r["ctd_data_pk"] for p in parsed for r in p["ctd_data"]) == list(range(500))
    assert set(parsed[0]["cast"]) == {"ctd_cast_pk", "hakai_id", "processing_stage", "process_error"}
    assert {k for p in parsed for r in p["ctd_data"] for k in r} == {"ctd_data_pk", "par_flag", "par_flag_level_1"}
    assert next(p for p in parsed if p["cast"]["hakai_id"] == "none")["ctd_data"] == []


def test_median_matches_sorting(spark):
    df = spark.range(3001).selectExpr("if(id % 3 = 0, 'a', 'b') as g", "double((id * 7919) % 5003) / 16 as v")
    want = {}
    for g, v in df.collect():
        want.setdefault(g, []).append(v)
    got = {r.g: r.m for r in reports.lower_median(df, ["g"], "v", "m").collect()}
    assert got == {g: sorted(v)[(len(v) + 1) // 2 - 1] for g, v in want.items()}


def test_side_tables_fold_to_one_row_per_key(spark):
    codes = spark.createDataFrame([("a", 4, None), ("a", 9, 1), ("b", 2, 9), ("b", 1, 2), ("c", None, None)], "k string, n int, m int")
    assert sorted(map(tuple, casttests.folded(codes, "k").collect())) == [("a", 4, 1), ("b", 1, 2), ("c", None, None)]
    reviews = spark.createDataFrame([("x", "SVD"), ("x", "MV"), ("y", "AV")], "hakai_id string, par_flag string")
    folded = casttests.folded(casttests.manual_qc_codes(reviews), "hakai_id")
    assert {r.hakai_id: r.par_manual_qc_flag for r in folded.collect()} == {"x": 4, "y": 1}
    logs = spark.createDataFrame(
        [("x", None, "WARNING! NO SOAK DETECTED, SUSPICIOUS DATA QUALITY"), ("x", None, "ok, zzz"), ("y", None, None)],
        "hakai_id string, cast_type string, process_log string")
    folded = casttests.folded(casttests.process_log_flags(logs), "hakai_id")
    assert {r.hakai_id: r.salinity_hakai_no_soak_test for r in folded.collect()} == {"x": 3, "y": None}
    stations = spark.createDataFrame([("s", 5.0), ("s", 9.0), ("s", None), ("t", None)], "station string, station_depth double")
    assert dict(map(tuple, casttests.deepest(stations).collect())) == {"s": 9.0, "t": None}


def test_do_cap_without_a_column_is_missing(spark):
    rows = spark.createDataFrame([("c", "d", 1.0, 5.0), ("c", "u", 1.0, 5.1)], "hakai_id string, direction_flag string, depth double, dissolved_oxygen_ml_l double")
    got = casttests.do_cap(rows).first().asDict()
    assert got["rinko_do_ml_l_hakai_do_cap_test"] == 9 and got["dissolved_oxygen_ml_l_hakai_do_cap_test"] != 9


def test_documents_of_a_cast_do_not_depend_on_the_others(spark):
    def documents(n_others):
        rows = spark.range(400 + n_others).selectExpr("id as ctd_data_pk", "if(id < 400, 'c', concat('o', id % 3)) as hakai_id", "'AV' as par_flag", "1 as par_flag_level_1")
        casts = rows.select("hakai_id").distinct().selectExpr("hakai_id", "1L as ctd_cast_pk", "'9' as processing_stage", "'' as process_error")
        return {(r.part, r.json) for r in files.flags_json(casts, rows, rows_per_document=100).filter("hakai_id = 'c'").collect()}

    alone = documents(0)
    assert len(alone) == 4 and documents(5000) == alone
    assert sum(len(json.loads(j)["ctd_data"]) for _, j in alone) == 400


def test_many_rules_of_one_device(spark):
    rows = spark.createDataFrame([(1, "M", "0", "2020-01-02", 5.0, "c"), (2, "M", "1", "2020-01-02", 5.0, "c")],
                                 "ctd_data_pk long, device_model string, device_sn string, at string, par double, hakai_id string")
    rows = rows.withColumn("measurement_dt", F.to_timestamp("at"))
    rules = spark.range(3000).selectExpr(
        "id as seq", "timestamp'2020-01-01' as start_datetime_range", "timestamp'2020-01-03' as end_datetime_range",
        "'M' as device_model", "'0' as device_sn", "cast(null as string) as hakai_id",
        "if(id % 10 = 0, concat('par > ', id % 250), 'par < 0') as query", "'par' as data_type", "'x' as comments", "'' as flagged_by",
        "if(id = 2750, 4, 3) as flag_type")
    hits = greylist.match_grey_list(rows, rules).collect()
    assert {(r.ctd_data_pk, r.seq) for r in hits} == {(1, i) for i in range(3000) if i % 10 == 0 and i % 250 < 5}
    got = {r.ctd_data_pk: r.par_flag_level_1 for r in greylist.apply_grey_list(rows, rules).collect()}
    assert got == {1: 4, 2: None}


def test_stage_and_selection(spark):
    casts = spark.createDataFrame([("a", "8_binAvg", None), ("b", "10_qc_pi", "e")], "hakai_id string, processing_stage string, process_error string")
    assert sorted(map(tuple, selection.advance_stage(casts).collect())) == [("a", "9_qc_auto", ""), ("b", "10_qc_pi", "e")]
    assert [r.hakai_id for r in selection.select_casts(casts, ids=["b"]).collect()] == ["b"]
    assert [r.hakai_id for r in selection.select_casts(casts).collect()] == ["a"]


def test_registered_test_feeds_its_variable(spark):
    from checks.registry import profiles, view

    def always(df):
        return df.withColumn("par_hakai_always_suspect_test", F.lit(3))

    sf, cfg = "/root/testdata/sf0.001", QCConfig(user_tests=(always,))
    for max_rows in (None, 50):
        out = run.run_qc(profiles(spark, sf), view(spark, sf, "stations"), time="elapsed_s", cfg=cfg, max_rows=max_rows)
        rows = out.filter("par IS NOT NULL").select("par_flag_level_1", "par_flag").distinct().collect()
        assert rows and all(r.par_flag_level_1 >= 3 and "par_hakai_always_suspect_test" in r.par_flag for r in rows)


def test_station_review_is_ordered(spark):
    from checks import registry

    rows = registry.QUERIES["station_flag_review"](spark, "/root/testdata/sf0.01").select("flagged_profiles_count", "station").collect()
    assert rows and [tuple(r) for r in rows] == sorted(map(tuple, rows), key=lambda r: (-r[0], r[1]))


def test_heavy_keys_are_split_by_their_share(spark):
    """One station in a third of all rows: no task reads more than twice the median, and only that key is split."""
    df = spark.range(120_000).selectExpr("id AS ctd_data_pk", "IF(id % 3 = 0, 'hot', concat('s', id % 4001)) AS station")
    table = spark.range(4001).selectExpr("concat('s', id) AS station", "id AS v").union(spark.sql("SELECT 'hot', -1L"))
    heavy = lookups.heavy_keys(df.select("station"), ["station"])
    assert [h["qc_parts"] for h in heavy] == [pytest.approx(8 * lookups.PARTS / 3, abs=2)]
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = lookups.lookup(df, table, ["station"], small=False)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and sum(sizes) == 120_000
        assert out.filter("v IS NULL").count() == 0 and out.filter("v = -1").count() == 40_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_median_of_very_many_values_in_one_metre(spark):
    """10^6 different values within one metre, next to small groups, values on both sides of zero and equal values."""
    df = spark.range(1_000_000).selectExpr("'many' AS g", "10 + ((id * 7919) % 1000003) / 1e7 AS v").union(
        spark.range(30_001).selectExpr("'wide' AS g", "IF(id % 2 = 0, -1, 1) * pow(10.0D, (id % 200) - 100) * (1 + id) AS v")).union(
        spark.range(50_000).selectExpr("'equal' AS g", "IF(id % 5 = 0, id / 7, 3.0D) AS v")).union(
        spark.sql("SELECT * FROM VALUES ('few', 2.0D), ('few', 1.0D), ('none', NULL) t(g, v)"))
    got = {r.g: r.m for r in reports.lower_median(df, ["g"], "v", "m").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("m")).collect()}
    assert got == {g: m for g, m in want.items() if m is not None} and len(got) == 4
