import json
import os

import pytest

from plumbline.operators import lookups
from plumbline.sources import files


def test_json_rows_with_iso_times(spark, tmp_path):
    (tmp_path / "rows.json").write_text("\n".join(json.dumps(r) for r in [
        {"ctd_data_pk": 1, "hakai_id": "a", "measurement_dt": "2020-01-01T07:00:00.000Z", "depth": 1.5, "unknown": 1},
        {"ctd_data_pk": 2, "hakai_id": "a", "measurement_dt": "not a time", "depth": None}]))
    out = files.read_ctd_data(spark, str(tmp_path / "rows.json"), "json")
    assert len(out.columns) == 90
    rows = out.selectExpr("ctd_data_pk", "date_format(measurement_dt, 'yyyy-MM-dd HH:mm') t", "depth").orderBy("ctd_data_pk").collect()
    assert [tuple(r) for r in rows] == [(1, "2020-01-01 07:00", 1.5), (2, None, None)]


def test_parquet_side_tables(spark, tmp_path):
    nan = spark.sql("SELECT 1L ctd_data_pk, 'a' hakai_id, double('NaN') temperature, 2.0D depth")
    files.write_snapshot(nan, str(tmp_path / "data"))
    assert files.read_ctd_data(spark, str(tmp_path / "data")).select("temperature", "depth").first() == (None, 2.0)
    spark.sql("SELECT 'QU1' name, 80.0D depth, 50.0D latitude, -125.0D longitude").write.parquet(str(tmp_path / "st"))
    assert files.read_stations(spark, str(tmp_path / "st")).select("station", "station_depth").first() == ("QU1", 80.0)
    spark.sql("SELECT 'a' hakai_id, '8_binAvg' processing_stage, 'x' other").write.parquet(str(tmp_path / "casts"))
    assert len(files.read_casts(spark, str(tmp_path / "casts")).columns) == 13
    spark.sql("SELECT 'a' hakai_id, 'SVC' par_flag").write.parquet(str(tmp_path / "mq"))
    assert files.read_manual_qc(spark, str(tmp_path / "mq")).select("par_flag", "flc_flag").first() == ("SVC", None)
    spark.sql("SELECT 'a' hakai_id, 'Static' cast_type, 'ok' process_log, 7 n").write.parquet(str(tmp_path / "md"))
    assert files.read_metadata(spark, str(tmp_path / "md")).first() == ("a", "Static", "ok")


def test_a_job_leaves_no_intermediate_tables(spark, tmp_path):
    """Also after a failure; what the job wrote elsewhere stays."""
    folder = files.shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    with files.job_folder(spark) as path:
        small = lookups.written(spark.range(5), "small")
        assert files.shared_folder(spark) == path and set(os.listdir(folder)) != before
        small.write.parquet(str(tmp_path / "out"))
    with pytest.raises(ValueError):
        with files.job_folder(spark):
            lookups.written(spark.range(5), "small")
            raise ValueError
    assert set(os.listdir(folder)) == before and spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_json_copies_take_a_small_part_of_their_text(spark, tmp_path):
    """Compressed, several files where there are many rows, and the same rows when read back."""
    rows = files.prepared(spark).range(3000).selectExpr(
        "id AS ctd_data_pk", "concat('c', id % 7) AS hakai_id", "date_format(timestamp_seconds(id), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS measurement_dt",
        "id / 4 AS depth", "CAST(IF(id % 3 = 0, NULL, id % 5) AS DOUBLE) AS temperature")
    files.write_snapshot(rows, str(tmp_path / "json"), fmt="json")
    found = [p for p in (tmp_path / "json").iterdir() if p.name.startswith("part-")]
    text = sum(len(json.dumps(r.asDict())) for r in rows.collect())
    assert all(p.name.endswith(".json.gz") for p in found) and sum(p.stat().st_size for p in found) < text / 4
    back = files.read_ctd_data(spark, str(tmp_path / "json"), "json").select(*rows.columns)
    want = rows.withColumn("measurement_dt", rows.measurement_dt.cast("timestamp"))
    assert back.exceptAll(want).isEmpty() and back.count() == 3000
