"""The batch job's files."""

import json

from checks.adapter import view
from plumbline.plans import batch, selection
from plumbline.sources import files


def test_documents_are_compressed_and_whole(spark, tmp_path):
    lines = files.prepared(spark).range(900).selectExpr(
        "id AS l_orderkey", "id * 7 AS l_partkey", "id % 6 AS l_suppkey", "1 AS l_linenumber", "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "1000.0D AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'A' AS l_returnflag", "IF(id % 2 = 0, 'F', 'O') AS l_linestatus",
        "timestamp'1996-03-01 00:00:00' AS l_shipdate")
    rows, casts = view(spark, "", "ctd_profile", lines), view(spark, "", "casts", lines)
    stations = view(spark, "", "stations", spark.range(6).selectExpr("id AS s_suppkey", "0.0D AS s_acctbal"))
    taken = selection.select_casts(casts)
    batch.run_batch(rows, taken, stations, str(tmp_path), time="elapsed_s")
    found = [p for p in (tmp_path / "documents").iterdir() if p.name.startswith("part-")]
    documents = [r.json for r in spark.read.json(str(tmp_path / "documents")).collect()]
    assert found and all(p.name.endswith(".json.gz") for p in found)
    assert sum(p.stat().st_size for p in found) < sum(map(len, documents)) / 4
    keys = [r["ctd_data_pk"] for d in documents for r in json.loads(d)["ctd_data"]]
    want = [r[0] for r in spark.read.parquet(str(tmp_path / "flags")).select("ctd_data_pk").collect()]
    assert want and sorted(keys) == sorted(want)
