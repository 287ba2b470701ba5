"""Rows stored by cast: no hash exchange for tests over profiles, the same results, large casts apart."""

import pytest

from checks.adapter import view
from checks.registry import FINAL, INVERSIONS, RATES, qced
from plumbline.operators import layout, profiletests
from plumbline.plans import run
from plumbline.sources import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def copy(spark, tmp_path_factory):
    """A copy, forgotten by the session and read again."""
    path = str(tmp_path_factory.mktemp("copy"))
    stored.write_by_cast(view(spark, SF, "ctd_profile"), path, buckets=4)
    spark.sql(f"DROP TABLE {stored._name(path)}")
    return stored.read_by_cast(spark, path)


TESTS = {
    "rate_of_change": lambda p: profiletests.neighbour_tests(p, RATES, {}, "elapsed_s"),
    "bottom_hit": lambda p: profiletests.bottom_hit(profiletests.density_inversion(p, "sigma0", INVERSIONS["sigma0"])),
    "par_shadow": profiletests.par_shadow,
}


@pytest.mark.parametrize("name", TESTS)
def test_no_exchange(spark, copy, name):
    want = layout.per_cast(layout.assign_qc_group(view(spark, SF, "ctd_profile")), TESTS[name])
    out = layout.per_cast(copy.map(layout.assign_qc_group), TESTS[name])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    bag = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert bag(out) == bag(want)


def test_large_casts_lie_apart(spark, tmp_path):
    rows = view(spark, SF, "ctd_profile")
    stored.write_by_cast(rows, str(tmp_path / "c"), buckets=4, max_rows=205)
    copy = stored.read_by_cast(spark, str(tmp_path / "c"))
    per_cast = {r[0]: r[1] for r in rows.groupBy("hakai_id").count().collect()}
    large = {c for c, n in per_cast.items() if n > 205}
    assert large and {r[0] for r in copy.large.select("hakai_id").distinct().collect()} == large
    assert copy.ordinary.count() + copy.large.count() == sum(per_cast.values())
    got = run.run_qc(
        copy, view(spark, SF, "stations"), view(spark, SF, "casts"), view(spark, SF, "manual_qc").drop("work_area"),
        view(spark, SF, "grey_list"), time="elapsed_s", max_rows=205).select("ctd_data_pk", *FINAL)
    bag = lambda df: sorted(map(str, df.collect()))
    assert bag(got) == bag(qced(spark, SF).select("ctd_data_pk", *FINAL))


def test_buckets_are_written_without_a_sort(spark, tmp_path):
    """Each task writes one bucket, so whole rows need not be sorted, and spilled, by it."""
    rows = spark.range(4000).selectExpr("id AS ctd_data_pk", "concat('c', id % 37) AS hakai_id", "id / 3 AS depth")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with stored._unsorted(spark):
        name = stored._name(str(tmp_path / "plan"))
        spark.sql(f"CREATE TABLE {name} (ctd_data_pk BIGINT, hakai_id STRING, depth DOUBLE) USING parquet "
                  f"CLUSTERED BY (hakai_id) INTO 4 BUCKETS LOCATION '{tmp_path / 'plan'}'")
        rows.repartition(4, "hakai_id").createOrReplaceTempView("by_cast_rows")
        plan = spark.sql(f"EXPLAIN INSERT INTO {name} SELECT * FROM by_cast_rows").first()[0]
    spark.catalog.dropTempView("by_cast_rows")
    spark.sql(f"DROP TABLE {name}")
    assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort" not in plan
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    stored.write_by_cast(rows, str(tmp_path / "c"), buckets=4)
    found = [p.name for p in (tmp_path / "c" / "ordinary").iterdir() if p.name.startswith("part-")]
    assert len(found) == 4 and all("zstd" in n for n in found)
    assert stored.read_by_cast(spark, str(tmp_path / "c")).ordinary.exceptAll(rows).isEmpty()
