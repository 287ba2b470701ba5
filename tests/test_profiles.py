"""Ordered and whole-cast tests against plain Python, whole and cut into chunks of any size."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from plumbline.config import Attenuated, DoCap, Inversion, StationDepth, UserTest
from plumbline.operators import casttests, layout, profiletests

SCHEMA = ("ctd_data_pk long, hakai_id string, direction_flag string, measurement_dt timestamp_ntz, depth double, "
          "sigma0 double, par double, t double, station string, station_depth double")


def make(seed=1, casts=4, rows=60):
    """Casts of several sizes with ties, missing depths, missing values and static rows."""
    import datetime as dt

    rnd, out = random.Random(seed), []
    for c in range(casts):
        for _ in range(rows * (4 if c == 0 else 1)):
            depth = None if rnd.random() < 0.05 else float(rnd.randrange(0, 40))
            d = rnd.choice("ddduuus")
            out.append((
                len(out) * 7 % 100003, f"c{c}", d, dt.datetime(2020, 1, 1, rnd.randrange(3)), depth,
                None if rnd.random() < 0.1 else round(20 + (depth or 0) * 0.05 + rnd.random() * 0.05, 3),
                None if c == 2 or rnd.random() < 0.1 else round(200 / ((depth or 0) + 1) * rnd.random(), 3),
                rnd.random() * 10, rnd.choice(["s1", "s2", None]), 5.0,
            ))
    return out


def groups(data, static_time=True):
    found = {}
    for r in data:
        key = (r[1], r[2], r[3] if r[2] == "s" and static_time else 0)
        found.setdefault(key, []).append(r)
    for rows in found.values():
        rows.sort(key=lambda r: (r[4] is None, r[4] or 0, r[0]))
    return found


def sign(x):
    return (x > 0) - (x < 0)


def expected(data):
    inv, rate, shadow = {}, {}, {}
    for rows in groups(data).values():
        for i, r in enumerate(rows):
            steps = []
            for j, s in ((i - 1, 1), (i + 1, -1)):
                if 0 <= j < len(rows) and None not in (r[4], rows[j][4], r[5], rows[j][5]):
                    steps.append(sign((r[4] - rows[j][4]) * s) * (r[5] - rows[j][5]) * s)
            worst = min(steps, default=0)
            inv[r[0]] = (9 if r[5] is None or r[4] is None else 2 if len(rows) == 1
                         else 4 if worst < -0.03 else 3 if worst < -0.005 else 1)
            prev = rows[i - 1] if i else None
            fast = prev and None not in (prev[5], r[5]) and abs(r[5] - prev[5]) > 0.01 * (abs(r[7] - prev[7]) or 1)
            rate[r[0]] = 9 if r[5] is None else 3 if fast else 1
    hit, good, att = {}, {}, {}
    any_par = {r[1] for r in data if r[6] is not None}
    for (cast, d, _), rows in groups(data, static_time=False).items():
        if inv[rows[-1][0]] in (3, 4):
            hit[cast] = True
        good[cast, d] = max((r[4] for r in rows if inv[r[0]] == 1), default=None)
        values = [r[5] for r in rows if r[5] is not None]
        spread = max(values) - min(values)
        std = statistics.pstdev(values)
        for r in rows:
            att[r[0]] = None if d == "s" else 9 if r[5] is None else 4 if spread < 0.5 else 3 if spread < 1.95 else 1
        deep = None
        for r in sorted(rows, key=lambda r: (r[4] is not None, r[4] or 0, r[0]), reverse=True):
            if r[4] is None:
                continue
            if r[6] is not None:
                deep = r[6] if deep is None else max(deep, r[6])
            shadow[r[0]] = 3 if r[6] is not None and r[6] < deep and deep > 5 else 1
        for r in sorted((r for r in rows if r[4] is None), key=lambda r: -r[0]):
            if r[6] is not None:
                deep = r[6] if deep is None else max(deep, r[6])
            shadow[r[0]] = 3 if r[6] is not None and r[6] < deep and deep > 5 else 1
    for r in data:
        if r[1] not in any_par:
            shadow[r[0]] = 2
    bottom = {
        r[0]: 4 if hit.get(r[1]) and r[4] is not None and good[r[1], r[2]] is not None and r[4] > good[r[1], r[2]] else 1
        for r in data}
    deepest = {}
    for r in data:
        if r[8] and r[4] is not None:
            deepest[r[1], r[8]] = max(r[4], deepest.get((r[1], r[8]), 0))
    station = {r[0]: 4 if deepest[r[1], r[8]] > 36 else 3 if deepest[r[1], r[8]] > 35 else 1 for r in data if r[8]}
    return {"inv": inv, "rate": rate, "shadow": shadow, "bottom": bottom, "att": att, "station": station}


def actual(spark, data, max_rows):
    df = layout.assign_qc_group(spark.createDataFrame(data, SCHEMA))

    def tests(part):
        out = profiletests.neighbour_tests(part, {"sigma0": 0.01}, {"sigma0": Inversion(-0.005, -0.03)}, "t")
        out = profiletests.bottom_hit(out)
        out = profiletests.attenuated_signal(out, {"sigma0": Attenuated(1.95, 0.5, "range")})
        out = profiletests.par_shadow(out, source=part)
        return casttests.station_depth(out, StationDepth(7.0, 7.2, 30, 31), keep_unmatched=True, source=part)

    rows = layout.per_cast(df, tests, max_rows).collect()
    assert len(rows) == len(data)
    pick = lambda c: {r["ctd_data_pk"]: r[c] for r in rows}
    return {
        "inv": pick("sigma0_qartod_density_inversion_test"), "rate": pick("sigma0_qartod_rate_of_change_test"),
        "shadow": pick("par_shadow_test"), "bottom": pick("bottom_hit_test"),
        "att": pick("sigma0_qartod_attenuated_signal_test"),
        "station": {k: v for k, v in pick("depth_in_station_range_test").items() if v is not None},
    }


@pytest.mark.parametrize("max_rows", [None, 100, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_profile_tests(spark, max_rows, seed):
    data = make(seed)
    want, got = expected(data), actual(spark, data, max_rows)
    for test in want:
        assert got[test] == want[test], test


def test_chunks_are_bounded_and_ordered(spark):
    rows = spark.range(20000).selectExpr(
        "id as ctd_data_pk", "'c' as hakai_id", "'d' as direction_flag",
        "case when id % 10 = 0 then null when id % 3 = 0 then 7.0 else double(id % 500) end as depth")
    cut = layout.with_chunks(rows, 1000)
    stats = cut.groupBy("qc_chunk").agg(
        F.count("*").alias("n"), F.min(layout.depth_key()).alias("lo"), F.max(layout.depth_key()).alias("hi")
    ).orderBy("qc_chunk").collect()
    assert sum(r.n for r in stats) == 20000 and len(stats) > 10
    assert max(r.n for r in stats) < 3000  # a third of the rows share one depth, and are cut all the same
    assert all(a.hi < b.lo for a, b in zip(stats, stats[1:]))


def test_rate_of_change_time_steps(spark):
    """Same time: the threshold itself; a step back of less than a second counts as one second, one ahead as none."""
    import datetime as dt

    at = dt.datetime(2020, 1, 1)
    steps = [(0, 10.0), (0, 10.01), (0, 16.0), (-300, 16.1), (-300, 22.0), (300, 22.1), (2500, 31.0), (2500, 42.0)]
    rows, now = [], at
    for k, (ms, value) in enumerate(steps):
        now += dt.timedelta(milliseconds=ms)
        rows.append((k, "c", "u", now, float(k), value))
    data = spark.createDataFrame(rows, "ctd_data_pk long, hakai_id string, direction_flag string, measurement_dt timestamp_ntz, depth double, temperature double")
    out = layout.per_cast(layout.assign_qc_group(data), lambda p: profiletests.rate_of_change(p, "temperature", 5.0))
    got = [r[0] for r in out.orderBy("ctd_data_pk").select("temperature_qartod_rate_of_change_test").collect()]
    assert got == [1, 1, 3, 1, 3, 1, 1, 3]


def test_chunk_size_does_not_grow_with_the_table(spark):
    def largest(n):
        rows = spark.range(n).selectExpr("id as ctd_data_pk", "'c' as hakai_id", "'d' as direction_flag", "double(id % 977) as depth")
        return layout.with_chunks(rows, 500).groupBy("qc_chunk").count().agg(F.max("count")).first()[0]

    assert largest(5_000) < 1000 and largest(100_000) < 1000


def test_ordinary_casts_move_once(spark):
    df = layout.assign_qc_group(spark.createDataFrame(make(), SCHEMA))

    def tests(part):
        out = profiletests.bottom_hit(profiletests.density_inversion(part, "sigma0", Inversion(-0.005, -0.03)))
        return casttests.station_depth(profiletests.par_shadow(out))

    plan = layout.per_cast(df, tests)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def cap(spark, values):
    """values: {(cast, direction): f(depth) or None}"""
    data = [(c, d, float(z) + 0.2, f(z)) for (c, d), f in values.items() for z in range(40)]
    df = spark.createDataFrame(data, "hakai_id string, direction_flag string, depth double, v double")
    return {r.hakai_id: r.v_hakai_do_cap_test for r in casttests.do_cap(df, DoCap(variables=("v",))).collect()}


def test_do_cap(spark):
    base = lambda z: 5.0 - z / 100
    got = cap(spark, {
        ("none", "d"): lambda z: None, ("none", "u"): lambda z: None,
        ("single", "d"): base,
        ("same", "d"): base, ("same", "u"): base,
        ("few", "d"): base, ("few", "u"): lambda z: base(z) + (0.9 if z < 20 else 0),
        ("small", "d"): base, ("small", "u"): lambda z: base(z) + 0.1,
        ("suspect", "d"): base, ("suspect", "u"): lambda z: base(z) + 0.3,
        ("fail", "d"): base, ("fail", "u"): lambda z: base(z) + 0.8,
        ("half", "d"): base, ("half", "u"): lambda z: base(z) + (0.8 if z < 20 else 0.1),
    })
    # No differing bin ("same") is not "too few"; exactly half is not more than half.
    assert got == {"none": 9, "single": 2, "same": 1, "few": 2, "small": 1, "suspect": 3, "fail": 4, "half": 1}


def test_process_log(spark):
    slow, soak, short = casttests.SLOW_OXYGEN_LOG, casttests.NO_SOAK_LOG, casttests.SHORT_STATIC_LOG
    df = spark.createDataFrame(
        [("a", "Static", slow), ("b", None, "x " + slow), ("c", "Cast", soak), ("d", "Cast", short),
         ("e", "Cast", "warning " + short), ("f", "Cast", None)], "hakai_id string, cast_type string, process_log string")
    rows = {r.hakai_id: r for r in casttests.process_log_flags(df).collect()}
    slow_col = "dissolved_oxygen_ml_l_hakai_slow_oxygen_sensor_test"
    assert [rows[k][slow_col] for k in "abcdef"] == [None, 3, None, None, None, None]
    assert [rows[k]["salinity_hakai_no_soak_test"] for k in "abcdef"] == [None, None, 3, None, None, None]
    assert [rows[k]["hakai_short_static_deployment_test"] for k in "abcdef"] == [None, None, None, None, 3, None]


def test_plan_of_a_whole_run(spark):
    from checks import registry

    plan = registry.QUERIES["qc_run"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 8 and plan.count("Sort [") <= 3


def windowed(back, ahead):
    """A test that sees the sum of some rows above and the largest of some rows below."""

    def fn(df):
        rows = layout.ordered(df)
        below = F.max("par").over(rows.rowsBetween(1, ahead)) if ahead else F.lit(None).cast("double")
        return df.withColumns({
            "above": F.sum("t").over(rows.rowsBetween(-back, -1)), "below": below,
            "n": F.count(F.lit(1)).over(rows.rowsBetween(-back, ahead))})

    return UserTest(fn, back, ahead)


@pytest.mark.parametrize("back,ahead", [(3, 2), (40, 25), (1, 0)])
def test_user_tests_see_beyond_their_chunk(spark, back, ahead):
    """The same for whole casts, for chunks larger than the halo, and for chunks that the halo spans."""
    data = make(4)
    df = layout.assign_qc_group(spark.createDataFrame(data, SCHEMA))
    want = {}
    for rows in groups(data).values():
        for i, r in enumerate(rows):
            above, below = rows[max(0, i - back) : i], rows[i + 1 : i + 1 + ahead]
            values = [x[6] for x in below if x[6] is not None]
            want[r[0]] = (sum(x[7] for x in above) if above else None, max(values, default=None), len(above) + 1 + len(below))
    for max_rows in (None, 100, 10):
        tests = [windowed(back, ahead), lambda d: d.withColumn("own", F.col("t") * 2)]
        if ahead == 0:
            tests = tests[:1]
        got = layout.per_cast(df, lambda p: layout.with_user_tests(p, tests), max_rows).collect()
        assert len(got) == len(data)
        for r in got:
            above, below, n = want[r.ctd_data_pk]
            assert r.n == n and r.below == below
            assert r.above == (None if above is None else pytest.approx(above))
        assert "qc_halo" not in got[0].asDict()


def test_rows_of_the_registered_user_test_are_narrow(spark, monkeypatch):
    """Casts are cut there, and cut casts are written: only with what the test needs."""
    from checks import registry
    from plumbline import schema as S

    widths, real = {}, layout.written
    monkeypatch.setattr(layout, "written", lambda d, name: widths.setdefault(name, set(d.columns)) and real(d, name))
    lines = spark.range(600).selectExpr(
        "id AS l_orderkey", "id * 7 AS l_partkey", "id % 2 AS l_suppkey", "1 AS l_linenumber", "CAST(id % 50 AS DOUBLE) AS l_quantity",
        "1000.0D AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'A' AS l_returnflag", "'F' AS l_linestatus",
        "timestamp'1996-03-01 00:00:00' AS l_shipdate")
    monkeypatch.setattr(registry, "profiles", lambda spark, sf: registry.view(spark, "", "ctd_profile", lines))
    out = registry.user_test(spark, "")
    assert out.count() == 600
    assert widths["cut-casts"] == {*S.QC_GROUP, S.DEPTH, S.PK, S.CHUNK, "conductivity"}


def test_casts_of_a_run_are_summed_up_once(spark, monkeypatch):
    """The sums by cast are hashed and not sorted, and also tell the sizes of casts, so rows are not counted again."""
    from checks import registry
    from plumbline.plans import run

    tables, counted = [], []
    keep, count = run.written, layout.large_casts
    monkeypatch.setattr(run, "written", lambda t, name: tables.append(t) or keep(t, name))
    monkeypatch.setattr(layout, "large_casts", lambda df, max_rows=None: counted.append(df.columns) or count(df, max_rows))
    registry.qced(spark, "/root/testdata/sf0.001")
    assert len(tables) == 1 and len(counted) == 1 and layout.ROWS in counted[0]
    plan = tables[0]._jdf.queryExecution().executedPlan().toString()
    sums = [x for x in plan.splitlines() if "Aggregate(" in x and "qc_of_par" in x]
    assert sums and not any("ObjectHashAggregate" in x for x in sums)
