import pytest

from plumbline.config import GrossRange, QueryRule
from plumbline.operators import rowtests
from plumbline.schema import BAD_VALUE


@pytest.mark.parametrize("value,flag", [(BAD_VALUE, 4), (None, 9), (float("nan"), 9)])
@pytest.mark.parametrize("places", [[7], [0], [0, 2, 3]])
def test_bad_value(spark, value, flag, places):
    data = [(i, value if i in places else float(i)) for i in range(8)]
    rows = rowtests.bad_value(spark.createDataFrame(data, "i int, x double"), ["x"]).collect()
    assert {r.i: r.x_hakai_bad_value_test for r in rows} == {i: flag if i in places else 1 for i in range(8)}


def test_empty_table_gets_the_column(spark):
    out = rowtests.bad_value(spark.createDataFrame([], "x double"), ["x"])
    assert out.columns == ["x", "x_hakai_bad_value_test"] and out.count() == 0


def test_null_sentinels_leaves_other_types(spark):
    df = spark.createDataFrame([(BAD_VALUE, 1, "a"), (float("nan"), 2, "b"), (0.0, 3, "c")], "x double, i int, s string")
    assert [tuple(r) for r in rowtests.null_sentinels(df).collect()] == [(None, 1, "a"), (None, 2, "b"), (0.0, 3, "c")]


def test_query_flag(spark):
    df = spark.createDataFrame(list(zip(range(1, 7), "abcdef")), "x int, y string")
    rows = rowtests.query_flags(df, [QueryRule("x = 1", ("result_test",), 4)]).collect()
    assert [r.result_test for r in rows] == [4, 1, 1, 1, 1, 1]


def test_later_query_rule_wins_and_null_is_no_match(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    rules = [QueryRule("x >= 1", ("a", "b"), 3), QueryRule("x = 2", ("a",), 4)]
    rows = rowtests.query_flags(df, rules).collect()
    assert [(r.a, r.b) for r in rows] == [(3, 3), (4, 3), (3, 3), (1, 1)]


def test_gross_range_ends_are_good(spark):
    df = spark.createDataFrame([(v,) for v in (-0.2, -0.1, 0.0, 5.0, 8.0, 9.0, 9.1, None)], "x double")
    rows = rowtests.gross_range(df, {"x": GrossRange((-0.1, 9), (0, 8))}).collect()
    assert [r.x_qartod_gross_range_test for r in rows] == [4, 3, 1, 1, 1, 3, 4, 9]
