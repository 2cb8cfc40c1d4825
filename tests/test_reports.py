from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import peek, row_count, running_totals

START = datetime(2024, 1, 1)
SCHEMA = "k string, end timestamp, x bigint, y bigint"

row = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(0, 200).map(lambda h: START + timedelta(hours=h))),
    st.one_of(st.none(), st.integers(-5, 5)),
    st.integers(-5, 5),
)


def plain_running_totals(df, keys):
    """What an ordered window over all rows of a key gives, one row per time."""
    window = Window.partitionBy(*keys).orderBy("end")
    sums = {name: F.sum(name).over(window) for name in ("x", "y")}
    return df.withColumns(sums).select(*keys, "end", "x", "y").distinct()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40), keyed=st.booleans())
def test_running_totals_are_those_of_an_ordered_window(spark, rows, keyed):
    df = spark.createDataFrame(rows, SCHEMA)
    keys = ["k"] if keyed else []
    expected = sorted(map(repr, plain_running_totals(df, keys).collect()))
    found = running_totals(df, ["x", "y"], "end", keys)
    assert sorted(map(repr, found.collect())) == expected


def test_only_totals_of_ranges_meet_in_one_task(spark):
    df = spark.range(1000).select(
        F.timestamp_seconds(F.col("id") * 900).alias("end"), F.lit(1).alias("x")
    )
    found = running_totals(df, ["x"], bucket="second", slices=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = [
        lines[i + 1]
        for lines in [plan.splitlines()]
        for i, line in enumerate(lines)
        if "Exchange SinglePartition" in line
    ]
    # The aggregate of a scalar subquery, and the totals of the ranges: five rows at most.
    assert below and all(
        "HashAggregate(keys=[_slice" in line or "partial_percentile_approx" in line for line in below
    )
    assert sorted(r.x for r in found.collect()) == list(range(1, 1001))


@pytest.mark.parametrize("slices", [1, 3, 50])
@pytest.mark.parametrize("bucket", [None, "second", "month"])
def test_any_ranges_give_the_same_totals(spark, slices, bucket):
    # A third of the rows at one time, some without one.
    at = F.when(F.col("id") % 3 == 0, 600).when(F.col("id") % 7 > 0, F.pmod("id", F.lit(40)) * 60)
    df = spark.range(500).select(
        F.lit("a").alias("k"), F.timestamp_seconds(at).alias("end"), F.lit(1).alias("x"),
        F.col("id").alias("y"),
    )
    for keys in ([], ["k"]):
        expected = sorted(map(repr, plain_running_totals(df, keys).collect()))
        found = running_totals(df, ["x", "y"], "end", keys, bucket, slices)
        assert sorted(map(repr, found.collect())) == expected


def test_row_count_and_peek(spark):
    df = spark.range(50).select(F.col("id"), (50 - F.col("id")).alias("down"))
    assert row_count(df).collect()[0].n_rows == 50
    assert peek(df, 3).count() == 3
    assert [r.id for r in peek(df, 3, ["down"]).collect()] == [49, 48, 47]
    plan = peek(df, 3, ["down"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
