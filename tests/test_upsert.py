"""Upserts of frames, and the stores that micro-batches keep up to date."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException, UnsupportedOperationException
from pyspark.sql import functions as F

from millrace.operators import merge_into, upsert
from millrace.queries.inputs import scratch_table
from millrace.session import run_dir
from millrace.streaming import Snapshots, UpsertStore
from millrace.streaming.folders import finished, remove, subfolders

PAIR = "k string, v bigint"
TARGET = [("a", 1), (None, 5)]
SOURCE = [("a", 10), (None, 7), ("c", 3)]


def frame(spark, rows, schema=PAIR):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "rule, null_safe, expected",
    [
        ("accumulate", True, [("a", 11), (None, 12), ("c", 3)]),
        ("accumulate", False, [("a", 11), (None, 5), (None, 7), ("c", 3)]),
        ("replace", True, [("a", 10), (None, 7), ("c", 3)]),
        ("replace", False, [("a", 10), (None, 5), (None, 7), ("c", 3)]),
    ],
)
def test_upsert_and_store_agree(spark, root, rule, null_safe, expected):
    target, source = frame(spark, TARGET), frame(spark, SOURCE)
    found = upsert(target, source, ["k"], rule, null_safe)
    assert rows_of(found) == sorted(expected, key=repr)
    store = UpsertStore(root, ["k"], rule, null_safe=null_safe)
    store.apply(target, 0)
    store.apply(source, 1)
    assert rows_of(store.read(spark)) == sorted(expected, key=repr)


def test_replace_also_takes_nulls(spark):
    found = upsert(frame(spark, [("a", 1), ("b", 2)]), frame(spark, [("a", None)]), ["k"])
    assert rows_of(found) == [("a", None), ("b", 2)]


def test_struct_keys(spark):
    schema = "k struct<a: string, b: int>, v bigint"
    target = frame(spark, [((None, 1), 1), (("x", 1), 2)], schema)
    source = frame(spark, [((None, 1), 10)], schema)
    assert rows_of(upsert(target, source, ["k"]).select("k.a", "k.b", "v")) == [
        ("x", 1, 2),
        (None, 1, 10),
    ]


@pytest.mark.parametrize("rule", ["replace", "accumulate"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_each_side_is_read_once(spark, root, rule, null_safe):
    for name, size in (("target", 1000), ("source", 3)):
        spark.range(size).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(
            f"{root}/{name}"
        )
    sides = [spark.read.parquet(f"{root}/{name}") for name in ("target", "source")]
    plan = upsert(*sides, ["k"], rule, null_safe)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange ") == 1


def test_repeated_source_keys(spark):
    target = frame(spark, [("a", 1), ("b", 2), (None, 3)])
    source = spark.createDataFrame(
        [("a", 10, 1), ("a", None, 3), ("a", 30, 2), ("c", 5, 1), (None, 7, 1), (None, 8, 2)],
        "k string, v bigint, at int",
    )
    with pytest.raises(SparkRuntimeException, match="several rows of one key"):
        upsert(target, source, ["k"]).collect()
    with pytest.raises(SparkRuntimeException, match="several rows of one key"):
        upsert(target.select("k"), source.select("k"), ["k"]).collect()
    newest = upsert(target, source, ["k"], order=["at"])
    assert newest.columns == ["k", "v"]
    assert rows_of(newest) == sorted([("a", None), ("b", 2), ("c", 5), (None, 8)], key=repr)
    # Where nulls are no keys, rows with one are neither repeated nor replaced.
    apart = upsert(target, source, ["k"], null_safe=False, order=["at"])
    assert rows_of(apart) == sorted(
        [("a", None), ("b", 2), ("c", 5), (None, 3), (None, 7), (None, 8)], key=repr
    )
    total = upsert(target, source.drop("at"), ["k"], "accumulate")
    assert rows_of(total) == sorted([("a", 41), ("b", 2), ("c", 5), (None, 18)], key=repr)


def test_store_refuses_repeated_keys(spark, root):
    store = UpsertStore(root, ["k"])
    store.apply(frame(spark, [("a", 1)]), 0)
    for rows in ([("b", 1), ("b", 2)], [(None, 1), (None, 2)]):
        with pytest.raises(ValueError, match="several rows of one key"):
            store.apply(frame(spark, rows), 1)
    assert rows_of(store.read(spark)) == [("a", 1)]
    loose = UpsertStore(f"{root}/loose", ["k"], null_safe=False)
    loose.apply(frame(spark, [(None, 1), (None, 2)]), 0)
    assert len(rows_of(loose.read(spark))) == 2


@pytest.mark.parametrize("make", [Snapshots, lambda root: UpsertStore(root, ["k"])])
def test_frame_read_before_a_rerun_still_reads(spark, root, make):
    store = make(root)
    save = store.save if isinstance(store, Snapshots) else store.apply
    save(frame(spark, [("a", 1)]), 0)
    before = store.read(spark)
    save(frame(spark, [("a", 1)]), 0)
    save(frame(spark, [("a", 2)]), 1)
    assert rows_of(before) == [("a", 1)]
    assert rows_of(store.read(spark)) == [("a", 2)]


def test_unknown_rule(spark, root):
    with pytest.raises(ValueError):
        upsert(frame(spark, []), frame(spark, []), ["k"], "merge")
    with pytest.raises(ValueError):
        UpsertStore(root, ["k"], "merge")


@pytest.mark.parametrize("rule", ["replace", "accumulate"])
def test_merge_needs_a_format_with_row_level_operations(spark, root, rule):
    with scratch_table(spark) as name:
        frame(spark, TARGET).write.option("path", root).saveAsTable(name)
        with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
            merge_into(name, frame(spark, SOURCE), ["k"], rule)


def test_empty_store(spark, root):
    with pytest.raises(LookupError):
        UpsertStore(root, ["k"]).read(spark)
    with pytest.raises(LookupError):
        Snapshots(root).read(spark)
    store = UpsertStore(root, ["k"])
    store.apply(frame(spark, []), 0)
    with pytest.raises(LookupError):
        store.read(spark)


def expected_state(batches, rule):
    state = {}
    for batch in batches:
        for key, value in batch.items():
            add = rule == "accumulate" and key in state
            state[key] = state[key] + value if add else value
    return sorted(state.items(), key=repr)


batch = st.dictionaries(st.sampled_from(["a", "b", "c", "dd", None]), st.integers(-9, 9), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    batches=st.lists(batch, min_size=1, max_size=7),
    rule=st.sampled_from(["replace", "accumulate"]),
    parted=st.booleans(),
    roll_up_every=st.integers(1, 3),
)
def test_any_batches_with_each_run_twice(spark, batches, rule, parted, roll_up_every):
    part = F.length("k") if parted else None
    store = UpsertStore(
        run_dir(spark, "store"), ["k"], rule, part=part, roll_up_every=roll_up_every
    )
    for i, rows in enumerate(batches):
        for _ in range(2):
            store.apply(frame(spark, list(rows.items())), i)
        if any(batches[: i + 1]):
            expected = expected_state(batches[: i + 1], rule)
            assert rows_of(store.read(spark)) == expected


def test_names_of_folders_are_no_columns(spark, root):
    with pytest.raises(ValueError, match="batch"):
        UpsertStore(root, ["k"]).apply(frame(spark, [("a", 1)], "k string, batch bigint"), 0)


def test_batch_that_failed_half_way_does_not_count(spark, root):
    store = UpsertStore(root, ["k"], "accumulate")
    store.apply(frame(spark, [("a", 1)]), 0)
    store.apply(frame(spark, [("a", 1)]), 1)
    remove(spark, f"{root}/batch=1/attempt=0/_SUCCESS")
    assert rows_of(store.read(spark)) == [("a", 1)]
    store.apply(frame(spark, [("a", 1)]), 1)
    assert rows_of(store.read(spark)) == [("a", 2)]


def test_roll_up_leaves_quiet_parts_alone_and_drops_what_is_folded(spark, root):
    store = UpsertStore(
        root, ["k"], "accumulate", part=F.col("k"), roll_up_every=2, keep_for=0
    )
    for i, key in enumerate(["a", "b", "a", "a", "c", "a", "c"]):
        store.apply(frame(spark, [(key, 1)]), i)
    assert finished(spark, root, "rolled") == [1, 3, 5]
    assert finished(spark, root, "batch") == [4, 5, 6]
    # Part b has had no change since the first roll-up, part a is folded anew by each.
    assert subfolders(spark, f"{root}/rolled=1/attempt=0") == ["part=b"]
    assert sorted(subfolders(spark, f"{root}/rolled=5/attempt=0")) == ["part=a", "part=c"]
    assert rows_of(store.read(spark)) == [("a", 4), ("b", 1), ("c", 2)]
    plan = store.read(spark).where("k = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan


def test_snapshots_keep_the_newest(spark, root):
    result, passing = Snapshots(root), Snapshots(f"{root}/passing", keep_for=0)
    for store in (result, passing):
        for i in range(4):
            store.save(frame(spark, [("a", i)]), i)
        store.save(frame(spark, [("a", 30)]), 3)
        assert rows_of(store.read(spark)) == [("a", 30)]
    # What a slow reader may still hold stays until it has been out of date for ``keep_for``.
    assert finished(spark, root, "batch") == [0, 1, 2, 3]
    assert finished(spark, f"{root}/passing", "batch") == [3]
