"""Three ways to keep reward totals, and what restarts and replays do to them."""

import json
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators import as_double, rewards
from millrace.plans import (
    accumulate_store,
    bronze_invoices,
    rewards_accumulated,
    rewards_complete,
    rewards_store,
    rewards_updated,
)
from millrace.queries.inputs import scratch_table
from millrace.session import (
    ROCKSDB_PROVIDER,
    SHUFFLE_PARTITIONS_CONF,
    STATE_PROVIDER_CONF,
    rocksdb_state,
    setting,
    shared_dir,
    state_partitions,
)
from millrace.streaming import Snapshots, changed_groups, complete, state_operators

FILES = [
    [("c1", 100.0), ("c2", 50.5), (None, 10.0)],
    [("c1", 0.1), ("c3", 7.0)],
    [("c1", 0.2), (None, 2.0), ("c2", None)],
]
TOTALS = {"c1": 100.3, "c2": 50.5, "c3": 7.0, None: 12.0}


def land(spark, path, invoices):
    documents = [
        json.dumps({"CustomerCardNo": card, "TotalAmount": amount}) for card, amount in invoices
    ]
    rows = spark.createDataFrame([(d,) for d in documents], "value string")
    rows.coalesce(1).write.mode("append").text(path)


def totals(df):
    rows = df.collect()
    assert len(rows) == len({r.CustomerCardNo for r in rows})
    for r in rows:
        assert float(r.TotalPoints) == pytest.approx(float(r.TotalAmount) * 0.02)
    return {r.CustomerCardNo: float(r.TotalAmount) for r in rows}


def test_rewards_of_a_frame(spark):
    df = spark.createDataFrame(sum(FILES, []), "CustomerCardNo string, TotalAmount double")
    found = rewards(df)
    assert dict(found.dtypes)["TotalAmount"] == dict(found.dtypes)["TotalPoints"] == "double"
    assert totals(found) == pytest.approx(TOTALS)
    exact = rewards(df, exact=True)
    assert dict(exact.dtypes)["TotalAmount"] == "decimal(38,6)"
    assert totals(as_double(exact)) == TOTALS


def test_exact_money_is_not_cut_to_cents(spark):
    df = spark.createDataFrame(
        [("a", 0.001)] * 1000 + [("b", 2e16), ("b", 0.5)], "CustomerCardNo string, TotalAmount double"
    )
    found = {r.CustomerCardNo: r.TotalAmount for r in rewards(df, exact=True).collect()}
    assert found == {"a": 1, "b": Decimal("20000000000000000.5")}


def test_rate_is_the_callers(spark):
    df = spark.createDataFrame([("a", 10.0)], "card string, paid double")
    assert rewards(df, "card", "paid", rate="0.5").first().TotalPoints == 5.0


@pytest.mark.parametrize("max_files", [None, 1])
def test_three_strategies_same_totals(spark, root, max_files):
    complete = Snapshots(f"{root}/complete")
    updated = rewards_store(f"{root}/updated", roll_up_every=2)
    added = accumulate_store(f"{root}/added", roll_up_every=2)
    landing = f"{root}/landing"
    with scratch_table(spark) as bronze:
        for file in FILES:
            land(spark, landing, file)
            bronze_invoices(
                spark, landing, f"{root}/cp0", bronze, "batch", path=f"{root}/bronze"
            ).awaitTermination()
            if max_files is None:
                continue
            # With every file: each query stops and starts again from its checkpoint.
            run_all(spark, root, bronze, complete, updated, added, max_files)
        run_all(spark, root, bronze, complete, updated, added, max_files)
    for result in (complete, updated, added):
        assert totals(result.read(spark)) == TOTALS


def run_all(spark, root, bronze, complete, updated, added, max_files):
    limits = {"trigger": "batch", "max_files": max_files, "exact": True}
    rewards_complete(spark, bronze, complete.save, f"{root}/cp1", **limits).awaitTermination()
    with rocksdb_state(spark):
        rewards_updated(spark, bronze, updated.apply, f"{root}/cp2", **limits).awaitTermination()
    rewards_accumulated(spark, bronze, added.apply, f"{root}/cp3", **limits).awaitTermination()


def test_both_stages_run_at_the_same_time(spark, root):
    result, landing = Snapshots(f"{root}/complete"), f"{root}/landing"
    land(spark, landing, FILES[0])
    with scratch_table(spark) as name:
        bronze = bronze_invoices(spark, landing, f"{root}/cp0", name, path=f"{root}/bronze")
        gold = None
        try:
            bronze.processAllAvailable()
            gold = rewards_complete(spark, name, result.save, f"{root}/cp1", exact=True)
            for file in FILES[1:]:
                land(spark, landing, file)
                bronze.processAllAvailable()
                gold.processAllAvailable()
        finally:
            for query in (bronze, gold):
                if query:
                    query.stop()
    assert totals(result.read(spark)) == TOTALS


def test_batch_that_is_run_again_is_not_added_twice(spark, root):
    store, landing = accumulate_store(f"{root}/added"), f"{root}/landing"
    failures = [RuntimeError("lost after the batch was written")]

    def apply_and_fail(df, batch_id):
        store.apply(df, batch_id)
        if batch_id == 1 and failures:
            raise failures.pop()

    with scratch_table(spark) as name:
        for file in FILES:
            land(spark, landing, file)
            bronze_invoices(
                spark, landing, f"{root}/cp0", name, "batch", path=f"{root}/bronze"
            ).awaitTermination()
        for attempt in range(2):
            query = rewards_accumulated(
                spark, name, apply_and_fail, f"{root}/cp1", "batch", 1, exact=True
            )
            if attempt == 0:
                with pytest.raises(Exception, match="lost after the batch"):
                    query.awaitTermination()
            else:
                query.awaitTermination()
    assert not failures
    assert totals(store.read(spark)) == TOTALS


@pytest.mark.parametrize("complete", [True, False])
def test_result_belongs_to_one_checkpoint(spark, root, complete):
    landing = f"{root}/landing"
    snapshots, store = Snapshots(f"{root}/complete"), accumulate_store(f"{root}/added")

    def run(bronze, checkpoint):
        limits = {"trigger": "batch", "exact": True}
        if complete:
            return rewards_complete(spark, bronze, snapshots.save, checkpoint, **limits)
        return rewards_accumulated(spark, bronze, store.apply, checkpoint, **limits)

    with scratch_table(spark) as name:
        for file in FILES:
            land(spark, landing, file)
            bronze_invoices(
                spark, landing, f"{root}/cp0", name, "batch", path=f"{root}/bronze"
            ).awaitTermination()
            run(name, f"{root}/cp1").awaitTermination()
        with pytest.raises(StreamingQueryException, match="another query or checkpoint"):
            run(name, f"{root}/cp2").awaitTermination()
    assert totals((snapshots if complete else store).read(spark)) == TOTALS


def test_update_mode_hands_over_only_changed_groups(spark, root):
    seen, landing = [], f"{root}/landing"

    def note(df, batch_id):
        seen.append({r.CustomerCardNo for r in df.collect()})

    with scratch_table(spark) as name:
        for file in FILES:
            land(spark, landing, file)
            bronze_invoices(
                spark, landing, f"{root}/cp0", name, "batch", path=f"{root}/bronze"
            ).awaitTermination()
            rewards_updated(spark, name, note, f"{root}/cp1", "batch").awaitTermination()
    assert [s for s in seen if s] == [{"c1", "c2", None}, {"c1", "c3"}, {"c1", "c2", None}]


def test_rocksdb_state_is_set_inside_the_block_only(spark):
    before = spark.conf.get(STATE_PROVIDER_CONF, None)
    with rocksdb_state(spark):
        assert spark.conf.get(STATE_PROVIDER_CONF) == ROCKSDB_PROVIDER
    assert spark.conf.get(STATE_PROVIDER_CONF, None) == before


def test_state_partitions_are_the_callers(spark, root):
    spark.createDataFrame([("a", 1.0)], "CustomerCardNo string, TotalAmount double").write.parquet(
        f"{root}/in"
    )
    rows = spark.readStream.schema("CustomerCardNo string, TotalAmount double").parquet(f"{root}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 3):
        complete(
            rewards(rows), Snapshots(f"{root}/out").save, f"{root}/cp", "batch"
        ).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    (operator,) = state_operators(spark, f"{root}/cp").collect()
    assert operator.numPartitions == 3 and operator.operatorName == "stateStoreSave"


def test_running_query_keeps_its_settings(spark, root):
    land(spark, f"{root}/landing", FILES[0])
    rows = spark.readStream.schema("CustomerCardNo string, TotalAmount double").json(
        f"{root}/landing"
    )
    with rocksdb_state(spark), setting(spark, SHUFFLE_PARTITIONS_CONF, "2"):
        query = changed_groups(rewards(rows), lambda df, i: df.count(), f"{root}/cp", "batch")
    query.awaitTermination()
    state = query.lastProgress.stateOperators[0]
    assert state.numShufflePartitions == 2
    assert any(name.startswith("rocksdb") for name in state.customMetrics)


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    assert folder == (named.rstrip("/") if named else folder)
    assert shared_dir(spark) == folder


def test_customer_with_a_third_of_all_invoices(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
            "CustomerCardNo"
        ),
        F.lit(1.0).alias("TotalAmount"),
    )
    totals = rewards(df, exact=True)
    assert totals.where("CustomerCardNo = 'hot'").first().TotalAmount == 10_000
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_sum")
