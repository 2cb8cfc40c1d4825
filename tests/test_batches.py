"""Streams over the test tables drain in few batches, however much there is to read."""

from glob import glob

from pyspark.sql import functions as F

from millrace.queries import streams
from millrace.queries.inputs import load, nested_invoices
from millrace.session import SHUFFLE_PARTITIONS_CONF
from millrace.streaming import Snapshots, UpsertStore

SMALL = "/root/testdata/sf0.001"


def batches_of(monkeypatch, store, method):
    seen, kept = set(), getattr(store, method)

    def counted(self, df, batch_id):
        seen.add(batch_id)
        kept(self, df, batch_id)

    monkeypatch.setattr(store, method, counted)
    return seen


def test_complete_mode_writes_its_result_few_times(spark, monkeypatch):
    monkeypatch.setattr(streams, "PARQUET_BYTES", 1)
    seen = batches_of(monkeypatch, Snapshots, "save")
    streams.stream_sensor_sliding(spark, SMALL).count()
    assert 1 < len(seen) <= 2 * streams.BATCHES + 1


def test_rewards_are_upserted_in_few_batches(spark, root, monkeypatch):
    orders = load(spark, SMALL, "orders").limit(60)
    years = (F.col("o_orderkey") % 40 + 1980).cast("string")
    orders = orders.withColumn("o_orderdate", F.to_timestamp(years, "yyyy"))
    orders.write.parquet(f"{root}/orders.parquet")
    for name in ("TEXT_BYTES", "PARQUET_BYTES"):
        monkeypatch.setattr(streams, name, 1)
    total = orders.agg(F.sum("o_totalprice")).first()[0]
    seen = batches_of(monkeypatch, UpsertStore, "apply")
    for query in (streams.stream_rewards_update, streams.stream_rewards_accumulate):
        found = query(spark, root).agg(F.sum("TotalAmount")).first()[0]
        assert abs(found - total) < 0.01
        assert 1 < len(seen) <= 2 * streams.BATCHES + 1
        seen.clear()


def test_state_partitions_follow_the_input(spark, root, monkeypatch):
    spark.range(1000).repartition(4).write.parquet(f"{root}/rows")
    before = spark.conf.get(SHUFFLE_PARTITIONS_CONF)
    cores = spark.sparkContext.defaultParallelism
    try:
        spark.conf.set(SHUFFLE_PARTITIONS_CONF, str(cores + 5))
        for size, expected in ((streams.STATE_BYTES, cores), (1, cores + 5)):
            monkeypatch.setattr(streams, "STATE_BYTES", size)
            with streams.fitting_state(spark, f"{root}/rows"):
                assert int(spark.conf.get(SHUFFLE_PARTITIONS_CONF)) == expected
            assert spark.conf.get(SHUFFLE_PARTITIONS_CONF) == str(cores + 5)
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS_CONF, before)


def test_landed_invoices_are_compressed_and_whole(spark, root):
    path = streams.landed_invoices(spark, SMALL, root)
    files = glob(f"{path.removeprefix('file:')}/year=*/part-*")
    assert files and all(name.endswith(".json.gz") for name in files)
    invoices = nested_invoices(load(spark, SMALL, "orders"), load(spark, SMALL, "lineitem"))
    lines = F.sum(F.size("InvoiceLineItems"))
    expected = invoices.agg(F.count("*"), lines).first()
    assert spark.read.json(path).agg(F.count("*"), lines).first() == expected


def test_interval_trigger_drains_compressed_files(spark, root, monkeypatch):
    monkeypatch.setattr(streams, "run_dir", lambda spark, label: f"{root}/{label}")
    found = streams.stream_interval_trigger(spark, SMALL)
    assert found.count() == load(spark, SMALL, "lineitem").count()
    landed = f"{root.removeprefix('file:')}/running_invoice_lines/landing"
    files = glob(f"{landed}/year=*/part-*")
    assert files and all(name.endswith(".json.gz") for name in files)
