"""The inputs derived from the test tables keep all of their rows."""

from pyspark.sql import functions as F

from millrace.operators import nested, nesting
from millrace.operators.nesting import PAGE_ROWS
from millrace.queries import QUERIES
from millrace.queries.inputs import nested_invoices, time_waves


def test_waves_keep_events_without_a_time(spark):
    rows = [(1, None), (2, "2024-01-01 00:00:00"), (3, "2024-01-02 00:00:00"), (4, None)]
    events = spark.createDataFrame(rows, "event_id long, ts string")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for frame in (events, events.where("ts is null")):
        waves = time_waves(frame, 3)
        ids = [r["event_id"] for wave in waves for r in wave.collect()]
        assert len(waves) == 3 and sorted(ids) == sorted(r["event_id"] for r in frame.collect())


def test_only_long_orders_are_paged(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(2).cache()
    short, long = [r["o_orderkey"] for r in orders.collect()]
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1)
    n = 3 * PAGE_ROWS
    many = lines.crossJoin(spark.range(n, numPartitions=4)).drop("l_orderkey")
    key = F.when(F.col("id") % 5000 == 0, short).otherwise(long).alias("l_orderkey")
    found = nested_invoices(orders, many.select(key, *many.columns))
    sizes = found.where("size(InvoiceLineItems) > 0").select("InvoiceNumber", F.size("InvoiceLineItems"))
    sizes = [tuple(r) for r in sizes.collect()]
    assert [s for k, s in sizes if k == str(short)] == [5]
    pages = [s for k, s in sizes if k == str(long)]
    assert sum(pages) == n - 5 and len(pages) > 1 and max(pages) <= PAGE_ROWS


def test_lines_of_a_hot_order_are_dealt_before_they_are_shuffled(spark, root):
    headers = spark.range(10).select(F.col("id").alias("k"), F.lit("h").alias("name"))
    key = F.when(F.col("id") % 3 == 0, 3).when(F.col("id") % 50 > 0, F.col("id") % 10 + 2)
    rows = spark.range(30_000).select(key.cast("bigint").alias("k"), (F.col("id") % 2).alias("v"))
    rows.repartition(6).write.parquet(f"{root}/rows")
    stored = spark.read.parquet(f"{root}/rows")
    found = nested(headers, stored, "k", F.col("v"), page_rows=1000)
    assert found.columns == ["k", "name", "page", "items"]
    documents = found.select("k", "page", F.size("items").alias("n")).collect()
    counts = {r["k"]: r["n"] for r in stored.groupBy("k").agg(F.count("*").alias("n")).collect()}
    for k in range(10):
        mine = sorted((r.page, r.n) for r in documents if r.k == k)
        assert sum(n for _, n in mine) == counts.get(k, 0)
        assert [page for page, _ in mine] == list(range(1, len(mine) + 1))
        assert all(n <= 1000 for _, n in mine)
        if k in counts:
            assert len(mine) == (1 if counts[k] <= 1000 else -(-counts[k] // 500))
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("k#" in line and "page#" in line for line in dealt)
    assert not any("collect_list" in line and "keys=[k#" in line and "page" not in line
                   for line in plan.splitlines())


def test_very_many_long_keys_are_not_broadcast(spark, root, monkeypatch):
    headers = spark.range(40).select(F.col("id").alias("k"))
    rows = spark.range(8000).select((F.col("id") % 40).alias("k"), "id")
    rows.write.parquet(f"{root}/rows")
    stored = spark.read.parquet(f"{root}/rows")
    monkeypatch.setattr(nesting, "BROADCAST_KEYS", 10)
    found = nested(headers, stored, "k", F.col("id"), page_rows=100)
    assert found.agg(F.sum(F.size("items"))).first()[0] == 8000
    assert found.select("k", F.explode("items")).distinct().count() == 8000
    assert found.groupBy("k").count().where("count != 4").isEmpty()


def test_queries_leave_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        log = QUERIES["log_parse"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
        late = log.where("CreatedTime <> date_format(timestamp, 'yyyy-MM-dd HH:mm:ss')")
        assert log.count() > 0 and late.count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
