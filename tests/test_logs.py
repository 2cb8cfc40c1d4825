from datetime import datetime
from functools import reduce

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import (
    checked_log,
    decode_log,
    distinct_records,
    latest_per_key,
    sensor_readings,
    split_malformed,
    trades,
)
from millrace.plans import idempotent_store, ingest_checked, ingest_idempotent, ingest_log
from millrace.queries.inputs import scratch_table
from millrace.schemas import LOG_ENVELOPE
from millrace.sources import (
    csv_rows,
    envelope_files,
    from_timestamp,
    json_inferred,
    kafka_log,
    kafka_options,
)

PAYLOAD = "a string, b double"


def at(minute, day=1):
    return datetime(2024, 1, day, 10, minute)


def log_of(spark, records):
    """Records of (key, value, offset, time)."""
    rows = [
        (k.encode() if k else None, v.encode() if v else None, "t", 0, o, time, 0)
        for k, v, o, time in records
    ]
    return spark.createDataFrame(rows, LOG_ENVELOPE)


def test_decode(spark):
    values = ['{"a":"x","b":1}', "{bad", '{"b":"abc","z":1}', '{"b":500}', None]
    log = log_of(spark, [("k", v, i, at(i)) for i, v in enumerate(values)])
    rows = decode_log(log, PAYLOAD).orderBy("timestamp").collect()
    assert [r.value and tuple(r.value) for r in rows] == [
        ("x", 1.0),
        (None, None),
        (None, None),
        (None, 500.0),
        None,
    ]
    assert {(r.key, r.topic) for r in rows} == {("k", "t")}


GOOD = {'{"b":1}': (None, 1.0), '{"a":"x","b":2.5,"z":[1]}': ("x", 2.5), '{"b":null}': (None, None)}
BAD = {
    "{bad": (None, None),
    '{"a":"x","b":"abc"}': ("x", None),
    '{"a":"x","b":{}}': ("x", None),
    '{"a":"x"': ("x", None),
    "[1]": (None, None),
    "7": (None, None),
    " ": None,
}


def test_malformed_records_can_be_set_apart(spark):
    values = [*GOOD, *BAD, None]
    log = log_of(spark, [("k", v, i, at(i)) for i, v in enumerate(values)])
    empty = log.where("offset = 0").withColumn("value", F.lit("").cast("binary"))
    log = log.unionByName(empty.withColumn("offset", F.lit(99).cast("bigint")))
    checked = checked_log(log, PAYLOAD, keep=["offset"])
    assert checked.columns == ["key", "value", "topic", "timestamp", "offset", "malformed"]
    found = {r.offset: (r.value and tuple(r.value), r.malformed) for r in checked.collect()}
    for i, v in enumerate(values):
        if v in GOOD:
            assert found[i] == (GOOD[v], None)
        elif v is None:  # no payload is no malformed one
            assert found[i] == (None, None)
        else:
            assert found[i][1] == v
            if v != '{"a":"x"':  # how much of a cut text is read is the parser's business
                assert found[i][0] == BAD[v]
    assert found[99] == (None, "")
    good, bad = split_malformed(log, PAYLOAD)
    assert good.columns == ["key", "value", "topic", "timestamp"]
    assert good.count() == len(GOOD) + 1
    assert {r.value for r in bad.collect()} == {*BAD, ""}


def test_malformed_records_take_one_parse(spark, root):
    log_of(spark, [("k", '{"a":"x","b":"abc"}', 0, at(0))]).write.parquet(root)
    checked = checked_log(spark.read.parquet(root), PAYLOAD)
    for frame in (
        checked,
        checked.where("malformed is not null").select("topic"),
        checked.where("value.b > 1 and malformed is null").select("value.a"),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
    # Nothing narrows the schema, or the value of the wrong type would go unnoticed.
    assert checked.where("malformed is not null").select("topic").count() == 1


def test_schema_may_have_a_field_named_like_the_mark(spark):
    log = log_of(spark, [("k", '{"_bad":"x"}', 0, at(0)), ("k", "{", 1, at(1))])
    rows = checked_log(log, "_bad string").orderBy("timestamp").collect()
    assert [(r.value[0], r.malformed) for r in rows] == [("x", None), (None, "{")]


def test_checked_ingest_keeps_both_sides(spark, root):
    values = [*GOOD, *BAD, None]
    log_of(spark, [("k", v, i, at(i)) for i, v in enumerate(values)]).write.parquet(f"{root}/log")
    stream = envelope_files(spark, f"{root}/log", stream=True)
    with scratch_table(spark) as name:
        query = ingest_checked(
            stream, f"{root}/cp", name, PAYLOAD, "batch", f"{root}/sides", name="sides"
        )
        assert query.name == "sides"
        query.awaitTermination()
    sides = spark.read.parquet(f"{root}/sides")
    assert {r.malformed for r in sides.where("side = 'bad'").collect()} == set(BAD)
    assert sides.where("side = 'good'").count() == len(GOOD) + 1
    plan = sides.where("side = 'bad'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan


def test_trades(spark):
    values = [
        '{"CreatedTime":"2019-02-05 10:05:00","Type":"BUY","Amount":500,"BrokerCode":"ABX"}',
        '{"CreatedTime":"2019-02-05 10:06:00","Type":"SELL","Amount":2.5,"BrokerCode":"ABX"}',
        '{"CreatedTime":"05.02.2019","Type":"BUY"}',
        '{"Amount":1}',
        "{bad",
        None,
    ]
    log = spark.createDataFrame([("k", v) for v in values], "key string, value string")
    rows = trades(log).collect()
    assert [(r.Buy, r.Sell) for r in rows] == [(500, 0), (0, 2.5), (None, 0), (0, 0), (0, 0), (0, 0)]
    assert [r.CreatedTime for r in rows] == [
        datetime(2019, 2, 5, 10, 5),
        datetime(2019, 2, 5, 10, 6),
        *[None] * 4,
    ]


def test_sensor_readings(spark):
    log = log_of(spark, [("S1", '{"CreatedTime":"2019-02-05 09:54:00","Reading":36.2}', 0, at(0))])
    row = sensor_readings(log).first()
    assert tuple(row) == ("S1", datetime(2019, 2, 5, 9, 54), 36.2)


def test_latest_per_key(spark):
    rows = [(1, None, "a", 5), (1, None, "b", 7), (1, 2, "c", 1), (None, 2, "d", 3), (1, 2, None, 9)]
    df = spark.createDataFrame(rows, "k int, j int, v string, o int")
    latest = latest_per_key(df, ["k", "j"], ["o"])
    assert latest.columns == df.columns
    assert {tuple(r) for r in latest.collect()} == {
        (1, None, "b", 7),
        (None, 2, "d", 3),
        (1, 2, None, 9),
    }
    keys = df.select("k")
    assert latest_per_key(keys, ["k"], ["k"]).count() == 2


def test_copies_fold_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, o int, v int")
    plan = latest_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max_by")


def test_distinct_records_keep_the_highest_offset(spark):
    v, w = '{"a":"x"}', '{"a":"y"}'
    log = log_of(
        spark, [("old", v, 1, at(0)), ("new", v, 5, at(0)), ("mid", v, 3, at(0)), ("k", v, 2, at(1)),
                ("k", w, 4, at(0))]
    )
    rows = distinct_records(log, PAYLOAD)
    assert rows.columns == ["key", "value", "topic", "timestamp", "fingerprint"]
    found = {(r.key, r.value.a, r.timestamp) for r in rows.collect()}
    assert found == {("new", "x", at(0)), ("k", "x", at(1)), ("k", "y", at(0))}


def test_records_differ_if_their_bytes_do(spark):
    # All of these decode to the same struct, but for the null.
    values = ['{"z":1}', '{"z":2}', '{"z": 2}', "{bad", "{worse", None]
    log = log_of(spark, [("k", v, i, at(0)) for i, v in enumerate(values)])
    again = log.withColumn("offset", F.col("offset") + 100).withColumn("key", F.lit(b"late"))
    found = distinct_records(log.unionByName(again).unionByName(log), PAYLOAD).collect()
    assert len(found) == len(values) == len({r.fingerprint for r in found})
    assert {r.key for r in found} == {"late"}
    assert {r.fingerprint and len(r.fingerprint) for r in found} == {32, None}


def test_rows_with_equal_places(spark):
    log = log_of(spark, [("k", "v", 1, at(0))])
    copies = [
        log,
        log,
        log.withColumn("partition", F.lit(3)).withColumn("key", F.lit(b"p3")),
        log.withColumn("offset", F.lit(None).cast("bigint")),
        log.withColumn("topic", F.lit(None).cast("string")),
    ]
    union = reduce(DataFrame.unionByName, copies)
    assert [r.key for r in distinct_records(union, PAYLOAD).collect()] == ["p3"]


def test_whole_records_are_shuffled_once_and_never_sorted(spark, root):
    log_of(spark, [("k", "v", 1, at(0))]).write.parquet(root)
    found = distinct_records(spark.read.parquet(root), PAYLOAD)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan and "SortMergeJoin" not in plan
    initial = plan[plan.index("Initial Plan") :]
    assert "ShuffledHashJoin" in initial
    dealt = [line for line in initial.splitlines() if "Exchange" in line]
    assert len(dealt) == 3 and sum("REPARTITION_BY_COL" in line for line in dealt) == 1


def test_start_position_is_inclusive_and_pushed_down(spark, root):
    log_of(spark, [("k", '{"a":"x"}', i, at(i)) for i in range(4)]).write.parquet(root)
    start = int(at(2).timestamp() * 1000)
    log = envelope_files(spark, root, start_ms=start)
    assert sorted(r.offset for r in log.collect()) == [2, 3]
    assert sorted(r.offset for r in from_timestamp(log, start).collect()) == [2, 3]
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan


def test_records_per_batch_are_bounded(spark, root):
    log = log_of(spark, [("k", '{"a":"x"}', i, at(i)) for i in range(25)]).coalesce(1)
    log.write.option("maxRecordsPerFile", 10).parquet(f"{root}/log")
    stream = envelope_files(spark, f"{root}/log", stream=True, max_files=1)
    with scratch_table(spark) as name:
        query = ingest_log(stream, f"{root}/cp", name, PAYLOAD, "batch", f"{root}/bronze")
        query.awaitTermination()
    counts = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert max(counts) <= 10 and sum(counts) == 25
    assert spark.read.parquet(f"{root}/bronze").count() == 25


def test_plain_ingest_keeps_copies_and_idempotent_ingest_does_not(spark, root):
    store = idempotent_store(f"{root}/kept", roll_up_every=2)
    records = [("k", f'{{"a":"{i}"}}', i, at(i, day=1 + i)) for i in range(3)]
    deliveries = [records[:2], records[1:], records[:1], records]
    with scratch_table(spark) as name:
        for number, part in enumerate(deliveries):
            sent = [(f"d{number}", v, o + 10 * number, t) for _, v, o, t in part]
            log_of(spark, sent).coalesce(1).write.mode("append").parquet(f"{root}/log")
            stream = envelope_files(spark, f"{root}/log", stream=True)
            ingest_log(
                stream, f"{root}/cp1", name, PAYLOAD, "batch", f"{root}/bronze"
            ).awaitTermination()
            ingest_idempotent(
                stream, store.apply, f"{root}/cp2", PAYLOAD, "batch"
            ).awaitTermination()
            if number == 2:
                kept = {(r.key, r.value.a) for r in store.read(spark).collect()}
                assert kept == {("d2", "0"), ("d1", "1"), ("d1", "2")}
    assert spark.read.parquet(f"{root}/bronze").count() == 8
    rows = store.read(spark).collect()
    assert sorted((r.key, r.value.a) for r in rows) == [("d3", "0"), ("d3", "1"), ("d3", "2")]


def test_position_past_the_end(spark, root):
    log_of(spark, [("k", "v", i, at(i)) for i in range(4)]).write.parquet(f"{root}/log")
    later = int(at(30).timestamp() * 1000)
    with pytest.raises(ValueError, match="at or after"):
        envelope_files(spark, f"{root}/log", start_ms=later)
    assert envelope_files(spark, f"{root}/log", start_ms=later, past_end="latest").count() == 0
    stream = envelope_files(spark, f"{root}/log", True, later, past_end="latest")
    # What comes after the start is handed over whatever its time, as from a topic's end.
    other = log_of(spark, [("p", "v", 0, at(0))]).withColumn("partition", F.lit(1))
    new = log_of(spark, [("n", "v", 4, at(5)), ("n", "v", 5, at(40))]).unionByName(other)
    new.write.mode("append").parquet(f"{root}/log")
    with scratch_table(spark) as name:
        ingest_log(
            stream, f"{root}/cp", name, PAYLOAD, "batch", f"{root}/bronze"
        ).awaitTermination()
    assert sorted(r.key for r in spark.read.parquet(f"{root}/bronze").collect()) == ["n", "n", "p"]
    empty = log_of(spark, []).write.parquet(f"{root}/empty")
    assert envelope_files(spark, f"{root}/empty", start_ms=0, past_end="latest").count() == 0
    with pytest.raises(ValueError, match="past_end"):
        envelope_files(spark, f"{root}/log", start_ms=0, past_end="earliest")


def test_new_stream_starts_at_the_beginning(spark, root):
    log_of(spark, [("k", "v", i, at(i)) for i in range(4)]).write.parquet(f"{root}/log")
    with scratch_table(spark) as one, scratch_table(spark) as two:
        queries = [  # under names of their own two ingests run in one session
            ingest_log(
                envelope_files(spark, f"{root}/log", stream=True),
                f"{root}/cp-{name}", name, PAYLOAD, None, f"{root}/{name}", name, fmt,
            )
            for name, fmt in ((one, "parquet"), (two, "orc"))
        ]
        for query in queries:
            query.processAllAvailable()
            query.stop()
        assert [query.name for query in queries] == [one, two]
        assert spark.read.parquet(f"{root}/{one}").count() == 4
        assert spark.read.orc(f"{root}/{two}").count() == 4


@pytest.mark.parametrize("copies", [1, 2])
def test_bytes_per_batch_bound_the_batches(spark, root, copies):
    for i in range(4 * copies):
        log_of(spark, [("k", "v", i, at(0))]).coalesce(1).write.mode("append").parquet(f"{root}/log")
    files = spark.read.format("binaryFile").load(f"{root}/log").agg(F.max("length")).first()[0]
    stream = envelope_files(spark, f"{root}/log", stream=True, max_bytes=2 * files)
    with scratch_table(spark) as name:
        query = ingest_log(stream, f"{root}/cp", name, PAYLOAD, "batch", f"{root}/bronze")
        query.awaitTermination()
    # Twice the input makes twice the batches.
    rows = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert rows == [2] * (2 * copies)


def test_a_batch_is_bounded_one_way(spark, root):
    with pytest.raises(ValueError, match="not by both"):
        envelope_files(spark, root, stream=True, max_files=1, max_bytes=1)


def test_kafka_options():
    assert kafka_options("h:9092", "invoices") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "invoices",
        "startingOffsets": "earliest",
    }
    options = kafka_options("h:9092", "invoices", 1, 10, "me", "pw")
    assert options["startingTimestamp"] == "1"
    assert options["startingOffsetsByTimestampStrategy"] == "error"
    assert "startingOffsets" not in options
    late = kafka_options("h:9092", "invoices", 1, past_end="latest")
    assert late["startingOffsetsByTimestampStrategy"] == "latest"
    with pytest.raises(ValueError, match="past_end"):
        kafka_options("h:9092", "invoices", 1, past_end="earliest")
    assert options["maxOffsetsPerTrigger"] == "10"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"].endswith(
        'PlainLoginModule required username="me" password="pw";'
    )


def test_kafka_login():
    odd = kafka_options("h:9092", "t", user='m"e', secret='p\\w";x="')
    assert odd["kafka.sasl.jaas.config"].endswith(
        r'''required username="m\"e" password="p\\w\";x=\"";'''
    )
    for login in ({"user": "me"}, {"secret": "pw"}, {"user": "me", "secret": "p\nw"}):
        with pytest.raises(ValueError):
            kafka_options("h:9092", "t", **login)


@pytest.mark.parametrize("stream", [False, True])
def test_kafka_needs_its_connector(spark, stream):
    # Without the connector Spark must at least have been asked for the right source.
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_log(spark, kafka_options("h:9092", "invoices"), stream)


def test_json_and_csv_sources(spark, root):
    rows = spark.createDataFrame([(1, "x", 2.5), (2, None, None)], "id bigint, s string, d double")
    rows.write.json(f"{root}/json")
    inferred = json_inferred(spark, f"{root}/json")
    assert dict(inferred.dtypes) == {"id": "bigint", "s": "string", "d": "double"}
    rows.write.option("header", True).csv(f"{root}/csv")
    assert {t for _, t in csv_rows(spark, f"{root}/csv").dtypes} == {"string"}
    typed = csv_rows(spark, f"{root}/csv", rows.schema)
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, rows.collect()))
    assert inferred.select(F.sum("d")).first()[0] == 2.5


def test_inferred_json_is_read_and_parsed_once(spark, root):
    lines = [
        '{"id":1,"s":"x","d":2.5,"none":null,"o":{"a":1,"b c":"q"},"xs":[1,2],"mixed":1,"it\'s":4}',
        '{"id":2,"s":null,"d":3,"none":null,"o":{"a":2.25},"xs":[],"mixed":"t","VOID":true}',
        "bad",
        "[1]",
    ]
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(f"{root}/json")
    found = json_inferred(spark, f"{root}/json")
    expected = spark.read.json(f"{root}/json").drop("_corrupt_record")
    assert dict(found.dtypes) == dict(expected.dtypes)
    columns = sorted(found.columns)
    rows = found.select(*[f"`{c}`" for c in columns]).where("id is not null").orderBy("id")
    same = expected.select(*[f"`{c}`" for c in columns]).where("id is not null").orderBy("id")
    assert rows.collect() == same.collect()
    assert found.where("id is null").count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"{root}/json" not in plan and "variants-" in plan
    sampled = json_inferred(spark, f"{root}/json", sampling=0.99)
    assert set(sampled.columns) <= set(found.columns)
    spark.createDataFrame([], "value string").write.text(f"{root}/none")
    assert json_inferred(spark, f"{root}/none").columns == []
