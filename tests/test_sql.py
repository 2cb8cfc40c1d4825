"""SQL over the stored results: counts, sums, look-ups and the running report."""

import json

import pytest

from millrace.plans import (
    accumulate_store,
    bronze_invoices,
    invoice_lines_stream,
    rewards_accumulated,
    trade_summary_stream,
    word_count_table,
)
from millrace.queries.inputs import scratch_table
from millrace.schemas import LOG_TABLE
from millrace.sources import table
from millrace.streaming import Snapshots


def write_lines(spark, path, lines, separator="\n"):
    rows = spark.createDataFrame([(line,) for line in lines], "value string")
    rows.coalesce(1).write.option("lineSep", separator).text(path)


def one(spark, query):
    return tuple(spark.sql(query).first())


def test_word_counts(spark, root):
    write_lines(spark, f"{root}/text", ["Sun sea sky. Ash", "sea"], ".")
    with scratch_table(spark) as name:
        word_count_table(spark, f"{root}/text", name, f"{root}/table")
        assert one(spark, f"SELECT sum(count) FROM {name} WHERE substr(word, 1, 1) = 's'") == (4,)
        assert spark.sql(f"SELECT * FROM {name} LIMIT 2").count() == 2


def test_invoices_and_rewards(spark, root):
    item = {"ItemCode": "a", "ItemQty": 1, "ItemPrice": 2.0, "TotalValue": 2.0}
    documents = [
        {"InvoiceNumber": str(i), "CustomerCardNo": f"c{i % 2}", "TotalAmount": 10.0,
         "InvoiceLineItems": [item] * i}
        for i in range(5)
    ]
    landing = f"{root}/landing"
    write_lines(spark, landing, [json.dumps(d) for d in documents])
    store = accumulate_store(f"{root}/rewards")
    with scratch_table(spark) as bronze, scratch_table(spark) as items:
        invoice_lines_stream(
            spark, landing, f"{root}/cp1", items, path=f"{root}/items"
        ).awaitTermination()
        assert one(spark, f"SELECT count(*) FROM {items}") == (10,)
        bronze_invoices(
            spark, landing, f"{root}/cp2", bronze, "batch", path=f"{root}/bronze"
        ).awaitTermination()
        assert one(spark, f"SELECT count(*) FROM {bronze}") == (5,)
        assert one(spark, f"SELECT count(*) FROM {bronze} WHERE InputFile IS NULL") == (0,)
        rewards_accumulated(spark, bronze, store.apply, f"{root}/cp3", "batch").awaitTermination()
    store.as_view(spark, "rewards_now")
    query = "SELECT TotalAmount, TotalPoints FROM rewards_now WHERE CustomerCardNo = 'c0'"
    assert one(spark, query) == (30.0, pytest.approx(0.6))


def test_trade_summary_and_running_report(spark, root):
    values = [("10:05", "BUY", 500), ("10:20", "SELL", 200), ("10:40", "BUY", 100)]
    result = Snapshots(f"{root}/summary")
    with scratch_table(spark) as log:
        spark.createDataFrame([], LOG_TABLE).write.option("path", f"{root}/log").saveAsTable(log)
        for time, kind, amount in values:
            payload = json.dumps(
                {"CreatedTime": f"2019-02-05 {time}:00", "Type": kind, "Amount": amount}
            )
            spark.sql(f"INSERT INTO {log} VALUES ('k', '{payload}')")
        trade_summary_stream(
            table(spark, log, stream=True), result.save, f"{root}/cp", "batch"
        ).awaitTermination()
    result.as_view(spark, "summary_now")
    found = one(
        spark,
        """SELECT TotalBuy, TotalSell FROM summary_now
           WHERE date_format(`end`, 'yyyy-MM-dd HH:mm:ss') = '2019-02-05 10:30:00'""",
    )
    assert found == (0, 200)
    report = spark.sql(
        """SELECT date_format(`end`, 'HH:mm') AS clock,
                  sum(TotalBuy) OVER (ORDER BY `end`) AS bought,
                  sum(TotalSell) OVER (ORDER BY `end`) AS sold,
                  bought - sold AS net
           FROM summary_now ORDER BY clock"""
    )
    assert [tuple(r) for r in report.collect()] == [
        ("10:15", 500, 0, 500),
        ("10:30", 500, 200, 300),
        ("10:45", 600, 200, 400),
    ]
