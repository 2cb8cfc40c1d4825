import json

from pyspark.sql import functions as F

from millrace.operators import line_items
from millrace.plans import bronze_invoices, invoice_lines_stream
from millrace.queries.inputs import nested_invoices, scratch_table
from millrace.queries.streams import LINE_COLUMNS
from millrace.sources import invoices, with_input_file


def item(code, qty):
    return {"ItemCode": code, "ItemDescription": code, "ItemPrice": 2.5, "ItemQty": qty,
            "TotalValue": 2.5 * qty}


def land(spark, path, documents):
    rows = spark.createDataFrame([(json.dumps(d),) for d in documents], "value string")
    rows.coalesce(1).write.mode("append").text(path)


DOCUMENTS = [
    {"InvoiceNumber": "1", "CreatedTime": 10, "CustomerCardNo": "c", "TotalAmount": 7.5,
     "DeliveryAddress": {"City": "Pune", "State": "MH", "PinCode": "411001"},
     "InvoiceLineItems": [item("a", 1), item("b", 2)]},
    {"InvoiceNumber": "2", "InvoiceLineItems": []},
    {"InvoiceNumber": "3"},
    {"InvoiceNumber": "4", "InvoiceLineItems": [item("c", 3)]},
]


def test_line_items(spark, root):
    land(spark, root, DOCUMENTS)
    flat = line_items(invoices(spark, root))
    assert flat.columns == LINE_COLUMNS
    rows = {(r.InvoiceNumber, r.ItemCode): r for r in flat.collect()}
    # No rows for an empty or a missing array.
    assert set(rows) == {("1", "a"), ("1", "b"), ("4", "c")}
    row = rows["1", "b"]
    assert (row.CreatedTime, row.City, row.State, row.PinCode) == (10, "Pune", "MH", "411001")
    assert (row.ItemPrice, row.ItemQty, row.TotalValue) == (2.5, 2, 5.0)
    assert rows["4", "c"].City is None


def test_scan_reads_only_the_columns_used(spark, root):
    land(spark, root, DOCUMENTS)
    plan = line_items(invoices(spark, root))._jdf.queryExecution().executedPlan().toString()
    assert "InvoiceLineItems" in plan
    for unused in ("CashierID", "CGST", "TaxableAmount", "NumberOfItems"):
        assert unused not in plan


def test_files_per_batch_bound_the_batches(spark, root):
    for document in DOCUMENTS:
        land(spark, f"{root}/landing", [document])
    with scratch_table(spark) as name:
        query = invoice_lines_stream(
            spark, f"{root}/landing", f"{root}/checkpoint", name, "batch", 1, f"{root}/items"
        )
        query.awaitTermination()
        assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [1, 1, 1, 1]
        assert spark.table(name).count() == 3
        # A file that comes later is added; the old ones are not read again.
        land(spark, f"{root}/landing", [{"InvoiceNumber": "5", "InvoiceLineItems": [item("d", 1)]}])
        invoice_lines_stream(
            spark, f"{root}/landing", f"{root}/checkpoint", name, "batch", 1, f"{root}/items"
        ).awaitTermination()
        assert spark.read.parquet(f"{root}/items").count() == 4


def test_handle_of_a_running_query(spark, root):
    land(spark, f"{root}/landing", DOCUMENTS)
    with scratch_table(spark) as name:
        query = invoice_lines_stream(
            spark, f"{root}/landing", f"{root}/checkpoint", name, "1 second", None, f"{root}/items"
        )
        assert query.name == "invoice-line-items"
        assert query.isActive
        query.processAllAvailable()
        query.stop()
        assert not query.isActive
        assert spark.read.parquet(f"{root}/items").count() == 3


def test_input_file_on_batch_and_stream(spark, root):
    land(spark, f"{root}/landing", DOCUMENTS)
    batch = with_input_file(invoices(spark, f"{root}/landing"))
    files = {r.InputFile for r in batch.select("InputFile").collect()}
    with scratch_table(spark) as name:
        bronze_invoices(
            spark, f"{root}/landing", f"{root}/checkpoint", name, "batch", path=f"{root}/bronze"
        ).awaitTermination()
    bronze = spark.read.parquet(f"{root}/bronze")
    assert bronze.count() == 4
    assert {r.InputFile for r in bronze.select("InputFile").collect()} == files
    assert len(files) == 1 and f"{root}/landing/part-" in files.pop()


def test_order_with_very_many_lines_is_cut_into_documents(spark):
    orders = spark.createDataFrame(
        [(1, 7, "O", 9.0, "5-LOW"), (2, 7, "F", 9.0, "5-LOW"), (3, 8, "F", 9.0, "5-LOW")],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderpriority string",
    ).withColumn("o_orderdate", F.expr("timestamp_ntz '1998-01-01'"))
    lines = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, 2).otherwise(1).cast("bigint").alias("l_orderkey"),
        F.col("id").alias("l_partkey"),
        F.lit(1.0).alias("l_quantity"),
        F.lit(2.0).alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"),
        F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
    )
    nested = nested_invoices(orders, lines)
    assert nested.agg(F.max(F.size("InvoiceLineItems"))).first()[0] <= 8192
    assert nested.where(F.size("InvoiceLineItems") == 0).count() == 3
    flat = line_items(nested)
    assert flat.select("ItemCode").distinct().count() == flat.count() == 50_000
