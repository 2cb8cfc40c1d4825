"""Schemas, as DDL text, and constants shared by the sources, operators and plans."""

# Field names, types and settings that results must agree with.

INVOICE = """
    InvoiceNumber string, CreatedTime bigint, StoreID string, PosID string, CashierID string,
    CustomerType string, CustomerCardNo string, TotalAmount double, NumberOfItems bigint,
    PaymentMethod string, TaxableAmount double, CGST double, SGST double, CESS double,
    DeliveryType string,
    DeliveryAddress struct<AddressLine string, City string, ContactNumber string,
                           PinCode string, State string>,
    InvoiceLineItems array<struct<ItemCode string, ItemDescription string, ItemPrice double,
                                  ItemQty bigint, TotalValue double>>
"""
TRADE = "CreatedTime string, Type string, Amount double, BrokerCode string"
SENSOR = "CreatedTime string, Reading double"
LOG_TABLE = "key string, value string"
INVOICE_COLUMNS = (
    "InvoiceNumber",
    "CreatedTime",
    "StoreID",
    "PosID",
    "CustomerType",
    "PaymentMethod",
    "DeliveryType",
    "DeliveryAddress.City",
    "DeliveryAddress.State",
    "DeliveryAddress.PinCode",
)
ITEM_COLUMNS = ("ItemCode", "ItemDescription", "ItemPrice", "ItemQty", "TotalValue")
REWARDS = "CustomerCardNo string, TotalAmount double, TotalPoints double"

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CLOCK_FORMAT = "HH:mm"
SENTENCE_SEPARATOR = "."
WORD_SEPARATOR = " "
WORD_PATTERN = "[a-z]"
BUY, SELL = "BUY", "SELL"
POINTS_RATE = "0.02"
WINDOW_SIZE = "15 minutes"
WATERMARK_DELAY = "30 minutes"

# What a Kafka source hands over; envelope files hold the same columns.
LOG_ENVELOPE = """
    key binary, value binary, topic string, partition int, offset bigint,
    timestamp timestamp, timestampType int
"""

# End of fixed values.
