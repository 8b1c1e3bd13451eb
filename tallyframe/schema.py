"""Data contract of the sales feed and the layouts of the results."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
TOTAL = T.DecimalType(18, 2)
INCENTIVE = T.DecimalType(18, 4)

# The column names a sales file must carry, in fact order.
# Ids are long so that a large key space fits; every int id is a valid long.
SALES_CONTRACT = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("sales_date", T.DateType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total_cost", MONEY),
    ]
)
MANDATORY_COLUMNS = SALES_CONTRACT.names

ADDITIONAL_COLUMN = "additional_column"
SALES_FACT = T.StructType(
    [*SALES_CONTRACT.fields, T.StructField(ADDITIONAL_COLUMN, T.StringType())]
)

LEDGER_EVENT = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("file_location", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("run_epoch_ms", T.LongType()),
    ]
)

# Ledger status codes.
ACTIVE = "A"
INACTIVE = "I"
