"""Rows and frames that several test modules use."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def frame(spark, rows, layout):
    """Rows as a local frame, cast to the layout; unlike a list of rows it needs no Python worker."""
    fields = T.StructType.fromDDL(layout).fields
    texts = [[None if r[i] is None else str(r[i]) for r in rows] for i in range(len(fields))]
    table = pa.table({f.name: pa.array(t, pa.string()) for f, t in zip(fields, texts, strict=True)})
    return spark.createDataFrame(table).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


GOLDEN_FACT = [
    (1, 121, "2023-03-30", 1, "100"),
    (1, 121, "2023-03-30", 1, "100"),
    (1, 121, "2023-03-31", 1, "50"),
    (1, 121, "2023-04-01", 1, "70"),
    (2, 121, "2023-03-05", 2, "150"),
    (3, 121, "2023-03-06", 3, "20"),
    (2, 122, "2023-03-07", 1, "33"),
    (3, 122, "2023-03-08", 4, "33.50"),
]
LOST_FACT = [
    (99, 121, "2023-03-01", 1, "999"),
    (1, 999, "2023-03-01", 1, "999"),
    (1, 121, "2023-03-01", 99, "999"),
    (None, 121, "2023-03-01", 1, "999"),
]


def fact_frame(spark, rows):
    text = frame(
        spark, rows, "customer_id long, store_id long, sales_date string, sales_person_id long, total_cost string"
    )
    return text.selectExpr(
        "customer_id",
        "store_id",
        "'soap' as product_name",
        "cast(sales_date as date) as sales_date",
        "sales_person_id",
        "cast(total_cost as decimal(12,2)) as price",
        "1 as quantity",
        "cast(total_cost as decimal(12,2)) as total_cost",
        "cast(null as string) as additional_column",
    )


def as_text(df, *columns):
    """Rows as a sorted list of tuples of strings."""
    rows = df.select(*columns).collect() if columns else df.collect()
    texts = [tuple(None if v is None else str(v) for v in row) for row in rows]
    return sorted(texts, key=lambda row: tuple(v or "" for v in row))
