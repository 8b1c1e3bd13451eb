"""Star enrichment of the sales fact, and the account of the rows it cannot match.

No join carries a broadcast hint. Dimensions are read from files, so Spark knows their size: it
broadcasts those below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles by key beyond
it, where adaptive execution cuts a key with very many rows into several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FACT = ["customer_id", "store_id", "sales_date", "sales_person_id", "total_cost"]
_CUSTOMER = ["first_name", "last_name", "address", "pincode", "phone_number"]
_STORE = ["store_address", "store_manager_name"]
_PERSON = [
    "manager_id",
    "is_manager",
    "sales_person_joining_date",
    "sales_person_first_name",
    "sales_person_last_name",
    "sales_person_address",
    "sales_person_pincode",
]
ENRICHED_COLUMNS = [*_FACT, *_CUSTOMER, *_STORE, *_PERSON]


def join_customer(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Rows of known customers, with the customer's attributes."""
    side = customer.select(F.col("customer_id").alias("dim_customer_id"), *_CUSTOMER)
    return fact.join(side, F.col("customer_id") == F.col("dim_customer_id"), "inner").drop("dim_customer_id")


def join_store(fact: DataFrame, store: DataFrame) -> DataFrame:
    """Rows of known stores, with the store's address and manager."""
    side = store.select(
        F.col("id").alias("dim_store_id"), F.col("address").alias("store_address"), "store_manager_name"
    )
    return fact.join(side, F.col("store_id") == F.col("dim_store_id"), "inner").drop("dim_store_id")


def join_sales_team(fact: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Rows of known sellers, with the seller's attributes under ``sales_person_`` names."""
    side = sales_team.select(
        F.col("id").alias("dim_person_id"),
        "manager_id",
        "is_manager",
        F.col("joining_date").alias("sales_person_joining_date"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
    )
    return fact.join(side, F.col("sales_person_id") == F.col("dim_person_id"), "inner").drop("dim_person_id")


def enrich(
    fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame, customer_last: bool = True
) -> DataFrame:
    """Fact rows known to all three dimensions, every column name unique.

    By default the customer comes last: it is the dimension that may need a shuffle, and the others have
    dropped their unmatched rows by then. Who uses the sellers' columns and not the customers' has the customer first, so
    that the rows are shuffled by customer while they are narrow.
    """
    narrow = fact.select(*_FACT)
    if customer_last:
        joined = join_customer(join_sales_team(join_store(narrow, store), sales_team), customer)
    else:
        joined = join_sales_team(join_store(join_customer(narrow, customer), store), sales_team)
    return joined.select(*ENRICHED_COLUMNS)


def unmatched(fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Fact rows that ``enrich`` leaves out, each once, with the first dimension that lacks it.

    One pass over the fact. A null key counts as unmatched.
    """
    tagged = fact
    for name, dimension, key in (
        ("customer", customer, "customer_id"),
        ("store", store, "id"),
        ("sales_person", sales_team, "id"),
    ):
        keys = dimension.select(F.col(key).alias(f"dim_{name}_id"))
        tagged = tagged.join(keys, F.col(f"{name}_id") == F.col(f"dim_{name}_id"), "left")
    reason = (
        F.when(F.col("dim_customer_id").isNull(), F.lit("unknown customer_id"))
        .when(F.col("dim_store_id").isNull(), F.lit("unknown store_id"))
        .when(F.col("dim_sales_person_id").isNull(), F.lit("unknown sales_person_id"))
    )
    return tagged.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*fact.columns, "reason")


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a dimension; the joins rely on there being none."""
    return dimension.groupBy(key).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
