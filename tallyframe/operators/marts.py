"""Monthly spend per customer, and monthly sales, rank and incentive per salesperson.

The fact is summed before it meets the dimensions that only add attributes. A customer or
store with a large share of all rows is then folded on the map side, and no join or sort ever
sees its single rows. Dimension keys are unique by contract (``dimensions.repeated_keys``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import full_name, incentive, month_of
from tallyframe.operators.ranking import rank_descending
from tallyframe.schema import TOTAL

# The mart columns, here and of the base rows below.
CUSTOMER_MART_COLUMNS = [
    "customer_id", "full_name", "address", "phone_number", "sales_date_month", "total_sales",
]
SALES_MART_COLUMNS = [
    "store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive",
]


def customer_base(enriched: DataFrame) -> DataFrame:
    """The sales rows behind the customer mart."""
    return enriched.select(
        "customer_id", "first_name", "last_name", "address", "pincode", "phone_number", "sales_date", "total_cost"
    )


def sales_base(enriched: DataFrame) -> DataFrame:
    """The sales rows behind the sales mart, with their month."""
    return enriched.select(
        "store_id",
        "sales_person_id",
        "sales_person_first_name",
        "sales_person_last_name",
        "manager_id",
        "is_manager",
        "sales_person_address",
        "sales_person_pincode",
        "sales_date",
        "total_cost",
        F.expr("substring(cast(sales_date as string), 1, 7) as sales_month"),
    )


def _known(rows: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Rows whose key is in the dimension; adds no column."""
    keys = dimension.select(F.col(dimension_key).alias("dim_key"))
    return rows.join(keys, F.col(key) == F.col("dim_key"), "left_semi")


def _at_known_counters(fact: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    at_store = _known(fact, "store_id", store, "id")
    return _known(at_store, "sales_person_id", sales_team, "id")


def _customer_names(totals: DataFrame, customer: DataFrame) -> DataFrame:
    side = customer.select(
        F.col("customer_id").alias("dim_key"), full_name("first_name", "last_name").alias("full_name"),
        "address", "phone_number",
    )
    return totals.join(side, F.col("customer_id") == F.col("dim_key"), "inner")


def customer_mart(fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Spend per customer and month over the sales that match every dimension."""
    totals = (
        _at_known_counters(fact, store, sales_team)
        .groupBy("customer_id", month_of("sales_date").alias("sales_date_month"))
        .agg(F.sum("total_cost").cast(TOTAL).alias("total_sales"))
    )
    return _customer_names(totals, customer).select(*CUSTOMER_MART_COLUMNS)


def customer_mart_window(
    fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame
) -> DataFrame:
    """The customer mart as a whole-partition window total followed by ``distinct``.

    The window runs over days, so one customer-month hands it 31 rows at most.
    """
    days = (
        _at_known_counters(fact, store, sales_team)
        .groupBy("customer_id", "sales_date")
        .agg(F.sum("total_cost").alias("day_sales"))
    )
    month = Window.partitionBy("customer_id", "sales_date_month")
    return (
        _customer_names(days, customer)
        .withColumn("sales_date_month", month_of("sales_date"))
        .withColumn("month_sales", F.sum("day_sales").over(month))
        .select(
            "customer_id", "full_name", "address", "phone_number", "sales_date_month",
            F.col("month_sales").cast(TOTAL).alias("total_sales"),
        )
        .distinct()
    )


def _person_totals(fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Totals with the seller's name.

    Only the customer has to be looked up per sale. Store and seller are keys of the sum, so they
    are looked up once per total.
    """
    totals = (
        _known(fact, "customer_id", customer, "customer_id")
        .groupBy("store_id", "sales_person_id", month_of("sales_date").alias("sales_month"))
        .agg(F.sum("total_cost").cast(TOTAL).alias("total_sales"))
    )
    stores = store.select(F.col("id").alias("dim_store_id"))
    people = sales_team.select(
        F.col("id").alias("dim_person_id"), full_name("first_name", "last_name").alias("full_name")
    )
    return (
        totals.join(stores, F.col("store_id") == F.col("dim_store_id"), "inner")
        .join(people, F.col("sales_person_id") == F.col("dim_person_id"), "inner")
        .select("store_id", "sales_person_id", "full_name", "sales_month", "total_sales")
    )


def _with_best(totals: DataFrame) -> DataFrame:
    """Totals with the best total of their store and month.

    A row has rank 1 exactly when it reaches that total, so sorting a store-month is not needed.
    """
    best = totals.groupBy(
        F.col("store_id").alias("best_store_id"), F.col("sales_month").alias("best_month")
    ).agg(F.max("total_sales").alias("best_total"))
    same_group = F.col("store_id").eqNullSafe(F.col("best_store_id")) & F.col("sales_month").eqNullSafe(
        F.col("best_month")
    )
    return totals.join(best, same_group, "inner").withColumn(
        "is_best", F.col("total_sales").eqNullSafe(F.col("best_total"))
    )


def sales_person_month_totals(
    fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame
) -> DataFrame:
    """Sales per store, salesperson and month."""
    return _person_totals(fact, customer, store, sales_team)


def sales_rank(fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Rank of every salesperson in the store and month by total, ties sharing a rank."""
    totals = _person_totals(fact, customer, store, sales_team)
    return rank_descending(totals, ["store_id", "sales_month"], "total_sales", "rnk")


def sales_mart(fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Sales per store, salesperson and month; the best of each store-month earn one percent.

    Sellers that tie for the best total all earn it.
    """
    totals = _with_best(_person_totals(fact, customer, store, sales_team))
    return totals.withColumn("incentive", incentive(F.col("total_sales"), F.col("is_best"))).select(
        *SALES_MART_COLUMNS
    )


def top_sellers(fact: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame) -> DataFrame:
    """Only the best sellers of each store and month, ties included."""
    best = _with_best(_person_totals(fact, customer, store, sales_team)).where("is_best")
    return best.withColumn("incentive", incentive(F.col("total_sales"), F.col("is_best"))).select(
        *SALES_MART_COLUMNS
    )
