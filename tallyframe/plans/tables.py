"""The given order tables seen as a retail feed: sales fact, dimensions, ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans.batch import Dimensions
from tallyframe.schema import MONEY


# The columns of the given tables. With a known layout a read is planned without
# a job that opens files to find it out.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str, with_product: bool = True, dealt: bool = False) -> DataFrame:
    """Sales fact, plus order priority, return flag and store region for the landing files.

    The product is looked up by its primary key with an outer join, which neither adds nor drops a
    row; whoever needs no product column leaves that join out. With ``dealt`` the lines are spread evenly over
    tasks whatever the files they are read from, while they are narrow.
    """
    lines = table(spark, sf_dir, "lineitem")
    if dealt:
        lines = lines.hint("rebalance")
    orders = table(spark, sf_dir, "orders")
    sellers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner").join(
        sellers, F.col("l_suppkey") == F.col("s_suppkey"), "inner"
    )
    product = []
    if with_product:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
        joined = joined.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        product = [
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast(MONEY).alias("price"),
        ]
    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("s_nationkey").cast("bigint").alias("store_id"),
        F.col("o_orderdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("sales_person_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
        *product,
        F.col("o_orderpriority").alias("payment_mode"),
        F.col("l_returnflag").alias("return_flag"),
    )


FACT_ORDER = [
    "customer_id", "store_id", "product_name", "sales_date", "sales_person_id", "price", "quantity", "total_cost",
]


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact in contract order."""
    return sales_lines(spark, sf_dir).select(*FACT_ORDER)


def sales_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the fact that the marts use."""
    return sales_lines(spark, sf_dir, with_product=False).select(
        "customer_id", "store_id", "sales_date", "sales_person_id", "total_cost"
    )


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.col("n_name").alias("address"),
            F.col("c_nationkey").cast("string").alias("pincode"),
            F.col("c_custkey").cast("string").alias("phone_number"),
        )
    )


def store_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("address"),
        F.col("n_regionkey").cast("string").alias("store_pincode"),
        F.concat(F.lit("manager of "), F.col("n_name")).alias("store_manager_name"),
    )


def sales_team_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("first_name"),
        F.col("s_nationkey").cast("string").alias("last_name"),
        F.col("s_nationkey").alias("manager_id"),
        F.when(F.col("s_acctbal") < 0, "Y").otherwise("N").alias("is_manager"),
        F.concat(F.lit("street "), F.col("s_suppkey").cast("string")).alias("address"),
        F.col("s_nationkey").cast("string").alias("pincode"),
        F.lit(None).cast("date").alias("joining_date"),
    )


def product_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(MONEY).alias("current_price"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return Dimensions(
        customer_table(spark, sf_dir), store_table(spark, sf_dir), sales_team_table(spark, sf_dir)
    )


def star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    d = dimensions(spark, sf_dir)
    return sales_keys(spark, sf_dir), d.customer, d.store, d.sales_team


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events: one file per customer, one event per order of the customer."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("file_name"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_orderkey").alias("event_id"),
        F.when(F.col("o_orderstatus") == "O", "A").otherwise("I").alias("status"),
    )


def landed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("file_name")
    )
