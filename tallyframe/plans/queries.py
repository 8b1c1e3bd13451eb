"""Registered queries over the given tables: one per operator of the engine."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import base_name, fold_columns, full_name, month_of, run_epoch_ms, run_timestamp, strip_store
from tallyframe.operators import dimensions as dims
from tallyframe.operators import ledger, marts
from tallyframe.operators.conform import accepted_rows, conform, header_groups, parse_files, rejected_rows
from tallyframe.operators.contract import bad_files, check_files
from tallyframe.operators.metrics import load_metrics
from tallyframe.plans.batch import Database, Layout, load_dimensions, read_mart, run_batch, stored_fact
from tallyframe.plans.landing import land, land_as, land_feeds, regional_lines, staged_lines
from tallyframe.plans.tables import (
    FACT_ORDER,
    customer_table,
    dimensions,
    file_events,
    landed_names,
    product_table,
    sales_fact,
    sales_keys,
    sales_lines,
    star,
    table,
)
from tallyframe.schema import SALES_FACT
from tallyframe.session import scratch_path
from tallyframe.sinks.files import (
    read_latest_snapshot,
    write_frame,
    write_partitioned,
    write_snapshot,
)
from tallyframe.sinks.jdbc import append_table, replace_months, replace_table
from tallyframe.sources.files import list_files
from tallyframe.sources.jdbc import read_table
from tallyframe.streaming.ingest import ingest_available


# --- files ---------------------------------------------------------------------------------


def csv_scan_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = land(sales_fact(spark, sf_dir), scratch_path(spark, "landing"))
    return conform(spark, check_files(list_files(spark, landing)))


def file_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per feed, with the number of data rows in its accepted files."""
    landing = land_feeds(spark, sf_dir)
    write_frame(customer_table(spark, sf_dir), f"{landing}/CUSTOMERS", "json")
    checked = check_files(list_files(spark, landing))
    accepted = accepted_rows(parse_files(spark, header_groups(checked)))
    feed = lambda path: F.element_at(F.split(path, "/"), -2)
    rows = accepted.groupBy(feed(F.col("source_file")).alias("row_feed")).agg(F.count("*").alias("n_rows"))
    verdicts = checked.select(
        feed(F.col("path")).alias("feed"),
        "verdict",
        "reason",
        F.concat_ws(",", "missing").alias("missing_columns"),
        F.concat_ws(",", "extra").alias("extra_columns"),
    ).distinct()
    return verdicts.join(rows, F.col("feed") == F.col("row_feed"), "left").select(
        "feed", "verdict", "reason", "missing_columns", "extra_columns", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


def extra_columns_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    extras = ["payment_mode", "return_flag"]
    lines = regional_lines(spark, sf_dir)
    return lines.select(
        "customer_id", "store_id", "sales_date", "sales_person_id", "total_cost",
        fold_columns(extras).alias("folded"),
        fold_columns(extras[1:]).alias("folded_one"),
        fold_columns([]).alias("folded_none"),
    )


def union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain, reordered and wider files of all accepted feeds as one fact."""
    return conform(spark, check_files(list_files(spark, land_feeds(spark, sf_dir))))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned goods come with a list as seller; priorities 1 to 3 with a wordy quantity, one that a cast would round, and
    a day that no time follows."""
    feed = sales_lines(spark, sf_dir).select(
        *[c for c in FACT_ORDER if c not in ("sales_person_id", "quantity", "sales_date")],
        F.when(F.col("payment_mode") == "3-MEDIUM", F.concat(F.col("sales_date").cast("string"), F.lit("T99:99")))
        .otherwise(F.col("sales_date").cast("string"))
        .alias("sales_date"),
        F.when(F.col("return_flag") == "R", F.concat(F.lit("["), F.col("sales_person_id").cast("string"), F.lit("]")))
        .otherwise(F.col("sales_person_id").cast("string"))
        .alias("sales_person_id"),
        F.when(F.col("payment_mode") == "1-URGENT", F.concat(F.col("quantity").cast("string"), F.lit(" pcs")))
        .when(F.col("payment_mode") == "2-HIGH", F.concat(F.col("quantity").cast("string"), F.lit(".000000001")))
        .otherwise(F.col("quantity").cast("string"))
        .alias("quantity"),
    )
    landing = land(feed, scratch_path(spark, "landing"))
    rejected = rejected_rows(parse_files(spark, header_groups(check_files(list_files(spark, landing)))))
    return rejected.select("reason", F.json_tuple("raw_record", *FACT_ORDER).alias(*FACT_ORDER))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = sales_lines(spark, sf_dir).select(*FACT_ORDER, "payment_mode")
    landing = land(feed, scratch_path(spark, "landing"))
    layout = Layout(scratch_path(spark, "store"))
    ingest_available(spark, landing, layout)
    return stored_fact(spark, layout).select(*SALES_FACT.names)


def _published(spark: SparkSession, layout: Layout) -> DataFrame:
    """Both marts of a store, one below the other."""
    none = lambda kind: F.lit(None).cast(kind)
    by_seller = read_mart(spark, layout, "sales_mart").select(
        F.lit("sales").alias("mart"), "store_id", F.col("sales_person_id").alias("person_id"), "full_name",
        F.col("sales_month").alias("month"), "total_sales", "incentive",
    )
    by_customer = read_mart(spark, layout, "customer_mart").select(
        F.lit("customer").alias("mart"), none("long").alias("store_id"), F.col("customer_id").alias("person_id"),
        "full_name", F.col("sales_date_month").alias("month"), "total_sales", none("decimal(18,4)").alias("incentive"),
    )
    return by_seller.unionByName(by_customer)


def batch_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that share all months, from files of the same names in different folders; the second has an earlier clock."""
    landing, layout = scratch_path(spark, "landing"), Layout(scratch_path(spark, "store"))
    feed = sales_lines(spark, sf_dir).select(*FACT_ORDER)
    even = F.col("store_id") % 2 == 0
    for run, rows in ((2_000, feed.where(even)), (1_000, feed.where(~even))):
        land_as(rows, f"{landing}/day{run}", "sales")
        run_batch(spark, landing, layout, dimensions(spark, sf_dir), run_epoch_ms=run, keep_base_rows=False)
    return _published(spark, layout)


def stream_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in several micro-batches that are published together, then a new checkpoint over the same store."""
    landing, layout = scratch_path(spark, "landing"), Layout(scratch_path(spark, "store"))
    feed = sales_lines(spark, sf_dir).select(*FACT_ORDER)
    late = F.col("sales_date") >= F.lit("1998-01-01").cast("date")
    load = lambda: dimensions(spark, sf_dir)
    for day, (rows, checkpoint) in enumerate(((feed.where(~late), "first"), (feed.where(late), "second"))):
        land_as(rows, f"{landing}/day{day}", "sales")
        ingest_available(
            spark, landing, layout, dimensions=load, files_per_batch=2, keep_base_rows=False,
            publish_every=None, checkpoint=layout.folder(f"checkpoint_{checkpoint}"),
        )
    return _published(spark, layout)


# --- dimensions ----------------------------------------------------------------------------


def dim_product_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_table(spark, sf_dir)


def join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.join_customer(sales_keys(spark, sf_dir), dimensions(spark, sf_dir).customer)


def join_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.join_store(sales_keys(spark, sf_dir), dimensions(spark, sf_dir).store)


def join_sales_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.join_sales_team(sales_keys(spark, sf_dir), dimensions(spark, sf_dir).sales_team)


def enrich_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.enrich(*star(spark, sf_dir))


def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales that would be lost if one segment, one region and the indebted sellers were unknown."""
    d = dimensions(spark, sf_dir)
    return dims.unmatched(
        sales_keys(spark, sf_dir),
        d.customer.where(F.col("last_name") != "BUILDING"),
        d.store.where(F.col("store_pincode") != "1"),
        d.sales_team.where(F.col("is_manager") == "N"),
    )


# --- marts ---------------------------------------------------------------------------------


def customer_mart_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_base(enrich_star(spark, sf_dir))


def sales_mart_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_base(dims.enrich(*star(spark, sf_dir), customer_last=False))


def hard_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The star with orphans in all dimensions, null keys, null totals, and totals so coarse that sellers tie."""
    d = dimensions(spark, sf_dir)
    fact = sales_keys(spark, sf_dir).select(
        F.when(F.col("customer_id") % 10 != 0, F.col("customer_id")).alias("customer_id"),
        "store_id",
        "sales_date",
        F.when(F.col("sales_person_id") % 7 != 0, F.col("sales_person_id")).alias("sales_person_id"),
        F.when(F.dayofmonth("sales_date") > 3, F.lit(100).cast("decimal(12,2)")).alias("total_cost"),
    )
    return (
        fact,
        d.customer.where(F.col("last_name") != "BUILDING"),
        d.store.where(F.col("store_pincode") != "1"),
        d.sales_team.where(F.col("is_manager") == "N"),
    )


def customer_mart_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_mart(*hard_star(spark, sf_dir))


def sales_mart_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_mart(*hard_star(spark, sf_dir))


def sales_rank_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_rank(*hard_star(spark, sf_dir))


def month_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sales_keys(spark, sf_dir)
        .groupBy(
            month_of("sales_date").alias("month_of_date"),
            F.expr("substring(cast(sales_date as string), 1, 7)").alias("month_by_text"),
            month_of(F.col("sales_date").cast("timestamp")).alias("month_of_timestamp"),
        )
        .agg(F.count("*").alias("n_rows"), F.min("sales_date").alias("first_day"))
    )


def full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all customers; those of one segment have no last name."""
    return customer_table(spark, sf_dir).select(
        "customer_id",
        full_name("first_name", F.nullif("last_name", F.lit("BUILDING"))).alias("full_name"),
    )


def customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_mart(*star(spark, sf_dir))


def customer_mart_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_mart_window(*star(spark, sf_dir))


def sales_person_month_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_person_month_totals(*star(spark, sf_dir))


def sales_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_rank(*star(spark, sf_dir))


def sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_mart(*star(spark, sf_dir))


def top_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_sellers(*star(spark, sf_dir))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sales_keys(spark, sf_dir)
        .select("customer_id", "store_id", month_of("sales_date").alias("sales_month"))
        .distinct()
    )


def load_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_metrics(regional_lines(spark, sf_dir).select(*FACT_ORDER, "payment_mode", "return_flag"))


def object_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the customers' files in two stores, cut to key and name."""
    name = F.concat(F.lit("in/"), F.col("c_mktsegment"), F.lit("/cust "), F.col("c_custkey").cast("string"), F.lit(".csv"))
    store = F.when(F.col("c_custkey") % 2 == 0, F.lit("s3a://shop/")).otherwise(F.lit("file:///"))
    return (
        table(spark, sf_dir, "customer")
        .select(F.concat(store, name).alias("path"))
        .select("path", strip_store("path").alias("object_key"), base_name("path").alias("file_name"))
    )


# --- ledger --------------------------------------------------------------------------------


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per customer, registered at the first and closed at the last order."""
    files = (
        file_events(spark, sf_dir)
        .groupBy("file_name")
        .agg(F.min("event_time").alias("begin"), F.max("event_time").alias("end"))
        .withColumn("path", F.concat(F.lit("landing/"), F.col("file_name")))
    )
    run = F.lit(1_000)
    return ledger.register_files(files, F.col("begin"), run).unionByName(
        ledger.close_files(files, F.col("end"), run)
    )


def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest_state(file_events(spark, sf_dir))


def ledger_active_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.active_landed(landed_names(spark, sf_dir), file_events(spark, sf_dir))


def ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.pending(landed_names(spark, sf_dir), file_events(spark, sf_dir))


# --- sinks ---------------------------------------------------------------------------------


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rows")
    rows = sales_mart_base(spark, sf_dir)
    write_frame(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def partitioned_mart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    rows = sales_mart_base(spark, sf_dir)
    write_partitioned(rows, path, ["sales_month", "store_id"])
    return spark.read.schema(rows.schema).parquet(path)


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the sales mart, the first of them before the last years had come in."""
    root = scratch_path(spark, "snapshots")
    fact, customer, store, team = star(spark, sf_dir)
    earlier = fact.where(F.col("sales_date") < F.lit("1998-01-01").cast("date"))
    for run, rows in ((1_000, earlier), (2_000, fact)):
        write_snapshot(marts.sales_mart(rows, customer, store, team), root, run)
    return read_latest_snapshot(spark, root)


def partitioned_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the sales rows by month; the newest is read back."""
    root = scratch_path(spark, "snapshots")
    rows = sales_mart_base(spark, sf_dir)
    for run, part in ((1_000, rows.where(F.col("store_id") < 5)), (2_000, rows)):
        write_snapshot(part, root, run, by=["sales_month"])
    return read_latest_snapshot(spark, root).select(*rows.columns)


def customer_mart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer-mart")
    rows = customer_mart(spark, sf_dir)
    write_partitioned(rows, path, ["sales_date_month"])
    return spark.read.schema(rows.schema).parquet(path)


def _database(spark: SparkSession) -> tuple[str, dict[str, str]]:
    """``TALLYFRAME_JDBC_URL`` and ``TALLYFRAME_JDBC_DRIVER`` name the database. Without them a local
    session uses the embedded in-memory one that ships with Spark. Only the process itself sees
    that one, so a session on a cluster has to name a database that all executors reach. The
    executors of a ``local-cluster[…]`` are processes of their own too.
    """
    url = os.environ.get("TALLYFRAME_JDBC_URL")
    driver = os.environ.get("TALLYFRAME_JDBC_DRIVER")
    if url is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set TALLYFRAME_JDBC_URL to a database that all executors reach")
        spark._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
        url = "jdbc:derby:memory:tallyframe;create=true"
        driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    return url, {"driver": driver} if driver else {}


def database_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales mart over dimensions that are loaded from a database, each in key ranges of equal numbers of rows."""
    url, properties = _database(spark)
    database = Database(url, properties, "query_customer", "query_store", "query_sales_team")
    stored = dimensions(spark, sf_dir)
    for frame, name in ((stored.customer, database.customer_table), (stored.store, database.store_table), (stored.sales_team, database.sales_team_table)):
        replace_table(frame, url, name, properties)
    loaded = load_dimensions(spark, database, Layout(scratch_path(spark, "store")), rows_per_task=500)
    return marts.sales_mart(star(spark, sf_dir)[0], loaded.customer, loaded.store, loaded.sales_team)


def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps of runs that begin with the first event of each kind and user."""
    runs = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id", "event_type").agg(F.min("ts").alias("begin"))
    return runs.select("user_id", "event_type", run_timestamp(F.col("begin")).alias("run_timestamp"), run_epoch_ms(F.col("begin")).alias("run_epoch_ms"))


def empty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery of which only the bad files come is an empty fact of the same layout, to which the next one is added."""
    with staged_lines(spark, sf_dir) as lines:
        nothing = conform(spark, bad_files(check_files(list_files(spark, land_feeds(spark, sf_dir, lines=lines)))))
        landing = scratch_path(spark, "landing")
        write_frame(lines.select(*FACT_ORDER, "payment_mode"), landing, "csv")
    return nothing.unionByName(conform(spark, check_files(list_files(spark, landing))))


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales mart to a database table and back."""
    url, properties = _database(spark)
    rows = marts.sales_mart(*star(spark, sf_dir))
    months = [r[0] for r in rows.select("sales_month").distinct().collect()]
    # The first months come by an append, and are replaced together with all others by what holds.
    replace_table(rows.limit(0), url, "sales_team_data_mart", properties)
    early = rows.where(F.col("sales_month") < "1994-01").withColumn("total_sales", F.col("total_sales") + 1)
    append_table(early, url, "sales_team_data_mart", properties)
    replace_months(rows, url, "sales_team_data_mart", properties, "sales_month", months)
    stored = read_table(spark, url, "sales_team_data_mart", properties, key="sales_person_id", rows_per_task=20_000)
    return stored.select(*marts.SALES_MART_COLUMNS)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "csv_scan_conform": csv_scan_conform,
        "file_contract_check": file_contract_check,
        "extra_columns_fold": extra_columns_fold,
        "union_files": union_files,
        "quarantine_rows": quarantine_rows,
        "stream_ingest": stream_ingest,
        "batch_marts": batch_marts,
        "stream_marts": stream_marts,
        "dim_product_scan": dim_product_scan,
        "join_customer": join_customer,
        "join_store": join_store,
        "join_sales_team": join_sales_team,
        "enrich_star": enrich_star,
        "unmatched_keys": unmatched_keys,
        "customer_mart_base": customer_mart_base,
        "sales_mart_base": sales_mart_base,
        "month_bucket": month_bucket,
        "full_name": full_names,
        "customer_mart": customer_mart,
        "customer_mart_window": customer_mart_window,
        "sales_person_month_total": sales_person_month_total,
        "sales_rank": sales_rank,
        "customer_mart_partial": customer_mart_partial,
        "sales_mart_partial": sales_mart_partial,
        "sales_rank_partial": sales_rank_partial,
        "sales_mart": sales_mart,
        "top_seller": top_seller,
        "distinct_rows": distinct_rows,
        "load_metrics": load_metrics_query,
        "object_paths": object_paths,
        "ledger_events": ledger_events,
        "ledger_latest": ledger_latest,
        "ledger_active_landed": ledger_active_landed,
        "ledger_pending": ledger_pending,
        "parquet_roundtrip": parquet_roundtrip,
        "partitioned_mart_roundtrip": partitioned_mart_roundtrip,
        "snapshot_latest": snapshot_latest,
        "partitioned_snapshot": partitioned_snapshot,
        "customer_mart_roundtrip": customer_mart_roundtrip,
        "jdbc_roundtrip": jdbc_roundtrip,
        "database_marts": database_marts,
        "run_stamps": run_stamps,
        "empty_feed": empty_feed,
    }
