"""Landing folders written from the sales fact: the input of the file queries.

Each store region delivers its whole sales in a layout of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans.tables import FACT_ORDER, sales_lines, table
from tallyframe.session import scratch_path, shuffles_released
from tallyframe.sinks.files import drop_paths, literal, matching_paths, write_frame

# What the file of each region looks like.
FEEDS = {
    "AFRICA": FACT_ORDER,
    "AMERICA": [*FACT_ORDER, "payment_mode"],
    "ASIA": list(reversed(FACT_ORDER)),
    "EUROPE": [*[c for c in FACT_ORDER if c != "store_id"], "payment_mode"],
    "MIDDLE EAST": [*FACT_ORDER, "payment_mode", "return_flag"],
}


def land(feed: DataFrame, landing: str) -> str:
    """Write one feed as CSV files of even size, whatever the files it was read from."""
    write_frame(feed.hint("rebalance"), landing, "csv")
    return landing


def land_as(feed: DataFrame, landing: str, name: str) -> str:
    """Write one feed as CSV files named ``<name>-<number>.csv``: other feeds may use the same names."""
    land(feed, landing)
    spark = feed.sparkSession
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    for number, part in enumerate(sorted(matching_paths(spark, f"{literal(landing)}/part-*"))):
        source = new_path(part)
        store = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if not store.rename(source, new_path(f"{landing}/{name}-{number}.csv")):
            raise OSError(f"{part} could not be renamed")
    return landing


@contextmanager
def staged_lines(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The sales lines, joined once and written, for feeds that are landed inside; they are gone afterwards.

    The rows are dealt evenly before the joins, so feeds need no shuffle of their own.
    """
    staged = scratch_path(spark, "lines")
    lines = sales_lines(spark, sf_dir, dealt=True)
    try:
        with shuffles_released(spark):
            write_frame(lines, staged)
        yield spark.read.schema(lines.schema).parquet(staged)
    finally:
        drop_paths(spark, literal(staged))


def regional_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Sales with the region of the store; return flag N counts as not given."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation_id"), "n_regionkey"
    )
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return (
        (sales_lines(spark, sf_dir) if lines is None else lines)
        .withColumn("return_flag", F.when(F.col("return_flag") != "N", F.col("return_flag")))
        .join(nation, F.col("store_id") == F.col("nation_id"), "inner")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
        .drop("nation_id", "n_regionkey", "r_regionkey")
    )


def land_feeds(spark: SparkSession, sf_dir: str, regions=tuple(FEEDS), lines: DataFrame | None = None) -> str:
    """Write the feed of each region to ``<landing>/<region>/`` and return the landing folder; ``lines`` are the staged
    lines, of a caller that lands more than these feeds."""
    if lines is None:
        with staged_lines(spark, sf_dir) as lines:
            return land_feeds(spark, sf_dir, regions, lines)
    landing = scratch_path(spark, "landing")
    stored = regional_lines(spark, sf_dir, lines)
    for name in regions:
        feed = stored.where(F.col("region") == name).select(*FEEDS[name])
        write_frame(feed, f"{landing}/{name.replace(' ', '_')}", "csv")
    return landing
