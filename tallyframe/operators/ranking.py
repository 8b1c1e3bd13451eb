"""Rank in groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import scratch_path


def rank_descending(df: DataFrame, keys: Sequence[str], amount: str, name: str, parts: int | None = None) -> DataFrame:
    """Add ``rank() over (partition by keys order by amount desc)``, nulls last.

    A plain window sorts a whole group in one task. Here equal amounts are counted first, and the distinct ones are
    cut into ``parts`` ranges of one order over all groups (by default as many as shuffles have), written with the number of their
    range. A range holds about the same number of amounts whether they are of one group or of many. Ranks count up inside
    of a range, and the rows of a group in earlier ranges are added from a table with one row per group and range.
    """
    keys, spark = list(keys), df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*keys, amount).agg(F.count("*").alias("n_rows"))
    order = [*[F.asc(k) for k in keys], F.desc(amount)]
    # The ranges are drawn anew whenever the plan is run, so the numbers of one run are kept.
    path = scratch_path(spark, "ranges")
    counted.repartitionByRange(parts, *order).withColumn("range_no", F.spark_partition_id()).write.parquet(path)
    held = spark.read.parquet(path)
    before = Window.unboundedPreceding
    of_group = Window.partitionBy(*[f"range_{k}" for k in keys]).orderBy("of_range").rowsBetween(before, -1)
    sums = (
        held.groupBy(*[F.col(k).alias(f"range_{k}") for k in keys], F.col("range_no").alias("of_range"))
        .agg(F.sum("n_rows").alias("range_rows"))
        .withColumn("rows_above", F.sum("range_rows").over(of_group))
    )
    in_range = Window.partitionBy(*keys, "range_no").orderBy(F.desc(amount)).rowsBetween(before, -1)
    ranks = (
        held.withColumn("rows_before", F.sum("n_rows").over(in_range))
        .join(sums, _same([*keys, "range_no"], [*[f"range_{k}" for k in keys], "of_range"]), "inner")
        .select(
            *[F.col(k).alias(f"rank_{k}") for k in keys],
            F.col(amount).alias("rank_amount"),
            (1 + F.coalesce("rows_above", F.lit(0)) + F.coalesce("rows_before", F.lit(0))).alias(name),
        )
    )
    found = df.join(ranks, _same([*keys, amount], [*[f"rank_{k}" for k in keys], "rank_amount"]), "inner")
    return found.select(*df.columns, name)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(Column.__and__, pairs)
