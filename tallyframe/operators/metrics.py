"""Load figures of a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def load_metrics(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_nulls) per column, from one pass over the frame."""
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), "n_rows", F.col(f"null_{i}").alias("n_nulls"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def observe_counts(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame, and a function that gives how many of its rows met each condition in the first action on it.

    The figures ride on that action: no further job is run. The function waits for it."""
    seen = Observation()
    marked = df.observe(seen, *[F.count_if(condition).alias(name) for name, condition in conditions.items()])

    def counts() -> dict[str, int]:
        # Spark leaves the observation out of a plan that turns out to be empty.
        known = seen.get if seen._jo.getRow().size() else {}
        return {name: known.get(name, 0) for name in conditions}

    return marked, counts
