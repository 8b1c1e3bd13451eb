"""File ledger: an append-only list of events, and the state derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.schema import ACTIVE, INACTIVE, LEDGER_EVENT


def register_files(files: DataFrame, event_time: Column, run_epoch_ms: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One event with status ``A`` per file that a run is about to process; ``keep`` names more columns."""
    return _events(files, event_time, run_epoch_ms, ACTIVE, keep)


def close_files(files: DataFrame, event_time: Column, run_epoch_ms: Column, keep: Sequence[str] = ()) -> DataFrame:
    """One event with status ``I`` per file that a run has processed to the end."""
    return _events(files, event_time, run_epoch_ms, INACTIVE, keep)


def _events(files: DataFrame, event_time: Column, run_epoch_ms: Column, status: str, keep: Sequence[str]) -> DataFrame:
    # In one run and second the closing event has to come after the registration.
    order = run_epoch_ms.cast("bigint") * 2 + (1 if status == INACTIVE else 0)
    return files.select(
        "file_name",
        F.col("path").alias("file_location"),
        F.date_trunc("second", event_time).alias("event_time"),
        order.alias("event_id"),
        F.lit(status).alias("status"),
        run_epoch_ms.cast("bigint").alias("run_epoch_ms"),
        *keep,
    ).select(*LEDGER_EVENT.names, *keep)


def latest_state(events: DataFrame, key: str = "file_name") -> DataFrame:
    """One row per file: its status after the last event, when it came in, when it was closed.

    ``key`` is what tells files apart: the name, or with ``file_key`` also folder, length and time.
    """
    return events.groupBy(key).agg(
        F.max_by("status", F.struct("event_time", "event_id")).alias("status"),
        F.min("event_time").alias("created_date"),
        F.max(F.when(F.col("status") == INACTIVE, F.col("event_time"))).alias("updated_date"),
    )


def active_landed(landed: DataFrame, events: DataFrame, key: str = "file_name") -> DataFrame:
    """Landed files that the ledger still holds as active, by name: their last run did not finish."""
    open_files = latest_state(events, key).where(F.col("status") == ACTIVE).select(key)
    return landed.join(open_files, key, "left_semi").select("file_name").distinct()


def pending(landed: DataFrame, events: DataFrame, key: str = "file_name") -> DataFrame:
    """Landed files that no run has processed to the end."""
    done = latest_state(events, key).where(F.col("status") == INACTIVE).select(key)
    return landed.join(done, key, "left_anti")
