"""File sinks: plain, Hive-partitioned, and one folder per run."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_frame(df: DataFrame, path: str, data_format: str = "parquet", mode: str = "overwrite") -> None:
    """Write a frame; errors go up to the caller."""
    writer = df.write.format(data_format).mode(mode)
    if data_format == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], touched_only: bool = False) -> None:
    """Write one folder per value of ``by``.

    The rebalance hint brings the rows of a folder together, so that few files come out, and
    still cuts a folder with very many rows into several tasks; a plain ``repartition`` on
    the same columns would give that folder to one task. With ``touched_only`` the folders
    that the frame has no rows for stay as they are, otherwise the whole table is replaced.
    """
    writer = (
        df.hint("rebalance", *by)
        .write.format("parquet")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
        .partitionBy(*by)
    )
    writer.save(path)


def snapshot_folder(root: str, run_epoch_ms: int) -> str:
    return f"{root.rstrip('/')}/run_epoch_ms={run_epoch_ms}"


def write_snapshot(df: DataFrame, root: str, run_epoch_ms: int, by: Sequence[str] = ()) -> str:
    """Keep the result of one run under its own folder beside those of earlier runs."""
    folder = snapshot_folder(root, run_epoch_ms)
    if by:
        write_partitioned(df, folder, by)
    else:
        write_frame(df, folder)
    return folder


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a pattern; one call to the store, no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder that exists or not; one call to the store. Names that begin with ``.`` or ``_`` are left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.listStatus(path) if store.exists(path) else []
    names = (status.getPath().getName() for status in found)
    return sorted(name for name in names if name[0] not in "._" or name.startswith("__HIVE"))


def literal(path: str) -> str:
    """The path for use inside of a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def drop_paths(spark: SparkSession, pattern: str) -> None:
    """Remove what an unfinished attempt has left."""
    for found in matching_paths(spark, pattern):
        path = spark._jvm.org.apache.hadoop.fs.Path(found)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def complete_snapshots(spark: SparkSession, root: str) -> list[int]:
    """Runs with a snapshot that was written to its end, oldest first."""
    done = matching_paths(spark, f"{literal(root.rstrip('/'))}/run_epoch_ms=*/_SUCCESS")
    return sorted(int(path.rsplit("run_epoch_ms=", 1)[1].partition("/")[0]) for path in done)


def read_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest snapshot that was written to its end."""
    runs = complete_snapshots(spark, root)
    if not runs:
        raise FileNotFoundError(f"no finished snapshot under {root}")
    return spark.read.parquet(snapshot_folder(root, runs[-1]))
