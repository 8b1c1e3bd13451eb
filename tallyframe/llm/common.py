"""What the operators share: tables, hand-over tables in the shared folder, and file access of tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import scratch_path

# The spaces between words, for patterns and for Python's str.translate.
WORD = r"[^\x20\x09-\x0D]+"
LOWER_A_TO_Z = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: a lost executor costs no step before it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(rows: DataFrame, place: Column, wanted: int, total: int) -> DataFrame:
    """About 1.2 times ``wanted`` rows of ``total``, those of smallest ``place`` (an xxhash64), by a comparison per row.

    A sort with a limit would have every task hand that many rows to the driver."""
    bound = below(wanted, total)
    return rows if bound is None else rows.where(place < F.lit(bound))


def below(wanted: int, total: int) -> int | None:
    """The xxhash64 below which about 1.2 times ``wanted`` of ``total`` lie; none where that is all."""
    return None if total <= 1.2 * wanted else int(-(2**63) + 2**64 * (1.2 * wanted / total))


def spread(files: DataFrame, order: str, size: str, per_task: int) -> DataFrame:
    """A list of files, one per row, over as many tasks as their bytes warrant, and not more than there are files.

    The number is stated, as adaptive execution would merge rows of a few KB into one task whatever they stand for."""
    count, total = files.agg(F.count("*"), F.sum(size)).first()
    return files.repartitionByRange(max(1, min(count, -(-(total or 0) // per_task))), order)


def task_files(folder: str):
    """The file system of a shared folder as tasks see it, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)
