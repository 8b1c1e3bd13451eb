"""Incremental intake: each landed file once, with the same checks as a batch run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyframe.plans.batch import Database, Dimensions, Layout, has_stored, publish_stored, take_files
from tallyframe.sources.files import FILE_LAYOUT, files_frame


def start_ingest(
    spark: SparkSession,
    landing: str,
    layout: Layout,
    dimensions: Dimensions | Callable[[], Dimensions] | None = None,
    database: Database | None = None,
    files_per_batch: int | None = None,
    archive: str | None = None,
    checkpoint: str | None = None,
    keep_base_rows: bool = True,
    publish_every: int | None = 1,
    **trigger,
) -> StreamingQuery:
    """Stream the status of new files and hand each micro-batch to the batch intake.

    The stream carries no content: files with another column order need their own header,
    which a stream with one fixed layout would ignore. A micro-batch is a run like any other: it takes what the
    ledger of the store does not hold yet, under a number of its own. A replayed batch, a new checkpoint and a
    batch run on the same store therefore take no file twice. ``dimensions`` may be a function that loads
    them; it is asked for every micro-batch. With ``archive`` Spark moves finished files there when a later
    batch ends; a file that is still in the landing folder may therefore be processed already.

    ``publish_every`` micro-batches the marts are brought up to date, by default with each. The others only store their
    rows, and the store's log is the queue of what is not published; with None ``publish_stored`` is left to the caller.
    A month that many micro-batches touch is then summed, ranked and written once. What a stopped stream has stored and not
    published is published with the next batch or run.
    """
    waiting = [0]

    def handle(batch: DataFrame, number: int) -> None:
        files = files_frame(batch.select("path", "length", "modificationTime"))
        if publish_every == 1 or dimensions is None:
            take_files(spark, files, layout, dimensions, database, keep_base_rows)
            return
        take_files(spark, files, layout, None)
        waiting[0] += 1
        if publish_every is not None and waiting[0] >= publish_every:
            waiting[0] = 0
            publish_stored(spark, layout, dimensions() if callable(dimensions) else dimensions, database, keep_base_rows)

    reader = spark.readStream.schema(FILE_LAYOUT).format("binaryFile").option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return (
        reader.load(landing)
        .select("path", "length", "modificationTime")
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint or layout.folder("stream_checkpoint"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def ingest_available(
    spark: SparkSession,
    landing: str,
    layout: Layout,
    dimensions: Dimensions | Callable[[], Dimensions] | None = None,
    database: Database | None = None,
    keep_base_rows: bool = True,
    **options,
) -> None:
    """Process all files that are new since the last call, publish what is stored, then stop."""
    start_ingest(spark, landing, layout, dimensions, database, keep_base_rows=keep_base_rows, **options).awaitTermination()
    if dimensions is not None and options.get("publish_every", 1) != 1 and has_stored(spark, layout):
        publish_stored(spark, layout, dimensions() if callable(dimensions) else dimensions, database, keep_base_rows)
