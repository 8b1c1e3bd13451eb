from helpers import as_text, frame
from pyspark.sql import functions as F

from tallyframe.operators import ledger
from tallyframe.schema import LEDGER_EVENT


def events(spark):
    rows = [
        ("done.csv", "in/done.csv", "2023-03-01 10:00:00", 1, "A"),
        ("done.csv", "in/done.csv", "2023-03-01 10:05:00", 2, "I"),
        ("dead.csv", "in/dead.csv", "2023-03-01 10:00:00", 1, "A"),
        ("again.csv", "in/again.csv", "2023-03-01 10:00:00", 1, "I"),
        ("again.csv", "in/again.csv", "2023-03-02 10:00:00", 3, "A"),
        ("quick.csv", "in/quick.csv", "2023-03-03 10:00:00", 5, "I"),
        ("quick.csv", "in/quick.csv", "2023-03-03 10:00:00", 4, "A"),
    ]
    df = frame(spark, rows, "file_name string, file_location string, t string, event_id long, status string")
    return df.select("file_name", "file_location", F.col("t").cast("timestamp").alias("event_time"), "event_id", "status")


def landed(spark):
    names = ["done.csv", "dead.csv", "again.csv", "quick.csv", "new.csv"]
    return frame(spark, [(n,) for n in names], "file_name string")


def test_latest_state(spark):
    assert as_text(ledger.latest_state(events(spark))) == [
        ("again.csv", "A", "2023-03-01 10:00:00", "2023-03-01 10:00:00"),
        ("dead.csv", "A", "2023-03-01 10:00:00", None),
        ("done.csv", "I", "2023-03-01 10:00:00", "2023-03-01 10:05:00"),
        ("quick.csv", "I", "2023-03-03 10:00:00", "2023-03-03 10:00:00"),
    ]


def test_active_and_pending(spark):
    assert as_text(ledger.active_landed(landed(spark), events(spark))) == [("again.csv",), ("dead.csv",)]
    assert as_text(ledger.pending(landed(spark), events(spark))) == [("again.csv",), ("dead.csv",), ("new.csv",)]


def test_register_and_close(spark):
    files = frame(spark, [("a.csv", "s3a://x/a.csv")], "file_name string, path string")
    now, run = F.lit("2023-03-01 10:00:00.75").cast("timestamp"), F.lit(7000)
    both = ledger.register_files(files, now, run).unionByName(ledger.close_files(files, now, run))
    assert both.columns == LEDGER_EVENT.names
    assert as_text(both, "file_name", "event_time", "status", "run_epoch_ms") == [
        ("a.csv", "2023-03-01 10:00:00", "A", "7000"),
        ("a.csv", "2023-03-01 10:00:00", "I", "7000"),
    ]
    assert as_text(ledger.latest_state(both), "status") == [("I",)]
