"""Order of runs, commits that meet, deferred publishing, compaction, and what a run lists."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import as_text
from feeds import VALID, feed, put
from pyspark.sql import functions as F

from tallyframe.operators import ledger
from tallyframe.operators.metrics import observe_counts
from tallyframe.plans import batch, runlog
from tallyframe.plans.batch import Dimensions, Layout, ledger_events, read_mart, run_batch, stored_fact
from tallyframe.streaming.ingest import ingest_available


def sale(day, total, seller=1):
    return f"1,121,soap,{day},{seller},{total},1,{total}"


@pytest.fixture
def shop(spark, star, tmp_path):
    (tmp_path / "landing").mkdir()
    return tmp_path / "landing", Layout(str(tmp_path / "store")), Dimensions(*star)


def run(spark, landing, layout, dims, **options):
    return run_batch(spark, str(landing), layout, dims, keep_base_rows=False, **options)


def totals(spark, layout):
    return as_text(read_mart(spark, layout, "sales_mart"), "sales_month", "sales_person_id", "total_sales")


def test_a_run_with_an_earlier_clock_counts(spark, shop):
    landing, layout, dims = shop
    put(landing, "a.csv", feed(VALID, sale("2023-03-01", 10)))
    run(spark, landing, layout, dims, run_epoch_ms=2000)
    put(landing, "b.csv", feed(VALID, sale("2023-03-02", 20)))
    report = run(spark, landing, layout, dims, run_epoch_ms=1000)
    assert totals(spark, layout) == [("2023-03", "1", "30.00")]
    assert report.run_epoch_ms > 2000 and batch.closed_runs(spark, layout) == [2000, report.run_epoch_ms]


def test_rejecting_runs_of_one_number_keep_all_files(spark, shop):
    landing, layout, dims = shop
    for name in ("bad1.csv", "bad2.csv"):
        put(landing, name, feed("a,b", name))
        assert run(spark, landing, layout, dims, run_epoch_ms=1000 if name == "bad1.csv" else 999).status == "rejected"
    assert as_text(batch.quarantined_lines(spark, layout).where("line like 'bad%'"), "file_name", "line") == [
        ("bad1.csv", "bad1.csv"),
        ("bad2.csv", "bad2.csv"),
    ]
    assert batch.rejected_files(spark, layout).count() == 2


def test_a_file_is_created_once(spark, tmp_path):
    root = f"file://{tmp_path}/a b%20"
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: runlog.claim_run(spark, root, 1000), range(24)))
    assert sorted(numbers) == list(range(1000, 1024))
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: runlog.commit(spark, root, 1, [runlog.Line("run", i)]), range(8)))
    assert sum(made) == 1 and [r[0] for r in runlog.read_log(spark, root).runs().collect()] == [made.index(True)]


def test_runs_that_end_at_the_same_time(spark, shop, tmp_path, monkeypatch):
    """A run that commits first is summed in by the other; a run over the same files stops the other."""
    landing, layout, dims = shop
    put(landing, "a.csv", feed(VALID, sale("2023-03-01", 10)))
    put(tmp_path, "other/b.csv", feed(VALID, sale("2023-03-02", 20), sale("2023-04-02", 5)))
    close = batch.close_run
    with monkeypatch.context() as patch:
        first = [str(tmp_path / "other")]
        patch.setattr(batch, "close_run", lambda *a: (run(spark, first.pop(), layout, dims) if first else None, close(*a))[1])
        run(spark, landing, layout, dims)
    assert totals(spark, layout) == [("2023-03", "1", "30.00"), ("2023-04", "1", "5.00")]
    put(landing, "c.csv", feed(VALID, sale("2023-03-03", 1)))
    with monkeypatch.context() as patch:
        again = [str(landing)]
        patch.setattr(batch, "close_run", lambda *a: (run(spark, again.pop(), layout, dims) if again else None, close(*a))[1])
        with pytest.raises(RuntimeError, match="another run has closed files"):
            run(spark, landing, layout, dims)
    assert totals(spark, layout) == [("2023-03", "1", "31.00"), ("2023-04", "1", "5.00")]
    assert stored_fact(spark, layout).count() == 4


def test_marts_are_published_once_for_many_micro_batches(spark, shop):
    landing, layout, dims = shop
    for number in range(3):
        put(landing, f"f{number}.csv", feed(VALID, sale(f"2023-03-0{number + 1}", 10), sale("2023-04-01", number)))
    asked = []
    load = lambda: asked.append(1) or dims
    ingest_available(spark, str(landing), layout, dimensions=load, files_per_batch=1, publish_every=None, keep_base_rows=False)
    assert totals(spark, layout) == [("2023-03", "1", "30.00"), ("2023-04", "1", "3.00")]
    assert len(asked) == 1 and len(batch.closed_runs(spark, layout)) == 3
    lines = batch.store_log(spark, layout).lines
    assert lines.where("part = 'sales_mart'").count() == 2 and lines.where("part = 'publishes'").count() == 3
    assert batch.publish_stored(spark, layout, dims) == []
    # What a stream has stored and not published is published with the next run.
    put(landing, "f3.csv", feed(VALID, sale("2023-05-01", 7)))
    ingest_available(spark, str(landing), layout)
    assert batch.has_stored(spark, layout) and len(totals(spark, layout)) == 2
    put(landing, "f4.csv", feed(VALID, sale("2023-04-02", 2)))
    assert run(spark, landing, layout, dims).months == ["2023-04", "2023-05"]
    assert totals(spark, layout) == [("2023-03", "1", "30.00"), ("2023-04", "1", "5.00"), ("2023-05", "1", "7.00")]


def test_compaction_changes_no_result(spark, shop):
    landing, layout, dims = shop

    def state():
        events = ledger_events(spark, layout)
        return (
            totals(spark, layout),
            as_text(ledger.latest_state(events, "file_key").drop("file_key")),
            as_text(stored_fact(spark, layout), "sales_date", "total_cost"),
            as_text(batch.rejected_files(spark, layout), "path"),
        )

    def opened():
        log = batch.store_log(spark, layout)
        return len(ledger_events(spark, layout).inputFiles()) + len(log.lines.inputFiles()) + len(log.folders("totals"))

    put(landing, "bad.csv", feed("a,b", "1,2"))
    for number in range(3):
        put(landing, f"f{number}.csv", feed(VALID, sale("2023-03-01", 10 + number)))
        run(spark, landing, layout, dims)
    before, many = state(), opened()
    assert batch.compact(spark, layout) == 3 and state() == before and opened() < many
    assert batch.compact(spark, layout) is None
    put(landing, "f3.csv", feed(VALID, sale("2023-03-01", 4), sale("2023-02-01", 1)))
    run(spark, landing, layout, dims)
    before = state()
    assert before[0] == [("2023-02", "1", "1.00"), ("2023-03", "1", "37.00")]
    batch.compact(spark, layout)
    few = opened()
    batch.drop_folded(spark, layout)
    assert state() == before and opened() == few <= 6
    assert len(list((landing.parent / "store" / "ledger_registered").glob("run_*"))) == 1
    assert run(spark, landing, layout, dims).status == "nothing"


def test_a_run_lists_its_own_folders_and_the_log(spark, shop, monkeypatch):
    landing, layout, dims = shop
    put(landing, "a.csv", feed(VALID, *[sale(f"2023-0{m}-01", m) for m in range(1, 7)]))
    run(spark, landing, layout, dims, run_epoch_ms=1000)
    listed, names = [], batch.list_names
    for module in (batch, runlog):
        monkeypatch.setattr(module, "list_names", lambda spark, folder: listed.append(folder) or names(spark, folder))
    put(landing, "b.csv", feed(VALID, sale("2023-03-02", 1)))
    run(spark, landing, layout, dims, run_epoch_ms=2000)
    own = {folder for folder in listed if "run_epoch_ms=2000" in folder}
    assert {f.rsplit("/", 1)[1] for f in set(listed) - own} == {"log", "runs_begun", "ledger_registered"}
    assert sorted(f.partition("store/")[2].partition("/")[0] for f in own) == ["customer_mart", "fact", "fact", "sales_mart", "totals"]
    assert ("2023-03", "1", "4.00") in totals(spark, layout) and len(totals(spark, layout)) == 6


def test_figures_ride_on_the_write(spark, tmp_path):
    context = spark.sparkContext

    def jobs(write, group):
        context.setJobGroup(group, group)
        write()
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(group))

    rows = spark.range(0, 1000, 1, 4).withColumn("odd", F.col("id") % 2 == 1)
    marked, counts = observe_counts(rows, odd=F.col("odd"), all=F.lit(True))
    plain = jobs(lambda: rows.write.parquet(f"{tmp_path}/plain"), "plain")
    assert jobs(lambda: (marked.write.parquet(f"{tmp_path}/marked"), counts()), "marked") == plain
    assert counts() == {"odd": 500, "all": 1000}
    marked, counts = observe_counts(rows.where(F.lit(False)), odd=F.col("odd"))
    marked.write.parquet(f"{tmp_path}/none")
    assert counts() == {"odd": 0}
