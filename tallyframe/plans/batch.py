"""One run: landed files to fact, fact to marts, and the ledger around both.

A run writes into folders of its own: its fact rows, its matched rows, its totals by month, the months of
the marts that it touches. A commit to the store's log, written last, makes them count, and gives the run its place in
the order of all runs. A run that dies half way shows nowhere, and its files are still pending. Run numbers are claimed
and never used twice. A run that finds at its commit that another one has been faster sums its months again with the
other's totals; if the other one has closed the same files, it stops.

A month that arrives in several runs is summed from the totals of these runs; no fact row is read again. What
a run could not match stays in its quarantine and in no mart, so the rows of a run are those in the marts, the
rejected and the unmatched. Runs may also only store their rows; ``publish_stored`` then brings the marts up to date with all
of them at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import month_of
from tallyframe.operators import ledger, marts
from tallyframe.operators.conform import header_groups, parse_files
from tallyframe.operators.contract import OK, bad_files, check_files, good_files, quarantine_lines
from tallyframe.operators.dimensions import enrich, repeated_keys, unmatched
from tallyframe.operators.metrics import observe_counts
from tallyframe.plans.runlog import LINE, Line, Log, claim_run, commit, point_to_base, read_log
from tallyframe.schema import LEDGER_EVENT, SALES_FACT, TOTAL
from tallyframe.sinks.files import (
    drop_paths,
    list_names,
    literal,
    snapshot_folder,
    write_frame,
    write_partitioned,
    write_snapshot,
)
from tallyframe.sinks.jdbc import replace_months
from tallyframe.sources.files import exact_paths, list_files
from tallyframe.sources.jdbc import keep_table, read_table

STORED_FACT = T.StructType(
    [
        *SALES_FACT.fields,
        T.StructField("source_file", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw_record", T.StringType()),
        T.StructField("row_state", T.StringType()),
        T.StructField("sales_month", T.StringType()),
        T.StructField("run_epoch_ms", T.LongType()),
    ]
)
#: What tells files apart in the ledger: path, length and time of change.
KEY = "file_key"
RUN_LEDGER = T.StructType([*LEDGER_EVENT.fields, T.StructField(KEY, T.StringType())])
# Totals of the matched sales of one run: what the marts are made of.
TOTALS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("total_cost", TOTAL),
        T.StructField("sales_month", T.StringType()),
    ]
)
# Fixed value: the folder name that Spark gives to a null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


# The mart layouts.
CUSTOMER_MART = (
    "customer_id long, full_name string, address string, phone_number string, sales_date_month string, total_sales decimal(18,2)"
)
SALES_MART = (
    "store_id long, sales_person_id long, full_name string, sales_month string, total_sales decimal(18,2), incentive decimal(18,4)"
)


@dataclass(frozen=True)
class Layout:
    """Folders of one mart store, all below a root that every executor reaches."""

    root: str

    @property
    def base(self) -> str:
        return self.root.rstrip("/")

    def folder(self, name: str) -> str:
        return f"{self.base}/{name}"


@dataclass(frozen=True)
class Dimensions:
    customer: DataFrame
    store: DataFrame
    sales_team: DataFrame

    def check(self) -> None:
        """Repeated keys would multiply sales, so they stop the run."""
        for name, frame, key in (
            ("customer", self.customer, "customer_id"),
            ("store", self.store, "id"),
            ("sales_team", self.sales_team, "id"),
        ):
            if repeated_keys(frame, key).head(1):
                raise ValueError(f"dimension {name} has rows with the same {key}")


@dataclass(frozen=True)
class Database:
    """Where the dimensions come from and the marts go besides the files.

    The properties hold driver and credentials and come from the caller.
    """

    url: str
    properties: Mapping[str, str]
    customer_table: str = "customer"
    store_table: str = "store"
    sales_team_table: str = "sales_team"
    customer_mart_table: str = "customers_data_mart"
    sales_mart_table: str = "sales_team_data_mart"


@dataclass
class RunReport:
    run_epoch_ms: int
    n_good_files: int = 0
    n_bad_files: int = 0
    n_good_rows: int = 0
    n_bad_rows: int = 0
    n_unmatched_rows: int = 0
    months: list[str | None] = field(default_factory=list)
    interrupted: list[str] = field(default_factory=list)
    #: ``done``; ``nothing`` without new files; ``rejected`` when none of the new files was good.
    status: str = "nothing"


def load_dimensions(spark: SparkSession, database: Database, layout: Layout, rows_per_task: int = 1_000_000) -> Dimensions:
    """Copy the dimension tables to the store, a large one in key ranges, and go on with the copy."""

    def copy(table: str, key: str) -> DataFrame:
        source = read_table(spark, database.url, table, database.properties, key=key, rows_per_task=rows_per_task)
        return keep_table(source, f"{layout.folder('dimensions')}/{table}")

    return Dimensions(
        customer=copy(database.customer_table, "customer_id"),
        store=copy(database.store_table, "id"),
        sales_team=copy(database.sales_team_table, "id"),
    )


def store_log(spark: SparkSession, layout: Layout) -> Log:
    return read_log(spark, layout.base)


def _read(spark: SparkSession, schema: T.StructType | str, paths: list[str], root: str | None = None) -> DataFrame:
    """The tables of some folders; without any an empty one."""
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return (reader if root is None else reader.option("basePath", root)).parquet(*exact_paths(paths))


def ledger_events(spark: SparkSession, layout: Layout, log: Log | None = None) -> DataFrame:
    """All registrations, and the closing events of the runs that count."""
    log = log or store_log(spark, layout)
    # Runs that have begun and not ended are in no commit; those that were folded are only listed until they are dropped.
    root = layout.folder("ledger_registered")
    names = [int(name.partition("=")[2]) for name in list_names(spark, root)]
    begun = []
    if names:
        numbers = spark.createDataFrame([(n,) for n in names], "run_epoch_ms long")
        begun = [snapshot_folder(root, row[0]) for row in numbers.join(log.runs(), "run_epoch_ms", "left_anti").collect()]
    paths = [*begun, *log.folders("ledger_registered", "ledger_closed", "ledger")]
    return _read(spark, RUN_LEDGER, paths).select(*RUN_LEDGER.names)


REJECTED = f"{KEY} string, path string, reason string"


def rejected_files(spark: SparkSession, layout: Layout, log: Log | None = None) -> DataFrame:
    """``file_key`` and ``reason`` of the files that a run has turned down; they are looked at once."""
    log = log or store_log(spark, layout)
    return _read(spark, REJECTED, log.folders("files_rejected"))


def quarantined_lines(spark: SparkSession, layout: Layout) -> DataFrame:
    """The text of the files that were turned down, of all runs that count."""
    paths = store_log(spark, layout).folders("quarantine_files")
    return _read(spark, "file_name string, reason string, line string", paths)


def pending_files(spark: SparkSession, layout: Layout, landed: DataFrame, events: DataFrame) -> DataFrame:
    """Landed files that no run has finished or turned down."""
    open_files = ledger.pending(landed, events, KEY)
    return open_files.join(rejected_files(spark, layout).select(KEY), KEY, "left_anti")


def written_months(spark: SparkSession, layout: Layout, part: str, run: int, folder: str) -> list[Line]:
    """The month folders below a folder that this run has written; those of other runs are not looked at."""
    lines = []
    for name in list_names(spark, layout.folder(folder)):
        if "=" in name:
            value = unquote(name.partition("=")[2])
            lines.append(Line(part, run, None if value == NULL_FOLDER else value, f"{folder}/{name}"))
    return lines


def read_fact(spark: SparkSession, layout: Layout, folders: list[str]) -> DataFrame:
    return _read(spark, STORED_FACT, folders, layout.folder("fact"))


def stored_fact(spark: SparkSession, layout: Layout, row_state: str = "ok") -> DataFrame:
    """The rows of all finished runs; the rejected ones with ``row_state="rejected"``."""
    return read_fact(spark, layout, store_log(spark, layout).folders(f"fact_{row_state}"))


def closed_runs(spark: SparkSession, layout: Layout) -> list[int]:
    """Numbers of the runs that count and have taken files."""
    return sorted(row.run_epoch_ms for row in store_log(spark, layout).runs().collect())


def take_in(spark: SparkSession, files: DataFrame, layout: Layout, run: int) -> tuple[RunReport, list[Line]]:
    """Check the files, register the good ones, and store their rows and the rejects; the lines of the run's commit.

    The text is parsed once: accepted and rejected rows go to different folders in one write. All figures of the
    report are observed in the writes.
    """
    report, lines = RunReport(run), [Line("run", run)]
    checks, ok = layout.folder("checks"), F.col("verdict") == OK
    counted, counts = observe_counts(check_files(files), good=ok, bad=~ok)
    write_snapshot(counted, checks, run)
    report.n_good_files, report.n_bad_files = counts().values()
    checked = spark.read.parquet(snapshot_folder(checks, run))

    def keep(rows: DataFrame, part: str) -> None:
        write_snapshot(rows, layout.folder(part), run)
        lines.append(Line(part, run, path=snapshot_folder(part, run)))

    if report.n_bad_files:
        text = quarantine_lines(checked)
        if text is not None:
            keep(text, "quarantine_files")
        keep(bad_files(checked).select(KEY, "path", "reason"), "files_rejected")
    if not report.n_good_files:
        report.status = "rejected" if report.n_bad_files else "nothing"
        return report, lines
    report.status = "done"
    keep(ledger.register_files(good_files(checked), F.current_timestamp(), F.lit(run), [KEY]), "ledger_registered")
    fits = F.col("fits")
    parsed, counts = observe_counts(parse_files(spark, header_groups(checked)), good=fits, bad=~fits)
    parsed = (
        parsed.withColumn("row_state", F.when(fits, "ok").otherwise("rejected"))
        .withColumn("sales_month", F.when(fits, month_of("sales_date")))
        .drop("fits")
    )
    folder = snapshot_folder("fact", run)
    write_partitioned(parsed, layout.folder(folder), ["row_state", "sales_month"])
    report.n_good_rows, report.n_bad_rows = counts().values()
    for state in ("ok", "rejected"):
        lines += written_months(spark, layout, f"fact_{state}", run, f"{folder}/row_state={state}")
    return report, lines


def publish(
    spark: SparkSession,
    layout: Layout,
    dimensions: Dimensions,
    run: int,
    own: list[Line] = (),
    database: Database | None = None,
    keep_base_rows: bool = True,
) -> tuple[list[str | None], int]:
    """Bring the marts up to date with the rows of this run and of all runs that are only stored, and commit.

    Each month that these rows touch is summed from the totals of all runs that count and of this one. Gives the
    months, and how many rows matched no dimension. Where another run commits first, its totals are missing in these sums, so
    they are made again.
    """
    dimensions.check()
    while True:
        log = store_log(spark, layout)
        queue = log.unpublished()
        stored = [layout.folder(line.path) for line in own if line.part == "fact_ok"]
        stored += log.folders("fact_ok", runs=queue) if queue else []
        months = sorted({_month_in(path) for path in stored}, key=lambda month: month or "")
        lost, lines = _sum_up(spark, layout, dimensions, run, read_fact(spark, layout, stored), keep_base_rows)
        totals = month_totals(spark, layout, log, months, [line for line in lines if line.part == "totals"])
        star = (dimensions.customer, dimensions.store, dimensions.sales_team)
        for part, mart, month in (("customer_mart", marts.customer_mart, "sales_date_month"), ("sales_mart", marts.sales_mart, "sales_month")):
            write_snapshot(mart(totals, *star), layout.folder(part), run, by=[month])
            lines += written_months(spark, layout, part, run, snapshot_folder(part, run))
        done = {line.run_epoch_ms for line in own if line.part == "fact_ok"} | set(queue)
        lines += [Line("publishes", run, of=number) for number in sorted(done)]
        if close_run(spark, layout, run, log, [*own, *lines]):
            break
    if database is not None:
        export_months(spark, layout, database, months)
    return months, lost


def _month_in(path: str) -> str | None:
    value = unquote(path.rstrip("/").rpartition("sales_month=")[2])
    return None if value == NULL_FOLDER else value


def _sum_up(spark: SparkSession, layout: Layout, dimensions: Dimensions, run: int, rows: DataFrame, keep_base_rows: bool) -> tuple[int, list[Line]]:
    """Write what the rows come to: those without a dimension, matched rows, totals by month."""
    star = (dimensions.customer, dimensions.store, dimensions.sales_team)
    lost, counts = observe_counts(unmatched(rows.select(*SALES_FACT.names), *star), n=F.lit(True))
    write_snapshot(lost, layout.folder("quarantine_keys"), run)
    lines = [Line("quarantine_keys", run, path=snapshot_folder("quarantine_keys", run))]
    matched = enrich(rows, *star).withColumn("sales_month", month_of("sales_date"))
    if keep_base_rows:
        # Written once; both sets of base rows are columns of it. Single rows do not change with later runs.
        write_snapshot(matched.sortWithinPartitions("sales_month", "store_id"), layout.folder("matched_rows"), run)
        lines.append(Line("matched_rows", run, path=snapshot_folder("matched_rows", run)))
        matched = spark.read.schema(matched.schema).parquet(layout.folder(lines[-1].path))
    totals = matched.groupBy("customer_id", "store_id", "sales_person_id", "sales_month").agg(
        F.sum("total_cost").cast(TOTAL).alias("total_cost")
    )
    folder = snapshot_folder("totals", run)
    _write_totals(totals, layout.folder(folder))
    return counts()["n"], lines + written_months(spark, layout, "totals", run, folder)


def _write_totals(totals: DataFrame, folder: str) -> None:
    """One folder per month. Files hold their month too, so that folders of runs and bases are read together."""
    write_partitioned(totals.select(*TOTALS.names).withColumn("month", F.col("sales_month")), folder, ["month"])


def month_totals(spark: SparkSession, layout: Layout, log: Log, months: list[str | None], own: list[Line]) -> DataFrame:
    """The totals of some months over all runs that count and the own ones, as a fact with the first day of each month."""
    folders = log.folders("totals", months=months) if months else []
    totals = _read(spark, TOTALS, [*folders, *(layout.folder(line.path) for line in own)])
    day = F.concat("sales_month", F.lit("-01")).cast("date")
    return totals.select("customer_id", "store_id", "sales_person_id", day.alias("sales_date"), "total_cost")


def has_stored(spark: SparkSession, layout: Layout) -> bool:
    """Whether runs wait to be published."""
    return bool(store_log(spark, layout).unpublished())


def publish_stored(
    spark: SparkSession, layout: Layout, dimensions: Dimensions, database: Database | None = None, keep_base_rows: bool = True
) -> list[str | None]:
    """Bring the marts up to date with all runs that are only stored: every month that they touch once, whatever their number."""
    if not has_stored(spark, layout):
        return []
    run = claim_run(spark, layout.base)
    return publish(spark, layout, dimensions, run, database=database, keep_base_rows=keep_base_rows)[0]


def export_months(spark: SparkSession, layout: Layout, database: Database, months: list[str | None]) -> None:
    """Bring the given months of the mart tables to the state of the files. Files are the truth: a failed
    export is made good by calling this again, and one that comes late leaves what a later state has brought."""
    log = store_log(spark, layout)
    for name, table, month in (
        ("customer_mart", database.customer_mart_table, "sales_date_month"),
        ("sales_mart", database.sales_mart_table, "sales_month"),
    ):
        rows = read_mart(spark, layout, name, log)
        replace_months(rows, database.url, table, database.properties, month, months, token=log.seq)


def close_run(spark: SparkSession, layout: Layout, run: int, log: Log, lines: list[Line]) -> bool:
    """Close the good files of a run and commit. From here on its rows count; False where another run was faster.

    The events may be many. What makes them count is the commit, a single file, which is there or not.
    """
    lines = list(lines)
    if any(line.part == "ledger_registered" for line in lines):
        closing = good_files(spark.read.parquet(snapshot_folder(layout.folder("checks"), run)))
        taken = ledger.latest_state(ledger_events(spark, layout, log), KEY).where(F.col("status") == "I")
        if closing.join(taken, KEY, "left_semi").head(1):
            raise RuntimeError(f"another run has closed files of run {run} meanwhile; nothing of this run counts")
        write_snapshot(
            ledger.close_files(closing, F.current_timestamp(), F.lit(run), [KEY]), layout.folder("ledger_closed"), run
        )
        lines.append(Line("ledger_closed", run, path=snapshot_folder("ledger_closed", run)))
    return commit(spark, log.root, log.seq + 1, lines)


def store_run(spark: SparkSession, layout: Layout, run: int, lines: list[Line]) -> None:
    """Commit a run without publishing it."""
    while not close_run(spark, layout, run, store_log(spark, layout), lines):
        pass


def read_base_rows(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The enriched rows behind a mart, ``sales_rows`` or ``customer_rows``, of all published runs."""
    base = {"sales_rows": marts.sales_base, "customer_rows": marts.customer_base}[name]
    paths = store_log(spark, layout).folders("matched_rows")
    if not paths:
        raise FileNotFoundError("no run has kept its matched rows")
    rows = spark.read.option("basePath", layout.folder("matched_rows")).parquet(*exact_paths(paths))
    return rows.select(*base(rows).columns, "run_epoch_ms")


def read_mart(spark: SparkSession, layout: Layout, name: str, log: Log | None = None) -> DataFrame:
    """A published mart with its columns in mart order."""
    columns = {"customer_mart": CUSTOMER_MART, "sales_mart": SALES_MART}[name]
    layout_of, root = T.StructType.fromDDL(columns), layout.folder(name)
    newest = (log or store_log(spark, layout)).newest(name)
    return _read(spark, layout_of, newest, root).select(*layout_of.names)


def run_batch(
    spark: SparkSession,
    landing: str,
    layout: Layout,
    dimensions: Dimensions,
    run_epoch_ms: int | None = None,
    on_interrupted: str = "rerun",
    database: Database | None = None,
    keep_base_rows: bool = True,
) -> RunReport:
    """Process every landed file that no earlier run has finished.

    ``on_interrupted`` says what to do with files that an earlier run began and did not
    finish: ``rerun`` takes them again, ``fail`` refuses to go on.
    """
    if on_interrupted not in ("rerun", "fail"):
        raise ValueError("on_interrupted must be 'rerun' or 'fail'")
    log = store_log(spark, layout)
    if run_epoch_ms is not None and log.runs().where(F.col("run_epoch_ms") == run_epoch_ms).head(1):
        raise ValueError(f"run {run_epoch_ms} is finished already")
    dimensions.check()
    landed = list_files(spark, landing)
    events = ledger_events(spark, layout, log)
    interrupted = sorted(row.file_name for row in ledger.active_landed(landed, events, KEY).collect())
    if interrupted and on_interrupted == "fail":
        raise RuntimeError(f"the last run did not finish {len(interrupted)} files, first {interrupted[0]}")

    run = claim_run(spark, log.root, run_epoch_ms)
    report, lines = take_in(spark, pending_files(spark, layout, landed, events), layout, run)
    report.interrupted = interrupted
    if report.n_good_files:
        report.months, report.n_unmatched_rows = publish(spark, layout, dimensions, run, lines, database, keep_base_rows)
    elif report.n_bad_files:
        store_run(spark, layout, run, lines)
    return report


def take_files(
    spark: SparkSession,
    landed: DataFrame,
    layout: Layout,
    dimensions: Dimensions | Callable[[], Dimensions] | None,
    database: Database | None = None,
    keep_base_rows: bool = True,
) -> RunReport | None:
    """A run over given files, as a stream hands them over: those that no run has finished or turned
    down. Dimensions may be a function, which is asked at each run; without any the rows are only stored."""
    files = pending_files(spark, layout, landed, ledger_events(spark, layout))
    if files.isEmpty():
        return None
    run = claim_run(spark, layout.base)
    report, lines = take_in(spark, files, layout, run)
    if report.n_good_files and dimensions is not None:
        current = dimensions() if callable(dimensions) else dimensions
        report.months, report.n_unmatched_rows = publish(spark, layout, current, run, lines, database, keep_base_rows)
    else:
        store_run(spark, layout, run, lines)
    return report


def compact(spark: SparkSession, layout: Layout) -> int | None:
    """Fold all commits into a base: the ledger's state, the files that were turned down, the totals of each month, and of
    the marts the newest folders. Gives the number of the last commit that is folded, None if there is nothing new.

    Readers and runs may go on meanwhile: they use the old base and its commits until the new one is pointed to, and
    what is folded stays until ``drop_folded``.
    """
    log = store_log(spark, layout)
    if log.seq == log.base:
        return None
    folder = f"bases/{log.seq:020d}-{uuid.uuid4().hex}"
    lines = log.lines.where(~F.col("part").isin("ledger_registered", "ledger_closed", "ledger", "files_rejected", "totals"))
    newest = F.max("seq").over(Window.partitionBy("part", "month"))
    is_mart = F.col("part").isin("customer_mart", "sales_mart")
    lines = lines.withColumn("newest", newest).where(~is_mart | (F.col("seq") == F.col("newest"))).drop("newest")

    events = _read(spark, RUN_LEDGER, log.folders("ledger_registered", "ledger_closed", "ledger"))
    order, whole = F.struct("event_time", "event_id"), F.struct(*RUN_LEDGER.names)
    closing = F.when(F.col("status") == "I", order)
    # What the latest state is made of: the first, the last, and the last closing event of each file.
    kept = F.array(F.min_by(whole, order), F.max_by(whole, order), F.max_by(whole, closing))
    state = events.groupBy(KEY).agg(F.array_distinct(F.array_compact(kept)).alias("kept"))
    write_frame(state.select(F.inline("kept")), layout.folder(f"{folder}/ledger"))
    write_frame(rejected_files(spark, layout, log).distinct(), layout.folder(f"{folder}/files_rejected"))
    totals = _read(spark, TOTALS, log.folders("totals"))
    keys = ["customer_id", "store_id", "sales_person_id", "sales_month"]
    totals = totals.groupBy(*keys).agg(F.sum("total_cost").cast(TOTAL).alias("total_cost"))
    _write_totals(totals, layout.folder(f"{folder}/totals"))

    fresh = [Line(part, 0, path=f"{folder}/{part}") for part in ("ledger", "files_rejected")]
    fresh += written_months(spark, layout, "totals", 0, f"{folder}/totals")
    rows = [(log.seq, line.run_epoch_ms, line.part, line.month, line.path, line.of) for line in fresh]
    point_to_base(spark, log.root, log.seq, folder, lines.unionByName(spark.createDataFrame(rows, LINE)))
    return log.seq


def drop_folded(spark: SparkSession, layout: Layout) -> None:
    """Remove what the base before the newest one has folded; whoever reads by that base or an older one must be done."""
    names = [name for name in list_names(spark, layout.folder("log")) if name.endswith(".json")]
    bases = sorted(int(name[5:-5]) for name in names if name.startswith("base-"))
    if len(bases) < 2:
        return
    before = bases[-2]
    known = store_log(spark, layout).lines
    runs = known.where((F.col("part") == "run") | (F.col("part") == "publishes")).where(F.col("seq") <= before).select("run_epoch_ms").distinct()
    for part in ("ledger_registered", "ledger_closed", "files_rejected", "totals"):
        listed = [(int(name.partition("=")[2]),) for name in list_names(spark, layout.folder(part))]
        if listed:
            gone = spark.createDataFrame(listed, "run_epoch_ms long").join(runs, "run_epoch_ms", "left_semi").collect()
            for row in gone:
                drop_paths(spark, literal(snapshot_folder(layout.folder(part), row.run_epoch_ms)))
    for name in names:
        if (int(name[5:-5]) < before) if name.startswith("base-") else (int(name[:-5]) <= before):
            drop_paths(spark, literal(f"{layout.folder('log')}/{name}"))
    for name in list_names(spark, layout.folder("bases")):
        if int(name.partition("-")[0]) < before:
            drop_paths(spark, literal(f"{layout.folder('bases')}/{name}"))
    for name in list_names(spark, layout.folder("runs_begun"))[:-1]:
        drop_paths(spark, literal(f"{layout.folder('runs_begun')}/{name}"))
