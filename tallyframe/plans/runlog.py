"""The log of a store: which runs count, in which order, and which folders each of them has written.

A commit is one small file with the next number, created only if no file has that name: of two runs that end at the
same time one gets the number, and the other looks again at what it has missed. The order of the commits is the order of
the runs, whatever their own numbers or the clocks of their machines say. Its lines, one per folder and month, are the
index by which readers find the folders of a month without listing others.

Commits are folded into a base from time to time: a table of what still holds, and a pointer that is written
last, again under a name of its own. Readers take the newest base and the commits after it.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sinks.files import list_names, write_frame

#: A line of a commit: a folder that a run has written, for a month or as a whole; ``of`` names another run.
LINE = "seq long, run_epoch_ms long, part string, month string, path string, of long"


@dataclass(frozen=True)
class Line:
    part: str
    run_epoch_ms: int
    month: str | None = None
    path: str | None = None
    of: int | None = None


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole text; False where a file of that name exists already.

    Local files appear by a hard link and those of HDFS by a rename, both of which refuse an existing name; other
    stores create conditionally, and show a file once it is complete."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme = store.getUri().getScheme()
    if scheme == "file":
        name = target.toUri().getPath()
        os.makedirs(os.path.dirname(name), exist_ok=True)
        draft = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(draft, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    if scheme in ("hdfs", "viewfs"):
        draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
        _put(store.create(draft, False), text)
        return store.rename(draft, target) or (store.delete(draft, False) and False)
    try:
        _put(store.createFile(target).overwrite(False).recursive().build(), text)
    except Exception as error:
        if store.exists(target):
            return False
        raise error
    return True


def _put(stream, text: str) -> None:
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def claim_run(spark: SparkSession, root: str, wanted: int | None = None) -> int:
    """A run number that no other run has or gets: the wanted one or the present second in ms, or the next above all
    numbers that were ever claimed."""
    folder = f"{root}/runs_begun"
    number = int(time.time()) * 1000 if wanted is None else wanted
    taken = max((int(name) for name in list_names(spark, folder)), default=0)
    while True:
        number = max(number, taken + 1)
        if create_once(spark, f"{folder}/{number:020d}", ""):
            return number
        taken = number


@dataclass(frozen=True)
class Log:
    """The state of a log at one commit: its number, that of its base, and the lines that hold."""

    root: str
    seq: int
    base: int
    lines: DataFrame

    def runs(self) -> DataFrame:
        return self.lines.where(F.col("part") == "run").select("run_epoch_ms")

    def folders(self, *parts: str, months: Iterable[str | None] | None = None, runs: Sequence[int] | None = None) -> list[str]:
        """Folders of some parts, of all or of some months, of all or of some runs; others are never listed."""
        found = self.lines.where(F.col("part").isin(*parts))
        if months is not None:
            known = [m for m in months if m is not None]
            found = found.where(F.col("month").isin(known) | (F.col("month").isNull() if None in months else F.lit(False)))
        if runs is not None:
            found = found.where(F.col("run_epoch_ms").isin(list(runs)))
        return [f"{self.root}/{row.path}" for row in found.select("path").orderBy("path").collect()]

    def newest(self, part: str) -> list[str]:
        """The newest folder of every month."""
        found = self.lines.where(F.col("part") == part).groupBy("month").agg(F.max_by("path", "seq").alias("path"))
        return [f"{self.root}/{row.path}" for row in found.orderBy("path").collect()]

    def unpublished(self) -> list[int]:
        """Closed runs whose rows are in no mart yet."""
        stored = self.lines.where(F.col("part") == "fact_ok").select("run_epoch_ms").distinct()
        done = self.lines.where(F.col("part") == "publishes").select(F.col("of").alias("run_epoch_ms"))
        return sorted(row.run_epoch_ms for row in stored.join(done, "run_epoch_ms", "left_anti").collect())


def read_log(spark: SparkSession, root: str) -> Log:
    """The newest base and the commits after it. Bases and commits are listed, no other folder is."""
    folder = f"{root}/log"
    names = [name for name in list_names(spark, folder) if name.endswith(".json")]
    bases = sorted(name for name in names if name.startswith("base-"))
    base = int(bases[-1][5:-5]) if bases else 0
    tail = sorted(name for name in names if not name.startswith("base-") and int(name[:-5]) > base)
    lines = spark.read.schema(LINE).json([f"{folder}/{name}" for name in tail]) if tail else spark.createDataFrame([], LINE)
    if bases:
        held = spark.read.text(f"{folder}/{bases[-1]}").first()["value"]
        lines = spark.read.schema(LINE).parquet(f"{root}/{json.loads(held)['folder']}/lines").unionByName(lines)
    return Log(root, int(tail[-1][:-5]) if tail else base, base, lines)


def commit(spark: SparkSession, root: str, seq: int, lines: Sequence[Line]) -> bool:
    """Write the commit of this number; False where another run has been faster."""
    text = "\n".join(json.dumps({"seq": seq} | asdict(line)) for line in lines)
    return create_once(spark, f"{root}/log/{seq:020d}.json", text)


def point_to_base(spark: SparkSession, root: str, seq: int, folder: str, lines: DataFrame) -> bool:
    """Make a written base the one that readers take. Two that fold the same commits leave the first."""
    write_frame(lines.coalesce(1), f"{root}/{folder}/lines")
    return create_once(spark, f"{root}/log/base-{seq:020d}.json", json.dumps({"folder": folder}))
