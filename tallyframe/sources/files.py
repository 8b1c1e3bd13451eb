"""Listing of landed files and reading of their header lines."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import base_name, strip_store
from tallyframe.session import scratch_path

HEADER_LINE = "path string, header_line string"
# The layout of the binary file source; only path, length and time are read.
FILE_LAYOUT = "path string, modificationTime timestamp, length bigint, content binary"
#: Characters after which a first line counts as no header.
HEADER_CHARACTERS = 65_536


def exact_paths(paths: Iterable[str]) -> list[str]:
    """Paths for a Spark reader, which takes ``[``, ``{``, ``*`` and ``?`` as patterns otherwise."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]


def as_uri(path: str) -> str:
    """The path as Arrow takes it; Hadoop's ``s3a`` and ``s3n`` are plain ``s3`` there."""
    return quote(re.sub("^s3[an]:", "s3:", path), safe="/:@")


def plain_path(path: str) -> str:
    return re.sub("^file:/+", "file:///", path)


def plain_path_column(path: Column) -> Column:
    # Most paths are plain as they come, and this is asked for every line.
    decoded = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    is_plain = ~F.startswith(decoded, F.lit("file:/")) | (F.startswith(decoded, F.lit("file:///")) & ~F.startswith(decoded, F.lit("file:////")))
    return F.when(is_plain, decoded).otherwise(F.regexp_replace(decoded, "^file:/+", "file:///"))


def files_frame(statuses: DataFrame) -> DataFrame:
    """(path, file_name, object_key, file_key) from (path, length, modificationTime).

    ``file_key`` tells files apart: one of the same name in another folder, or one that was replaced,
    is another file.
    """
    path = F.regexp_replace("path", "^file:/+", "file:///")
    modified = F.unix_millis("modificationTime").cast("string")
    return statuses.select(path.alias("path"), "length", modified.alias("modified")).select(
        "path",
        base_name("path").alias("file_name"),
        strip_store("path").alias("object_key"),
        F.concat_ws("|", "path", F.col("length").cast("string"), "modified").alias("file_key"),
    )


def list_files(spark: SparkSession, location: str, how: str | None = None) -> DataFrame:
    """(path, file_name, object_key, file_key) of every file under a location, empty files included.

    ``tasks`` expands folders level by level in tasks, as deep as they go; no name passes the driver. ``source``
    asks Spark's file source, whose listing sits in the driver. The argument, else the setting
    ``spark.tallyframe.listing``, says which; without either it is ``tasks`` for stores that give Arrow and Spark the same
    times of change (local files, S3), as the time is part of what a file is known by, and ``source`` for others and
    for a location that is a pattern. Both give the same files and keys.

    Spark does not show names that begin with ``_`` or ``.``, nor could it read such files; sales files
    among them are listed too, however deep they lie, so that they are judged like any other. Empty files have
    length 0 and no time. A location without files raises ``FileNotFoundError``.
    """
    how = how or spark.conf.get("spark.tallyframe.listing", None) or _listing_of(location)
    if how not in ("tasks", "source"):
        raise ValueError(f"files are listed by 'tasks' or 'source', not {how!r}")
    statuses = _statuses_in_tasks(spark, location) if how == "tasks" else _statuses_of_source(spark, location)
    if statuses.isEmpty():
        raise FileNotFoundError(f"no files under {location}")
    return files_frame(statuses)


def _listing_of(location: str) -> str:
    scheme = re.match(r"(?:(\w+):)?", location)[1] or "file"
    pattern = re.search(r"[*?\[{\\]", location)
    return "tasks" if scheme in ("file", "s3", "s3a", "s3n") and not pattern else "source"


def _qualified(spark: SparkSession, location: str) -> tuple:
    """The location's file system and its full name there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(location)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(root).toString()


def _statuses_in_tasks(spark: SparkSession, location: str) -> DataFrame:
    """Statuses by one job per level of folders; each level is a written table, so that a lost executor lists its
    folders of one level again. The driver knows how many folders a level has, and no names but the location's."""
    root = plain_path(_qualified(spark, location)[1])
    start = as_uri(root)

    def entries(batches):
        # Nested, so that it travels by value and workers need no copy of the package.
        import pyarrow as pa
        from pyarrow import fs

        def concealed(name, folder):
            # The names that Spark's file sources pass over, and those of folders that they look into.
            hides = name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")
            return hides and not (folder and name.startswith(("_common_metadata", "_metadata")))

        try:
            store, top = fs.FileSystem.from_uri(start)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
            raise RuntimeError(f"Arrow has no access to {root}; set spark.tallyframe.listing to source") from error
        top = top.rstrip("/")
        for batch in batches:
            for path, below_hidden in zip(batch.column("path").to_pylist(), batch.column("hidden").to_pylist(), strict=True):
                key = top + path[len(root) :]
                if path == root and store.get_file_info(key or "/").type == fs.FileType.File:
                    found = [store.get_file_info(key)]
                else:
                    found = store.get_file_info(fs.FileSelector(key or "/", allow_not_found=True))
                rows = []
                for info in found:
                    folder = info.type == fs.FileType.Directory
                    hidden = below_hidden or concealed(info.base_name, folder)
                    sales = info.base_name[:1] in ("_", ".") and info.base_name.endswith(".csv")
                    if folder or info.type == fs.FileType.File and (sales or not hidden):
                        at = None if folder else info.mtime_ns // 1_000_000
                        rows.append((root + info.path[len(top) :], hidden, folder, 0 if folder else info.size, at))
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds(pa), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "hidden", "folder", "length", "changed"])

    def kinds(pa):
        return [pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]

    table, most = scratch_path(spark, "listing"), 4 * spark.sparkContext.defaultParallelism
    folders, count, levels = spark.createDataFrame(pa.table({"path": [root], "hidden": [False]})), 1, 0
    layout = "path string, hidden boolean, folder boolean, length bigint, changed bigint"
    while count:
        written = f"{table}/level={levels}"
        folders.repartition(min(count, most)).mapInArrow(entries, layout).write.parquet(written)
        folders = spark.read.schema(layout).parquet(written).where("folder").select("path", "hidden")
        count, levels = folders.count(), levels + 1
    files = spark.read.schema(layout).parquet(*[f"{table}/level={n}" for n in range(levels)]).where("not folder")
    # An empty file is known by its name, as in the listing by the source.
    return files.select("path", "length", F.when(F.col("length") > 0, F.timestamp_millis("changed")).alias("modificationTime"))


def _statuses_of_source(spark: SparkSession, location: str) -> DataFrame:
    """Statuses from the file source, which lists in parallel and opens no file for them. It shows empty files by name
    only, and hidden ones not at all."""
    source = spark.read.schema(FILE_LAYOUT).format("binaryFile").option("recursiveFileLookup", "true").load(location)
    names = [plain_path(unquote(path)) for path in source.inputFiles()]
    known = source.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "length", "modificationTime")
    all_names = spark.createDataFrame(pa.table({"path": pa.array(names, pa.string())}))
    statuses = all_names.join(known, "path", "left").withColumn("length", F.coalesce("length", F.lit(0).cast("long")))
    # Names of metadata are shown and not read.
    name = F.substring_index("path", "/", -1)
    statuses = statuses.where(~(name.startswith("_") & ~name.contains("=")))
    shown = set(names)
    hidden = [row for row in hidden_files(spark, location) if "=" not in row[0].rsplit("/", 1)[1] or plain_path(row[0]) not in shown]
    if not hidden:
        return statuses
    kinds = "path string, length long, modificationTime timestamp"
    return statuses.unionByName(spark.createDataFrame(hidden, kinds))


def hidden_files(spark: SparkSession, location: str) -> list[tuple]:
    """Status of the sales files with names that Spark hides, level by level as long as a level has anything in it."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    store, root = _qualified(spark, location)
    level = exact_paths([root])[0]
    found = []
    while store.globStatus(to_path(f"{level}/*")):
        found += store.globStatus(to_path(f"{level}/[_.]*.csv"))
        level += "/*"
    return [
        (s.getPath().toString(), s.getLen(), datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc))
        for s in found
        if s.isFile()
    ]


def read_headers(files: DataFrame, how: str | None = None) -> DataFrame:
    """First non-blank line of each file, as (path, header_line); null for a file without one.

    ``open`` reads the first bytes of each file in tasks spread over the files and costs the
    same for a small and a huge file, but needs a store that Arrow can open with the
    credentials of the executors. ``scan`` works on every store that Spark reads, at the price of
    a pass over the text. Which of them it is depends on the argument or the setting
    ``spark.tallyframe.headers`` alone, by default ``open``: a store that Arrow cannot open stops the
    read with a message, since a scan would silently read everything twice.

    Both end lines at LF, CR LF or CR, skip lines of white space, and give the first
    ``HEADER_CHARACTERS`` + 1 characters of a longer line, which the contract check turns down.
    """
    paths = files.select("path")
    if how is None:
        how = files.sparkSession.conf.get("spark.tallyframe.headers", "open")
    if how not in ("open", "scan"):
        raise ValueError(f"headers are read by 'open' or 'scan', not {how!r}")
    return _open_headers(paths) if how == "open" else _scan_headers(paths)


def _open_headers(paths: DataFrame) -> DataFrame:
    most = HEADER_CHARACTERS

    def first_lines(batches):
        # Nested, so that it travels by value and workers need no copy of the package.
        import re
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        def first_line(path):
            try:
                store, key = fs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", path), safe="/:@"))
                stream = store.open_input_stream(key, compression=None)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
                raise RuntimeError(f"Arrow has no access to {path}; set spark.tallyframe.headers to scan") from error
            # A character has four bytes at most, so the line ends or is too long within a fixed length.
            pending, first = b"", True
            with stream:
                while True:
                    block = stream.read(16384)
                    *lines, rest = re.split(b"[\r\n]", pending + block)
                    for line in lines if block else [*lines, rest]:
                        text = line.decode("utf-8-sig" if first else "utf-8", errors="replace")
                        first = False
                        if text.strip():
                            return text[: most + 1]
                    if not block:
                        return None
                    if len(rest) > 4 * most and rest.strip():
                        return rest.decode("utf-8-sig", errors="replace")[: most + 1]
                    pending = rest if rest.strip() else b""

        for batch in batches:
            names = batch.column("path").to_pylist()
            lines = [first_line(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(lines, pa.string())], ["path", "header_line"]
            )

    return paths.mapInArrow(first_lines, HEADER_LINE)


def _scan_headers(paths: DataFrame) -> DataFrame:
    spark = paths.sparkSession
    names = [row.path for row in paths.collect()]
    if not names:
        return spark.createDataFrame([], HEADER_LINE)
    first = (
        spark.read.text(exact_paths(names))
        .where((F.col("_metadata.file_block_start") == 0) & F.col("value").rlike(r"\S"))
        .select(
            plain_path_column(F.col("_metadata.file_path")).alias("path"),
            F.substring("value", 1, HEADER_CHARACTERS + 1).alias("value"),
            F.monotonically_increasing_id().alias("line"),
        )
        .groupBy("path")
        .agg(F.min_by("value", "line").alias("header_line"))
    )
    return paths.join(first, "path", "left")
