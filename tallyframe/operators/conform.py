"""Sales files of any accepted header to the one fact layout."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import fold_cells, to_day, to_money, to_whole_number
from tallyframe.operators.contract import good_files
from tallyframe.schema import ADDITIONAL_COLUMN, SALES_CONTRACT, SALES_FACT
from tallyframe.sources.files import exact_paths, plain_path_column


@dataclass
class HeaderGroup:
    """Files with the same header, cell for cell; ``keys`` tells the state in which each file was checked."""

    cells: tuple[str, ...]
    header: tuple[str, ...]
    paths: list[str] = field(default_factory=list)
    keys: list[str | None] = field(default_factory=list)


def header_groups(checked: DataFrame) -> list[HeaderGroup]:
    """Good files by exact header. Only file names reach the driver, as for any Spark read."""
    groups: dict[tuple[str, ...], HeaderGroup] = {}
    good = good_files(checked)
    file_key = F.col("file_key") if "file_key" in good.columns else F.lit(None).cast("string").alias("file_key")
    for row in good.select("cells", "header", "path", file_key).collect():
        key = tuple(row.cells)
        group = groups.setdefault(key, HeaderGroup(key, tuple(row.header)))
        group.paths.append(row.path)
        group.keys.append(row.file_key)
    return [groups[key] for key in sorted(groups)]


def parse_files(spark: SparkSession, groups: list[HeaderGroup]) -> DataFrame:
    """All rows of the good files: the fact columns, and per row its file and its faults.

    Besides the fact columns the frame has ``source_file``, ``fits``, and for rows that do not fit
    ``reason`` and ``raw_record`` (as JSON). A value does not fit that is no number, whole number or day
    of its column; money with a third decimal, or a date without a day, would be changed by the cast, so they do
    not fit either. A row with too few or too many cells does not fit as a whole: ``raw_record`` then holds its line.

    Headers are rows of a small table, not plans: lines are read once, whatever the number of headers, and each line's
    cells are placed by the header of its own file. A line is cut into as many cells as the widest header has, so headers
    of very different widths go by classes of width, of which there are ``len(WIDTHS)`` at most, each with a scan of
    its own. The read stops if a file is not in the state in which its header was checked.
    """
    classes: dict[int, list[HeaderGroup]] = {}
    for group in groups:
        width = next(w for w in WIDTHS if len(group.header) <= w)
        classes.setdefault(width, []).append(group)
    parts = [_parse_class(spark, width, classes[width]) for width in sorted(classes)]
    if not parts:
        layout = T.StructType(
            [
                *SALES_FACT.fields,
                T.StructField("source_file", T.StringType()),
                T.StructField("fits", T.BooleanType()),
                T.StructField("reason", T.StringType()),
                T.StructField("raw_record", T.StringType()),
            ]
        )
        return spark.createDataFrame([], layout)
    return reduce(DataFrame.unionByName, parts)


def accepted_rows(parsed: DataFrame) -> DataFrame:
    """Rows whose values all fit, in fact layout plus ``source_file``."""
    return parsed.where("fits").select(*SALES_FACT.names, "source_file")


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """Rows with a value that does not fit, or with too few or too many cells, as (source_file, reason, raw_record)."""
    return parsed.where(~F.col("fits")).select("source_file", "reason", "raw_record")


def conform(spark: SparkSession, checked: DataFrame) -> DataFrame:
    """Checked files to the sales fact in one call."""
    return accepted_rows(parse_files(spark, header_groups(checked))).select(*SALES_FACT.names)


# Columns of a line as read, the mark after a line's last cell, a character that parts no cells, and the
# classes of widths (a header line of bounded length has fewer cells than the last).
LINE, BAD_LINE, END, NO_SEPARATOR = "tallyframe_line", "tallyframe_bad_line", "\x02tallyframe end\x02", "\x01"
WIDTHS = tuple(16 * 4**k for k in range(7))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line, source_file, length, modified) of every line but blank ones and each file's header."""
    layout = T.StructType([T.StructField(LINE, T.StringType()), T.StructField(BAD_LINE, T.StringType())])
    raw = (
        spark.read.schema(layout)
        .option("header", True)
        # The one column of this layout is no file's header; states are compared instead.
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("columnPruning", False)
        .option("sep", NO_SEPARATOR)
        .option("quote", "")
        .csv(exact_paths(paths))
    )
    return raw.select(
        # A line that does hold the character is no single cell, and kept as a whole.
        F.coalesce(BAD_LINE, LINE).alias("line"),
        plain_path_column(F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_size").alias("length"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("modified"),
    )


def _headers(spark: SparkSession, groups: list[HeaderGroup]) -> DataFrame:
    """Per file its header, the places of the contract's columns and of the others, and the state it was checked in."""
    states = [_state(path, key) for g in groups for path, key in zip(g.paths, g.keys, strict=True)]
    files = pa.table(
        {
            "source_file": pa.array([path for g in groups for path in g.paths], pa.string()),
            "checked_length": pa.array([length for length, _ in states], pa.int64()),
            "checked_modified": pa.array([modified for _, modified in states], pa.int64()),
            "number": pa.array([n for n, g in enumerate(groups) for _ in g.paths], pa.int32()),
        }
    )
    headers = pa.table(
        {
            "number": pa.array(range(len(groups)), pa.int32()),
            "n_cells": pa.array([len(g.header) for g in groups], pa.int32()),
            "header": pa.array([g.header for g in groups], pa.list_(pa.string())),
            "places": pa.array([[g.header.index(n) for n in SALES_CONTRACT.names] for g in groups], pa.list_(pa.int32())),
            "others": pa.array(
                [[k for k, n in enumerate(g.header) if n not in SALES_CONTRACT.names] for g in groups], pa.list_(pa.int32())
            ),
        }
    )
    return spark.createDataFrame(files).join(spark.createDataFrame(headers), "number").drop("number")


def _state(path: str, key: str | None) -> tuple[int | None, int | None]:
    """Length and time of change that a file's key names; nulls without a key, and what no file has for a key of another form."""
    if key is None:
        return None, None
    found = re.fullmatch(r"\|([0-9]{1,18})\|(-?[0-9]{1,18})", key[len(path) :]) if key.startswith(path) else None
    return (int(found[1]), int(found[2])) if found else (-1, -1)


def _parse_class(spark: SparkSession, width: int, groups: list[HeaderGroup]) -> DataFrame:
    """The rows of files whose headers have at most ``width`` cells."""
    lines = _lines(spark, [path for g in groups for path in g.paths])
    known = lines.join(_headers(spark, groups), "source_file", "left")
    held = known.select("*", _cells("line", width).alias("cells"))
    placed = held.select(
        "*", *[F.get("cells", F.get("places", F.lit(k))).alias(name) for k, name in enumerate(SALES_CONTRACT.names)]
    )
    # Each cell is cast once, here; what follows looks at the results. A row is generated, not projected, since a filter on
    # what follows would be moved below a projection, and parse the line again for every column that it names.
    typed = placed.select("*", F.explode(F.array(F.struct(*[_typed(f).alias(f.name) for f in SALES_CONTRACT.fields]))).alias("typed"))
    misfit = {
        f.name: F.col(f.name).isNotNull() & F.col(f"typed.{f.name}").isNull()
        for f in SALES_CONTRACT.fields
        if not isinstance(f.dataType, T.StringType)
    }
    torn = ~F.get("cells", F.col("n_cells")).eqNullSafe(F.lit(END))
    other = F.col("n_cells").isNull() | (F.col("checked_length") != F.col("length")) | (F.col("checked_modified") != F.col("modified"))
    changed = F.concat(F.lit("Header was checked on another state of "), F.col("source_file"))
    bad = torn | reduce(Column.__or__, misfit.values())
    faults = F.concat_ws(",", *[F.when(wrong, F.lit(name)) for name, wrong in misfit.items()])
    filled = F.filter(F.arrays_zip("header", F.slice("cells", F.lit(1), F.size("header"))), lambda x: x["1"].isNotNull())
    return typed.select(
        *[F.col(f"typed.{f.name}").alias(f.name) for f in SALES_CONTRACT.fields],
        fold_cells("cells", "others").alias(ADDITIONAL_COLUMN),
        "source_file",
        F.when(other, F.raise_error(changed).cast("boolean")).otherwise(~bad).alias("fits"),
        F.when(torn, F.lit("wrong number of cells")).when(bad, F.concat(F.lit("bad value: "), faults)).alias("reason"),
        F.when(torn, F.to_json(F.struct("line"))).when(bad, F.to_json(F.map_from_entries(filled))).alias("raw_record"),
    )


def _cells(line: str, width: int) -> Column:
    """The cells of a line and a mark behind the last, cut off after ``width`` + 1; an empty cell is null, a quoted empty one is not.

    A line without quotes is cut at its commas, which is what the CSV parser makes of it, at a fraction of the parser's work."""
    layout = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width + 1)])
    # The mark stands where the header ends, unless a line has fewer or more cells.
    marked = F.concat(line, F.lit(f",{END}"))
    parsed = F.from_csv(marked, layout.simpleString(), {"sep": ","})
    # The parser takes a zero character in front for the mark of a comment.
    plain = ~F.contains(F.col(line), F.lit('"')) & ~F.startswith(F.col(line), F.lit("\0"))
    cut = F.transform(F.split(marked, ",", width + 2), lambda cell: F.nullif(cell, F.lit("")))
    return F.when(plain, cut).otherwise(F.array(*[parsed[n] for n in layout.names]))


def _typed(target: T.StructField) -> Column:
    value = F.col(target.name)
    if isinstance(target.dataType, T.IntegralType):
        return to_whole_number(value, target.dataType)
    if isinstance(target.dataType, T.DecimalType):
        return to_money(value, target.dataType)
    if isinstance(target.dataType, T.DateType):
        return to_day(value)
    return value
