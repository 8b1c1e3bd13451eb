"""Check of landed files against the column contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.schema import MANDATORY_COLUMNS
from tallyframe.sources.files import HEADER_CHARACTERS, exact_paths, read_headers

OK = "ok"
ERROR = "error"

# A comma outside of double quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def header_cells(line: Column) -> Column:
    """The cells of a header line, outer quotes removed."""
    return F.transform(
        F.split(line, _COMMA, -1),
        lambda cell: F.regexp_replace(F.regexp_replace(cell, '^"(.*)"$', "$1"), r'\\"', '"'),
    )


def column_names(cells: Column) -> Column:
    """Names as Spark's CSV reader gives them.

    An empty cell becomes ``_c<position>``; a name that occurs more than once, in whatever
    case, gets its position appended.
    """
    return F.transform(
        cells,
        lambda cell, at: F.when(cell == "", F.concat(F.lit("_c"), at.cast("string")))
        .when(
            F.size(F.filter(cells, lambda other: F.lower(other) == F.lower(cell))) > 1,
            F.concat(cell, at.cast("string")),
        )
        .otherwise(cell),
    )


def check_files(
    files: DataFrame, mandatory: Sequence[str] = MANDATORY_COLUMNS, headers: DataFrame | None = None
) -> DataFrame:
    """One verdict per listed file.

    Result: path, file_name, cells (header as written), header (column names), missing,
    extra (both in the order of their source), verdict ``ok`` or ``error``, and reason.
    A file is an error when its name does not end in ``.csv`` or begins with ``_`` or ``.`` (Spark reads no
    such file), when it has no header line or one of more than ``HEADER_CHARACTERS``, or when a mandatory
    column is missing. A ``file_key`` in the listing is kept.
    """
    hidden = F.col("file_name").rlike("^[_.]")
    is_csv = F.col("file_name").endswith(".csv") & ~hidden
    key = [c for c in files.columns if c == "file_key"]
    csv_files = files.where(is_csv)
    headers = read_headers(csv_files) if headers is None else headers
    wanted = F.array(*[F.lit(name) for name in mandatory])

    long = F.coalesce(F.length("header_line") > HEADER_CHARACTERS, F.lit(False))
    checked = (
        csv_files.join(headers, "path", "left")
        .select("path", "file_name", *key, long.alias("long"), F.when(~long, F.col("header_line")).alias("header_line"))
        .select("path", "file_name", *key, "long", header_cells(F.col("header_line")).alias("cells"))
        .withColumn("header", column_names(F.col("cells")))
        .withColumn("missing", F.array_except(wanted, "header"))
        .withColumn("extra", F.array_except("header", wanted))
        .withColumn(
            "reason",
            F.when(F.col("long"), F.lit(f"header line over {HEADER_CHARACTERS} characters"))
            .when(F.col("header").isNull(), F.lit("no header line"))
            .when(
                F.size("missing") > 0,
                F.concat(F.lit("missing columns: "), F.concat_ws(",", "missing")),
            ),
        )
        .drop("long")
    )
    none = F.lit(None).cast("array<string>")
    others = files.where(~is_csv).select(
        "path",
        "file_name",
        *key,
        none.alias("cells"),
        none.alias("header"),
        none.alias("missing"),
        none.alias("extra"),
        F.when(F.col("file_name").endswith(".csv"), F.lit("hidden name")).otherwise(F.lit("not a csv file")).alias("reason"),
    )
    return checked.unionByName(others).withColumn(
        "verdict", F.when(F.col("reason").isNull(), OK).otherwise(ERROR)
    )


def good_files(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("verdict") == OK)


def bad_files(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("verdict") == ERROR)


def quarantine_lines(checked: DataFrame) -> DataFrame | None:
    """The text of the rejected CSV files as (file_name, reason, line); None without any.

    Files of another kind stay where they are: only their verdict is kept, since their content
    need not be text.
    """
    spark = checked.sparkSession
    # Spark reads no hidden name; a file without a header line has no text to keep.
    text = F.col("header").isNotNull() | F.col("reason").startswith("header line over")
    rejected = bad_files(checked).where(text)
    by_reason: dict[str, list[str]] = {}
    for row in rejected.select("reason", "path").collect():
        by_reason.setdefault(row.reason, []).append(row.path)
    lines = None
    for reason, paths in sorted(by_reason.items()):
        part = spark.read.text(exact_paths(paths)).select(
            F.col("_metadata.file_name").alias("file_name"),
            F.lit(reason).alias("reason"),
            F.col("value").alias("line"),
        )
        lines = part if lines is None else lines.unionByName(part)
    return lines
