"""Column expressions shared by the operators. All of them are built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.schema import ADDITIONAL_COLUMN, INCENTIVE


def month_of(day: str | Column) -> Column:
    """``yyyy-MM`` of a date or timestamp; a null day gives a null month."""
    column = F.col(day) if isinstance(day, str) else day
    return F.substring(column.cast("string"), 1, 7)


def full_name(first: str | Column, last: str | Column) -> Column:
    """First and last name with a blank between; null as soon as one part is null."""
    return F.concat(first, F.lit(" "), last)


def fold_columns(names: Sequence[str]) -> Column:
    """The named columns joined with commas in the order given, nulls skipped.

    Without any name the result is a null string; with names that are all null it is ''.
    """
    if not names:
        folded = F.lit(None).cast("string")
    else:
        folded = F.concat_ws(",", *[F.col(f"`{n.replace('`', '``')}`") for n in names])
    return folded.alias(ADDITIONAL_COLUMN)


def fold_cells(cells: str | Column, places: str | Column) -> Column:
    """The cells at the given places (from 0) joined as ``fold_columns`` joins columns."""
    held = F.col(cells) if isinstance(cells, str) else cells
    return F.when(F.size(places) > 0, F.concat_ws(",", F.transform(places, lambda at: F.get(held, at))))


def incentive(total: Column, is_best: Column) -> Column:
    """One percent of the total for the best seller, nothing for the others."""
    return F.when(is_best, total * F.lit(0.01).cast("decimal(3,2)")).otherwise(F.lit(0)).cast(INCENTIVE)


def to_whole_number(text: Column, data_type) -> Column:
    """Text to a whole number type; ``3.0`` counts as 3, ``3.5``, ``3.000000001`` and ``[1, 2]`` give null.

    The text itself is looked at, since a cast to a decimal would round first."""
    whole = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(\.0*)?\s*$", 1)
    # A cast that fails makes an error and drops it, which costs more than all else here, so only digits are cast. What
    # ``conv`` gives back as it was is plain digits; so many of them fit into the type.
    fit = 9 if isinstance(data_type, T.IntegerType) else 18 if isinstance(data_type, T.LongType) else 2
    digits = F.when(F.length(text) <= fit, F.when(F.conv(text, 10, 10) == text, text.try_cast(data_type)))
    return F.coalesce(digits, F.when(whole != "", whole.try_cast(data_type)))


def to_money(text: Column, data_type) -> Column:
    """Text to a decimal type; more places than it has are null unless they are zeros, however many there are."""
    places = data_type.scale
    exact = rf"^\s*[+-]?([0-9]+(\.[0-9]{{0,{places}}}0*)?|\.[0-9]{{1,{places}}}0*)\s*$"
    # Only a text with as many places as the type is cast before it is looked at: an exponent may name a number of any length.
    usual = F.substring(text, -places - 1, 1) == "." if places else F.lit(False)
    written = F.when(usual, _as_written(text, text.try_cast(data_type)))
    return F.coalesce(written, F.when(text.rlike(exact), F.trim(text).try_cast(data_type)))


def to_day(text: Column) -> Column:
    """Text to a day; a time may follow, and anything else after the day gives null, as does a month without a day."""
    day = F.regexp_extract(text, r"^\s*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})([\sT].*)?$", 1)
    bare = text.rlike(r"^\s*[0-9-]+\s*$")
    written = F.when(F.length(text) == 10, _as_written(text, text.try_cast("date")))
    # Hours over 23, minutes and seconds over 59 are no time; a cast would find out by an error that it makes and drops.
    no_time = text.rlike(r"^\s*[0-9-]+[\sT](2[4-9]|[3-9][0-9]):|^\s*[0-9-]+[\sT][0-9]{1,2}:([0-9]{1,2}:)?[6-9][0-9]")
    timed = F.when(~no_time, text.try_cast("timestamp"))
    return F.coalesce(written, F.when(bare | timed.isNotNull(), day.try_cast("date")))


def _as_written(text: Column, value: Column) -> Column:
    """The value if its own text is the given one, else null: what a cast has changed nothing about needs no pattern."""
    return F.when(value.cast("string") == text, value)


def base_name(path: str | Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def strip_store(path: str | Column) -> Column:
    """Path without ``scheme://bucket/``; plain file paths lose only the scheme."""
    return F.regexp_replace(path, r"^(file:/+|[a-z][a-z0-9+.-]*://[^/]*/)", "")


def run_timestamp(moment: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the moment, by default of the start of the query."""
    return F.date_format(F.current_timestamp() if moment is None else moment, "yyyy-MM-dd HH:mm:ss")


def run_epoch_ms(moment: Column | None = None) -> Column:
    """Milliseconds since the epoch at second precision."""
    return (F.unix_timestamp(F.current_timestamp() if moment is None else moment) * 1000).cast("bigint")
