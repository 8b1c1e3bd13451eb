"""The landed input of the file queries, over tables with keys that repeat, miss or are null."""

import os
from pathlib import Path

import pytest
from helpers import as_text, frame

from tallyframe.plans import landing as _landing
from tallyframe.plans import queries as _queries
from tallyframe.plans.landing import FEEDS, land_feeds, regional_lines, staged_lines
from tallyframe.plans.tables import FACT_ORDER, LAYOUTS, sales_lines
from tallyframe.session import shuffles_released

ROWS = {
    "region": [(1, "ASIA"), (2, "EUROPE"), (3, None)],
    # Store 10 comes twice, in two regions; store 12 has none that is known, 13 one without a name, 14 is not there.
    "nation": [(10, "N10", 1), (10, "N10", 2), (11, "N11", 2), (12, "N12", 9), (13, "N13", 3), (None, "none", 1)],
    "supplier": [(1, "S1", 10, 1), (2, "S2", 11, 1), (3, "S3", 12, 1), (4, "S4", 13, 1), (5, "S5", 14, 1), (6, "S6", None, 1)],
    "part": [(1, "red, \"wide\" nut", "B", "T", 1, 900.5), (2, None, "B", "T", 1, None)],
    "orders": [(1, 7, "O", 1, "1995-01-02", "1-URGENT"), (2, None, "O", 1, "1995-02-03", None)],
    # Each seller sells two products, one of them unknown; the last two lines are equal, and one has no order.
    "lineitem": [
        *[(1 + s % 2, 1 + p * 2, s, 1, 3, 10.5 + s, 0, 0, "N" if p else "R", "F", "1995-03-01") for s in range(1, 7) for p in (0, 1)],
        (2, 2, 1, 1, None, None, 0, 0, None, "F", None),
        (2, 2, 1, 1, None, None, 0, 0, None, "F", None),
        (99, 1, 1, 1, 3, 1.5, 0, 0, "R", "F", None),
    ],
}


@pytest.fixture
def sf_dir(spark, tmp_path):
    for name, rows in ROWS.items():
        frame(spark, rows, LAYOUTS[name]).write.parquet(str(tmp_path / "sf" / f"{name}.parquet"))
    return str(tmp_path / "sf")


@pytest.fixture
def scratch(spark):
    """Gives the kinds of scratch folders that have come since the test began."""
    top = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")) / "tallyframe"

    def names():
        return {path.name for path in top.iterdir()} if top.exists() else set()

    before = names()
    return lambda: [name.rpartition("-")[0] for name in sorted(names() - before)]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}


def test_an_empty_feed_joins_its_lines_once_and_keeps_landings_only(spark, sf_dir, scratch, monkeypatch):
    """Both deliveries come from one join, whose table and shuffle files are gone when they have landed."""
    expected = as_text(sales_lines(spark, sf_dir).fillna("", "payment_mode").select(*FACT_ORDER, "payment_mode"))
    assert len(expected) == 14
    calls = []

    def counted(*given, **named):
        calls.append(given)
        return sales_lines(*given, **named)

    for module in (_landing, _queries):
        monkeypatch.setattr(module, "sales_lines", counted)
    before = shuffle_files(spark)
    found = _queries.empty_feed(spark, sf_dir)
    assert len(calls) == 1
    assert "lines" not in scratch() and scratch().count("landing") == 2
    # A repeated store repeats its lines in the regional feeds, and in no other delivery; a line without a region is in it.
    assert as_text(found.select(*FACT_ORDER, "additional_column")) == expected
    assert not {name for name in shuffle_files(spark) - before if name.endswith(".data")}


def test_feeds_hold_the_rows_of_their_region(spark, sf_dir, scratch):
    lines = regional_lines(spark, sf_dir)
    landing = land_feeds(spark, sf_dir)
    for name, columns in FEEDS.items():
        landed = spark.read.option("header", True).csv(f"{landing}/{name.replace(' ', '_')}", escape="\\")
        assert landed.columns == list(columns)
        assert as_text(landed) == as_text(lines.where(lines.region == name).select(*columns))
    assert as_text(lines.groupBy("region").count()) == [(None, "2"), ("ASIA", "4"), ("EUROPE", "6")]
    assert "lines" not in scratch()


def test_staged_lines_go_when_a_landing_fails(spark, sf_dir, scratch):
    with pytest.raises(ZeroDivisionError), staged_lines(spark, sf_dir) as lines:
        assert scratch() == ["lines"]
        assert as_text(lines) == as_text(sales_lines(spark, sf_dir))
        1 / 0
    assert "lines" not in scratch()


def test_shuffle_files_are_released(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(key)
    rows = spark.range(1000).repartition(3)
    with shuffles_released(spark):
        rows.write.parquet(str(tmp_path / "rows"))
    assert spark.conf.get(key) == setting
    assert not {name for name in shuffle_files(spark) - before if name.endswith(".data")}
    # The frame can be run again all the same.
    assert rows.count() == spark.read.parquet(str(tmp_path / "rows")).count() == 1000
