from helpers import frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import (
    base_name,
    fold_columns,
    full_name,
    incentive,
    month_of,
    run_epoch_ms,
    run_timestamp,
    strip_store,
    to_day,
    to_money,
    to_whole_number,
)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_month_of_date_timestamp_and_null(spark):
    day, moment = F.lit("2023-03-31").cast("date"), F.lit("2023-03-31 23:59:59").cast("timestamp")
    assert one(spark, month_of(day), month_of(moment), month_of(F.lit(None).cast("date"))) == (
        "2023-03",
        "2023-03",
        None,
    )


def test_full_name_needs_both_parts(spark):
    none = F.lit(None).cast("string")
    assert one(spark, full_name(F.lit("A"), F.lit("B")), full_name(F.lit("A"), none), full_name(none, F.lit("B"))) == (
        "A B",
        None,
        None,
    )


def test_fold_keeps_order_and_skips_nulls(spark):
    df = frame(spark, [("UPI", "north"), ("UPI", None), (None, None)], "mode string, zone string")
    assert [r[0] for r in df.select(fold_columns(["zone", "mode"])).collect()] == ["north,UPI", "UPI", ""]
    assert [r[0] for r in df.select(fold_columns([])).collect()] == [None, None, None]
    assert df.select(fold_columns([])).schema[0].dataType.simpleString() == "string"


def test_whole_numbers(spark):
    df = frame(spark, [("3",), (" 4 ",), ("5.0",), ("5.5",), ("[1, 2]",), ("x",), (None,), ("99999999999",)], "t string")
    got = [r[0] for r in df.select(to_whole_number(F.col("t"), "int")).collect()]
    assert got == [3, 4, 5, None, None, None, None, None]


def test_paths(spark):
    names = ["s3a://shop/in/day 1.csv", "file:/data/x.csv", "hdfs://nn:8020/in/y.csv"]
    df = frame(spark, [(n,) for n in names], "p string")
    assert [tuple(r) for r in df.select(base_name("p"), strip_store("p")).collect()] == [
        ("day 1.csv", "in/day 1.csv"),
        ("x.csv", "data/x.csv"),
        ("y.csv", "in/y.csv"),
    ]


def test_run_stamps(spark):
    moment = F.lit("2023-08-20 10:11:12.987").cast("timestamp")
    assert one(spark, run_timestamp(moment), run_epoch_ms(moment)) == ("2023-08-20 10:11:12", 1692526272000)
    now = one(spark, run_timestamp(), run_epoch_ms())
    assert len(now[0]) == 19 and now[1] % 1000 == 0


def test_incentive_is_an_exact_decimal(spark):
    total = F.lit("33.50").cast("decimal(18,2)")
    df = spark.range(1).select(incentive(total, F.lit(True)).alias("a"), incentive(total, F.lit(False)).alias("b"))
    assert [str(v) for v in df.first()] == ["0.3350", "0.0000"]
    assert df.schema["a"].dataType.simpleString() == "decimal(18,4)"


def test_no_cell_is_changed_silently(spark):
    """Cells that a cast alone would round or cut are null, exact ones keep their value."""
    def cells(convert, kind, *texts):
        rows = frame(spark, [(t,) for t in texts], "t string").select("t", convert(F.col("t"), kind).cast("string").alias("v"))
        return {r.t: r.v for r in rows.collect()}

    whole = cells(to_whole_number, T.LongType(), "3", " 3.000 ", "-7.", "3.000000001", "1.000000001", "3.5", "1e3", "", "99999999999999999999")
    assert whole == {"3": "3", " 3.000 ": "3", "-7.": "-7", "3.000000001": None, "1.000000001": None, "3.5": None, "1e3": None, "": None, "99999999999999999999": None}
    money = cells(to_money, T.DecimalType(12, 2), "1.5", ".25", "-3", "2.500000000000000000000", "1.0000000000000000001", "1.239", "12345678901.00", ".")
    assert money == {"1.5": "1.50", ".25": "0.25", "-3": "-3.00", "2.500000000000000000000": "2.50", "1.0000000000000000001": None, "1.239": None, "12345678901.00": None, ".": None}
    day = cells(lambda t, _: to_day(t), None, "2023-03-01", "2023-3-1", "2023-03-01 10:15:00", "2023-03-01T10:15", "2023-03-01 garbage", "2023-03-01T99:99", "2023-03", "2023-02-30", "2023-03-01x", "2023-03-01 ")
    kept = {"2023-03-01", "2023-3-1", "2023-03-01 10:15:00", "2023-03-01T10:15", "2023-03-01 "}
    assert day == {text: "2023-03-01" if text in kept else None for text in day}


def test_usual_texts_are_typed_without_patterns_and_as_the_patterns_type_them(spark):
    texts = [
        "0", "7", "12", "007", "+7", "-7", "3.0", "3.5", " 5", "5 ", "", " ", "[5]", "5 pcs", "999999999", "2147483647", "2147483648",
        "999999999999999999", "9223372036854775807", "99999999999999999999", "abc", "٣", "1e3", "3.000000001", "0.00", "1.50", "-0.00", "-1.50",
        "+1.50", "01.50", ".50", "1.5", "1.505", "1.500", "1.E9", "ab.cd", "12345678901.00", "1E-99999999", "1996-01-02", "1996-1-2", "1996-02-30",
        "1996-01", "-999-01-01", "10000-01-01", "1996-01-02T99:99", "1996-01-02 24:00", "1996-01-02 23:59:60", "1996-01-02 23:60", "1996-01-02 23:59",
        "1996-01-02T10:00:00+05:30", "1996-01-02 later", "0000-01-01",
    ]
    text, long, money = F.col("text"), T.LongType(), T.DecimalType(12, 2)
    day = F.regexp_extract(text, r"^\s*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})([\sT].*)?$", 1)
    whole = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(\.0*)?\s*$", 1)
    plain = [
        whole.try_cast(long),
        whole.try_cast(T.IntegerType()),
        F.when(text.rlike(r"^\s*[+-]?([0-9]+(\.[0-9]{0,2}0*)?|\.[0-9]{1,2}0*)\s*$"), F.trim(text).try_cast(money)),
        F.when(text.rlike(r"^\s*[0-9-]+\s*$") | text.try_cast("timestamp").isNotNull(), day.try_cast("date")).cast("string"),
    ]
    made = [to_whole_number(text, long), to_whole_number(text, T.IntegerType()), to_money(text, money), to_day(text).cast("string")]
    rows = frame(spark, [(t,) for t in [*texts, None]], "text string")
    found = rows.select("text", F.struct(*made).alias("made"), F.struct(*plain).alias("plain")).collect()
    assert [(r.text, tuple(r.made)) for r in found] == [(r.text, tuple(r.plain)) for r in found]
    # No text that is no number reaches a cast to one: the error that this makes costs more than the whole row.
    assert "conv(" in str(made[0]) and "conv(" in str(made[1])
