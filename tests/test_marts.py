import random

from helpers import GOLDEN_FACT, LOST_FACT, as_text, fact_frame, frame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import marts
from tallyframe.operators.dimensions import ENRICHED_COLUMNS, enrich, repeated_keys, unmatched
from tallyframe.operators.ranking import rank_descending


def test_customer_mart_golden(spark, star):
    expected = [
        ("1", "Pavo K", "2023-03", "250.00"),
        ("1", "Pavo K", "2023-04", "70.00"),
        ("2", "Orla S", "2023-03", "183.00"),
        ("3", None, "2023-03", "53.50"),
    ]
    fact = fact_frame(spark, GOLDEN_FACT + LOST_FACT)
    columns = ("customer_id", "full_name", "sales_date_month", "total_sales")
    assert as_text(marts.customer_mart(fact, *star), *columns) == expected
    assert as_text(marts.customer_mart_window(fact, *star), *columns) == expected
    assert marts.customer_mart(fact, *star).columns == marts.CUSTOMER_MART_COLUMNS


def test_sales_mart_golden(spark, star):
    fact = fact_frame(spark, GOLDEN_FACT + LOST_FACT)
    mart = marts.sales_mart(fact, *star)
    assert mart.columns == marts.SALES_MART_COLUMNS
    assert as_text(mart, "store_id", "sales_person_id", "sales_month", "total_sales", "incentive") == [
        ("121", "1", "2023-03", "250.00", "2.5000"),
        ("121", "1", "2023-04", "70.00", "0.7000"),
        ("121", "2", "2023-03", "150.00", "0.0000"),
        ("121", "3", "2023-03", "20.00", "0.0000"),
        ("122", "1", "2023-03", "33.00", "0.0000"),
        ("122", "4", "2023-03", "33.50", "0.3350"),
    ]
    assert as_text(marts.sales_rank(fact, *star), "store_id", "sales_person_id", "sales_month", "rnk") == [
        ("121", "1", "2023-03", "1"),
        ("121", "1", "2023-04", "1"),
        ("121", "2", "2023-03", "2"),
        ("121", "3", "2023-03", "3"),
        ("122", "1", "2023-03", "2"),
        ("122", "4", "2023-03", "1"),
    ]


def test_tied_sellers_all_earn(spark, star):
    fact = fact_frame(spark, [*GOLDEN_FACT, (2, 122, "2023-03-09", 1, "0.50")])
    at_122 = marts.sales_mart(fact, *star).where("store_id = 122")
    assert as_text(at_122, "sales_person_id", "total_sales", "incentive") == [
        ("1", "33.50", "0.3350"),
        ("4", "33.50", "0.3350"),
    ]
    assert as_text(marts.sales_rank(fact, *star).where("store_id = 122"), "rnk") == [("1",), ("1",)]
    assert as_text(marts.top_sellers(fact, *star).where("store_id = 122"), "sales_person_id") == [("1",), ("4",)]


def test_null_month_and_null_totals_form_groups(spark, star):
    fact = fact_frame(spark, [(1, 121, None, 1, "10"), (1, 121, None, 2, "4"), (2, 122, "2023-05-01", 3, None)])
    assert as_text(marts.sales_mart(fact, *star), "store_id", "sales_person_id", "sales_month", "total_sales", "incentive") == [
        ("121", "1", None, "10.00", "0.1000"),
        ("121", "2", None, "4.00", "0.0000"),
        # The only seller of the month is its best one; one percent of nothing known is not known.
        ("122", "3", "2023-05", None, None),
    ]
    assert as_text(marts.customer_mart(fact, *star), "customer_id", "sales_date_month", "total_sales") == [
        ("1", None, "14.00"),
        ("2", "2023-05", None),
    ]
    assert as_text(marts.sales_rank(fact, *star), "sales_person_id", "rnk") == [("1", "1"), ("2", "2"), ("3", "1")]


def test_enriched_has_unique_columns_and_known_rows(spark, star):
    enriched = enrich(fact_frame(spark, GOLDEN_FACT + LOST_FACT), *star)
    assert enriched.columns == ENRICHED_COLUMNS and len(set(ENRICHED_COLUMNS)) == len(ENRICHED_COLUMNS)
    assert enriched.count() == len(GOLDEN_FACT)
    assert marts.sales_base(enriched).where("sales_month is null").count() == 0
    assert marts.customer_base(enriched).columns[0] == "customer_id"


def test_no_row_is_lost_silently(spark, star):
    fact = fact_frame(spark, GOLDEN_FACT + LOST_FACT)
    lost = unmatched(fact, *star)
    assert {(r.customer_id, r.reason) for r in lost.collect()} == {
        (99, "unknown customer_id"),
        (None, "unknown customer_id"),
        (1, "unknown store_id"),
        (1, "unknown sales_person_id"),
    }
    assert fact.count() == enrich(fact, *star).count() + lost.count()


def test_mart_totals_add_up_and_every_month_has_a_winner(spark, star):
    rng = random.Random(7)
    rows = [
        (rng.choice([1, 1, 1, 2, 3]), rng.choice([121, 121, 122]), f"2023-0{rng.randint(1, 6)}-1{rng.randint(0, 9)}",
         rng.randint(1, 4), f"{rng.randint(1, 400) / 4:.2f}")
        for _ in range(400)
    ]
    fact = fact_frame(spark, rows)
    whole = fact.agg(F.sum("total_cost").cast("decimal(18,2)")).first()[0]
    for mart in (marts.customer_mart(fact, *star), marts.sales_mart(fact, *star)):
        assert mart.agg(F.sum("total_sales").cast("decimal(18,2)")).first()[0] == whole
    groups = marts.sales_rank(fact, *star).groupBy("store_id", "sales_month").agg(F.min("rnk").alias("m"))
    assert groups.where("m <> 1").count() == 0
    assert as_text(marts.customer_mart(fact, *star)) == as_text(marts.customer_mart_window(fact, *star))


def test_split_rank_equals_window_rank(spark):
    rng = random.Random(11)
    amounts = [None, "0.00", "0.05", "-0.05", "-12.30", "9.99", "10.00", "99.99", "100.00", "100.01", "123456.78"]
    # One group holds most rows, and one amount most rows of the group.
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["a", "b", None]), rng.choice([*amounts, *["7.77"] * 9])) for _ in range(900)]
    df = frame(spark, rows, "g string, v string").selectExpr("g", "cast(v as decimal(18,2)) as v")
    window = Window.partitionBy("g").orderBy(F.desc("v"))
    expected = df.withColumn("rnk", F.rank().over(window).cast("long"))
    assert as_text(rank_descending(df, ["g"], "v", "rnk").selectExpr("coalesce(g,'-')", "coalesce(string(v),'-')", "rnk")) == as_text(
        expected.selectExpr("coalesce(g,'-')", "coalesce(string(v),'-')", "rnk")
    )


def test_marts_do_not_depend_on_the_join_strategy(spark, star):
    fact = fact_frame(spark, GOLDEN_FACT + LOST_FACT)
    expected = as_text(marts.sales_mart(fact, *star)), as_text(marts.customer_mart(fact, *star).na.fill("-"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for name in names:
            spark.conf.set(name, -1)
        assert (as_text(marts.sales_mart(fact, *star)), as_text(marts.customer_mart(fact, *star).na.fill("-"))) == expected
    finally:
        for name in names:
            spark.conf.unset(name)


def test_a_hot_customer_is_split_in_joins_and_folded_before_them(spark, tmp_path):
    """With most rows on one key and nothing small enough to broadcast, no task gets that key whole."""
    rows = spark.range(0, 600_000, 1, 8).selectExpr(
        "if(id % 3 > 0, 7, id) as customer_id",
        "id % 2 as store_id",
        "date_add(date'2023-01-01', cast(id % 300 as int)) as sales_date",
        "id % 5 as sales_person_id",
        "cast(1 as decimal(12,2)) as total_cost",
    )
    rows.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    customer = spark.range(600_000).selectExpr(
        "id as customer_id", "'a' as first_name", "'b' as last_name", "'c' as address", "'d' as pincode", "'e' as phone_number"
    )
    store = spark.range(2).selectExpr("id", "'a' as address", "'m' as store_manager_name")
    team = spark.range(5).selectExpr(
        "id", "'f' as first_name", "'l' as last_name", "1 as manager_id", "'N' as is_manager",
        "'a' as address", "'p' as pincode", "date'2020-01-01' as joining_date",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        totals = enrich(fact, customer, store, team).agg(F.count("*"), F.sum("total_cost"))
        assert tuple(map(int, totals.collect()[0])) == (600_000, 600_000)
        assert "skew=true" in totals._jdf.queryExecution().executedPlan().toString()
        mart = marts.customer_mart(fact, customer, store, team)
        mart.collect()
        plan = mart._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.index("[customer_id") < plan.index("HashAggregate(keys=[customer_id")
        assert mart.agg(F.sum("total_sales")).first()[0] == 600_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_fact_is_scanned_once_for_the_sales_mart(spark, star, tmp_path):
    fact_frame(spark, GOLDEN_FACT).write.parquet(str(tmp_path / "fact"))
    mart = marts.sales_mart(spark.read.parquet(str(tmp_path / "fact")), *star)
    mart.collect()
    plan = mart._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_repeated_keys(spark):
    df = frame(spark, [(1,), (2,), (2,)], "id long")
    assert as_text(repeated_keys(df, "id")) == [("2", "2")]


def test_rank_of_a_group_in_one_narrow_range(spark, monkeypatch, tmp_path):
    """One group of 50,000 amounts between 1,000,000.00 and 1,005,000.00 is spread evenly over all ranges."""
    from pyspark.sql import functions as F

    from tallyframe.operators import ranking

    monkeypatch.setattr(ranking, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    df = spark.range(60_000).selectExpr("1L as store", "cast(1000000 + (id * 7919 % 50000) / 10 as decimal(18,2)) as total")
    ranked = ranking.rank_descending(df, ["store"], "total", "rnk", parts=16)
    plain = df.withColumn("rnk", F.expr("rank() over (partition by store order by total desc)"))
    assert ranked.exceptAll(plain).isEmpty() and ranked.count() == 60_000
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/ranges").groupBy("range_no").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 50_000 / 16


def test_sales_rows_meet_the_customers_while_they_are_narrow(spark, star):
    fact = fact_frame(spark, GOLDEN_FACT + LOST_FACT)
    last, first = enrich(fact, *star), enrich(fact, *star, customer_last=False)
    assert as_text(marts.sales_base(first)) == as_text(marts.sales_base(last))
    assert first.columns == last.columns == ENRICHED_COLUMNS
    plan = marts.sales_base(first)._jdf.queryExecution().optimizedPlan().toString()
    # The outer joins come first in the text of a plan.
    assert plan.index("= dim_person_id") < plan.index("= dim_customer_id")
