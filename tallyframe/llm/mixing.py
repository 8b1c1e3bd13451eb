"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a hash. Words are summed by source and leading hash digit; the digit at which a
source's running sum passes its budget is the boundary, and only rows of that one bucket are summed
again by the next digit, until the boundary is one row. Rows before the boundary are in: a comparison
per row, without a sort of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import WORD, table, written

#: Weights by place of the source, share of all words that is given out, most repeats.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Hash digits are of 12 bits; after the 60 bits of the hash follow those of the row's number.
DIGITS = [("hash", s) for s in (48, 36, 24, 12, 0)] + [("turn", s) for s in (48, 36, 24, 12, 0)]


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*columns: Column) -> Column:
    """60 bits of the MD5 of the values; the same in any engine."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """Targets from ``src``, ``source_size``: shares by weight, stopped at ``most`` times the source.

    One level ``l`` fits: a source gets ``l * weight`` or its bound, whichever is less. Sources in order
    of bound / weight stop first, so the level follows from running sums over one row per source.
    """
    listed = Window.orderBy(F.col("src").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(listed) - 1) % len(weights) + 1)
    bound = F.col("source_size") * most
    everything = Window.partitionBy()
    before = Window.orderBy("stops", "src").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("bound").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    return (
        sizes.withColumn("weight", weight)
        .withColumn("bound", bound)
        .withColumn("stops", F.col("bound") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("stops"), F.col("level"))).over(everything))
        .withColumn("target", F.least(F.col("bound").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("bound").cast("double"))))
        .select("src", "source_size", "target")
    )


def mix(docs: DataFrame, source: str, size: Column, identity: list[str], weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """How often the mix takes each row: ``row`` (all columns of docs), ``size``, ``source_size``,
    ``target`` (of its source), ``copies``, ``taken`` (= copies * size).

    Every row is taken ``floor(target / source_size)`` times, and once more if its hash lies before the
    boundary of its source; the row on the boundary is in when that brings the sum nearer. So a source
    misses its target by half of one row at most, and reruns agree, whatever the partitioning.

    ``identity`` names the columns that are hashed. Rows equal in all of them share a hash and are told
    apart by their place in the written table; they are to be interchangeable. A null source is a source
    (the last in order); null sizes count 0 and such rows are taken whole times only as their hash
    says; an empty table gives no rows. Columns of docs may have any name, as they travel in ``row``.
    """
    rows = written(
        docs.select(
            F.struct(*docs.columns).alias("row"), docs[source].alias("src"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            hash60(*[docs[c] for c in identity]).alias("hash"), F.monotonically_increasing_id().alias("turn"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = written(
        source_targets(sizes, weights, share, most)
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-sources",
    )
    cut = None
    for depth, (column, shift) in enumerate(DIGITS):
        cut = written(_boundary(rows, sources, cut, depth), "mix-boundary")
        if (cut.agg(F.max("rows")).first()[0] or 0) <= 1:
            break
    digit = _digits(depth)
    before = F.lit(False)
    same = F.lit(True)
    for k, value in enumerate(digit):
        before = before | (same & (value < F.col("at")[k]))
        same = same & (value == F.col("at")[k])
    marks = sources.join(cut.select(F.col("src").alias("cut_src"), "at", "takes"), F.col("src").eqNullSafe(F.col("cut_src")), "left").select(
        F.col("src").alias("of"), "source_size", "target", "whole", "rest", "at", "takes"
    )
    more = F.when(F.col("rest") <= 0, False).when(F.col("at").isNull(), True).otherwise(before | (same & F.col("takes")))
    copies = (F.col("whole") + more.cast("int")).cast("int")
    return rows.join(marks, F.col("src").eqNullSafe(F.col("of")), "inner").select(
        "row", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken")
    )


def _digits(depth: int) -> list[Column]:
    """The digits of a row down to a depth, leading digit first."""
    return [
        F.shiftright(F.col(name), shift).bitwiseAND(F.lit(0xFFFF if shift == 48 else 0xFFF))
        for name, shift in DIGITS[: depth + 1]
    ]


def _boundary(rows: DataFrame, sources: DataFrame, cut: DataFrame | None, depth: int) -> DataFrame:
    """Per source the bucket at this depth in which the running sum passes the rest: ``src``, ``at``
    (its digits), ``base`` (words before it), ``rows`` in it, ``takes`` (its words bring the sum nearer)."""
    digits = _digits(depth)
    if cut is None:
        inside = rows.withColumns({"at": F.array().cast("array<bigint>"), "base": F.lit(0).cast("long")})
    else:
        held = cut.select(F.col("src").alias("of"), "at", "base")
        same = F.col("src").eqNullSafe(F.col("of"))
        for k, value in enumerate(digits[:-1]):
            same = same & (value == F.col("at")[k])
        inside = rows.join(held, same, "inner")
    sums = inside.groupBy("src", "at", "base", digits[-1].alias("digit")).agg(
        F.sum("size").alias("words"), F.count("*").alias("rows")
    )
    after = F.col("base") + F.sum("words").over(Window.partitionBy("src").orderBy("digit"))
    rest = sources.select(F.col("src").alias("of"), "rest")
    return (
        sums.withColumn("after", after)
        .join(rest, F.col("src").eqNullSafe(F.col("of")), "inner")
        .where((F.col("rest") > 0) & (F.col("after") > F.col("rest")) & (F.col("after") - F.col("words") <= F.col("rest")))
        .select(
            "src", F.concat("at", F.array(F.col("digit").cast("long"))).alias("at"), (F.col("after") - F.col("words")).alias("base"), "rows",
            (F.col("after") - F.col("rest") < F.col("rest") - F.col("after") + F.col("words")).alias("takes"),
        )
    )


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(sized, "source", F.col("size"), ["doc_id", "source", "size"]).select(
        "row.doc_id", "size", "source_size", "target", "taken", "copies"
    )


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), hashed AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), coalesce(source, ''), size::VARCHAR)), 1, 15))::BIGINT AS hash FROM sized
), sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sums
), bounded AS (SELECT *, 2 * source_size AS bound, 2 * source_size / weight::DOUBLE AS stops FROM placed),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(bound) OVER (ORDER BY stops, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY stops, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM bounded
), targets AS (
  SELECT source, source_size,
    least(bound::DOUBLE, coalesce(max(level) FILTER (WHERE level <= stops) OVER () * weight, bound::DOUBLE)) AS target FROM levels
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), running AS (
  SELECT h.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
    sum(size) OVER (PARTITION BY h.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after
  FROM hashed h JOIN rests r ON h.source IS NOT DISTINCT FROM r.source
), chosen AS (
  SELECT *, whole + CASE WHEN rest <= 0 THEN 0 WHEN after <= rest THEN 1
                         WHEN after - size <= rest AND after - rest < rest - after + size THEN 1 ELSE 0 END AS copies
  FROM running
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::INTEGER AS copies FROM chosen
"""
