"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node in ``links`` (``a``, ``b``: longs); roots are equal within a component.

    In each round a node points to its smallest neighbour, or itself, one jump further; links then join
    what their ends point to, and those within one node go. The larger end of a link always moves, so links
    run out after about log(n) rounds. Each round is written, so a lost executor repeats none. A hub's
    links are folded before they are shuffled.
    """
    links = written(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("to")), "step")
        jump = step.alias("s").join(step.select(F.col("a").alias("mid"), F.col("to").alias("far")), F.col("to") == F.col("mid"), "left")
        jump = written(jump.select("a", F.coalesce("far", "to").alias("to")), "jump")
        if labels is None:
            labels = jump.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            moved = labels.join(jump, F.col("root") == F.col("a"), "left")
            labels = written(moved.select("node", F.coalesce("to", "root").alias("root")), "labels")
        left = jump.select(F.col("a").alias("x"), F.col("to").alias("p"))
        right = jump.select(F.col("a").alias("y"), F.col("to").alias("q"))
        kept = links.join(left, F.col("a") == F.col("x")).join(right, F.col("b") == F.col("y")).where(F.col("p") != F.col("q"))
        links = written(kept.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "links")
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
