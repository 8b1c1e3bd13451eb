"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives a vector a long string of bits. A shard of vectors keeps its strings in sorted order, tree by
tree, so that the vectors that share a prefix with a query lie side by side. A query descends to its
longest matches; then all trees and shards ascend together, one bit at a time, until enough vectors share
the prefix, and only those are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import sampled, table, written

#: Trees, bits of a string, vectors of a shard, queries of a block (bound of what is broadcast).
TREES, BITS, SHARD, BLOCK = 24, 62, 1 << 16, 20_000
#: Rows the trees are fitted on, at most; entries of all trees that a query ascends for: a multiple of the rows, or a
#: fixed number where there are few.
FIT_ROWS, SHARE, LEAST = 4_000, 1.5, 4_000


class Forest:
    """The trees' hash functions, fitted on a bounded sample: random directions, each cut at the sample's median,
    so that every bit parts the vectors in halves."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 7):
        self.trees, self.bits = trees, bits
        self.directions = np.random.default_rng(seed).standard_normal((sample.shape[1], trees * bits))
        self.cuts = np.median(sample @ self.directions, axis=0)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Strings as integers: one row per vector, one column per tree."""
        ones = (vectors @ self.directions > self.cuts).reshape(len(vectors), self.trees, self.bits)
        return ones.astype(np.int64) @ (np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64))


class Shard:
    """Vectors with their sorted arrays of strings."""

    def __init__(self, forest: Forest, ids: np.ndarray, vectors: np.ndarray):
        self.forest, self.ids, self.vectors = forest, ids, vectors
        codes = forest.codes(vectors)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=0)

    def range(self, tree: int, codes: np.ndarray, length: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Where the strings lie that share the first ``length`` bits."""
        rest = np.int64(self.forest.bits) - length
        low = (codes >> rest) << rest
        return np.searchsorted(self.sorted[:, tree], low), np.searchsorted(self.sorted[:, tree], low + (np.int64(1) << rest) - 1, "right")

    def counts(self, codes: np.ndarray) -> np.ndarray:
        """For each query and prefix length the vectors that share it, summed over the trees."""
        out = np.zeros((len(codes), self.forest.bits + 1), np.int64)
        for length in range(self.forest.bits + 1):
            for tree in range(self.forest.trees):
                low, high = self.range(tree, codes[:, tree], length)
                out[:, length] += high - low
        return out

    def nearest(self, query_ids, queries, codes, lengths, k: int) -> Iterator[tuple]:
        """The nearest ``k`` of those that share a prefix of the given length with a query, by exact distance."""
        ranges = [self.range(t, codes[:, t], lengths) for t in range(self.forest.trees)]
        mask = np.zeros(len(self.ids), bool)
        for q in range(len(queries)):
            mask[:] = False
            for tree, (low, high) in enumerate(ranges):
                mask[self.order[low[q] : high[q], tree]] = True
            found = np.flatnonzero(mask & (self.ids != query_ids[q]))
            distance = np.sqrt(((self.vectors[found] - queries[q]) ** 2).sum(axis=1))
            best = np.lexsort((self.ids[found], distance))[:k]
            for i in best:
                yield int(query_ids[q]), int(self.ids[found[i]]), float(distance[i])


def usable(vector: str = "vector"):
    """Whether a vector takes part: not null, no component null or not finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, vec_id: str, vector: str, is_query, k: int = 10, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (Euclidean distance in doubles): for every row that
    ``is_query`` (a condition on ``vec_id``) its ``k`` nearest among all other rows, as found; ties go to the smaller id.

    The forest is fitted on ``FIT_ROWS`` rows at most, chosen by hash; every row is indexed. A query ascends until its
    trees hold ``max(least, share * rows)`` entries together. Vectors null, zero or with a null or non-finite
    component take no part, nor do rows without id, nor those of another length than the most frequent one (the
    smaller of two that are). Ids are unique by contract; rows that repeat an id are not each other's neighbours. Fewer rows
    than ``k`` give all of them; no row gives none.

    Queries go in blocks of bounded size to all shards, so identical vectors, however many, meet in no task: a
    shard answers with ``k`` rows per query at most.
    """
    spark = vectors.sparkSession
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[vector].cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable())
    schema = "query_id long, vec_id long, score double"
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("held"))
    most = lengths.orderBy(F.col("held").desc(), "length").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total = most["held"]
    rows = rows.where(F.size("vector") == most["length"])
    place = F.xxhash64("vec_id")
    sample = sampled(rows, place, FIT_ROWS, total).orderBy(place, "vec_id").limit(FIT_ROWS).collect()
    forest = spark.sparkContext.broadcast(Forest(np.array([r["vector"] for r in sample])))
    queries = rows.where(is_query(F.col("vec_id")))
    asked = queries.count()
    enough, blocks = max(least, int(share * total)), max(1, -(-asked // BLOCK))
    parts = []
    for b in range(blocks):
        chosen = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()
        if not chosen:
            continue
        ids = np.array([r["vec_id"] for r in chosen], np.int64)
        block = spark.sparkContext.broadcast((ids, np.array([r["vector"] for r in chosen])))
        counted = rows.mapInArrow(_counts(forest, block), "query int, length int, held long")
        held = counted.groupBy("query", "length").agg(F.sum("held").alias("held"))
        # The longest prefix that enough entries share; all of them, if even the empty prefix has too few.
        lengths = dict(held.where((F.col("held") >= enough) | (F.col("length") == 0)).groupBy("query").agg(F.max("length")).collect())
        reach = spark.sparkContext.broadcast(np.array([lengths.get(q, 0) for q in range(len(ids))], np.int64))
        parts.append(written(rows.mapInArrow(_nearest(forest, block, reach, k), schema), "neighbours"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    # A shard gives k rows per query at most; the best k of them are ranked.
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _shards(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[Shard]:
    """The rows of a task as shards of bounded size."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, SHARD):
            part = batch.slice(at, SHARD)
            flat = part.column("vector").flatten().to_numpy()
            held.append((part.column("vec_id").to_numpy(), flat.reshape(part.num_rows, -1)))
            size += part.num_rows
            if size >= SHARD:
                yield Shard(forest, *(np.concatenate(c) for c in zip(*held, strict=True)))
                held, size = [], 0
    if size:
        yield Shard(forest, *(np.concatenate(c) for c in zip(*held, strict=True)))


def _counts(forest, block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        codes = forest.value.codes(block.value[1])
        for shard in _shards(batches, forest.value):
            counts = shard.counts(codes)
            total = counts if total is None else total + counts
        if total is not None:
            query, length = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(total[query, length])], ["query", "length", "held"]
            )

    return run


def _nearest(forest, block, reach, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = block.value
        codes = forest.value.codes(queries)
        for shard in _shards(batches, forest.value):
            found = list(shard.nearest(ids, queries, codes, reach.value, k))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], ["query_id", "vec_id", "score"])

    return run


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, "vec_id", "embedding", lambda i: i % 100 == 0, k=10)
