"""Vector code compression: Lloyd's codebooks per part of a vector, over cover trees that tasks build of their rows.

A vector is cut into parts, and each part is coded by the nearest of a few codebook entries. The rows of a
task are built into cover trees once, one per part and some hundred rows, and written as a table. A node covers the
points within its radius, and its children's radii are at most half of it. In each round a
node whose points must all be nearest to one entry, by the triangle inequality, is assigned as a whole: its sum is
a difference of two cumulative sums. Other nodes pass the entries that may still be nearest to their children, and
only points of leaves that stay open are compared one by one. All sums and distances are whole numbers, so the codebooks
are those of the plain method.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import table, written

#: Parts of a vector, entries of a codebook, rounds.
PARTS, ENTRIES, ROUNDS = 8, 16, 6  # at most 256 entries
#: Rows of a set of trees; points of a node that is not parted further.
ROWS, LEAF = 1024, 32
#: Fixed value: whole numbers a component of 1 is. Scaled components are held within this limit, so that 64 bits hold all sums.
SCALE, LIMIT = 4096, 1 << 24


class Trees:
    """One cover tree per part over the same rows.

    ``order`` lists the points (part * rows + row) such that every node covers a range; nodes are listed level by level, with
    ``start``, ``end``, ``radius`` (at least the largest distance from the first point of the range, its centre), and the
    range ``child`` to ``last`` of their children (none: a leaf)."""

    FIELDS = ("order", "start", "end", "radius", "child", "last")

    def __init__(self, points: np.ndarray, **fields: np.ndarray):
        #: (parts, rows, width)
        self.points = points
        self.flat = points.reshape(-1, points.shape[2]).astype(np.int64)
        for name, value in fields.items():
            setattr(self, name, value)

    @classmethod
    def build(cls, points: np.ndarray) -> Trees:
        parts, rows, width = points.shape
        flat = points.reshape(-1, width).astype(np.int64)
        order = np.arange(parts * rows, dtype=np.int32)
        start = np.arange(parts, dtype=np.int64) * rows
        end = start + rows
        radius = np.sqrt(square(flat, flat[np.repeat(start, rows)]).reshape(parts, rows).max(axis=1).astype(np.float64))
        found = {"start": [start], "end": [end], "radius": [radius], "child": [], "last": []}
        known = parts
        while len(start):
            open_ = (end - start > LEAF) & (radius > 0)
            split = cls._split(flat, order, start[open_], end[open_], radius[open_] / 2)
            of, fresh_start, fresh_end, fresh_radius = split
            children = np.bincount(of, minlength=int(open_.sum()))
            child, last = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
            last[open_] = known + np.cumsum(children)
            child[open_] = last[open_] - children
            found["child"].append(child)
            found["last"].append(last)
            start, end, radius = fresh_start, fresh_end, fresh_radius
            known += len(start)
            for name, value in (("start", start), ("end", end), ("radius", radius)):
                found[name].append(value)
        joined = {name: np.concatenate(value) for name, value in found.items()}
        joined = {name: value.astype(np.float64 if name == "radius" else np.int32) for name, value in joined.items()}
        return cls(points, order=order, **joined)

    @staticmethod
    def _split(flat: np.ndarray, order: np.ndarray, start: np.ndarray, end: np.ndarray, reach: np.ndarray):
        """Part nodes into children: the first free point of every node becomes a centre and takes what it reaches,
        until no point is free. Sorts ``order`` in place; gives the node, range and radius of each child."""
        sizes = end - start
        node = np.repeat(np.arange(len(start)), sizes)
        place = np.repeat(start - np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), sizes) + np.arange(len(node)) if len(node) else np.zeros(0, np.int64)
        owner, far = np.zeros(len(node), np.int64), np.zeros(len(node), np.float64)
        free, limit = np.arange(len(node)), reach**2
        while len(free):
            first = np.flatnonzero(np.diff(node[free], prepend=-1))
            centre = np.repeat(free[first], np.diff(np.append(first, len(free))))
            apart = square(flat[order[place[free]]], flat[order[place[centre]]])
            near = apart <= limit[node[free]]
            owner[free[near]], far[free[near]] = centre[near], apart[near]
            free = free[~near]
        sorted_ = np.lexsort((owner, node))
        # The centre is the first of its own range, since the sort is stable and it is the first point it takes.
        order[place] = order[place[sorted_]]
        owner, far = owner[sorted_], far[sorted_]
        head = np.flatnonzero(np.diff(owner, prepend=-1))
        tail = np.append(head[1:], len(owner))
        radius = np.sqrt(np.maximum.reduceat(far, head)) if len(head) else np.zeros(0)
        begin = place[head] if len(head) else np.zeros(0, np.int64)
        return node[head], begin, begin + tail - head, radius

    def assign(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry of every ordered point, and sums (parts, entries, width) and counts of the points of each entry."""
        parts, rows, width = self.points.shape
        entries = books.shape[1]
        sorted_ = self.flat[self.order]
        running = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(sorted_, axis=0)])
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        code = np.zeros(parts * rows, np.uint8)
        nodes = np.arange(parts)
        alive = np.ones((parts, entries), bool)
        while len(nodes):
            part = self.start[nodes] // max(1, rows)
            centre = sorted_[self.start[nodes]]
            apart = to_entries(centre, part, books)
            near = np.where(alive, apart, np.iinfo(np.int64).max)
            best = near.argmin(axis=1)
            distance = np.sqrt(apart.astype(np.float64))
            least = distance[np.arange(len(nodes)), best]
            # A point is within the radius of the centre, so an entry this much farther off is nearest to none. The slack is
            # far above the error of the roots; it only keeps more entries.
            bound = least + 2 * self.radius[nodes]
            alive &= distance <= (bound * (1 + 1e-9) + 1e-6)[:, None]
            whole = (alive.sum(axis=1) == 1) | (self.radius[nodes] == 0)
            self._take(nodes[whole], (part * entries + best)[whole], running, sums, counts, code, entries)
            leaf = ~whole & (self.child[nodes] == self.last[nodes])
            self._compare(nodes[leaf], alive[leaf], sorted_, books, sums, counts, code, rows)
            inner = ~whole & ~leaf
            sizes = self.last[nodes[inner]] - self.child[nodes[inner]]
            alive = np.repeat(alive[inner], sizes, axis=0)
            nodes = ranges(self.child[nodes[inner]], sizes)
        return code, sums.reshape(parts, entries, width), counts.reshape(parts, entries)

    def _take(self, nodes, slots, running, sums, counts, code, entries) -> None:
        start, end = self.start[nodes], self.end[nodes]
        np.add.at(sums, slots, running[end] - running[start])
        np.add.at(counts, slots, end - start)
        code[ranges(start, end - start)] = np.repeat(slots % entries, end - start)

    def _compare(self, nodes, alive, sorted_, books, sums, counts, code, rows) -> None:
        entries = books.shape[1]
        sizes = self.end[nodes] - self.start[nodes]
        place = ranges(self.start[nodes], sizes)
        alive = np.repeat(alive, sizes, axis=0)
        part = place // max(1, rows)
        apart = to_entries(sorted_[place], part, books)
        best = np.where(alive, apart, np.iinfo(np.int64).max).argmin(axis=1)
        np.add.at(sums, part * entries + best, sorted_[place])
        np.add.at(counts, part * entries + best, 1)
        code[place] = best

    def codes(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, parts) and the squared distances of each row, summed over its parts."""
        parts, rows, _ = self.points.shape
        flat = np.empty(parts * rows, np.uint8)
        flat[self.order] = self.assign(books)[0]
        code = flat.reshape(parts, rows)
        apart = square(self.flat.reshape(parts, rows, -1), books[np.arange(parts)[:, None], code])
        return code.T, apart.sum(axis=0)


def square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, exact."""
    gap = a - b
    return (gap * gap).sum(axis=-1)


def to_entries(points: np.ndarray, part: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Squared distances of points, in order of their parts, to the entries of their part's codebook."""
    out = np.empty((len(points), books.shape[1]), np.int64)
    bounds = np.searchsorted(part, np.arange(len(books) + 1))
    for book, low, high in zip(books, bounds, bounds[1:]):
        some = points[low:high]
        out[low:high] = (some * some).sum(axis=1)[:, None] - 2 * (some @ book.T) + (book * book).sum(axis=1)
    return out


def ranges(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.arange(ends[-1]) + np.repeat(start - (ends - sizes), sizes)


def width_of(length: int, parts: int = PARTS) -> int:
    return -(-length // parts)


def as_parts(whole: np.ndarray, parts: int) -> np.ndarray:
    """Rows of vectors as (parts, rows, width); a length that the parts do not divide is filled up with zeros."""
    width = width_of(whole.shape[1], parts)
    full = np.zeros((len(whole), parts * width), np.int32)
    full[:, : whole.shape[1]] = whole
    return np.ascontiguousarray(full.reshape(len(whole), parts, width).transpose(1, 0, 2))


def whole_vectors(rows: DataFrame, vector: str, keep: list[Column], scale: int = SCALE) -> DataFrame:
    """``row`` (the columns ``keep``) and ``whole``, the vector in whole numbers; vectors null or with a null or
    non-finite component are left out."""
    value = rows[vector]
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = F.transform(value, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return rows.where(value.isNotNull() & finite).select(F.struct(*keep).alias("row"), held.alias("whole"))


def plant(held: DataFrame, length: int, parts: int = PARTS) -> DataFrame:
    """Trees over all rows as a table in the shared folder, some hundred rows of ``held`` in each."""
    layout = T.StructType([T.StructField("rows", T.ArrayType(held.schema["row"].dataType)), T.StructField("points", T.BinaryType()), *(T.StructField(n, T.BinaryType()) for n in Trees.FIELDS)])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                whole = part.column("whole").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, length)
                trees = Trees.build(as_parts(whole, parts))
                rows = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("row"))
                data = [trees.points, *(getattr(trees, name) for name in Trees.FIELDS)]
                yield pa.RecordBatch.from_arrays([rows, *(pa.array([x.tobytes()], pa.binary()) for x in data)], layout.names)

    return written(held.mapInArrow(build, layout), "code-trees")


def grown(batch: pa.RecordBatch, at: int, parts: int, width: int) -> Trees:
    kinds = {"radius": np.float64}
    read = {n: np.frombuffer(batch.column(n)[at].as_buffer(), kinds.get(n, np.int32)) for n in Trees.FIELDS}
    points = np.frombuffer(batch.column("points")[at].as_buffer(), np.int32)
    return Trees(points.reshape(parts, -1, width), **read)


def lloyd(trees: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) after the rounds. A task sends one sum per entry; unused entries stay."""
    parts, entries, width = books.shape
    for _ in range(rounds):
        current = books

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(current.shape, np.int64), np.zeros(current.shape[:2], np.int64)
            for batch in batches:
                for at in range(batch.num_rows):
                    _, more, number = grown(batch, at, parts, width).assign(current)
                    total += more
                    count += number
            data = np.concatenate([total, count[..., None]], axis=2).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(data))), pa.array(data)], ["place", "value"])

        read = trees.select("points", *Trees.FIELDS).mapInArrow(sums, "place long, value long")
        found = np.zeros(parts * entries * (width + 1), object)
        for row in read.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
            found[row["place"]] = int(row["value"])
        found = found.reshape(parts, entries, width + 1)
        count = found[..., width:]
        books = np.where(count > 0, found[..., :width] // np.maximum(count, 1), books).astype(np.int64)
    return books


def compress(rows: DataFrame, vec_id: str, vector: str, keep: list[Column], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """``row`` (the columns ``keep``), ``code`` and ``error`` of every vector that takes part, and the codebooks.

    Left out are vectors that are null or hold a null or non-finite component, and those of another length than the most
    frequent one (the shorter of equally frequent ones). A length that the parts do not divide counts as filled up with
    zeros. Scaled components beyond 2^24 count as 2^24. The codebooks start with the rows of smallest id, ids that
    repeat ordered by their vectors, null ids last; with fewer rows there are fewer entries. Without rows there are no
    codebooks, and None comes in their place."""
    held = whole_vectors(rows, vector, [rows[vec_id].alias("first_by"), F.struct(*keep).alias("kept")])
    usual = held.groupBy(F.size("whole").alias("length")).count().orderBy(F.desc("count"), "length").first()
    layout = T.StructType([*held.select("row.kept").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if usual is None or not usual["length"]:
        return rows.sparkSession.createDataFrame([], layout), None
    length = usual["length"]
    held = held.where(F.size("whole") == length)
    seeds = held.orderBy(F.asc_nulls_last("row.first_by"), "whole").limit(entries).select("whole").collect()
    books = as_parts(np.array([r["whole"] for r in seeds], np.int64), parts).astype(np.int64)
    width = books.shape[2]
    trees = plant(held.select(F.col("row.kept").alias("row"), "whole"), length, parts)
    books = lloyd(trees, books, rounds)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                codes, errors = grown(batch, at, parts, width).codes(books)
                texts = [row.tobytes().hex() for row in np.ascontiguousarray(codes)]
                yield pa.RecordBatch.from_arrays([batch.column("rows")[at].values, pa.array(texts), pa.array(errors)], ["kept", "code", "error"])

    return trees.mapInArrow(code, layout), books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    coded, books = compress(rows, "vec_id", "embedding", [rows["vec_id"], rows["label"]])
    coded = written(coded.select("kept.vec_id", "kept.label", "code", "error"), "codes")
    digest = hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()
    # Sums are partial in every task; a label of very many rows is split by adaptive execution in the join.
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """Lloyd's rounds written out: nearest entries, then floor of the mean per entry and position."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(least(greatest(x::DOUBLE * 4096, -16777216), 16777216)) AS BIGINT)) AS whole
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), usual AS (
  SELECT len(whole) AS length, (len(whole) + 7) // 8 AS width FROM kept GROUP BY ALL ORDER BY count(*) DESC, 1 LIMIT 1
), named AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, whole) AS rn FROM kept, usual WHERE len(whole) = length
), parts AS MATERIALIZED (
  SELECT rn, p, width, list_transform(range(1, width + 1), lambda i: coalesce(whole[p * width + i], 0)) AS v
  FROM named, range(8) AS t(p)
), book0 AS MATERIALIZED (SELECT p, rn - 1 AS entry, v FROM parts WHERE rn <= 16)"""
    ]
    for k in range(7):
        steps.append(
            f"""near{k} AS MATERIALIZED (
  SELECT rn, p, any_value(v) AS v, min({{d: d, e: entry}}) AS best FROM (
    SELECT a.rn, a.p, a.v, b.entry, list_sum(list_transform(range(1, a.width + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))::BIGINT AS d
    FROM parts a JOIN book{k} b USING (p)) GROUP BY rn, p
)"""
        )
        if k < 6:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(n.v, b.v) AS v FROM book{k} b LEFT JOIN (
    SELECT p, entry, list((s - ((s % c) + c) % c) // c ORDER BY i) AS v FROM (
      SELECT p, best.e AS entry, i, sum(v[i])::BIGINT AS s, count(*) AS c FROM near{k}, usual, range(1, width + 1) AS t(i) GROUP BY ALL)
    GROUP BY p, entry) n ON n.p = b.p AND n.entry = b.entry
)"""
            )
    steps.append(
        """coded AS (
  SELECT rn, string_agg(format('{:02x}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near6 GROUP BY rn
), digest AS (
  SELECT sha256(coalesce(string_agg(x, ',' ORDER BY p, entry), '')) AS codebooks_sha256 FROM (SELECT p, entry, array_to_string(v, ',') AS x FROM book6)
)"""
    )
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN named USING (rn), digest"""


OP11_SQL = _sql()
