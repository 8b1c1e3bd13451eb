"""Near-duplicates by HyperMinHash.

A document's shingles are hashed once each into buckets; a bucket keeps the smallest hash as a
leading-zero count and ten mantissa bits, in two bytes. Bands of registers give keys; documents that share
a key are candidates. An estimate from the registers, corrected for chance collisions, drops
pairs that are far below the threshold, and links are confirmed on the full shingle sets.

Within a key not all pairs are made. All members are first compared with one pivot, the member
whose keys gather the most documents (an original gathers its copies), and components of the confirmed
links are formed. Members outside of a key's largest component are then compared with all members of other
components, in blocks and without making pairs, on two bytes of every shingle: that bounds an intersection from
above, so only pairs that are linked, or nearly so, come out and go to the full sets. In the end every
pair that shares a key is confirmed, refuted, or within one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import table, written
from tallyframe.llm.components import components

#: Registers of a band, bands, mantissa bits; at 80% a pair shares no band with probability 5e-9.
ROWS, BANDS, MANTISSA = 5, 48, 10
REGISTERS = ROWS * BANDS
#: Members of a block, and outsiders that meet a block at a time.
BLOCK, OUTSIDERS = 512, 2_048
#: Standard errors by which an estimate may miss the threshold without being dropped.
ERRORS = 6.0
# Small letters for capitals on UTF-8 bytes; constants of a 64-bit finalizer; the share of
# collisions between registers of unequal sets, as published for HyperMinHash.
OCTETS = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
COLLISION = 0.169919487159739093975315012348630288992


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it has grown."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``size`` are one shingle, none give none."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    acc = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
    acc ^= acc >> np.uint64(33)
    acc *= np.uint64(MIX[0])
    acc ^= acc >> np.uint64(33)
    acc *= np.uint64(MIX[1])
    acc ^= acc >> np.uint64(33)
    return np.unique(acc)


@lru_cache(maxsize=1)
def _order() -> np.ndarray:
    """For every register the others in an order of its own: where an empty one borrows."""
    return np.argsort(np.random.default_rng(1).random((REGISTERS, REGISTERS)), axis=1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a set that is not empty: length in bits of the smallest hash, then its leading mantissa
    bits. Empty buckets borrow from others, so that bands of small sets agree no more than those of large ones."""
    value = (shingles & np.uint64((1 << 40) - 1)).astype(np.float64) + 1
    fraction, exponent = np.frexp(value)
    code = (exponent << MANTISSA) | ((2 * fraction - 1) * (1 << MANTISSA)).astype(np.int64)
    out = np.full(REGISTERS, 0xFFFF, np.int64)
    np.minimum.at(out, ((shingles >> np.uint64(40)) % np.uint64(REGISTERS)).astype(np.int64), code)
    filled = out != 0xFFFF
    if not filled.all():
        empty = np.flatnonzero(~filled)
        order = _order()[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out.astype("<u2")


def may_reach(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs may be as similar as ``percent``: by their sizes, and by the share of equal registers
    less what chance gives, within six standard errors."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    ratio = small / large
    chance = COLLISION * 2.0 ** (1 - MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    estimate = ((a == b).mean(axis=-1) - chance) / (1 - chance)
    t = percent / 100
    filled = REGISTERS * -np.expm1(-large / REGISTERS)
    return (100 * small >= percent * large) & (estimate + ERRORS * np.sqrt(2 * t * (1 - t) / filled) >= t)


def _hashed(size: int, whole: bool):
    """Documents to their sets: whole, or as size, fingerprint and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            if len(hashes) > 1_000_000:
                hashes.clear()
            at = batch.schema.get_field_index("text")
            counts, prints, sketches, sets, shorts = [], [], [], [], []
            for text in batch.column(at):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(OCTETS).split()
                shingles = shingle_set(words, size, hashes)
                data = shingles.tobytes()
                if whole:
                    sets.append(data)
                    shorts.append(shingles.astype("<u2").tobytes())
                    continue
                counts.append(len(shingles))
                prints.append(hashlib.blake2b(data, digest_size=16).digest() if data else None)
                sketches.append(sketch(shingles).tobytes() if data else None)
            kept = [(n, batch.column(k)) for k, n in enumerate(batch.schema.names) if k != at]
            if whole:
                kept += [("shingles", pa.array(sets, pa.binary())), ("short", pa.array(shorts, pa.binary()))]
            else:
                kept += [("n", pa.array(counts, pa.int32())), ("print", pa.array(prints, pa.binary())), ("sketch", pa.array(sketches, pa.binary()))]
            yield pa.RecordBatch.from_arrays([c for _, c in kept], [n for n, _ in kept])

    return run


def near_duplicates(docs: DataFrame, doc_id: str, text: str, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: ``doc_id``, ``text_hash`` (xxhash64 of the text), ``n_shingles``,
    ``component_id`` (smallest id that links reach), ``kept`` (doc_id is component_id).

    Sets are linked when 100 * intersection >= percent * union; equal sets are one class, so copies
    cost one comparison. Null or empty texts have no set and stay by themselves. A component in which no
    row has an id has a null id, and one of its rows is kept. Repeated rows are of one class. A column of
    any name may carry id and text; an empty table gives no rows.
    """
    held = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("h"))
    rows = held.mapInArrow(_hashed(shingle, False), "id long, h long, n int, print binary, sketch binary")
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "nd-rows")
    # A class stands for all rows of equal sets; the row of smallest number lends it its text.
    classes = written(
        rows.where(F.col("n") > 0).groupBy("print").agg(F.min("id").alias("first_id"), F.min("rid").alias("node")), "nd-classes"
    )
    nodes = rows.join(classes.select("node"), F.col("rid") == F.col("node"), "left_semi").select("rid", "id", "h", "n", "sketch")
    nodes = written(nodes.withColumnRenamed("rid", "node"), "nd-nodes")

    key = F.explode(
        F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substr("sketch", b * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    )
    bands = nodes.select("node", key.alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    members = written(bands.join(shared, "key"), "nd-members")
    involved = nodes.join(members.select("node").distinct(), "node", "left_semi")
    sketches = written(involved.select("node", "n", "sketch"), "nd-sketches")
    wanted = involved.select("node", F.col("id").alias("of_id"), F.col("h").alias("of_h"))
    texts = held.join(wanted, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")), "inner").select("node", "text")
    sets = written(texts.dropDuplicates(["node"]).mapInArrow(_hashed(shingle, True), "node long, shingles binary, short binary"), "nd-sets")

    weight = members.groupBy("node").agg(F.sum("held").alias("weight"))
    ranked = members.select("key", "node").join(weight, "node")
    full = sets.select("node", "shingles")
    links = written(_confirmed(_stars(ranked), sketches, full, percent), "nd-links")
    labels = components(links)
    rest = _cross(written(_open(members, labels), "nd-open"), sets.select("node", "short"), percent)
    more = written(_confirmed(rest, sketches, full, percent), "nd-links")
    if not more.isEmpty():
        labels = components(links.unionAll(more))

    grouped = classes.join(labels, "node", "left").select("print", "first_id", "node", F.coalesce("root", "node").alias("root"))
    grouped = written(grouped, "nd-grouped")
    ids = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"), F.min("node").alias("stand_in"))
    of_print = grouped.join(ids, "root").select(F.col("print").alias("of"), "component_id", "stand_in")
    joined = rows.select("id", "h", "n", "print", "rid").join(of_print, F.col("print") == F.col("of"), "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    kept = F.when(F.col("n") == 0, True).when(F.col("component_id").isNull(), F.col("rid") == F.col("stand_in"))
    return joined.select(
        F.col("id").alias("doc_id"), F.col("h").alias("text_hash"), F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"), kept.otherwise(F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def _stars(ranked: DataFrame) -> DataFrame:
    """Pairs of every member of a key with the key's heaviest, of equal ones that of smallest number."""
    best = ranked.groupBy(F.col("key").alias("of")).agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("best"))
    pairs = ranked.join(best, F.col("key") == F.col("of")).select("node", (-F.col("best.minus")).alias("pivot"))
    return pairs.where(F.col("node") != F.col("pivot")).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the keys that hold more than one component: ``key``, ``node``, ``label``, and of the key
    ``held`` (members), ``top`` (label of its largest component) and ``outside`` (members of others)."""
    named = members.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("label"))
    parts = named.groupBy("key", "label").agg(F.count("*").alias("part"))
    of_key = parts.groupBy(F.col("key").alias("of")).agg(
        F.sum("part").alias("held"), F.max(F.struct("part", "label")).alias("most")
    )
    mixed = of_key.select("of", "held", F.col("most.label").alias("top"), (F.col("held") - F.col("most.part")).alias("outside"))
    return named.join(mixed.where(F.col("outside") > 0), F.col("key") == F.col("of")).drop("of")


def _cross(open_: DataFrame, shorts: DataFrame, percent: int) -> DataFrame:
    """The pairs between an outsider of a key and members of other components that may be linked.

    Members are dealt into blocks and outsiders into portions; a group holds one of each, so its size is
    bounded, and all that it gives are pairs that reach the threshold on two bytes of every shingle.
    """
    blocks, portions = F.ceil(F.col("held") / BLOCK).cast("int"), F.ceil(F.col("outside") / OUTSIDERS).cast("int")
    place = F.xxhash64("node")
    outside = F.col("label") != F.col("top")
    members = open_.select(
        "key", "node", "label", outside.alias("outside"), F.lit(False).alias("asks"),
        F.pmod(place, blocks).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), portions - 1)).alias("j"),
    )
    asking = open_.where(outside).select(
        "key", "node", "label", F.lit(True).alias("outside"), F.lit(True).alias("asks"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"), F.pmod(place, portions).cast("int").alias("j"),
    )

    def compare(frame):
        import pandas as pd

        asks = frame["asks"].to_numpy()
        node, label, outside = (frame[c].to_numpy() for c in ("node", "label", "outside"))
        mine = np.flatnonzero(~asks)
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        short = [np.frombuffer(x, "<u2") for x in frame["short"]]
        if len(mine):
            n = np.array([len(short[k]) for k in mine])
            flat, starts = np.concatenate([short[k] for k in mine]), np.cumsum(n) - n
            for x in np.flatnonzero(asks):
                known = np.zeros(1 << 16, bool)
                known[short[x]] = True
                both = np.add.reduceat(known[flat], starts, dtype=np.int64)
                both = np.minimum(both, len(short[x]))
                # A pair of two outsiders is met from both sides; one is enough.
                near = (100 * both >= percent * (n + len(short[x]) - both)) & (label[mine] != label[x]) & (~outside[mine] | (node[mine] > node[x]))
                y = node[mine[near]]
                found_a.append(np.minimum(y, node[x]))
                found_b.append(np.maximum(y, node[x]))
        return pd.DataFrame({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    return members.unionAll(asking).join(shorts, "node").groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the threshold on their full sets."""

    def beside(frame: DataFrame, right: DataFrame, side: str) -> DataFrame:
        names = [F.col(c).alias(f"{c}_{side}") for c in right.columns]
        return frame.join(right.select(*names), F.col(side) == F.col(f"node_{side}")).drop(f"node_{side}")

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            a, b = (np.frombuffer(b"".join(get(f"sketch_{s}").to_pylist()), "<u2").reshape(-1, REGISTERS) for s in "ab")
            near = may_reach(a, b, get("n_a").to_numpy(), get("n_b").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([get("a"), get("b")], ["a", "b"]).filter(pa.array(near))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            linked = []
            for a, b in zip(get("shingles_a"), get("shingles_b"), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([get("a"), get("b")], ["a", "b"]).filter(pa.array(linked))

    near = beside(beside(pairs, sketches, "a"), sketches, "b").mapInArrow(estimated, "a long, b long")
    return beside(beside(near, sets, "a"), sets, "b").mapInArrow(compared, "a long, b long")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", shingle=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, doc_id: str, text: str, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that ``near_duplicates`` keeps, all columns: one document of each group.

    Rows that repeat both id and text are one document, which stays once; rows without words all stay.
    """
    found = near_duplicates(docs, doc_id, text, shingle, percent).where("kept")
    kept = found.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_h"), "n_shingles").distinct()
    held = docs.select(F.struct(*docs.columns).alias("row"), docs[doc_id].cast("long").alias("id"), F.xxhash64(docs[text]).alias("h"))
    rows = held.join(kept, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")), "inner")
    single = F.when(F.col("n_shingles") == 0, F.monotonically_increasing_id()).otherwise(-1)
    return rows.withColumn("single", single).dropDuplicates(["id", "h", "single"]).select("row.*")
