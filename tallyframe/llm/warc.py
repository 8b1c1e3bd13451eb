"""WARC archives: sorted by id, rolled by compressed size, committed through names and manifests.

A shard is one range of record ids. Where ranges end follows from the rows alone: from a histogram of the records
that a hash of their key chooses, so another run, cluster or partitioning gives the same shards and files. A shard's
task writes records in order, each a gzip member of its own, closes a file when it has grown to the given size, and
gives files their final name only once they are whole. What belongs to the archive is what the manifest table lists; files of lost attempts have
temporary names, or are replaced by equal ones.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import sampled, spread, table, task_files, written
from tallyframe.session import scratch_path

#: Compressed bytes at which a file is closed, and payload bytes from which equal ones are kept once.
ROLL_BYTES, SHARED_BYTES = 64 << 20, 100
#: Payload bytes of a shard, shards at most (each grows beyond that), records of the histogram per shard and in all, and
#: bytes of files that one task reads back.
SHARD_BYTES, MOST_SHARDS, PER_SHARD, IN_ALL, READ_BYTES = 64 << 20, 50_000, 400, 1_000_000, 4 << 20
#: The profile of a revisit, the date of all records unless the caller names one.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

BOUNDS = "shard int, record_id long, payload_digest string"
MANIFEST = "shard int, file string, records long, bytes long, sha256 string"
RECORD = "record_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_urn(record_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{record_id}:{digest}')}>"


def record_bytes(record_id, url, payload: bytes | None, size: int, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One record. A revisit has no block and names the record that holds its payload."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_urn(record_id, digest + 'r' * revisit)}",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}")
    if record_id is not None:
        head.append(f"X-Record-Number: {record_id}")
    head += [f"X-Payload-Length: {size}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        block = b""
        head.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            head += [f"WARC-Refers-To: {record_urn(refers_to, digest)}", f"X-Refers-To-Number: {refers_to}"]
    else:
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
        block = http.encode() + payload
    head += [
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_rolled(records: Iterable[bytes], folder: str, shard: int, roll_bytes: int) -> Iterator[tuple]:
    """Write a shard's records; a manifest row per file. Equal records give equal files."""
    files, path = task_files(folder)
    files.create_dir(path, recursive=True)
    attempt, out, count, number = uuid.uuid4().hex, None, 0, 0

    def close():
        out.close()
        name = f"{shard:06d}-{number:05d}.warc.gz"
        if files.get_file_info(f"{path}/{name}").type.name != "NotFound":
            files.delete_file(f"{path}/{name}")
        files.move(f"{path}/.{attempt}-{number}.tmp", f"{path}/{name}")
        return shard, name, count, size, digest.hexdigest()

    for record in records:
        member = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = member.compress(record) + member.flush()
        if out is not None and size + len(packed) > roll_bytes:
            yield close()
            out, number = None, number + 1
        if out is None:
            out, count, size, digest = files.open_output_stream(f"{path}/.{attempt}-{number}.tmp", compression=None), 0, 0, hashlib.sha256()
        out.write(packed)
        digest.update(packed)
        count, size = count + 1, size + len(packed)
    if out is not None:
        yield close()


def bounds_of(keys: DataFrame, shard_bytes: int) -> list[tuple[int | None, str]]:
    """The first key (id, digest) of every shard but the first, in order, nulls last.

    ``keys`` has ``record_id``, ``payload_digest`` and ``payload_bytes`` of every record. Of all keys those with the
    smallest hashes are taken, ``1.2 * PER_SHARD`` for each shard and ``1.2 * IN_ALL`` at most, and cut where their bytes
    come to a shard's part; they bound how uneven shards are, not what is in them.
    """
    rows, total = keys.agg(F.count("*"), F.sum("payload_bytes")).first()
    shards = min(MOST_SHARDS, -(-(total or 0) // shard_bytes))
    if shards < 2:
        return []
    key = ["record_id", "payload_digest"]
    chosen = sampled(keys, F.xxhash64(*key), min(PER_SHARD * shards, IN_ALL), rows).groupBy(*key).agg(F.sum("payload_bytes").alias("size")).collect()
    chosen.sort(key=lambda r: place_of(r["record_id"], r["payload_digest"]))
    whole, before, bounds = sum(r["size"] for r in chosen), 0, []
    for row in chosen:
        if before * shards >= (len(bounds) + 1) * whole:
            bounds.append((row["record_id"], row["payload_digest"]))
        before += row["size"]
    return bounds


def place_of(record_id: int | None, digest: str) -> tuple:
    """What records are ordered by: ids, nulls last, then digests."""
    return record_id is None, record_id or 0, digest


def write_archive(
    pages: DataFrame, folder: str, record_id: str, url: str, payload: str, roll_bytes=ROLL_BYTES, shared=SHARED_BYTES, date=DATE, shard_bytes=SHARD_BYTES
) -> DataFrame:
    """Write one record per row below ``folder``; gives the manifest, which is kept beside the files, as are the bounds
    of the shards.

    Of rows with equal payloads of at least ``shared`` bytes, those with the smallest id hold the
    payload, others revisit it. Null payloads count as empty. Null ids come last and refer to the smallest id
    there is; where there is none, all of them hold the payload. A repeated row is written again, like any
    row, with the same record id. A null url leaves its header out; an empty table gives an archive of no files.
    Equal tables give equal files. Records of one id and payload are in one shard.
    """
    spark = pages.sparkSession
    rows = pages.select(
        pages[record_id].cast("long").alias("record_id"), pages[url].alias("url"),
        F.coalesce(pages[payload], F.lit("")).cast("binary").alias("payload"),
    ).select("*", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    keys = written(rows.select("record_id", "payload_digest", "payload_bytes"), "warc-keys")
    # Digests meet, not payloads; only those that occur more than once go back to the rows.
    first = (
        keys.where(F.col("payload_bytes") >= shared)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("record_id").alias("first_id"), F.count("*").alias("times"))
        .where(F.col("times") > 1)
        .drop("times")
    )
    marked = rows.join(written(first, "warc-first"), F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    records = marked.select(
        "record_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, F.col("first_id")).alias("refers_to"), revisit.alias("revisit"),
    )
    bounds = bounds_of(keys, shard_bytes)
    spark.createDataFrame([(n, *key) for n, key in enumerate(bounds, 1)], BOUNDS).write.parquet(f"{folder}/bounds")
    places = spark.sparkContext.broadcast([place_of(*key) for key in bounds])

    @F.arrow_udf("int")
    def shard_of(ids: pa.Array, digests: pa.Array) -> pa.Array:
        held = zip(ids.to_pylist(), digests.to_pylist(), strict=True)
        return pa.array([bisect_right(places.value, place_of(*key)) for key in held], pa.int32())

    order = [F.col("shard").asc(), F.col("record_id").asc_nulls_last(), F.col("payload_digest").asc(), F.col("url").asc()]
    dealt = records.select("*", shard_of("record_id", "payload_digest").alias("shard")).repartitionById(len(bounds) + 1, "shard")
    ranged = dealt.sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
            for batch in batches
            for i in range(batch.num_rows)
        )
        for shard, held in groupby(rows, lambda row: row["shard"]):
            packed = (
                record_bytes(
                    row["record_id"], row["url"], row["payload"], row["payload_bytes"], row["payload_digest"],
                    row["refers_to"], row["revisit"], date,
                )
                for row in held
            )
            for entry in write_rolled(packed, folder, shard, roll_bytes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([entry[0]], pa.int32()), pa.array([entry[1]]), pa.array([entry[2]]), pa.array([entry[3]]), pa.array([entry[4]])],
                    ["shard", "file", "records", "bytes", "sha256"],
                )

    ranged.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_records(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of each record of an archive file; digests are checked."""
    with gzip.GzipFile(fileobj=stream) as file:
        while line := file.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"not the start of a record: {line[:40]!r}")
            head = {}
            while (line := file.readline()) != b"\r\n":
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                head[name] = value
            block = file.read(int(head["Content-Length"]))
            if file.read(4) != b"\r\n\r\n" or head["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                raise ValueError(f"damaged record {head['WARC-Record-ID']}")
            yield head, block


def read_archive(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files that the manifest lists. Payload size and digest of a response are taken
    from its block; a revisit states those of the payload that it refers to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = task_files(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    yield from _batches(read_records(stream), payloads)

    return spread(manifest.select("file", "bytes"), "file", "bytes", READ_BYTES).mapInArrow(read, RECORD)


def _batches(records: Iterator[tuple[dict, bytes]], payloads: bool, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("record_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )
    rows, size = [], 0
    number = lambda value: None if value is None else int(value)
    for head, block in records:
        kind, digest, length, payload = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["X-Payload-Length"]), None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            length, stated, digest = len(payload), digest, hashlib.sha256(payload).hexdigest()
            if digest != stated:
                raise ValueError(f"another payload than stated: {head['WARC-Record-ID']}")
        rows.append(
            (number(head.get("X-Record-Number")), head.get("WARC-Target-URI"), payload if payloads else None, length, digest, kind,
             number(head.get("X-Refers-To-Number")))
        )
        size += len(block) + 200
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = write_archive(table(spark, sf_dir, "pages"), folder, "page_id", "url", "html")
    return read_archive(manifest, folder, payloads=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP6_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
firsts AS (
  SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
    CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM firsts
"""
