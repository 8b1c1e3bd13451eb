"""Token ids as plane-shuffled binary shards.

A shard is one range of documents in order. Ids go in blocks of fixed size; a block is transposed into
the planes of its ids' bytes (or bits), and each plane is compressed by itself, since the high planes of
small ids are nearly constant. A footer holds the chunk index and the documents' lengths, so that any run of
documents can be read without the rest.

    file    b"PLN1"  chunk*  footer  length of footer (8 bytes, little-endian)  b"PLN1"
    chunk   one zstandard frame: one plane of one block
    footer  zstandard frame of JSON: planes, block, ids, offsets (of every chunk, and the end), docs, lengths
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import spread, table, task_files
from tallyframe.session import scratch_path

#: Ids per block, compression level, the vocabulary and the id that ends a document.
BLOCK, LEVEL, END_ID = 1 << 16, 3, 2
#: Pieces that an encoder remembers before it starts anew: bounds the memory of a worker.
REMEMBERED = 600_000
#: Bytes of text that are encoded at a time, as far as whole documents allow.
TEXT_BYTES = 4 << 20
#: Bytes of shards that one task reads back, as far as whole files allow.
READ_BYTES = 4 << 20
MAGIC = b"PLN1"
# The texts and words of Latin-1 for which any library agrees on letters and digits, and how the
# vocabulary's own pattern cuts such a word.
LATIN, LOWER, PLAIN = re.compile("[\x00-\xff]*"), re.compile("[a-zß-öø-ÿ]+"), re.compile("[!-@[-`{-~a-zß-öø-ÿ]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]| |[^ 0-9a-zß-öø-ÿ]+")
MANIFEST = "shard int, file string, docs long, ids long, bytes long"


class Encoder:
    """Ids of texts by the tokenizers library, which is asked once for each piece between spaces.

    The vocabulary lower-cases text, drops white space, and no token spans either white space or the edge of a
    word, so a text's ids are those of its pieces one after another. Texts of Latin letters are lower-cased
    beforehand, so that pieces recur; words of such letters go to the library's model directly, words with marks
    on them take the ids of their parts, all other pieces go through the library's whole chain.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        octets = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # By code point, all of them: a character that a table lacks costs str.translate an exception.
        self.octets = [chr(c) if c < 0x80 else octets.pre_tokenize_str(chr(c))[0][0] for c in range(0x100)]
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        """Ids of the pieces not met before; a word that has marks on it takes the ids of its parts."""
        known, words, odd, cut = self.known, [], [], []
        for p in new:
            if LOWER.fullmatch(p):
                words.append(p)
            elif PLAIN.fullmatch(p) and "<|" not in p and not PARTS.fullmatch(p):
                cut.append(p)
            else:
                odd.append(p)
        # All such words in one call; the space between two of them is a part of its own, without ids.
        parts, own = PARTS.findall(" ".join(cut)), set(new)
        for p in dict.fromkeys(parts):
            if p not in known and p not in own:
                (words if LOWER.fullmatch(p) else odd).append(p)
        sizes, ids = [], []
        for p in " ".join(words).translate(self.octets).split(" ") if words else []:
            made = self.model.tokenize(p)
            sizes.append(len(made))
            ids += [t.id for t in made]
        for made in self.tokenizer.encode_batch(odd, add_special_tokens=False):
            sizes.append(len(made.ids))
            ids += made.ids
        self._keep([*words, *odd], sizes, ids)
        if cut:
            places = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
            ids, sizes = self._taken(places)
            firsts = np.concatenate([[0], np.flatnonzero(places == known[" "])])
            self._keep(cut, np.add.reduceat(sizes, firsts), ids)

    def _keep(self, pieces: list[str], sizes, ids) -> None:
        place = len(self.starts) - 1
        self.known.update(zip(pieces, range(place, place + len(pieces)), strict=True))
        self.starts = np.concatenate([self.starts, np.cumsum(sizes, dtype=np.int64) + self.starts[-1]])
        self.ids = np.concatenate([self.ids, np.asarray(ids, np.uint32)])

    def _taken(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces at these places, one after another, and how many each has."""
        first = self.starts[places]
        sizes = self.starts[places + 1] - first
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(first - ends + sizes, sizes) + np.arange(sizes.sum())], sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each text has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        texts = [t if "<|" in t or not LATIN.fullmatch(t) else t.lower() for t in texts]
        texts = [t.replace("\n", " ") for t in texts]
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        # Arrow tells equal pieces apart from new ones, so that Python sees each piece of these texts once.
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False)
        places = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(places < 0)
        new = pieces[missing].tolist()
        self._learn(new)
        places[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        ids, sizes = self._taken(places[coded.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])])


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """A worker's encoder, with what it remembers, serves all of its tasks."""
    return Encoder(path)


def to_planes(ids: np.ndarray, planes: str) -> np.ndarray:
    """A block of ids as rows of bytes, one row per plane."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if planes == "byte":
        return octets
    return np.concatenate([np.packbits((octets[k] >> b) & 1)[None] for k in range(4) for b in range(8)])


def from_planes(rows: np.ndarray, count: int, planes: str) -> np.ndarray:
    if planes == "bit":
        bits = np.unpackbits(rows, axis=1, count=count)
        rows = np.stack([sum(bits[8 * k + b] << b for b in range(8)) for k in range(4)]).astype(np.uint8)
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


class ShardWriter:
    """Writes one shard; holds one block of ids at a time, and the documents' lengths for the footer."""

    def __init__(self, folder: str, shard: int, block: int = BLOCK, planes: str = "byte"):
        self.files, self.path = task_files(folder)
        self.files.create_dir(self.path, recursive=True)
        self.shard, self.block, self.planes = shard, block, planes
        self.temporary = f"{self.path}/.{shard:06d}-{uuid.uuid4().hex}.tmp"
        self.out = self.files.open_output_stream(self.temporary, compression=None)
        self.out.write(MAGIC)
        self.offsets, self.docs, self.lengths, self.rest, self.ids = [len(MAGIC)], [], [], np.zeros(0, np.uint32), 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, docs: list, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs += docs
        self.lengths += lengths.tolist()
        self.ids += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        while len(self.rest) >= self.block:
            self._chunks(self.rest[: self.block])
            self.rest = self.rest[self.block :]

    def _chunks(self, ids: np.ndarray) -> None:
        for row in to_planes(ids, self.planes):
            packed = self.packer.compress(row.tobytes())
            self.out.write(packed)
            self.offsets.append(self.offsets[-1] + len(packed))

    def close(self) -> tuple:
        """Ends the file and gives it its name; a row of the manifest."""
        if len(self.rest):
            self._chunks(self.rest)
        about = {"planes": self.planes, "block": self.block, "ids": self.ids, "offsets": self.offsets, "docs": self.docs, "lengths": self.lengths}
        footer = self.packer.compress(json.dumps(about).encode())
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()
        name = f"{self.path}/{self.shard:06d}.planes"
        if self.files.get_file_info(name).type.name != "NotFound":
            self.files.delete_file(name)
        self.files.move(self.temporary, name)
        return self.shard, name.rpartition("/")[2], len(self.docs), self.ids, self.offsets[-1] + len(footer) + 12


class ShardReader:
    def __init__(self, folder: str, name: str):
        files, path = task_files(folder)
        self.file = files.open_input_file(f"{path}/{name}")
        self.unpacker = zstandard.ZstdDecompressor()
        end = self.file.size()
        tail = self.file.read_at(12, end - 12)
        if tail[8:] != MAGIC:
            raise ValueError(f"{name} is not whole")
        length = int.from_bytes(tail[:8], "little")
        about = json.loads(self.unpacker.decompress(self.file.read_at(length, end - 12 - length)))
        self.planes, self.block, self.ids = about["planes"], about["block"], about["ids"]
        self.offsets, self.docs, self.lengths = about["offsets"], about["docs"], about["lengths"]

    def read_block(self, number: int) -> np.ndarray:
        """The ids of one block, through the chunk index."""
        planes = 4 if self.planes == "byte" else 32
        first, count = number * planes, min(self.block, self.ids - number * self.block)
        data = self.file.read_at(self.offsets[first + planes] - self.offsets[first], self.offsets[first])
        at = [o - self.offsets[first] for o in self.offsets[first : first + planes + 1]]
        rows = [np.frombuffer(self.unpacker.decompress(data[a:b]), np.uint8) for a, b in zip(at, at[1:])]
        return from_planes(np.stack(rows), count, self.planes)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Every document with its ids; a block or a document is held at a time."""
        number, held = 0, np.zeros(0, np.uint32)
        for doc, length in zip(self.docs, self.lengths):
            parts = [held]
            got = len(held)
            while got < length:
                parts.append(self.read_block(number))
                got += len(parts[-1])
                number += 1
            ids = np.concatenate(parts) if len(parts) > 1 else held
            yield doc, ids[:length]
            held = ids[length:]


def write_tokens(docs: DataFrame, folder: str, doc_id: str, text: str, vocabulary: str, end_id: int = END_ID, block: int = BLOCK, planes: str = "byte") -> DataFrame:
    """Encode whole texts and write them as shards in ascending order of ``doc_id``; gives the manifest,
    which is kept beside the files and says which of them count.

    Every document ends with ``end_id``; null texts are empty. Null ids come last; rows of equal id are
    ordered by a hash of the text, and repeated rows are written as often as they occur. An empty table gives
    no shard.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    # The hash splits an id that has a large part of the rows.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = encoder_of(vocabulary), None
        for batch in batches:
            # A few MB of text at a time, whatever the rows of a batch are.
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(), dtype=np.int64)
            cuts = np.flatnonzero(np.diff((ends - 1) // TEXT_BYTES)) + 1
            for at, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(at, end - at)
                writer = writer or ShardWriter(folder, TaskContext.get().partitionId(), block, planes)
                ids, counts = encoder.encode(part.column("text").to_pylist())
                ids = np.insert(ids, np.cumsum(counts), end_id)
                writer.add(part.column("doc_id").to_pylist(), counts + 1, ids)
        if writer:
            made = writer.close()
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "file", "docs", "ids", "bytes"), made))], schema=_MANIFEST)

    ranged.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


_MANIFEST = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the shards: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids``."""
    # One row per shard: its ids' sum is known from the manifest.
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = spread(manifest.select("file", "bytes", before.cast("long").alias("start")), "file", "bytes", READ_BYTES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                rows, held, start = [], 0, entry["start"]
                for doc, ids in ShardReader(folder, entry["file"]).documents():
                    rows.append((doc, start, len(ids), ids.astype("<u4").tobytes()))
                    start, held = start + len(ids), held + len(ids)
                    if held > 1 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["doc_id", "start", "n_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)


def op5_token_planes(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents") if docs is None else docs
    folder = scratch_path(spark, "token-planes")
    manifest = write_tokens(docs, folder, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
