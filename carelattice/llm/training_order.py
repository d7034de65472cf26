"""Token sequences in training order: fixed-stride shards behind a keyed permutation.

Documents are encoded to byte-level BPE ids and cut into sequences of ``length`` ids. A sequence is numbered by its task and
its place there, and a keyed Feistel network with cycle-walking permutes all such numbers without any table, count or second
pass. Ranges of the permuted numbers are the shards: a sequence goes straight to its range, is sorted there, and the shard is
written as records of one fixed size. Its global slot is its rank: the records of the shards before plus its place in the
shard, so slots are gapless, and the record of a slot lies at place * stride of its shard. Training reads sequentially,
resumes at any slot and seeks to any sequence. A shard appears at once under its final name; a lost task writes the same again.

Record, little-endian: doc_id int64, place of the sequence in its document int32, number of ids int32, CRC-32 of the ids
uint32, 4 bytes of zeros, then ``length`` uint16 ids, padded with zeros.
"""

from __future__ import annotations

import base64
import struct
import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.llm.elias_fano import local_path
from carelattice.llm.hashing import mix
from carelattice.runtime import cut_lineage, new_shared_path

HEAD = "<qiiII"
HEAD_BYTES = struct.calcsize(HEAD)
LENGTH = 256
#: Bytes of text per shard.
SHARD_TEXT = 32 << 20
ROUNDS = 8
#: Sequences a task can number.
TASK_SPAN = 1 << 32
NO_ID = -(1 << 63)


def feistel(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """Slots of ``index`` (0 to total - 1): a permutation of that range chosen by ``key``."""
    half = np.uint64(max(1, -(-max(total - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % (1 << 64)))
    out = index.astype(np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        x = (left << half) | right
        out[todo] = x
        todo = todo[x >= np.uint64(total)]  # cycle-walking: those outside the range go round again
    return out.astype(np.int64)


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE vocabulary of at most 65,536 ids; ``path`` is a file of ranks."""

    path: str
    pattern: str

    @classmethod
    def public(cls, path: str | None = None) -> Vocabulary:
        import public_tokenizers

        return cls(str(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)

    def encoder(self):
        """text to ids as bytes of uint16."""
        return _encoder(self.path, self.pattern)


@lru_cache(1)
def _encoder(path: str, pattern: str):
    """Made once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if max(ranks.values()) > 0xFFFF:
        raise ValueError("ids must fit 16 bits")
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: array("H", own.encode_ordinary(text)).tobytes()


def sequences(docs: DataFrame, vocabulary: Vocabulary, length: int, key: int, parts: int, shards: int) -> DataFrame:
    """(shard, v, record) of every sequence of (doc_id, text): v is its permuted number, shard the range v lies in."""
    size, total = HEAD_BYTES + 2 * length, parts * TASK_SPAN
    width = -(-total // shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, done = vocabulary.encoder(), TaskContext.get().partitionId(), 0
        if part >= parts:
            raise RuntimeError("more partitions than were planned")
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                records = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    ids = encode(text.as_py() or "")
                    for k in range(-(-len(ids) // (2 * length))):
                        own = ids[2 * length * k : 2 * length * (k + 1)]
                        records.append((struct.pack(HEAD, NO_ID if doc is None else doc, k, len(own) // 2, zlib.crc32(own), 0) + own).ljust(size, b"\0"))
                v = feistel(np.arange(done, done + len(records)) + part * TASK_SPAN, total, key)
                done += len(records)
                yield pa.RecordBatch.from_arrays([pa.array((v // width).astype(np.int32)), pa.array(v), pa.array(records, pa.binary())], names=["shard", "v", "record"])

    return docs.select("doc_id", "text").mapInArrow(run, "shard int, v long, record binary")


def _store(path: str):
    from pyarrow import fs

    name = local_path(path)
    return (fs.LocalFileSystem(), name) if name is not None else fs.FileSystem.from_uri(path)


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        shard, out, draft, n = None, None, "", 0
        reports: list[tuple[int, int]] = []

        def finish() -> None:
            out.close()
            store.move(draft, f"{base}/{shard:08d}.seq")
            reports.append((shard, n))

        for batch in batches:
            for own, record in zip(batch.column("shard").to_pylist(), batch.column("record"), strict=True):
                if own != shard:
                    if out is not None:
                        finish()
                    shard, draft, n = own, f"{base}/_{uuid.uuid4().hex}", 0
                    out = store.open_output_stream(draft)
                out.write(record.as_py())
                n += 1
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in reports], pa.int64()) for c in range(2)], names=["shard", "n"])

    return run


@dataclass(frozen=True)
class Order:
    """Shards under ``folder``; shard i holds the slots from ``offsets[i]`` up to ``offsets[i + 1]``."""

    folder: str
    offsets: tuple[int, ...]
    length: int

    @property
    def stride(self) -> int:
        return HEAD_BYTES + 2 * self.length

    @property
    def total(self) -> int:
        return self.offsets[-1]

    @property
    def shards(self) -> int:
        return len(self.offsets) - 1


def materialise(docs: DataFrame, folder: str | None = None, vocabulary: Vocabulary | None = None, length: int = LENGTH, shard_text: int = SHARD_TEXT, key: int = 1) -> Order:
    """Write the sequences of ``docs`` (doc_id, text) in training order.

    Null and empty texts have no sequence; rows that repeat are separate documents; a null doc_id is kept as null; other
    columns are ignored. An empty table gives empty shards. Ids are integers, or texts of integers; any other id is an error. The driver
    sees one number per shard.
    """
    spark = docs.sparkSession
    folder = folder or new_shared_path(spark, "training-order")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")).first()[0]
    shards, parts = max(1, -(-size // shard_text)), max(1, plain.rdd.getNumPartitions())
    dealt = sequences(plain, vocabulary or Vocabulary.public(), length, key, parts, shards).repartitionById(shards, F.col("shard"))
    done = cut_lineage(dealt.sortWithinPartitions("shard", "v").mapInArrow(_written(folder), "shard long, n long"), "shards-written")
    sizes = np.zeros(shards, np.int64)
    for row in done.collect():
        sizes[row["shard"]] = row["n"]
    return Order(folder, (0, *np.cumsum(sizes).tolist()), length)


def read_slots(order: Order, start: int, count: int) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(slot, doc_id, place, ids) of the slots from ``start``, one seek and then sequential reads."""
    slot, last = start, min(start + count, order.total)
    while slot < last:
        shard = bisect_right(order.offsets, slot) - 1
        store, base = _store(order.folder)
        with store.open_input_stream(f"{base}/{shard:08d}.seq") if slot == order.offsets[shard] else store.open_input_file(f"{base}/{shard:08d}.seq") as f:
            if slot > order.offsets[shard]:
                f.seek((slot - order.offsets[shard]) * order.stride)
            while slot < min(last, order.offsets[shard + 1]):
                record = f.read(order.stride)
                doc, place, n, crc, _ = struct.unpack_from(HEAD, record)
                ids = record[HEAD_BYTES : HEAD_BYTES + 2 * n]
                if zlib.crc32(ids) != crc:
                    raise ValueError(f"slot {slot} is damaged")
                yield slot, None if doc == NO_ID else doc, place, np.frombuffer(ids, np.uint16)
                slot += 1


def read(spark: SparkSession, order: Order, ids: bool = True) -> DataFrame:
    """(slot, shard, offset, doc_id, place, n_tokens, ids_crc32, ids) of all slots, read shard by shard in parallel."""
    schema = "slot long, shard long, offset long, doc_id long, place int, n_tokens int, ids_crc32 long" + ", ids array<int>" * ids
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                rows = []
                first = order.offsets[shard]
                for slot, doc, place, found in read_slots(order, first, order.offsets[shard + 1] - first):
                    head = (slot, shard, (slot - first) * order.stride, doc, place, len(found), zlib.crc32(found.tobytes()))
                    rows.append(head + (found.astype(np.int32),) * ids)
                    if len(rows) == 8192:
                        yield _batch(rows, names, kinds)
                        rows = []
                if rows:
                    yield _batch(rows, names, kinds)

    return spark.range(0, order.shards, 1, order.shards).mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)
