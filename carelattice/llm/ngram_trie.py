"""N-gram language model in an Elias-Fano trie.

Level 1 is the vocabulary: the sorted 64-bit hashes of all training tokens, with exact counts. Level k holds, per n-gram of
order k - 1 (its node), the ids of the words that follow it. A level consists of Elias-Fano sequences: the nodes that have
successors, the successor ids, made monotone by starting each node above the last value of the one before, and monotone pointers
to these starts. A query looks up the node, adds the node's start to the word id and makes one search among the successors.
Beside them lie the discounted probabilities and, per n-gram, its back-off weight, both quantised to 16 bits of log10.

Smoothing is interpolated absolute discounting: P(w | context) = max(c - D, 0) / c(context) + B(context) P(w | shorter
context), down to the add-0.1 unigrams. n-grams of order 2 and above that are seen less than ``keep`` times are not stored;
their mass is in B, so the probabilities of all words still add up to one.

Spark counts and shuffles: a task counts the n-grams of its documents and sends each shard one compact block, so a very
frequent word or pair costs one entry per block. Shards take ranges of nodes, so that neighbours in a block are close and a node is
looked up in one place; the successors of frequent nodes are spread over all shards by a hash of (node, word). A few neighbouring
shards are merged one after the other and written as one file in the shared folder, memory-mapped by the tasks that score. Every
file appears at once under its final name with the same content, however often its task runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.elias_fano import EliasFano, Growing, open_arrays, write_arrays
from carelattice.llm.hashing import mix
from carelattice.runtime import cut_lineage, new_shared_path

#: The end token; no word holds a blank.
END = b" end "
PSEUDO = 0.1
DISCOUNT = 0.75
#: log10 values are stored in steps of LOWEST / 65535.
LOWEST = -16.0
#: Tokens of the training text per shard.
TOKENS_PER_SHARD = 4_000_000
#: More shards than this share files, up to as many a file: searches in few large files cost less than in many small ones.
FILES, SHARDS_PER_FILE = 32, 8
#: Back-off weights are written in blocks of so many nodes.
BLOCK = 1 << 20
#: Bytes of text that are taken apart and looked up at once; a document is never divided.
CHUNK = 5_000_000
#: Tokens that are counted before anything is sent.
COUNTED = 1_600_000
#: A node with more than this part of a shard's tokens is frequent; there are about as many of them a shard at most.
FREQUENT = 64


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(log10, LOWEST, 0) / LOWEST * 65535).astype(np.uint16)


def restored(q: np.ndarray) -> np.ndarray:
    return q.astype(np.float64) / 65535 * LOWEST


#: Probability of each quantised value.
PROBABILITY = 10 ** restored(np.arange(1 << 16))


@dataclass
class Nodes:
    """How the nodes of a level are dealt to its shards: ranges of ids, but the ``frequent`` ones to all shards."""

    total: int
    shards: int
    frequent: np.ndarray

    def start(self, shard: np.ndarray | int) -> np.ndarray | int:
        return -(-shard * self.total // self.shards)

    @property
    def width(self) -> int:
        return -(-self.total // self.shards)

    def in_file(self, shard: np.ndarray | int, keys: np.ndarray, per_file: int) -> np.ndarray:
        """Numbers of nodes among all of the shards in a file."""
        return keys + shard % per_file * (self.width + len(self.frequent))

    def places(self, nodes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard of each n-gram, and the number of its node there: place in the range, frequent ones above all of them."""
        shard = nodes * self.shards // max(1, self.total)
        key = nodes - self.start(shard)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, nodes), len(self.frequent) - 1)
            some = np.flatnonzero(self.frequent[at] == nodes)
            shard[some] = shard_of(pair_hash(nodes[some], words[some]), self.shards)
            key[some] = self.width + at[some]
        return shard, key

    def ids(self, shard: int, keys: np.ndarray) -> np.ndarray:
        out = keys + self.start(shard)
        spread = keys >= self.width
        out[spread] = self.frequent[keys[spread] - self.width]
        return out


@dataclass
class Level:
    """Files of one order. ``offsets``: id of the first n-gram of each shard, and the total at the end.

    ``frequent``: ascending ids of the n-grams that are frequent as nodes of the next level.
    """

    folder: str
    order: int
    offsets: list[int]
    frequent: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    nodes: Nodes | None = None
    per_file: int = 1
    backoff: str | None = None
    _open: dict = field(default_factory=dict, repr=False)

    @property
    def shards(self) -> int:
        return len(self.offsets) - 1

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    @cached_property
    def starts(self) -> np.ndarray:
        """Id of the first n-gram of each file, and the total at the end."""
        return np.array([*self.offsets[: -1 : self.per_file], self.offsets[-1]])

    def file(self, number: int) -> dict:
        if number not in self._open:
            arrays = open_arrays(f"{self.folder}/{number}.ef") if self.starts[number + 1] > self.starts[number] else {}
            names = {k.rpartition(".")[0] for k in arrays if k.endswith(".meta")}
            self._open[number] = arrays | {n: EliasFano.opened(arrays, n) for n in names}
        return self._open[number]

    def _by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = _order(shard)
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for part in np.split(order, cuts):
            if len(part):
                yield int(shard[part[0]]), part

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        for number, part in self._by_shard(np.searchsorted(self.starts, ids, "right") - 1):
            out[part] = self.file(number)["counts"][ids[part] - self.starts[number]]
        return out

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of word hashes, -1 for unknown words (order 1)."""
        out = np.full(len(hashes), -1, np.int64)
        for number, part in self._by_shard(shard_of(hashes, self.shards) // self.per_file):
            found = self.file(number)
            if found:
                at = found["words"].find(hashes[part] - least_hash(number * self.per_file, self.shards))
                out[part] = np.where(at >= 0, at + self.starts[number], -1)
        return out

    def successors(self, nodes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the n-grams (node, word), -1 where not stored, and their discounted probability. Fast if nodes ascend."""
        out, direct = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes))
        shards, keys = self.nodes.places(nodes, words)
        keys = self.nodes.in_file(shards, keys, self.per_file)
        for number, part in self._by_shard(shards // self.per_file):
            found = self.file(number)
            if not found:
                continue
            node = keys[part]
            # equal neighbours are looked up once
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            at = found["nodes"].find(node[first])
            times = np.diff(first, append=len(node))
            part = part[np.repeat(at >= 0, times)]
            start, end = (np.repeat(x, times[at >= 0]) for x in found["pointers"].neighbours(at[at >= 0]))
            want = start + words[part].astype(np.uint64)
            part, want = part[want < end], want[want < end]
            at = found["next"].find(want)
            part, at = part[at >= 0], at[at >= 0]
            out[part] = at + self.starts[number]
            direct[part] = PROBABILITY[found["logs"][at]]
        return out, direct

    def backoffs(self, ids: np.ndarray) -> np.ndarray:
        """Back-off weights of n-grams."""
        out = np.ones(len(ids))
        if self.backoff is not None:
            for block, part in self._by_shard(ids // BLOCK):
                key = ("backoff", block)
                if key not in self._open:
                    self._open[key] = open_arrays(f"{self.backoff}/{block}.q")["logs"]
                out[part] = PROBABILITY[self._open[key][ids[part] % BLOCK]]
        return out


@dataclass
class Model:
    """``tokens``: N, ``distinct``: V of the training text."""

    tokens: int
    distinct: int
    levels: list[Level]

    @cached_property
    def unknown(self) -> float:
        return PSEUDO / (self.tokens + PSEUDO * (self.distinct + 1))

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of word hashes, -1 for unknown words, their unigram probability and its log10."""
        ids = self.levels[0].words(hashes)
        counts = np.zeros(len(ids))
        counts[ids >= 0] = self.levels[0].counts_of(ids[ids >= 0])
        unigram = (counts + PSEUDO) / (self.tokens + PSEUDO * (self.distinct + 1))
        return ids, unigram, np.log10(unigram)

    def chunk(self, word: np.ndarray, low: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 of the model probability per token, from its id and unigram probability. ``ends``: where documents end."""
        low, node = low.copy(), contexts(word, ends, self._end)
        for k, level in enumerate(self.levels[1:], 1):
            # distinct (context, word) of the chunk, looked up once
            some = np.flatnonzero(node >= 0)
            pairs, where = _pairs(node[some], word[some])
            known = np.flatnonzero(pairs[:, 1] >= 0)
            found, direct = np.full(len(pairs), -1, np.int64), np.zeros(len(pairs))
            found[known], direct[known] = level.successors(pairs[known, 0], pairs[known, 1])
            low[some] = direct[where] + self.levels[k - 1].backoffs(pairs[:, 0])[where] * low[some]
            if k + 1 < len(self.levels):
                grams = np.full(len(word), -1, np.int64)
                grams[some] = found[where]
                node = contexts(grams, ends, -1)
        return np.log10(low)

    @cached_property
    def _end(self) -> int:
        return int(self.levels[0].words(np.array([xxhash.xxh64_intdigest(END)], np.uint64))[0])


def _pairs(node: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (node, word), -1 allowed in either, and the place of every pair among them; packed in one integer where it fits."""
    bits = (int(word.max(initial=0)) + 1).bit_length()
    if (int(node.max(initial=0)) + 2) << bits < 1 << 63:
        packed, where = np.unique((node + 1) << bits | word + 1, return_inverse=True)
        return np.stack([(packed >> bits) - 1, (packed & (1 << bits) - 1) - 1]).T, where
    return np.unique(np.stack([node, word], axis=1), axis=0, return_inverse=True)


def contexts(ids: np.ndarray, ends: np.ndarray, first: int) -> np.ndarray:
    """Id that precedes each token; ``first`` at the beginning of a document."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.empty(0, np.int64)
    out[starts] = first
    return out


def _order(shard: np.ndarray) -> np.ndarray:
    """Stable order by shard; small numbers are sorted by digits, ascending ones not at all."""
    if (shard[1:] >= shard[:-1]).all():
        return np.arange(len(shard))
    return np.argsort(shard.astype(np.uint16) if shard.max() < 1 << 16 else shard, kind="stable")


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the leading bits: ranges of hashes, equal shares of them."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def least_hash(shard: int, shards: int) -> np.uint64:
    """Smallest hash that ``shard_of`` gives this shard."""
    return np.uint64(-(-(shard << 32) // shards) << 32)


def pair_hash(nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(mix(nodes.astype(np.uint64)) + words.astype(np.uint64))


def _tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of distinct words, the place of every token among them, and where documents end; every document ends with END."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words = lists.flatten().dictionary_encode()
    distinct, at = words.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False), words.indices.to_numpy()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in (*distinct, END)), np.uint64, len(distinct) + 1)
    # white space at either end of a text leaves an empty word
    kept = at != next(iter(np.flatnonzero(distinct == b"")), -1)
    before = np.concatenate([[0], np.cumsum(kept)])
    upto = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    ends = before[upto[1:]] + np.arange(len(text))
    out = np.full(before[-1] + len(text), len(distinct), np.int32)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = at[kept]
    return hashes, out, ends


def token_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, hashes of distinct words, places of tokens among them, ends) of about CHUNK bytes of text each."""
    for batch in batches:
        text = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
        sizes = pc.binary_length(text).to_numpy()
        group = np.cumsum(sizes + 1, dtype=np.int64) // CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            if first < last:
                yield batch.slice(first, last - first), *_tokens(text.slice(first, last - first).view(pa.string()))


class Files:
    """Files of one level: arrays of a few neighbouring shards, which come in order, are joined in each."""

    def __init__(self, folder: str, per_file: int) -> None:
        self.folder, self.per_file, self.number = folder, per_file, None

    def enter(self, shard: int) -> None:
        if shard // self.per_file != self.number:
            self.close()
            self.number, self.top, self.sequences, self.plain = shard // self.per_file, 0, {}, {}

    def add(self, sequences: dict[str, np.ndarray], plain: dict[str, np.ndarray]) -> None:
        for name, values in sequences.items():
            self.sequences.setdefault(name, Growing()).add(values)
        for name, values in plain.items():
            self.plain.setdefault(name, []).append(values)

    def close(self) -> None:
        if self.number is not None and self.sequences:
            if "pointers" in self.sequences:
                # the end of the last node
                self.sequences["pointers"].add(np.array([self.top]))
            arrays = {k: v for name, growing in self.sequences.items() for k, v in growing.arrays(name).items()}
            write_arrays(f"{self.folder}/{self.number}.ef", arrays | {name: np.concatenate(parts) for name, parts in self.plain.items()})
        self.number = None


def _write_level(blocks: DataFrame, order: int, write, files: Files | None = None) -> DataFrame:
    """Merge the blocks of every shard with ``write(shard, blobs) -> (n, total, nodes, masses)`` and read back what it reports.

    A row per shard has n and total, further ones the masses of its nodes, packed by blocks of BLOCK nodes. ``write`` may add the
    places of frequent n-grams in the shard; they stand in a row of block -1.
    """
    schema = "shard long, n long, total long, block long, blob binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(shard: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
            n, total, node, mass, *frequent = write(shard, blobs)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "n": n, "total": total}], schema=out)
            yield from (pa.RecordBatch.from_pylist([{"shard": shard, "block": -1, "blob": f.astype(np.int64).tobytes()}], schema=out) for f in frequent)
            cuts = np.searchsorted(node, np.arange(0, (int(node[-1]) // BLOCK + 2) * BLOCK, BLOCK)) if len(node) else []
            for block, (first, last) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if first < last:
                    yield pa.RecordBatch.from_pylist([{"shard": shard, "block": block, "blob": _masses(node[first:last] - block * BLOCK, mass[first:last])}], schema=out)

        out = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])
        shard, blobs = None, []
        for batch in batches:
            for s, blob in zip(batch.column("shard").to_pylist(), batch.column("blob"), strict=True):
                if s != shard and blobs:
                    yield from done(shard, blobs)
                    blobs = []
                shard = s
                blobs.append(blob.as_py())
        if blobs:
            yield from done(shard, blobs)
        if files:
            files.close()

    return cut_lineage(blocks.repartition(F.expr(f"shard div {files.per_file if files else 1}")).sortWithinPartitions("shard").mapInArrow(run, schema), f"lm-level-{order}")


@cache
def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def _pressed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _codec().compress(data, asbytes=True)


def _restored(blob: bytes) -> pa.Buffer:
    return _codec().decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"))


def _blob(*arrays: np.ndarray, values: np.ndarray = np.empty(0)) -> bytes:
    """Sorted integer columns, the first as differences, in the narrowest kinds that hold them, byte by byte of all values."""
    cols = [np.diff(arrays[0], prepend=arrays[0].dtype.type(0)), *arrays[1:]]
    cols = [c.astype(np.min_scalar_type(int(c.max()))) if len(c) else c.astype(np.uint8) for c in cols]
    head = np.array([len(arrays[0]), *[c.itemsize for c in cols]], np.int64).tobytes()
    return _pressed(head + b"".join(c.view(np.uint8).reshape(-1, c.itemsize).T.tobytes() for c in cols) + values.tobytes())


def _masses(node: np.ndarray, mass: np.ndarray) -> bytes:
    """Ascending places within a block and their masses; these are few different numbers."""
    values, at = np.unique(mass, return_inverse=True)
    return _blob(node.astype(np.uint64), at, values=values.astype(np.float64))


def _add_masses(blob: bytes, total: np.ndarray) -> None:
    node, at, values = _unblob(blob, 2, values=True)
    total[node.astype(np.int64)] += values[at.astype(np.int64)]


def _unblob(blob: bytes, columns: int, values: bool = False) -> list[np.ndarray]:
    data = _restored(blob)
    n, *sizes = np.frombuffer(data, np.int64, columns + 1)
    at, out = 8 * (columns + 1), []
    for size in sizes:
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out.append(planes.T.copy().view(f"u{size}").reshape(n).astype(np.uint64))
        at += int(n * size)
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return [*out, np.frombuffer(data, np.uint8, offset=at).copy().view(np.float64)] if values else out


def _summed(blobs: list[bytes], columns: int) -> list[np.ndarray]:
    """Merged keys (all but the last column) in order, and the sums of the last column."""
    parts = [_unblob(b, columns) for b in blobs]
    cols = [np.concatenate([p[c] for p in parts]) for c in range(columns)]
    del parts
    bits = np.uint64(int(cols[1].max()).bit_length() if columns == 3 else 0)
    if columns == 2 or (int(cols[0].max()) + 1) << int(bits) < 1 << 64:
        # one integer a key
        key = cols[0] if columns == 2 else cols[0] << bits | cols[1]
        order = np.argsort(key)
        key, n = key[order], cols[-1][order]
        del cols, order
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, n = key[starts], np.add.reduceat(n, starts)
        return [key, n] if columns == 2 else [key >> bits, key & (np.uint64(1) << bits) - np.uint64(1), n]
    order = np.lexsort(cols[-2::-1])
    cols = [c[order] for c in cols]
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols[:-1]], axis=0)
    starts = np.flatnonzero(new)
    return [*(c[starts] for c in cols[:-1]), np.add.reduceat(cols[-1], starts)]


def _offsets(report: DataFrame, shards: int) -> list[int]:
    """One number per shard; shards are millions of tokens each."""
    sizes = np.zeros(shards, np.int64)
    for row in report.where("n IS NOT NULL").select("shard", "n").collect():
        sizes[row["shard"]] = row["n"]
    return [0, *np.cumsum(sizes).tolist()]


def _frequent(report: DataFrame, offsets: list[int]) -> np.ndarray:
    """Ids of frequent n-grams, about FREQUENT a shard at most."""
    rows = report.where("block = -1").select("shard", "blob").collect()
    return np.sort(np.concatenate([np.empty(0, np.int64), *(np.frombuffer(r["blob"], np.int64) + offsets[r["shard"]] for r in rows)]))


def fit(train: DataFrame, order: int = 2, keep: int = 2, shards: int | None = None) -> Model:
    """Model of the rows of ``train`` (text binary, null: empty). An empty table gives a model of unknown words only."""
    spark = train.sparkSession
    train = train.select("text")
    total_bytes = train.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")).first()[0]
    n_shards = shards or max(1, round(total_bytes / 6 / TOKENS_PER_SHARD))
    often = max(1, total_bytes // 6 // n_shards // FREQUENT)
    per_file = min(SHARDS_PER_FILE, -(-n_shards // FILES))
    folder = new_shared_path(spark, "lm")

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, _ in _grouped((hashes[at], ends) for _, hashes, at, ends in token_chunks(batches)):
            unique, counts = np.unique(hashes, return_counts=True)
            yield from _dealt(shard_of(unique, n_shards), n_shards, unique, counts.astype(np.uint64))

    files = Files(f"{folder}/1", per_file)

    def write_words(shard: int, blobs: list[bytes]):
        words, counts = _summed(blobs, 2)
        files.enter(shard)
        files.add({"words": words - least_hash(shard // per_file * per_file, n_shards)}, {"counts": counts.astype(np.min_scalar_type(int(counts.max())))})
        return len(words), int(counts.sum()), np.empty(0, np.int64), np.empty(0), np.flatnonzero(counts > often)

    report = _write_level(train.mapInArrow(vocabulary, "shard long, blob binary"), 1, write_words, files)
    offsets = _offsets(report, n_shards)
    tokens = report.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    levels = [Level(f"{folder}/1", 1, offsets, _frequent(report, offsets), per_file=per_file)]
    for k in range(2, order + 1):
        if not offsets[-1]:
            break
        partial = Model(tokens, levels[0].offsets[-1], levels)
        levels.append(_next_level(train, partial, folder, k, keep, n_shards, often, k == order))
    return Model(tokens, levels[0].offsets[-1], levels)


def _grouped(chunks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbouring chunks (values, ends) joined up to COUNTED tokens, to count more before anything is sent."""
    held, size = [], 0
    for values, ends in chunks:
        held.append((values, ends + size))
        size += len(values)
        if size >= COUNTED:
            yield np.concatenate([v for v, _ in held]), np.concatenate([e for _, e in held])
            held, size = [], 0
    if held:
        yield np.concatenate([v for v, _ in held]), np.concatenate([e for _, e in held])


def _dealt(shard: np.ndarray, shards: int, *columns: np.ndarray, kinds: int = 1) -> Iterator[pa.RecordBatch]:
    """One block per shard of columns sorted by the first (and second) one; shards are numbered in steps of ``kinds``."""
    order = _order(shard)
    cuts = np.searchsorted(shard[order], np.arange(shards + 1) * kinds)
    ids, blobs = [], []
    for s in range(shards):
        part = order[cuts[s] : cuts[s + 1]]
        if len(part):
            ids.append(s)
            blobs.append(_blob(*(c[part] for c in columns)))
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "blob"])


def _next_level(train: DataFrame, model: Model, folder: str, k: int, keep: int, shards: int, often: int, top: bool) -> Level:
    spark, below = train.sparkSession, model.levels[-1]
    nodes, per_file = Nodes(below.offsets[-1], shards, below.frequent), below.per_file
    files = Files(f"{folder}/{k}", per_file)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for word, ends in _grouped((model.levels[0].words(hashes)[at], ends) for _, hashes, at, ends in token_chunks(batches)):
            node = contexts(word, ends, model._end)
            for level in model.levels[1:]:
                pairs, where = _pairs(node, word)
                grams = np.full(len(pairs), -1, np.int64)
                some = pairs[:, 0] >= 0
                grams[some] = level.successors(pairs[some, 0], pairs[some, 1])[0]
                node = contexts(grams[where], ends, -1)
            some = node >= 0
            node, word = node[some].astype(np.uint64), word[some].astype(np.uint64)
            if model.distinct < 1 << 31 and below.offsets[-1] < 1 << 32:
                packed, n = np.unique(node << np.uint64(31) | word, return_counts=True)
                node, word = packed >> np.uint64(31), packed & np.uint64((1 << 31) - 1)
            else:
                both, n = np.unique(np.stack([node, word], axis=1), axis=0, return_counts=True)
                node, word = both.T
            if len(node):
                shard, key = nodes.places(node.astype(np.int64), word.astype(np.int64))
                # frequent nodes come last in a shard, as their numbers are above the others
                yield from _dealt(2 * shard + (key >= nodes.width), shards, key.astype(np.uint64), word, n.astype(np.uint64), kinds=2)

    def write(shard: int, blobs: list[bytes]):
        node, word, n = _summed(blobs, 3)
        kept = n >= keep
        node, word, n = node[kept], word[kept], n[kept].astype(np.int64)
        if not len(node):
            return 0, 0, np.empty(0, np.int64), np.empty(0)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        last = np.concatenate([first[1:], [len(node)]]) - 1
        files.enter(shard)
        start = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word[last] + np.uint64(1), dtype=np.uint64)]) + np.uint64(files.top)
        files.top = int(start[-1])
        owner = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(node)]])))
        own = nodes.ids(shard, node[first].astype(np.int64))
        share = (n - DISCOUNT) / below.counts_of(own)[owner]
        logs = quantised(np.log10(share))
        sequences = {"nodes": nodes.in_file(shard, node[first].astype(np.int64), per_file), "pointers": start[:-1], "next": word + start[owner]}
        # counts are only asked for by the next level
        files.add(sequences, {"logs": logs} | ({} if top else {"counts": n.astype(np.min_scalar_type(int(n.max())))}))
        ascending = np.argsort(own)
        # what is taken away is the quantised share, so that the weights close the sum exactly
        report = len(node), int(n.sum()), own[ascending], np.add.reduceat(PROBABILITY[logs], first)[ascending]
        return report if top else (*report, np.flatnonzero(n > often))

    report = _write_level(train.mapInArrow(count, "shard long, blob binary"), k, write, files)
    offsets = _offsets(report, shards)
    level = Level(f"{folder}/{k}", k, offsets, _frequent(report, offsets), nodes, per_file)
    below.backoff = f"{folder}/{k - 1}-backoff"
    target, total = below.backoff, below.offsets[-1]

    def write_backoffs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, taken = None, None
        done = []

        def flush():
            if block is not None:
                write_arrays(f"{target}/{block}.q", {"logs": quantised(np.log10(np.maximum(1 - taken, 10**LOWEST)))})
                done.append(block)

        for batch in batches:
            for own, blob in zip(batch.column("block").to_pylist(), batch.column("blob"), strict=True):
                if own != block:
                    flush()
                    block, taken = own, np.zeros(min(BLOCK, total - own * BLOCK))
                if blob.is_valid:
                    _add_masses(blob.as_py(), taken)
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["block"])

    # one row per block, so that blocks without successors exist as well; shards in order, so that sums repeat
    every = spark.range(-(-total // BLOCK)).select(F.col("id").alias("block"), F.lit(-1).cast("long").alias("shard"), F.lit(None).cast("binary").alias("blob"))
    rows = report.where("block >= 0").select("block", "shard", "blob").unionByName(every)
    cut_lineage(rows.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(write_backoffs, "block long"), "lm-backoffs")
    return level


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(key..., n_tokens, n_known, train_tokens, base_score, score) per row of ``docs`` with a binary column text."""
    keys = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keys) + ", n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, hashes, at, ends in token_chunks(batches):
            word, unigram, base = (values[at] for values in model.words(hashes))
            known, full = word >= 0, model.chunk(word, unigram, ends)
            starts = np.concatenate([[0], ends[:-1] + 1])
            sums = [np.diff(np.concatenate([[0], ends + 1])), *(np.add.reduceat(x, starts) for x in (known.astype(np.int64), base, full))]
            arrays = [rows.column(c) for c in keys] + [pa.array(sums[0]), pa.array(sums[1]), pa.array(np.full(len(ends), model.tokens)), pa.array(sums[2]), pa.array(sums[3])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(*keys, "text").mapInArrow(run, schema)


def held_out(doc_id: str) -> Column:
    """Rows that never train: crc32 of the id as text leaves 0 modulo 10; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def fit_and_score(docs: DataFrame, order: int = 2, keep: int = 2) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) with a model of those that are not held out.

    Null and empty texts are the end token alone. Rows that repeat are counted and scored as often as they occur; other
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), held_out("doc_id").alias("held_out"))
    model = fit(rows.where(~F.col("held_out")), order, keep)
    return score(rows, model)
