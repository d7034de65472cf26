"""Near-duplicate classes by MinHash with tensored banding.

A document is the set of its distinct five-word shingles. Two collections of ``side`` short minhash tuples are computed per
set; every pair of a tuple of the first with a tuple of the second is a table key. ``side`` squared tables of
``2 * rows`` minhashes each thus cost ``2 * side * rows`` minhashes instead of ``2 * side**2 * rows``.

1. Equal sets (128-bit fingerprint and size) collapse to the smallest doc_id before any key is made.
2. Members of a bucket are compared with one centre only, first inside each Arrow batch, so that a batch sends at most one
   row per key through the shuffle, then among the centres of the batches. A bucket never makes all its pairs.
3. Pairs whose signatures agree five standard deviations below the threshold are dropped; all others are confirmed on
   the full sets, rebuilt from the whole texts. Members of a centre are dealt in blocks, the centre's text once per block.
4. Confirmed links are contracted to components; a further round, with another order of centres for all keys, looks only at pairs
   of different components. That joins large groups at about one pair per member. A component leaves when its buckets hold
   no other. Where a round finds few links, as among documents of one template just below the threshold, no more rounds follow.
5. The rounds, at most ``ROUNDS``, only make the components few. All documents whose buckets still hold several components
   are then joined by an exact prefix filter on their shingles, so that no pair of them is lost for never having met a
   centre. A shingle with many sets is dealt to cells of bounded size on both sides of the join.

A pair with similarity s shares a key with probability 1 - 2(1 - s**rows)**side at least: 0.9999 at 0.75 and 0.99999 at 0.8
with the defaults. Every pair that shares one ends in one component by the rounds, or is compared by the last step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.components import components
from carelattice.llm.hashing import WordHashes, constants, mix, windows
from carelattice.llm.small import if_few
from carelattice.runtime import cut_lineage

#: Members of a centre that are confirmed in one block; the centre's text travels once per block.
BLOCK = 256
#: Rounds of centres at most, before the exact join.
ROUNDS = 3
#: A round with fewer links than a share of 1 / FEW of the open documents is the last one.
FEW = 10
#: Cells at most of the table of shingle frequencies, two bytes each; every task of the last step holds it.
MOST_CELLS = 1 << 23
#: Cells in one row of that table.
CELL_BLOCK = 1 << 14
#: Sets of a shingle that are compared in one cell; sets of a shingle that has more are dealt to several.
CELL_SETS = 4096
#: Shingles up to which the list of those that are dealt is broadcast (32 MB).
BROADCAST_SHINGLES = 1_000_000
#: Pairs a task holds before it hands the distinct ones on.
HELD_PAIRS = 1 << 20


@dataclass(frozen=True)
class Banding:
    """``percent``: similarity from which documents are linked; ``side`` tuples of ``rows`` minhashes in either collection."""

    width: int = 5
    percent: int = 75
    side: int = 12
    rows: int = 2

    @property
    def hashes(self) -> int:
        return 2 * self.side * self.rows

    @property
    def agreeing(self) -> int:
        """Fewest equal minhashes of a pair that is confirmed on the full sets."""
        s = self.percent / 100
        return max(1, int(self.hashes * s - 5 * (self.hashes * s * (1 - s)) ** 0.5))


def shingles(text: bytes, cache: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text; A-Z are lower-cased, words end at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = cache.of(words)
    if len(words) < width:
        return windows(hashes, len(words), seed=7 + len(words))
    return np.unique(windows(hashes, width))


def signature(found: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """32-bit minhashes of a non-empty set."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        part = found[None, at : at + 4096]
        np.minimum(least, ((part ^ seeds[:, None]) * seeds[::-1, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(docs: DataFrame, banding: Banding) -> DataFrame:
    """(id, n, fp_a, fp_b, sig) per row of ``docs`` (id, text binary); sig is null for an empty set."""
    schema = "id long, n long, fp_a long, fp_b long, sig binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seeds = WordHashes(), constants(banding.hashes, 11)
        for batch in batches:
            n, a, b, sigs = [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py() or b"", cache, banding.width)
                n.append(len(found))
                a.append(int(found.sum(dtype=np.uint64).astype(np.int64)) if len(found) else 0)
                b.append(int(mix(found).sum(dtype=np.uint64).astype(np.int64)) if len(found) else 0)
                sigs.append(signature(found, seeds).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sigs, pa.binary())],
                names=["id", "n", "fp_a", "fp_b", "sig"],
            )

    return docs.select("id", "text").mapInArrow(run, schema)


def table_keys(sigs: np.ndarray, banding: Banding) -> np.ndarray:
    """(documents, side * side) keys of the tables from (documents, hashes) signatures."""
    half = sigs.reshape(len(sigs), 2, banding.side, banding.rows).astype(np.uint64)
    tuples = np.zeros(half.shape[:3], np.uint64)
    for r in range(banding.rows):
        tuples = mix(tuples + half[..., r] + np.uint64(r + 1))
    tuples += constants(2 * banding.side, 23).reshape(1, 2, banding.side)
    pairs = mix(tuples[:, 0])[:, :, None] * np.uint64(0x9E3779B97F4A7C15) + mix(tuples[:, 1])[:, None, :]
    return mix(pairs).reshape(len(sigs), -1)


def _stars(keys, prio, ids, comps):
    """Centres of all keys, and pairs (centre, member) of different components; all arguments are flat and parallel."""
    order = np.lexsort((prio, keys))
    keys, ids, comps = keys[order], ids[order], comps[order]
    first = np.empty(len(keys), bool)
    first[:1] = True
    first[1:] = keys[1:] != keys[:-1]
    centre = np.flatnonzero(first)[np.cumsum(first) - 1]
    member = ~first & (comps != comps[centre])
    pairs = np.unique(np.stack([ids[centre[member]], ids[member]], axis=1), axis=0) if member.any() else np.empty((0, 2), np.int64)
    return order[first], pairs


def candidates(nodes: DataFrame, banding: Banding, round_: int) -> DataFrame:
    """Distinct pairs (a, b) of ``nodes`` (id, comp, sig) that a bucket's centre makes, components differing.

    The centre is the member with the smallest hashed id, so most buckets of a group share it and few distinct pairs arise.
    """
    schema = "k long, prio long, a long, b long, comp long"

    def rows(k, prio, a, b, comp) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(prio.astype(np.int64)), pa.array(a), b, pa.array(comp)], names=["k", "prio", "a", "b", "comp"])

    def pair_rows(pairs: np.ndarray) -> pa.RecordBatch:
        k = mix(mix(pairs[:, 0].astype(np.uint64)) + pairs[:, 1].astype(np.uint64))
        nought = np.zeros(len(pairs), np.int64)
        return rows(k, nought, pairs[:, 0], pa.array(pairs[:, 1]), nought)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                ids, comps = batch.column("id").to_numpy(), batch.column("comp").to_numpy()
                sigs = np.stack([np.frombuffer(s.as_py(), np.uint32) for s in batch.column("sig")])
                keys = table_keys(sigs, banding)
                ids, comps, keys = np.repeat(ids, keys.shape[1]), np.repeat(comps, keys.shape[1]), keys.ravel()
                prio = mix(ids.astype(np.uint64) + np.uint64(round_)) >> np.uint64(1)
                firsts, pairs = _stars(keys, prio, ids, comps)
                yield rows(keys[firsts], prio[firsts], ids[firsts], pa.nulls(len(firsts), pa.int64()), comps[firsts])
                if len(pairs):
                    yield pair_rows(pairs)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None, None)
        for batch in batches:
            is_pair = batch.column("b").is_valid().to_numpy(zero_copy_only=False)
            a = batch.column("a").to_numpy()
            out = [np.stack([a[is_pair], batch.column("b").filter(pa.array(is_pair)).to_numpy()], axis=1)] if is_pair.any() else []
            if not is_pair.all():
                own = ~is_pair
                k, ids, comps = batch.column("k").to_numpy()[own], a[own], batch.column("comp").to_numpy()[own]
                first = np.empty(len(k), bool)
                first[0] = k[0] != last[0]
                first[1:] = k[1:] != k[:-1]
                at = np.cumsum(first)
                heads = np.flatnonzero(first)
                centres = np.concatenate([[last[1] if last[1] is not None else 0], ids[heads]])[at]
                theirs = np.concatenate([[last[2] if last[2] is not None else 0], comps[heads]])[at]
                member = ~first & (comps != theirs)
                if member.any():
                    out.append(np.stack([centres[member], ids[member]], axis=1))
                last = (k[-1], int(centres[-1]), int(theirs[-1]))
            if out:
                pairs = np.unique(np.concatenate(out), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    dealt = nodes.select("id", "comp", "sig").mapInArrow(local, schema).repartition("k").sortWithinPartitions("k", "prio")
    return dealt.mapInArrow(merged, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def plausible(pairs: DataFrame, nodes: DataFrame, banding: Banding) -> DataFrame:
    """Pairs whose set sizes and signatures allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(s.as_py() for s in batch.column(c)), np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                good = (left == right).sum(axis=1) >= banding.agreeing
                yield batch.select(["a", "b"]).filter(pa.array(good))

    side = lambda x: nodes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= banding.percent * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, banding: Banding) -> DataFrame:
    """Pairs (a, b) linked by their full sets. ``texts``: (id, text binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, block, centres = WordHashes(), None, []
        for batch in batches:
            a_out, b_out = [], []
            for a, salt, b, text in zip(*(batch.column(c) for c in ("a", "salt", "b", "text")), strict=True):
                a, salt, b = a.as_py(), salt.as_py(), b.as_py()
                found = shingles(text.as_py() or b"", cache, banding.width)
                if block != (a, salt):
                    block, centres = (a, salt), []
                if b is None:
                    centres.append(found)
                elif any(similar(c, found, banding.percent) for c in centres):
                    a_out.append(a)
                    b_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    # most centres have one block: only the members of the others are joined to the number of blocks
    counted = cut_lineage(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks")), "blocks")
    large = counted.where("blocks > 1")
    large = if_few(large, large.count())
    centres = counted.select(F.col("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), F.col("a").alias("id"))
    whole = pairs.join(large, "a", "left_anti").select("a", F.lit(0).cast("long").alias("salt"), "b", F.col("b").alias("id"))
    dealt = pairs.join(large, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("salt"), "b", F.col("b").alias("id"))
    members = whole.unionByName(dealt)
    rows = centres.unionByName(members).join(texts, "id").select("a", "salt", "b", "text")
    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _of_components(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` with the components of both sides."""
    known = lambda x: labels.select(F.col("id").alias(x), F.col("comp").alias(f"comp_{x}"))
    return pairs.join(known("a"), "a").join(known("b"), "b")


def _open(nodes: DataFrame, found: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes of the components that ``found``, pairs of different components, leads out of.

    In a bucket of several components the centre and a member of every other one are in ``found``, so all its components appear.
    """
    ids = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    comps = labels.join(ids, "id", "left_semi").select("comp").distinct()
    return cut_lineage(nodes.join(labels.join(comps, "comp", "left_semi").select("id"), "id", "left_semi"), "open-nodes")


def frequencies(texts: DataFrame, cells: int, banding: Banding) -> np.ndarray:
    """How many sets of ``texts`` (id, text) have a shingle in each of ``cells`` cells of hashes, at most 65,535."""

    def rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        blocks = total.reshape(-1, min(CELL_BLOCK, cells))
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([blocks[b].tobytes() for b in some], pa.binary())], names=["block", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, total = WordHashes(), np.zeros(cells, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(total, (shingles(text.as_py() or b"", cache, banding.width) & np.uint64(cells - 1)).astype(np.int64), 1)
        yield from rows(np.minimum(total, 65535).astype(np.uint16))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts.as_py(), np.uint16).astype(np.int64)
        least = [np.minimum(x, 65535).astype(np.uint16).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(least, pa.binary())], names=["block", "counts"])

    schema = "block long, counts binary"
    total = np.zeros((cells // min(CELL_BLOCK, cells), min(CELL_BLOCK, cells)), np.uint16)
    for row in texts.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect():
        total[row["block"]] = np.frombuffer(row["counts"], np.uint16)
    return total.ravel()


def _meeting(group, role, n, pos, ids, comps, percent: int) -> Iterator[np.ndarray]:
    """Pairs (a, b) of a leading row (role 1 or 3) and a later follower (2 or 3) of its group that sizes, places and components allow.

    Arguments are flat, parallel and sorted by group, n and id. ``pos`` is the shingle's place in the set's order: if it is the
    first the pair has in common, no more than the smaller rest is common.
    """
    left, step, out, held = np.flatnonzero(role & 1), 0, [], 0
    follows = role > 1
    while len(left):
        step += 1
        left = left[left + step < len(group)]
        right = left + step
        near = (group[left] == group[right]) & (100 * n[left] >= percent * n[right])
        left, right = left[near], right[near]
        rest = np.minimum(n[left] - pos[left], n[right] - pos[right])
        good = ((100 + percent) * rest >= percent * (n[left] + n[right])) & (comps[left] != comps[right]) & follows[right]
        if good.any():
            out.append(np.stack([ids[left[good]], ids[right[good]]], axis=1))
            held += len(out[-1])
        if held > HELD_PAIRS:
            yield np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
            out, held = [], 0
    if out:
        yield np.unique(np.sort(np.concatenate(out), axis=1), axis=0)


def prefix_pairs(nodes: DataFrame, texts: DataFrame, banding: Banding) -> DataFrame:
    """Distinct pairs (a, b), a < b, of ``nodes`` (id, comp) of different components; holds all whose sets are linked.

    Sets are ordered by the frequency of their shingles, rare ones first. Of a linked pair the larger set (or an equal one)
    has a shingle among its first n - percent * n + 1 that stands among the first n - 2 * percent / (1 + percent) * n + 1 of the other
    (those are indexed): else too few are left to be common. Shingles of one set only are not sent. Of a shingle with
    more than CELL_SETS sets the indexed ones and all are dealt to groups, each pair of groups is a cell of its own, and one
    with sets of a single component is left out.
    """
    p = banding.percent
    source = cut_lineage(nodes.select("id", "comp").distinct().join(texts, "id"), "prefix-texts")
    words = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")).first()[0]
    cells = min(MOST_CELLS, 1 << max(10, int(words).bit_length()))
    table = source.sparkSession.sparkContext.broadcast(frequencies(source, cells, banding).tobytes())

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, counts = WordHashes(), np.frombuffer(table.value, np.uint16)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(6)]
                for i, comp, text in zip(batch.column("id").to_pylist(), batch.column("comp").to_pylist(), batch.column("text"), strict=True):
                    found = shingles(text.as_py() or b"", cache, banding.width)
                    often = counts[(found & np.uint64(cells - 1)).astype(np.int64)]
                    order, n = np.argsort(often, kind="stable"), len(found)
                    pos = np.arange(n - -(-p * n // 100) + 1 if n else 0)
                    pos = pos[often[order[pos]] > 1]
                    for column, values in zip(
                        columns, (found[order[pos]].view(np.int64), pos < n - -(-2 * p * n // (100 + p)) + 1, np.full(len(pos), n), pos, np.full(len(pos), i), np.full(len(pos), comp)), strict=True
                    ):
                        column.append(values.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["k", "indexed", "n", "pos", "id", "comp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            k, salt, role, *rest = rows
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (salt[1:] != salt[:-1])
            for both in _meeting(np.cumsum(new), role, *rest, p):
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                rows = np.stack([c.to_numpy() for c in batch.columns])
                other = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1]))
                begin = int(other[-1]) + 1 if len(other) else 0  # where the group begins that the next batch may go on with
                if begin or (held and (held[-1][:2, -1] != rows[:2, 0]).any()):
                    yield from pairs(np.concatenate([*held, rows[:, :begin]], axis=1))
                    held = []
                held.append(rows[:, begin:])
        if held:
            yield from pairs(np.concatenate(held, axis=1))

    posted = cut_lineage(source.mapInArrow(post, "k long, indexed long, n long, pos long, id long, comp long"), "prefixes")
    share = lambda n: F.ceil(n / CELL_SETS).cast("long")
    counted = posted.groupBy("k").agg(F.count(F.lit(1)).alias("sets"), F.sum("indexed").alias("leads"), (F.min("comp") != F.max("comp")).alias("several"))
    frequent = cut_lineage(counted.where(F.col("sets") > CELL_SETS).select("k", share(F.col("leads")).alias("rows"), share(F.col("sets")).alias("columns"), "several"), "frequent-shingles")
    n_frequent = frequent.count()
    alone = F.array(F.struct(F.lit(0).cast("long").alias("salt"), (F.col("indexed") + 2).alias("role")))
    if not n_frequent:
        cells_of = posted.withColumn("cell", F.explode(alone))
    else:
        count_to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
        own_row, own_column = F.pmod(F.xxhash64("id"), F.col("rows")), F.pmod(F.xxhash64("id", F.lit(1)), F.col("columns"))
        leading = F.transform(count_to(F.col("columns")), lambda j: F.struct((own_row * F.col("columns") + j).alias("salt"), F.lit(1).cast("long").alias("role")))
        following = F.transform(count_to(F.col("rows")), lambda i: F.struct((i * F.col("columns") + own_column).alias("salt"), F.lit(2).cast("long").alias("role")))
        many = F.when(F.col("indexed") == 1, F.concat(leading, following)).otherwise(following)
        known = posted.join(F.broadcast(frequent) if n_frequent <= BROADCAST_SHINGLES else frequent, "k", "left").where(F.coalesce("several", F.lit(True)) & F.coalesce(F.col("rows") > 0, F.lit(True)))
        cells_of = known.withColumn("cell", F.explode(F.when(F.col("rows").isNull(), alone).otherwise(many)))
    dealt = cells_of.select("k", F.col("cell.salt").alias("salt"), F.col("cell.role").alias("role"), "n", "pos", "id", "comp")
    sorted_ = dealt.repartition("k", "salt").sortWithinPartitions("k", "salt", "n", "id")
    return sorted_.mapInArrow(meet, "a long, b long").where("a <> b").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", banding: Banding | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; kept is doc_id = component_id.

    Rows without text or words have an empty set, are linked with nothing and kept. Rows that repeat a doc_id count as one
    document with several texts. A row without doc_id cannot be named as a member: component_id is null, kept true. Fewer
    than five words make one shingle of the whole sequence. Other columns are ignored; an empty table gives no rows. Ids are
    integers, or texts of integers; any other id is an error.
    """
    banding = banding or Banding()
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    sketches = cut_lineage(sketch(plain, banding), "sketches")
    full = sketches.where("n > 0 AND id IS NOT NULL")
    sets = ["fp_a", "fp_b", "n"]
    reps = full.groupBy(*sets).agg(F.min("id").alias("rep"))
    members = cut_lineage(full.join(reps, sets).select("id", "n", "rep", F.when(F.col("id") == F.col("rep"), F.col("sig")).alias("sig")), "members")
    nodes = members.where("sig IS NOT NULL").select("id", "n", "sig", F.col("id").alias("comp"))

    found = cut_lineage(candidates(nodes, banding, 1), "candidates")
    touched = cut_lineage(found.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "touched")
    touched_n = touched.count()
    texts = cut_lineage(plain.join(if_few(touched, touched_n), "id", "left_semi"), "touched-texts")
    nodes = cut_lineage(nodes.join(touched, "id", "left_semi"), "touched-nodes")
    labels = nodes.select("id", "comp").distinct()
    tried, open_n = None, touched_n

    def contracted(links: DataFrame) -> DataFrame:
        merged = _of_components(links, labels).select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
        new = components(merged).select(F.col("node").alias("comp"), "component")
        return cut_lineage(labels.join(new, "comp", "left").select("id", F.coalesce("component", "comp").alias("comp")), "labels")

    for round_ in range(1, ROUNDS + 2):
        if tried is not None:
            found = cut_lineage(candidates(nodes.drop("comp").join(labels, "id"), banding, round_), "candidates")
            nodes = _open(nodes, found, labels)
            open_n = nodes.count()
        if not open_n or round_ > ROUNDS:
            break
        untried = found if tried is None else found.join(tried, ["a", "b"], "left_anti")
        likely = cut_lineage(plausible(untried, nodes, banding), "likely")
        links = cut_lineage(confirmed(likely, texts, banding), "links")
        fresh = links.count()
        tried = likely if tried is None else tried.unionByName(likely)
        if fresh:
            labels = contracted(links)
        if fresh * FEW < open_n:
            break

    if open_n:
        left = prefix_pairs(nodes.drop("comp").join(labels, "id"), texts, banding).join(tried, ["a", "b"], "left_anti")
        links = cut_lineage(confirmed(cut_lineage(plausible(left, nodes, banding), "likely"), texts, banding), "links")
        if not links.isEmpty():
            labels = contracted(links)

    final = labels.select(F.col("id").alias("rep"), "comp")
    known = members.select("id", "n", "rep").join(final, "rep", "left").select("id", "n", F.coalesce("comp", "rep").alias("comp"))
    rest = sketches.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("comp"))
    return known.unionByName(rest).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.coalesce(F.col("id") == F.col("comp"), F.lit(True)).alias("kept")
    )


def keep_one_per_class(docs: DataFrame, banding: Banding | None = None) -> DataFrame:
    """``docs`` without all but the smallest doc_id of every class, all columns kept.

    Rows that repeat a doc_id are one document: one of them stays, the one with the smallest text.
    """
    classes = near_duplicates(docs, banding=banding)
    gone = cut_lineage(classes.where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    left = docs.join(gone, "doc_id", "left_anti")
    twice = cut_lineage(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    if twice.isEmpty():
        return left
    once = left.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct("*"), F.coalesce("text", F.lit(""))).alias("row")).select("row.*")
    return left.join(twice, "doc_id", "left_anti").unionByName(once)
