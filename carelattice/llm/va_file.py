"""Centroid clustering over a VA-file: exact k-means whose rounds read approximations, not vectors.

Vectors are written once, as fixed-stride records, one file per task. What the rounds read is a table with, per vector, its
file and place there, a cell of ``bits`` bits for every dimension (equal widths between the exact extremes of all rows) and
the length of its residual, which is the vector minus the middle of its cell.

A round looks its squared distances to the cell's middle up in a table per dimension, cell and centroid. By how much a
centroid c is farther than the one b that is nearest to the middle lies within 2 * residual * |b - c| of the difference found in the
tables. Centroids whose interval lies beyond 0 are out; only where more than one is left the full vector is fetched, with its
neighbours in one range read, and the exact integer distances to those left decide, the smaller number among equals.

Sums of clusters are carried from round to round: a round fetches the vectors that changed their cluster and adds or subtracts
them. All arithmetic that decides is on integers; the intervals are widened by far more than a double's error. Vectors never go
through a shuffle or the driver; the driver gets ``k`` centroids and two numbers per dimension.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.elias_fano import local_path
from carelattice.runtime import cut_lineage, new_shared_path

#: Greatest magnitude of a scaled component: 64 squares of twice that sum below 2 ** 62.
LIMIT = 1 << 27
#: Records between two wanted ones that are rather read than skipped.
GAP = 8
STATE = "file string, place long, {id} {kind}, cells binary, residual double, cluster int, was int"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    name = local_path(path)
    return (fs.LocalFileSystem(), name) if name is not None else fs.FileSystem.from_uri(path)


def whole_vectors(rows: DataFrame, id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v array<long>): vectors of exactly ``dims`` components, none null or not finite, as floor(scale * x)."""
    v = F.col(f"`{vector}`")
    sound = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = rows.where(v.isNotNull() & F.coalesce(sound, F.lit(False)))
    return kept.select(F.col(f"`{id}`").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of seed:id; rows of one id by their vector, rows without id last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


@dataclass(frozen=True)
class Cells:
    """Cells of equal width per dimension; ``low`` is the least value, ``middle`` is in halves, to stay whole."""

    low: np.ndarray
    width: np.ndarray
    bits: int

    @classmethod
    def over(cls, vectors: DataFrame, dims: int, bits: int) -> Cells:
        """Fitted to the extremes of all rows, which are found in one pass."""

        def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            least = most = None
            for batch in batches:
                if batch.num_rows:
                    v = _matrix(batch.column(0), dims)
                    least = v.min(0) if least is None else np.minimum(least, v.min(0))
                    most = v.max(0) if most is None else np.maximum(most, v.max(0))
            if least is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(least), pa.array(most)], names=["d", "least", "most"])

        found = vectors.select("v").mapInArrow(extremes, "d int, least long, most long").groupBy("d").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        rows = sorted(found.collect())
        least, most = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
        if len(rows) and max(-least.min(), most.max()) > LIMIT:
            raise ValueError(f"a scaled component is beyond {LIMIT}: squared distances need not fit 64 bits")
        return cls(least, np.maximum(-(-(most - least + 1) >> bits), 1), bits)

    def of(self, v: np.ndarray) -> np.ndarray:
        return (v - self.low) // self.width

    def middle(self, cells: np.ndarray) -> np.ndarray:
        """Twice the middle of the cells."""
        return 2 * (self.low + cells * self.width) + self.width - 1

    def packed(self, cells: np.ndarray) -> np.ndarray:
        """Rows of ``bits`` bits per dimension."""
        each = (cells[:, :, None] >> np.arange(self.bits)) & 1
        return np.packbits(each.reshape(len(cells), -1).astype(np.uint8), axis=1)

    def unpacked(self, rows: np.ndarray, dims: int) -> np.ndarray:
        each = np.unpackbits(rows, axis=1)[:, : dims * self.bits].reshape(len(rows), dims, self.bits)
        return each @ (1 << np.arange(self.bits))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _bytes_matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def approximate(vectors: DataFrame, folder: str, cells: Cells, dims: int) -> DataFrame:
    """Write the vector files and give the approximations: STATE without clusters.

    A file appears under its final name when its task is through; a repeated task writes a file of its own name, and the
    rows of the task that is committed name that one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        name, out, n = uuid.uuid4().hex, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/_{name}")
            v = _matrix(batch.column(1), dims)
            out.write(v.astype("<i4").tobytes())
            own = cells.of(v)
            residual = np.sqrt(((2 * v - cells.middle(own)) ** 2).sum(1)) / 2
            count = batch.num_rows
            packed = cells.packed(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * count), pa.array(np.arange(n, n + count)), batch.column(0), pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(residual),
                    pa.array([None] * count, pa.int32()), pa.array([None] * count, pa.int32()),
                ],
                names=["file", "place", "id", "cells", "residual", "cluster", "was"],
            )
            n += count
        if out is not None:
            out.close()
            store.move(f"{base}/_{name}", f"{base}/{name}")

    return vectors.select("id", "v").mapInArrow(run, STATE.format(id="id", kind=vectors.schema["id"].dataType.simpleString()))


class Fetch:
    """Reads full vectors by file and place, neighbours in one range."""

    def __init__(self, folder: str, dims: int) -> None:
        self.store, self.base = _store(folder)
        self.dims, self.stride = dims, 4 * dims
        self.open: tuple[str, object] = ("", None)

    def __call__(self, files: list[str], places: np.ndarray) -> np.ndarray:
        out = np.empty((len(places), self.dims), np.int64)
        names = np.array(files)
        for name in dict.fromkeys(files):
            rows = np.flatnonzero(names == name)
            rows = rows[np.argsort(places[rows], kind="stable")]
            if self.open[0] != name:
                self.open = (name, self.store.open_input_file(f"{self.base}/{name}"))
            at = places[rows]
            for run in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(at) > GAP) + 1):
                first, last = int(at[run[0]]), int(at[run[-1]])
                data = self.open[1].read_at((last - first + 1) * self.stride, first * self.stride)
                out[rows[run]] = np.frombuffer(data, "<i4").reshape(-1, self.dims)[at[run] - first]
        return out


def nearest(cells: np.ndarray, residual: np.ndarray, tables: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which centroids (columns) may be nearest to each vector (rows), by the intervals alone."""
    middle = np.zeros((len(cells), tables.shape[2]))
    for d in range(cells.shape[1]):
        middle += tables[d][cells[:, d]]
    best = middle.argmin(1)
    farther = middle - middle[np.arange(len(best)), best][:, None]
    return farther <= 2 * residual[:, None] * apart[best] * (1 + 1e-9) + 1e-6 * (1 + middle.min(1)[:, None])


def assign(state: DataFrame, folder: str, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """STATE with the nearest centroid as cluster and the former one as was."""
    k, dims = centroids.shape
    middles = cells.middle(np.arange(1 << cells.bits)[:, None]).T / 2  # dims x cells
    tables = (middles[:, :, None] - centroids.T[:, None, :]) ** 2
    apart = np.sqrt(((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2, dtype=np.float64))
    width = -(-dims * cells.bits // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = Fetch(folder, dims)
        for batch in batches:
            if not batch.num_rows:
                continue
            files, places = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            may = nearest(cells.unpacked(_bytes_matrix(batch.column(3), width), dims), batch.column(4).to_numpy(), tables, apart)
            cluster = may.argmax(1).astype(np.int32)
            open_ = np.flatnonzero(may.sum(1) > 1)
            if len(open_):
                v = fetch([files[i] for i in open_], places[open_])
                exact = np.full((len(open_), k), np.iinfo(np.int64).max)
                for c in range(k):
                    own = np.flatnonzero(may[open_, c])
                    exact[own, c] = ((v[own] - centroids[c]) ** 2).sum(1)
                cluster[open_] = exact.argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(cluster), batch.column(5)], names=batch.schema.names)

    return state.mapInArrow(run, state.schema)


def shifts(state: DataFrame, folder: str, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed their cluster add to the counts and sums of all clusters (k x dims numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = Fetch(folder, dims)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = fetch(batch.column(0).to_pylist(), batch.column(1).to_numpy())
            now, was = (batch.column(i).fill_null(-1).to_numpy() for i in (2, 3))
            for c in range(k):
                come, gone = now == c, was == c
                count[c] += come.sum() - gone.sum()
                total[c] += v[come].sum(0) - v[gone].sum(0)
        c, d = (x.ravel().astype(np.int32) for x in np.indices((k, dims + 1)))
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(np.column_stack([count, total]).ravel())], names=["c", "d", "n"])

    moved = state.where(~F.col("cluster").eqNullSafe(F.col("was"))).select("file", "place", "cluster", "was")
    out = np.zeros((k, dims + 1), np.int64)
    for c, d, n in moved.mapInArrow(run, "c int, d int, n long").groupBy("c", "d").agg(F.sum("n")).collect():
        out[c, d] = n
    return out[:, 0], out[:, 1:]


def distances(state: DataFrame, folder: str, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance): exact squared distance of every vector to its centroid."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = Fetch(folder, dims)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = fetch(batch.column(0).to_pylist(), batch.column(1).to_numpy())
            far = ((v - centroids[batch.column(3).to_numpy()]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(far)], names=["id", "cluster", "distance"])

    kind = state.schema["id"].dataType.simpleString()
    return state.select("file", "place", "id", "cluster").mapInArrow(run, f"id {kind}, cluster int, distance long")


@dataclass(frozen=True)
class Clustering:
    """``rows`` (id, cluster, distance) and the final centroids, ``k x dims`` integers."""

    rows: DataFrame
    centroids: np.ndarray


def cluster(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, seed: int = 2, bits: int = 6, folder: str | None = None) -> Clustering:
    """``rounds`` rounds of exact k-means and a last assignment of every kept vector.

    A vector with another number of components, a null or a non-finite one is left out; a null id, repeated ids and repeated
    vectors stay as rows. With fewer than ``k`` kept vectors there are as many clusters as vectors; an empty cluster keeps its
    centroid; without any kept vector there are no rows. A component beyond LIMIT / scale is an error. Other columns are not
    read.
    """
    folder = folder or new_shared_path(rows.sparkSession, "va-vectors")
    vectors = whole_vectors(rows, id, vector, dims, scale)
    centroids = first_centroids(vectors, k, seed)
    cells = Cells.over(vectors, dims, bits)
    state = cut_lineage(approximate(vectors, folder, cells, dims), "va-cells")
    if not len(centroids):
        return Clustering(state.select("id", "cluster", F.lit(0).cast("long").alias("distance")), centroids.reshape(0, dims))
    count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for _ in range(rounds):
        state = cut_lineage(assign(state, folder, cells, centroids), "va-state")
        more, sums = shifts(state, folder, len(centroids), dims)
        count, total = count + more, total + sums
        centroids = np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], centroids)
    state = cut_lineage(assign(state, folder, cells, centroids), "va-state")
    return Clustering(cut_lineage(distances(state, folder, centroids), "va-distances"), centroids)


def report(found: Clustering, id: str = "vec_id") -> DataFrame:
    """Every vector with its cluster's and the whole inertia and the digest of its centroid."""
    spark = found.rows.sparkSession
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    # one row per cluster, so at most as many as centroids
    sums = found.rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    whole = sum(r["cluster_inertia"] for r in sums)
    names = spark.createDataFrame([(r["cluster"], r["cluster_inertia"], whole, digest[r["cluster"]]) for r in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(names), "cluster").select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
