import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from carelattice.llm import queries, va_file


def brute(rows, k, rounds, scale=256, seed=2):
    """rows: (id, vector); exact k-means with Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def assigned():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents] for _, v in kept]
        return [(min(f), f.index(min(f))) for f in far]

    for _ in range(rounds):
        own = assigned()
        for c in range(len(cents)):
            mine = [v for (_, v), (_, j) in zip(kept, own, strict=True) if j == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    own = assigned()
    inertia = Counter()
    for d, c in own:
        inertia[c] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, c, d, inertia[c], sum(inertia.values()), names[c]) for (i, _), (d, c) in zip(kept, own, strict=True)]


SCHEMA = "vec_id long, embedding array<float>, cluster string, v int, id string, `file` int"


def run(spark, rows, partitions=3, **more):
    frame = spark.createDataFrame([(i, v, "x", 1, "y", 2) for i, v in rows], SCHEMA).repartition(partitions)
    return [tuple(r) for r in va_file.report(va_file.cluster(frame, **more)).collect()]


def f32(x):
    return float(np.float32(x))


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(4)
    middles = [[rnd.gauss(0, 0.3) for _ in range(64)] for _ in range(6)]
    rows = [(i, [f32(rnd.gauss(m, 0.1)) for m in rnd.choice(middles)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # one common vector
    rows += [(None, rows[1][1]), (3, rows[2][1]), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 65), (304, [None] + [0.5] * 63), (305, [float("nan")] + [0.5] * 63), (306, [float("-inf")] + [0.5] * 63)]
    return rows + [(400, [0.0] * 64), (401, [100.0] * 64), (402, [-1e-9] * 64)]


def test_equals_plain_k_means(spark, odd):
    assert Counter(run(spark, odd, k=12, rounds=3)) == Counter(brute(odd, 12, 3))


@pytest.mark.parametrize("bits", [1, 4, 8])
def test_any_width_of_cells(spark, odd, bits):
    assert Counter(run(spark, odd, 2, k=5, rounds=2, bits=bits)) == Counter(brute(odd, 5, 2))


def test_ties_take_the_smaller_number(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(40)]  # equal centroids: the later ones stay empty and stay where they are
    assert Counter(run(spark, rows, k=9, rounds=2)) == Counter(brute(rows, 9, 2))


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.25] * 64), (2, [0.5] * 64)]
    assert Counter(run(spark, rows)) == Counter(brute(rows, 40, 5))
    assert run(spark, [(1, None), (2, [1.0])]) == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError, match="beyond"):
        run(spark, [(1, [1e6] * 64)])


def test_intervals_hold_the_nearest_and_few_others(spark):
    rnd = np.random.default_rng(2)
    v = np.floor(rnd.normal(0, 30, (2000, 64))).astype(np.int64)
    cents = v[:20]
    cells = va_file.Cells(v.min(0), np.maximum(-(-(v.max(0) - v.min(0) + 1) >> 6), 1), 6)
    own = cells.of(v)
    assert own.min() >= 0 and own.max() < 64 and (cells.unpacked(cells.packed(own), 64) == own).all()
    residual = np.sqrt(((2 * v - cells.middle(own)) ** 2).sum(1)) / 2
    middles = cells.middle(np.arange(64)[:, None]).T / 2
    apart = np.sqrt(((cents[:, None] - cents[None]) ** 2).sum(2).astype(float))
    may = va_file.nearest(own, residual, (middles[:, :, None] - cents.T[:, None, :]) ** 2, apart)
    far = ((v[:, None] - cents[None]) ** 2).sum(2)
    assert may[far == far.min(1)[:, None]].all() and may.sum(1).mean() < 4 and (may.sum(1) == 1).any()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in queries.QUERIES["op11_va_file"](spark, sf).collect()) == Counter(brute(rows, 40, 5))
