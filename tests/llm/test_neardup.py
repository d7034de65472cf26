import random

import numpy as np

from carelattice.llm import neardup
from carelattice.llm.components import components
from tests.llm import brute


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    rows, n = [], 100
    for size in (6, 30, 80, 200):
        for _ in range(3):
            base = rng.choices(words, k=size)
            for copies in range(rng.randint(1, 7)):
                text = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    text[rng.randrange(size)] = rng.choice(words)
                rows.append((n, " ".join(text).title() if copies % 2 else " ".join(text)))
                n += 1
    chain = rng.choices(words, k=120)
    for k in range(12):  # neighbours are similar, the ends are not
        rows.append((n + k, " ".join(chain[k * 4 : 80 + k * 4])))
    return rows


def test_against_all_pairs(docs, odd_rows):
    rows = corpus() + odd_rows + [(50, corpus()[0][1])]
    got = sorted((tuple(r) for r in neardup.near_duplicates(docs(rows, 5)).collect()), key=repr)
    assert got == sorted(brute.classes(rows), key=repr)


def test_empty_table(docs):
    assert neardup.near_duplicates(docs([(1, "a")]).where("false")).collect() == []
    assert neardup.keep_one_per_class(docs([(1, "a")]).where("false")).collect() == []


def test_stage_keeps_one_row_of_repeated_documents(docs):
    text = "five words make a shingle here and more of them follow"
    source = docs([(3, text), (3, text), (2, text.upper()), (9, "something else"), (9, "something else"), (None, "no id")])
    kept = neardup.keep_one_per_class(source)
    assert kept.columns == source.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 9, None]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute.components([e for e in edges if e[0] != e[1]])


def test_tensored_keys_match_when_a_tuple_of_either_half_does():
    banding = neardup.Banding(side=3, rows=2)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 32, (2, banding.hashes), dtype=np.uint32)
    b[2:4], b[6:8] = a[2:4], a[6:8]  # second tuple of the first half, first of the second
    keys = neardup.table_keys(np.stack([a, b]), banding)
    assert keys.shape == (2, 9) and np.flatnonzero(keys[0] == keys[1]).tolist() == [3]


def test_pairs_within_a_template_below_the_threshold(docs):
    rng = random.Random(8)
    template = [f"t{k}" for k in range(204)]
    rows = []
    for k in range(600):  # 0.73 to each other; every tenth shares four more shingles with the one after it, 0.756
        private = [f"p{k}x{i}" for i in range(37)]
        if k % 10 == 1:
            private[:4] = [f"p{k - 1}x{i}" for i in range(4)]
        rows.append((k, " ".join(template + private)))
    rng.shuffle(rows)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(rows, 5)).collect()}
    assert got == {k: k - 1 if k % 10 == 1 else k for k in range(600)}


def test_frequent_shingles_are_dealt_to_groups(docs, monkeypatch):
    monkeypatch.setattr(neardup, "CELL_SETS", 2)
    rows = corpus(6)
    plain = docs(rows, 4).selectExpr("doc_id AS id", "CAST(text AS BINARY) AS text")
    pairs = {(r["a"], r["b"]) for r in neardup.prefix_pairs(plain.selectExpr("id", "id AS comp"), plain, neardup.Banding()).collect()}
    sets = [(i, brute.shingle_set(t)) for i, t in rows]
    linked = {(i, j) for i, s in sets for j, u in sets if i < j and 4 * len(s & u) >= 3 * len(s | u)}
    assert linked and linked <= pairs


def test_rounds_end_where_few_are_linked(docs, monkeypatch):
    rng = random.Random(9)
    template = [f"t{k}" for k in range(204)]
    rows = []
    for k in range(600):  # 0.73 to each other; every twentieth shares four more shingles with the one after it
        private = [f"p{k}x{i}" for i in range(37)]
        if k % 20 == 1:
            private[:4] = [f"p{k - 1}x{i}" for i in range(4)]
        rows.append((k, " ".join(template + private)))
    rounds, real = [], neardup.candidates
    monkeypatch.setattr(neardup, "candidates", lambda nodes, banding, round_: rounds.append(round_) or real(nodes, banding, round_))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(rows, 5)).collect()}
    assert got == {k: k - 1 if k % 20 == 1 else k for k in range(600)} and rounds == [1]


def test_only_centres_of_several_blocks_are_dealt(docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 2)
    rows = [(k, " ".join(f"w{i}" for i in range(40 + k % 3))) for k in range(12)]
    texts = docs(rows).selectExpr("doc_id AS id", "CAST(text AS BINARY) AS text")
    asked = [(0, k) for k in range(1, 8)] + [(8, 9), (10, 11)]
    got = neardup.confirmed(texts.sparkSession.createDataFrame(asked, "a long, b long"), texts, neardup.Banding()).collect()
    assert sorted(map(tuple, got)) == asked
