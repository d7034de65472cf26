import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from carelattice.llm import elias_fano, queries
from carelattice.llm import ngram_trie as G
from carelattice.llm.elias_fano import EliasFano, Growing, open_arrays, write_arrays

END = b" end "


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


class Plain:
    def __init__(self, texts, order, keep):
        streams = [[END, *tokens(t)] for t in texts]
        self.order = order
        self.grams = {1: Counter((w,) for s in streams for w in s[1:])}
        for k in range(2, order + 1):
            seen = Counter(tuple(s[j - k + 1 : j + 1]) for s in streams for j in range(k - 1, len(s)))
            self.grams[k] = {g: n for g, n in seen.items() if n >= keep and (k == 2 or g[:-1] in self.grams[k - 1])}
        self.n, self.v = sum(self.grams[1].values()), len(self.grams[1])
        self.mass = Counter()
        for k in range(2, order + 1):
            for g, n in self.grams[k].items():
                self.mass[g[:-1]] += (n - G.DISCOUNT) / self.grams[k - 1][g[:-1]]

    def p(self, word, context):
        out = (self.grams[1][(word,)] + 0.1) / (self.n + 0.1 * (self.v + 1))
        for k in range(1, len(context) + 1):
            c = context[-k:]
            if c not in self.grams[k]:
                break
            direct = (self.grams[k + 1][c + (word,)] - G.DISCOUNT) / self.grams[k][c] if c + (word,) in self.grams[k + 1] else 0
            out = direct + (1 - self.mass[c]) * out
        return out

    def score(self, text):
        s = [END, *tokens(text)]
        return sum(math.log10(self.p(s[j], tuple(s[max(0, j - self.order + 1) : j]))) for j in range(1, len(s)))


@pytest.mark.parametrize("order", [2, 3])
def test_against_dictionaries(docs, odd_rows, order):
    rows = [*odd_rows, *((k, f"the quick brown fox {k % 7} jumps over the lazy dog {k % 3} and the quick cat") for k in range(100, 160))]
    got = G.fit_and_score(docs(rows), order=order).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    plain = Plain([t for i, t in rows if not held(i)], order, 2)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(i), len(tokens(t))) for i, t in rows)
    texts = {(i, len(tokens(t))): t for i, t in rows}
    for r in got:
        text = texts[r["doc_id"], r["n_tokens"]]
        assert r["held_out"] == held(r["doc_id"]) and r["train_tokens"] == plain.n
        assert r["n_known"] == sum((w,) in plain.grams[1] for w in tokens(text))
        assert r["base_score"] == pytest.approx(sum(math.log10((plain.grams[1][(w,)] + 0.1) / (plain.n + 0.1 * (plain.v + 1))) for w in tokens(text)))
        assert r["score"] == pytest.approx(plain.score(text), abs=5e-4 * r["n_tokens"])


def test_query_uses_trigrams_and_those_seen_once(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    plain = Plain([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10], 3, 1)
    got = queries.QUERIES["op10_ngram_lm"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["score"] == pytest.approx(plain.score(texts[r["doc_id"]]), abs=5e-4 * r["n_tokens"])


def test_empty_tables(docs):
    source = docs([(k, "a b") for k in range(5)])
    assert G.fit_and_score(source.where("false")).collect() == []


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 9), (300, 50), (300, 1 << 20), (2000, 1 << 63), (500, (1 << 64) - 1)])
def test_elias_fano(tmp_path, n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    write_arrays(str(tmp_path / "x.ef"), EliasFano.arrays(values, "x"))
    opened = EliasFano.opened(open_arrays(str(tmp_path / "x.ef")), "x")
    assert (opened[np.arange(n)] == values).all()
    asked = np.concatenate([values, values[:-1] + np.uint64(1), rng.integers(0, top, 200, dtype=np.uint64, endpoint=True)])
    assert (opened.successor(asked) == np.searchsorted(values, asked)).all()


@pytest.mark.parametrize("most", [50, 1 << 40])
def test_pairs_packed_and_not(most):
    rng = np.random.default_rng(most)
    node, word = rng.integers(-1, most, 400), rng.integers(-1, most, 400)
    pairs, where = G._pairs(node, word)
    assert (pairs[where.ravel()] == np.stack([node, word], axis=1)).all() and len({*map(tuple, pairs.tolist())}) == len(pairs)


def test_masses_leave_a_shard_in_small_rows(spark, monkeypatch):
    monkeypatch.setattr(G, "BLOCK", 4)
    blocks = spark.createDataFrame([(0, bytearray(b"x"))], "shard long, blob binary")
    node = np.array([0, 3, 4, 13])
    report = G._write_level(blocks, 2, lambda shard, blobs: (9, 11, node, node / 16)).collect()
    assert [(r["n"], r["total"]) for r in report if r["block"] is None] == [(9, 11)]
    total = np.zeros(16)
    for r in report:
        if r["block"] is not None:
            G._add_masses(r["blob"], total[4 * r["block"] :])
    assert total[node].tolist() == (node / 16).tolist() and {r["block"] for r in report} == {None, 0, 1, 3}


@pytest.mark.parametrize("chunk", [1, 50, 1 << 30])
def test_chunks_hold_the_words_of_python(monkeypatch, chunk):
    monkeypatch.setattr(G, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice([*b" \t\n\r\x0b\x0cABab\x00\x1c\x1f\x85\xa0\xc3\xa9"], rng.integers(0, 12)).tolist()) for _ in range(600)]
    texts += [None, b"", b" ", "\u00a0\u2003x\u00c9 ".encode()]
    batch = pa.record_batch({"text": pa.array(texts, pa.binary())})
    got = []
    for rows, hashes, at, ends in G.token_chunks(iter([batch, batch.slice(0, 0)])):
        assert rows.num_rows == len(ends)
        got += [part.tolist() for part in np.split(hashes[at], ends + 1)[:-1]]
    assert got == [[xxhash.xxh64_intdigest(w) for w in [*(t or b"").lower().split(), END]] for t in texts]


@pytest.mark.parametrize("large", [False, True])
def test_find_and_neighbours(tmp_path, large):
    rng = np.random.default_rng(5)
    # a dense run, so that buckets reach over words, and thin values around it
    values = np.unique(np.concatenate([rng.integers(0, 1 << (63 if large else 20), 500, dtype=np.uint64), np.arange(7000, 9000, dtype=np.uint64)]))
    write_arrays(str(tmp_path / "x.ef"), EliasFano.arrays(values, "x"))
    opened = EliasFano.opened(open_arrays(str(tmp_path / "x.ef")), "x")
    asked = np.concatenate([values, values + np.uint64(1), values - np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)])
    place = {int(v): i for i, v in enumerate(values)}
    assert opened.find(asked).tolist() == [place.get(int(v), -1) for v in asked]
    here, then = opened.neighbours(np.arange(len(values) - 1))
    assert (here == values[:-1]).all() and (then == values[1:]).all()


@pytest.mark.parametrize("top", [9, 1 << 20, 1 << 60])
def test_a_sequence_in_pieces(tmp_path, top):
    rng = np.random.default_rng(top % 1000)
    values = np.sort(rng.integers(0, top, 1500, dtype=np.uint64))
    growing = Growing()
    for piece in np.split(values, [0, 700, 701, 764, 764, 1200]):
        growing.add(piece)
    write_arrays(str(tmp_path / "x.ef"), growing.arrays("x"))
    opened = EliasFano.opened(open_arrays(str(tmp_path / "x.ef")), "x")
    assert (opened[np.arange(1500)] == values).all() and (opened.successor(values) == np.searchsorted(values, values)).all()


def _skewed(spark, docs):
    texts = [" ".join(f"the {'of' if k % 3 else 'and'} w{(k * 7 + j * j) % 61}" for j in range(25)) + f" x{k} y{k}" for k in range(90)]
    rows = docs(list(enumerate(texts))).select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts, rows, G.fit(rows.select("text"), order=3, keep=1, shards=5)


@pytest.mark.parametrize("files", [32, 2])
def test_frequent_nodes_are_spread_and_others_stand_in_one_shard(spark, docs, monkeypatch, files):
    monkeypatch.setattr(G, "FILES", files)
    texts, rows, model = _skewed(spark, docs)
    assert [len(level.starts) - 1 for level in model.levels] == [5 if files == 32 else 2] * 3
    plain = Plain(texts, 3, 1)
    for r in G.score(rows, model).collect():
        assert r["score"] == pytest.approx(plain.score(texts[r["doc_id"]]), abs=5e-4 * r["n_tokens"])
    for below, level in zip(model.levels, model.levels[1:]):
        assert 0 < len(below.frequent) < below.offsets[-1]
        node, word = (x.ravel() for x in np.meshgrid(np.arange(below.offsets[-1]), np.arange(model.distinct), indexing="ij"))
        shard, key = level.nodes.places(node, word)
        for s in range(5):
            assert (level.nodes.ids(s, key[shard == s]) == node[shard == s]).all()
        shards = {int(n): set(shard[node == n].tolist()) for n in np.unique(node)}
        assert all(len(found) == (5 if n in below.frequent else 1) for n, found in shards.items())


def test_a_lookup_takes_few_searches(spark, docs, monkeypatch):
    _, _, model = _skewed(spark, docs)
    selected, select = [], elias_fano._select
    monkeypatch.setattr(elias_fano, "_select", lambda words, k: selected.append(len(k)) or select(words, k))
    for below, level in zip(model.levels, model.levels[1:]):
        node, word = (x.ravel() for x in np.meshgrid(np.arange(below.offsets[-1]), np.arange(model.distinct), indexing="ij"))
        found, _ = level.successors(node, word)
        assert sorted(found[found >= 0].tolist()) == list(range(level.offsets[-1]))
        # one for the node, one for its start, one for the word, and a few per shard
        assert sum(selected) <= 3 * len(node) + 50
        selected.clear()
