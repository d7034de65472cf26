import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from carelattice.llm import merkle, queries


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Root and, per leaf, the siblings (left, right) of each level."""
    level, paths = leaves, [[] for _ in leaves]
    at = list(range(len(leaves)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            run = level[i // 16 * 16 : i // 16 * 16 + 16]
            paths[leaf].append((run[: i % 16], run[i % 16 + 1 :]))
        level = [h("".join(level[k : k + 16])) for k in range(0, len(level), 16)]
        at = [i // 16 for i in at]
    return level[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        found[s] = (own, *tree([leaf_of(r) for r in own]))
    root, upper = tree([found[s][1] for s in order]) if order else (None, [])
    out = []
    for k, s in enumerate(order):
        own, sub, paths = found[s]
        for r, path in zip(own, paths, strict=True):
            whole = path + upper[k]
            changed = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf_of(changed)
            for left, right in whole:
                node = h("".join([*left, node, *right]))
            out.append((r[0], leaf_of(r), sub, root, h("".join(x for a, b in whole for x in a + b)), node, node == root))
    return out


def same(got, rows):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(brute(rows))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, digest string, `_id` int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(partitions)


def test_odd_rows_ties_and_nulls(spark, odd_rows):
    rows = [(i, f"s{k % 3}" if k % 4 else None, "en", None if k % 5 == 0 else k, t) for k, (i, t) in enumerate(odd_rows * 3)]
    rows += [(i, "été", None, 3, f"Text {i} Big") for i in range(40)] + [(7, "alone", "x", 1, "ABC")] + [(50, "hot", "x", 1, "Same")] * 30
    same(merkle.audit(frame(spark, rows)), rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 300])
def test_tree_sizes(spark, n):
    rows = [(i, "only", "en", i, f"Text {i}") for i in range(n)]
    same(merkle.audit(frame(spark, rows)), rows)


def test_more_than_two_stored_levels_and_many_groups(spark):
    rows = [(i, "hot", "en", i, f"T {i}") for i in range(4200)] + [(i, f"s{i}", "en", i, "U") for i in range(300)]
    same(merkle.audit(frame(spark, rows, 7)), rows)


def test_empty_table(spark):
    assert merkle.audit(frame(spark, [(1, "a", "en", 1, "x")]).where("false")).collect() == []


def test_tampering_is_found(spark):
    rows = [(i, "s", "en", 1, "With Capitals" if i % 2 else "none") for i in range(100)]
    for r in merkle.audit(frame(spark, rows)).collect():
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0 or r["doc_id"] % 2 == 0)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    same(queries.QUERIES["op12_merkle_manifest"](spark, sf), rows)
