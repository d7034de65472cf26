import base64

import numpy as np
import pytest
import tiktoken

from carelattice.llm import training_order as T


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 4096, 5000])
def test_feistel_is_a_permutation(n):
    for key in (0, 7, 1 << 63):
        assert sorted(T.feistel(np.arange(n), n, key).tolist()) == list(range(n))
    if n > 100:
        assert (T.feistel(np.arange(n), n, 1) != T.feistel(np.arange(n), n, 2)).any()


def test_round_trip(spark, docs, odd_rows):
    voc = T.Vocabulary.public()
    with open(voc.path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=voc.pattern, mergeable_ranks=ranks, special_tokens={})
    rows = [*odd_rows, (30, "it's  here \n\n <|endoftext|> x")]
    order = T.materialise(docs(rows), length=32, shard_text=60_000)
    got = T.read(spark, order).collect()
    assert sorted(r["slot"] for r in got) == list(range(order.total)) and order.shards > 2
    assert all(r["offset"] == (r["slot"] - order.offsets[r["shard"]]) * order.stride for r in got)
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["slot"])] != sorted((r["doc_id"] for r in got), key=str)
    ids = [(str(i), plain.encode_ordinary(t or "")) for i, t in rows]
    want = sorted((i, found[k : k + 32]) for i, found in ids for k in range(0, len(found), 32))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    by_slot = {r["slot"]: r for r in got}
    begin = order.offsets[1] - 5
    part = list(T.read_slots(order, begin, 12))  # over a shard's end
    assert [(s, d, i.tolist()) for s, d, _, i in part] == [(s, by_slot[s]["doc_id"], by_slot[s]["ids"]) for s in range(begin, begin + 12)]


def test_no_sequences(spark, docs):
    for source in (docs([(1, None), (2, "")]), docs([(1, "a")]).where("false")):
        order = T.materialise(source)
        assert order.total == 0 and T.read(spark, order).collect() == []
