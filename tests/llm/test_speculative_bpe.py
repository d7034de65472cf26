import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from carelattice.llm import queries, speculative_bpe


@pytest.fixture(scope="module")
def bpe():
    return speculative_bpe.public_bpe()


@pytest.fixture(scope="module")
def library(bpe):
    return Tokenizer.from_file(bpe.path)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "Hello WORLD, it's 12 o'clock; they'll've gone", "<|endoftext|>", "a<|startoftext|>B <|endoftext|><|endoftext|>", "<|endoftext", "İstanbul ΑΣ Σ ς", "é ẛ̣ Å",
    "한국어 텍스트", "漢字仮名交じり文" * 200, "🙂🙃 👩‍👩‍👧", "\x1c\x85  x​y", "ǅ ß ﬁ ﬃ", "Ɤ\U00010d50 Ᲊ x", "aaaa" * 700, "=-" * 900, "\x00\x01", "� ", "ⅷ ² ½ ٣",
]


def test_ids_and_decoding_equal_the_library(docs, odd_rows, bpe, library):
    rows = odd_rows * 2 + [(100 + k, t) for k, t in enumerate(TEXTS)]
    for packed in (False, True):
        got = speculative_bpe.decode(speculative_bpe.encode(docs(rows), bpe, packed=packed), bpe).collect()
        assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
        for r in got:
            ids = np.frombuffer(r["token_ids"], "<u4").tolist() if packed else r["token_ids"]
            assert ids == ids_of(library, r["text"]), r["text"]
            assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
            assert r["n_words"] is None and r["odd name"] == 1


def test_empty_table_null_ids_and_strange_numbers(docs, bpe, library):
    assert speculative_bpe.encode(docs([(1, "x")]).where("false"), bpe).collect() == []
    frame = docs([(1, "x")]).selectExpr("explode(array(null, array(), array(3306, 99999999, -1, 1002, cast(null as int)))) as token_ids", "1 as decoded")
    assert {r["decoded"] for r in speculative_bpe.decode(frame, bpe).collect()} == {None, "", "hello</w> world</w>"}


def test_columns_are_replaced_or_kept(docs, bpe):
    frame = docs([(1, "hello")]).selectExpr("*", "'x' as token_ids", "'y' as `a_longer name_`")
    got = speculative_bpe.encode(frame, bpe)
    assert got.columns[-1] == "token_ids" and got.columns.count("token_ids") == 1 and got.collect()[0]["token_ids"] == [3306]
    assert speculative_bpe.encode(frame, bpe, keep=["a_longer name_"]).collect()[0]["a_longer name_"] == "y"


def test_every_word_equals_exact_merging_and_the_library(bpe, library):
    rnd = random.Random(5)
    letters = ["etaoinshr", "lhe", "xy", "漢字éñ🙂ß", "=-_*.", "the ingand"]
    words = {"".join(rnd.choice(a.replace(" ", "")) for _ in range(rnd.randint(1, 40))) for a in letters for _ in range(1500)}
    words |= {c * n for c in "aex-=" for n in range(1, 120)}
    split = sorted({w for x in words for w in speculative_bpe.Splitter(bpe).of(x)})
    found, failing = bpe.encode_words([w.encode() for w in split])
    assert 0 < failing < len(split)
    for w, got in zip(split, found, strict=True):
        assert got.tolist() == bpe.exact(w.encode()) == ids_of(library, w), w
    owner, tokens = bpe.merge_all([w.encode() for w in split])
    for k, w in enumerate(split):
        assert tokens[owner == k].tolist() == ids_of(library, w), w


def test_pairs_are_compatible_exactly_when_they_are_an_encoding(bpe):
    rnd = np.random.default_rng(3)
    inner = np.flatnonzero([len(t) > 0 and not t.endswith(b"</w>") and not t.startswith(b"<|") for t in bpe.letters])
    a, b = rnd.choice(inner, 4000), rnd.choice(inner, 4000)
    table, spelled = bpe.table, {}

    def spell(t):
        if t not in spelled:
            spelled[t] = [t] if bpe.rank[t] < 0 else spell(int(bpe.left[t])) + spell(int(bpe.right[t]))
        return spelled[t]

    own = np.array([speculative_bpe.merge(list(spell(int(x))), table) == [x] for x in range(bpe.size)])
    keep = own[a] & own[b]
    got = bpe.compatible(a[keep], b[keep])
    for x, y, good in zip(a[keep].tolist(), b[keep].tolist(), got.tolist(), strict=True):
        assert good == (speculative_bpe.merge(spell(x) + spell(y), table) == [x, y])
    assert 0 < got.sum() < len(got)


def test_unchanged_characters_of_all_planes(bpe, library):
    """Every character of the blocks taken as settled is normalised and split as by the library."""
    splitter, letters = speculative_bpe.Splitter(bpe), speculative_bpe.byte_letters()
    for cp in range(0x110000):
        if not 0xD800 <= cp < 0xE000 and splitter.settled(chr(cp)):
            text = f"aΣ{chr(cp)}B́ {chr(cp)}̧"
            want = [w for w, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))]
            assert ["".join(letters[b] for b in w.encode()) for w in splitter.plain(text)] == want, hex(cp)


def test_text_of_ids(bpe):
    (ids, _) = bpe.encode_words([b"hello", b"world"])
    assert speculative_bpe.read_text([i for x in ids for i in x.tolist()] + [49407], bpe) == "hello world <|endoftext|>"


def test_query(spark, bpe, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op13_speculative_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ids_of(library, texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
