import itertools

import public_tokenizers
import pytest
import sentencepiece

from carelattice.llm import piece_lattice as L

ODD = [(40, " "), (41, "  a  b "), (42, "x" * 300 + " \n\n\t é漢字🙂 벨 y"), (43, "   벨 foo" * 3), (44, "\n"), (45, "🙂" * 10), (46, "  " * 50), (47, "<s> </s> <0x41> <unk>")]


@pytest.mark.parametrize("most", [0, 40, 200_000])
def test_equal_to_the_library(docs, odd_rows, most):
    library = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    source = docs(odd_rows + ODD).withColumnRenamed("lang", "round_trip")
    got = L.encode(source, L.public_pieces(), most=most)
    assert got.columns == [c for c in source.columns if c != "round_trip"] + ["piece_ids", "round_trip"]
    rows = got.collect()
    assert len(rows) == len(odd_rows + ODD)
    for r in rows:
        assert r["piece_ids"] == library.encode(r["text"] or ""), r["doc_id"]
        assert r["round_trip"]
    again = L.decode(got.drop("round_trip"), L.public_pieces()).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in again) == sorted((str(i), t or "") for i, t in odd_rows + ODD)


def test_escape_character_and_empty_table(docs):
    rows = L.encode(docs([(1, "a ▁ b")]), L.public_pieces()).collect()
    assert not rows[0]["round_trip"]
    assert L.encode(docs([(1, "a")]).where("false"), L.public_pieces()).collect() == []


def test_viterbi_against_all_paths(spark):
    rows = [("a", -1.0, 300), ("b", -2.0, 301), ("ab", -2.5, 302), ("ba", -1.2, 303), ("aba", -3.1, 304), ("▁", -0.5, 305), ("▁a", -2.0, 306), ("bb", -9.0, 307)]
    pieces = L.Pieces("", "unigram", tuple(rows), 0)
    units = ["▁" + "".join(x) for n in range(1, 6) for x in itertools.product("abz", repeat=n)][:120]
    score = {p: s for p, s, _ in rows}
    ids = {p: i for p, _, i in rows}
    unknown = min(score.values()) - 10

    def best(text):
        if not text:
            return 0.0, []
        options = []
        for k in range(1, len(text) + 1):
            head = text[:k]
            if head in score or k == 1:
                rest, tail = best(text[k:])
                options.append((score.get(head, unknown) + rest, [ids[head]] + tail if head in ids else list(head.encode()) + tail))
        return max(options)

    def total(text, found):
        names = {i: p for p, i in ids.items()}
        return sum(score[names[i]] if i in names else unknown for i in found)

    got = {r["unit"]: r["ids"] for r in L.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), pieces).collect()}
    assert set(got) == set(units)
    for u in units:
        assert total(u, got[u]) == pytest.approx(best(u)[0]), u
