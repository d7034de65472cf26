from carelattice.llm import rule_ledger as L
from tests.llm import brute


def test_measures(docs, odd_rows):
    eight = "a b c d e f g h"
    rows = [*odd_rows, (20, f"{eight} {eight} x {eight}"), (21, "a " * 30), (22, f"{eight}\n\n{eight}\r\n{eight}\n \n|$# <>")]
    got = L.ledger(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.measures(r["text"]), r["doc_id"]
        assert r["failed_bits"] & 1 == (r["n_words"] < 20)


def test_policies_and_ablation(docs, odd_rows):
    book = L.ledger(docs(odd_rows))
    rows = book.collect()
    for policy in L.POLICIES:
        mask = policy.mask(L.rules())
        assert book.where(L.passes(policy)).count() == sum(r["failed_bits"] & mask == 0 for r in rows)
        for r in L.ablation(book, policy).collect():
            assert r["rejected"] == sum(bool(x["failed_bits"] >> r["bit"] & 1) for x in rows)
            assert r["rejected_alone"] == sum(x["failed_bits"] & mask == 1 << r["bit"] for x in rows)


def test_stage_keeps_columns(docs, odd_rows):
    source = docs([*odd_rows, (30, "all good words in this small text are different from one another so that nothing in here can be said to repeat itself")])
    kept = L.keep_passing(source)
    assert kept.columns == source.columns and 30 in {r["doc_id"] for r in kept.collect()}
    assert L.keep_passing(source.where("false")).collect() == []


def test_columns_with_names_of_its_own(docs, odd_rows):
    names = ("_words", "_lines", "_hashes", "_windows", "_found", "__words", "n_lines", "failed_bits")
    source = docs(odd_rows).selectExpr("*", *[f"'own' AS `{n}`" for n in names])
    got = L.ledger(source).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert all(r[n] == "own" for n in names[:6]) and r["n_lines"] >= 0 and r["failed_bits"] & 1 == (r["n_words"] < 20)
