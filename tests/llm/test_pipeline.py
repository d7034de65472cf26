import re

import __spark_entry__ as entry
import corpus_pipeline
from carelattice.llm import decontamination, piece_lattice, rule_ledger
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_run_against_brute_force(spark):
    got = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.columns == [*docs.columns, "piece_ids", "round_trip"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    passed = {}
    for i, text in rows.items():
        words, chars, symbols, dup_lines, repeated = brute.measures(text)
        lines = sum(bool(x.strip(" \t\n\r\x0b\x0c")) for x in text.split("\n"))
        fails = words < 20 or 100 * repeated > 30 * words or 100 * symbols > 20 * chars or 100 * dup_lines > 50 * lines or chars < 2 * words or chars > 20 * words
        if not fails:
            passed[i] = text
    kept = {i for i, _, _, k in brute.classes(list(passed.items())) if k}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {i for i in kept if any(t in rows[i] for t in items)}
    assert {r["doc_id"] for r in got.select("doc_id").collect()} == kept - leaking
    assert got.where("NOT round_trip").count() == 0
    assert rule_ledger.CURRENT.version == "v2" and decontamination.WIDTH == 8 and piece_lattice.public_pieces().kind == "bpe"


def test_stages_on_odd_rows(spark, docs, odd_rows):
    source = docs(odd_rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, source, SF)
        assert out.columns == source.columns
        assert out.count() <= source.count()
    assert corpus_pipeline.STAGES[-1][1](spark, source, SF).count() == len(odd_rows)
