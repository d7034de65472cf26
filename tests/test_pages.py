import gzip
import json

import pytest

from carelattice.streaming import pages


def lines(first, n):
    return "".join(json.dumps({"resourceType": "Location", "id": f"l{i}"}) + "\n" for i in range(first, first + n))


@pytest.fixture
def run(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()

    def go(**more):
        pages.ingest_pages(spark, str(folder), str(tmp_path / "table"), str(tmp_path / "offsets"), **more)
        kept = spark.read.parquet(str(tmp_path / "table"))
        ids = sorted(int(r.id[1:]) for r in kept.where("line_status = 'OK'").collect())
        entries = sorted((r.page, r.rows, r.kept, r.total, r.stopped) for r in pages.ledger(spark, str(tmp_path / "table")).collect())
        return ids, entries

    go.folder, go.table = folder, str(tmp_path / "table")
    return go


def test_resumes_mid_list_and_waits_at_a_gap(spark, run):
    (run.folder / "page-1.ndjson").write_text(lines(0, 5) + "\n{broken\n")
    (run.folder / "page-2.ndjson.gz").write_bytes(gzip.compress(lines(5, 5).encode()))
    (run.folder / "page-4.ndjson").write_text(lines(15, 5))
    (run.folder / "notes.txt").write_text("not a page")
    ids, entries = run(pages_per_batch=1)
    assert ids == list(range(10)) and entries == [(1, 6, 6, 6, False), (2, 5, 5, 11, False)]
    assert run() == (ids, entries)  # nothing new
    part = run.folder / "page=3"
    part.mkdir()
    (part / "part-0").write_text(lines(10, 5))
    ids, entries = run(pages_per_batch=5)
    assert ids == list(range(20)) and [e[0] for e in entries] == [1, 2, 3, 4]
    assert pages.status(spark, run.table, 21).first().asDict() == {"pages": 4, "rows": 21, "status": "complete"}


def test_cap_holds_within_a_page_and_over_runs(spark, run):
    for p in range(1, 7):
        (run.folder / f"page-{p}.ndjson").write_text(lines(10 * (p - 1), 10))
    ids, entries = run(pages_per_batch=2, row_cap=34)
    assert ids == list(range(34)) and entries == [(1, 10, 10, 10, False), (2, 10, 10, 20, False), (3, 10, 10, 30, False), (4, 10, 4, 34, True)]
    (run.folder / "page-7.ndjson").write_text(lines(60, 10))
    assert run(pages_per_batch=2, row_cap=34) == (ids, entries)
    assert pages.status(spark, run.table).first()["status"] == "stopped"


def test_cap_at_the_end_of_a_page_ends_with_the_next(run):
    for p in (1, 2, 3):
        (run.folder / f"page-{p}.ndjson").write_text(lines(10 * (p - 1), 10))
    ids, entries = run(row_cap=20)
    assert ids == list(range(20)) and entries[-1] == (3, 10, 0, 20, True)


def test_overrun_of_the_announced_total(run):
    for p in (1, 2, 3):
        (run.folder / f"page-{p}.ndjson").write_text(lines(10 * (p - 1), 10))
    ids, entries = run(expected_total=12, overrun=5)
    assert ids == list(range(17)) and entries[-1] == (2, 10, 7, 17, True)


def test_a_repeated_batch_counts_once(spark, run, monkeypatch):
    for p in (1, 2):
        (run.folder / f"page-{p}.ndjson").write_text(lines(10 * (p - 1), 10))
    whole = pages.with_header

    def fails(rows):
        monkeypatch.setattr(pages, "with_header", whole)
        raise RuntimeError("stopped")

    monkeypatch.setattr(pages, "with_header", fails)
    with pytest.raises(Exception, match="stopped"):
        run()
    ids, entries = run()
    assert ids == list(range(20)) and entries == [(1, 10, 10, 10, False), (2, 10, 10, 20, False)]
    # the ledger is whole but the batch was not committed: Spark repeats it
    last = sorted((run.folder.parent / "offsets" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    (run.folder / "page-3.ndjson").write_text(lines(20, 10))
    ids, entries = run()
    assert ids == list(range(30)) and [e[3] for e in entries] == [10, 20, 30]
