import json

from carelattice.streaming import ingest


def page(folder, name, *resources):
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in resources))


def item(id_, updated, note):
    return {"resourceType": "Location", "id": id_, "meta": {"lastUpdated": updated}, "note": note}


def test_resumable_ingest(spark, tmp_path, rows):
    pages, table, offsets = tmp_path / "pages", str(tmp_path / "table"), str(tmp_path / "offsets")
    pages.mkdir()

    def run():
        ingest.ingest(ingest.stream_lines(spark, str(pages), max_files=1), table, offsets).awaitTermination()
        return sorted((r.id, json.loads(r.value)["note"]) for r in ingest.current(spark, table).collect())

    page(pages, "1", item("a", "2024-01-02", "new"), item("b", "2024-01-01", "b1"))
    (pages / "2").write_text("{broken\n\n")
    assert run() == [("a", "new"), ("b", "b1")]
    assert run() == [("a", "new"), ("b", "b1")]
    # an older version that arrives late does not replace a newer one
    page(pages, "3", item("a", "2024-01-01", "old"), item("b", "2024-01-03", "b2"), item("c", "2024-01-01", "c1"))
    assert run() == [("a", "new"), ("b", "b2"), ("c", "c1")]
    assert spark.read.parquet(table).where("line_status = 'INVALID'").count() == 1
    for _ in range(2):
        ingest.compact(spark, table)
        assert run() == [("a", "new"), ("b", "b2"), ("c", "c1")]
    # after a restart, the last version and later batches make the state
    page(pages, "4", item("c", "2024-01-05", "c2"), item("a", "2023-01-01", "oldest"))
    assert run() == [("a", "new"), ("b", "b2"), ("c", "c2")]


def test_running_counts(spark, tmp_path, rows):
    pages, out, offsets = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "offsets")
    pages.mkdir()
    for i in range(3):
        page(pages, str(i), item(str(i), "2024", ""), {"resourceType": "Endpoint", "id": "e"})
        ingest.count_types(ingest.stream_lines(spark, str(pages)), out, offsets).awaitTermination()
        assert rows(ingest.latest_counts(spark, out), "resource_type", "lines") == [("Endpoint", i + 1), ("Location", i + 1)]
