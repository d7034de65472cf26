"""Ingest of numbered page files through a streaming source whose offsets are page numbers.

A page is a file ``page-7.ndjson`` (``.gz`` too) or a folder ``page=7`` of part files, numbered from 1; a gap holds back the pages
behind it until it is filled. Every micro-batch takes the next pages, one task each, and commits them to a ledger: rows of the
page, rows kept, running total, status. A row cap, or an overrun of the total that was announced, ends the ingest
within a page, and pages behind it are never read. A restart goes on after the last page in the ledger; a repeated batch overwrites its
own rows and its own part of the ledger, so that no page counts twice.

Pages need a file system that pyarrow can open.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from carelattice.constants import MOST_OVERRUN
from carelattice.runtime import cut_lineage
from carelattice.sources.ndjson import with_header
from carelattice.sources.tables import already_written

PAGE = re.compile(r"page[=-](\d+)(\.ndjson(\.gz)?)?$")
ROWS = 8192
LEDGER = "page long, rows long, kept long, total long, stopped boolean"


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(url.path) if url.scheme else path
    return fs.FileSystem.from_uri(path)


@dataclass
class Page(InputPartition):
    number: int


class PageReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.ledger, self.step = options["path"], options["ledger"], int(options.get("pagesperbatch", "1"))
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        at, stopped = self._committed()
        at = max(at, self.at or 0)
        if stopped:
            return {"page": at}
        there, to = self._pages(), at
        while to < at + self.step and to + 1 in there:
            to += 1
        return {"page": to}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        self.at = end["page"]
        return [Page(n) for n in range(start["page"] + 1, end["page"] + 1)]

    def commit(self, end: dict) -> None:
        pass

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.path)
        n, values = 0, []

        def batch() -> pa.RecordBatch:
            count = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([partition.number] * count, pa.int64()), pa.array(range(n - count, n), pa.int64()), pa.array(values, pa.string())], names=["page", "row", "value"]
            )

        for name in self._pages()[partition.number]:
            with store.open_input_stream(name, compression="gzip" if name.endswith(".gz") else None) as f:
                for line in _lines(f):
                    if line.strip():
                        values.append(line)
                        n += 1
                        if len(values) == ROWS:
                            yield batch()
                            values = []
        if values:
            yield batch()

    def _pages(self) -> dict[int, list[str]]:
        """Files of every page that is there."""
        store, base = open_store(self.path)
        out = {}
        for found in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            name = PAGE.fullmatch(found.base_name)
            if name and found.type == fs.FileType.Directory:
                parts = store.get_file_info(fs.FileSelector(found.path))
                out[int(name[1])] = sorted(p.path for p in parts if p.is_file and p.base_name[0] not in "_.")
            elif name:
                out[int(name[1])] = [found.path]
        return out

    def _committed(self) -> tuple[int, bool]:
        """Last page in the ledger, and whether the ingest was ended."""
        import pyarrow.dataset as ds

        store, base = open_store(self.ledger)
        if store.get_file_info(base).type == fs.FileType.NotFound:
            return 0, False
        rows = ds.dataset(base, filesystem=store, format="parquet").to_table(["page", "stopped"]).to_pylist()
        return max((r["page"] for r in rows), default=0), any(r["stopped"] for r in rows)


def _lines(f) -> Iterator[str]:
    rest = b""
    while block := f.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        for line in whole:
            yield line.decode("utf-8", "replace")
    yield rest.decode("utf-8", "replace")


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "resource_pages"

    def schema(self) -> str:
        return "page long, row long, value string"

    def streamReader(self, schema) -> PageReader:
        return PageReader(dict(self.options))


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """(batch_id, page, rows, kept, total, stopped) of every page taken so far."""
    return spark.read.schema(f"{LEDGER}, batch_id long").parquet(f"{table}/_ledger")


def ingest_pages(
    spark: SparkSession, pages: str, table: str, checkpoint: str, pages_per_batch: int = 1, row_cap: int | None = None, expected_total: int | None = None, overrun: int = MOST_OVERRUN
) -> None:
    """Take all pages that are there and stop. Rows go to ``table`` as in :mod:`ingest`, with their page.

    No more than ``row_cap`` rows are taken, and no more than ``overrun`` beyond ``expected_total``; both hold over all runs.
    """
    limits = [x for x in (row_cap, expected_total + overrun if expected_total is not None else None) if x is not None]

    def taken(batch_id: int) -> tuple[int, bool]:
        if not already_written(spark, f"{table}/_ledger/batch_id=0"):
            return 0, False
        row = ledger(spark, table).where(F.col("batch_id") < batch_id).agg(F.coalesce(F.max("total"), F.lit(0)), F.coalesce(F.bool_or("stopped"), F.lit(False))).first()
        return row[0], row[1]

    def write(batch: DataFrame, batch_id: int) -> None:
        total, stopped = taken(batch_id)
        rows = cut_lineage(batch, "pages")
        counts = dict(rows.groupBy("page").agg(F.count(F.lit(1))).collect())  # at most pages_per_batch
        entries, first, last = [], min(counts, default=0), 0
        for page in sorted(counts):
            if stopped:
                break
            kept = min(counts[page], max(0, min(limits) - total)) if limits else counts[page]
            total, stopped, last = total + kept, kept < counts[page], page
            entries.append((page, counts[page], kept, total, stopped))
        ends = entries[-1][2] if entries else 0
        kept_rows = rows.where((F.col("page") < last) | (F.col("page") == last) & (F.col("row") < ends))
        header = with_header(kept_rows).select("line_status", "resource_type", "id", "last_updated", "value", "page", "row")
        header.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{table}/_ledger/batch_id={batch_id}")

    spark.dataSource.register(PageSource)
    source = spark.readStream.format(PageSource.name()).option("path", pages).option("ledger", f"{table}/_ledger").option("pagesPerBatch", pages_per_batch)
    query = source.load().writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def status(spark: SparkSession, table: str, expected_total: int | None = None) -> DataFrame:
    """(pages, rows, status) of an ingest: stopped, complete (the announced total is there) or in_progress."""
    sums = ledger(spark, table).agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.max("total"), F.lit(0)).alias("rows"), F.coalesce(F.bool_or("stopped"), F.lit(False)).alias("s"))
    done = F.col("rows") >= F.lit(expected_total) if expected_total is not None else F.lit(False)
    return sums.select("pages", "rows", F.when(F.col("s"), "stopped").when(done, "complete").otherwise("in_progress").alias("status"))
