"""WARC archives as a PySpark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans one partition per group of archives of about ``groupBytes`` (an archive is read by one task, as only its start
is a known record boundary; the writer keeps archives near ``archiveBytes``). A record's headers are parsed first. Filters on
record_type, record_id, target_uri, refers_to, payload_digest and content_length are decided on the headers alone; the block of
a record that fails them is skipped, by a seek in a plain archive and without copying in a compressed one, and never decoded.
Option ``payload`` = "false" skips all blocks.

Writing makes one or more archives per task, each under a draft name that the driver renames when the job commits, so a repeated or
speculative task leaves nothing behind. Paths may be on any file system pyarrow can open.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, IsNull, Not, StringStartsWith, WriterCommitMessage

from carelattice.runtime import cut_lineage, new_shared_path

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_length long, "
    "content_type string, content_length long, payload binary"
)
#: Header of each column that is read from one; WARC-Payload-Length is an extension field.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest", "payload_length": "WARC-Payload-Length", "content_type": "Content-Type", "content_length": "Content-Length",
}
NUMBERS = {"payload_length", "content_length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class Archives(InputPartition):
    paths: list[str] = field(default_factory=list)

    def __init__(self, paths: list[str]) -> None:
        super().__init__(None)
        self.paths = paths


class _Stream:
    """Buffered bytes of an archive, gzip members (one per record, or one for all) joined."""

    def __init__(self, source, packed: bool) -> None:
        self.source, self.packed, self.buffer, self.at = source, packed, b"", 0
        self.inflate, self.rest = None, b""

    def _more(self) -> bytes:
        if not self.packed:
            return self.source.read(1 << 20)
        while True:
            raw = self.rest or self.source.read(1 << 18)
            self.rest = b""
            if not raw:
                return b""
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            out = self.inflate.decompress(raw)
            if self.inflate.eof:
                self.rest, self.inflate = self.inflate.unused_data, None
            if out:
                return out

    def _fill(self) -> bool:
        more = self._more()
        self.buffer, self.at = self.buffer[self.at :] + more, 0
        return bool(more)

    def line(self) -> bytes | None:
        """The next line without its end, None at the end of the archive."""
        start = self.at
        while (end := self.buffer.find(b"\n", start)) < 0:
            start = len(self.buffer) - self.at
            if not self._fill():
                return None if self.at == len(self.buffer) else self.take(len(self.buffer) - self.at)
        out = self.buffer[self.at : end]
        self.at = end + 1
        return out.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        parts, need = [], n
        while need:
            part = self.buffer[self.at : self.at + need]
            self.at += len(part)
            need -= len(part)
            parts.append(part)
            if need and not self._fill():
                raise EOFError("the archive ends within a record")
        return b"".join(parts)

    def skip(self, n: int) -> None:
        have = len(self.buffer) - self.at
        if n > have and not self.packed:
            self.source.seek(n - have, 1)
            self.buffer, self.at = b"", 0
            return
        while n:
            step = min(n, len(self.buffer) - self.at)
            self.at += step
            n -= step
            if n and not self._fill():
                raise EOFError("the archive ends within a record")


def records(path: str, wanted, payload: bool) -> Iterator[dict]:
    """Records of an archive whose headers pass ``wanted``; others are skipped, as are blocks unless ``payload``."""
    store, name = opened(path)
    with store.open_input_file(name) as source:
        stream = _Stream(source, name.endswith(".gz"))
        while (first := stream.line()) is not None:
            if not first:
                continue
            if not first.startswith(b"WARC/"):
                raise ValueError(f"{path}: a record begins with {first[:40]!r}")
            found: dict[str, str] = {}
            while line := stream.line():
                key, _, value = line.decode("utf-8", "replace").partition(":")
                found[key.strip().lower()] = value.strip()
            row = {column: found.get(header.lower()) for column, header in HEADERS.items()}
            for column in NUMBERS:
                row[column] = int(row[column]) if row[column] is not None else None
            length = row["content_length"] or 0
            if not wanted(row):
                stream.skip(length)
                continue
            if payload:
                row["payload"] = stream.take(length)
            else:
                stream.skip(length)
                row["payload"] = None
            yield row


def _test(f):
    """A predicate on header columns for a pushed filter, None where headers can't decide it."""
    inner = f.child if isinstance(f, Not) else f
    name = inner.attribute[0] if len(getattr(inner, "attribute", ())) == 1 else None
    if name not in HEADERS:
        return None
    if isinstance(inner, IsNull):
        test = lambda row: row[name] is None
    elif isinstance(inner, IsNotNull):
        test = lambda row: row[name] is not None
    elif isinstance(inner, EqualTo | EqualNullSafe) and inner.value is not None:
        test = lambda row: row[name] == inner.value
    elif isinstance(inner, In) and None not in inner.value:
        test = lambda row: row[name] in inner.value
    elif isinstance(inner, StringStartsWith):
        test = lambda row: row[name] is not None and row[name].startswith(inner.value)
    else:
        return None
    if isinstance(f, Not):
        # SQL: a comparison with null is not true either way
        if isinstance(inner, EqualTo | In | StringStartsWith):
            return lambda row: row[name] is not None and not test(row)
        return lambda row: not test(row)
    return test


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.group = int(options.get("groupbytes", options.get("groupBytes", str(128 << 20))))
        self.tests: list = []

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            test = _test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[Archives]:
        store, name = opened(self.path)
        found = store.get_file_info(fs.FileSelector(name, recursive=True)) if store.get_file_info(name).type == fs.FileType.Directory else [store.get_file_info(name)]
        files = [f for f in found if f.type == fs.FileType.File and f.base_name.endswith((".warc", ".warc.gz")) and not f.base_name.startswith(("_", "."))]
        prefix = self.path[: self.path.index(name)] if name in self.path else ""
        groups: list[list[str]] = []
        size = self.group
        for f in sorted(files, key=lambda f: f.path):
            if size + f.size > self.group:
                groups.append([])
                size = 0
            groups[-1].append(prefix + f.path if not self.path.startswith("/") else f.path)
            size += f.size
        return [Archives(g) for g in groups] or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(c, pa.int64() if c in NUMBERS else pa.string()) for c in HEADERS] + [("payload", pa.binary())])
        order = ["record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest", "payload_length", "content_type", "content_length", "payload"]
        kinds = pa.schema([kinds.field(c) for c in order])
        rows, size = [], 0
        for path in partition.paths:
            for row in records(path, lambda r: all(t(r) for t in self.tests), self.payload):
                rows.append(row)
                size += 400 + len(row["payload"] or b"")
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)


@dataclass
class Written(WriterCommitMessage):
    drafts: list[tuple[str, str]]


def encoded(row: dict) -> bytes:
    """One record: the headers that are not null, then the block."""
    block = row.get("payload") or b""
    head = [b"WARC/1.1"]
    for column, header in HEADERS.items():
        value = len(block) if column == "content_length" else row.get(column)
        if value is not None:
            text = str(value).replace("\r", "%0D").replace("\n", "%0A")
            head.append(f"{header}: {text}".encode("utf-8", "surrogatepass"))
    if row.get("record_type") == "revisit":
        head.append(f"WARC-Profile: {PROFILE}".encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.packed = options.get("compression", "gzip") == "gzip"
        self.most = int(options.get("archivebytes", options.get("archiveBytes", str(256 << 20))))
        if overwrite:
            store, name = opened(self.path)
            if store.get_file_info(name).type != fs.FileType.NotFound:
                raise ValueError(f"{self.path} exists; archives are only added to")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        drafts, out, size = [], None, 0
        try:
            for batch in iterator:
                names = batch.schema.names
                for values in zip(*(batch.column(c) for c in names), strict=True):
                    if out is None or size >= self.most:
                        if out is not None:
                            out.close()
                        tag = uuid.uuid4().hex
                        name = f"{folder}/part-{tag}.warc" + ".gz" * self.packed
                        drafts.append((f"{folder}/_draft-{tag}", name))
                        out, size = store.open_output_stream(drafts[-1][0], compression=None), 0
                    record = encoded({c: v.as_py() for c, v in zip(names, values, strict=True)})
                    if self.packed:
                        deflate = zlib.compressobj(6, zlib.DEFLATED, 31)  # a member per record, as the format advises
                        record = deflate.compress(record) + deflate.flush()
                    out.write(record)
                    size += len(record)
        finally:
            if out is not None:
                out.close()
        return Written(drafts)

    def commit(self, messages: list[Written | None]) -> None:
        store, _ = opened(self.path)
        for message in messages:
            for draft, name in message.drafts if message else ():
                store.move(draft, name)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = opened(self.path)
        for message in messages:
            for draft, _ in message.drafts if message else ():
                if store.get_file_info(draft).type == fs.FileType.File:
                    store.delete_file(draft)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark hand filters to Python sources, a session setting."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives under ``path``; without ``payload`` the blocks are skipped and the column is null."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def deduplicated(pages: DataFrame, least: int = 100) -> DataFrame:
    """Records of ``pages`` (page_id, url, html) in the columns of SCHEMA, one per row.

    Of rows whose payloads are equal and at least ``least`` bytes long those with the smallest page_id carry the payload
    (several if that page_id repeats; rows without page_id only if the whole group has none), all others are
    revisits of it without a block. Shorter payloads are always carried. A null html is an empty payload.

    Payloads are grouped by digest, narrow and partially aggregated; only groups of more than one row are joined back.
    That list is written first, so Spark knows its size: it is broadcast if small, else joined by a shuffle.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    grouped = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = cut_lineage(grouped.where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"), "payload-groups")
    joined = rows.join(groups, "digest", "left")
    again = F.col("first").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first"), F.lit(False)) & (F.octet_length("payload") >= least)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    return joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.lit(None).cast("long").alias("content_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Archive ``pages`` under ``path``."""
    register(pages.sparkSession)
    deduplicated(pages).write.format("warc").option("compression", compression).mode("append").save(path)


def page_of(urn: Column) -> Column:
    """page_id of a record id, null for a page without one."""
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Of responses, length and digest are taken from the payload that was read; of revisits, whose blocks are empty and
    are not read, from the headers.
    """
    spark = pages.sparkSession
    path = new_shared_path(spark, "warc")
    write_pages(pages, path)
    kept = read(spark, path).where("record_type = 'response'").select(
        page_of(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    again = read(spark, path, payload=False).where("record_type = 'revisit'").select(
        page_of(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"), F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
    return kept.unionByName(again)
