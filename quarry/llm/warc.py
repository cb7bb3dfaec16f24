"""WARC archives: a writer through Spark's text sink and a reader as a Python data source.

Writing: a record is one value of the text sink, whose line separator is the blank line that ends a
WARC record, so archives go to any file system that Spark writes.  Records with equal payloads of
``min_bytes`` or more are written once, under their smallest page id; the others become revisit records.

Reading (format ``warc``): whole files are packed into partitions of about ``partitionBytes``.  A task reads a
record's headers first, tests the predicates that were pushed down (on record_type, record_id, target_uri,
payload_digest, refers_to), and where they fail, or with ``payload=false``, steps over the block.
Options: path (a folder or a file), payload, partitionBytes.  ``.gz`` files are inflated as a stream.

Defined cases: a null html is an empty payload; a null url has no target URI, and control characters
and spaces of one are percent-encoded; a null page id is read back as null and is never what others refer
to; rows with the smallest id of their payload are all responses.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith,
)
from pyspark.sql.types import StructType

from quarry.session import materialize, ship_package

CRLF = "\r\n"
SCHEMA = ("record_type string, record_id string, target_uri string, date string, payload_digest string, "
          "refers_to string, content_type string, content_length long, headers map<string,string>, "
          "http_headers map<string,string>, payload binary")
# fixed values: names of the standard's header fields
FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
          "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def page_id_of(urn: Column) -> Column:
    return F.expr("cast(null as long)") if urn is None else F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def records(pages: DataFrame, min_bytes: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the record of each page, without the blank line that ends it."""
    html = F.coalesce("html", F.lit(""))
    base = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"),
                        F.octet_length(html).alias("n"))
    # payloads that more than one page has; ids combine before the shuffle
    shared = materialize(
        base.where(F.col("n") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") > 1).select("digest", "first"), "warc-shared")
    rows = base.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    uri = F.col("url")
    for code in [*range(0x21), 0x7F]:
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _page_urn(F.col("page_id"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", uri), _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _header("WARC-Refers-To", F.when(revisit, _page_urn(F.col("first")))),
        _header("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")))
    return rows.select(F.concat(head, F.lit(CRLF), block).alias("value"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 100, compression: str = "gzip", records_per_file: int = 100_000
               ) -> None:
    """Archives under ``path`` from page_id, url, html."""
    (records(pages, min_bytes).write.option("lineSep", CRLF + CRLF).option("compression", compression)
     .option("maxRecordsPerFile", records_per_file).text(path))


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path``; filters on the header columns are applied before a payload is read."""
    ship_package(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options)


def _open_fs(path: str):
    """(file system, path in it) of a URI or a plain path; ``file:/x`` is written ``file:///x`` first."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", 32 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in FIELDS and isinstance(f, (EqualTo, StringStartsWith)):
                self.tests.append((name, "prefix" if isinstance(f, StringStartsWith) else "in",
                                   f.value if isinstance(f, StringStartsWith) else {f.value}))
            elif name in FIELDS and isinstance(f, In):
                self.tests.append((name, "in", set(f.value)))
            elif name in FIELDS and isinstance(f, IsNotNull):
                self.tests.append((name, "there", None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = _open_fs(self.path)
        info = system.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
        found = sorted((i.path, i.size) for i in found
                       if i.type == fs.FileType.File and i.base_name[0] not in "._" and i.size)
        packed: list[Files] = []
        room = 0
        for path, size in found:
            if size > room or not packed:
                packed.append(Files([]))
                room = self.partition_bytes
            packed[-1].paths.append(path)
            room -= size
        return packed or [Files([])]

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            own = headers.get(FIELDS[name])
            if own is None or kind == "in" and own not in value or kind == "prefix" and not own.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _open_fs(self.path)
        rows: list[dict] = []
        size = 0
        for path in partition.paths:
            raw = system.open_input_file(path)
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
            with raw, stream:
                for row in self.records(stream, path):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)

    def records(self, stream, path: str) -> Iterator[dict]:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: no record begins with {line[:40]!r}")
            headers = read_headers(stream)
            length = int(headers["content-length"])
            if not self.wanted(headers):
                skip(stream, length, path)
                continue
            http: dict[str, str] = {}
            payload = None
            if self.payload or headers.get("warc-type") == "revisit":
                block = stream.read(length)
                if len(block) < length:
                    raise ValueError(f"{path}: a record ends early")
                payload = block
                if headers.get("content-type", "").startswith("application/http"):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    http = read_headers(io.BytesIO(head.partition(b"\r\n")[2]))
                payload = payload if self.payload and headers.get("warc-type") != "revisit" else None
            else:
                skip(stream, length, path)
            yield {"content_length": length, "headers": list(headers.items()), "http_headers": list(http.items()),
                   "payload": payload} | {k: headers.get(v) for k, v in FIELDS.items()}


def read_headers(stream) -> dict[str, str]:
    """Header fields, names in lower case, up to the blank line; folded lines are joined."""
    out: dict[str, str] = {}
    last = None
    while (line := stream.readline()) and (text := line.rstrip(b"\r\n")):
        if text[:1] in b" \t" and last:
            out[last] += " " + text.strip().decode("utf-8", "replace")
            continue
        name, _, value = text.decode("utf-8", "replace").partition(":")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def skip(stream, length: int, path: str) -> None:
    while length:
        got = len(stream.read(min(length, 1 << 20)))
        if not got:
            raise ValueError(f"{path}: a record ends early")
        length -= got


ARROW = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
    ("payload_digest", pa.string()), ("refers_to", pa.string()), ("content_type", pa.string()),
    ("content_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
    ("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def page_records(archived: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records that ``write_warc`` wrote.

    A response is measured on the payload that was read; a revisit carries its payload's length and digest.
    """
    revisit = F.col("record_type") == "revisit"
    return archived.where(F.col("record_type").isin("response", "revisit")).select(
        page_id_of(F.col("record_id")).alias("page_id"),
        F.when(revisit, F.col("http_headers")["content-length"].cast("long"))
        .otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("payload_digest", "^sha256:", "")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type", page_id_of(F.col("refers_to")).alias("refers_to"))
