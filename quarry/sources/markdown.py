"""A Markdown corpus as a Spark data source: many small files in few partitions, headers alone, and only what is new.

``spark.read.format("markdown").load(folder)`` gives (path, header, text) of every ``*.md`` file: ``path`` relative to the
folder, ``header`` the front matter between its first two fence lines (NULL without one), ``text`` the whole text with ``\\n`` line ends.
Files are packed into partitions of ``partitionBytes``.  With ``headersOnly`` a file is read block by block up to its second fence
and the columns are (path, header).  As a stream, the offset is the place of the newest file in the order of
(modification time, path); a micro-batch, and a later run from the same checkpoint, reads the files after it.  Files
younger than ``settleSeconds`` wait, so that one written meanwhile is not passed over.
"""

from __future__ import annotations

import fnmatch
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from quarry.session import ship_package
from quarry.sources.unit_log import _open_fs

BLOCK = 4096  # bytes read at a time when only headers are asked for
FENCE = re.compile(r"[^\S\n]*---[^\S\n]*(?:\n|\Z)")


@dataclass
class Files(InputPartition):
    paths: list[str]


def split_header(text: str) -> str | None:
    """The lines between a fence on the first line and the next fence; None without both."""
    first = FENCE.match(text)
    if not first:
        return None
    end = re.compile(r"^" + FENCE.pattern, re.M).search(text, first.end())
    return text[first.end():end.start()] if end else None


def _lines(raw: bytes) -> str:
    return re.sub(r"\r\n?", "\n", raw.decode("utf-8", "replace"))


class _Corpus:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.glob = options.get("glob", "*.md")
        self.recursive = str(options.get("recursive", "true")).lower() == "true"
        self.headers_only = str(options.get("headersOnly", options.get("headersonly", "false"))).lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", options.get("partitionbytes", 32 << 20)))
        self.settle = float(options.get("settleSeconds", options.get("settleseconds", 2)))

    def files(self) -> list[tuple[int, str, int]]:
        """(modification time, path, size) of the corpus, in that order."""
        system, root = _open_fs(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=self.recursive, allow_not_found=True))
        return sorted((i.mtime_ns or 0, i.path, i.size) for i in found
                      if i.type == fs.FileType.File and i.base_name[0] not in "._" and fnmatch.fnmatchcase(i.base_name, self.glob))

    def pack(self, files: list[tuple[int, str, int]]) -> list[Files]:
        """Files in partitions of about the bytes asked for; a file costs at least a block."""
        packed: list[Files] = []
        room = 0
        for _, path, size in sorted(files, key=lambda f: f[1]):
            if not packed or size > room:
                packed.append(Files([]))
                room = self.partition_bytes
            packed[-1].paths.append(path)
            room -= max(size, BLOCK)
        return packed

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, root = _open_fs(self.path)
        names, headers, texts, size = [], [], [], 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array(names, pa.string()), pa.array(headers, pa.string())]
            return pa.RecordBatch.from_arrays(columns if self.headers_only else [*columns, pa.array(texts, pa.string())],
                                              ["path", "header"] if self.headers_only else ["path", "header", "text"])

        for path in partition.paths:
            name = unquote(path[len(root.rstrip("/")) + 1:])
            with system.open_input_file(path) as f:
                if self.headers_only:
                    header = self._header(f)
                    text = ""
                else:
                    text = _lines(f.read())
                    header = split_header(text)
            names.append(name)
            headers.append(header)
            texts.append(text)
            size += len(text) + 500
            if size > 8 << 20:
                yield batch()
                names, headers, texts, size = [], [], [], 0
        if names:
            yield batch()

    @staticmethod
    def _header(f) -> str | None:
        raw = b""
        while True:
            block = f.read(BLOCK)
            raw += block
            if not block:
                return split_header(_lines(raw))
            # a cut line end or character at the end of a block is read with the next one
            whole = raw[:raw.rfind(b"\n") + 1]
            text = _lines(whole)
            if whole and not FENCE.match(text):
                return None
            header = split_header(text) if whole else None
            if header is not None:
                return header


class MarkdownReader(DataSourceReader):
    def __init__(self, options: dict):
        self.corpus = _Corpus(options)

    def partitions(self) -> list[Files]:
        return self.corpus.pack(self.corpus.files()) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.corpus.read(partition)


class MarkdownStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.corpus = _Corpus(options)

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        old = (time.time() - self.corpus.settle) * 1e9
        settled = [f for f in self.corpus.files() if f[0] <= old]
        return {"time": settled[-1][0], "path": settled[-1][1]} if settled else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        after, upto = (start["time"], start["path"]), (end["time"], end["path"])
        return self.corpus.pack([f for f in self.corpus.files() if after < f[:2] <= upto])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.corpus.read(partition)


class Markdown(DataSource):
    @classmethod
    def name(cls) -> str:
        return "markdown"

    def schema(self) -> str:
        return "path string, header string" + ("" if _Corpus(dict(self.options)).headers_only else ", text string")

    def reader(self, schema) -> MarkdownReader:
        return MarkdownReader(dict(self.options))

    def streamReader(self, schema) -> MarkdownStream:
        return MarkdownStream(dict(self.options))


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(Markdown)


def scan_markdown(spark: SparkSession, folder: str, headers_only: bool = False, **options) -> DataFrame:
    """(path, header[, text]) of every Markdown file under ``folder``."""
    register(spark)
    return spark.read.format("markdown").options(headersOnly=headers_only, **options).load(folder)


def stream_markdown(spark: SparkSession, folder: str, headers_only: bool = False, **options) -> DataFrame:
    """The same as a stream: files come once, in the order in which they were written."""
    register(spark)
    return spark.readStream.format("markdown").options(headersOnly=headers_only, **options).load(folder)


def export_markdown_files(docs: DataFrame, folder: str) -> int:
    """Write each (path, text) as a file of its own from the tasks; names are percent-encoded.  Returns the number of files.

    A task that runs again writes the same files again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open_fs(folder)
        made: set[str] = set()
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                path = f"{root}/{quote(name, safe='/')}"
                parent = path.rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(path) as f:
                    f.write((text or "").encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    return docs.select("path", "text").where("path IS NOT NULL").mapInArrow(run, "n long").agg({"n": "sum"}).first()[0] or 0
