"""Markdown corpus source and article / chunk sinks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPORT_FOLDERS = 256  # of an export; a folder's files are written by one task
EXPORT_PASSES = 2  # over the documents, each for its share of the folders; shuffle files of one are on disk at a time
PARTITION_BYTES = 32 << 20  # of files that one task of a scan reads; a file counts as FILE_BYTES at least
FILE_BYTES = 4096
BATCH_BYTES = 8 << 20  # of texts that a task holds before it passes them on
LIST_ROWS = 10_000  # files in one batch of a listing
# characters of a path that java.net.URI escapes, and so Spark in the location of a file
ESCAPED = re.compile(r"[^A-Za-z0-9_\-!.~'()*:@&=+$,;/\u0080-\U0010ffff]|[\u0080-\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def scan_corpus(spark: SparkSession, path: str, glob: str = "*.md", recursive: bool = False,
                logical_names: bool = False) -> DataFrame:
    """Every Markdown file under ``path`` as (path, text); one row per file that is not empty, whole text.

    Tasks list the folders and read the files as they stand, so the driver holds no file's name and a batch of texts
    is all a task holds; the files are those found when this is called.  What tasks cannot list (a pattern, a single
    file, a file system that only Spark opens, partition folders without ``recursive``) is read by Spark's
    ``binaryFile``, whose file index stays in the driver.  Both give the same rows.  Line endings are normalised to
    ``\\n``.  With ``logical_names`` the path is the document name recorded by ``export_markdown`` instead of the file
    location.
    """
    df = _read_by_tasks(spark, path, glob, recursive)
    if df is None:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
        if recursive:
            reader = reader.option("recursiveFileLookup", True)
        df = reader.load(path).select(F.col("_metadata.file_path").alias("path"), "content")
    file_path = F.col("path")
    text = F.regexp_replace(F.col("content").cast("string"), r"\r\n?", "\n")
    if logical_names:
        # an exported document: its recorded name, and its text minus the line end the writer added
        name = F.unhex(F.regexp_extract(file_path, r"/doc=([0-9A-F]+)\.md$", 1)).cast("string")
        return df.select(name.alias("path"), F.regexp_replace(text, r"\n\z", "").alias("text"))
    return df.select(file_path.alias("path"), text.alias("text"))


def _read_by_tasks(spark: SparkSession, path: str, glob: str, recursive: bool) -> DataFrame | None:
    """(location, content) of the files under a folder that Python can open; None for all else."""
    from quarry.session import _file_system, ship_package
    from quarry.sources.unit_log import _open_fs

    if set("{}[]*?\\") & set(path):
        return None
    jvm = spark.sparkContext._jvm
    fs, jpath = _file_system(spark, path)
    root = fs.makeQualified(jpath).toString()
    try:
        system, base = _open_fs(root)
        if system.get_file_info(base).type != pafs.FileType.Directory:
            return None
    except (OSError, pa.ArrowException):
        return None
    location = jvm.org.apache.hadoop.fs.Path(root).toUri().toString().rstrip("/")
    ship_package(spark)
    files = _list_files(spark, root, jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern(), recursive)
    if files is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_fs(root)
        base = base.rstrip("/")
        paths, contents, held = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

        for b in batches:
            for file in b.column(0).to_pylist():
                with system.open_input_file(base + file) as f:
                    contents.append(f.read())
                paths.append(location + ESCAPED.sub(lambda c: quote(c[0], safe=""), file))
                held += len(contents[-1]) + len(paths[-1])
                if held > BATCH_BYTES:
                    yield batch()
                    paths, contents, held = [], [], 0
        if paths:
            yield batch()

    n, size = files.agg(F.count(F.lit(1)), F.sum(F.greatest("bytes", F.lit(FILE_BYTES)))).first()
    tasks = max(1, min(n, spark.sparkContext.defaultParallelism), -(-(size or 0) // PARTITION_BYTES))
    return files.select("path").repartition(tasks).mapInArrow(run, "path string, content binary")


def _list_files(spark: SparkSession, root: str, pattern: str, recursive: bool) -> DataFrame | None:
    """(path below ``root``, bytes) of the files whose names match; None if there are folders and not ``recursive``.

    Each level of folders is listed by tasks and written as a table.  Hidden and empty files are left out, as by Spark.
    """
    from quarry.session import forget, materialize
    from quarry.sources.unit_log import _open_fs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_fs(root)
        base, wanted = base.rstrip("/"), re.compile(pattern, re.DOTALL)
        paths, sizes = [], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])

        for b in batches:
            for folder in b.column(0).to_pylist():
                for name, size in _entries(system, base + folder or "/"):
                    if not _hidden(name, size is None) and (size is None or size and wanted.fullmatch(name)):
                        paths.append(f"{folder}/{name}")
                        sizes.append(size)
                        if len(paths) == LIST_ROWS:
                            yield batch()
                            paths, sizes = [], []
        if paths:
            yield batch()

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    levels: list[DataFrame] = []
    folders = spark.range(0, 1, 1, 1).select(F.lit("").alias("path"))
    while True:
        level = materialize(folders.mapInArrow(run, "path string, bytes long"), "corpus-files")
        levels.append(level.where("bytes IS NOT NULL"))
        folders = level.where("bytes IS NULL").select("path")
        if folders.isEmpty():
            return reduce(DataFrame.union, levels)
        if not recursive:
            forget(level)
            return None
        folders = folders.repartition(tasks)


def _entries(system: pafs.FileSystem, folder: str) -> Iterator[tuple[str, int | None]]:
    """(name, bytes) of what is in a folder; a folder's bytes are None."""
    if not isinstance(system, pafs.LocalFileSystem):
        for i in system.get_file_info(pafs.FileSelector(folder)):
            if i.type in (pafs.FileType.File, pafs.FileType.Directory):
                yield i.base_name, i.size if i.type == pafs.FileType.File else None
        return
    with os.scandir(folder) as entries:  # one at a time, however many
        for e in entries:
            try:
                yield e.name, None if e.is_dir() else e.stat().st_size
            except FileNotFoundError:  # a link to nothing
                continue


def _hidden(name: str, is_folder: bool) -> bool:
    """Whether Spark passes over a file or folder of that name."""
    if is_folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name


def export_markdown(docs: DataFrame, root: str) -> int:
    """Write each (path, text) document as its own file ``root/<folder>/doc=<hex(path)>.md``.  Returns the number of rows.

    Tasks write the files themselves, so a document costs one small file and no folder or commit of its own; a task
    that runs again writes the same files again.  Each text ends with one ``\\n``, which
    ``scan_corpus(logical_names=True)`` drops.  Rows of one path are one document, their texts (null: empty) following
    each other; so are rows whose path is null or empty.  What was under ``root`` before is deleted.  ``docs`` is computed
    once a pass and has to give the same rows each time.
    """
    from quarry.session import _file_system, forget, materialize, ship_package
    from quarry.sources.unit_log import _open_fs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_fs(root)
        made, name, out = set(), None, None
        try:
            for b in batches:
                for at in range(0, b.num_rows, 1024):
                    for folder, doc, text in zip(*(c.to_pylist() for c in b.slice(at, 1024).columns), strict=True):
                        if doc != name:
                            if out is not None:
                                out.close()
                            if folder not in made:
                                system.create_dir(f"{base}/{folder}", recursive=True)
                                made.add(folder)
                            name, out = doc, system.open_output_stream(f"{base}/{folder}/doc={doc}.md")
                        out.write((text or b"") + b"\n")
                yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})
        finally:
            if out is not None:
                out.close()

    ship_package(docs.sparkSession)
    fs, jpath = _file_system(docs.sparkSession, root)
    fs.delete(jpath, True)
    fs.mkdirs(jpath)
    doc = F.coalesce(F.hex(F.col("path")), F.lit(""))
    rows = docs.select(F.pmod(F.crc32(doc.cast("binary")), F.lit(EXPORT_FOLDERS)).alias("folder"), doc.alias("doc"),
                       F.col("text").cast("binary").alias("text"))
    n = 0
    for part in range(EXPORT_PASSES):
        # documents of one folder, and rows of one document, meet in one task
        placed = rows.where(F.col("folder") % EXPORT_PASSES == part).repartition("folder").sortWithinPartitions("folder", "doc", "text")
        written = materialize(placed.mapInArrow(run, "n long"), "corpus-written")  # its shuffle files go when it ends
        n += written.agg({"n": "sum"}).first()[0] or 0
        forget(written)
    return n


def write_articles(articles: DataFrame, path: str, mode: str = "append") -> None:
    """Write typed articles (with ids) as parquet, partitioned by publish date."""
    articles.write.mode(mode).partitionBy("publish_date").parquet(path)


def append_articles(articles: DataFrame, path: str, order=("path",), col: str = "article_id") -> DataFrame:
    """Append typed articles with identity-style ids that continue after the largest id already
    in the table at ``path`` (1 for a new table), and return the appended rows.

    Re-importing the same files appends them again under new ids, as an identity column
    does.  The largest id is one aggregate (answered from parquet footers where possible).
    """
    from quarry.operators.corpus import assign_ids

    from quarry.session import path_exists

    spark = articles.sparkSession
    # a table that cannot be read raises: ids would restart otherwise
    last = spark.read.parquet(path).agg(F.max(col)).first()[0] if path_exists(spark, path) else None
    with_ids = assign_ids(articles, list(order), col=col, start=(last or 0) + 1)
    write_articles(with_ids, path, mode="append")
    return with_ids


def write_chunks(chunks: DataFrame, path: str, mode: str = "append") -> None:
    """Write chunk rows (article_id, chunk_no, chunk[, embedding]) as parquet, clustered by article.

    Chunks are made in the task that read their document, so every article's chunks
    are already in one task; a sort within each task clusters them by article in the
    file (row-group statistics on article_id) without a shuffle.  A global range
    repartition would instead shuffle all chunk text and, to sample its bounds, run
    the (Python) chunker a second time.  Articles numbered by ``assign_ids`` arrive
    range-partitioned, so files then also cover disjoint id ranges.
    """
    chunks.sortWithinPartitions("article_id", "chunk_no").write.mode(mode).parquet(path)
