"""Versioned manifests: which files of a table count, as one JSON file a version.

A version is written under a hidden name and then renamed to ``_manifest/<version>.json`` without
overwriting, so readers see a version whole or not at all, and of two writers of one version the second is told.
Files go through the Hadoop file system, so a table can lie wherever Spark writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from quarry.session import _file_system, path_exists


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest version and its content; (-1, {}) where nothing was committed."""
    folder = _folder(path)
    if not path_exists(spark, folder):
        return -1, {}
    fs, jpath = _file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(jpath)]
    versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[0] != "."]
    if not versions:
        return -1, {}
    version = max(versions)
    stream = fs.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{version:012d}.json"))
    try:
        return version, json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, version: int, content: dict) -> bool:
    """Make ``content`` the given version; False if that version is there already."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    folder = _folder(path)
    fs, _ = _file_system(spark, folder)
    draft = hadoop.Path(f"{folder}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()
    options = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").NONE
    final = hadoop.Path(f"{folder}/{version:012d}.json")
    try:
        hadoop.FileContext.getFileContext(draft.toUri(), sc._jsc.hadoopConfiguration()).rename(draft, final, options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def update(spark: SparkSession, path: str, change: Callable[[dict], dict | None]) -> dict:
    """Commit ``change(newest content)`` as the next version, anew on what is newest then if another writer came first.

    ``change`` returning None leaves the table as it is.
    """
    while True:
        version, content = latest(spark, path)
        after = change(content)
        if after is None:
            return content
        if commit(spark, path, version + 1, after):
            return after
