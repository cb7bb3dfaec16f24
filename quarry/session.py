"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quarry") -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    Launched by spark-submit (or any launcher that already runs the JVM) the cluster's
    master and sizing are kept; without one it runs ``local[*]``.  Shuffle partitions are
    set only when given or when the session is local (default 8 then); on a cluster size
    them so one partition is ~128-256 MB of shuffle data, and AQE coalesces small ones.
    """
    launched = bool(os.environ.get("PYSPARK_GATEWAY_PORT") or os.environ.get("SPARK_MASTER"))
    builder = SparkSession.builder.appName(app_name)
    if master or not launched:
        builder = builder.master(master or "local[*]")
        # driver memory only takes effect when this process starts the JVM
        builder = builder.config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # whole documents travel through mapInPandas: keep Arrow batches small, by rows and by
        # bytes (a batch of long documents is cut at 64 MB whatever its row count)
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        # streaming state (one row per player) kept in RocksDB, not on the JVM heap
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if shuffle_partitions or spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir`` (or it was set on the
    SparkContext).  Where neither is set, a ``local`` session gets a fresh folder under
    the system temp directory; any other master raises, because executors and driver
    would each see their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = _local_folder(sc.master)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _local_folder(master: str) -> str:
    """A temp folder for an in-process session; it goes when this process ends."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"master {master!r} has no spark.checkpoint.dir: set it to a folder that the driver "
                           "and all executors share")
    folder = tempfile.mkdtemp(prefix="quarry-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_scratch: list[str] = []
_scopes = threading.local()  # scopes open in this thread


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables / stream state.

    The file system removes it when the session's JVM ends; ``release_scratch`` does so at once.
    """
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    fs, jpath = _file_system(spark, path)
    fs.deleteOnExit(jpath)
    _scratch.append(path)
    for scope in getattr(_scopes, "open", []):
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """On leaving, delete the scratch folders that this thread was handed inside (one micro-batch of a stream)."""
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    own: list[str] = []
    _scopes.open.append(own)
    try:
        yield
    finally:
        _scopes.open.pop()
        for path in own:
            if path in _scratch:
                fs, jpath = _file_system(spark, path)
                fs.delete(jpath, True)
                _scratch.remove(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder this process handed out (their DataFrames cannot be read afterwards)."""
    while _scratch:
        fs, jpath = _file_system(spark, _scratch.pop())
        fs.delete(jpath, True)


def forget(*frames: DataFrame) -> None:
    """Delete the tables of ``materialize`` that nothing reads any more, to free their disk early."""
    for df in frames:
        path = df._scratch
        fs, jpath = _file_system(df.sparkSession, path)
        fs.delete(jpath, True)
        _scratch.remove(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop) file system; any other failure raises."""
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder on its (Hadoop) file system; a path that is missing raises."""
    fs, jpath = _file_system(spark, path)
    return fs.getFileStatus(jpath).isDirectory()


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used where an intermediate is read by several branches or must not be recomputed
    (sampled range bounds, positions): every branch then reads the same files, only the
    columns it needs (columnar, unlike an RDD checkpoint), and lineage is cut there.  The
    shuffle files of the write are dropped when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before) if before is not None else spark.conf.unset(FREE_SHUFFLES)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, which unpickle its functions by name."""
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="quarry-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._quarry_shipped = True
