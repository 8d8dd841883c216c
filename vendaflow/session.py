"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}
_settings_lock = threading.Lock()
_writers: dict[SparkSession, tuple[int, dict[str, str | None]]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names.

    A local session without the setting gets a temporary folder; a cluster session
    without it is an error, since a folder of one machine would not be seen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="vendaflow-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/vendaflow/{app}/{label}-{uuid.uuid4().hex}"


# Shuffle files of a query go when it ends, not when the driver next collects its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# A side of a join that is this small in every task, as shuffled, is hashed, and neither side is sorted.
HASHED = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}


@contextmanager
def writing(spark: SparkSession, settings: dict[str, str] = TIDY | HASHED) -> Iterator[None]:
    """Settings of queries whose rows go to files at once: nobody asks for their shuffles again.

    They hold for the session until the last of the writers that run together ends.
    """
    with _settings_lock:
        running, before = _writers.get(spark, (0, {}))
        for key, value in settings.items():
            if key not in before:
                before[key] = spark.conf.get(key, None)
                spark.conf.set(key, value)
        _writers[spark] = (running + 1, before)
    try:
        yield
    finally:
        with _settings_lock:
            running, before = _writers.pop(spark)
            if running > 1:
                _writers[spark] = (running - 1, before)
            else:
                for key, value in before.items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Of the files written: two thirds of the bytes of Spark's default.
COMPRESSION = "zstd"


def local_session(app: str, cores: str = "8", **conf: str) -> SparkSession:
    """A single-JVM session as tests and the benchmark use it."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it exists; False if it does. One of two callers wins."""
    target, files = _file_system(spark, path)
    files.mkdirs(target.getParent())
    return files.createNewFile(target)


def delete_file(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it; nothing happens if it is not there."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def file_age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written, None if it is not there."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return None
    return time.time() - files.getFileStatus(target).getModificationTime() / 1000


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the folders in a folder; none if it does not exist."""
    target, files = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().toString() for s in files.listStatus(target) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the files that a file, folder or glob names, without hidden ones."""
    target, files = _file_system(spark, path)
    found = []
    for status in files.globStatus(target) or []:
        inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [
            s.getPath().toString()
            for s in inside
            if s.isFile() and s.getPath().getName()[0] not in "._"
        ]
    return sorted(found)


def first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """The first line of a text file, compressed or not; None if it is empty."""
    target, files = _file_system(spark, path)
    java = spark._jvm.java.io
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(files.getConf())
    codec, stream = codecs.getCodec(target), files.open(target)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        return java.BufferedReader(java.InputStreamReader(plain, encoding)).readLine()
    finally:
        stream.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names anything, on any file system Spark knows."""
    target, files = _file_system(spark, path)
    found = files.globStatus(target)
    return found is not None and len(found) > 0
