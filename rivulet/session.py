"""Session helpers: one place for the settings every job relies on.

Settings that change results (session time zone, ANSI) are pinned here; the
sizing settings (shuffle partitions, file split size) are only defaults and are
left alone when the cluster already set them.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults applied only when the session does not have a value yet.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only when the runtime size of a side is known to be small;
    # above it Spark keeps the shuffle join.  This is the size check for every
    # join that is not on a dimension of fixed size.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
    # rows reach Python workers in batches of this size, whatever their length;
    # Spark's 64 MB is held several times over (JVM, pipe, Arrow, Python objects)
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # session windows are pre-merged inside each input partition before the
    # shuffle, so a hot key's events are not all shipped to one task unmerged
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

#: Folder of a one-process session that names none, by application.
_LOCAL_DIRS: dict[str, str] = {}
#: Published folders that this process has looked up, by application and name.
_PUBLISHED: dict[tuple[str, str], str] = {}


def build_session(master: str | None = None, app_name: str = "rivulet",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only used when given (tests, bench); on a cluster the
    launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("RIVULET_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin result-affecting settings on an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session that runs
    in one process (``local[...]``, as in tests) may go without: it gets a
    fresh folder; on a cluster a missing setting is an error, because the
    executors would not see the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(spark.sparkContext.applicationId)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
        base = _LOCAL_DIRS[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="rivulet-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared folder (never reused)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path in it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system; an unreachable one raises."""
    fs, target = _file_system(spark, path)
    return bool(fs.exists(target))


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage with all it holds (nothing if it isn't there)."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path`` (0 if it isn't there)."""
    fs, target = _file_system(spark, path)
    return int(fs.getContentSummary(target).getLength()) if fs.exists(target) else 0


#: Whether Spark removes the shuffle files of a query as soon as the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, the shuffle files of a write, or of a DataFrame made here, go with its end, not with some later garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def file_statuses(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of the data files of ``path``, from the listing alone."""
    fs, target = _file_system(spark, path)
    found, files = [], fs.listFiles(target, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((name, int(f.getLen()), int(f.getModificationTime())))
    return sorted(found)


def content_token(spark: SparkSession, *parts: str, path: str) -> str:
    """Short name for the data at ``path`` as it is now: it changes when a file does."""
    listing = repr((parts, path.rstrip("/"), [(n, size, at) for n, size, at in file_statuses(spark, path)]))
    return hashlib.sha1(listing.encode()).hexdigest()[:12]


def published(spark: SparkSession, name: str, build) -> str:
    """The folder that ``build(folder)`` filled under ``name``.

    It is built into a new folder, and a one-line file that names the folder is
    written last; later calls read that file.  A folder is never written again,
    so DataFrames over it stay valid; of two builders at once either one's
    folder is used, whole.
    """
    ref = f"{shared_dir(spark)}/published/{name}"
    key = (spark.sparkContext.applicationId, ref)
    folder = _PUBLISHED.get(key)
    if folder is None and path_exists(spark, f"{ref}/_SUCCESS"):
        folder = spark.read.text(ref).first()[0]
    if folder is None or not path_exists(spark, folder):  # never built, or removed since
        fresh = scratch_path(spark, name)
        build(fresh)
        spark.createDataFrame([(fresh,)], "value string").coalesce(1).write \
            .mode("ignore" if folder is None else "overwrite").text(ref)
        folder = spark.read.text(ref).first()[0]
    _PUBLISHED[key] = folder
    return folder
