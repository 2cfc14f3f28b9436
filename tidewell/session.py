"""Session defaults and the shared working folder."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

UNKNOWN_BYTES = 1 << 60
SHUFFLE_BYTES = 128 * 1024 * 1024  # input bytes per shuffle partition
MAX_SHUFFLE_PARTITIONS = 20_000


def get_session(name: str = "tidewell", master: str | None = None, **extra) -> SparkSession:
    """A session with this library's defaults; ``extra`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, whose Python workers run parts of it. Sessions
    of one application share it, so it is sent once."""
    _ship(spark.sparkContext)


@functools.cache
def _ship(context: SparkContext) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidewell-"), "tidewell")
    context.addPyFile(
        shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, for checkpoints and written tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may go
    without: it then gets a temporary folder, since all its tasks see one disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tidewell-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")


def checkpointed(df):
    """``df`` written to the shared checkpoint folder, with its lineage cut."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raises the session's shuffle partitions to suit an input; returns the setting.

    Spark's default of 200 suits tens of gigabytes. AQE merges partitions that
    turn out small but cannot make more, so the number must be high enough to
    begin with. It is bounded, because the driver tracks every map task times
    every partition, and a setting that is already higher is kept.
    """
    setting = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MAX_SHUFFLE_PARTITIONS, input_bytes // SHUFFLE_BYTES + 1)
    if wanted > setting:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(setting, wanted)


def estimated_bytes(df) -> int | None:
    """Spark's size estimate of ``df`` before running it, or None where it has none.

    A table has the size of its files. For rows from elsewhere Spark reports a
    placeholder near the largest long.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else None


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; empty when it is missing."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_file(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isFile()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly under ``path``, in order."""
    fs, hadoop_path = _hadoop(spark, path)
    names = (s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isFile())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def set_changed(spark: SparkSession, path: str, millis: int) -> None:
    """Sets a file's time of change, by which a stream of files orders them."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.setTimes(hadoop_path, millis, -1)


def changed_at(spark: SparkSession, path: str) -> int:
    """A file's time of change, in milliseconds since 1970."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop(spark, path)
    fs.mkdirs(hadoop_path)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library wrote and nothing reads any more."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
