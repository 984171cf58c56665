"""Session settings and the shared working folder."""

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The method limit is the size up to which the JVM compiles a method to machine code. The
# labelling CASE with the operators around it can pass it; such a stage is better run as
# several smaller methods than interpreted.
_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name: str = "tallyfold", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session with adaptive execution on; `conf` keys use `_` for `.`."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Bound the size of compiled methods in a session started elsewhere.

    This changes no result. Time zone and adaptive execution are the caller's to set.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, _SETTINGS[name])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A machine-local folder is made up only for a local master with the setting unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tallyfold-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_own = threading.local()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder, or below that of `scratch_within`."""
    return f"{getattr(_own, 'folder', None) or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_within(spark: SparkSession, name: str) -> Iterator[str]:
    """Let all scratch data of this thread lie in one folder that is emptied first and goes at the end.

    A run that is repeated under the same name after it died replaces what it left behind.
    """
    folder, before = f"{shared_folder(spark)}/{name}", getattr(_own, "folder", None)
    remove_folder(spark, folder)
    _own.folder = folder
    try:
        yield folder
    finally:
        _own.folder = before
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def kept(spark: SparkSession, df: DataFrame, label: str = "lines") -> DataFrame:
    """The frame written below the shared folder and read back.

    It is worked out once for all who read it. Positions count from where a scan starts, and
    each scan plans its own splits; written once, they are the same for everybody.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_in_turn(spark: SparkSession, frames: Iterable[DataFrame], label: str) -> DataFrame:
    """Frames of one schema, written below the shared folder one after the other and read back as one."""
    path = scratch_path(spark, label)
    for df in frames:
        df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """A frame written below the shared folder, for as long as a `with` block lasts.

    A lazy frame is worked out once, not at every use, and what was written goes when the
    block ends, also by a failure.
    """

    def __init__(self, spark: SparkSession, df: DataFrame, label: str):
        self.spark, self.df, self.path = spark, df, scratch_path(spark, label)

    def __enter__(self) -> DataFrame:
        self.df.write.parquet(self.path)
        return self.spark.read.schema(self.df.schema).parquet(self.path)

    def __exit__(self, *_) -> None:
        remove_folder(self.spark, self.path)
