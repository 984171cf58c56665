"""Versions of a stored table, and the key filters written with its rows.

A stored table is a folder of runs. A run is what one write added, partitioned by month; it is
never changed. A version says which runs hold the rows of which month. It is one small file,
written beside its place and then renamed to its number, which fails if that number is taken.
So the rename is the whole commit: a writer that dies before it has changed nothing, and one
that dies after it has changed everything; rows in runs that no version names do not exist.
Readers keep to the version they began with, whose runs stay for KEPT further commits.

The file system must rename files whole and without overwriting (HDFS and local ones do).

A run of a table with a key column has a Bloom filter for every month in it: a key's hash
names one bitmap of the month and PROBES bits there. Batches are probed against the bitmaps,
so the keys of a long history are read again only in runs that may hold a key of the batch.
"""

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyfold.session import remove_folder

KEPT = 3  # versions before the present one whose runs stay
ATTEMPTS = 10  # times a change is made anew after others came first
PROBES = 6  # bits a key sets
KEYS_PER_BITMAP = 2048  # of the 32,768 bits of a bitmap, a month's keys set at most a third
BITMAP_BITS = 32768

_VERSIONS, _FILTERS = "_versions", "_filters"


class Conflict(Exception):
    """Another writer has committed first."""


@dataclass(frozen=True)
class Version:
    """Per month the runs that hold its rows, each with the number of bitmaps of its filter (0: none)."""

    number: int = 0
    months: dict[str, dict[str, int]] = field(default_factory=dict)

    def folders(self, months: Iterable[str]) -> list[str]:
        return [f"run={run}/month={month}" for month in sorted(months) for run in sorted(self.months.get(month, {}))]

    def runs(self) -> set[str]:
        return {run for runs in self.months.values() for run in runs}


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, at = file_system(spark, path)
    return system.exists(at(path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    system, at = file_system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at(path))] if system.exists(at(path)) else []


def remove(spark: SparkSession, path: str) -> None:
    remove_folder(spark, path)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{path}/{_VERSIONS}") if n.endswith(".json"))


def _file(path: str, number: int) -> str:
    return f"{path}/{_VERSIONS}/{number:012d}.json"


def _read(spark: SparkSession, path: str, number: int) -> Version:
    system, at = file_system(spark, path)
    stream = system.open(at(_file(path, number)))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(number, json.loads(text))


def current(spark: SparkSession, path: str) -> Version:
    """The version that was committed last; a table without one is empty."""
    numbers = _numbers(spark, path)
    return _read(spark, path, numbers[-1]) if numbers else Version()


def write_run(spark: SparkSession, path: str, stamped: DataFrame, key: str | None = None) -> dict[str, dict[str, int]]:
    """Write rows with a `month` as a new run: per month the run and the size of its filter."""
    run = uuid.uuid4().hex
    stamped.write.partitionBy("month").parquet(f"{path}/run={run}")
    months = [n.removeprefix("month=") for n in names_in(spark, f"{path}/run={run}") if n.startswith("month=")]
    if not months:
        remove(spark, f"{path}/run={run}")
    sizes = dict.fromkeys(months, 0)
    if key in stamped.columns and months:
        sizes = _write_filter(spark, path, run, stamped.schema, key)
    return {month: {run: sizes[month]} for month in months}


def publish(spark: SparkSession, path: str, base: Version, months: dict[str, dict[str, int]]) -> Version:
    """Commit the next version after `base`; Conflict if there is one already."""
    system, at = file_system(spark, path)
    made, place = f"{path}/{_VERSIONS}/.{uuid.uuid4().hex}", _file(path, base.number + 1)
    stream = system.create(at(made), False)
    try:
        stream.write(bytearray(json.dumps(months, sort_keys=True).encode()))
    finally:
        stream.close()
    rename_new(spark, made, place)
    return Version(base.number + 1, months)


def rename_new(spark: SparkSession, made: str, place: str) -> None:
    """Rename to a place that must not be taken."""
    jvm = spark._jvm
    path, options = jvm.org.apache.hadoop.fs.Path, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(made).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(path(made), path(place), options)
    except Exception as failure:
        remove(spark, made)
        if exists(spark, place):
            raise Conflict(place) from failure
        raise


def change(
    spark: SparkSession, path: str, step: Callable[[Version], tuple[dict[str, dict[str, int]], set[str]] | None]
) -> Version:
    """Make a change on the present version, and anew on the next one where another writer came first.

    `step` writes runs and returns them per month, with the months that they replace; runs of
    other months are added. A step that returns nothing changes nothing.
    """
    for _ in range(ATTEMPTS):
        base = current(spark, path)
        made = step(base)
        if made is None:
            return base
        added, replaced = made
        months = {m: dict(runs) for m, runs in base.months.items() if m not in replaced}
        for month, runs in added.items():
            months.setdefault(month, {}).update(runs)
        try:
            version = publish(spark, path, base, months)
        except Conflict:
            continue
        clean(spark, path)
        return version
    raise Conflict(f"{path} was changed by others {ATTEMPTS} times in a row")


def clean(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Remove versions before the last `kept` ones and runs that only these name.

    Data goes before the version that names it, so that a clean-up which dies is finished by the next.
    """
    numbers = _numbers(spark, path)
    old, rest = numbers[: -kept - 1], numbers[-kept - 1 :]
    if not old:
        return
    named = set().union(*[_read(spark, path, n).runs() for n in rest])
    for number in old:
        for run in _read(spark, path, number).runs() - named:
            remove(spark, f"{path}/run={run}")
            remove(spark, f"{path}/{_FILTERS}/run={run}")
        remove(spark, _file(path, number))


def vacuum(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> list[str]:
    """Remove runs that no version names, left by writers that died. Runs still being written are younger."""
    named = set().union(*[_read(spark, path, n).runs() for n in _numbers(spark, path)])
    system, at = file_system(spark, path)
    limit = spark._jvm.System.currentTimeMillis() - older_than_hours * 3_600_000
    gone = []
    for name in names_in(spark, path):
        run = name.removeprefix("run=")
        if name.startswith("run=") and run not in named and system.getFileStatus(at(f"{path}/{name}")).getModificationTime() <= limit:
            remove(spark, f"{path}/{name}")
            remove(spark, f"{path}/{_FILTERS}/{name}")
            gone.append(run)
    return gone


def read_runs(spark: SparkSession, path: str, schema: StructType, folders: list[str]) -> DataFrame:
    """The rows of some runs and months, with `month` as a partition column."""
    whole = StructType([*schema.fields, StructField("run", StringType()), StructField("month", StringType())])
    if not folders:
        return spark.createDataFrame([], whole).drop("run")
    paths = [f"{path}/{folder}" for folder in folders]
    return spark.read.schema(whole).option("basePath", path).parquet(*paths).drop("run")


def _bits(key: Column, bitmaps: Column) -> tuple[Column, list[Column]]:
    """Which bitmap of so many a key belongs to, and its bits there."""
    places = [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BITMAP_BITS)) for k in range(1, PROBES + 1)]
    return F.pmod(F.xxhash64(key), bitmaps), places


def _write_filter(spark: SparkSession, path: str, run: str, schema: StructType, key: str) -> dict[str, int]:
    """Write the bitmaps of a run, and return their number per month."""
    fields = StructType([schema[key], StructField("month", StringType())])
    keys = spark.read.schema(fields).parquet(f"{path}/run={run}")
    # One row per month: the calendar bounds it.
    counts = {r["month"]: r["n"] for r in keys.groupBy("month").agg(F.count("*").alias("n")).collect()}
    sizes = {month: -(-n // KEYS_PER_BITMAP) for month, n in counts.items()}
    bitmap, places = _bits(F.col(key), F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("month")))
    bits = keys.select("month", bitmap.alias("bitmap"), F.explode(F.array(*places)).alias("place"))
    whole = bits.groupBy("month", "bitmap").agg(F.bitmap_construct_agg("place").alias("bits"))
    whole.write.parquet(f"{path}/{_FILTERS}/run={run}")
    return sizes


def may_hold(spark: SparkSession, path: str, version: Version, keys: DataFrame, key: str) -> DataFrame:
    """Keys of a batch with the months and runs that may hold them: key, month, run.

    `keys` has the key and its `month`. Runs without a filter may hold any key.
    """
    filtered = [(run, month, n) for month, runs in version.months.items() for run, n in runs.items() if n]
    plain = [(run, month) for month, runs in version.months.items() for run, n in runs.items() if not n]
    found = keys.select(F.col(key), "month", F.lit(None).cast("string").alias("run")).limit(0)
    if filtered:
        # One row per run and month, as in the version's file.
        sizes = spark.createDataFrame(filtered, "run string, month string, bitmaps int")
        place, places = _bits(F.col(key), F.col("bitmaps"))
        probes = keys.select(key, "month").join(F.broadcast(sizes), "month").select("*", place.alias("bitmap"))
        kind = "month string, bitmap long, bits binary, run string"
        folders = [f"{path}/{_FILTERS}/run={run}" for run in sorted({run for run, _, _ in filtered})]
        stored = spark.read.schema(kind).option("basePath", f"{path}/{_FILTERS}").parquet(*folders)
        # One condition per bit, in turn: most keys that are not there fail the first, and none is interpreted.
        known = reduce(Column.__and__, [F.getbit(_byte_of(p), p % 8) == 1 for p in places])
        found = probes.join(stored, ["run", "month", "bitmap"]).where(known).select(key, "month", "run")
    if plain:
        others = spark.createDataFrame(plain, "run string, month string")
        found = found.unionByName(keys.select(key, "month").join(F.broadcast(others), "month").select(key, "month", "run"))
    return found


def _byte_of(place: Column) -> Column:
    at = (F.floor(place / 8) + 1).cast("int")
    return F.conv(F.hex(F.substr("bits", at, F.lit(1))), 16, 10).cast("int")
