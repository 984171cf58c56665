"""Keeping keyed tables: insert-if-absent, upserts, replacement and deletion.

Each operator is a pure function from the present state and a batch to the next state.
The writers below them apply the same functions to stored tables, partitioned by month and
kept in versions (see versions.py): a change is seen as a whole or not at all.
"""

import uuid
from collections.abc import Callable, Iterable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.functions.columns import month_of
from tallyfold.operators import versions
from tallyfold.operators.skew import first_by
from tallyfold.schemas import LABELS, LEDGER
from tallyfold.session import Scratch

KEY = "transaction_id"


def new_rows(target: DataFrame, batch: DataFrame, key: str = KEY, *, order: Iterable[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks; inside the batch the first in `order` wins."""
    once = first_by(batch, [key], list(order))
    return once.join(target.select(key), key, "left_anti").select(*target.columns)


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str = KEY, *, order: Iterable[str]) -> DataFrame:
    """Next state: existing rows win, new keys are added once."""
    return target.unionByName(new_rows(target, batch, key, order=order))


def upsert_columns(
    target: DataFrame, batch: DataFrame, key: str = KEY, columns: Iterable[str] = LABELS, *, order: Iterable[str]
) -> DataFrame:
    """Next state: a matching key takes only `columns` from the batch, a new key the whole row.

    Of batch rows with one key, the last in `order` counts.
    """
    replaced = set(columns)
    once = first_by(batch, [key], list(order), last=True)
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = once.select(*target.columns).withColumn("_new", F.lit(True)).alias("new")
    in_old, in_new = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()

    def pick(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        wanted = in_new if name in replaced else ~in_old
        return F.when(wanted, after).otherwise(before).alias(name)

    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(*[pick(name) for name in target.columns])


def upsert_labels(target: DataFrame, batch: DataFrame, order: Iterable[str] = LABELS) -> DataFrame:
    """Re-classification: stored date, amount and direction stay, the four labels change.

    Labels follow from the text that the key covers, so batch rows of one key agree as a rule;
    if they don't, the last in `order` counts.
    """
    return upsert_columns(target, batch, KEY, LABELS, order=order)


def upsert_by_key(target: DataFrame, batch: DataFrame, key: str, order: Iterable[str]) -> DataFrame:
    """Next state: whole rows replaced by key, the last one in `order` wins, others are kept."""
    latest = first_by(batch, [key], list(order), last=True).select(*target.columns)
    return target.join(latest.select(key), key, "left_anti").select(*target.columns).unionByName(latest)


def delete_where(table: DataFrame, predicate: Column) -> DataFrame:
    """Keep the rows for which the predicate is not true (false or NULL)."""
    return table.where(~F.coalesce(predicate, F.lit(False)))


def replace_table(df: DataFrame, path: str) -> None:
    """Full replacement: the frame becomes the table."""
    df.write.mode("overwrite").parquet(path)


_SCHEMA = "_schema"  # an empty file with the table's columns; readers of the table pass it over


def _stamped(df: DataFrame, date: str) -> DataFrame:
    """Dealt by month and evened out by what arrived, so a busy month is spread over several tasks
    and a quiet one does not become many small files. Unlike a range, it takes no sample first,
    for which the whole frame would be worked out once more."""
    return df.withColumn("month", _month(date)).hint("rebalance", "month")


def _month(date: str) -> Column:
    return F.coalesce(month_of(date), F.lit("none"))


def create_monthly(spark: SparkSession, path: str, schema: StructType = LEDGER) -> None:
    """Make an empty stored table; one that is there already is left as it is."""
    if versions.exists(spark, f"{path}/{_SCHEMA}"):
        return
    beside = f"{path}/{_SCHEMA}-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).coalesce(1).write.parquet(beside)
    try:
        versions.rename_new(spark, beside, f"{path}/{_SCHEMA}")
    except versions.Conflict:
        pass  # another one made it meanwhile


def stored_schema(spark: SparkSession, path: str) -> StructType:
    """The columns the table was made with; a stored table may have any."""
    return spark.read.parquet(f"{path}/{_SCHEMA}").schema


def _checked(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """The frame in the table's column order. Other columns or types than the table's are refused."""
    wanted = stored_schema(spark, path)
    found, kept = ({f.name: f.dataType for f in x.fields} for x in (df.schema, wanted))
    if found != kept:
        raise ValueError(f"columns {found} do not fit the table at {path}, which has {kept}")
    return df.select(*wanted.names)


def append_monthly(spark: SparkSession, path: str, df: DataFrame, date: str = "transaction_date") -> None:
    """Add rows to a stored table as they are."""
    run = versions.write_run(spark, path, _stamped(_checked(spark, path, df), date), KEY)
    versions.change(spark, path, lambda base: (run, set()) if run else None)


def read_monthly(
    spark: SparkSession,
    path: str,
    months: list[str] | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """The stored table as of its present version, or only some months of it (pruned before anything is read).

    `since` and `until` are ISO dates. They pick the rows, and the months that can hold them.
    """
    return _read(spark, path, versions.current(spark, path), months, since, until)


def _read(
    spark: SparkSession,
    path: str,
    version: versions.Version,
    months: list[str] | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    wanted = [
        m
        for m in version.months
        if (months is None or m in months) and (since is None or m >= since[:7]) and (until is None or m <= until[:7])
    ]
    table = versions.read_runs(spark, path, stored_schema(spark, path), version.folders(wanted))
    if months is not None:
        table = table.where(F.col("month").isin(months))
    if since is not None:
        table = table.where((F.col("month") >= since[:7]) & (F.col("transaction_date") >= F.lit(since).cast("date")))
    if until is not None:
        table = table.where((F.col("month") <= until[:7]) & (F.col("transaction_date") <= F.lit(until).cast("date")))
    return table.drop("month")


def stored_months(spark: SparkSession, path: str, last: int | None = None) -> list[str]:
    """Months of a stored table, newest first, from its version alone."""
    months = sorted(versions.current(spark, path).months, reverse=True)
    return [m for m in months if m != "none"][:last]


def months_in(df: DataFrame, date: str = "transaction_date") -> list[str]:
    """Distinct months of a frame. The calendar bounds the list, whatever the row count."""
    found = df.select(_month(date).alias("month")).distinct().collect()
    return sorted(row.month for row in found)


def _kept(spark: SparkSession, df: DataFrame, stored: bool):
    """The frame written below the shared folder: a lazy batch is worked out once, not at every use.
    One that its caller has stored already is read from there."""
    return nullcontext(df) if stored else Scratch(spark, df, "batch")


def append_absent(
    spark: SparkSession, path: str, batch: DataFrame, order: Iterable[str], *, stored: bool = False
) -> None:
    """Insert-if-absent into a stored table. Running it again adds nothing.

    The key covers the date text, so equal keys share a month. The batch's keys are probed
    against the filters of its months; keys are read again only from the runs that may hold
    one of them. Columns that serve `order` only need not be in the table. `stored` says that the
    batch is on disk, so that it is not written once more.
    """
    order = list(order)
    with _kept(spark, batch, stored) as batch:
        keys = batch.select(KEY, _month("transaction_date").alias("month"))

        def step(base: versions.Version):
            maybe = versions.may_hold(spark, path, base, keys, KEY)
            # At most one row per run and month, as in the version's file.
            places = [f"run={r.run}/month={r.month}" for r in maybe.select("run", "month").distinct().collect()]
            there = versions.read_runs(spark, path, stored_schema(spark, path), sorted(places)).drop("month")
            fresh = new_rows(there, batch, order=order)
            run = versions.write_run(spark, path, _stamped(_checked(spark, path, fresh), "transaction_date"), KEY)
            return (run, set()) if run else None

        versions.change(spark, path, step)


def rewrite_labels(spark: SparkSession, path: str, batch: DataFrame, *, stored: bool = False) -> None:
    """Upsert labels in a stored ledger; only months of the batch are rewritten. `stored` as in `append_absent`."""
    with _kept(spark, batch, stored) as batch:
        months = months_in(batch)
        _replace_months(spark, path, lambda base: (upsert_labels(_read(spark, path, base, months), batch), months))


def delete_rows(
    spark: SparkSession, path: str, predicate: Column, since: str | None = None, until: str | None = None
) -> None:
    """Delete from a stored table, rewriting only the months that hold such rows.

    Dates given as `since` and `until` narrow the predicate, and spare all other months the reading.
    """
    if since is not None:
        predicate = predicate & (F.col("transaction_date") >= F.lit(since).cast("date"))
    if until is not None:
        predicate = predicate & (F.col("transaction_date") <= F.lit(until).cast("date"))

    def left(base: versions.Version):
        touched = months_in(_read(spark, path, base, None, since, until).where(predicate))
        return delete_where(_read(spark, path, base, touched), predicate), touched

    _replace_months(spark, path, left)


def _replace_months(spark: SparkSession, path: str, make: Callable[[versions.Version], tuple[DataFrame, list[str]]]) -> None:
    """Put new versions of some months in the place of the old ones, all of them by one commit.

    `make` gives the new rows and the months they replace, from the version they are made of. A
    run that dies leaves the table as it was or as it was to become, and can be run again.
    """

    def step(base: versions.Version):
        rows, months = make(base)
        if not months:
            return None
        return versions.write_run(spark, path, _stamped(_checked(spark, path, rows), "transaction_date"), KEY), set(months)

    versions.change(spark, path, step)


def truncate_all(spark: SparkSession, tables: Iterable[str]) -> list[str]:
    """Empty catalog tables in the given order; absent ones are skipped. Returns those emptied."""
    emptied = []
    for name in tables:
        if spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], spark.table(name).schema)
            empty.write.insertInto(name, overwrite=True)
            emptied.append(name)
    return emptied


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
