"""What the operators of this subpackage share: tables, staging, distributed running sums."""

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.session import scratch_path

# White space between words, and a word, as the contracts of the queries give them.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, wherever the driver was started."""
    import tallyfold

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(tallyfold.__file__))
    # Read here and sent by Spark; executors never open this path.
    path = os.path.join(tempfile.mkdtemp(), "tallyfold.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the frame below the shared folder and read it back.

    Cuts the lineage without tying it to any executor, and fixes what later jobs see.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucketed_running(df: DataFrame, groups: list[str], bucket: str, order: list, values: dict) -> DataFrame:
    """Per group, running totals of the rows before each one, in order of (bucket, `order`).

    `values` maps a new column to the expression it sums. No group is sorted in one task:
    rows are sorted per (group, bucket), and only bucket totals meet per group. Groups and
    buckets must not be null. The frame is read twice, so it should be staged or cheap.
    """
    keys = [*groups, bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"_{k}_all") for k, v in values.items()])
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"_{k}_all").over(earlier), F.lit(0)).alias(f"_{k}_before") for k in values]
    )
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.select("*", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_{k}_in") for k, v in values.items()])
    whole = inside.join(offsets, keys)
    return whole.select(*df.columns, *[(F.col(f"_{k}_in") + F.col(f"_{k}_before")).alias(k) for k in values])


def global_running(df: DataFrame, order: list, values: dict, label: str) -> DataFrame:
    """Range-sort the whole frame and add running totals of the rows before each one.

    The sorted pieces are staged, so that their bounds stay as they are; between pieces only
    one total per piece moves. Rows equal in all of `order` share a piece.
    """
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = staged(df.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id()), label)
    totals = part.groupBy("_piece").agg(*[F.sum(v).alias(f"_{k}_all") for k, v in values.items()])
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_piece", *[F.coalesce(F.sum(f"_{k}_all").over(earlier), F.lit(0)).alias(f"_{k}_before") for k in values]
    )
    before = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = part.select(
        "*", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_{k}_in") for k, v in values.items()]
    )
    # One row per piece, and there are as many pieces as shuffle partitions.
    whole = inside.join(F.broadcast(offsets), "_piece")
    return whole.select(*df.columns, *[(F.col(f"_{k}_in") + F.col(f"_{k}_before")).alias(k) for k in values])
