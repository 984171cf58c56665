"""Joins and de-duplication that hold up when one key carries a large share of the rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure, not guess: does the frame stay below both the row and the byte bound?

    Rows and bytes are added up where they lie; one row per task is sent on.
    """
    widths = "".join(f" + coalesce(octet_length(CAST(`{name}` AS STRING)), 0) + 16" for name in df.columns)
    rows, size = df.selectExpr("count(*) AS rows", f"coalesce(sum(0{widths}), 0) AS bytes").first()
    return rows <= max_rows and size <= max_bytes


def heavy_keys(facts: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Keys that hold more than half of a task's even share of all rows: _k0, _k1, ..., _pieces.

    Rows are counted where they lie. As each such key holds more than 1 / (2 * parts) of the
    rows, there are fewer than 2 * parts of them, whatever the data. `_pieces` is the number of
    tasks that a key's share is worth, taken four times so that they fall evenly.
    """
    named = facts.select(*[F.col(name).alias(f"_k{at}") for at, name in enumerate(keys)]).dropna()
    counts = named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    share = F.col("_n") * parts / total
    return counts.where(share * 2 > 1).select(*named.columns, F.ceil(share * 4).cast("int").alias("_pieces"))


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    condition,
    spread: str,
    how: str = "left",
    small: bool | None = None,
    keys: dict[str, str] | None = None,
) -> DataFrame:
    """Join a large side with a lookup side that may or may not be small.

    `condition(facts, dim)` gives the join condition; `keys` the columns of the facts that it
    sets equal to columns of the lookup side, where it is more than one equality. A lookup side
    measured to be small is broadcast, so the facts do not move. Otherwise both sides are
    shuffled. Facts of a heavy key are spread over as many tasks as the key's share of all
    facts asks for (by a hash of the column `spread`), and only the lookup rows of such keys
    are repeated; all others are sent once. Results are the same.
    """
    if small is None:
        small = fits_broadcast(dim)
    if small:
        right = dim.alias("dim")
        left = facts.alias("facts")
        return left.join(F.broadcast(right), condition(_of("facts"), _of("dim")), how)
    keys = keys or _equal_columns(condition)
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fewer rows than twice the tasks of a shuffle.
    heavy = F.broadcast(heavy_keys(facts, list(keys), parts))

    def marked(side: DataFrame, names: list[str]) -> DataFrame:
        same = [F.col(f"side.{name}") == F.col(f"heavy._k{at}") for at, name in enumerate(names)]
        joined = side.alias("side").join(heavy.alias("heavy"), same, "left")
        return joined.select("side.*", F.coalesce("_pieces", F.lit(1)).alias("_pieces"))

    salt = F.pmod(F.xxhash64(spread), F.col("_pieces"))
    left = marked(facts, list(keys)).withColumn("_salt", salt).drop("_pieces").alias("facts")
    copies = F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))
    right = marked(dim, list(keys.values())).withColumn("_salt_copy", copies).drop("_pieces").alias("dim")
    on = condition(_of("facts"), _of("dim")) & (F.col("facts._salt") == F.col("dim._salt_copy"))
    return left.join(right.hint("merge"), on, how).drop("_salt", "_salt_copy")


def _equal_columns(condition) -> dict[str, str]:
    """The two columns of a condition that is one equality."""
    asked: dict[str, list[str]] = {"facts": [], "dim": []}

    def asking(side: str):
        def column(name: str):
            asked[side].append(name)
            return F.col(f"{side}.{name}")

        return column

    given = condition(asking("facts"), asking("dim"))
    (fact,), (dim,) = (names if len(names) == 1 else [""] for names in asked.values())
    if str(given) != str(F.col(f"facts.{fact}") == F.col(f"dim.{dim}")):
        raise ValueError("give the keys of a condition that is more than one equality of columns")
    return {fact: dim}


def _of(side: str):
    return lambda name: F.col(f"{side}.{name}")


def first_by(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) in `order`; NULLs come first.

    A rank of 1 is pruned before the shuffle: every map task sends on one candidate per key,
    so a key with very many copies never has to be sorted in one place.
    """
    by = [F.desc_nulls_last(name) if last else F.asc_nulls_first(name) for name in order]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
