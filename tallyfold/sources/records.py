"""Records whose quoted cells hold line breaks, in files that are split anywhere.

Whether a line starts inside a quoted cell depends on all lines before it in its file. But
what a line makes of the state at its start is known from the line alone: it leaves it as it
is (no quotes), turns it over, or ends in one state whatever it was. Such steps can be put
together in any grouping. So each block (file split) is summed up on its own, the sums of a
file's blocks give the state each block starts in, and then every line knows its own. Only
sums of blocks meet per file; lines of a block meet in the task that has the block.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# One whole cell with the comma before it, right behind the one before; what is left is a cell that stays open.
_WHOLE_CELL = r'\G,(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
# The end of a cell that was open at the start of the line.
_CLOSING = r'^[^"]*+(?:""[^"]*+)*+"[^,]*+'

_BLOCK = ["file", "block"]


def _stays_open(cells: Column) -> Column:
    return F.regexp_replace(cells, _WHOLE_CELL, "") != ""


def _ends_inside(line: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted cell: if it starts outside one, and if it starts inside."""
    text = F.col(line)
    quoted = text.contains('"')
    from_outside = quoted & _stays_open(F.concat(F.lit(","), text))
    closed = F.regexp_replace(text, _CLOSING, "")
    from_inside = ~quoted | ~text.rlike(_CLOSING) | _stays_open(closed)
    return from_outside, from_inside


def _after(start: Column, known: Column, turns: Column) -> Column:
    """The state after steps: the last that was certain and the turns since, or all turns from the start."""
    odd = lambda n: n % 2 == 1
    certain = known["inside"] != odd(turns - known["turns"])
    return F.when(known.isNotNull(), certain).otherwise(start != odd(turns))


def records(lines: DataFrame) -> DataFrame:
    """Lines (file, block, pos, line) put together to records, with the place of their first line.

    `pos` counts records instead of lines. A cell that is never closed lasts to the end of its file.
    """
    outside, inside = _ends_inside("line")
    in_block = Window.partitionBy(*_BLOCK).orderBy("pos")
    steps = lines.select(*lines.columns, outside.alias("_outside"), inside.alias("_inside"))
    turned = steps.withColumn("_turns", F.sum((F.col("_outside") & ~F.col("_inside")).cast("int")).over(in_block))
    certain = F.when(F.col("_outside") == F.col("_inside"), F.struct(F.col("_outside").alias("inside"), F.col("_turns").alias("turns")))
    known = turned.withColumn("_known", F.last(certain, ignorenulls=True).over(in_block))
    before = known.withColumns(
        {"_known_before": F.lag("_known").over(in_block), "_turns_before": F.coalesce(F.lag("_turns").over(in_block), F.lit(0))}
    )
    placed = before.join(_starts(known), _BLOCK).select(
        *lines.columns, _after(F.col("_start"), F.col("_known_before"), F.col("_turns_before")).alias("_goes_on")
    )
    return _joined(placed, lines.columns)


def _starts(known: DataFrame) -> DataFrame:
    """Per block whether it starts inside a quoted cell: `_start`."""
    last = known.groupBy(*_BLOCK).agg(F.max_by(F.struct("_known", "_turns"), "pos").alias("_sum"))
    by_block = Window.partitionBy("file").orderBy("block")
    upto = by_block.rowsBetween(Window.unboundedPreceding, -1)
    # A block's turns count from its last certain state, if it has one.
    turns = F.col("_sum._turns") - F.coalesce(F.col("_sum._known.turns"), F.lit(0))
    counted = last.withColumn("_all", F.sum(turns).over(by_block))
    state = F.when(
        F.col("_sum._known").isNotNull(),
        F.struct(F.col("_sum._known.inside").alias("inside"), (F.col("_all") - turns).alias("turns")),
    )
    earlier = counted.select(
        *_BLOCK, F.last(state, ignorenulls=True).over(upto).alias("_state"), F.coalesce(F.lag("_all").over(by_block), F.lit(0)).alias("_all")
    )
    return earlier.select(*_BLOCK, _after(F.lit(False), F.col("_state"), F.col("_all")).alias("_start"))


def _joined(placed: DataFrame, names: list[str]) -> DataFrame:
    """First lines of records with the lines that go on behind them."""
    in_block = Window.partitionBy(*_BLOCK).orderBy("pos")
    going = F.sum(F.col("_goes_on").cast("int")).over(in_block)
    begun = F.last(F.when(~F.col("_goes_on"), F.col("pos")), ignorenulls=True).over(in_block)
    numbered = placed.select("*", begun.alias("_begun"), (F.col("pos") - going).alias("_nth"))
    # Lines that go on from an earlier block belong to the last record begun there.
    last = numbered.groupBy(*_BLOCK).agg(F.max("_begun").alias("_last"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = last.select(
        *_BLOCK, F.last(F.when(F.col("_last").isNotNull(), F.struct("block", F.col("_last").alias("pos"))), ignorenulls=True).over(upto).alias("_from")
    )
    on = numbered.where("_goes_on").join(earlier, _BLOCK)
    own = F.struct("block", F.col("_begun").alias("pos"))
    tails = (
        on.withColumn("_from", F.when(F.col("_begun").isNotNull(), own).otherwise(F.col("_from")))
        .groupBy("file", F.col("_from.block").alias("block"), F.col("_from.pos").alias("pos"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("block").alias("at"), F.col("pos").alias("nth"), "line"))).alias("_tail"))
    )
    heads = numbered.where("NOT _goes_on").join(tails, ["file", "block", "pos"], "left")
    whole = F.concat_ws("\n", F.array(F.col("line")), F.transform("_tail", lambda part: part["line"]))
    return heads.select(
        *[F.col("_nth").alias("pos") if n == "pos" else whole.alias("line") if n == "line" else F.col(n) for n in names]
    )
