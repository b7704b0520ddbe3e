"""Positions of rows in a total order: dense ids, ranks inside groups and running sums, without a hot task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadfeat.operators.storage import stored

#: Rows of a range partition at most, and the least for which another partition is worth its start.
LARGEST_PART, SMALLEST_PART = 1_000_000, 10_000
#: ``monotonically_increasing_id`` holds the partition above this bit and the row's place in it below.
PART_SHIFT = 33


def parts_for(df: DataFrame, rows: int) -> int:
    """Range partitions for so many rows: as many as shuffles have, fewer for small tables, more for large ones."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // LARGEST_PART), min(usual, -(-rows // SMALLEST_PART)))


def in_order(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], parts: int) -> DataFrame:
    """The rows dealt to ``parts`` ranges of (group, order) and sorted, with their place in ``_at``.

    Equal rows are told apart by where they were read, so that no key, however many rows it has, has to fit
    into one range. ``_at`` is only of use once the frame is written: another run may cut other ranges.
    """
    keys = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in (*group, *order)]
    told = df.withColumn("_row", F.monotonically_increasing_id())
    sorted_ = told.repartitionByRange(parts, *keys, F.col("_row")).sortWithinPartitions(*keys, F.col("_row"))
    return sorted_.drop("_row").withColumn("_at", F.monotonically_increasing_id())


def starts(
    written: DataFrame, group: Sequence[str], outs: Mapping[str, str | None], total: str | None = None
) -> DataFrame:
    """Add to a written frame of ``in_order`` for each ``out: size`` what stands before a row in its group.

    That is the sum of ``size`` over earlier rows, or their number where ``size`` is None. ``total`` names a
    column for the number of rows of the group. Per range and group one row of totals is summed up, so at
    most as many rows as there are ranges meet in one task; it is joined back by range.
    """
    part = F.shiftright("_at", PART_SHIFT)
    found = written.withColumn("_part", part)
    sums = {f"_sum_{out}": F.count(F.lit(1)) if size is None else F.sum(size) for out, size in outs.items()}
    totals = found.groupBy(*group, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"), *[c.alias(name) for name, c in sums.items()]
    )
    ranges = Window.partitionBy(*group).orderBy("_part")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    every = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    # Written, so that the planner knows its size and need not shuffle the rows to join it.
    offsets = stored(totals.select(
        *keys,
        F.col("_part").alias("_p"),
        "_first",
        F.sum("_rows").over(every).alias("_total"),
        *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_before_{out}") for out in outs],
    ), "offsets")
    inner = Window.partitionBy(*group, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    for out, size in outs.items():
        if size is not None:
            found = found.withColumn(f"_inner_{out}", F.coalesce(F.sum(size).over(inner), F.lit(0)))
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)],
        F.col("_part") == F.col("_p"),
    )

    def start(out: str, size: str | None) -> Column:
        inside = F.col("_at") - F.col("_first") if size is None else F.col(f"_inner_{out}")
        return (F.col(f"_before_{out}") + inside).alias(out)

    kept = [c for c in written.columns if c != "_at"]
    named = [] if total is None else [F.col("_total").alias(total)]
    return found.join(offsets, same).select(*kept, *[start(out, size) for out, size in outs.items()], *named)


def with_starts(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    outs: Mapping[str, str | None],
    total: str | None = None,
) -> DataFrame:
    """``starts`` for a frame that is cheap to read twice (a written one): range partitions are stored on the way.

    The result depends on the rows and the order only, not on how the input is split; rows that are equal in
    group and order stand in any order.
    """
    return starts(stored(in_order(df, group, order, parts_for(df, df.count())), "ranges"), group, outs, total)
