"""Dense, deterministic numbering without a single-partition window.

``row_number() over (order by k)`` puts every row into one task.  Instead we
range-partition on the order key, sort within partitions, tag each row with
its partition and its index inside it, land that once in the shared
checkpoint folder, and add the row count of all earlier partitions.  There is
one plan at every size, whether keys repeat or not.  Where the order key
identifies a row, ids do not depend on how rows were partitioned, so a
retried or re-planned job assigns the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.sizing import bounded_broadcast
from quire.operators.stage import land, materialize

_PID = "__q_pid"
_IDX = "__q_idx"
_BEFORE = "__q_before"


def _ranged(df: DataFrame, order_cols: list[str], num_partitions: int | None, label: str) -> DataFrame:
    """Rows in ``order_cols`` order, landed with their range partition and their index in it."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    index = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    tagged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns({_PID: F.spark_partition_id(), _IDX: index})
    return land(tagged, label)


def _with_offsets(staged: DataFrame, value) -> DataFrame:
    """Add the total of ``value`` over all earlier range partitions.

    The totals are one row per partition, a number set by configuration, so
    one window task and a broadcast are bounded.
    """
    totals = staged.groupBy(_PID).agg(F.sum(value).alias("__q_total"))
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__q_total").over(earlier), F.lit(0)).cast("long")
    return staged.join(F.broadcast(totals.select(_PID, before.alias(_BEFORE))), _PID)


def dense_number(
    df: DataFrame,
    order_cols: list[str],
    out_col: str,
    num_partitions: int | None = None,
    start: int = 1,
) -> DataFrame:
    """Add ``out_col`` = position of the row in ``order_cols`` order (from ``start``).

    ``order_cols`` should identify a row, else ties get an arbitrary (but
    still dense) order.  They should be of bounded size: range partitioning
    samples them onto the driver.  Rows are shuffled and written once, with
    all their columns.
    """
    numbered = _with_offsets(_ranged(df, order_cols, num_partitions, "numbering"), F.lit(1))
    position = (F.col(_BEFORE) + F.col(_IDX) + F.lit(start)).cast("long")
    return numbered.select(*df.columns, position.alias(out_col))


def rank_within(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    out_col: str,
    num_partitions: int | None = None,
    start: int = 0,
) -> DataFrame:
    """``row_number() over (partition by g order by o) - 1 + start`` without a per-group task.

    (group, order) must identify a row.  Rows are numbered globally in
    (group, order) order; the first number of
    each group comes from a partial aggregation (map-side combined, so a hot
    group costs one row per map task) and is subtracted.
    """
    numbered = dense_number(df, group_cols + order_cols, "__q_g", num_partitions)
    firsts = materialize(numbered.groupBy(*group_cols).agg(F.min("__q_g").alias("__q_first")), "firsts")
    return (
        numbered.join(bounded_broadcast(firsts), group_cols)
        .withColumn(out_col, (F.col("__q_g") - F.col("__q_first") + F.lit(start)).cast("long"))
        .drop("__q_g", "__q_first")
    )


def prefix_sum(
    df: DataFrame,
    order_cols: list[str],
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all rows before this one in ``order_cols`` order.

    Same two passes as :func:`dense_number`; the running sum is a window
    within one range partition.
    """
    numbered = _with_offsets(_ranged(df, order_cols, num_partitions, "prefix"), F.col(value_col))
    earlier = Window.partitionBy(_PID).orderBy(_IDX).rowsBetween(Window.unboundedPreceding, -1)
    run = F.coalesce(F.sum(value_col).over(earlier), F.lit(0))
    return numbered.select(*df.columns, (F.coalesce(F.col(_BEFORE), F.lit(0)) + run).cast("long").alias(out_col))
