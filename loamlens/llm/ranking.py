"""Positions in an order, for tables of any size: no group is sorted in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamlens.session import durable

#: rows of one range of the order, which one task sorts
RANGE_ROWS = 50_000


def with_positions(rows: DataFrame, within: Sequence[str], order: Sequence[Column], name: str = "position",
                   range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with the gapless position, from 0, of each row among those that are equal in ``within``.

    ``rows`` must be a stored table. Rows are numbered as they are stored, which settles ties, so that a
    key held by a third of all rows is cut into as many ranges as its rows need. The ranges are stored
    with their number; a position is a row's place in its range plus the rows of the ranges before,
    which are counted in a table of one row per range and group. ``_id``, ``_range`` and ``_before`` are
    taken as names.
    """
    order = [*order, F.col("_id")]
    numbered = rows.withColumn("_id", F.monotonically_increasing_id())
    ranges = max(1, -(-rows.count() // range_rows))
    placed = durable(numbered.repartitionByRange(ranges, *within, *order)
                     .withColumn("_range", F.spark_partition_id()))
    counts = placed.groupBy("_range", *within).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", *within, F.coalesce(
        F.sum("_rows").over(earlier), F.lit(0).cast("bigint")).alias("_before"))
    inside = Window.partitionBy("_range", *within).orderBy(*order)
    local = placed.withColumn("_inside", F.row_number().over(inside) - 1)
    return local.join(offsets, ["_range", *within]).select(
        *rows.columns, (F.col("_before") + F.col("_inside")).alias(name))
