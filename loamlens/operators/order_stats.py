"""Exact quantiles and modes, per group or over everything, without one task holding a group.

``percentile`` keeps every distinct value of a group in one buffer. That is right for groups with
a bounded number of distinct values and is used for those. In the other groups values are selected by
rank instead: equal values are counted, the counts are dealt over ranges of the order by splitters from a
sample, and the rows of each range say which range holds a wanted rank. Only those ranges are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from loamlens.operators.skew import salted_join
from loamlens.session import durable

BUFFERED_DISTINCT_VALUES = 200_000
# Group keys and rank targets are broadcast up to this many rows, joined by a shuffle beyond.
MAX_BROADCAST_ROWS = 100_000


def _with_group(df: DataFrame, cols: Sequence[str], group: str | None,
                weight: str | None = None) -> DataFrame:
    weights = [F.col(weight).alias("_weight")] if weight else []
    if group is None:
        return df.select(F.lit(1).alias("_group"), *cols, *weights)
    return df.where(F.col(group).isNotNull()).select(F.col(group).alias("_group"), *cols, *weights)


def _times(weight: str | None) -> Column:
    """How many rows a row of ``_with_group`` stands for."""
    return F.col("_weight") if weight else F.lit(1)


def _rename(df: DataFrame, cols: Sequence[str], group: str | None) -> DataFrame:
    return df.select(*([F.col("_group").alias(group)] if group else []), *cols)


def _distinct_values(cols: Sequence[str]) -> Column:
    """Distinct values of all columns together, which is what a group's buffers hold."""
    total = sum((F.approx_count_distinct(c) for c in cols), F.lit(0))
    return total.alias("_distinct")


def few_distinct_values(df: DataFrame, cols: Sequence[str],
                        limit: int = BUFFERED_DISTINCT_VALUES) -> bool:
    """Whether the columns have at most ``limit`` distinct values, hence every group of them."""
    return df.agg(_distinct_values(cols)).first()["_distinct"] <= limit


def _join_table(rows: DataFrame, table: DataFrame, n_rows: int, on: Sequence[str],
                how: str = "inner") -> DataFrame:
    if n_rows <= MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(table), list(on), how)
    return salted_join(rows, table, list(on), how)


def quantiles(df: DataFrame, cols: Sequence[str], fraction: float = 0.5,
              group: str | None = None,
              buffered: int | None = BUFFERED_DISTINCT_VALUES, weight: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantile of every column: one row per group, or one row.

    Missing values are skipped, a column without values gives null, a null group gives no row.
    In groups with more than ``buffered`` distinct values in their columns they are selected by rank; None
    says that the caller has checked that there are none. ``weight`` names a column that says how many
    equal rows a row stands for.
    """
    rows = _with_group(df, cols, group, weight)
    built_in = [F.percentile(c, F.lit(fraction), _times(weight)).alias(c) for c in cols]
    wide, n_wide = None, 0
    if buffered is not None:
        wide = durable(rows.groupBy("_group").agg(_distinct_values(cols))
                       .where(F.col("_distinct") > buffered).select("_group"))
        n_wide = wide.count()
    if n_wide == 0:
        if group is None:
            return rows.agg(*built_in)
        return _rename(rows.groupBy("_group").agg(*built_in), cols, group)
    narrow = _join_table(rows, wide, n_wide, ["_group"], "left_anti")
    by_rank = _selected_by_rank(_join_table(rows, wide, n_wide, ["_group"], "left_semi"),
                                cols, fraction, weight)
    result = narrow.groupBy("_group").agg(*built_in).unionByName(by_rank)
    return _rename(result, cols, group)


def quantiles_and_total(df: DataFrame, cols: Sequence[str], fraction: float, group: str,
                        buffered: int = BUFFERED_DISTINCT_VALUES,
                        weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Quantiles per group and over everything, in one aggregation when the values are few."""
    if not few_distinct_values(df, cols, buffered):
        return (durable(quantiles(df, cols, fraction, group, buffered, weight)),
                quantiles(df, cols, fraction, None, buffered, weight))
    times = F.col(weight) if weight else F.lit(1)
    both = durable(
        df.rollup(group).agg(F.grouping(group).alias("_is_total"),
                             *[F.percentile(c, F.lit(fraction), times).alias(c) for c in cols]))
    return (both.where((F.col("_is_total") == 0) & F.col(group).isNotNull()).drop("_is_total"),
            both.where(F.col("_is_total") == 1).select(*cols))


def _melt(rows: DataFrame, cols: Sequence[str], times: Column) -> DataFrame:
    """``(_group, i, whole, real, times)``: values of the i-th column, whole numbers as such, others as doubles.

    A column's values are all in one of the two, so that ordering by both orders them in their own type.
    """
    pairs = []
    for i, c in enumerate(cols):
        is_whole = isinstance(rows.schema[c].dataType, T.IntegralType)
        pairs.append(F.struct(
            F.lit(i).alias("i"), F.col(c).isNotNull().alias("there"),
            (F.col(c) if is_whole else F.lit(None)).cast("bigint").alias("whole"),
            (F.lit(None) if is_whole else F.col(c)).cast("double").alias("real")))
    return rows.select("_group", times.alias("times"), F.explode(F.array(*pairs)).alias("p")).where("p.there").select(
        "_group", "p.i", "p.whole", "p.real", "times")


def _selected_by_rank(rows: DataFrame, cols: Sequence[str], fraction: float,
                      weight: str | None = None) -> DataFrame:
    """Quantiles of all columns of the given groups; the input is read once.

    Equal values meet as counts, so one value with most of the rows is one row here. Ranges are cut by
    group, column and value together; a group's offsets are a running sum over one row per range.
    """
    value = ["whole", "real"]
    counted = _melt(rows, cols, _times(weight)).groupBy("_group", "i", *value).agg(F.sum("times").alias("n"))
    placed = durable(counted.repartitionByRange("_group", "i", *value).withColumn("_part", F.spark_partition_id()))
    ahead = Window.partitionBy("_group", "i").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_group", "i", "_part").agg(F.sum("n").alias("n")).select(
        "_group", "i", "_part", "n", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("_group", "i")).alias("total"))
    position = (F.col("total") - 1) * F.lit(fraction)
    below = F.floor(position)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), below.alias("rank"),
                 (1 - (position - below)).alias("weight")),
        F.struct(F.lit(1).alias("side"), F.least(below + 1, F.col("total") - 1).alias("rank"),
                 (position - below).alias("weight")))
    # at most two ranges of each group and column
    wanted = durable(parts.withColumn("_side", F.explode(sides)).select(
        "_group", "i", "_part", "n", "before", "_side.*").where(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))).drop("n"))
    inside = _join_table(placed, wanted, wanted.count(), ["_group", "i", "_part"])
    until = Window.partitionBy("_group", "i", "side").orderBy(*value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    reached = inside.withColumn("_end", F.col("before") + F.sum("n").over(until))
    picked = reached.where((F.col("rank") < F.col("_end")) & (F.col("rank") >= F.col("_end") - F.col("n")))
    # a neighbour without weight adds nothing, even if it's infinite
    term = F.when(F.col("weight") == 0, 0.0).otherwise(
        F.coalesce("real", F.col("whole").cast("double")) * F.col("weight"))
    return picked.groupBy("_group").agg(
        *[F.sum(F.when(F.col("i") == i, term)).alias(c) for i, c in enumerate(cols)])


def grouped_modes(df: DataFrame, cols: Sequence[str], group: str) -> DataFrame:
    """Most frequent value of every column per group; ties go to the smallest value."""
    rows = _with_group(df, cols, group)
    return _rename(_most_frequent(_value_counts(rows, cols), cols), cols, group)


def global_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    rows = _with_group(df, cols, None)
    return _rename(_most_frequent(_value_counts(rows, cols), cols), cols, None)


def modes_and_total(df: DataFrame, cols: Sequence[str], group: str,
                    weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Modes per group and over everything, from one count of the values per group."""
    weights = [F.col(weight).alias("_weight")] if weight else []
    counts = durable(_value_counts(df.select(F.col(group).alias("_group"), *cols, *weights), cols, weight))
    known = counts.where(F.col("_group").isNotNull())
    total = counts.groupBy(F.lit(1).alias("_group"), "i", "value").agg(F.sum("n").alias("n"))
    return (_rename(_most_frequent(known, cols), cols, group),
            _rename(_most_frequent(total, cols), cols, None))


def _value_counts(rows: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """``(_group, i, value, n)``: how often each value of the i-th column occurs in a group."""
    pairs = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("value"))
             for i, c in enumerate(cols)]
    return (
        rows.select("_group", _times(weight).alias("_times"), F.explode(F.array(*pairs)).alias("_pair"))
        .groupBy("_group", "_pair.i", "_pair.value").agg(F.sum("_times").alias("n"))
    )


def _most_frequent(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    # a group with nothing but missing values keeps its row: the missing value ranks last
    order = F.struct(F.col("value").isNull(), -F.col("n"), F.col("value"))
    chosen = [
        F.min_by(F.when(F.col("i") == i, F.col("value")),
                 F.when(F.col("i") == i, order)).alias(c)
        for i, c in enumerate(cols)
    ]
    return counts.groupBy("_group").agg(*chosen)


def high_share(values: Column, threshold: Column) -> Column:
    """Share of values above the threshold; a missing value counts as not above."""
    return F.avg(F.coalesce(values > threshold, F.lit(False)).cast("double"))


def numeric_ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum of every column in one aggregation."""
    if not cols:
        return {}
    row = df.agg(*[F.struct(F.min(c).cast("double").alias("low"),
                            F.max(c).cast("double").alias("high")).alias(c)
                   for c in cols]).first()
    return {c: (row[c]["low"], row[c]["high"]) for c in cols}


def distinct_head(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """First ``n`` distinct values in sorted order."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(n)


