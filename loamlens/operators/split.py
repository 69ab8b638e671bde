"""Group-aware splits: holdout by shuffled groups, balanced folds, disjointness check."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from loamlens.errors import GroupLeakError, TooFewGroupsError
from loamlens.operators.rows import Rows
from loamlens.operators.skew import digest, rank_by_digest, salted_join
from loamlens.schemas import CV_FOLDS, HOLDOUT_SHARE, SEED
from loamlens.session import durable

# More size classes than this are joined by a shuffle instead of a broadcast.
MAX_BROADCAST_ROWS = 100_000


def holdout_condition(df: DataFrame, group: str, share: float = HOLDOUT_SHARE,
                      seed: int = SEED) -> Column:
    """Condition that is true for the rows of ``ceil(share * groups)`` shuffled groups.

    Groups are ordered by digest; only the last digest that still belongs to the holdout is
    fetched, so applying the split needs neither a join nor a shuffle.
    """
    groups = df.select(group).distinct()
    ranked = rank_by_digest(groups, group, seed)
    last = (
        ranked.where(F.col("rank") == F.ceil(F.col("n_ranked") * F.lit(share)))
        .select("digest").first()
    )
    if last is None:
        raise TooFewGroupsError(f"no group in column {group!r} to split by")
    return digest(F.col(group), seed) <= F.lit(last["digest"])


def group_holdout(df: DataFrame, group: str, share: float = HOLDOUT_SHARE, seed: int = SEED,
                  flag: str = "is_holdout") -> DataFrame:
    return df.withColumn(flag, holdout_condition(df, group, share, seed))


def deal_equal_groups(size: int, count: int, loads: list[int]) -> list[tuple[int, int, list[int]]]:
    """Deal ``count`` groups of one size, each to the lightest fold (ties: lowest fold).

    Returns ``(first_rank, last_rank, cycle)`` runs: inside a run the folds take turns in the
    order of ``cycle``. At most one run per fold, however many groups there are. ``loads`` is
    updated in place.
    """
    runs, dealt = [], 0
    waiting = sorted(range(len(loads)), key=lambda f: (loads[f], f))
    active: list[int] = []
    while dealt < count:
        active.append(waiting.pop(0))
        cycle = sorted(active, key=lambda f: (loads[f], f))
        take = count - dealt
        if waiting:
            # turns each active fold has before the next waiting fold becomes the lightest
            goal, rival = loads[waiting[0]], waiting[0]
            turns = sum((goal - loads[f] + (f < rival) + size - 1) // size
                        for f in cycle if (loads[f], f) < (goal, rival))
            take = min(take, turns)
        if take == 0:
            continue
        runs.append((dealt + 1, dealt + take, cycle))
        for position, fold in enumerate(cycle):
            loads[fold] += size * ((take - position + len(cycle) - 1) // len(cycle))
        dealt += take
    return runs


def fold_runs(sizes: Iterable[tuple[int, int]], n_folds: int):
    """Rows ``(size, first_rank, last_rank, cycle)`` for ``(size, count)``, largest size first."""
    loads = [0] * n_folds
    for size, count in sorted(sizes, reverse=True):
        for run in deal_equal_groups(size, count, loads):
            yield (size, *run)


def assign_folds(df: DataFrame, group: str, n_folds: int = CV_FOLDS,
                 seed: int = SEED, weight: str | None = None) -> DataFrame:
    """``(group, group_rows, fold)``: groups by size, each to the lightest fold so far.

    Only the histogram of group sizes reaches the driver. Groups of equal size are taken in
    digest order. ``weight`` names a column that says how many rows a row stands for.
    """
    spark = df.sparkSession
    number = F.sum(weight) if weight else F.count(F.lit(1))
    sized = durable(df.groupBy(group).agg(number.alias("group_rows")))
    histogram = sized.groupBy("group_rows").agg(F.count(F.lit(1)).alias("n")).collect()
    if sum(row["n"] for row in histogram) < n_folds:
        raise TooFewGroupsError(f"column {group!r} has fewer than {n_folds} groups")
    runs = list(fold_runs([(row["group_rows"], row["n"]) for row in histogram], n_folds))
    schema = T.StructType([
        T.StructField("group_rows", T.LongType()), T.StructField("_first", T.LongType()),
        T.StructField("_last", T.LongType()), T.StructField("_cycle", T.ArrayType(T.IntegerType())),
    ])
    table = spark.createDataFrame(runs, schema)
    if len(runs) <= MAX_BROADCAST_ROWS:
        table = F.broadcast(table)
    turn = F.pmod(F.col("rank") - F.col("_first"), F.size("_cycle")).cast("int")
    return (
        rank_by_digest(sized, group, seed, within="group_rows")
        .join(table, "group_rows")
        .where(F.col("rank").between(F.col("_first"), F.col("_last")))
        .select(group, "group_rows", F.get("_cycle", turn).alias("fold"))
    )


def with_folds(df: DataFrame | Rows, group: str, n_folds: int = CV_FOLDS, seed: int = SEED) -> DataFrame | Rows:
    """``df`` with a ``fold`` column; a group with very many rows is joined over several tasks."""
    if isinstance(df, Rows):
        folds = assign_folds(df.kinds, group, n_folds, seed, "_weight").drop("group_rows")
        return replace(df, kinds=durable(salted_join(df.kinds, folds, [group], null_safe=True)))
    folds = assign_folds(df, group, n_folds, seed).drop("group_rows")
    return salted_join(df, folds, [group], null_safe=True)


def shared_groups(left: DataFrame, right: DataFrame, group: str) -> DataFrame:
    """Groups present in both frames."""
    return left.select(group).intersect(right.select(group))


def require_disjoint(left: DataFrame, right: DataFrame, group: str) -> None:
    leaked = shared_groups(left, right, group).first()
    if leaked is not None:
        raise GroupLeakError(f"group {leaked[0]!r} is on both sides of the split")
