"""Two building blocks that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamlens.session import durable

# A key is only salted while it is among this many largest ones, so the salt table that is
# broadcast has a fixed maximal size. Any key beyond has less than 1/1000 of the rows.
MAX_SALTED_KEYS = 1000
ROWS_PER_SALT = 1_000_000
# What the sketch of frequent keys reports at most, and tracks: a map of 16,384 keys, three quarters full.
# Fewer than 2,340 keys can hold a share that it is sure of, so the report cuts nothing off.
MAX_SKETCHED_KEYS, TRACKED_KEYS = 5_000, 12_288
LEAST_SHARE = 2_340
DIGEST_DIGITS = 3


def _same(on: Sequence[str], prefix: str, null_safe: bool) -> Column:
    """Equality of the key columns with those renamed by ``_renamed_keys``."""
    pairs = [(F.col(c), F.col(f"{prefix}{i}")) for i, c in enumerate(on)]
    return reduce(Column.__and__, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _renamed_keys(df: DataFrame, on: Sequence[str], prefix: str) -> DataFrame:
    keys = [F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(on)]
    return df.select(*keys, *[c for c in df.columns if c not in on])


def hot_keys(df: DataFrame, on: Sequence[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``(on..., _salts)`` of the keys with more than ``rows_per_salt`` rows, as a stored table.

    Candidates come from a mergeable sketch of frequent items, so that no table of all keys is built or
    shuffled; its counts are upper bounds, so every key that holds at least ``1 / LEAST_SHARE`` of the
    rows is among them (the sketch errs by at most 3.5 / 16,384 of the rows, and reports what it is sure of).
    Then the rows of the candidates alone are counted. The table is stored, as both sides of a join
    have to see the same salts and sketches depend on the order of merging.
    """
    key = F.xxhash64(*[F.col(c) for c in on])
    top = F.call_function("approx_top_k", key, F.lit(MAX_SKETCHED_KEYS), F.lit(TRACKED_KEYS))
    found = df.agg(top.alias("top")).select(F.explode("top").alias("key")).where(
        F.col("key.count") > rows_per_salt).select(F.col("key.item").alias("_hash"))
    sized = df.select(*on).join(F.broadcast(found), key == F.col("_hash"), "left_semi") \
        .groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return durable(salts_for(sized, on, rows_per_salt, MAX_SKETCHED_KEYS))


def salts_for(sized_keys: DataFrame, on: Sequence[str], rows_per_salt: int = ROWS_PER_SALT,
              most: int = MAX_SALTED_KEYS) -> DataFrame:
    """The same, ``most`` keys at most, from keys whose number of rows, ``_rows``, is known already."""
    return (
        sized_keys.where(F.col("_rows") > rows_per_salt)
        .orderBy(F.col("_rows").desc(), *on)
        .limit(most)
        .select(*on, F.ceil(F.col("_rows") / rows_per_salt).cast("int").alias("_salts"))
    )


def _with_salts(df: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    # null keys form a hot group like any other, hence the null-safe comparison
    salts = F.broadcast(_renamed_keys(hot, on, "_hot"))
    return df.join(salts, _same(on, "_hot", null_safe=True), "left").select(*df.columns, "_salts")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                null_safe: bool = False, rows_per_salt: int | None = None,
                hot: DataFrame | None = None) -> DataFrame:
    """Equi-join, in which the rows of a hot left key can be dealt out over several tasks.

    Without ``rows_per_salt`` and ``hot`` it is a plain join: neither side is counted or repeated, and
    adaptive execution splits skewed partitions. With one of them the rows of a hot key on the left get one salt each, those on the right are repeated once
    per salt, so every pair meets exactly once. Works for ``inner``, ``left``, ``left_semi`` and
    ``left_anti``. ``hot`` replaces the salts taken from the row counts of the left side. The
    result has the left columns, then the right ones without the keys; other columns must not
    share a name.
    """
    if hot is None and rows_per_salt is None:
        joined = left.join(_renamed_keys(right, on, "_key"), _same(on, "_key", null_safe), how)
        return joined.select(*left.columns, *[c for c in right.columns if c not in on
                                              and how not in ("left_semi", "left_anti")])
    if hot is None:
        hot = hot_keys(left, on, rows_per_salt)
    # The salt depends on the row and its partition only: a repeated task deals its rows out
    # the same way, and copies of one row, spread over the input, still get different salts.
    deal = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns], F.spark_partition_id()),
                  F.col("_salts"))
    dealt = (
        _with_salts(left, hot, on)
        .withColumn("_salt", F.coalesce(deal, F.lit(0)).cast("int")).drop("_salts")
    )
    repeated = (
        _with_salts(right, hot, on)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1,
                                                                       F.lit(0)))))
        .drop("_salts")
    )
    repeated = _renamed_keys(repeated, on, "_key").withColumnRenamed("_salt", "_key_salt")
    condition = _same(on, "_key", null_safe) & (F.col("_salt") == F.col("_key_salt"))
    joined = dealt.join(repeated, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*left.columns)
    return joined.select(*left.columns, *[c for c in right.columns if c not in on])


def grid_for(sized_keys: DataFrame, on: Sequence[str],
             pairs_per_cell: int = ROWS_PER_SALT) -> DataFrame:
    """``(on..., _left_parts, _right_parts)`` of the keys that produce more pairs than one cell should.

    ``sized_keys`` holds the numbers of rows ``_left`` and ``_right`` of each key. A key of ``c`` cells
    is cut into about the root of ``c`` parts on either side, and a side of fewer rows into one part per
    row, the other into the rest. So a row is copied at most ``ceil(sqrt(c))`` times, or all rows
    of the smaller side together about ``c`` times.
    """
    pairs = F.col("_left").cast("double") * F.col("_right")
    cells = F.ceil(pairs / pairs_per_cell)
    root = F.ceil(F.sqrt("_cells"))
    left = F.least("_left", F.greatest(root, F.ceil(F.col("_cells") / F.col("_right"))))
    right = F.least("_right", F.ceil(F.col("_cells") / F.col("_left_parts")))
    return (
        sized_keys.where(pairs > pairs_per_cell).withColumn("_cells", cells)
        .orderBy(F.col("_cells").desc(), *on).limit(MAX_SALTED_KEYS)
        .withColumn("_left_parts", left.cast("int")).withColumn("_right_parts", right.cast("int"))
        .select(*on, "_left_parts", "_right_parts")
    )


def _on_grid(df: DataFrame, hot: DataFrame, on: Sequence[str], own: str, other: str) -> DataFrame:
    """Every row in one part of its own side, ``_own``, and once for each part of the other, ``_other``."""
    parts = F.broadcast(_renamed_keys(hot, on, "_hot"))
    # as in salted_join: the same part whenever a task is repeated
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id()), F.col(own))
    others = F.sequence(F.lit(0), F.coalesce(F.col(other) - 1, F.lit(0)))
    return df.join(parts, _same(on, "_hot", null_safe=True), "left").select(
        *df.columns, F.coalesce(part, F.lit(0)).cast("int").alias("_own"),
        F.explode(others).alias("_other"))


def grid_join(left: DataFrame, right: DataFrame, on: Sequence[str], grid: DataFrame,
              tasks: int | None = None, in_order: bool = False) -> DataFrame:
    """Inner equi-join, in which the pairs of a hot key are spread over a grid of cells.

    ``grid`` (see ``grid_for``) says into how many parts each side of a key is dealt; every pair of
    rows meets in one cell, that of its two parts. Keys without an entry are one cell. The result has
    the left columns, then the right ones without the keys; other columns must not share a name.

    With ``tasks`` the cells are dealt over so many tasks. Without, adaptive execution may put them into a few,
    by the bytes of the sides, which are small beside their pairs. ``in_order`` lets the pairs of a left row in a cell
    follow each other.
    """
    # null keys meet nothing, so they shouldn't move
    left, right = (side.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in on])) for side in (left, right))
    rows = _on_grid(left, grid, on, "_left_parts", "_right_parts")
    cols = _on_grid(right, grid, on, "_right_parts", "_left_parts")
    cols = _renamed_keys(cols, on, "_key").withColumnsRenamed({"_own": "_right", "_other": "_left"})
    if tasks:
        rows = rows.repartition(tasks, *on, "_own", "_other")
        cols = cols.repartition(tasks, *[f"_key{i}" for i in range(len(on))], "_left", "_right")
    condition = (_same(on, "_key", null_safe=False) & (F.col("_own") == F.col("_left"))
                 & (F.col("_other") == F.col("_right")))
    if in_order:  # a merge join goes by its left rows, and isn't replanned
        rows = rows.hint("merge")
    return rows.join(cols, condition).select(
        *left.columns, *[c for c in right.columns if c not in on])


def with_copies(df: DataFrame, copy: str, size: int, n: str | None = None) -> DataFrame:
    """The rows of ``df``, each with its number ``copy`` among the rows equal to it, from 1, and with ``n`` of these.

    Equal rows are counted by partial aggregation, and their copies are made by ranges of bounded ``size`` that are dealt
    over tasks, so no task holds all rows of a large group.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    sized = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    ranges = sized.select(*columns, F.xxhash64(*columns).alias("_digest"), "_n", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / size))).alias("_range"))
    first = F.col("_range") * size + 1
    return ranges.repartition("_digest", "_range").select(*columns, *([F.col("_n").alias(n)] if n else []), F.explode(
        F.sequence(first, F.least(F.col("_n"), first + size - 1))).alias(copy))


def digest(key: Column, seed: int) -> Column:
    """Seeded hexadecimal digest of a key: a reproducible shuffle that any SQL engine can redo."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))


def rank_by_digest(keys: DataFrame, key: str, seed: int, within: str | None = None,
                   digits: int = DIGEST_DIGITS) -> DataFrame:
    """Add ``digest``, ``rank`` (from 1) and ``n_ranked`` of distinct keys, in digest order.

    A plain ``row_number`` would sort everything, or a whole class, in one task. Leading digits
    of the digest cut the order into ``16 ** digits`` even buckets: the rank is the number of
    keys in the buckets before plus the position inside the bucket.
    """
    classes = [within] if within else []
    keys = (
        keys.withColumn("digest", digest(F.col(key), seed))
        .withColumn("_bucket", F.substring("digest", 1, digits))
    )
    in_class = Window.partitionBy(*classes) if classes else Window.partitionBy(F.lit(0))
    before = in_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keys.groupBy(*classes, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(*classes, "_bucket",
                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                F.sum("_n").over(in_class).alias("n_ranked"))
    )
    position = F.row_number().over(
        Window.partitionBy(*classes, "_bucket").orderBy("digest", key))
    return (
        keys.withColumn("_position", position)
        .join(offsets, [*classes, "_bucket"])
        .withColumn("rank", F.col("_before") + F.col("_position"))
        .drop("_bucket", "_before", "_position")
    )
