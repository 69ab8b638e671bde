"""Hard negatives: segment summaries bound a score from both sides, so few pairs are scored exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from loamlens.session import durable

#: components are multiplied by this and rounded down
SCALE = 256
#: positives of an anchor, negatives of a positive, percentages of the positive's score a negative lies between
POSITIVES, NEGATIVES, LOWEST, HIGHEST = 5, 3, 50, 95
#: segments a vector is cut into, coarse to fine
SEGMENTS = (1, 4, 16)
#: anchors and rows compared by one call
ANCHOR_BLOCK, ROW_BLOCK = 4096, 4096
#: doubles hold whole numbers below this one exactly
_EXACT = 2.0 ** 53
#: scores beyond it count as it
_LARGEST = (1 << 63) - 1


def levels_of(dim: int) -> list[np.ndarray]:
    """The first component of each segment, for every level that a vector of that length can be cut at."""
    return [np.arange(s) * dim // s for s in SEGMENTS if s <= dim]


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Mean and deviation of each segment, level by level, both times the root of the segment's length.

    For two segments of length L the product of vectors is L times that of the means, give or take L times that of the
    deviations.
    """
    parts = []
    for starts in levels_of(vectors.shape[1]):
        lengths = np.diff(np.append(starts, vectors.shape[1]))
        means = np.add.reduceat(vectors, starts, axis=1) / lengths
        rest = vectors - np.repeat(means, lengths, axis=1)
        parts += [means * np.sqrt(lengths), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))]
    return np.hstack(parts) if parts else np.zeros((len(vectors), 0))


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1)


def summarised(rows: DataFrame, anchor: Column, scale: int = SCALE) -> DataFrame:
    """Rows that can take part, equal ones once, with whole components and stored summaries; a stored table."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x.cast("double") * float(scale)) < float("inf")))
    rows = rows.select("vec_id", "label", "embedding", F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.where(whole).distinct().select(
        "*", F.size("embedding").alias("dim"), F.xxhash64("vec_id", "label", "embedding").alias("key"))
    kept = ["vec_id", "key", "label", "anchor", "dim"]
    schema = rows.select(*kept, F.array().cast("array<double>").alias("vector"),
                         F.array().cast("array<double>").alias("summary")).schema

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                vectors = np.floor(_matrix(part.column("embedding"), part.num_rows) * scale)
                with np.errstate(over="ignore", invalid="ignore"):
                    told = summaries(vectors)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [_lists(vectors), _lists(told)],
                    [*kept, "vector", "summary"])

    return durable(rows.mapInArrow(run, schema))


@dataclass(frozen=True)
class Block:
    """Vectors of one length, with the means and deviations of every level."""

    ids: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(table: pa.Table) -> "Block":
        n = table.num_rows
        vectors, told = _matrix(table["vector"], n), _matrix(table["summary"], n)
        levels, at = [], 0
        for starts in levels_of(vectors.shape[1]):
            s = len(starts)
            levels.append((told[:, at:at + s], told[:, at + s:at + 2 * s]))
            at += 2 * s
        plain = [table[c].to_numpy() for c in ("vec_id", "key", "label")]
        return Block(*plain, vectors, levels)


def candidates(anchors: Block, i: int, rows: Block, able: np.ndarray, windows: list[tuple[float, float]],
               k: int) -> np.ndarray:
    """Those of ``able`` that may be among the ``k`` best of a window, a lowest and a highest score.

    A row is left out once its bounds lie outside of every window, or ``k`` others, whose bounds both lie in
    the window, are sure to have a higher score. Rounding of the bounds is allowed for.
    """
    for (ours, our_spread), (means, spreads) in zip(anchors.levels, rows.levels):
        middle, reach = means[able] @ ours[i], spreads[able] @ our_spread[i]
        reach = reach + 1e-9 * (np.abs(means[able]) @ np.abs(ours[i]) + reach + 1)
        low, high = middle - reach, middle + reach
        stays = np.zeros(len(able), bool)
        for least, most in windows:
            may = (low <= most) & (high >= least)
            sure = low[(low >= least) & (high <= most)]
            if len(sure) >= k:
                may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
            stays |= may
        able = able[stays]
    return able


def _scores(anchor: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole inner products, held to a long's range."""
    if not len(vectors) or not len(anchor):
        return np.zeros(len(vectors), np.int64)
    with np.errstate(over="ignore"):
        exact = len(anchor) * np.abs(anchor).max() * np.abs(vectors).max() < _EXACT
    if exact:
        return (vectors @ anchor).astype(np.int64)
    ours = [int(x) for x in anchor]
    sums = (sum(a * int(x) for a, x in zip(ours, v)) for v in vectors)
    return np.array([min(max(x, -_LARGEST), _LARGEST) for x in sums], np.int64)


def best(anchors: Block, rows: Block, windows: list[list[tuple[float, float]]], same_label: bool,
         k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(anchor, window, rows, scores)``: the ``k`` best rows in each of an anchor's windows, ties by id.

    Rows have the anchor's label, the anchor itself aside, or another one.
    """
    with np.errstate(over="ignore"):
        largest = max(np.abs(b.vectors).max(initial=0) for b in (anchors, rows))
        bounded = rows.vectors.shape[1] * largest * largest < _EXACT
    for i, asked in enumerate(windows):
        able = rows.labels == anchors.labels[i]
        if same_label:
            able &= (rows.ids != anchors.ids[i]) | (rows.keys != anchors.keys[i])
        able = np.flatnonzero(able if same_label else ~able)
        if bounded:
            able = candidates(anchors, i, rows, able, asked, k)
        scores = _scores(anchors.vectors[i], rows.vectors[able])
        for w, (least, most) in enumerate(asked):
            at = np.flatnonzero((scores >= least) & (scores <= most))
            at = at[np.lexsort((rows.keys[able[at]], rows.ids[able[at]], -scores[at]))[:k]]
            yield i, w, able[at], scores[at]


_FOUND = ["anchor_id", "anchor_key", "window", "id", "key", "score"]


def _searched(rows: DataFrame, anchors: DataFrame, sizes: DataFrame, windows_of, same_label: bool,
              k: int) -> DataFrame:
    """``best`` on every block of anchors with every block of rows of the same length; a row of ``_FOUND`` per
    window and place, counted from 1.

    Blocks are dealt by digest and their number follows the counts, so all have about the same size, and a
    call holds one of each. What the blocks find is ranked once more.
    """
    rows = rows.join(sizes, "dim").withColumns({
        "row_block": F.pmod("key", "row_blocks"),
        "anchor_block": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("anchor_blocks") - 1))})
    anchors = anchors.join(sizes, "dim").withColumns({
        "anchor_block": F.pmod("key", "anchor_blocks"),
        "row_block": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("row_blocks") - 1))})
    anchors = anchors.toDF(*anchors.columns)  # they come from the same table as the rows

    def search(anchor_table: pa.Table, row_table: pa.Table) -> pa.Table:
        mine, others = Block.of(anchor_table), Block.of(row_table)
        parts = [np.zeros((0, len(_FOUND)), np.int64)]
        for i, w, at, scores in best(mine, others, windows_of(anchor_table), same_label, k):
            parts.append(np.column_stack([
                np.full(len(at), x, np.int64) for x in (mine.ids[i], mine.keys[i], w + 1)]
                + [others.ids[at], others.keys[at], scores]))
        return pa.table(list(np.vstack(parts).T), schema=pa.schema([(c, pa.int64()) for c in _FOUND]))

    pair = ["dim", "anchor_block", "row_block"]
    found = anchors.groupBy(*pair).cogroup(rows.groupBy(*pair)).applyInArrow(
        search, ", ".join(f"{c} bigint" for c in _FOUND))
    first = Window.partitionBy("anchor_id", "anchor_key", "window").orderBy(F.col("score").desc(), "id", "key")
    return found.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lowest: int = LOWEST, highest: int = HIGHEST, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; other columns are not looked at. ``anchor`` says
    which of them are anchors; these are a stated query set, held against all rows in blocks of bounded size, and
    only the best of each block leave a task. An anchor's positives are the best others of its label, a
    positive's negatives the best of other labels with a score between ``lowest`` and ``highest`` percent of its own (of
    a negative score: none). Ties go to the smaller id.

    Rows with a null id, label or vector, or a component that is null or, once scaled, not finite,
    take no part. Equal rows count once; rows that share an id only are rows of their own. Vectors of different lengths have
    no product. Scores are exact; those beyond a long are its largest or smallest. An empty table
    gives an empty one.
    """
    rows = summarised(rows, anchor, scale)
    counts = rows.groupBy("dim").agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors"))
    sizes = durable(counts.where("anchors > 0").select(
        "dim", F.ceil(F.col("rows") / ROW_BLOCK).alias("row_blocks"),
        F.ceil(F.col("anchors") / ANCHOR_BLOCK).alias("anchor_blocks")))
    anchors = rows.where("anchor")
    near = durable(_searched(rows, anchors, sizes, lambda table: [[(-np.inf, np.inf)]] * table.num_rows, True, positives)
                   .select("anchor_id", "anchor_key", F.col("nth").alias("window"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score")))
    # scores fall with the place, so those of 0 and more are the first ones
    asked = near.where("positive_score >= 0").groupBy("anchor_id", "anchor_key").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("window", "positive_score"))), lambda p: p["positive_score"]).alias("scores"))
    asked = anchors.join(asked.toDF("vec_id", "key", "scores"), ["vec_id", "key"])

    def windows(table: pa.Table) -> list[list[tuple[float, float]]]:
        return [[(-(-lowest * s // 100), highest * s // 100) for s in scores] for scores in table["scores"].to_pylist()]

    hard = _searched(rows, asked, sizes, windows, False, negatives)
    return hard.join(near, ["anchor_id", "anchor_key", "window"]).select(
        "anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
