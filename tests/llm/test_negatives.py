"""Hard negatives against brute force: bounds, filtering, blocks, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loamlens.llm import negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>"


def _brute(rows, every=50, n_pos=5, n_neg=3, low=50, high=95):
    whole = []
    for vec_id, label, vector in sorted(set((i, l, None if v is None else tuple(v)) for i, l, v in rows), key=repr):
        if vec_id is not None and label is not None and vector is not None and not any(
                x is None or not math.isfinite(x) for x in vector):
            whole.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    out = []
    for a in whole:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in whole
                        if r is not a and len(r[2]) == len(a[2]))
        for minus, pos_id, _ in [s for s in scored if s[2] == a[1]][:n_pos]:
            hard = [s for s in scored if s[2] != a[1] and low * -minus <= -100 * s[0] <= high * -minus][:n_neg]
            out += [(a[0], pos_id, k, s[1], -minus, -s[0]) for k, s in enumerate(hard, 1)]
    return sorted(out)


def _found(df):
    return sorted(tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def _clustered(n, dim, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    return [(i, int(draw.integers(4)), (centres[draw.integers(6)] + draw.normal(size=dim) / 3).tolist())
            for i in range(n)]


@pytest.mark.parametrize("blocks", [(3, 40), (4096, 4096)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "ROW_BLOCK", blocks[1])
    rows = _clustered(400, 20, 1)
    # ties: equal vectors of different rows
    rows += [(1000 + i, i % 4, rows[i % 7][2]) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = _brute(rows, every=10)
    assert len(expected) > 300
    assert _found(negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)) == expected


def _block(rows):
    vectors = np.floor(np.array([v for *_, v in rows]) * 256)
    return negatives.Block.of(pa.table({
        "vec_id": [i for i, *_ in rows], "key": list(range(len(rows))), "label": [l for _, l, _ in rows],
        "vector": negatives._lists(vectors), "summary": negatives._lists(negatives.summaries(vectors))}))


@pytest.mark.parametrize("dim", [1, 3, 4, 17, 64])
def test_bounds_hold_at_every_level(dim):
    block = _block(_clustered(120, dim, dim))
    exact = block.vectors @ block.vectors.T
    assert len(block.levels) == sum(s <= dim for s in negatives.SEGMENTS)
    for means, spreads in block.levels:
        middle, reach = means @ means.T, spreads @ spreads.T
        assert (np.abs(exact - middle) <= reach + 1e-6 * (1 + np.abs(exact))).all()


def test_few_rows_are_scored_and_none_is_lost():
    """Levels leave ever fewer rows, and what they leave out is no answer."""
    smooth = np.cumsum(np.random.default_rng(5).normal(size=(3000, 64)), axis=1) / 8
    block = _block([(i, i % 5, v.tolist()) for i, v in enumerate(smooth)])
    left = 0
    for i in range(20):
        exact = block.vectors @ block.vectors[i]
        able = np.flatnonzero(block.labels != block.labels[i])
        top = exact[able].max()
        windows = [(math.ceil(top / 2), top * 0.95 // 1), (math.ceil(top / 4), top // 2)]
        stay = negatives.candidates(block, i, block, able, windows, 3)
        left += len(stay)
        for least, most in windows:
            inside = able[(exact[able] >= least) & (exact[able] <= most)]
            assert set(inside[np.argsort(-exact[inside], kind="stable")][:3]) <= set(stay)
    assert left < 0.2 * 20 * 2400


def test_odd_rows(spark):
    rows = _clustered(60, 8, 2)
    odd = [(None, 1, rows[0][2]), (10, None, rows[1][2]), (20, 1, None), (30, 2, [None] + rows[2][2][1:]),
           (40, 2, [math.nan] + rows[2][2][1:]), (50, 2, [math.inf] + rows[2][2][1:]), (70, 1, []), (71, 2, []),
           (72, 1, []), (80, 0, [0.5, 0.25]), (81, 0, [1.0, 1.0]), (82, 1, [0.5, 0.5]), rows[3], rows[3]]
    rows = [r for r in rows if r[0] not in (10, 20, 30, 40, 50)] + odd
    rows += [(90, 1, rows[0][2]), (90, 2, rows[1][2])]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({n: F.lit(n) for n in ("anchor", "key", "dim", "vector", "summary", "row_block", "scores")})
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert _found(found) == _brute(rows, every=10)
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    big = float(1 << 29)
    rows = [(0, 0, [big, 1.0]), (1, 0, [big, 3.0]), (2, 0, [big, 2.0]), (3, 1, [big * 0.75, 2.0]),
            (4, 1, [big * 0.75, 3.0]), (5, 1, [1e200, 1.0]), (6, 1, [-1e200, 1.0]), (7, 1, [1e308, 1.0])]
    small = [(i, l, [x / 256 for x in v]) for i, l, v in rows]
    expected = _brute([r for r in small if r[0] < 5], every=10)
    assert [r[3] for r in expected] == [4, 3, 4, 3]
    found = _found(negatives.hard_negatives(spark.createDataFrame(small, SCHEMA), F.col("vec_id") == 0))
    assert [r for r in found if r[3] < 5] == expected


def test_every_copy_of_a_hot_label_is_ranked(spark):
    rows = [(1 + i, 0, [1.0, 0.5]) for i in range(900)] + [(1000 + i, 1, [0.8, 0.5]) for i in range(300)]
    found = _found(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 450))
    assert found == _brute([r for r in rows if r[0] == 450 or r[0] < 6 or 1000 <= r[0] < 1003], every=450)
