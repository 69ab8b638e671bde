"""Order statistics, imputation, encoding, splits and metrics."""

import math
import random
import statistics

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loamlens.errors import AllMissingError, GroupLeakError, TooFewGroupsError
from loamlens.operators.encode import MIN_MAX, NumericScaler, feature_encoder, one_hot_stages
from loamlens.operators.impute import (
    GroupedMedianImputer, GroupedMostFrequentImputer, GroupwiseImputer)
from loamlens.operators.metrics import (
    bad_fold_summary, correlation, fold_stats, regression_metrics)
from loamlens.operators.order_stats import grouped_modes, high_share, quantiles
from loamlens.operators.split import (
    assign_folds, fold_runs, group_holdout, require_disjoint, with_folds)


def test_quantile_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert quantiles(df, ["x"], 0.9).first()["x"] == pytest.approx(3.7)
    assert df.agg(high_share(F.col("x"), F.lit(3.7))).first()[0] == pytest.approx(0.2)
    even = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert quantiles(even, ["x"]).first()["x"] == 2.5


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.9, 1.0])
def test_narrowing_equals_the_buffer(spark, fraction):
    rng = random.Random(3)
    rows = [("hot", rng.choice([rng.lognormvariate(0, 8), -rng.random(), 5.0]), None)
            for _ in range(3000)]
    rows += [(f"g{i % 7}", rng.random(), float(i % 5)) for i in range(200)]
    rows += [("single", 1e300, -1e300), ("single", -1e300, 1e300), (None, 99.0, 99.0)]
    df = spark.createDataFrame(rows, "g string, x double, z double")
    for group in ("g", None):
        plain = quantiles(df, ["x", "z"], fraction, group, buffered=None).collect()
        narrowed = quantiles(df, ["x", "z"], fraction, group, buffered=20).collect()
        assert len(plain) == len(narrowed)
        by_group = {r["g"] if group else 0: r for r in plain}
        for r in narrowed:
            for c in "xz":
                expected = by_group[r["g"] if group else 0][c]
                assert r[c] == (expected if expected is None else pytest.approx(expected))


@pytest.mark.parametrize("buffered", [None, 3])
def test_weighted_quantiles_equal_those_of_repeated_rows(spark, buffered):
    counted = spark.createDataFrame(
        [("a", 1.0, 3), ("a", 2.0, 1), ("a", None, 5), ("a", 7.5, 4), ("a", 9.0, 2), ("b", 4.0, 2), ("b", 5.0, 2)],
        "g string, x double, n long")
    repeated = counted.select("g", "x", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    for group in ("g", None):
        found = quantiles(counted, ["x"], 0.3, group, buffered, "n").collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, quantiles(repeated, ["x"], 0.3, group).collect()))


def test_selection_keeps_each_type(spark):
    """Whole numbers beyond doubles, both zeros and infinities, against sorted lists."""
    rng = random.Random(7)
    base = 1 << 60
    rows = [(rng.choice("ab"), base + rng.randrange(400), rng.choice(
        [0.0, -0.0, float("inf"), float("-inf"), 1e308, -1e308, rng.random()]), rng.randrange(100)) for _ in range(2000)]
    # a third of all rows are one value
    rows += [("a", base + 7, -0.0, 3)] * 1000 + [("a", None, None, None), (None, 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, big bigint, x double, small int")
    for fraction in (0.0, 0.25, 0.5, 0.9, 1.0):
        found = {r["g"]: r for r in quantiles(df, ["big", "x", "small"], fraction, "g", buffered=5).collect()}
        assert set(found) == {"a", "b"}
        for g in "ab":
            for i, c in enumerate(("big", "x", "small"), 1):
                values = sorted(r[i] for r in rows if r[0] == g and r[i] is not None)
                at = (len(values) - 1) * fraction
                low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
                expected = float(low) if at == int(at) else low * (1 - at % 1) + high * (at % 1)
                assert found[g][c] == pytest.approx(expected, nan_ok=True), (g, c, fraction)


def test_selection_reads_its_input_once(spark):
    from loamlens.operators import order_stats

    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(500).selectExpr("1 AS _group", "id AS x", "id / 7 AS y")
    counted = df.mapInArrow(seen, df.schema)
    row = order_stats._selected_by_rank(counted, ["x", "y"], 0.5).first()
    assert (row["x"], row["y"]) == (249.5, pytest.approx(249.5 / 7)) and read.value == 500


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("a", v) for v in ("b", "a", "b", "a", None, None, None)]
                               + [("n", None)], "g string, v string")
    assert {r["g"]: r["v"] for r in grouped_modes(df, ["v"], "g").collect()} == {"a": "a", "n": None}


def test_impute_fixture(spark):
    train = spark.createDataFrame(
        [("a", 1.0), ("a", None), (None, 5.0), ("b", None)], "g string, x double")
    model = GroupedMedianImputer("g", "x").fit(train)
    test = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", None), (3, None, 5.0), (4, "b", None), (5, "z", None),
         (6, None, None)], "i int, g string, x double")
    assert [r["x"] for r in model.transform(test).orderBy("i").collect()] == [1, 1, 5, 3, 3, 3]


def test_impute_all_fills_the_group_last(spark):
    rows = [(1, "a", 1.0, "u"), (2, "a", None, None), (3, None, None, None), (4, "b", 7.0, "v"),
            (5, "a", 3.0, "u")]
    df = spark.createDataFrame(rows, "i int, g string, x double, c string")
    model = GroupwiseImputer("g", ["x", "absent"], ["c", "g"]).fit(df)
    filled = [tuple(r)[1:] for r in model.transform(df).orderBy("i").collect()]
    # the null group gets the global median and mode, not those of the state it is given
    assert filled == [("a", 1, "u"), ("a", 2, "u"), ("a", 3, "u"), ("b", 7, "v"), ("a", 3, "u")]


def test_impute_without_any_value(spark):
    df = spark.createDataFrame([("a", None, None)], "g string, x double, c string")
    assert GroupedMedianImputer("g", "x").fit(df).transform(df).first()["x"] is None
    with pytest.raises(AllMissingError, match="c"):
        GroupedMostFrequentImputer("g", "c").fit(df)
    with pytest.raises(ValueError, match="nowhere"):
        GroupwiseImputer("nowhere", ["x"]).fit(df)


def test_imputer_learns_from_training_rows_only(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "g string, x double")
    model = GroupedMedianImputer("g", "x").fit(train)
    for other in (100.0, -100.0):
        test = spark.createDataFrame([("a", None), ("a", other)], "g string, x double")
        assert sorted(r["x"] for r in model.transform(test).collect()) == sorted([2.0, other])


def test_narrowed_imputer_equals_buffered(spark):
    rng = random.Random(5)
    df = spark.createDataFrame(
        [(i, rng.choice("ab"), rng.choice([None, rng.random()]), rng.choice([None, "u", "v"]))
         for i in range(400)], "i int, g string, x double, c string")
    plain, narrow = (
        [tuple(r) for r in GroupwiseImputer("g", ["x"], ["c"], buffered=b).fit(df).transform(df)
         .orderBy("i").collect()] for b in (100_000, 10))
    assert all(p[3] == n[3] and p[2] == pytest.approx(n[2]) for p, n in zip(plain, narrow))
    before = {r["i"]: r["x"] for r in df.collect()}
    assert all(r[2] is not None and before[r[0]] in (None, r[2]) for r in plain)


def test_scaling_fixture(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, k double")
    scaled = NumericScaler(["x", "k"]).fit(df).transform(df).orderBy("x").collect()
    std = statistics.pstdev([1, 2, 4])
    assert [r["x"] for r in scaled] == pytest.approx([(v - 7 / 3) / std for v in (1, 2, 4)])
    assert [r["k"] for r in scaled] == [0, 0, 0]
    ranged = NumericScaler(["x", "k"], MIN_MAX).fit(df).transform(df).orderBy("x").collect()
    assert [tuple(r) for r in ranged] == [(0, 0), (pytest.approx(1 / 3), 0), (1, 0)]


def test_one_hot_of_unseen_and_null_is_zero(spark):
    train = spark.createDataFrame([("b",), ("a",)], "c string")
    test = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, c string")
    model = Pipeline(stages=one_hot_stages(["c"])).fit(train)
    rows = model.transform(test).orderBy("i").select(vector_to_array("c_onehot").alias("v"))
    assert [r["v"] for r in rows.collect()] == [[1, 0], [0, 0], [0, 0]]


def test_encoder_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, None)], "x double, c string")
    assert feature_encoder(["x"], ["c"]).fit(df).transform(df).count() == 2


def plain_greedy(sizes, k):
    loads, out = [0] * k, []
    for size, count in sorted(sizes, reverse=True):
        for rank in range(1, count + 1):
            fold = min(range(k), key=lambda f: (loads[f], f))
            loads[fold] += size
            out.append((size, rank, fold))
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1, max_size=8),
       st.integers(1, 7))
def test_fold_runs_equal_plain_greedy(sizes, k):
    dealt = [(size, rank, cycle[(rank - first) % len(cycle)])
             for size, first, last, cycle in fold_runs(sizes.items(), k)
             for rank in range(first, last + 1)]
    assert dealt == plain_greedy(sizes.items(), k)


def test_fold_runs_do_not_grow_with_the_groups():
    runs = list(fold_runs([(10**11, 1), (1, 10**12)], 5))
    assert len(runs) <= 10 and runs[-1][2] == 10**12


def test_folds_fixture(spark):
    rows = [(f"g{i}", j) for i, n in enumerate([5, 4, 3, 3, 2, 1]) for j in range(n)]
    df = spark.createDataFrame(rows, "g string, j int")
    folds = {r["g"]: r["fold"] for r in assign_folds(df, "g", 3).collect()}
    assert (folds["g0"], folds["g1"], folds["g2"], folds["g3"], folds["g4"], folds["g5"]) \
        == (0, 1, 2, 2, 1, 0)
    joined = with_folds(df, "g", 3)
    assert joined.count() == 18 and joined.groupBy("fold").count().select("count").distinct() \
        .collect()[0][0] == 6
    with pytest.raises(TooFewGroupsError):
        assign_folds(df, "g", 7)


def test_holdout_is_whole_groups_whatever_the_partitioning(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 13).alias("g"))
    split = group_holdout(df, "g")
    per_group = split.groupBy("g").agg(F.count_distinct("is_holdout").alias("sides"))
    assert per_group.where("sides > 1").isEmpty()
    assert split.where("is_holdout").select("g").distinct().count() == math.ceil(0.2 * 13)
    again = group_holdout(df.repartition(7).orderBy(F.rand(1)), "g")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, split.collect()))
    require_disjoint(split.where("is_holdout"), split.where("NOT is_holdout"), "g")
    with pytest.raises(GroupLeakError):
        require_disjoint(df, df, "g")


def metrics(spark, pairs):
    df = spark.createDataFrame(pairs, "y double, p double")
    return regression_metrics(df, "y", "p").first()


def test_metrics(spark):
    row = metrics(spark, [(1.0, 1.0), (2.0, 3.0), (4.0, 4.0)])
    assert row["rmse"] == pytest.approx(math.sqrt(1 / 3))
    assert row["mae"] == pytest.approx(1 / 3)
    assert row["r2"] == pytest.approx(1 - 1 / (14 / 3))
    assert metrics(spark, [(2.0, 2.0), (2.0, 2.0)])["r2"] == 1
    assert metrics(spark, [(2.0, 2.0), (2.0, 3.0)])["r2"] == 0
    assert metrics(spark, [(2.0, 3.0)])["r2"] is None


def test_correlation_with_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)],
                               "x double, y double, k double")
    row = df.agg(correlation("x", "y"), correlation("x", "k")).first()
    assert row[0] == pytest.approx(1.0) and row[1] is None


def test_fold_stats_and_bad_folds(spark):
    rows = [(0, 1.0, 1.0), (0, 3.0, 3.0), (1, 1.0, 9.0), (1, 2.0, -5.0), (2, 4.0, 4.0)]
    stats = fold_stats(spark.createDataFrame(rows, "fold int, y double, p double"), "y", "p")
    by_fold = {r["fold"]: r for r in stats.collect()}
    total = statistics.variance([1, 3, 1, 2, 4])
    assert by_fold[0]["y_var_norm"] == pytest.approx(2 / total)
    assert by_fold[0]["y_range"] == 2 and by_fold[0]["r2"] == 1
    assert by_fold[2]["r2"] is None and by_fold[2]["y_var_norm"] is None
    assert bad_fold_summary(stats).first()[:] == (True, 1, [1])
