"""Lookup, salted and temporal joins."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loamlens.operators.lookback import match_crops
from loamlens.operators.lookup import lookup
from loamlens.operators.skew import grid_for, grid_join, hot_keys, rank_by_digest, salted_join
from loamlens.queries import QUERIES


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_lookup_repeats_keeps_and_skips_null_keys(spark):
    base = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    table = spark.createDataFrame([("x", 10), ("x", 11), (None, 12)], "key string, w int")
    assert bag(lookup(base, table, "k", "key")) == Counter(
        [("x", 1, 10), ("x", 1, 11), ("y", 2, None), (None, 3, None)])
    assert bag(lookup(base, table, "k", "key", match_nulls=True)) == Counter(
        [("x", 1, 10), ("x", 1, 11), ("y", 2, None), (None, 3, 12)])


def test_lookup_suffix_on_name_clash(spark):
    base = spark.createDataFrame([("x", 1)], "k string, v int")
    table = spark.createDataFrame([("x", 10)], "key string, v int")
    assert lookup(base, table, "k", "key", "_phys").columns == ["k", "v", "v_phys"]


def test_lookup_in_an_empty_table_gives_nulls(spark):
    base = spark.createDataFrame([("x", 1)], "k string, v int")
    assert lookup(base, spark.createDataFrame([], "key string, w double"), "k", "key") \
        .first()[:] == ("x", 1, None)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salting_does_not_change_a_join(spark, how, null_safe):
    # a third of the rows are copies of one row, a third have a null key
    left = spark.createDataFrame([("hot", 7)] * 50 + [(None, i) for i in range(50)]
                                 + [(f"k{i % 20}", i) for i in range(50)], "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)]
                                  + [(f"k{i}", i) for i in range(0, 20, 2)], "k string, w int")
    plain = left.alias("l").join(
        right.alias("r"),
        F.col("l.k").eqNullSafe(F.col("r.k")) if null_safe else F.col("l.k") == F.col("r.k"), how)
    plain = plain.select("l.*") if how in ("left_semi", "left_anti") else plain.select(
        "l.*", "r.w")
    salted = salted_join(left.repartition(5), right, ["k"], how, null_safe, rows_per_salt=10)
    assert bag(salted) == bag(plain)


def test_hot_rows_are_dealt_over_salts(spark):
    left = spark.createDataFrame([("hot", 7)] * 64, "k string, v int").repartition(16)
    right = spark.createDataFrame([("hot", 1)], "k string, w int")
    joined = salted_join(left, right, ["k"], rows_per_salt=8)
    assert joined.count() == 64
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n_left, n_right", [(1000, 1), (1, 1000), (100, 100), (400, 3), (7, 1000)])
def test_grid_cells_and_copies_are_bounded(spark, n_left, n_right):
    sized = spark.createDataFrame([("hot", n_left, n_right), ("cold", 3, 3)],
                                  "k string, _left bigint, _right bigint")
    (hot,) = grid_for(sized, ["k"], 10).collect()
    cells = math.ceil(n_left * n_right / 10)
    a, b = hot["_left_parts"], hot["_right_parts"]
    assert cells <= a * b <= 2 * cells + 2 and a <= n_left and b <= n_right
    root = math.ceil(math.sqrt(cells))
    assert b <= root or n_left * b <= cells + n_left     # copies of a left row
    assert a <= root or n_right * a <= cells + n_right   # copies of a right row


def test_grid_join_equals_a_plain_join(spark):
    left = spark.createDataFrame([("hot", i % 40) for i in range(120)] + [(None, 1), ("a", 1), ("b", 2)],
                                 "k string, v int").repartition(6)
    right = spark.createDataFrame([("hot", i % 30) for i in range(90)] + [(None, 1), ("a", 5), ("c", 2)],
                                  "k string, w int").repartition(5)
    sized = spark.createDataFrame([("hot", 120, 90)], "k string, _left bigint, _right bigint")
    plain = left.join(right, "k").select("k", "v", "w")
    for pairs in (10, 200, 5000, 1_000_000):
        assert bag(grid_join(left, right, ["k"], grid_for(sized, ["k"], pairs))) == bag(plain)


def test_small_sides_with_many_pairs_keep_several_tasks(spark, tmp_path):
    """2,000 orders and 3,000 records are few bytes but 6 million pairs."""
    folder = orders_and_records(spark, tmp_path, 2000, 3000)
    for name in ("lookback_match", "match_union"):
        shares = QUERIES[name](spark, folder).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
        assert sum(r["n"] for r in shares) == 6_000_000
        assert max(r["n"] for r in shares) <= 4_500_000


def test_sketch_finds_every_hot_key(spark):
    # 1,500 keys of 20 rows each, more than a plain limit took, among 20,000 keys of one row
    rows = spark.range(1500 * 20).select((F.col("id") % 1500).alias("k"), F.lit("x").alias("s")).unionByName(
        spark.range(10_000, 30_000).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("s")))
    hot = hot_keys(rows.repartition(8), ["k", "s"], 15)
    assert {tuple(r) for r in hot.collect()} == {(k, "x", 2) for k in range(1500)}
    assert hot_keys(rows.limit(0), ["k", "s"], 15).count() == 0


def test_rank_by_digest_is_a_full_ranking(spark):
    keys = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    for digits in (1, 2):
        ranked = rank_by_digest(keys, "k", 42, "c", digits).collect()
        for c in range(3):
            rows = sorted((r["digest"], r["rank"]) for r in ranked if r["c"] == c)
            assert [rank for _, rank in rows] == list(range(1, len(rows) + 1))


CROPS = [("S", 1990, "CORN", "a", 1), ("S", 1990, "WHEAT", "b", 2), ("S", 1979, "CORN", "c", 3),
         ("S", 2005, "WHEAT", "d", 4)]


@pytest.mark.parametrize("state, year, expected", [
    ("S", 2000, ["a", "b"]),      # exactly ten years back counts
    ("S", 2001, ["a"]),           # one fallback row, first on a tie
    ("S", 1989, ["c"]),
    ("S", 1990, ["a", "b"]),      # the same year counts
    ("S", 1978, []),
    (None, 2000, []),
    ("S", None, []),
    ("S", 2010, ["d"]),
    ("T", 2000, []),
])
def test_match_fixture(spark, state, year, expected):
    crops = spark.createDataFrame(
        CROPS, "state_name string, year int, commodity_desc string, unit_desc string, ordinal int")
    samples = spark.createDataFrame([("p", state, year, "old")],
                                    "id string, state_name string, sample_year int, "
                                    "commodity_desc string")
    matched = match_crops(samples, crops, ["ordinal"])
    assert sorted(r["crop_unit_desc"] for r in matched.collect()) == expected
    assert matched.columns.count("commodity_desc") == 1
    assert all(r["commodity_desc"] != "old" for r in matched.collect())


@pytest.mark.parametrize("rows_per_salt", [5, 1_000_000])
def test_match_equals_nested_loops(spark, rows_per_salt):
    rng = random.Random(1)
    states = ["A"] * 5 + ["B", "C", None]      # one state holds most rows
    samples = [(i, rng.choice(states), rng.choice([None, *range(1980, 2000)])) for i in range(150)]
    crops = [(rng.choice(states[:-1]), rng.choice([1975, 1976, 1984, 1993]), i)
             for i in range(60)]
    expected = Counter()
    for sid, state, year in samples:
        prior = [c for c in crops if state and year and c[0] == state and c[1] <= year]
        window = [c for c in prior if c[1] >= year - 3]
        for c in window or sorted(prior, key=lambda c: (-c[1], c[2]))[:1]:
            expected[sid, c[2]] += 1
    matched = match_crops(
        spark.createDataFrame(samples, "id int, state_name string, sample_year int"),
        spark.createDataFrame(crops, "state_name string, year int, ordinal int"),
        ["ordinal"], lookback=3, rows_per_salt=rows_per_salt)
    assert Counter((r["id"], r["ordinal"]) for r in matched.collect()) == expected


def test_counted_matches_equal_the_expanded_ones(spark):
    rng = random.Random(2)
    samples = spark.createDataFrame(
        [(i % 90, rng.choice(["A", "B", None]), rng.choice([None, *range(1980, 2000)]), "old") for i in range(150)],
        "id int, state_name string, sample_year int, commodity_desc string")
    crops = spark.createDataFrame(
        [(rng.choice("AB"), rng.choice([1975, 1976, 1984, 1993]), rng.choice(["x", "y", None]), i) for i in range(60)],
        "state_name string, year int, commodity_desc string, ordinal int")
    rows = match_crops(samples, crops, ["ordinal"], lookback=3).collect()
    for per in (["id", "is_fallback"], ["commodity_desc", "crop_year"], ["state_name", "ordinal", "id"]):
        counted = match_crops(samples, crops, ["ordinal"], lookback=3, per=per)
        assert counted.columns == [*per, "n_pairs"]
        assert Counter({tuple(r)[:-1]: r["n_pairs"] for r in counted.collect()}) == Counter(
            tuple(r[c] for c in per) for r in rows)


def orders_and_records(spark, folder, n_orders, n_records):
    """Tables of one state in which all orders (2000) meet all records (1999)."""
    tables = {
        "nation": spark.sql("SELECT 1 AS n_nationkey, 'PERU' AS n_name, 1 AS n_regionkey"),
        "customer": spark.sql("SELECT 1L AS c_custkey, 1 AS c_nationkey, 1D AS c_acctbal"),
        "supplier": spark.sql("SELECT 1L AS s_suppkey, 1 AS s_nationkey, 1D AS s_acctbal"),
        "part": spark.sql("SELECT 1L AS p_partkey, 'PROMO' AS p_type, 'b' AS p_brand"),
        "orders": spark.range(n_orders).selectExpr(
            "id AS o_orderkey", "1L AS o_custkey", "timestamp'2000-05-05' AS o_orderdate"),
        "lineitem": spark.range(n_records).selectExpr(
            "id AS l_orderkey", "1L AS l_partkey", "1L AS l_suppkey", "1 AS l_linenumber",
            "5000D + 10 * (id % 3) AS l_extendedprice", "0.05D AS l_discount", "0.01D AS l_tax", "'R' AS l_returnflag",
            "'O' AS l_linestatus", "timestamp'1999-05-05' AS l_shipdate"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pairs_are_counted_not_formed(spark, tmp_path):
    folder = orders_and_records(spark, tmp_path, 200_000, 300_000)
    assert [tuple(r) for r in QUERIES["match_override"](spark, folder).collect()] == [
        ("PROMO", False, 6 * 10 ** 10)]
    assert [tuple(r) for r in QUERIES["state_yield_profile"](spark, folder).collect()] == [("PERU", 501.0)]
    assert tuple(QUERIES["match_counts"](spark, folder).first()) == (200_000, 0, 200_000, 0)


def test_matching_reads_records_of_all_amounts(spark, tmp_path):
    """A record of 500 units counts, so the order five years later falls back to it."""
    folder = orders_and_records(spark, tmp_path, 0, 2)
    spark.sql("SELECT 7L AS o_orderkey, 1L AS o_custkey, timestamp'2004-05-05' AS o_orderdate").write.mode(
        "overwrite").parquet(f"{folder}/orders.parquet")
    assert [(r["sample_year"], r["year"], r["yield_value"], r["l_orderkey"])
            for r in QUERIES["closest_prior"](spark, folder).collect()] == [(2004, 1999, 500.0, 0)]
    assert tuple(QUERIES["match_counts"](spark, folder).first()) == (1, 0, 1, 1)


def test_measurements_are_finished_before_they_meet_records(spark, sf_dir):
    """Once per sample: the planned result rounds nothing."""
    plan = QUERIES["matched_training_table"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan
