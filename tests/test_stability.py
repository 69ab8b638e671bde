"""Results don't depend on how the rows lie."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import Window, functions as F

from loamlens.operators.order_stats import quantiles
from loamlens.plans.dataset import numbered


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(i % 500, (i * 7919 % 13) / 10, "x") for i in range(2000)], "a bigint, b double, c string")


@pytest.mark.parametrize("parts", [2, 7, 16])
def test_row_ids_follow_from_content(rows, parts):
    ids = lambda df: sorted((r.row_id, r.a, r.b) for r in numbered(df).collect())
    want = ids(rows)
    assert len({i for i, _, _ in want}) == 2000
    assert ids(rows.repartition(parts)) == want


@pytest.mark.parametrize("ends", [[math.inf], [-math.inf], [math.inf, -math.inf], [1.7e308, -1.7e308]])
def test_narrowing_ends_on_extreme_values(spark, ends):
    values = [float(i) for i in range(1000)] + ends
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for fraction in (0.5, 0.9):
        want = df.agg(F.percentile("v", F.lit(fraction))).first()[0]
        assert quantiles(df, ["v"], fraction, buffered=10).first()["v"] == pytest.approx(want)


def test_copies_are_numbered_without_meeting_in_a_task(spark, monkeypatch):
    from loamlens.plans import dataset

    monkeypatch.setattr(dataset, "COPIES", 7)
    rows = [("a", 1.5)] * 50 + [("b", None)] * 7 + [("c", 2.0), (None, None)]
    df = spark.createDataFrame(rows, "x string, y double")
    ids = dataset.numbered(df)
    # as by a window over equal rows
    copies = Window.partitionBy("x", "y").orderBy("x")
    ranked = df.withColumn("n", F.row_number().over(copies)).select(
        "x", "y", F.xxhash64(F.xxhash64("x", "y"), "n").alias("row_id"))
    key = lambda frame: sorted(map(tuple, frame.collect()), key=repr)
    assert ids.columns == ["x", "y", "row_id"] and key(ids) == key(ranked)
    assert "Window" not in ids._jdf.queryExecution().toString()


def test_pairs_are_numbered_by_their_sides(spark, sf_dir):
    """The same ids as by comparing whole rows, and no pair moves for them."""
    from loamlens.plans.dataset import training_table
    from loamlens.queries.modelling import RECORD_ORDER, raw_tables

    tables = raw_tables(spark, sf_dir)
    # repeated samples and records make equal pairs
    twice = lambda df, n: df.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_again")
    tables = replace(tables, samples=twice(tables.samples, 2), crops=twice(tables.crops, 3))
    wanted = numbered(training_table(tables, RECORD_ORDER))
    found = numbered(training_table(tables, RECORD_ORDER, copy="_copy"), copy="_copy")
    assert found.columns == wanted.columns and found.count() == wanted.count() == found.select("row_id").distinct().count()
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and plan.index("Join") < plan.index("Aggregate")
