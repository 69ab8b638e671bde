"""The whole job on the smallest tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loamlens.operators.forest import (
    ForestParams, best_candidate, fit_model, search_grid)
from loamlens.operators.split import group_holdout, with_folds
from loamlens.operators.stored import load_model, save_model
from loamlens.plans import job
from loamlens.queries.modelling import RECORD_ORDER, raw_tables
from loamlens.schemas import FeatureSpec
from loamlens.session import checkpoint_dir, durable, temporary_tables

SPEC = FeatureSpec(numeric=("a", "b"), categorical=("g", "state_name"), target="y", group="sample",
                   impute_group="state_name")


@pytest.fixture(scope="module")
def signal(spark):
    """A target that follows a number and a category, with gaps in the features."""
    rows = spark.range(600).select(
        F.col("id").alias("row_id"), (F.col("id") % 60).alias("sample"),
        F.when(F.col("id") % 11 != 0, F.rand(1) * 10).alias("a"), (F.rand(2) * 10).alias("b"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("g"),
        F.concat(F.lit("S"), (F.col("id") % 4).cast("string")).alias("state_name"))
    target = (F.coalesce("a", F.lit(5.0)) * 3
              + F.when(F.col("g") == "even", 20).otherwise(0)).alias("y")
    return durable(rows.select("*", target))


def add_missing_features(df):
    """The derived features need their inputs; here they are constants."""
    return df.withColumns({c: F.lit(1.0) for c in (
        "ph_h2o", "cec_nh4_ph_7", "clay_total", "avg_temperature", "ca_nh4_ph_7", "mg_nh4_ph_7",
        "growing_degree_days")})


def test_forest_finds_the_signal_and_repeats(spark, signal):
    rows = add_missing_features(group_holdout(signal, "sample"))
    train, holdout = rows.where("NOT is_holdout"), rows.where("is_holdout")
    predictions = []
    for _ in range(2):
        model = fit_model(train, SPEC, ForestParams(8, 6, 2))
        predicted = model.transform(holdout)
        predictions.append({r["row_id"]: r["prediction"] for r in predicted.collect()})
        assert predicted.agg(F.corr("y", "prediction")).first()[0] > 0.9
    assert predictions[0] == predictions[1]


def test_search_scores_every_candidate_and_predicts_every_row(spark, signal):
    rows = with_folds(add_missing_features(signal), "sample", 3)
    grid = [ForestParams(2, 1, 1), ForestParams(5, 5, 1)]
    search = search_grid(rows, SPEC, grid, range(3))
    assert search.scores.count() == 6
    assert best_candidate(search.scores).first()["candidate"] == 1
    predicted = search.out_of_fold(1)
    assert predicted.count() == predicted.select("row_id").distinct().count() == 600


def test_stored_model_predicts_the_same(spark, signal, tmp_path):
    rows = add_missing_features(signal)
    with temporary_tables(spark):
        model = fit_model(rows, SPEC, ForestParams(4, 4, 2))
        wanted = {r["row_id"]: r["prediction"] for r in model.transform(rows).collect()}
        save_model(model, str(tmp_path / "model"))
    predicted = load_model(spark.newSession(), str(tmp_path / "model")).transform(rows)
    assert {r["row_id"]: r["prediction"] for r in predicted.collect()} == wanted


def test_job_writes_every_result(spark, sf_dir, tmp_path):
    result = job.run(raw_tables(spark, sf_dir), str(tmp_path), grid=[ForestParams(3, 3, 2)],
                     record_order=RECORD_ORDER)
    assert not list(Path(checkpoint_dir(spark).removeprefix("file:")).glob("loamlens-job-*"))
    assert result.model.transform(spark.read.parquet(f"{tmp_path}/training_data_processed")).count()
    stored = spark.read.parquet(f"{tmp_path}/training_data_processed")
    as_csv = spark.read.option("header", True).csv(f"{tmp_path}/training_data_processed_csv")
    assert stored.count() == as_csv.count() > 0
    assert "row_id" not in as_csv.columns and "crop_year" in as_csv.columns
    folds = spark.read.parquet(f"{tmp_path}/folds")
    assert sorted(r["fold"] for r in folds.collect()) == [0, 1, 2, 3, 4]
    report = result.diagnostics
    n_local = report.local_variance.count() + report.holdout_local_variance.count()
    assert n_local == stored.count()
    assert result.holdout_predictions.select("pedlabsampnum").intersect(
        spark.read.parquet(f"{tmp_path}/training_data_processed").join(
            result.holdout_predictions.select("row_id"), "row_id", "left_anti")
        .select("pedlabsampnum")).isEmpty()
    for name in job.report_tables(result):
        assert spark.read.parquet(f"{tmp_path}/{name}").columns
