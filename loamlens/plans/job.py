"""The batch job: read, match, store, train, diagnose, store the results."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession

from loamlens.operators.forest import ForestParams
from loamlens.operators.stored import load_model, save_model
from loamlens.plans.dataset import RawTables, numbered, training_table
from loamlens.plans.diagnostics import DiagnosticReport
from loamlens.plans.training import TrainingResult, train_with_grid_search
from loamlens.schemas import (
    CHEMICAL_SCHEMA, COMMODITIES, CROP_SCHEMA, MAX_LOOKBACK_YEARS, PHYSICAL_SCHEMA,
    VERTEX_SCHEMA, WEATHER_SCHEMA, FeatureSpec)
from loamlens.session import temporary_tables
from loamlens.sources.readers import read_table, require_rows
from loamlens.sources.sinks import write_csv, write_table

# Stands for the input order of yield records where "the first one" matters.
RECORD_ORDER = ("commodity_desc", "county_name", "unit_desc", "yield_value")


def read_inputs(spark: SparkSession, folder: str, fmt: str = "parquet") -> RawTables:
    def table(name, schema, **options):
        return read_table(spark, f"{folder}/{name}", schema, fmt, **options)

    return RawTables(
        samples=table("weather_soil_samples", WEATHER_SCHEMA),
        chemical=table("ssurgo_lab_chemical_properties", CHEMICAL_SCHEMA),
        physical=table("ssurgo_lab_physical_properties", PHYSICAL_SCHEMA),
        crops=table("nass_crops", CROP_SCHEMA, as_is=("year",)),
        vertices=table("state_polygons", VERTEX_SCHEMA),
    )


def run(tables: RawTables, output: str, spec: FeatureSpec = FeatureSpec(),
        grid: Sequence[ForestParams] | None = None, csv: bool = True,
        record_order: Sequence[str] = RECORD_ORDER, commodities: Sequence[str] = COMMODITIES,
        lookback: int = MAX_LOOKBACK_YEARS, **training) -> TrainingResult:
    """Run everything and write one folder per result below ``output``.

    The result reads what is written there; intermediate tables are gone when this returns.
    """
    spark = tables.samples.sparkSession
    with temporary_tables(spark):
        matched = numbered(training_table(tables, record_order, commodities, lookback, copy="_copy"), copy="_copy")
        matched = require_rows(
            write_table(matched, f"{output}/training_data_processed"), "matched records")
        if csv:
            write_csv(matched.drop("row_id"), f"{output}/training_data_processed_csv")
        result = train_with_grid_search(matched, spec, grid, **training)
        stored = {name: write_table(df, f"{output}/{name}")
                  for name, df in report_tables(result).items()}
        save_model(result.model, f"{output}/model")
    report = result.diagnostics and DiagnosticReport(
        **{f.name: stored[f.name] for f in fields(DiagnosticReport)})
    return replace(result, model=load_model(spark, f"{output}/model"), diagnostics=report,
                   **{field: stored[name] for name, field in RESULT_TABLES.items()})


#: names of stored tables, and the fields of a result they come from
RESULT_TABLES = {"cv_scores": "scores", "best_params": "best",
                 "holdout_predictions": "holdout_predictions", "holdout_metrics": "holdout_metrics"}


def report_tables(result: TrainingResult) -> dict[str, DataFrame]:
    tables = {name: getattr(result, field) for name, field in RESULT_TABLES.items()}
    if result.diagnostics is not None:
        tables.update(vars(result.diagnostics))
    return tables


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", help="folder with the five input tables")
    parser.add_argument("output", help="folder for the results")
    parser.add_argument("--format", default="parquet", help="Spark source format of the input")
    parser.add_argument("--no-csv", action="store_true")
    arguments = parser.parse_args(argv)
    spark = SparkSession.builder.appName("loamlens").getOrCreate()
    run(read_inputs(spark, arguments.input, arguments.format), arguments.output,
        csv=not arguments.no_csv)


if __name__ == "__main__":
    main()
