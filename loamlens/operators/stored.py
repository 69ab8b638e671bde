"""A fitted model as a folder: statistics as tables, settings as JSON, Spark's own stages as they are."""

from __future__ import annotations

import json

from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from loamlens.operators.encode import DerivedFeatures, NumericScalerModel
from loamlens.operators.forest import ForestModel, ForestParams
from loamlens.operators.impute import GroupwiseImputerModel
from loamlens.operators.trees import Target


def save_model(model: PipelineModel, folder: str) -> None:
    """Write a model made by ``fit_model``, replacing what is there."""
    imputer, _, encoder, forest = model.stages
    scaler, *encoding = encoder.stages
    PipelineModel(stages=encoding).write().overwrite().save(f"{folder}/stages")
    forest.forest.write.mode("overwrite").parquet(f"{folder}/forest")
    spark = SparkSession.active()
    if imputer.stats is not None:
        imputer.stats.write.mode("overwrite").parquet(f"{folder}/groups")
    settings = {"imputer": {k: getattr(imputer, k) for k in (
        "group_col", "numeric_cols", "categorical_cols", "defaults", "n_groups")},
        "scaler": {"fitted": scaler.fitted, "suffix": scaler.suffix},
        "forest": {"params": asdict(forest.size), "target": asdict(forest.target),
                   "bins": [b.tolist() for b in forest.bins]}}
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{folder}/settings")


def load_model(spark: SparkSession, folder: str) -> PipelineModel:
    """The model of ``save_model``, in any session."""
    settings = json.loads(spark.read.text(f"{folder}/settings").first()["value"])
    kept = settings["imputer"]
    filled = kept["numeric_cols"] or kept["categorical_cols"]
    imputer = GroupwiseImputerModel(
        stats=spark.read.parquet(f"{folder}/groups") if filled else None, **kept)
    scaler = NumericScalerModel({c: tuple(v) for c, v in settings["scaler"]["fitted"].items()},
                                settings["scaler"]["suffix"])
    encoding, grown = PipelineModel.load(f"{folder}/stages").stages, settings["forest"]
    forest = ForestModel(spark.read.parquet(f"{folder}/forest"), grown["bins"], Target(**grown["target"]),
                         ForestParams(**grown["params"]))
    return PipelineModel(stages=[imputer, DerivedFeatures(),
                                 PipelineModel(stages=[scaler, *encoding]), forest])
