"""Saving and loading of fitted models on any storage Spark reaches.

A folder holds ``kind`` and the small fields as one JSON row (parquet), and beside it what is large: pipeline stages or
similarity tables. Numbers survive exactly, so a loaded model scores as the saved one did.
"""

from __future__ import annotations

import json
from dataclasses import fields
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from cartwright.operators.predictive.churn import ChurnModel
from cartwright.operators.predictive.clv import Fit
from cartwright.operators.predictive.cox import CoxModel
from cartwright.operators.predictive.recommend import Similarity
from cartwright.operators.predictive.weibull import WeibullModel

# What each model keeps beside its small fields.
_STAGES = {ChurnModel: ("pipeline",)}
_TABLES = {Similarity: ("light", "heavy", "cells")}
_KINDS = {m.__name__: m for m in (ChurnModel, CoxModel, Fit, Similarity, WeibullModel)}


def _plain(value: Any) -> Any:
    """Arrays as {"array": list} and numpy numbers as Python's, for JSON; its text of a double is exact."""
    if isinstance(value, np.ndarray):
        return {"array": value.tolist()}
    if isinstance(value, np.generic):
        return value.item()
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def _restored(value: Any) -> Any:
    return np.array(value["array"], float) if isinstance(value, dict) and set(value) == {"array"} else value


def save_model(spark: SparkSession, model: Any, path: str) -> None:
    """Write a model of this package to ``path``, in place of what is there."""
    kind = type(model)
    if _KINDS.get(kind.__name__) is not kind:
        raise TypeError(f"no way to save a {kind.__name__}")
    stages, tables = _STAGES.get(kind, ()), _TABLES.get(kind, ())
    small = {f.name: _plain(getattr(model, f.name)) for f in fields(model) if f.name not in stages + tables}
    small["_tables"] = list(tables)
    missing = [name for name in tables if getattr(model, name) is None]
    for name in stages:
        getattr(model, name).write().overwrite().save(f"{path}/{name}")
    for name in tables:
        if name not in missing:
            getattr(model, name).write.mode("overwrite").parquet(f"{path}/{name}")
    row = (kind.__name__, json.dumps(small), json.dumps(missing))
    # Written last: a folder without this row is no model.
    spark.createDataFrame([row], "kind string, small string, missing string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str, kind: type | None = None) -> Any:
    """The model saved under ``path``; with ``kind``, any other one is refused."""
    row = spark.read.parquet(f"{path}/model").first()
    found = _KINDS[row["kind"]]
    if kind is not None and found is not kind:
        raise TypeError(f"{path} holds a {row['kind']}, not a {kind.__name__}")
    values = {name: _restored(v) for name, v in json.loads(row["small"]).items()}
    if found is CoxModel:
        values["baseline"] = [tuple(step) for step in values["baseline"]]
    values |= {name: PipelineModel.load(f"{path}/{name}") for name in _STAGES.get(found, ())}
    missing = json.loads(row["missing"])
    written = values.pop("_tables", ["light", "heavy"])  # folders without the list are older than the table of cells
    for name in _TABLES.get(found, ()):
        values[name] = None if name in missing or name not in written else spark.read.parquet(f"{path}/{name}")
    return found(**values)
