"""Fitted pipelines saved to and loaded from the shared folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> str:
    """Overwriting save (a plain ``save`` fails when the path exists)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
