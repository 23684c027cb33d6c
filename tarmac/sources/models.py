"""Saved classifiers, one folder per track and model."""

from __future__ import annotations

from pyspark.ml import PipelineModel

from tarmac import schema


def model_path(folder: str, track: str, name: str) -> str:
    if track not in schema.TRACKS:
        raise ValueError(f"unknown track {track!r}")
    return f"{folder}/track{track}_{name}"


def save_model(model: PipelineModel, folder: str, track: str, name: str) -> str:
    path = model_path(folder, track, name)
    model.write().overwrite().save(path)
    return path


def load_model(folder: str, track: str, name: str) -> PipelineModel:
    return PipelineModel.load(model_path(folder, track, name))
