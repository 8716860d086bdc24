"""Scoring streams. Fitted models other than nearest neighbours are stateless projections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..models.base import Model
from ..models.knn import KNNModel


def score_stream(model: Model, stream: DataFrame) -> DataFrame:
    """Add ``prediction`` to a streaming table."""
    if isinstance(model, KNNModel):
        raise ValueError("nearest neighbours rank against the whole training table; score batches")
    return model.transform(stream)
