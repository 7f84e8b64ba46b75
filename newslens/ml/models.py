"""Pretrained models as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Called once per Python worker; returns a function from a batch to its results.
LoadModel = Callable[[], Callable[[pd.DataFrame], pd.Series]]


def model_column(load: LoadModel, returns: T.DataType | str, **inputs: Column) -> Column:
    """Apply a model to a struct of named inputs, in Arrow batches.

    The model is loaded when a worker starts its first batch, not per row or per
    batch, and is given whole batches.
    """

    @F.pandas_udf(returns)
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield model(batch)

    return predict(F.struct(*[value.alias(name) for name, value in inputs.items()]))
