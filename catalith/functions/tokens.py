"""Tokenizers that a Python worker loads once and keeps for all batches it sees."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def counted(load: Callable[[], Callable[[str], int]]) -> Callable[[Column], Column]:
    """A column function for the number of tokens of a text, 0 of a null one. load makes the tokenizer, in the worker, once for each task's
    batches; texts come in Arrow batches."""

    @F.pandas_udf("int")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = load()
        for texts in parts:
            yield pd.Series([0 if t is None else tokens(t) for t in texts], dtype="int32")

    return count
