"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

__all__ = ["by_value", "drop_clashing", "materialize", "text_key", "text_or_empty"]


def by_value(module: str) -> None:
    """Ship the functions of ``module`` inside the job, so that executors need not import it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def drop_clashing(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without input columns that are named like an output column, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def text_or_empty(name: str = "text") -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def text_key(name: str = "text") -> Column:
    """A key that two rows share only if their texts are equal; null counts as empty."""
    return F.sha2(text_or_empty(name), 256)
