"""Choosing one row of each group by a composite order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def arg_max(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, which should end in a unique column so that ties are settled.

    Spark cuts each task's rows to ``k`` per group before the shuffle (the window group limit), so only the best of each
    task travel.
    """
    name = rank or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank else out.drop(name)
