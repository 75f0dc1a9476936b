"""Set operations over source branches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame, fill: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), dfs)


def union_distinct(*dfs: DataFrame, fill: bool = False) -> DataFrame:
    """UNION: exact duplicates across and within branches collapse."""
    return union_all(*dfs, fill=fill).distinct()


def union_as_text(dfs: Sequence[DataFrame], cols: Sequence[Sequence[str]], names: Sequence[str]):
    """Stack branches with different columns as text under generic names."""
    branches = [
        df.select(*[F.col(c).cast("string").alias(n) for c, n in zip(picked, names)])
        for df, picked in zip(dfs, cols)
    ]
    return union_distinct(*branches)
