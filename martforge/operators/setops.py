"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def rewrite_where(df: DataFrame, pred: Column, rewrite) -> DataFrame:
    """Apply ``rewrite`` to the rows matching ``pred`` and re-attach the rest."""
    return union(rewrite(df.where(pred)), df.where(~pred | pred.isNull()))


def id_minus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids of ``a`` not in ``b``."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def id_union(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct union of ids."""
    return a.select(key).unionByName(b.select(key)).where(F.col(key).isNotNull()).distinct()
