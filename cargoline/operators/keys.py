"""Guards on the keys of the lookup side of a join."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(dim: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``dim`` by ``key``, raising where a key has several rows (a join would double the facts).

    NULL keys match nothing and are dropped.  The grouping shuffles on the key, which is
    the key of the join that follows.
    """
    columns = [c for c in columns or dim.columns if c != key]
    grouped = dim.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in columns])
    guard = F.when(F.col("_rows") > 1, F.raise_error(F.concat(
        F.lit(f"one-to-one join violated: {key} "), F.col(key).cast("string"), F.lit(" has several rows"))))
    return grouped.filter(guard.isNull()).select(key, *columns)
