"""One row per key: first by a total order, or latest by a sequence."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per key; all other columns break ties, so the result is repeatable.

    Spark turns the ``row_number() = 1`` filter into a group limit that runs before the
    shuffle too, so a key with very many copies leaves at most one row per map task.
    """
    order = list(order_by or [])
    order += [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order or keys])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def completeness(cols: Iterable[str], missing: str = "na") -> Column:
    """How many of the columns hold a value other than NULL and ``missing``."""
    points = [F.coalesce((F.col(c) != missing).cast("int"), F.lit(0)) for c in cols]
    return sum(points[1:], points[0])


def latest_by_key(
    df: DataFrame, keys: Sequence[str], sequence: Sequence[str], hide: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the highest ``sequence`` per key; remaining columns break ties.

    A plain ``max`` over a struct: it is combined on the map side, so hot keys shrink to
    one row per task before the shuffle, and the result does not depend on arrival order.
    """
    rest = [c for c in df.columns if c not in keys and c not in sequence]
    ranked = F.struct(*[F.col(f"`{c}`") for c in [*sequence, *rest]])
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    shown = [c for c in df.columns if c not in hide]
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`").alias(c) for c in shown])
