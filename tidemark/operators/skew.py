"""Left join that stays even when a few keys hold much of the left side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1_000          # at most this many keys are treated as hot
HOT_ROWS = 100            # fewer rows of a key in one group of tasks never make it hot
TRACKED_KEYS = 4_000      # counters of one frequency sketch
SKETCH_GROUPS = 512       # sketches are merged in this many groups of tasks


def _hash(names: Sequence[str]):
    return F.xxhash64(*[F.col(f"`{n}`") for n in names])


def hot_hashes(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of the heaviest keys, HOT_KEYS of them at most.

    Runs one job over the key columns: a fixed-size frequency sketch per group of tasks, no
    shuffle of the keys. A key counts if it holds 1/HOT_KEYS of a group. The list only picks
    the route a row takes; a key missing from it, or on it without need, costs time but does
    not change a result. It is fetched once, so that every use sees the same list.
    """
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])    # NULL keys never join
    tops = (
        df.filter(known).select(_hash(keys).alias("_k"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g"))
        .groupBy("_g")
        .agg(F.expr(f"approx_top_k(_k, {HOT_KEYS}, {TRACKED_KEYS})").alias("_top"), F.count(F.lit(1)).alias("_n"))
    )
    rows = F.col("_t.count")
    heavy = tops.select(F.explode("_top").alias("_t"), "_n").filter(
        (rows >= HOT_ROWS) & (rows * HOT_KEYS >= F.col("_n"))
    )
    totals = heavy.groupBy(F.col("_t.item").alias("_hot")).agg(F.sum(rows).alias("_rows"))
    return [r["_hot"] for r in totals.orderBy(F.desc("_rows"), "_hot").limit(HOT_KEYS).collect()]


def left_join_unique(
    left: DataFrame, right: DataFrame, keys: Sequence[str], sketch_of: DataFrame | None = None
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` for a right side with one row per key.

    Rows with a hot key are answered from a broadcast of at most HOT_KEYS right rows. They, and
    rows with a NULL key, are spread over the join's partitions under a salt that cannot match.
    All others take a sort-merge join: the right side has a row per key, and the size that Spark
    guesses from compressed files would have it sent whole through the driver. ``sketch_of`` may name a cheaper frame with the same
    keys (for example the stored table behind ``left``) to look for hot keys in.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    hot = hot_hashes(sketch_of if sketch_of is not None else left, keys)
    packed = right.select(
        *[F.col(f"`{k}`").alias(f"_r_{k}") for k in keys],
        F.struct(*[F.col(f"`{c}`") for c in payload]).alias("_row"),
    )

    lonely = F.lit(False)       # cannot match in the ordinary join
    for k in keys:
        lonely = lonely | F.col(f"`{k}`").isNull()
    flagged, row = left, F.col("_row")
    if hot:
        flagged = _answer_hot(left, packed, keys, hot)
        lonely = lonely | F.col("_hot").isNotNull()
        row = F.coalesce(F.col("_hot_row"), row)

    plain = [f.name for f in left.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.spark_partition_id())
    flagged = flagged.withColumns(
        {
            "_salt": F.when(lonely, spread).otherwise(F.lit(0)),
            # a key travels once: as one to join on, or beside it
            **{f"_j_{k}": F.when(~lonely, F.col(f"`{k}`")) for k in keys},
            **{f"_own_{k}": F.when(lonely, F.col(f"`{k}`")) for k in keys},
        }
    )
    on = F.col("_salt") == F.col("_zero")
    for k in keys:
        on = on & (F.col(f"`_j_{k}`") == F.col(f"`_r_{k}`"))
    joined = flagged.join(packed.withColumn("_zero", F.lit(0).cast("bigint")).hint("merge"), on, "left")
    return joined.select(
        *[F.coalesce(f"`_j_{c}`", f"`_own_{c}`").alias(c) if c in keys else F.col(f"`{c}`") for c in left.columns],
        *[row.getField(c).alias(c) for c in payload],
    )


def _answer_hot(left: DataFrame, packed: DataFrame, keys: list[str], hot: list[int]) -> DataFrame:
    """Add ``_hot`` (set for hot keys) and ``_hot_row`` (their right row, NULL if there is none)."""
    listed = left.sparkSession.createDataFrame([(h,) for h in hot], "_hot bigint")
    packed_hash = F.xxhash64(*[F.col(f"`_r_{k}`") for k in keys])
    found = packed.withColumn("_rh", packed_hash).join(
        F.broadcast(listed), F.col("_rh") == F.col("_hot"), "left_semi"
    )
    table = listed.join(F.broadcast(found), F.col("_hot") == F.col("_rh"), "left").select(
        "_hot",
        F.col("_row").alias("_hot_row"),
        *[F.col(f"`_r_{k}`").alias(f"_h_{k}") for k in keys],
    )
    equal = F.lit(True)
    for k in keys:
        equal = equal & (F.col(f"`_h_{k}`") == F.col(f"`{k}`"))
    return left.withColumn("_lh", _hash(keys)).join(
        F.broadcast(table), (F.col("_lh") == F.col("_hot")) & (F.col("_hot_row").isNull() | equal), "left"
    )


def count_per_key(df: DataFrame, keys: Sequence[str], name: str, sketch_of: DataFrame | None = None) -> DataFrame:
    """Add the number of rows that share the key, NULL keys counted as one group.

    The same values as ``count(*) OVER (PARTITION BY key)``, but counted with map-side
    partial aggregation and joined back, so no task ever holds a whole hot group.
    """
    marks = {f"_null_{k}": F.col(f"`{k}`").isNull() for k in keys}
    # a NULL key never equals itself in a join: carry it as (is-null flag, default value)
    safe = {f"_key_{k}": F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys}
    def coded(frame: DataFrame) -> DataFrame:
        return frame.withColumns({**marks, **safe})
    names = [*marks, *safe]
    counts = coded(df.select(*keys)).groupBy(*names).agg(F.count(F.lit(1)).alias(name))
    sketch = coded((sketch_of if sketch_of is not None else df).select(*keys))
    return left_join_unique(coded(df), counts, names, sketch).drop(*names)
