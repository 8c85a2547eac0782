"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Source i has size s_i, weight w_i and the ceiling c_i = epochs * s_i. Its target is
min(c_i, level * w_i); the level is the one at which all targets add up to the wanted
total. Sorted by c_i / w_i, the full sources come first, so two running sums over the
sources give the level: (total - ceilings before) / (weights from here on).

A source then repeats each document floor(target / s_i) times, and takes a fraction of
its documents once more: those that come first in a seeded order, until the wanted words
are reached. A document that straddles the end is taken if more than half of it fits, so
the taken words differ from the target by half a document at most.

Running sums are distributed: rows are dealt out in ranges, summed within each range,
and shifted by the sums of the ranges before. A source with a third of all rows spreads
over many ranges.

Everything is DataFrame expressions.

Defined results: a null or blank text has size 0 and is taken 0 times. A null source is a
source of its own, last in order. Rows that repeat a doc_id are documents of their own.
Sources of size 0 have target 0. Extra columns are ignored. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored

EPOCHS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def running(df: DataFrame, order: list[Column], sums: dict[str, str], purpose: str) -> DataFrame:
    """Adds for each (name: column) the sum of the column over all rows before this one.

    The order must be total up to rows that are alike.
    """
    dealt = stored(df.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()), purpose)
    within = Window.partitionBy("range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("range_no").agg(*[F.sum(c).alias(f"part_{n}") for n, c in sums.items()])
    # one row per range: as many as there are shuffle partitions
    earlier = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select("range_no", *[F.coalesce(F.sum(f"part_{n}").over(earlier), F.lit(0)).alias(f"shift_{n}") for n in sums])
    return (
        dealt.join(F.broadcast(shifts), "range_no")
        .withColumns({n: F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"shift_{n}") for n, c in sums.items()})
        .drop("range_no", *[f"shift_{n}" for n in sums])
    )


def targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``weight`` (1, 2, 3, repeating, by source) and ``target`` to (source, source_size)."""
    by_name = [F.col("source").asc_nulls_last()]
    numbered = running(sources.withColumn("one", F.lit(1)), by_name, {"rank": "one"}, "source-rank")
    weighed = numbered.select(
        "source", "source_size", (F.col("rank") % 3 + 1).cast("long").alias("weight")
    ).withColumn("ceiling", F.lit(epochs) * F.col("source_size"))
    fullness = F.col("ceiling") / F.col("weight")
    filled = running(
        weighed.withColumn("fullness", fullness),
        [F.col("fullness").asc(), F.col("source").asc_nulls_last()],
        {"ceilings": "ceiling", "weights": "weight"},
        "source-level",
    )
    totals = weighed.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("all_weights"))
    level = (F.col("total") - F.col("ceilings")) / (F.col("all_weights") - F.col("weights"))
    here = filled.crossJoin(F.broadcast(totals)).withColumn("level", level)     # one row of totals
    # the level grows while sources are full and is right at the first that isn't, in the order of the running sums
    first = F.struct("fullness", F.col("source").isNull(), "source", "level")
    found = here.agg(F.min(F.when(F.col("level") <= F.col("fullness"), first)).alias("at"))
    return here.drop("level").crossJoin(F.broadcast(found)).select(
        "source",
        "source_size",
        "weight",
        F.least(F.col("ceiling").cast("double"), F.coalesce(F.col("at.level"), F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def mixed(docs: DataFrame, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, weight, target, copies, taken."""
    sized = stored(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            docs["source"].cast("string").alias("source"),
            F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        ),
        "sizes",
    )
    wanted = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), epochs), "targets")
    draw = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.col("source").asc_nulls_last(), F.col("draw").asc(), F.col("doc_id").asc_nulls_first(), F.col("size").asc()]
    placed = running(sized.withColumn("draw", draw), order, {"words_before": "size"}, "draws")
    base = running(wanted, [F.col("source").asc_nulls_last()], {"source_starts": "source_size"}, "starts")
    left, right = placed.alias("d"), base.withColumnRenamed("source", "name").alias("s")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    before = F.col("words_before") - F.col("source_starts")
    quota = F.col("target") - F.col("whole") * F.col("source_size")
    more = F.when(2 * before + F.col("size") <= 2 * quota, F.lit(1)).otherwise(F.lit(0))
    return (
        left.join(right, F.col("d.source").eqNullSafe(F.col("s.name")))
        .withColumn("whole", whole)
        .withColumn("copies", F.when(F.col("size") > 0, (F.col("whole") + more).cast("long")).otherwise(F.lit(0).cast("long")))
        .select("doc_id", "source", "size", "source_size", "weight", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLES = {
    "op1_mix_sources": """
        WITH d AS (
            SELECT doc_id, source,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
        f AS (SELECT *, 3 * source_size AS ceiling, CAST(3 * source_size AS DOUBLE) / weight AS fullness FROM w),
        l AS (
            SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(ceiling) OVER b, 0) AS DOUBLE)
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lvl
            FROM f
            WINDOW b AS (ORDER BY fullness, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        a AS (SELECT lvl FROM l WHERE lvl <= fullness ORDER BY fullness, source NULLS LAST LIMIT 1),
        t AS (SELECT source, source_size, least(CAST(ceiling AS DOUBLE), a.lvl * weight) AS target FROM f, a),
        p AS (
            SELECT d.*, t.source_size, t.target,
                   CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
                   coalesce(sum(d.size) OVER (
                       PARTITION BY d.source ORDER BY md5('mix-1:' || d.doc_id), d.doc_id, d.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST(size * (whole + CASE WHEN 2 * before + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END)
                    AS BIGINT) AS taken
        FROM p
    """
}
QUERIES = {"op1_mix_sources": op1_mix_sources}
