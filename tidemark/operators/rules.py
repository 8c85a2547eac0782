"""Named row rules: keep, quarantine, measure.

A rule is a name and a SQL condition. A row passes only if the condition is TRUE;
NULL counts as a failure, so kept and quarantined rows are exact complements.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]


def not_null(*cols: str) -> dict[str, str]:
    return {f"{c}_present": f"{c} IS NOT NULL" for c in cols}


def non_negative(*cols: str) -> dict[str, str]:
    return {f"{c}_non_negative": f"{c} >= 0" for c in cols}


def one_of(col: str, words: Iterable[str]) -> dict[str, str]:
    listed = ", ".join(f"'{w}'" for w in words)
    return {f"{col}_listed": f"{col} IN ({listed})"}


def passes(rules: Rules) -> Column:
    checks = [F.coalesce(F.expr(r), F.lit(False)) for r in rules.values()]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def _where(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns as they are, each evaluated once.

    Rules read a cleaned column many times. Pushed below the cleaning step, every mention
    would repeat that column's whole expression; the partition id ties the filter to its
    place above it.
    """
    return (
        df.withColumns({"_hit": condition, "_part": F.spark_partition_id()})
        .filter(F.col("_hit") & (F.col("_part") >= 0))
        .drop("_hit", "_part")
    )


def keep_valid(df: DataFrame, rules: Rules, cleaned: bool = True) -> DataFrame:
    """Rows that pass every rule.

    ``cleaned=False`` says that the rules read columns as they are stored: each becomes a
    plain filter, which Spark pushes down to the scan.
    """
    if not cleaned:
        return reduce(lambda kept, rule: kept.filter(F.expr(rule)), rules.values(), df)
    return _where(df, passes(rules))


def quarantine(df: DataFrame, rules: Rules, null_policy: str = "strict") -> DataFrame:
    """Rows that break a rule.

    ``null_policy="literal"`` takes the rules at their word: a rule that evaluates
    to NULL does not count as broken, so such a row is neither kept nor reported.
    """
    if null_policy == "strict":
        return _where(df, ~passes(rules))
    if null_policy != "literal":
        raise ValueError(f"unknown null_policy: {null_policy}")
    return _where(df, reduce(lambda a, b: a | b, [~F.expr(r) for r in rules.values()]))


def violation_counts(rules: Rules) -> list[Column]:
    return [F.count_if(~F.coalesce(F.expr(r), F.lit(False))).alias(n) for n, r in rules.items()]


def measure(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rows seen and rows that fail. A single aggregation."""
    total = F.count(F.lit(1)).alias("_rows")
    entries = [
        F.struct(F.lit(n).alias("rule"), F.col("_rows").alias("rows_seen"), F.col(f"`{n}`").alias("violations"))
        for n in rules
    ]
    return df.agg(total, *violation_counts(rules)).select(F.inline(F.array(*entries)))


def observe(df: DataFrame, rules: Rules, name: str) -> tuple[DataFrame, Observation]:
    """Warn-only form: rows flow on unchanged, counts arrive with the first action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows_seen"), *violation_counts(rules)), seen
