"""Issue log: which column broke a rule, why, and how bad it is."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import prompts
from tidemark.operators import infer, rules
from tidemark.operators.specs import IssueSpec


def first_match(pairs: Iterable[tuple[str, Column]], otherwise: Column) -> Column:
    """The value paired with the first condition that is TRUE."""
    chain = None
    for condition, value in pairs:
        chain = F.when(F.expr(condition), value) if chain is None else chain.when(F.expr(condition), value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def classify(df: DataFrame, spec: IssueSpec) -> DataFrame:
    """Add ``column_name``, ``issue_description`` and ``severity``."""

    def label(column: str, description: str) -> Column:
        return F.struct(F.lit(column).alias("column"), F.lit(description).alias("description"))

    cases = [(condition, label(column, text)) for condition, column, text in spec.cases]
    levels = [(condition, F.lit(level)) for condition, level in spec.levels]
    return df.withColumns(
        {
            "_label": first_match(cases, label(spec.other_column, spec.other_description)),
            "severity": first_match(levels, F.lit(spec.other_level)),
        }
    ).withColumns(
        {"column_name": F.col("_label.column"), "issue_description": F.col("_label.description")}
    ).drop("_label")


def issue_log(
    df: DataFrame,
    row_rules: rules.Rules,
    spec: IssueSpec,
    null_policy: str = "strict",
    keep_null_fields: bool = True,
) -> DataFrame:
    """One record per bad row. The row itself travels as JSON, NULL fields included."""
    shown = [F.col(f"`{c}`") for c in df.columns if c not in spec.hidden]
    options = {"ignoreNullFields": "false"} if keep_null_fields else {}
    bad = rules.quarantine(df, row_rules, null_policy)
    return classify(bad, spec).select(
        F.expr("uuid()").alias("issue_id"),
        F.lit(spec.table).alias("table_name"),
        "column_name",
        "issue_description",
        "severity",
        F.to_json(F.struct(*shown), options).alias("affected_record"),
        F.current_timestamp().alias("detected_at"),
    )


def union_logs(logs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, logs)


def rollup(issues: DataFrame) -> DataFrame:
    return issues.groupBy("table_name", "column_name", "issue_description", "severity").agg(
        F.count(F.lit(1)).alias("issues")
    )


ISSUE_KEYS = ("issue_id", "table_name", "column_name", "issue_description", "severity", "detected_at")
ISSUE_EXTRAS = ("rule_name", "affected_ratio", "suggested_fix")


def explain(
    issues: DataFrame,
    fn: Callable[[str], str],
    model: str = "local",
    limit: int | None = None,
    **retry,
) -> DataFrame:
    """Explain each issue through ``fn``; returns the 15-column report."""
    from tidemark.sources.tables import require_columns

    issues, record_col = require_columns(issues, ISSUE_KEYS, ("affected_records", "affected_record"), ISSUE_EXTRAS)
    if limit is not None:
        issues = issues.limit(limit)
    facts = issues.select(
        "issue_id",
        "table_name",
        "column_name",
        "severity",
        "issue_description",
        F.col(record_col).alias("affected_records"),
        F.col("detected_at").cast("string").alias("detected_at"),
        *[
            (F.col(c).cast("string") if c in issues.columns else F.lit(None).cast("string")).alias(c)
            for c in ISSUE_EXTRAS
        ],
    )
    asked = facts.withColumn("_prompt", prompts.issue_prompt(facts.columns))
    answered = infer.map_text(asked, "_prompt", fn, **retry)
    return answered.select(
        *facts.columns,
        F.col("reply_text").alias("ai_generated_explanation"),
        F.lit(model).alias("model_name"),
        F.col("generation_status"),
        F.col("error_message"),
        F.current_timestamp().alias("generated_at"),
    )
