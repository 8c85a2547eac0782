"""Prompt texts, one per row, assembled with built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import presets


def prompt(df: DataFrame, template: str, values: dict[str, Column], name: str = "prompt") -> DataFrame:
    """Add ``template`` with each ``{key}`` replaced by that column's text (NULL reads as empty)."""
    parts: list[Column] = []
    rest = template
    while rest:
        spots = [(rest.index("{" + k + "}"), k) for k in values if "{" + k + "}" in rest]
        if not spots:
            parts.append(F.lit(rest))
            break
        at, key = min(spots)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(F.coalesce(values[key].cast("string"), F.lit("")))
        rest = rest[at + len(key) + 2 :]
    return df.withColumn(name, F.concat(*parts))


def facts_json(cols: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"})


def issue_prompt(cols: Sequence[str]) -> Column:
    ask = (
        "Describe the following data quality issue to a compliance officer in plain business words. "
        "Stick to the facts given. Answer under these headings, in one to three sentences each:\n"
        + "\n".join(presets.ISSUE_HEADINGS)
        + "\nIssue: "
    )
    return F.concat(F.lit(ask), facts_json(cols))


def brief_prompt(claim_cols: Sequence[str], evidence_cols: Sequence[str]) -> Column:
    ask = (
        "Scoring rules marked this claim for review. Say why it deserves a closer look, without "
        "accusing anyone, and quote the data points. Answer under these headings:\n"
        + "\n".join(presets.BRIEF_HEADINGS)
        + "\nClaim: "
    )
    return F.concat(
        F.lit(ask), facts_json(claim_cols), F.lit("\nEvidence: "), facts_json(evidence_cols)
    )


def kpi_prompt(domain: Column, kpi_json: Column) -> Column:
    return F.concat(
        F.lit("Summarise these figures for the board: insights, risks, opportunities, anomalies. Domain: "),
        domain,
        F.lit(". Figures: "),
        kpi_json,
    )


ANSWER_TEMPLATE = (
    "Use nothing but the records below to answer. Say so if they do not hold the answer, "
    "and name the records you rely on.\n\nRecords:\n{context}\n\nQuestion:\n{question}\n"
)
