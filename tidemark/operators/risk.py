"""Weighted-rule scoring of claims."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.functions import prompts
from tidemark.operators import infer, skew


def upper_text(col: str) -> Column:
    return F.upper(F.trim(F.col(col).cast("string")))


def normalise(
    df: DataFrame, texts: Mapping[str, str], ints: Mapping[str, str], amounts: Mapping[str, str]
) -> DataFrame:
    """Add comparable copies: {new name: column} for upper-case texts, ints and doubles."""
    return df.withColumns(
        {
            **{new: upper_text(c) for new, c in texts.items()},
            **{new: F.col(c).try_cast("int") for new, c in ints.items()},
            **{new: F.col(c).try_cast("double") for new, c in amounts.items()},
        }
    )


CLAIM_TEXTS = {
    "severity_norm": "incident_severity",
    "authorities_contacted_norm": "authorities_contacted",
    "police_report_available_norm": "police_report_available",
    "claim_rejected_norm": "Claim_Rejected",
    "property_damage_norm": "property_damage",
}
CLAIM_INTS = {
    "claim_logged_on_day": "Claim_Logged_On_day_bucket",
    "claim_processed_on_day": "Claim_Processed_On_day_bucket",
    "incident_date_day": "indicate_day_bucket",
    "vehicles": "number_of_vehicles_involved",
    "injuries": "bodily_injuries",
    "witness_count": "witnesses",
}
CLAIM_AMOUNTS = {"injury_amount": "injury", "property_amount": "property", "vehicle_amount": "vehicle"}


def rank(col: Column, mapping: Mapping[str, int]) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def features(claims: DataFrame, policy_key: str = "PolicyID", sketch_of: DataFrame | None = None) -> DataFrame:
    """Normalised columns, day spans, losses, complexity points, mismatch flags, claims per policy."""
    # counted first: the columns added below need not travel to that join
    counted = skew.count_per_key(claims, [policy_key], "policy_claim_count", sketch_of)
    df = normalise(counted, CLAIM_TEXTS, CLAIM_INTS, CLAIM_AMOUNTS)
    zero = F.lit(0)
    losses = {
        f"{kind}_loss": F.coalesce(F.col(f"{kind}_amount"), F.lit(0.0)) for kind in ("injury", "property", "vehicle")
    }
    no_report = ~F.col("police_report_available_norm").isin(*presets.TRUE_WORDS)
    df = df.withColumns(
        {
            **losses,
            "report_delay_days": F.col("claim_logged_on_day") - F.col("incident_date_day"),
            "processing_days": F.col("claim_processed_on_day") - F.col("claim_logged_on_day"),
            "claim_lifecycle_days": F.col("claim_processed_on_day") - F.col("incident_date_day"),
            "authority_report_mismatch": _flag(
                F.col("authorities_contacted_norm").isin(*presets.AUTHORITIES) & no_report
            ),
            "high_severity_no_police_report": _flag(
                F.col("severity_norm").isin(*presets.SEVERE_WORDS) & no_report
            ),
            "severity_rank": rank(F.col("severity_norm"), presets.SEVERITY_RANKS),
        }
    )
    extra_points = (
        F.col("witness_count") > 0,
        F.col("injury_loss") > 5000,
        F.col("property_loss") > 2500,
        F.col("property_damage_norm").isin(*presets.TRUE_WORDS),
    )
    points = F.coalesce(F.col("vehicles"), zero) + F.coalesce(F.col("injuries"), zero)
    for extra in extra_points:
        points = points + _flag(extra)
    df = df.withColumns(
        {
            "total_loss_amount": F.col("injury_loss") + F.col("property_loss") + F.col("vehicle_loss"),
            "complexity_points": points,
        }
    )
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != "policy_claim_count"], "policy_claim_count")


def apply_rules(df: DataFrame, risk_rules: Sequence[tuple] = presets.RISK_RULES) -> DataFrame:
    return df.withColumns({name: _flag(F.expr(cond)) for name, _, _, cond in risk_rules})


def score(df: DataFrame, weights: Mapping[str, int]) -> DataFrame:
    """Add ``raw_anomaly_points`` and ``anomaly_score``, the share of all weights in percent."""
    parts = [F.col(name) * F.lit(w) for name, w in weights.items()]
    points = sum(parts[1:], parts[0])
    return df.withColumns(
        {
            "raw_anomaly_points": points,
            "anomaly_score": F.round(points / F.lit(sum(weights.values())) * 100, 2),
        }
    )


def tier(value: Column, tiers: Sequence[tuple[str, float]] = presets.RISK_TIERS, other: str = presets.NO_TIER) -> Column:
    """Name of the first threshold the value reaches, from high to low."""
    return F.coalesce(*[F.when(value >= at, F.lit(name)) for name, at in tiers], F.lit(other))


def fired(risk_rules: Sequence[tuple] = presets.RISK_RULES) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(n) == 1, F.lit(text)) for n, _, text, _ in risk_rules]))


def scored(
    claims: DataFrame,
    risk_rules: Sequence[tuple] = presets.RISK_RULES,
    sketch_of: DataFrame | None = None,
) -> DataFrame:
    ruled = apply_rules(features(claims, sketch_of=sketch_of), risk_rules)
    weighted = score(ruled, {name: weight for name, weight, _, _ in risk_rules})
    return weighted.withColumns(
        {"priority_tier": tier(F.col("anomaly_score")), "triggered_rules": fired(risk_rules)}
    )


def flagged(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Rows at or over the threshold; None keeps all of them."""
    return df if threshold is None else df.filter(F.col("anomaly_score") >= threshold)


def flag_summary(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Total, flagged and flagged percentage (0 for no rows), in one aggregation."""
    hit = F.lit(True) if threshold is None else F.col("anomaly_score") >= threshold
    return df.agg(
        F.count(F.lit(1)).alias("total_claims"), F.count_if(hit).alias("flagged_claims")
    ).withColumn(
        "flagged_pct",
        F.coalesce(F.round(F.try_divide(F.col("flagged_claims") * 100.0, F.col("total_claims")), 2), F.lit(0.0)),
    )


REPORT_COLUMNS = (
    # output name, source column, type
    ("claim_id", "ClaimID", "string"),
    ("policy_id", "PolicyID", "string"),
    ("claim_logged_on_raw", "Claim_Logged_On", "string"),
    ("claim_processed_on_raw", "Claim_Processed_On", "string"),
    ("incident_date_raw", "incident_date", "string"),
    ("claim_logged_on_day_bucket", "claim_logged_on_day", "int"),
    ("claim_processed_on_day_bucket", "claim_processed_on_day", "int"),
    ("incident_date_day_bucket", "incident_date_day", "int"),
    ("claim_rejected", "Claim_Rejected", "flag"),
    ("incident_state", "incident_state", "string"),
    ("incident_city", "incident_city", "string"),
    ("incident_location", "incident_location", "string"),
    ("incident_type", "incident_type", "string"),
    ("collision_type", "collision_type", "string"),
    ("incident_severity", "incident_severity", "string"),
    ("authorities_contacted", "authorities_contacted", "string"),
    ("police_report_available", "police_report_available", "flag"),
    ("number_of_vehicles_involved", "vehicles", "int"),
    ("bodily_injuries", "injuries", "int"),
    ("witnesses", "witness_count", "int"),
    ("injury_amount", "injury_amount", "double"),
    ("property_amount", "property_amount", "double"),
    ("vehicle_amount", "vehicle_amount", "double"),
    ("total_loss_amount", "total_loss_amount", "double"),
    ("property_damage", "property_damage", "flag"),
    ("policy_bind_date", "policy_bind_date", "string"),
    ("anomaly_score", "anomaly_score", "double"),
    ("priority_tier", "priority_tier", "string"),
    ("triggered_rules", "triggered_rules", "array<string>"),
    ("report_delay_days", "report_delay_days", "int"),
    ("processing_days", "processing_days", "int"),
    ("claim_lifecycle_days", "claim_lifecycle_days", "int"),
    ("policy_claim_count", "policy_claim_count", "int"),
    ("complexity_points", "complexity_points", "int"),
    ("authority_report_mismatch", "authority_report_mismatch", "int"),
    ("high_severity_no_police_report", "high_severity_no_police_report", "int"),
)
CLAIM_FACTS = tuple(name for name, _, _ in REPORT_COLUMNS[:26])
EVIDENCE = tuple(name for name, _, _ in REPORT_COLUMNS[26:])


def report(
    scored_claims: DataFrame, fn: Callable[[str], str], model: str = "local", limit: int | None = None, **retry
) -> DataFrame:
    """The 40-column result: claim facts, evidence, and a brief written by ``fn``."""
    def shaped(source: str, kind: str) -> Column:
        # a flag reads True/False in the report, as text
        return F.initcap(F.col(source).cast("string")) if kind == "flag" else F.col(source).cast(kind)

    rows = scored_claims.select(*[shaped(src, kind).alias(name) for name, src, kind in REPORT_COLUMNS])
    if limit is not None:
        rows = rows.limit(limit)
    asked = rows.withColumn("_prompt", prompts.brief_prompt(CLAIM_FACTS, EVIDENCE))
    answered = infer.map_text(asked, "_prompt", fn, **retry)
    return answered.select(
        *rows.columns,
        F.coalesce(F.col("reply_text"), F.concat(F.lit("ERROR: "), F.col("error_message"))).alias(
            "ai_investigation_brief"
        ),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("brief_generated_at"),
        F.lit(model).alias("model_name"),
        "generation_status",
    )


def top_claims(rows: DataFrame, n: int = 3, key: str = "claim_id") -> DataFrame:
    """The n highest scores; the key breaks ties."""
    return rows.orderBy(F.desc("anomaly_score"), F.col(key)).limit(n)
