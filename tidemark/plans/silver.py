"""Typed, cleaned entities from raw text rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.functions import columns as c
from tidemark.operators import dedup, rules, skew


def policy(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[c.force_null(k).alias(k) for k in ("policy_number", "customer_id", "car_id")],
        c.to_ts(c.force_null("policy_bind_date")).alias("policy_bind_date"),
        F.upper(c.force_null("policy_state")).alias("policy_state"),
        c.force_null("policy_csl").alias("policy_csl"),
        c.to_int(c.force_null("policy_deductable")).alias("policy_deductable"),
        c.force_null("policy_annual_premium").try_cast("float").alias("policy_annual_premium"),
        c.to_int(c.force_null("umbrella_limit")).alias("umbrella_limit"),
        "_source_file",
    )


PROPER_CLAIM_TEXTS = (
    "incident_city",
    "incident_location",
    "incident_type",
    "collision_type",
    "incident_severity",
    "authorities_contacted",
)


def claims(raw: DataFrame) -> DataFrame:
    """Claims before enrichment. Day offsets hold the number before the colon, NULL as 0."""
    df = c.null_tokens(raw, presets.CLAIM_NULL_TOKENS)
    return df.select(
        *[F.col(k).cast("string").alias(k) for k in ("ClaimID", "PolicyID")],
        *[c.leading_int(d).alias(d) for d in ("Claim_Logged_On", "Claim_Processed_On", "incident_date")],
        c.token_bool("Claim_Rejected", "Y", "N").alias("Claim_Rejected"),
        F.upper(F.trim("incident_state")).alias("incident_state"),
        *[c.proper(t).alias(t) for t in PROPER_CLAIM_TEXTS],
        c.token_bool("police_report_available", "YES", "NO").alias("police_report_available"),
        *[
            c.to_int(n).alias(n)
            for n in ("number_of_vehicles_involved", "bodily_injuries", "witnesses")
        ],
        *[F.col(a).try_cast("float").alias(a) for a in ("injury", "property", "vehicle")],
        c.token_bool("property_damage", "YES", "NO").alias("property_damage"),
        "_source_file",
    )


def day_buckets(df: DataFrame) -> DataFrame:
    """Running day numbers, counted from the day of month the policy was bound."""
    start = F.dayofmonth("policy_bind_date") + F.col("incident_date")
    logged = start + F.col("Claim_Logged_On")
    return df.withColumns(
        {
            "indicate_day_bucket": start,
            "Claim_Logged_On_day_bucket": logged,
            "Claim_Processed_On_day_bucket": logged + F.col("Claim_Processed_On"),
        }
    )


def enrich_claims(
    claims_df: DataFrame, policy_df: DataFrame, sketch_of: DataFrame | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Add the bind date and the day buckets. ``policy_df`` holds one row per policy.

    ``carry`` names policy columns that come along, so that later steps need no second join.
    """
    links = policy_df.select(F.col("policy_number").alias("PolicyID"), "policy_bind_date", *carry)
    return day_buckets(skew.left_join_unique(claims_df, links, ["PolicyID"], sketch_of))


def sales(raw: DataFrame) -> DataFrame:
    df = raw.select(
        c.to_int(c.force_null("sales_id")).alias("sales_id"),
        c.force_null("car_id").alias("car_id"),
        *[c.to_ts(c.force_null(t), presets.SALES_TS_FORMAT).alias(t) for t in ("ad_placed_on", "sold_on")],
        c.to_int(c.force_null("original_selling_price")).alias("original_selling_price"),
        *[F.initcap(c.force_null(t)).alias(t) for t in ("Region", "State", "City", "seller_type", "owner")],
        "_source_file",
    )
    return c.recode(df, "Region", presets.REGION_CODES)


def customers(raw: DataFrame) -> DataFrame:
    """Customers under one set of names, with their completeness score."""
    df = c.null_tokens(raw)

    def name(target: str):
        return F.trim(c.first_of(df, presets.CUSTOMER_ALIASES.get(target, (target,))).cast("string"))

    clean = df.select(
        name("CustomerID").alias("CustomerID"),
        *[F.initcap(name(t)).alias(t) for t in ("Region", "State", "City")],
        *[F.lower(name(t)).alias(t) for t in ("Job", "Marital", "Education")],
        *[c.to_int(n).alias(n) for n in ("Default", "Balance", "HHInsurance", "CarLoan")],
        "_source_file",
        "_loaded_at",
    )
    return c.recode(clean, "Region", presets.REGION_CODES).withColumn(
        "completeness_score", dedup.completeness(("Job", "Marital", "Education"))
    )


def cars(raw: DataFrame) -> DataFrame:
    df = c.null_tokens(raw)
    return df.select(
        F.col("car_id").cast("string").alias("car_id"),
        F.trim("name").alias("name"),
        *[c.proper(t).alias(t) for t in ("fuel", "transmission", "model")],
        F.trim("torque").alias("torque"),
        *[c.to_int(n).alias(n) for n in ("km_driven", "seats")],
        c.number_in("mileage", "([0-9.]+)", "float").alias("mileage"),
        c.number_in("engine", "([0-9]+)", "int").alias("engine"),
        c.number_in("max_power", "([0-9.]+)", "float").alias("max_power"),
        "_source_file",
    )


def valid_unique(df: DataFrame, row_rules: rules.Rules, keys: list[str], order: str = "valid_first") -> DataFrame:
    """Rows that pass the rules, one per key.

    ``valid_first`` checks before it removes copies, so a bad copy cannot hide a good one.
    ``dedup_first`` removes copies before it checks.
    """
    if order == "valid_first":
        return dedup.dedup_first(rules.keep_valid(df, row_rules), keys)
    if order == "dedup_first":
        return rules.keep_valid(dedup.dedup_first(df, keys), row_rules)
    raise ValueError(f"unknown order: {order}")


def policy_silver(raw: DataFrame, order: str = "valid_first") -> DataFrame:
    return valid_unique(policy(raw), presets.POLICY_RULES, ["policy_number"], order)


def claims_silver(
    raw: DataFrame, policy_df: DataFrame, order: str = "valid_first", carry: Sequence[str] = ()
) -> DataFrame:
    """Valid claims, one per ClaimID, with bind date. The rules use claim columns only, so
    bad rows and copies go before the join. The cleaned key alone serves as the hot-key sketch."""
    good = valid_unique(claims(raw), presets.CLAIM_RULES, ["ClaimID"], order)
    return enrich_claims(good, policy_df, sketch_of=claims(raw).select("PolicyID"), carry=carry)


def sales_silver(raw: DataFrame, order: str = "valid_first") -> DataFrame:
    return valid_unique(sales(raw), presets.SALES_RULES, ["sales_id"], order)


def cars_silver(raw: DataFrame, unique: bool = True) -> DataFrame:
    good = rules.keep_valid(cars(raw), presets.CAR_RULES)
    return dedup.dedup_first(good, ["car_id"]) if unique else good


def customers_silver(raw: DataFrame, enforce: bool = False) -> DataFrame:
    """Latest and most complete row per customer. Bad rows stay in unless ``enforce``."""
    scored = customers(raw)
    if enforce:
        scored = rules.keep_valid(scored, presets.CUSTOMER_RULES)
    return dedup.latest_by_key(
        scored, ["CustomerID"], ["completeness_score", "_loaded_at"], hide=["completeness_score"]
    )
