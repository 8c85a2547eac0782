"""Facts and dimensions from the silver entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import skew


#: What a claim takes from its policy, besides the bind date.
LINKS = ("customer_id", "car_id", "policy_csl")


def fact_claims(
    claims: DataFrame, policy: DataFrame | None = None, sketch_of: DataFrame | None = None
) -> DataFrame:
    """Claims with their policy's keys and real dates. Claims without a policy stay, with NULLs.

    Claims that carry ``LINKS`` from their enrichment need no ``policy``; their facts carry the
    policy type as well.
    """
    if policy is None:
        df, more = claims.withColumn("_bound", F.col("policy_bind_date")), [F.col("policy_csl").alias("policy_type")]
    else:
        links = policy.select(
            F.col("policy_number").alias("PolicyID"), "customer_id", "car_id", F.col("policy_bind_date").alias("_bound")
        )
        df, more = skew.left_join_unique(claims, links, ["PolicyID"], sketch_of), []

    def on_day(bucket: str) -> Column:
        return F.date_add(F.col("_bound").cast("date"), F.col(bucket))

    logged, processed = on_day("Claim_Logged_On_day_bucket"), on_day("Claim_Processed_On_day_bucket")
    return df.select(
        F.col("ClaimID").alias("claim_id"),
        F.col("PolicyID").alias("policy_id"),
        "customer_id",
        "car_id",
        on_day("indicate_day_bucket").alias("incident_date"),
        logged.alias("claim_logged_on"),
        processed.alias("claim_processed_on"),
        F.col("Claim_Rejected").alias("claim_rejected"),
        "incident_severity",
        "incident_type",
        "collision_type",
        "injury",
        "property",
        "vehicle",
        "number_of_vehicles_involved",
        "bodily_injuries",
        "witnesses",
        "property_damage",
        "police_report_available",
        F.date_diff(processed, logged).alias("processing_time_days"),
        *more,
    )


def dim_policy(policy: DataFrame) -> DataFrame:
    return policy.select(
        F.col("policy_number").alias("policy_id"),
        "customer_id",
        "car_id",
        "policy_bind_date",
        "policy_state",
        "policy_csl",
        "policy_deductable",
        "policy_annual_premium",
        "umbrella_limit",
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    lowered = {n: n.lower() for n in ("Region", "State", "City", "Job", "Marital", "Education", "Balance")}
    names = {"CustomerID": "customer_id", **lowered, "Default": "default_flag"}
    order = ("CustomerID", "Region", "State", "City", "Job", "Marital", "Education", "Default", "Balance")
    return customers.select(*[F.col(n).alias(names[n]) for n in order], "HHInsurance", "CarLoan")


def dim_car(cars: DataFrame) -> DataFrame:
    return cars.select(
        "car_id", "name", "model", "fuel", "transmission", "km_driven", "mileage", "engine", "max_power", "torque", "seats"
    )


def fact_sales(sales: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Listings with their age on ``as_of`` (today if not given) and a sold flag."""
    today = as_of if as_of is not None else F.current_date()
    return sales.select(
        "sales_id",
        "car_id",
        "ad_placed_on",
        "sold_on",
        F.col("Region").alias("region"),
        F.col("State").alias("state"),
        F.col("City").alias("city"),
        "original_selling_price",
        "seller_type",
        "owner",
        F.date_diff(today, F.col("ad_placed_on")).alias("days_since_listing"),
        F.col("sold_on").isNotNull().cast("int").alias("is_sold"),
    )
