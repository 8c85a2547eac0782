"""One-row KPI summaries, their JSON form, and the summary table.

The policy and customer figures are defined over a fan-out join (one row per claim, one for
an entity without claims). That join is never built: claims are counted per key first, and
each entity row is weighted by the rows it would have had.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.functions import prompts
from tidemark.operators import infer

INSIGHT_COLUMNS = (
    "domain_name STRING, summary_title STRING, executive_summary STRING, kpi_json STRING,"
    " generation_timestamp TIMESTAMP, model_name STRING, status STRING"
)


def percent(hit: Column, of: Column | None = None) -> Column:
    return F.try_divide(F.count_if(hit) * 100.0, of if of is not None else F.count(F.lit(1)))


def amount() -> Column:
    return F.col("injury") + F.col("property") + F.col("vehicle")


def claims(fact_claims: DataFrame) -> DataFrame:
    return fact_claims.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.avg(amount()).alias("avg_claim_amount"),
        F.sum(amount()).alias("total_claim_amount"),
        F.avg("processing_time_days").alias("avg_processing_time"),
        percent(F.col("claim_rejected")).alias("rejection_rate"),
        percent(F.col("incident_severity") == "Major Damage").alias("major_severity_pct"),
        F.avg("number_of_vehicles_involved").alias("avg_vehicles_involved"),
        F.avg("bodily_injuries").alias("avg_bodily_injuries"),
        percent(F.col("police_report_available")).alias("police_report_pct"),
    )


def _weighted(entities: DataFrame, fact_claims: DataFrame, key: str, exact: bool) -> DataFrame:
    """Entities with ``_claims`` (claims found) and ``_w`` (rows in the fan-out)."""
    found = fact_claims.groupBy(key).agg(
        F.count("claim_id").alias("_claims"), F.count(F.lit(1)).alias("_rows")
    )
    joined = entities.join(found, key, "left").withColumns(
        {
            "_claims": F.coalesce("_claims", F.lit(0)),
            "_w": F.lit(1) if exact else F.coalesce("_rows", F.lit(1)),
        }
    )
    return joined


def _avg(col: str) -> Column:
    known = F.when(F.col(col).isNotNull(), F.col("_w"))
    return F.try_divide(F.sum(F.col(col) * F.col("_w")), F.sum(known).cast("double"))


def _share(hit: Column) -> Column:
    return F.try_divide(F.sum(F.when(hit, F.col("_w")).otherwise(0)) * 100.0, F.sum("_w"))


def policy(dim_policy: DataFrame, fact_claims: DataFrame, exact: bool = False) -> DataFrame:
    """Policy figures. As defined, a policy counts once per claim; ``exact`` counts it once
    and reads ``policies_with_claim_pct`` as a share of policies."""
    df = _weighted(dim_policy, fact_claims.select("policy_id", "claim_id"), "policy_id", exact)
    policies = F.count_distinct("policy_id")
    with_claim = F.count_if(F.col("_claims") > 0) if exact else F.sum("_claims")
    return df.agg(
        policies.alias("total_policies"),
        _avg("policy_annual_premium").alias("avg_premium"),
        F.sum(F.col("umbrella_limit") * F.col("_w").cast("bigint")).alias("total_umbrella_coverage"),
        _avg("policy_deductable").alias("avg_deductible"),
        F.try_divide(with_claim * 100.0, policies).alias("policies_with_claim_pct"),
    )


def customer(dim_customer: DataFrame, fact_claims: DataFrame, exact: bool = False) -> DataFrame:
    """Customer figures. As defined, ``claims_per_customer`` is the share of fan-out rows that
    hold a claim; ``exact`` gives claims divided by customers."""
    df = _weighted(dim_customer, fact_claims.select("customer_id", "claim_id"), "customer_id", exact)
    return df.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        _avg("balance").alias("avg_balance"),
        _share(F.col("default_flag") == 1).alias("default_rate"),
        F.try_divide(F.sum("_claims").cast("double"), F.sum("_w")).alias("claims_per_customer"),
        _share(F.col("CarLoan") == 1).alias("car_loan_pct"),
        _share(F.col("HHInsurance") == 1).alias("home_insurance_pct"),
    )


def average_amount_text(fact_claims: DataFrame) -> DataFrame:
    return fact_claims.agg(F.avg(amount()).cast("string").alias("avg_claim_amount"))


def ask_about_amount(
    fact_claims: DataFrame, fn: Callable[[str], str], question: str = "What does this mean for the business?", **retry
) -> DataFrame:
    """Put one figure, the average claim amount, to the text function."""
    figure = F.concat(F.lit(f"{question} Average claim amount: "), F.col("avg_claim_amount"))
    asked = average_amount_text(fact_claims).select(figure.alias("question"))
    return infer.map_text(asked, "question", fn, **retry).select(
        "question", F.col("reply_text").alias("explanation"), "generation_status"
    )


def as_json(kpi_row: DataFrame) -> DataFrame:
    return kpi_row.select(prompts.facts_json(kpi_row.columns).alias("kpi_json"))


def union_domains(rows: Mapping[str, DataFrame]) -> DataFrame:
    """{domain: KPI row} as (domain_name, kpi_json) rows."""
    parts = [as_json(df).select(F.lit(name).alias("domain_name"), "kpi_json") for name, df in rows.items()]
    return reduce(DataFrame.unionByName, parts)


def summaries(
    rows: Mapping[str, DataFrame],
    fn: Callable[[str], str],
    titles: Mapping[str, str] = dict(presets.KPI_DOMAINS),
    model: str = "local",
    **retry,
) -> DataFrame:
    """One summary per domain: title, text by ``fn``, figures, time, model, status."""
    named = rows and union_domains(rows)
    pairs = [F.lit(x) for pair in titles.items() for x in pair]
    asked = named.withColumn("_prompt", prompts.kpi_prompt(F.col("domain_name"), F.col("kpi_json")))
    return infer.map_text(asked, "_prompt", fn, **retry).select(
        "domain_name",
        F.create_map(*pairs)[F.col("domain_name")].alias("summary_title"),
        F.col("reply_text").alias("executive_summary"),
        "kpi_json",
        F.current_timestamp().alias("generation_timestamp"),
        F.lit(model).alias("model_name"),
        F.col("generation_status").alias("status"),
    )


def summary_of(insights: DataFrame, domain: str) -> DataFrame:
    return (
        insights.filter(F.col("domain_name") == domain)
        .select("domain_name", "summary_title", "executive_summary")
        .limit(1)
    )
