"""The layers end to end, as streams: raw files, bronze, silver with issue log, gold, marts.

Each function runs its flows over what has arrived since the last call and then stops, so
calling ``run`` again after new files came in brings every table up to date. A table is a
folder under ``root``; each flow has its own checkpoint there.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import presets
from tidemark.operators import dedup, quarantine, rules
from tidemark.operators.partials import Partials
from tidemark.plans import marts, silver, star
from tidemark.sources import ingest, tables
from tidemark.streaming import flows
from tidemark.streaming.segments import Draft

FIELDS = {
    "policy": (
        "policy_number", "customer_id", "car_id", "policy_bind_date", "policy_state", "policy_csl", "policy_deductable",
        "policy_annual_premium", "umbrella_limit",
    ),
    "sales": (
        "sales_id", "car_id", "ad_placed_on", "sold_on", "original_selling_price", "Region", "State", "City",
        "seller_type", "owner",
    ),
    "cars": (
        "car_id", "name", "fuel", "transmission", "model", "torque", "km_driven", "seats", "mileage", "engine", "max_power",
    ),
    "claims": (
        "ClaimID", "PolicyID", "Claim_Logged_On", "Claim_Processed_On", "Claim_Rejected", "incident_date",
        "incident_state", "incident_city", "incident_location", "incident_type", "collision_type", "incident_severity",
        "authorities_contacted", "police_report_available", "number_of_vehicles_involved", "bodily_injuries", "witnesses",
        "injury", "property", "vehicle", "property_damage",
    ),
}
CUSTOMER_FIELDS = {
    **presets.CUSTOMER_ALIASES,
    **{n: (n,) for n in ("State", "Job", "Default", "Balance", "HHInsurance", "CarLoan")},
}
UNIQUE = {"policy": "policy_number", "sales": "sales_id", "cars": "car_id", "claims": "ClaimID"}
CLEAN = {
    "policy": (silver.policy, presets.POLICY_RULES, presets.POLICY_ISSUES),
    "sales": (silver.sales, presets.SALES_RULES, presets.SALES_ISSUES),
    "cars": (silver.cars, presets.CAR_RULES, presets.CAR_ISSUES),
    "claims": (silver.claims, presets.CLAIM_RULES, presets.CLAIM_ISSUES),
}
CUSTOMER_SEQUENCE = ["completeness_score", "_loaded_at"]


def _checkpoint(root: str, flow: str) -> str:
    return f"{root}/checkpoints/{flow}"


def bronze_entity(
    spark: SparkSession, raw: str, root: str, name: str, glob: str, max_files: int, wait: bool = True
) -> StreamingQuery:
    """New files of one entity to its table: values as exact text, with lineage.

    Fields that the entity doesn't have, and lines that can't be read, go to ``_rescued_data``.
    """
    path, checkpoint = f"{root}/bronze/{name}", _checkpoint(root, f"bronze-{name}")
    if name == "claims":
        schema = ", ".join(f"`{f}` string" for f in FIELDS[name])
        return flows.run_flow(ingest.json_rescue(spark, raw, glob, schema, True, max_files), path, checkpoint, wait=wait)
    # fields are found by each file's own header
    fields = CUSTOMER_FIELDS if name == "customers" else {f: (f,) for f in FIELDS[name]}

    def step(files: DataFrame, _: int) -> dict[str, DataFrame]:
        paths = [r["path"] for r in files.collect()]        # max_files at most
        return {path: ingest.drifting_csv(spark, [unquote(p) for p in paths], None, fields)}

    return flows.run_step(ingest.new_files(spark, raw, glob, max_files), step, checkpoint, wait)


def bronze(spark: SparkSession, raw: str, root: str, max_files: int) -> None:
    """All entities at once, told apart by file name."""
    running = [
        bronze_entity(spark, raw, root, name, glob, max_files, wait=False)
        for name, glob in presets.FILE_GLOBS.items()
    ]
    for query in running:
        query.awaitTermination()


def _silver_entity(spark: SparkSession, root: str, name: str, max_files: int) -> None:
    clean, row_rules, spec = CLEAN[name]
    path, key = f"{root}/silver/{name}", UNIQUE[name]

    def finish(good: DataFrame, batch_id: int) -> DataFrame:
        return flows.unseen(spark, dedup.dedup_first(good, [key]), [key], path, batch_id)

    flows.split_flow(
        flows.stream_sink(spark, f"{root}/bronze/{name}", max_files), clean, row_rules, spec, path,
        f"{root}/dq_issues/flow={name}", _checkpoint(root, f"silver-{name}"), finish,
    )


def waiting_claims(spark: SparkSession, root: str) -> flows.Waiting:
    """Claims without a policy so far."""
    return flows.Waiting(spark, f"{root}/silver/claims_waiting", f"{root}/silver/claims/flow=repaired", ("ClaimID",))


def _linked(claims: DataFrame, policy: DataFrame) -> DataFrame:
    """Claims with bind date and links; ``_found`` is set where there is a policy."""
    marked = policy.withColumn("_found", F.lit(True))
    return silver.enrich_claims(claims, marked, carry=[*star.LINKS, "_found"])


def _silver_claims(spark: SparkSession, root: str, max_files: int) -> None:
    """New valid claims: with their policy to ``silver/claims``, without one to those that wait."""
    clean, row_rules, spec = CLEAN["claims"]
    settled, waiting = f"{root}/silver/claims/flow=fresh", waiting_claims(spark, root)

    def step(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        lonely = waiting.draft(batch_id)
        found, issues = (Draft(spark, path, f"batch_id={batch_id}") for path in (settled, f"{root}/dq_issues/flow=claims"))
        for rows in flows.in_slices(clean(batch), ["ClaimID"], batch.count()):
            rows = rows.persist()
            good = dedup.dedup_first(rules.keep_valid(rows, row_rules), ["ClaimID"])
            fresh = flows.unseen(spark, good, ["ClaimID"], (settled, waiting.waiting), batch_id)
            linked = _linked(fresh, flows.read_sink(spark, f"{root}/silver/policy")).persist()
            try:
                lonely.add(linked.filter("_found IS NULL").select(*rows.columns))
                found.add(linked.filter("_found").drop("_found"))
                issues.add(quarantine.issue_log(rows, row_rules, spec))
            finally:
                linked.unpersist()
                rows.unpersist()
            del good, fresh, linked, rows
        waiting.finish(lonely, batch_id)
        found.finish()
        issues.finish()
        return {}

    flows.run_step(flows.stream_sink(spark, f"{root}/bronze/claims", max_files), step, _checkpoint(root, "silver-claims"))


def _repair_claims(spark: SparkSession, root: str, max_files: int) -> None:
    """Policies that came in after their claims complete them."""

    def complete(claims: DataFrame, policy: DataFrame) -> DataFrame:
        named = policy.select(F.col("policy_number").alias("PolicyID"))
        return _linked(claims.join(named, "PolicyID", "left_semi"), policy).drop("_found")

    policies = flows.stream_sink(spark, f"{root}/silver/policy", max_files)
    flows.late_flow(policies, waiting_claims(spark, root), complete, _checkpoint(root, "repair-claims"))


def to_silver(spark: SparkSession, root: str, max_files: int) -> None:
    """Clean, check, deduplicate; bad rows of all entities go to one issue log."""
    for name in ("policy", "sales", "cars"):
        _silver_entity(spark, root, name, max_files)
    _repair_claims(spark, root, max_files)      # after the policies, and before claims read them
    _silver_claims(spark, root, max_files)
    source = silver.customers(flows.stream_sink(spark, f"{root}/bronze/customers", max_files))
    flows.upsert_flow(
        source, ["CustomerID"], CUSTOMER_SEQUENCE, f"{root}/silver/customers", _checkpoint(root, "silver-customers")
    )
    flows.run_flow(
        source, f"{root}/dq_issues/flow=customers", _checkpoint(root, "issues-customers"),
        lambda rows: quarantine.issue_log(rows, presets.CUSTOMER_RULES, presets.CUSTOMER_ISSUES),
    )


def unlinked_claims(spark: SparkSession, root: str) -> DataFrame | None:
    """Claims that still wait, with NULL in place of what their policy would give."""
    rows = waiting_claims(spark, root).open()
    if rows is None:
        return None
    links = {f.name: F.lit(None).cast(f.dataType) for f in flows.read_sink(spark, f"{root}/silver/policy").schema if f.name in ("policy_bind_date", *star.LINKS)}
    return silver.day_buckets(rows.withColumns(links))


def claims(spark: SparkSession, root: str) -> DataFrame:
    """All valid claims, each once."""
    settled, waiting = flows.read_sink(spark, f"{root}/silver/claims").drop("flow"), unlinked_claims(spark, root)
    return settled if waiting is None else settled.unionByName(waiting)


def issues(spark: SparkSession, root: str) -> DataFrame:
    return flows.read_sink(spark, f"{root}/dq_issues").drop("flow")


def customers(spark: SparkSession, root: str) -> DataFrame:
    return flows.read_upsert(
        spark, f"{root}/silver/customers", ["CustomerID"], CUSTOMER_SEQUENCE, hide=["completeness_score"]
    )


def to_gold(
    spark: SparkSession, root: str, max_files: int, as_of: Column | None = None
) -> None:
    """Facts and dimensions follow silver as streams. The customer dimension is rebuilt: its
    source is updated in place, which an append-only stream cannot follow."""
    steps = {
        "fact_claims": ("claims", star.fact_claims),        # completed claims come as rows of their own
        "dim_policy": ("policy", star.dim_policy),
        "dim_car": ("cars", star.dim_car),
        "fact_sales": ("sales", lambda rows: star.fact_sales(rows, as_of)),
    }
    for target, (source, transform) in steps.items():
        stream = flows.stream_sink(spark, f"{root}/silver/{source}", max_files)
        flows.run_flow(stream, f"{root}/gold/{target}", _checkpoint(root, target), transform)
    tables.refresh(star.dim_customer(customers(spark, root)), f"{root}/gold/dim_customer")


def to_marts(spark: SparkSession, root: str, max_files: int) -> None:
    """Add what is new in gold to the aggregates' parts, and settle the aggregates from the parts.

    The parts hold a row per customer and policy type, and per region and car, so neither
    step reads the facts again. Claims that still wait are counted beside them.
    """
    def gold(name: str) -> DataFrame:
        return flows.read_sink(spark, f"{root}/gold/{name}")

    def parts(name: str, source: str, parts_of, how: Partials) -> DataFrame:
        path = f"{root}/gold/parts_{name}"
        facts = flows.stream_sink(spark, f"{root}/gold/{source}", max_files)
        flows.aggregate_flow(facts, parts_of, how.merge, path, _checkpoint(root, f"parts-{name}"))
        return how.table(spark, path).read()

    tables.refresh(marts.customer_identity(gold("dim_customer")), f"{root}/gold/agg_customer_identity")
    per_claim, waiting = parts("claims", "fact_claims", marts.claim_parts, marts.CLAIM_PARTS), unlinked_claims(spark, root)
    if waiting is not None:
        per_claim = marts.CLAIM_PARTS.merge(per_claim.unionByName(marts.claim_parts(star.fact_claims(waiting))))
    tables.refresh(marts.claim_performance_of(per_claim, gold("dim_customer")), f"{root}/gold/agg_claim_performance")
    per_car = parts("stock", "fact_sales", marts.stock_parts, marts.STOCK_PARTS)
    tables.refresh(marts.inventory_status_of(per_car, gold("dim_car")), f"{root}/gold/agg_inventory_status")


def run(
    spark: SparkSession, raw: str, root: str, max_files: int, as_of: Column | None = None
) -> None:
    """``max_files`` bounds every micro-batch, the first run over a backlog included."""
    bronze(spark, raw, root, max_files)
    to_silver(spark, root, max_files)
    to_gold(spark, root, max_files, as_of)
    to_marts(spark, root, max_files)
