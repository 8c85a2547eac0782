"""Fixed values of the insurance pipeline: rules, labels, weights, thresholds, word lists.

Everything here is data. The operators take it as parameters.
"""

from __future__ import annotations

from tidemark.operators.rules import non_negative, not_null, one_of
from tidemark.operators.specs import IssueSpec

# Texts that stand for a missing value.
NULL_TOKENS = ("null", "NULL", "")          # matched exactly
CLAIM_NULL_TOKENS = ("null", "NULL", "", "?")
NULL_WORDS = ("null", "none", "", "nan")    # matched after trim and lower

# File patterns of the raw inputs.
FILE_GLOBS = {
    "customers": "customers*.csv",
    "sales": "[sS]ales*.csv",
    "cars": "cars*.csv",
    "policy": "policy*.csv",
    "claims": "claims*.json",
}
SALES_TS_FORMAT = "dd-MM-yyyy HH:mm"

# Regions, their one-letter codes, header variants.
REGIONS = ("East", "West", "Central", "South", "North")
REGION_CODES = {"W": "West", "C": "Central", "E": "East", "S": "South", "N": "North"}
CUSTOMER_ALIASES = {
    "CustomerID": ("CustomerID", "Customer_ID", "cust_id"),
    "Region": ("Region", "Reg"),
    "City": ("City", "City_in_state"),
    "Marital": ("Marital", "Marital_status"),
    "Education": ("Education", "Edu"),
}
MARITAL = ("single", "married", "divorced", "na")
EDUCATION = ("secondary", "primary", "na")

# Row rules.
TIMELINE_1 = "incident_date > 0 AND Claim_Logged_On = 0 AND Claim_Processed_On > 0"
TIMELINE_2 = "incident_date > 0 AND Claim_Logged_On > 0 AND Claim_Logged_On > incident_date"
TIMELINE_3 = (
    "incident_date > 0 AND Claim_Logged_On > 0 AND Claim_Logged_On < incident_date"
    " AND (Claim_Processed_On > Claim_Logged_On OR Claim_Processed_On > incident_date)"
)
LINEAGE_RULES = not_null("_source_file")
POLICY_RULES = {
    **not_null("policy_number", "customer_id", "car_id"),
    **non_negative("policy_deductable", "policy_annual_premium", "umbrella_limit"),
}
CLAIM_RULES = {
    **not_null("ClaimID", "PolicyID", "property_damage"),
    "incident_date_positive": "incident_date > 0",
    **non_negative("injury", "property", "vehicle"),
    "timeline_1": f"NOT ({TIMELINE_1})",
    "timeline_2": f"NOT ({TIMELINE_2})",
    "timeline_3": f"NOT ({TIMELINE_3})",
}
SALES_RULES = {
    **not_null("sales_id", "car_id"),
    **non_negative("original_selling_price"),
    **one_of("Region", REGIONS),
}
CUSTOMER_RULES = {
    **not_null("CustomerID"),
    **one_of("Region", REGIONS),
    **non_negative("Balance"),
    **one_of("Marital", MARITAL),
    **one_of("Education", EDUCATION),
}
CAR_RULES = {**not_null("car_id"), **non_negative("km_driven", "mileage")}


def _bad_number(col: str) -> str:
    return f"{col} IS NULL OR {col} < 0"


# Issue labels, first match wins.
POLICY_ISSUES = IssueSpec(
    table="policy",
    cases=(
        ("policy_number IS NULL", "policy_number", "Missing or empty Policy ID"),
        ("customer_id IS NULL", "customer_id", "Orphaned record: Missing customer_id link"),
        ("car_id IS NULL", "car_id", "Orphaned record: Missing car_id link"),
        (
            _bad_number("policy_deductable"),
            "policy_deductable",
            "Financial Error: Negative or missing policy deductible",
        ),
        (
            _bad_number("policy_annual_premium"),
            "policy_annual_premium",
            "Financial Error: Negative or missing annual premium",
        ),
    ),
    other_column="umbrella_limit",
    other_description="Financial Error: Negative or missing umbrella limit",
    levels=(("policy_number IS NULL OR customer_id IS NULL OR car_id IS NULL", "4"),),
    other_level="3",
)
CLAIM_ISSUES = IssueSpec(
    table="claims",
    cases=(
        ("ClaimID IS NULL", "ClaimID", "Missing or empty Claim ID"),
        ("PolicyID IS NULL", "PolicyID", "Orphaned record: Missing Policy ID"),
        ("incident_date = 0", "incident_date", "Invalid metric: Incident date is 00:00.0 or missing"),
        (TIMELINE_1, "Claim_Logged_On", "Timeline Logic Error: Claim was processed but never logged"),
        (TIMELINE_2, "Claim_Logged_On", "Timeline Logic Error: Claim was logged after the incident date"),
        (
            TIMELINE_3,
            "Claim_Processed_On",
            "Timeline Logic Error: Processed date sequence is invalid against Logged/Incident date",
        ),
        (_bad_number("injury"), "injury", "Financial Error: Injury cost is missing or negative"),
        (_bad_number("property"), "property", "Financial Error: Property cost is missing or negative"),
        (_bad_number("vehicle"), "vehicle", "Financial Error: Vehicle cost is missing or negative"),
        ("property_damage IS NULL", "property_damage", "Missing Data: Property damage flag is null"),
    ),
    other_column="Multiple/Complex",
    other_description="Data Quality Rule Violation",
    levels=(
        ("ClaimID IS NULL", "4"),
        ("PolicyID IS NULL", "3"),
        ("injury < 0 OR property < 0 OR vehicle < 0", "3"),
    ),
    other_level="2",
)
SALES_ISSUES = IssueSpec(
    table="sales",
    cases=(
        ("sales_id IS NULL", "sales_id", "Missing or empty Sales ID"),
        ("car_id IS NULL", "car_id", "Orphaned record: Missing Car ID"),
        (
            _bad_number("original_selling_price"),
            "original_selling_price",
            "Invalid financial metric: Price is negative or missing",
        ),
    ),
    other_column="Region",
    other_description="Invalid Region value (Must be East, West, Central, North or South)",
    levels=((f"sales_id IS NULL OR car_id IS NULL OR {_bad_number('original_selling_price')}", "4"),),
    other_level="2",
)
CUSTOMER_ISSUES = IssueSpec(
    table="customers",
    cases=(
        ("CustomerID IS NULL", "CustomerID", "Missing or empty Customer ID"),
        (_bad_number("Balance"), "Balance", "Negative or missing balance detected"),
        (
            "Marital IS NULL OR Marital NOT IN ('single', 'married', 'divorced', 'na')",
            "Marital",
            "Invalid Marital status (Must be single, married, divorced, or na)",
        ),
        (
            "Education IS NULL OR Education NOT IN ('secondary', 'primary', 'na')",
            "Education",
            "Invalid Education value (Must be secondary, primary, or na)",
        ),
    ),
    other_column="Region",
    other_description="Invalid Region value (Must be East, West, Central, North or South)",
    levels=(("CustomerID IS NULL", "4"), (_bad_number("Balance"), "3")),
    other_level="2",
    hidden=("completeness_score",),
)
CAR_ISSUES = IssueSpec(
    table="cars",
    cases=(
        ("car_id IS NULL", "car_id", "Missing or empty Car ID"),
        ("km_driven < 0", "km_driven", "Invalid metric: Negative KM Driven detected"),
    ),
    other_column="mileage",
    other_description="Invalid metric: Negative Mileage detected",
    levels=(("car_id IS NULL", "4"), ("km_driven < 0", "3")),
    other_level="2",
)

# Claim risk. Words, ranks, rules with weight and text, tier thresholds.
TRUE_WORDS = ("TRUE", "YES", "Y", "1")
AUTHORITIES = ("POLICE", "AMBULANCE", "FIRE", "OTHER")
SEVERE_WORDS = ("MAJOR DAMAGE", "SEVERE", "HIGH", "TOTAL LOSS")
SEVERITY_RANKS = {
    "TRIVIAL DAMAGE": 1,
    "MINOR DAMAGE": 1,
    "LOW": 1,
    "MODERATE DAMAGE": 2,
    "MEDIUM": 2,
    "MAJOR DAMAGE": 3,
    "HIGH": 3,
    "SEVERE": 4,
    "TOTAL LOSS": 4,
    "CRITICAL": 4,
}
# name, weight, text, condition over the columns that risk.features adds
RISK_RULES = (
    (
        "rule_timing_anomaly",
        20,
        "Delayed reporting or suspicious incident timing",
        "report_delay_days > 30 OR incident_date_day <= 3",
    ),
    ("rule_processing_delay", 15, "Delayed claim processing", "processing_days > 21"),
    (
        "rule_high_complexity",
        20,
        "High complexity accident pattern",
        "complexity_points >= 5 OR vehicles >= 3 OR injuries >= 2",
    ),
    (
        "rule_documentation_mismatch",
        15,
        "Police or authority documentation mismatch",
        "authority_report_mismatch + high_severity_no_police_report > 0",
    ),
    (
        "rule_rejection_pattern",
        10,
        "Claim rejection pattern",
        "claim_rejected_norm IN ('TRUE', 'YES', 'Y', '1')",
    ),
    (
        "rule_severity_mismatch",
        20,
        "Severity mismatch versus incident facts and amount exposure",
        "(severity_rank <= 2 AND (vehicles >= 3 OR injuries >= 1 OR injury_loss > 5000"
        " OR property_loss > 3000 OR vehicle_loss > 10000))"
        " OR (severity_rank >= 3 AND coalesce(vehicles, 0) <= 1 AND coalesce(injuries, 0) = 0"
        " AND injury_loss < 1000 AND property_loss < 500 AND vehicle_loss < 2500)",
    ),
)
RISK_TIERS = (("HIGH", 70), ("MEDIUM", 45), ("LOW", 25))
NO_TIER = "NOT_FLAGGED"

# Inventory ageing, chunking, retrieval confidence.
AGING_DAYS = 60
CHUNK_SIZE = 400
CHUNK_OVERLAP = 80
TOP_K = 5
CONFIDENCE_WEIGHTS = (0.5, 0.3, 0.2)        # mean, best, diversity
DIVERSITY_TARGET = 4
CONFIDENCE_BANDS = (("HIGH", 0.75), ("MEDIUM", 0.50))
LOWEST_BAND = "LOW"
RETRIES = 3
BACKOFF_SECONDS = 2.0

# Headings of the generated texts.
ISSUE_HEADINGS = (
    "What was found:",
    "Why it matters:",
    "Likely cause:",
    "What was done to fix it:",
    "How to prevent recurrence:",
)
BRIEF_HEADINGS = (
    "What makes this claim suspicious:",
    "Which risk factors are present:",
    "What the investigator should do next:",
)
KPI_DOMAINS = (
    ("claims_performance", "Claims Performance Overview"),
    ("policy_portfolio", "Policy Portfolio Overview"),
    ("customer_profile", "Customer Profile Overview"),
)
# Parts of the policy document, (text before, column).
POLICY_DOCUMENT = (
    ("Policy ", "policy_id"),
    ("Policy bind date is ", "policy_bind_date"),
    ("Policy state is ", "policy_state"),
    ("Combined single limit is ", "policy_csl"),
    ("Policy deductible is ", "policy_deductable"),
    ("Annual premium is ", "policy_annual_premium"),
    ("Umbrella limit is ", "umbrella_limit"),
)
