"""Check SQL: what each registered query must return, written for a second engine.

Plain SQL over the same tables, built from common table expressions. It shares the raw
SELECTs with the queries, being their input, and nothing else.
"""

from __future__ import annotations

from tidemark import presets
from tidemark.workload.raw import TEXTS, check_sql


def _fn(e: str) -> str:
    return f"CASE WHEN lower(trim({e})) IN ('null', 'none', '', 'nan') THEN NULL ELSE trim({e}) END"


def _tok(e: str, extra: str = "") -> str:
    return f"CASE WHEN {e} IN ('null', 'NULL', ''{extra}) THEN NULL ELSE {e} END"


def _claim_tok(e: str) -> str:
    return _tok(e, ", '?'")


def _initcap(e: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({e}, ' '), "
        "lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"
    )


def _region(e: str) -> str:
    return (
        f"CASE {e} WHEN 'W' THEN 'West' WHEN 'C' THEN 'Central' WHEN 'E' THEN 'East'"
        f" WHEN 'S' THEN 'South' WHEN 'N' THEN 'North' ELSE {e} END"
    )


def _yes_no(e: str, yes: str, no: str) -> str:
    return f"CASE {_claim_tok(e)} WHEN '{yes}' THEN true WHEN '{no}' THEN false END"


def _offset(e: str) -> str:
    return (
        f"CASE WHEN ({_claim_tok(e)}) IS NULL THEN 0"
        f" ELSE TRY_CAST(string_split({_claim_tok(e)}, ':')[1] AS INTEGER) END"
    )


def _ts(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S')"


def _unit(e: str, pattern: str, dtype: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({_tok(e)}, '{pattern}', 1), '') AS {dtype})"


def _first_per_key(source: str, key: str, order: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


CLAIM_TEXTS = ("incident_city", "incident_location", "incident_type", "collision_type", "incident_severity", "authorities_contacted")
CLAIM_ORDER = (
    "PolicyID", "Claim_Logged_On", "Claim_Processed_On", "incident_date", "Claim_Rejected", "incident_state",
    *CLAIM_TEXTS, "police_report_available", "number_of_vehicles_involved", "bodily_injuries", "witnesses",
    "injury", "property", "vehicle", "property_damage",
)
T1 = "(incident_date > 0 AND Claim_Logged_On = 0 AND Claim_Processed_On > 0)"
T2 = "(incident_date > 0 AND Claim_Logged_On > 0 AND Claim_Logged_On > incident_date)"
T3 = (
    "(incident_date > 0 AND Claim_Logged_On > 0 AND Claim_Logged_On < incident_date AND "
    "(Claim_Processed_On > Claim_Logged_On OR Claim_Processed_On > incident_date))"
)
CLAIM_CHECKS = {
    "ClaimID_present": "ClaimID IS NOT NULL",
    "PolicyID_present": "PolicyID IS NOT NULL",
    "property_damage_present": "property_damage IS NOT NULL",
    "incident_date_positive": "incident_date > 0",
    "injury_non_negative": "injury >= 0",
    "property_non_negative": "property >= 0",
    "vehicle_non_negative": "vehicle >= 0",
    "timeline_1": f"NOT {T1}",
    "timeline_2": f"NOT {T2}",
    "timeline_3": f"NOT {T3}",
}


def _all(*conds: str) -> str:
    return "(" + " AND ".join(f"coalesce({c}, false)" for c in conds) + ")"


REGION_OK = "Region IN ('East', 'West', 'Central', 'South', 'North')"
OK = {
    "policy": _all(
        "policy_number IS NOT NULL", "customer_id IS NOT NULL", "car_id IS NOT NULL",
        "policy_deductable >= 0", "policy_annual_premium >= 0", "umbrella_limit >= 0",
    ),
    "claims": _all(*CLAIM_CHECKS.values()),
    "sales": _all("sales_id IS NOT NULL", "car_id IS NOT NULL", "original_selling_price >= 0", REGION_OK),
    "customers": _all(
        "CustomerID IS NOT NULL", REGION_OK, "Balance >= 0",
        "Marital IN ('single', 'married', 'divorced', 'na')", "Education IN ('secondary', 'primary', 'na')",
    ),
    "cars": _all("car_id IS NOT NULL", "km_driven >= 0", "mileage >= 0"),
}

_known = "CASE WHEN {0} IS NOT NULL AND {0} <> 'na' THEN 1 ELSE 0 END"
_customer_texts = {
    "Region": _region(_initcap(f"trim({_tok('Region')})")),
    "State": _initcap(f"trim({_tok('State')})"),
    "City": _initcap(f"trim({_tok('City')})"),
    **{n: f"lower(trim({_tok(n)}))" for n in ("Job", "Marital", "Education")},
}
_customer_ints = ", ".join(
    f'TRY_CAST({_tok(chr(34) + n + chr(34))} AS INTEGER) AS "{n}"' for n in ("Default", "Balance", "HHInsurance", "CarLoan")
)

CTES: dict[str, str] = {
    **{f"raw_{name}": check_sql(name) for name in TEXTS},
    "policy": f"""SELECT {_fn('policy_number')} AS policy_number, {_fn('customer_id')} AS customer_id,
      {_fn('car_id')} AS car_id, TRY_CAST({_fn('policy_bind_date')} AS TIMESTAMP) AS policy_bind_date,
      upper({_fn('policy_state')}) AS policy_state, {_fn('policy_csl')} AS policy_csl,
      TRY_CAST({_fn('policy_deductable')} AS INTEGER) AS policy_deductable,
      TRY_CAST({_fn('policy_annual_premium')} AS FLOAT) AS policy_annual_premium,
      TRY_CAST({_fn('umbrella_limit')} AS INTEGER) AS umbrella_limit, _source_file FROM raw_policy""",
    "policy_silver": f"SELECT * FROM policy WHERE {OK['policy']}",
    "claims": f"""SELECT {_claim_tok('ClaimID')} AS ClaimID, {_claim_tok('PolicyID')} AS PolicyID,
      {", ".join(f"{_offset(n)} AS {n}" for n in ("Claim_Logged_On", "Claim_Processed_On", "incident_date"))},
      {_yes_no('Claim_Rejected', 'Y', 'N')} AS Claim_Rejected,
      upper(trim({_claim_tok('incident_state')})) AS incident_state,
      {", ".join(f"{_initcap(f'trim({_claim_tok(n)})')} AS {n}" for n in CLAIM_TEXTS)},
      {_yes_no('police_report_available', 'YES', 'NO')} AS police_report_available,
      {", ".join(f"TRY_CAST({_claim_tok(n)} AS INTEGER) AS {n}"
                 for n in ("number_of_vehicles_involved", "bodily_injuries", "witnesses"))},
      {", ".join(f"TRY_CAST({_claim_tok(n)} AS FLOAT) AS {n}" for n in ("injury", "property", "vehicle"))},
      {_yes_no('property_damage', 'YES', 'NO')} AS property_damage, _source_file FROM raw_claims""",
    "claims_ok": f"SELECT * FROM claims WHERE {OK['claims']}",
    "claims_one": _first_per_key("claims_ok", "ClaimID", ", ".join(f"{n} NULLS FIRST" for n in CLAIM_ORDER)),
    "claims_silver": """SELECT c.*, p.policy_bind_date,
      CAST(day(p.policy_bind_date) AS INTEGER) + c.incident_date AS indicate_day_bucket,
      CAST(day(p.policy_bind_date) AS INTEGER) + c.incident_date + c.Claim_Logged_On AS Claim_Logged_On_day_bucket,
      CAST(day(p.policy_bind_date) AS INTEGER) + c.incident_date + c.Claim_Logged_On + c.Claim_Processed_On
        AS Claim_Processed_On_day_bucket
      FROM claims_one c LEFT JOIN policy_silver p ON c.PolicyID = p.policy_number""",
    "sales": f"""SELECT TRY_CAST({_fn('sales_id')} AS INTEGER) AS sales_id, {_fn('car_id')} AS car_id,
      try_strptime({_fn('ad_placed_on')}, '%d-%m-%Y %H:%M') AS ad_placed_on,
      try_strptime({_fn('sold_on')}, '%d-%m-%Y %H:%M') AS sold_on,
      TRY_CAST({_fn('original_selling_price')} AS INTEGER) AS original_selling_price,
      {_region(_initcap(_fn('Region')))} AS Region, {_initcap(_fn('State'))} AS State, {_initcap(_fn('City'))} AS City,
      {_initcap(_fn('seller_type'))} AS seller_type, {_initcap(_fn('owner'))} AS owner, _source_file FROM raw_sales""",
    "sales_silver": f"SELECT * FROM sales WHERE {OK['sales']}",
    "customers": f"""SELECT *, {" + ".join(_known.format(n) for n in ("Job", "Marital", "Education"))} AS score
      FROM (SELECT trim({_tok('CustomerID')}) AS CustomerID,
      {", ".join(f"{e} AS {n}" for n, e in _customer_texts.items())}, {_customer_ints}, _source_file, _loaded_at
      FROM raw_customers)""",
    "customers_silver": """SELECT * EXCLUDE (score) FROM customers QUALIFY row_number() OVER (PARTITION BY CustomerID
      ORDER BY score DESC, _loaded_at DESC, Region DESC NULLS LAST, State DESC NULLS LAST, City DESC NULLS LAST,
      Job DESC NULLS LAST, Marital DESC NULLS LAST, Education DESC NULLS LAST, "Default" DESC NULLS LAST,
      Balance DESC NULLS LAST, HHInsurance DESC NULLS LAST, CarLoan DESC NULLS LAST) = 1""",
    "customers_enforced": f"""SELECT * EXCLUDE (score) FROM customers WHERE {OK['customers']} QUALIFY row_number() OVER (
      PARTITION BY CustomerID ORDER BY score DESC, _loaded_at DESC) = 1""",
    "cars": f"""SELECT {_tok('car_id')} AS car_id, trim({_tok('name')}) AS name,
      {", ".join(f"{_initcap(f'trim({_tok(n)})')} AS {n}" for n in ("fuel", "transmission", "model"))},
      trim({_tok('torque')}) AS torque, TRY_CAST({_tok('km_driven')} AS INTEGER) AS km_driven,
      TRY_CAST({_tok('seats')} AS INTEGER) AS seats, {_unit('mileage', '([0-9.]+)', 'FLOAT')} AS mileage,
      {_unit('engine', '([0-9]+)', 'INTEGER')} AS engine, {_unit('max_power', '([0-9.]+)', 'FLOAT')} AS max_power,
      _source_file FROM raw_cars""",
    "cars_silver": f"SELECT * FROM cars WHERE {OK['cars']}",
    "facts": """SELECT c.ClaimID AS claim_id, c.PolicyID AS policy_id, p.customer_id, p.car_id,
      CAST(p.policy_bind_date AS DATE) + c.indicate_day_bucket AS incident_date,
      CAST(p.policy_bind_date AS DATE) + c.Claim_Logged_On_day_bucket AS claim_logged_on,
      CAST(p.policy_bind_date AS DATE) + c.Claim_Processed_On_day_bucket AS claim_processed_on,
      c.Claim_Rejected AS claim_rejected, c.incident_severity, c.incident_type, c.collision_type,
      CAST(c.injury AS DOUBLE) AS injury, CAST(c.property AS DOUBLE) AS property, CAST(c.vehicle AS DOUBLE) AS vehicle,
      c.number_of_vehicles_involved, c.bodily_injuries, c.witnesses, c.property_damage, c.police_report_available,
      CAST(date_diff('day', CAST(p.policy_bind_date AS DATE) + c.Claim_Logged_On_day_bucket,
        CAST(p.policy_bind_date AS DATE) + c.Claim_Processed_On_day_bucket) AS INTEGER) AS processing_time_days
      FROM claims_silver c LEFT JOIN policy_silver p ON c.PolicyID = p.policy_number""",
    "d_policy": "SELECT policy_number AS policy_id, * EXCLUDE (policy_number, _source_file) FROM policy_silver",
    "d_customer": """SELECT CustomerID AS customer_id, Region AS region, State AS state, City AS city, Job AS job,
      Marital AS marital, Education AS education, "Default" AS default_flag, Balance AS balance, HHInsurance, CarLoan
      FROM customers_silver""",
    "f_sales": """SELECT sales_id, car_id, ad_placed_on, sold_on, Region AS region, State AS state, City AS city,
      original_selling_price, seller_type, owner,
      CAST(date_diff('day', CAST(ad_placed_on AS DATE), DATE '2001-09-01') AS INTEGER) AS days_since_listing,
      CASE WHEN sold_on IS NULL THEN 0 ELSE 1 END AS is_sold FROM sales_silver""",
    "risk_base": """SELECT *, upper(trim(incident_severity)) AS sev, upper(trim(authorities_contacted)) AS auth,
      coalesce(CAST(injury AS DOUBLE), 0) AS il, coalesce(CAST(property AS DOUBLE), 0) AS pl,
      coalesce(CAST(vehicle AS DOUBLE), 0) AS vl, number_of_vehicles_involved AS nv, bodily_injuries AS nb,
      Claim_Logged_On_day_bucket - indicate_day_bucket AS report_delay_days,
      Claim_Processed_On_day_bucket - Claim_Logged_On_day_bucket AS processing_days,
      Claim_Processed_On_day_bucket - indicate_day_bucket AS claim_lifecycle_days,
      count(*) OVER (PARTITION BY PolicyID) AS policy_claim_count FROM claims_silver""",
    "risk_feat": """SELECT *, il + pl + vl AS total_loss_amount,
      coalesce(nv, 0) + coalesce(nb, 0) + CASE WHEN coalesce(witnesses, 0) > 0 THEN 1 ELSE 0 END
        + CASE WHEN il > 5000 THEN 1 ELSE 0 END + CASE WHEN pl > 2500 THEN 1 ELSE 0 END
        + CASE WHEN property_damage THEN 1 ELSE 0 END AS complexity_points,
      CASE WHEN auth IN ('POLICE', 'AMBULANCE', 'FIRE', 'OTHER') AND NOT police_report_available THEN 1 ELSE 0 END
        AS authority_report_mismatch,
      CASE WHEN sev IN ('MAJOR DAMAGE', 'SEVERE', 'HIGH', 'TOTAL LOSS') AND NOT police_report_available
        THEN 1 ELSE 0 END AS high_severity_no_police_report,
      CASE WHEN sev IN ('TRIVIAL DAMAGE', 'MINOR DAMAGE', 'LOW') THEN 1 WHEN sev IN ('MODERATE DAMAGE', 'MEDIUM') THEN 2
        WHEN sev IN ('MAJOR DAMAGE', 'HIGH') THEN 3 WHEN sev IN ('SEVERE', 'TOTAL LOSS', 'CRITICAL') THEN 4 END
        AS severity_rank FROM risk_base""",
    "risk_rule": """SELECT *,
      CASE WHEN report_delay_days > 30 OR indicate_day_bucket <= 3 THEN 1 ELSE 0 END AS rule_timing_anomaly,
      CASE WHEN processing_days > 21 THEN 1 ELSE 0 END AS rule_processing_delay,
      CASE WHEN complexity_points >= 5 OR nv >= 3 OR nb >= 2 THEN 1 ELSE 0 END AS rule_high_complexity,
      CASE WHEN authority_report_mismatch = 1 OR high_severity_no_police_report = 1 THEN 1 ELSE 0 END
        AS rule_documentation_mismatch,
      CASE WHEN Claim_Rejected THEN 1 ELSE 0 END AS rule_rejection_pattern,
      CASE WHEN (severity_rank IN (1, 2) AND (nv >= 3 OR nb >= 1 OR il > 5000 OR pl > 3000 OR vl > 10000))
        OR (severity_rank IN (3, 4) AND coalesce(nv, 0) <= 1 AND coalesce(nb, 0) = 0 AND il < 1000 AND pl < 500
        AND vl < 2500) THEN 1 ELSE 0 END AS rule_severity_mismatch FROM risk_feat""",
    "risk": """SELECT *, CASE WHEN anomaly_score >= 70 THEN 'HIGH' WHEN anomaly_score >= 45 THEN 'MEDIUM'
      WHEN anomaly_score >= 25 THEN 'LOW' ELSE 'NOT_FLAGGED' END AS priority_tier FROM (SELECT *,
      20 * rule_timing_anomaly + 15 * rule_processing_delay + 20 * rule_high_complexity + 15 * rule_documentation_mismatch
        + 10 * rule_rejection_pattern + 20 * rule_severity_mismatch AS raw_anomaly_points,
      round(CAST(raw_anomaly_points AS DOUBLE) / 100 * 100, 2) AS anomaly_score FROM risk_rule)""",
    "chunks": """SELECT doc_id, CAST(n AS INTEGER) AS chunk_no, substr(text, n * 320 + 1, 400) AS chunk_text FROM (
      SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / 320.0) AS BIGINT))) AS n FROM documents)""",
    "label_pairs": """SELECT m.label AS query_id, e.vec_id, e.label, round(list_dot_product(m.q, e.v)
      / (sqrt(list_dot_product(m.q, m.q)) * sqrt(list_dot_product(e.v, e.v))), 6) AS score,
      list_dot_product(m.q, e.v) / (sqrt(list_dot_product(m.q, m.q)) * sqrt(list_dot_product(e.v, e.v))) AS exact
      FROM (SELECT label, list(x ORDER BY i) AS q FROM (SELECT label, i, avg(v[i]) AS x FROM (
        SELECT label, CAST(embedding AS DOUBLE[]) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
        GROUP BY label, i) GROUP BY label) m
      CROSS JOIN (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) e""",
    "label_hits": """SELECT query_id, vec_id, label, score, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY round(exact, 12) DESC, vec_id) AS INTEGER) AS rank FROM label_pairs QUALIFY rank <= 5""",
    "ranked_chunks": """SELECT query_id, chunk_id, doc_id, chunk_text, round(exact, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY round(exact, 12) DESC, chunk_id) AS INTEGER) AS rank FROM (
      SELECT q.item_id AS query_id, c.chunk_id, c.doc_id, c.chunk_text, CASE WHEN c.norm = 0 OR q.norm = 0 THEN 0.0 ELSE
        list_dot_product(q.v, c.v) / (q.norm * c.norm) END AS exact
      FROM (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM benchmark_vectors) q
      CROSS JOIN (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM chunk_vectors) c) QUALIFY rank <= 10""",
}


def _hashed(e: str) -> str:
    return (
        "list_transform(range(64), lambda i: CAST(len(list_filter(list_transform("
        f"regexp_extract_all(lower({e}), '[a-z0-9]+'), "
        "lambda w: CAST('0x' || substr(md5(w), 1, 4) AS BIGINT) % 64), lambda p: p = i)) AS DOUBLE))"
    )


CTES["benchmark_vectors"] = f"SELECT item_id, text, {_hashed('text')} AS v FROM benchmark"
CTES["chunk_vectors"] = (
    "SELECT doc_id || ':' || chunk_no AS chunk_id, doc_id, chunk_text, "
    f"{_hashed('chunk_text')} AS v FROM chunks"
)

NEEDS = {
    "policy": ["raw_policy"],
    "policy_silver": ["policy"],
    "claims": ["raw_claims"],
    "claims_ok": ["claims"],
    "claims_one": ["claims_ok"],
    "claims_silver": ["claims_one", "policy_silver"],
    "sales": ["raw_sales"],
    "sales_silver": ["sales"],
    "customers": ["raw_customers"],
    "customers_silver": ["customers"],
    "customers_enforced": ["customers"],
    "cars": ["raw_cars"],
    "cars_silver": ["cars"],
    "facts": ["claims_silver"],
    "d_policy": ["policy_silver"],
    "d_customer": ["customers_silver"],
    "f_sales": ["sales_silver"],
    "risk_base": ["claims_silver"],
    "risk_feat": ["risk_base"],
    "risk_rule": ["risk_feat"],
    "risk": ["risk_rule"],
    "label_hits": ["label_pairs"],
    "chunk_vectors": ["chunks"],
    "ranked_chunks": ["benchmark_vectors", "chunk_vectors"],
}


def _sql(select: str, *ctes: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in order:
            order.append(name)

    for name in ctes:
        visit(name)
    head = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order)
    return f"WITH {head}\n{select}" if order else select


def _issues(name: str, key: str, cases: str, descriptions: str, levels: str) -> str:
    return _sql(
        f"SELECT '{name}' AS table_name, CASE {cases} END AS column_name, CASE {descriptions} END AS issue_description, "
        f"CASE {levels} END AS severity, CAST({key} AS VARCHAR) AS record_key FROM {name} WHERE NOT {OK[name]}",
        name,
    )


def _neg(c: str) -> str:
    return f"({c} IS NULL OR {c} < 0)"


_P = "policy_number IS NULL", "customer_id IS NULL", "car_id IS NULL", _neg("policy_deductable"), _neg("policy_annual_premium")
_C = (
    "ClaimID IS NULL", "PolicyID IS NULL", "incident_date = 0", T1, T2, T3, _neg("injury"), _neg("property"),
    _neg("vehicle"), "property_damage IS NULL",
)
_S = "sales_id IS NULL", "car_id IS NULL", _neg("original_selling_price")
_U = (
    "CustomerID IS NULL", _neg("Balance"),
    "(Marital IS NULL OR Marital NOT IN ('single', 'married', 'divorced', 'na'))",
    "(Education IS NULL OR Education NOT IN ('secondary', 'primary', 'na'))",
)
_R = "car_id IS NULL", "km_driven < 0"


def _case(conds, values, other: str) -> str:
    return " ".join(f"WHEN {c} THEN '{v}'" for c, v in zip(conds, values)) + f" ELSE '{other}'"


ISSUE_SQL = {
    "policy": _issues(
        "policy", "policy_number",
        _case(_P, ("policy_number", "customer_id", "car_id", "policy_deductable", "policy_annual_premium"), "umbrella_limit"),
        _case(
            _P,
            ("Missing or empty Policy ID", "Orphaned record: Missing customer_id link",
             "Orphaned record: Missing car_id link", "Financial Error: Negative or missing policy deductible",
             "Financial Error: Negative or missing annual premium"),
            "Financial Error: Negative or missing umbrella limit",
        ),
        _case(_P, ("4", "4", "4", "3", "3"), "3"),
    ),
    "claims": _issues(
        "claims", "ClaimID",
        _case(
            _C,
            ("ClaimID", "PolicyID", "incident_date", "Claim_Logged_On", "Claim_Logged_On", "Claim_Processed_On",
             "injury", "property", "vehicle", "property_damage"),
            "Multiple/Complex",
        ),
        _case(
            _C,
            ("Missing or empty Claim ID", "Orphaned record: Missing Policy ID",
             "Invalid metric: Incident date is 00:00.0 or missing",
             "Timeline Logic Error: Claim was processed but never logged",
             "Timeline Logic Error: Claim was logged after the incident date",
             "Timeline Logic Error: Processed date sequence is invalid against Logged/Incident date",
             "Financial Error: Injury cost is missing or negative",
             "Financial Error: Property cost is missing or negative",
             "Financial Error: Vehicle cost is missing or negative", "Missing Data: Property damage flag is null"),
            "Data Quality Rule Violation",
        ),
        "WHEN ClaimID IS NULL THEN '4' WHEN PolicyID IS NULL THEN '3' "
        "WHEN injury < 0 OR property < 0 OR vehicle < 0 THEN '3' ELSE '2'",
    ),
    "sales": _issues(
        "sales", "sales_id",
        _case(_S, ("sales_id", "car_id", "original_selling_price"), "Region"),
        _case(
            _S,
            ("Missing or empty Sales ID", "Orphaned record: Missing Car ID",
             "Invalid financial metric: Price is negative or missing"),
            "Invalid Region value (Must be East, West, Central, North or South)",
        ),
        _case(_S, ("4", "4", "4"), "2"),
    ),
    "customers": _issues(
        "customers", "CustomerID",
        _case(_U, ("CustomerID", "Balance", "Marital", "Education"), "Region"),
        _case(
            _U,
            ("Missing or empty Customer ID", "Negative or missing balance detected",
             "Invalid Marital status (Must be single, married, divorced, or na)",
             "Invalid Education value (Must be secondary, primary, or na)"),
            "Invalid Region value (Must be East, West, Central, North or South)",
        ),
        _case(_U, ("4", "3"), "2"),
    ),
    "cars": _issues(
        "cars", "car_id",
        _case(_R, ("car_id", "km_driven"), "mileage"),
        _case(
            _R, ("Missing or empty Car ID", "Invalid metric: Negative KM Driven detected"),
            "Invalid metric: Negative Mileage detected",
        ),
        _case(_R, ("4", "3"), "2"),
    ),
}

_claims_kpi = """count(*) AS total_claims, round(avg(injury + property + vehicle), 4) AS avg_claim_amount,
  round(sum(injury + property + vehicle), 4) AS total_claim_amount, round(avg(processing_time_days), 4) AS avg_processing_time,
  round(sum(CASE WHEN claim_rejected THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS rejection_rate,
  round(sum(CASE WHEN incident_severity = 'Major Damage' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4)
    AS major_severity_pct,
  round(avg(number_of_vehicles_involved), 4) AS avg_vehicles_involved, round(avg(bodily_injuries), 4) AS avg_bodily_injuries,
  round(sum(CASE WHEN police_report_available THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS police_report_pct"""
_policy_kpi = """count(DISTINCT d.policy_id) AS total_policies, round(avg(CAST(policy_annual_premium AS DOUBLE)), 4) AS avg_premium,
  CAST(sum(umbrella_limit) AS BIGINT) AS total_umbrella_coverage, round(avg(policy_deductable), 4) AS avg_deductible,
  round({hits} * 100.0::DOUBLE / count(DISTINCT d.policy_id), 4) AS policies_with_claim_pct"""
_customer_kpi = """count(DISTINCT d.customer_id) AS total_customers, round(avg(balance), 4) AS avg_balance,
  round(sum(CASE WHEN default_flag = 1 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS default_rate,
  round({share}, 4) AS claims_per_customer,
  round(sum(CASE WHEN CarLoan = 1 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS car_loan_pct,
  round(sum(CASE WHEN HHInsurance = 1 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS home_insurance_pct"""
_claim_raw = ("ClaimID", "PolicyID", "incident_date", "collision_type", "vehicle", "property_damage")
_policy_raw = (
    "policy_number", "customer_id", "car_id", "policy_bind_date", "policy_state", "policy_csl", "policy_deductable",
    "policy_annual_premium", "umbrella_limit", "_source_file",
)
_rule_view = "ClaimID, PolicyID, incident_date, Claim_Logged_On, Claim_Processed_On"
_confidence = """SELECT query_id, s AS confidence_score, CASE WHEN s >= 0.75 THEN 'HIGH' WHEN s >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END
  AS confidence_band, n AS unique_keys FROM (SELECT query_id, CAST(count(DISTINCT {key}) AS INTEGER) AS n,
  round(0.5 * avg(score) + 0.3 * max(score) + 0.2 * least(count(DISTINCT {key}) / 4.0::DOUBLE, 1.0), 4) AS s
  FROM {hits} GROUP BY query_id)"""
_sources = """SELECT query_id, string_agg(CAST({key} AS VARCHAR), ',' ORDER BY best) AS source_keys FROM (
  SELECT query_id, {key}, min(rank) AS best FROM {hits} GROUP BY query_id, {key}) GROUP BY query_id"""
_fired = " || ".join(
    f"CASE WHEN {rule} = 1 THEN '; {words}' ELSE '' END"
    for rule, words in (
        ("rule_timing_anomaly", "Delayed reporting or suspicious incident timing"),
        ("rule_processing_delay", "Delayed claim processing"),
        ("rule_high_complexity", "High complexity accident pattern"),
        ("rule_documentation_mismatch", "Police or authority documentation mismatch"),
        ("rule_rejection_pattern", "Claim rejection pattern"),
        ("rule_severity_mismatch", "Severity mismatch versus incident facts and amount exposure"),
    )
)
_true_false = "CASE WHEN {0} THEN 'True' WHEN NOT {0} THEN 'False' END AS {1}"
_EVENT_OK = "event_type IN ('view', 'click', 'purchase', 'signup') AND value >= 5"

CHECKS: dict[str, str] = {
    "null_tokens": _sql("SELECT " + ", ".join(f"{_claim_tok(n)} AS {n}" for n in _claim_raw) + " FROM raw_claims", "raw_claims"),
    "force_null": _sql("SELECT " + ", ".join(f"{_fn(n)} AS {n}" for n in _policy_raw) + " FROM raw_policy", "raw_policy"),
    "recode_region": _sql(f"SELECT sales_id, {_region(_initcap(_fn('Region')))} AS Region FROM raw_sales", "raw_sales"),
    "first_of_aliases": _sql("SELECT _source_file, CustomerID, Region, City FROM raw_customers", "raw_customers"),
    "token_bool": _sql(
        "SELECT ClaimID, Claim_Rejected AS rejected, police_report_available AS police_report, property_damage AS damage FROM claims",
        "claims",
    ),
    "offset_parse": _sql("SELECT ClaimID, Claim_Logged_On, Claim_Processed_On, incident_date FROM claims", "claims"),
    "unit_extract": _sql(
        f"SELECT {_tok('car_id')} AS car_id, {_unit('mileage', '([0-9.]+)', 'DOUBLE')} AS mileage, "
        f"{_unit('engine', '([0-9]+)', 'INTEGER')} AS engine, {_unit('max_power', '([0-9.]+)', 'DOUBLE')} AS max_power "
        "FROM raw_cars",
        "raw_cars",
    ),
    "custom_ts_parse": _sql(
        "SELECT sales_id, " + ", ".join(
            f"{_ts(f'try_strptime({_fn(n)}, {chr(39)}%d-%m-%Y %H:%M{chr(39)})')} AS {n}" for n in ("ad_placed_on", "sold_on")
        ) + " FROM raw_sales",
        "raw_sales",
    ),
    "string_columns_trim": _sql(
        "SELECT " + ", ".join(f"trim({_claim_tok(n)}) AS {n}" for n in _policy_raw)
        + f" FROM raw_policy WHERE ({_claim_tok('policy_number')}) IS NOT NULL",
        "raw_policy",
    ),
    "silver_policy": _sql(
        f"SELECT * REPLACE ({_ts('policy_bind_date')} AS policy_bind_date, "
        "CAST(policy_annual_premium AS DOUBLE) AS policy_annual_premium) FROM policy_silver",
        "policy_silver",
    ),
    "silver_claims": _sql(
        f"SELECT * REPLACE ({_ts('policy_bind_date')} AS policy_bind_date, CAST(injury AS DOUBLE) AS injury, "
        "CAST(property AS DOUBLE) AS property, CAST(vehicle AS DOUBLE) AS vehicle) FROM claims_silver",
        "claims_silver",
    ),
    "silver_sales": _sql(
        f"SELECT * REPLACE ({_ts('ad_placed_on')} AS ad_placed_on, {_ts('sold_on')} AS sold_on) FROM sales_silver",
        "sales_silver",
    ),
    "silver_cars": _sql(
        "SELECT * REPLACE (CAST(mileage AS DOUBLE) AS mileage, CAST(max_power AS DOUBLE) AS max_power) FROM cars_silver",
        "cars_silver",
    ),
    "silver_customers": _sql(f"SELECT * REPLACE ({_ts('_loaded_at')} AS _loaded_at) FROM customers_silver", "customers_silver"),
    "silver_customers_enforced": _sql(
        f"SELECT * REPLACE ({_ts('_loaded_at')} AS _loaded_at) FROM customers_enforced", "customers_enforced"
    ),
    "rules_valid": _sql(f"SELECT {_rule_view} FROM claims WHERE {OK['claims']}", "claims"),
    "rules_valid_stored": f"SELECT event_id, event_type FROM events WHERE {_EVENT_OK}",
    "rules_quarantine": _sql(f"SELECT {_rule_view} FROM claims WHERE NOT {OK['claims']}", "claims"),
    "rules_quarantine_literal": _sql(
        "SELECT CustomerID, Region, Balance, Marital, Education, _source_file FROM customers WHERE CustomerID IS NULL "
        f"OR NOT ({REGION_OK}) OR NOT (Balance >= 0) OR NOT (Marital IN ('single', 'married', 'divorced', 'na')) "
        "OR NOT (Education IN ('secondary', 'primary', 'na'))",
        "customers",
    ),
    "rules_measure": _sql(
        " UNION ALL ".join(
            f"SELECT '{n}' AS rule, count(*) AS rows_seen, count(*) FILTER (NOT coalesce({r}, false)) AS violations FROM claims"
            for n, r in CLAIM_CHECKS.items()
        ),
        "claims",
    ),
    "timeline_rules": _sql(f"SELECT ClaimID, {T1} AS t1, {T2} AS t2, {T3} AS t3 FROM claims", "claims"),
    **{f"issues_{n}": sql for n, sql in ISSUE_SQL.items()},
    "issue_rollup": "SELECT table_name, column_name, issue_description, severity, count(*) AS issues FROM ("
    + " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in ISSUE_SQL.values())
    + ") GROUP BY ALL",
    "dq_explain": "SELECT table_name, column_name, severity, issue_description, CAST(NULL AS VARCHAR) AS rule_name, "
    "CAST(NULL AS VARCHAR) AS affected_ratio, CAST(NULL AS VARCHAR) AS suggested_fix, "
    "'Reviewed.' AS ai_generated_explanation, 'local' AS model_name, 'SUCCESS' AS generation_status, "
    f"CAST(NULL AS VARCHAR) AS error_message FROM ({ISSUE_SQL['sales']})",
    "dedup_first": "SELECT * EXCLUDE (l_shipdate) FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, "
    "l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) = 1",
    "dedup_count": "SELECT count(*) AS rows_kept FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
    "completeness": _sql("SELECT CustomerID, _source_file, score AS completeness_score FROM customers", "customers"),
    "upsert_latest": "SELECT user_id, event_id, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "fact_claims": _sql(
        "SELECT * REPLACE (CAST(incident_date AS VARCHAR) AS incident_date, CAST(claim_logged_on AS VARCHAR) AS claim_logged_on, "
        "CAST(claim_processed_on AS VARCHAR) AS claim_processed_on) FROM facts",
        "facts",
    ),
    "dim_policy": _sql(
        f"SELECT * REPLACE ({_ts('policy_bind_date')} AS policy_bind_date, "
        "CAST(policy_annual_premium AS DOUBLE) AS policy_annual_premium) FROM d_policy",
        "d_policy",
    ),
    "dim_customer": _sql("SELECT * FROM d_customer", "d_customer"),
    "dim_car": _sql(
        "SELECT * EXCLUDE (_source_file) REPLACE (CAST(mileage AS DOUBLE) AS mileage, CAST(max_power AS DOUBLE) AS max_power) "
        "FROM cars_silver",
        "cars_silver",
    ),
    "fact_sales_asof": _sql(
        f"SELECT * REPLACE ({_ts('ad_placed_on')} AS ad_placed_on, {_ts('sold_on')} AS sold_on) FROM f_sales", "f_sales"
    ),
    "customer_identity": _sql(
        "SELECT region, count(customer_id) AS total_unique_customers, round(avg(balance), 2) AS average_account_balance "
        "FROM d_customer GROUP BY region",
        "d_customer",
    ),
    "claim_performance": _sql(
        "SELECT c.region, p.policy_csl AS policy_type, count(f.claim_id) AS total_claims, "
        "round(avg(f.processing_time_days), 1) AS avg_processing_days, "
        "round(sum(CASE WHEN f.claim_rejected THEN 1 ELSE 0 END)::DOUBLE / count(f.claim_id) * 100, 2) AS rejection_rate_percent, "
        "sum(f.vehicle + f.property + f.injury) AS total_claim_financial_value FROM facts f "
        "LEFT JOIN d_customer c ON f.customer_id = c.customer_id LEFT JOIN d_policy p ON f.policy_id = p.policy_id "
        "GROUP BY c.region, p.policy_csl",
        "facts", "d_customer", "d_policy",
    ),
    "inventory_status": _sql(
        "SELECT s.region, c.model, count(s.sales_id) AS aging_unsold_cars, "
        "CAST(sum(s.original_selling_price) AS BIGINT) AS locked_revenue_at_risk, max(s.days_since_listing) AS max_days_on_market "
        "FROM f_sales s LEFT JOIN cars_silver c ON s.car_id = c.car_id WHERE s.is_sold = 0 AND s.days_since_listing > 60 "
        "GROUP BY s.region, c.model",
        "f_sales", "cars_silver",
    ),
    "kpi_claims": _sql(f"SELECT {_claims_kpi} FROM facts", "facts"),
    "kpi_json": _sql(f"SELECT {_claims_kpi} FROM facts", "facts"),
    "kpi_policy": _sql(
        f"SELECT {_policy_kpi.format(hits='count(claim_id)')} FROM d_policy d LEFT JOIN facts f ON d.policy_id = f.policy_id",
        "d_policy", "facts",
    ),
    "kpi_policy_exact": _sql(
        f"SELECT {_policy_kpi.format(hits='count(f.policy_id)')} FROM d_policy d "
        "LEFT JOIN (SELECT DISTINCT policy_id FROM facts) f ON d.policy_id = f.policy_id",
        "d_policy", "facts",
    ),
    "kpi_customer": _sql(
        f"SELECT {_customer_kpi.format(share='avg(CASE WHEN claim_id IS NOT NULL THEN 1 ELSE 0 END)')} "
        "FROM d_customer d LEFT JOIN facts f ON d.customer_id = f.customer_id",
        "d_customer", "facts",
    ),
    "kpi_customer_exact": _sql(
        f"SELECT {_customer_kpi.format(share='sum(coalesce(f.n, 0))::DOUBLE / count(*)')} FROM d_customer d "
        "LEFT JOIN (SELECT customer_id, count(claim_id) AS n FROM facts GROUP BY customer_id) f ON d.customer_id = f.customer_id",
        "d_customer", "facts",
    ),
    "kpi_union": _sql(
        "SELECT 'claims_performance' AS domain_name, (SELECT count(*) FROM facts) AS total UNION ALL "
        "SELECT 'policy_portfolio', (SELECT count(DISTINCT policy_id) FROM d_policy) UNION ALL "
        "SELECT 'customer_profile', (SELECT count(DISTINCT customer_id) FROM d_customer)",
        "facts", "d_policy", "d_customer",
    ),
    "kpi_summaries": "SELECT domain_name, summary_title, 'Reviewed.' AS executive_summary, 'local' AS model_name, "
    "'SUCCESS' AS status FROM (VALUES ('claims_performance', 'Claims Performance Overview'), "
    "('policy_portfolio', 'Policy Portfolio Overview'), ('customer_profile', 'Customer Profile Overview')) "
    "v(domain_name, summary_title)",
    "avg_amount_text": _sql("SELECT CAST(avg(injury + property + vehicle) AS VARCHAR) AS avg_claim_amount FROM facts", "facts"),
    "explain_amount": _sql(
        "SELECT 'What does this mean for the business? Average claim amount: ' "
        "|| CAST(avg(injury + property + vehicle) AS VARCHAR) AS question, 'Reviewed.' AS explanation, "
        "'SUCCESS' AS generation_status FROM facts",
        "facts",
    ),
    "summary_table": _sql(
        "SELECT 'customer_profile' AS domain_name, 'Customer Profile Overview' AS summary_title, "
        "'Reviewed.' AS executive_summary, count(customer_id) AS total_customers FROM d_customer",
        "d_customer",
    ),
    "policy_claim_count": _sql(
        "SELECT ClaimID, PolicyID, count(*) OVER (PARTITION BY PolicyID) AS policy_claim_count FROM claims", "claims"
    ),
    "risk_features": _sql(
        "SELECT ClaimID, report_delay_days, processing_days, claim_lifecycle_days, total_loss_amount, complexity_points, "
        "authority_report_mismatch, high_severity_no_police_report, severity_rank, policy_claim_count FROM risk_feat",
        "risk_feat",
    ),
    "risk_rules": _sql(
        "SELECT ClaimID, rule_timing_anomaly, rule_processing_delay, rule_high_complexity, rule_documentation_mismatch, "
        "rule_rejection_pattern, rule_severity_mismatch FROM risk_rule",
        "risk_rule",
    ),
    "risk_score": _sql("SELECT ClaimID, raw_anomaly_points, anomaly_score, priority_tier FROM risk", "risk"),
    "risk_tier_counts": _sql("SELECT priority_tier, count(*) AS claims FROM risk GROUP BY priority_tier", "risk"),
    "risk_fired": _sql(f"SELECT ClaimID, substr({_fired}, 3) AS triggered_rules FROM risk", "risk"),
    "risk_flagged": _sql("SELECT ClaimID, anomaly_score FROM risk WHERE anomaly_score >= 45", "risk"),
    "risk_flag_summary": _sql(
        "SELECT count(*) AS total_claims, count(*) FILTER (anomaly_score >= 45) AS flagged_claims, "
        "round(count(*) FILTER (anomaly_score >= 45) * 100.0::DOUBLE / count(*), 2) AS flagged_pct FROM risk",
        "risk",
    ),
    "risk_report": _sql(
        "SELECT ClaimID AS claim_id, PolicyID AS policy_id, CAST(Claim_Logged_On AS VARCHAR) AS claim_logged_on_raw, "
        "CAST(Claim_Processed_On AS VARCHAR) AS claim_processed_on_raw, CAST(incident_date AS VARCHAR) AS incident_date_raw, "
        "Claim_Logged_On_day_bucket AS claim_logged_on_day_bucket, "
        "Claim_Processed_On_day_bucket AS claim_processed_on_day_bucket, indicate_day_bucket AS incident_date_day_bucket, "
        + _true_false.format("Claim_Rejected", "claim_rejected")
        + ", incident_state, incident_city, incident_location, incident_type, collision_type, incident_severity, "
        "authorities_contacted, " + _true_false.format("police_report_available", "police_report_available")
        + ", number_of_vehicles_involved, bodily_injuries, witnesses, CAST(injury AS DOUBLE) AS injury_amount, "
        "CAST(property AS DOUBLE) AS property_amount, CAST(vehicle AS DOUBLE) AS vehicle_amount, total_loss_amount, "
        + _true_false.format("property_damage", "property_damage")
        + f", {_ts('policy_bind_date')} AS policy_bind_date, anomaly_score, priority_tier, report_delay_days, processing_days, "
        "claim_lifecycle_days, CAST(policy_claim_count AS INTEGER) AS policy_claim_count, complexity_points, "
        "authority_report_mismatch, high_severity_no_police_report, rule_timing_anomaly + rule_processing_delay "
        "+ rule_high_complexity + rule_documentation_mismatch + rule_rejection_pattern + rule_severity_mismatch AS rules_fired, "
        "'Reviewed.' AS ai_investigation_brief, 'local' AS model_name, 'SUCCESS' AS generation_status FROM risk",
        "risk",
    ),
    "risk_top": _sql(
        "SELECT ClaimID AS claim_id, anomaly_score, priority_tier FROM risk ORDER BY anomaly_score DESC, claim_id LIMIT 3", "risk"
    ),
    "doc_render": _sql(
        "SELECT policy_id, concat_ws(' ', 'Policy ' || policy_id || '.', "
        f"'Policy bind date is ' || {_ts('policy_bind_date')} || '.', 'Policy state is ' || policy_state || '.', "
        "'Combined single limit is ' || policy_csl || '.', 'Policy deductible is ' || policy_deductable || '.', "
        "'Annual premium is ' || CAST(floor(policy_annual_premium) AS BIGINT) || '.', 'Umbrella limit is ' || umbrella_limit || '.') "
        "AS document_text FROM d_policy",
        "d_policy",
    ),
    "doc_chunks": _sql(
        "SELECT doc_id, chunk_no, CAST(length(chunk_text) AS INTEGER) AS chars, md5(chunk_text) AS digest FROM chunks", "chunks"
    ),
    "doc_chunks_trimmed": _sql(
        "SELECT doc_id, count(*) AS chunks, CAST(sum(length(chunk_text)) AS BIGINT) AS chars FROM chunks "
        "WHERE chunk_no = 0 OR length(chunk_text) > 80 GROUP BY doc_id",
        "chunks",
    ),
    "embed_hash": "SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(count(*) AS DOUBLE) AS words FROM ("
    "SELECT doc_id, CAST('0x' || substr(md5(w), 1, 4) AS BIGINT) % 64 AS place FROM ("
    "SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents)) GROUP BY doc_id, place",
    "knn_topk": _sql("SELECT query_id, vec_id, label, score, rank FROM label_hits", "label_hits"),
    "knn_all_pairs": "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) "
    "SELECT query_id, vec_id, score, CAST(2 AS BIGINT) AS copies FROM (SELECT a.vec_id AS query_id, b.vec_id, "
    "list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS exact, "
    "round(exact, 6) AS score FROM v a CROSS JOIN v b) "
    "QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(exact, 12) DESC, vec_id) <= 3",
    "knn_confidence": _sql(_confidence.format(key="label", hits="label_hits"), "label_hits"),
    "knn_sources": _sql(_sources.format(key="label", hits="label_hits"), "label_hits"),
    "knn_chunks": _sql(
        "SELECT query_id, chunk_id, doc_id, score, rank FROM ranked_chunks WHERE rank <= 5", "ranked_chunks"
    ),
    "rag_context": _sql(
        "SELECT query_id, string_agg('[Source ' || rank || '] Policy ID: ' || doc_id || chr(10) || chunk_text, "
        "chr(10) || chr(10) ORDER BY rank) AS context FROM ranked_chunks WHERE rank <= 5 GROUP BY query_id",
        "ranked_chunks",
    ),
    "rag_history": _sql(
        "SELECT b.text AS question, 'Found 10 records' AS answer, c.confidence_score, c.confidence_band, "
        "c.unique_keys AS unique_policies_retrieved, s.source_keys AS source_policies FROM benchmark b "
        f"JOIN ({_confidence.format(key='doc_id', hits='ranked_chunks')}) c ON b.item_id = c.query_id "
        f"JOIN ({_sources.format(key='doc_id', hits='ranked_chunks')}) s ON b.item_id = s.query_id",
        "ranked_chunks",
    ),
    "prompt_build": "SELECT conv_id, turn, 'Turn ' || turn || ' by ' || role || ':' || chr(10) || text || chr(10) AS prompt "
    "FROM conversations",
    "reply_text": "SELECT conv_id, turn, CASE WHEN role <> 'system' THEN trim(text) END AS reply FROM conversations",
    "infer_status": "SELECT conv_id, turn, CASE role WHEN 'assistant' THEN CAST(length(text) AS VARCHAR) "
    "WHEN 'user' THEN length(text) || ' characters' END AS reply_text, "
    "CASE role WHEN 'system' THEN 'FAILED' ELSE 'SUCCESS' END AS generation_status, "
    "CASE role WHEN 'system' THEN 'not allowed' END AS error_message FROM conversations",
    "drifting_csv": "SELECT c_custkey AS customer_id, c_mktsegment AS region, c_acctbal AS balance, "
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_nationkey END AS tier FROM customer",
    "csv_groups": "SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS region, c_acctbal AS balance, "
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(c_nationkey AS VARCHAR) END AS tier FROM customer",
    "csv_ingest": "SELECT '_source_file_present' AS rule, count(*) AS rows_seen, 0 AS violations FROM part UNION ALL "
    "SELECT 'p_size - 10_non_negative', count(*), count(*) FILTER (p_size < 10) FROM part",
    "json_rescue": "SELECT CASE WHEN event_type <> 'signup' THEN event_id END AS event_id, "
    "CASE WHEN event_type <> 'signup' THEN user_id END AS user_id, "
    "CASE WHEN event_type NOT IN ('signup', 'error') THEN value END AS value, "
    "CASE event_type WHEN 'error' THEN '{\"event_type\":\"error\",\"value\":\"n/a\"}' "
    "WHEN 'signup' THEN 'not json ' || event_id ELSE '{\"event_type\":\"' || event_type || '\"}' END AS rescued FROM events",
    "issue_record": "SELECT 'events' AS table_name, CASE event_type WHEN 'error' THEN 'event_type' ELSE 'value' END AS column_name, "
    "CASE event_type WHEN 'error' THEN '3' ELSE '2' END AS severity, "
    "'{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"event_type\":\"' || event_type || '\",\"value\":null}' "
    "AS affected_record FROM events WHERE NOT value >= 5",
    "observed_counts": "SELECT 'rows_seen' AS measure, count(*) AS n FROM lineitem UNION ALL "
    "SELECT 'big', count(*) FILTER (l_quantity < 25) FROM lineitem UNION ALL "
    "SELECT 'taxed', count(*) FILTER (l_tax <= 0) FROM lineitem",
    "temp_view": "SELECT user_id, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY user_id",
    "infer_all_statuses": "SELECT conv_id, turn, CASE length(text) % 4 WHEN 3 THEN CAST(length(text) AS VARCHAR) END AS reply_text, "
    "CASE length(text) % 4 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'EMPTY' WHEN 2 THEN 'PARSE_ERROR' ELSE 'SUCCESS' END AS generation_status, "
    "CASE length(text) % 4 WHEN 0 THEN 'not allowed' WHEN 2 THEN 'reply is not valid JSON' END AS error_message FROM conversations",
    "infer_retry": "SELECT conv_id, turn, 'ok ' || conv_id || ' ' || turn || ' ' || role AS reply_text, "
    "'SUCCESS' AS generation_status, CAST(NULL AS VARCHAR) AS error_message FROM conversations",
    "bronze_text_keys": "SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber AS ClaimID, "
    "lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS PolicyID, '2020-01-01' AS bound FROM lineitem",
    "bronze_claims_rescue": "SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS ClaimID, "
    "CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS PolicyID, "
    "CASE event_type WHEN 'error' THEN 'broken ' || event_id WHEN 'click' THEN '{\"surprise\":\"x\"}' END AS rescued FROM events",
    "stream_rules": f"SELECT event_id, CASE WHEN {_EVENT_OK} THEN 'kept' WHEN event_type = 'error' THEN 'event_type' "
    "ELSE 'value' END AS went_to FROM events",
    "stream_dedup": "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER ("
    "PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
    "stream_static_join": "SELECT event_id, user_id, c_mktsegment AS segment FROM events LEFT JOIN customer ON user_id = c_custkey",
    "stream_upsert": "SELECT user_id, event_id, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "stream_dedup_batches": "SELECT DISTINCT user_id, event_type, CAST(1 AS BIGINT) AS rows FROM events",
    "stream_aggregate": "SELECT user_id, count(event_id) AS events, count(*) FILTER (event_type = 'purchase') AS purchases, "
    "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS spent, min(event_id) AS first_event, max(event_id) AS last_event, "
    "round(sum(CAST(round(value * 100) AS BIGINT)) / count(event_id), 6) AS mean_spent FROM events GROUP BY user_id",
    "stream_multi_flow": "SELECT event_type AS flow, event_type, count(*) AS events FROM events GROUP BY event_type",
    "stream_ingest": "SELECT s_suppkey, s_name, s_acctbal, true AS has_lineage FROM supplier",
}
CHECKS["pipeline_stream"] = CHECKS["claim_performance"]
CHECKS["late_policies"] = CHECKS["claim_performance"]
for _name in ("stream_upsert_batches", "stream_state_upsert"):
    CHECKS[_name] = CHECKS["stream_upsert"]
CHECKS["infer_kept"] = CHECKS["infer_status"]
CHECKS["evolving_csv"] = CHECKS["drifting_csv"]
CHECKS["schema_versions"] = (
    "SELECT * FROM (VALUES ('CustomerID', CAST(0 AS BIGINT), 'int'), ('Region', 0, 'string'), ('Balance', 0, 'double'), "
    "('Tier', 2, 'int')) AS t(name, first_batch, type)"
)
CHECKS["stream_observed_counts"] = (
    "SELECT r.rule, count(*) AS rows_seen, count(*) FILTER (CASE r.rule WHEN 'value_floor' THEN coalesce(value < 5, true) "
    "ELSE coalesce(event_type NOT IN ('view', 'click', 'purchase', 'signup'), true) END) AS violations, count(*) AS rows_kept "
    "FROM events, (VALUES ('event_type_listed'), ('value_floor')) AS r(rule) GROUP BY r.rule"
)

_TFIDF = r"""
    WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS word FROM documents),
    c AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY ALL),
    m AS (SELECT word, ln((1.0 + (SELECT count(*) FROM documents)::DOUBLE) / (1.0 + count(*)::DOUBLE)) + 1.0 AS idf FROM c GROUP BY word),
    r AS (SELECT doc_id, word, n * idf AS x FROM c JOIN m USING (word)),
    d AS (SELECT doc_id, word, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS weight FROM r)
"""
CHECKS["embed_tfidf"] = _TFIDF + "SELECT doc_id, word, round(weight, 6) AS weight FROM d"
CHECKS["knn_tfidf"] = _TFIDF + r""",
    qw AS (SELECT item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS word FROM benchmark),
    qc AS (SELECT item_id, word, count(*) AS n FROM qw GROUP BY ALL),
    qr AS (SELECT item_id, word, n * idf AS x FROM qc JOIN m USING (word)),
    q AS (SELECT item_id, word, x / sqrt(sum(x * x) OVER (PARTITION BY item_id)) AS weight FROM qr),
    s AS (SELECT q.item_id AS query_id, d.doc_id, sum(q.weight * d.weight) AS score FROM q JOIN d USING (word) GROUP BY ALL)
    SELECT query_id, doc_id, round(score, 6) AS score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, doc_id) AS INTEGER) AS rank
    FROM s QUALIFY rank <= """ + str(presets.TOP_K)
CHECKS["kpi_union_figures"] = _sql(
    " UNION ALL ".join(
        f"SELECT '{domain}' AS domain_name, figure, value FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM ({one})) ON COLUMNS(*) INTO NAME figure VALUE value)"
        for domain, one in (
            ("claims_performance", f"SELECT {_claims_kpi} FROM facts"),
            ("policy_portfolio", f"SELECT {_policy_kpi.format(hits='count(claim_id)')} FROM d_policy d LEFT JOIN facts f ON d.policy_id = f.policy_id"),
            (
                "customer_profile",
                f"SELECT {_customer_kpi.format(share='avg(CASE WHEN claim_id IS NOT NULL THEN 1 ELSE 0 END)')} "
                "FROM d_customer d LEFT JOIN facts f ON d.customer_id = f.customer_id",
            ),
        )
    ),
    "facts", "d_policy", "d_customer",
)
CHECKS["dq_explain_capped"] = "SELECT CAST(7 AS BIGINT) AS reports"
CHECKS["glob_class"] = "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 < 2"
CHECKS["overwrite_schema"] = "SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey"
CHECKS["newest_first"] = (
    "SELECT row_number() OVER (ORDER BY ts DESC) - 1 AS place, event_id "
    "FROM (SELECT ts, max(event_id) AS event_id FROM events GROUP BY ts ORDER BY ts DESC LIMIT 50)"
)
CHECKS["vector_ops"] = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x FROM embeddings),
    n AS (SELECT vec_id, x[1] AS first, sqrt(list_sum(list_transform(x, lambda e: e * e))) AS norm FROM v)
    SELECT vec_id, CASE WHEN norm > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length, round(norm, 4) AS norm, round(CASE WHEN norm > 0 THEN first / norm ELSE first END, 6) AS first
    FROM n
"""
