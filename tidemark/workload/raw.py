"""Raw insurance inputs derived from the given tables, dirty values included.

Each is one SELECT over whole tables, written so that Spark and the checking engine read
it alike. Dirt comes from the data's own values: null tokens, codes, units, bad numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import read_table

_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_DAY_MONTH_YEAR = f"SUBSTR({_DAY}, 9, 2) || '-' || SUBSTR({_DAY}, 6, 2) || '-' || SUBSTR({_DAY}, 1, 4)"
_LATER = "CAST(CAST(o_orderdate + INTERVAL '30' DAY AS DATE) AS STRING)"
_LATER_DMY = f"SUBSTR({_LATER}, 9, 2) || '-' || SUBSTR({_LATER}, 6, 2) || '-' || SUBSTR({_LATER}, 1, 4)"

POLICY = f"""
SELECT
  CASE WHEN o_orderstatus = 'P' AND o_totalprice < 20000 THEN ' NULL '
       ELSE ' ' || CAST(o_orderkey AS STRING) || ' ' END AS policy_number,
  CASE WHEN o_totalprice < 5000 THEN 'none' ELSE CAST(o_custkey AS STRING) END AS customer_id,
  CASE WHEN o_totalprice > 499500 THEN '' ELSE CAST(o_custkey AS STRING) END AS car_id,
  CASE WHEN o_totalprice < 9000 THEN 'unknown' ELSE {_DAY} END AS policy_bind_date,
  CASE o_orderstatus WHEN 'F' THEN 'oh' WHEN 'O' THEN ' il ' ELSE 'sc' END AS policy_state,
  ' ' || o_orderpriority AS policy_csl,
  CASE WHEN o_totalprice > 498000 THEN '-1' WHEN o_orderpriority = '1-URGENT' THEN '500'
       WHEN o_orderpriority = '2-HIGH' THEN '1000' ELSE ' 2000 ' END AS policy_deductable,
  CASE WHEN o_totalprice > 496000 THEN 'NaN'
       ELSE CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING) END AS policy_annual_premium,
  CASE WHEN o_orderstatus = 'F' THEN '0' WHEN o_orderstatus = 'O' THEN '5000000'
       WHEN o_totalprice > 490000 THEN 'lots' ELSE '1000000' END AS umbrella_limit,
  'orders' AS _source_file
FROM {{orders}}
"""

CLAIMS = """
SELECT
  CASE WHEN l_quantity >= 50 AND l_tax = 0 THEN 'NULL'
       ELSE CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS ClaimID,
  CASE WHEN l_extendedprice > 104000 THEN '?' ELSE CAST(l_orderkey AS STRING) END AS PolicyID,
  CASE WHEN l_discount = 0.05 THEN 'null' ELSE CAST(l_linenumber - 1 AS STRING) || ':15.0' END AS Claim_Logged_On,
  CASE WHEN l_discount = 0.05 THEN '' WHEN l_tax > 0.06 THEN CAST(l_linenumber + 25 AS STRING) || ':45.0'
       ELSE CAST(l_linenumber - 1 AS STRING) || ':45.0' END AS Claim_Processed_On,
  CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN 'N' ELSE CASE WHEN l_linestatus = 'F' THEN 'U' ELSE 'N' END
       END AS Claim_Rejected,
  CASE WHEN l_returnflag = 'N' AND l_discount = 0 THEN '?' WHEN l_returnflag = 'A' AND l_discount = 0.1 THEN 'xx:10'
       ELSE CAST(CAST(FLOOR(l_quantity / 2) AS INT) AS STRING) || ':30.0' END AS incident_date,
  CASE l_linestatus WHEN 'F' THEN ' ny ' ELSE 'sc' END AS incident_state,
  CASE l_returnflag WHEN 'A' THEN ' arlington' WHEN 'R' THEN 'COLUMBUS' ELSE 'hillsdale heights' END AS incident_city,
  'road ' || CAST(l_suppkey AS STRING) AS incident_location,
  CASE WHEN l_linenumber < 4 THEN 'multi-vehicle collision' ELSE 'parked car' END AS incident_type,
  CASE WHEN l_linenumber < 4 THEN 'REAR collision' ELSE '?' END AS collision_type,
  CASE WHEN l_linenumber < 3 THEN 'major damage' WHEN l_linenumber < 5 THEN ' Minor Damage'
       WHEN l_linenumber < 6 THEN 'TOTAL LOSS' WHEN l_linenumber < 7 THEN 'trivial damage'
       ELSE 'unheard of' END AS incident_severity,
  CASE WHEN l_discount < 0.03 THEN 'police' WHEN l_discount < 0.06 THEN 'None' WHEN l_discount < 0.08 THEN 'FIRE'
       ELSE 'ambulance' END AS authorities_contacted,
  CASE WHEN l_tax < 0.03 THEN 'YES' WHEN l_tax < 0.06 THEN 'NO' ELSE '?' END AS police_report_available,
  CASE WHEN l_linenumber > 5 THEN '3' WHEN l_linenumber > 3 THEN '2' ELSE '1' END AS number_of_vehicles_involved,
  CASE WHEN l_discount > 0.08 THEN '2' WHEN l_discount > 0.04 THEN '1' ELSE '0' END AS bodily_injuries,
  CASE WHEN l_tax > 0.04 THEN '2' WHEN l_tax > 0.03 THEN 'few' ELSE '0' END AS witnesses,
  CASE WHEN l_extendedprice < 1200 THEN '-5'
       ELSE CAST(CAST(FLOOR(l_extendedprice / 10) AS BIGINT) AS STRING) || '.50' END AS injury,
  CASE WHEN l_quantity = 13 AND l_tax = 0.08 THEN 'n/a'
       ELSE CAST(CAST(FLOOR(l_extendedprice / 20) AS BIGINT) AS STRING) || '.25' END AS property,
  CASE WHEN l_quantity = 17 AND l_tax = 0.08 THEN ''
       ELSE CAST(CAST(FLOOR(l_extendedprice / 8) AS BIGINT) AS STRING) || '.75' END AS vehicle,
  CASE WHEN l_quantity = 19 THEN '?' WHEN l_linestatus = 'O' THEN 'YES' ELSE 'NO' END AS property_damage,
  'lineitem' AS _source_file
FROM {lineitem}
"""

SALES = f"""
SELECT
  CASE WHEN o_totalprice < 3000 THEN 'None' ELSE CAST(o_orderkey AS STRING) END AS sales_id,
  CASE WHEN o_totalprice > 498500 THEN ' ' ELSE ' ' || CAST(o_custkey AS STRING) END AS car_id,
  CASE WHEN o_totalprice < 8000 THEN {_DAY} ELSE {_DAY_MONTH_YEAR} || ' 10:30' END AS ad_placed_on,
  CASE WHEN o_orderstatus = 'F' THEN {_LATER_DMY} || ' 18:05' WHEN o_orderstatus = 'O' THEN 'null'
       ELSE '' END AS sold_on,
  CASE WHEN o_totalprice < 4000 THEN '-1' WHEN o_totalprice > 497000 THEN 'call us'
       ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS STRING) END AS original_selling_price,
  CASE o_orderpriority WHEN '1-URGENT' THEN ' w' WHEN '2-HIGH' THEN 'EAST' WHEN '3-MEDIUM' THEN 'Central'
       WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'P' THEN 'nan' ELSE 's' END
       ELSE CASE WHEN o_orderstatus = 'P' THEN 'Northwest' ELSE 'north' END END AS Region,
  CASE o_orderstatus WHEN 'F' THEN 'texas ' ELSE 'ohio' END AS State,
  'town ' || CAST(o_custkey AS STRING) AS City,
  CASE WHEN o_totalprice < 100000 THEN 'dealer' ELSE 'INDIVIDUAL' END AS seller_type,
  'first owner' AS owner,
  'orders' AS _source_file
FROM {{orders}}
"""

CARS = """
SELECT
  CASE WHEN p_size = 50 AND p_type = 'PROMO' THEN 'NULL' ELSE CAST(p_partkey AS STRING) END AS car_id,
  ' ' || p_name AS name,
  lower(p_type) AS fuel,
  CASE WHEN p_size < 25 THEN 'MANUAL ' ELSE 'automatic' END AS transmission,
  ' ' || p_brand AS model,
  CAST(p_size AS STRING) || 'Nm@ 2000rpm ' AS torque,
  CASE WHEN p_size = 2 THEN 'many' ELSE CAST(p_size * 1000 - 1500 AS STRING) END AS km_driven,
  CASE WHEN p_size = 7 THEN '' ELSE '5' END AS seats,
  CASE WHEN p_size = 3 THEN 'no data' ELSE CAST(p_size AS STRING) || '.5 kmpl' END AS mileage,
  CASE WHEN p_size = 4 THEN 'CC' ELSE CAST(CAST(FLOOR(p_retailprice) AS INT) AS STRING) || ' CC' END AS engine,
  CASE WHEN p_size = 5 THEN 'null' ELSE CAST(p_size AS STRING) || '.25 bhp' END AS max_power,
  'part' AS _source_file
FROM {part}
"""

_CUSTOMER_LOAD = """
SELECT
  CASE WHEN c_acctbal > 9900 THEN 'NULL' ELSE ' ' || CAST(c_custkey AS STRING) END AS CustomerID,
  CASE r_name WHEN 'AFRICA' THEN 'E' WHEN 'AMERICA' THEN 'west' WHEN 'ASIA' THEN ' C' WHEN 'EUROPE' THEN
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Northwest' ELSE 'n' END ELSE 'South' END AS Region,
  lower(n_name) AS State,
  'town of ' || lower(c_mktsegment) AS City,
  {job} AS Job,
  CASE WHEN c_nationkey < 8 THEN 'Single' WHEN c_nationkey < 16 THEN ' MARRIED' WHEN c_nationkey < 20 THEN 'divorced'
       WHEN c_nationkey < 22 THEN 'na' WHEN c_nationkey < 23 THEN '' ELSE 'widowed' END AS Marital,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'Secondary' WHEN 'BUILDING' THEN 'primary' WHEN 'AUTOMOBILE' THEN 'tertiary'
       WHEN 'FURNITURE' THEN 'NA' ELSE {education} END AS Education,
  CASE WHEN c_acctbal < 500 THEN '1' ELSE '0' END AS Default,
  CASE WHEN c_nationkey = 24 THEN 'abc' ELSE CAST(CAST(FLOOR(c_acctbal) AS BIGINT) + {raise} AS STRING) END AS Balance,
  CASE WHEN c_acctbal > 4000 THEN '1' ELSE '0' END AS HHInsurance,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '1' ELSE '0' END AS CarLoan,
  '{load}' AS _source_file,
  CAST('{day} 00:00:00' AS TIMESTAMP) AS _loaded_at
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
"""

# every customer arrives in two loads that differ in job, education and balance
CUSTOMERS = "\nUNION ALL\n".join(
    [
        _CUSTOMER_LOAD.format(
            load="load-1", day="2024-01-01", **{"raise": 0},
            job="CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'na' ELSE 'Admin' END",
            education="'secondary'",
        ),
        _CUSTOMER_LOAD.format(
            load="load-2", day="2024-02-01", **{"raise": 100},
            job="CASE WHEN c_mktsegment = 'MACHINERY' THEN 'null' ELSE 'SERVICES' END",
            education="'NULL'",
        ),
    ]
).replace(" AS Default", ' AS {q}Default{q}')

TEXTS = {"policy": POLICY, "claims": CLAIMS, "sales": SALES, "cars": CARS, "customers": CUSTOMERS}
BASE_TABLES = ("orders", "lineitem", "part", "customer", "nation", "region")


_PLANS: dict[tuple, DataFrame] = {}


def forget_plans() -> None:
    _PLANS.clear()


def planned(build):
    """Build a frame once within a registered query; only the plan is kept, never rows."""

    def get(spark: SparkSession, folder: str, *args) -> DataFrame:
        key = (build.__name__, spark.sparkContext.applicationId, id(spark), folder, *args)
        if key not in _PLANS:
            _PLANS[key] = build(spark, folder, *args)
        return _PLANS[key]

    return get


@planned
def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The raw input ``name`` as a DataFrame over the Parquet tables in ``folder``."""
    text = TEXTS[name].replace("{q}", "`")
    used = [t for t in BASE_TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: read_table(spark, folder, t) for t in used})


def check_sql(name: str) -> str:
    """The same SELECT for the checking engine, over tables of the given names."""
    text = TEXTS[name].replace("{q}", '"')
    for t in BASE_TABLES:
        text = text.replace("{" + t + "}", t)
    return text.strip()
