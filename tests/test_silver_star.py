import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.plans import kpi, marts, silver, star
from tidemark.session import split_wide_steps
from tidemark.workload.queries import QUERIES
from tidemark.workload.raw import raw

CLAIM_COLUMNS = (
    "ClaimID", "PolicyID", "Claim_Logged_On", "Claim_Processed_On", "Claim_Rejected", "incident_date", "incident_state",
    "incident_city", "incident_location", "incident_type", "collision_type", "incident_severity", "authorities_contacted",
    "police_report_available", "number_of_vehicles_involved", "bodily_injuries", "witnesses", "injury", "property",
    "vehicle", "property_damage", "_source_file",
)


def claim(**given):
    base = dict(
        ClaimID="c1", PolicyID="p1", Claim_Logged_On="5:00.0", Claim_Processed_On="5:00.0", Claim_Rejected="N",
        incident_date="5:00.0", incident_state=" ny", incident_city="new york", incident_location="1 road",
        incident_type="theft", collision_type="?", incident_severity="major damage", authorities_contacted="police",
        police_report_available="YES", number_of_vehicles_involved="1", bodily_injuries="0", witnesses="x", injury="10",
        property="20", vehicle="30", property_damage="NO", _source_file="f",
    )
    base.update(given)
    return tuple(base[c] for c in CLAIM_COLUMNS)


def claims_frame(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CLAIM_COLUMNS))


POLICY_DDL = ", ".join(
    f"{c} string" for c in (
        "policy_number", "customer_id", "car_id", "policy_bind_date", "policy_state", "policy_csl", "policy_deductable",
        "policy_annual_premium", "umbrella_limit", "_source_file",
    )
)


def policies(spark):
    return spark.createDataFrame(
        [
            (" p1 ", "u1", "k1", "2020-01-10", "oh", "100/300", "500", "1406.91", "0", "f"),
            ("p2", "u1", "k2", "bad date", " il", "250/500", "1000", "nan", "5", "f"),
            ("p3", "u2", "k1", "2020-02-20", "sc", "250/500", "1000", "10", "5", "f"),
            ("p3", "u2", "k0", "2020-02-20", "sc", "250/500", "1000", "10", "5", "f"),
            ("null", "u2", "k1", "2020-02-20", "sc", "250/500", "1000", "10", "5", "f"),
            ("p4", "u3", "k1", "", "sc", "250/500", "-1", "10", "5", "f"),
        ],
        POLICY_DDL,
    )


def test_policy_cleaning_and_survivors(spark):
    got = {r.policy_number: r for r in silver.policy_silver(policies(spark)).collect()}
    assert set(got) == {"p1", "p3"}
    assert got["p1"].policy_bind_date == dt.datetime(2020, 1, 10) and got["p1"].policy_state == "OH"
    assert got["p3"].car_id == "k0"


def test_claim_types(spark):
    row = silver.claims(claims_frame(spark, claim(Claim_Logged_On=None, Claim_Processed_On="x:1", injury="abc"))).first()
    assert (row.Claim_Logged_On, row.Claim_Processed_On, row.injury, row.witnesses) == (0, None, None, None)
    assert (row.incident_state, row.incident_city, row.collision_type) == ("NY", "New York", None)
    assert row.Claim_Rejected is False and row.police_report_available is True and row.property_damage is False


@pytest.mark.parametrize(
    "given,kept",
    [
        ({}, True),
        ({"incident_date": "?"}, False),
        ({"incident_date": "bad"}, False),
        ({"Claim_Logged_On": "0:0", "Claim_Processed_On": "3:0"}, False),                        # processed, never logged
        ({"Claim_Logged_On": "6:0"}, False),                                                      # logged after incident
        ({"Claim_Logged_On": "3:0", "Claim_Processed_On": "4:0"}, False),                         # processed out of turn
        ({"Claim_Logged_On": "3:0", "Claim_Processed_On": "3:0"}, True),
        ({"Claim_Processed_On": "40:0"}, True),                                                   # logged on the incident day
        ({"injury": "-1"}, False),
        ({"vehicle": ""}, False),
        ({"property_damage": "?"}, False),
        ({"ClaimID": "NULL"}, False),
    ],
)
def test_claim_rules(spark, given, kept):
    raw = claims_frame(spark, claim(**given))
    got = silver.claims_silver(raw, silver.policy_silver(policies(spark)))
    assert got.count() == int(kept)


def test_order_of_checks_and_dedup(spark):
    raw = claims_frame(spark, claim(injury="-1", PolicyID="a"), claim(PolicyID="b"))
    policy = silver.policy_silver(policies(spark))
    assert [r.PolicyID for r in silver.claims_silver(raw, policy).collect()] == ["b"]
    assert silver.claims_silver(raw, policy, order="dedup_first").count() == 0
    with pytest.raises(ValueError):
        silver.claims_silver(raw, policy, order="?")


def test_buckets_and_dates_and_the_processing_identity(spark):
    raw = claims_frame(spark, claim(), claim(ClaimID="c2", PolicyID="gone"))
    policy = silver.policy_silver(policies(spark))
    claims = silver.claims_silver(raw, policy)
    row = claims.filter("ClaimID = 'c1'").first()
    assert (row.indicate_day_bucket, row.Claim_Logged_On_day_bucket, row.Claim_Processed_On_day_bucket) == (15, 20, 25)
    facts = {r.claim_id: r for r in star.fact_claims(claims, policy).collect()}
    assert facts["c1"].incident_date == dt.date(2020, 1, 25) and facts["c1"].processing_time_days == 5
    assert facts["c1"].customer_id == "u1" and facts["c2"].customer_id is None and facts["c2"].incident_date is None


def test_customer_survivor_and_enforcement(spark):
    ddl = "cust_id string, Reg string, State string, City string, Job string, Marital_status string, Edu string, "
    ddl += "Default string, Balance string, HHInsurance string, CarLoan string, _source_file string, _loaded_at string"
    rows = [
        ("1", "W", "s", "c", "na", "single", None, "0", "5", "0", "0", "f", "2024-03-01"),
        ("1", "W", "s", "c", "job", "single", "primary", "0", "6", "0", "0", "f", "2024-01-01"),
        ("1", "west", "s", "c", "job", "single", "primary", "0", "7", "0", "0", "f", "2024-02-01"),
        ("2", "Northwest", "s", "c", "job", "single", "tertiary", "0", "-7", "0", "0", "f", "2024-02-01"),
    ]
    raw = spark.createDataFrame(rows, ddl)
    got = {r.CustomerID: r for r in silver.customers_silver(raw).collect()}
    assert got["1"].Balance == 7 and got["1"].Region == "West" and set(got) == {"1", "2"}
    assert "completeness_score" not in silver.customers_silver(raw).columns
    assert [r.CustomerID for r in silver.customers_silver(raw, enforce=True).collect()] == ["1"]


def test_cars_may_fan_out_only_on_request(spark):
    ddl = ", ".join(
        f"{c} string" for c in ("car_id", "name", "fuel", "transmission", "model", "torque", "km_driven", "seats",
                                "mileage", "engine", "max_power", "_source_file")
    )
    row = ("k", " a ", "diesel", "manual", "m", "t", "10", "5", "23.4 kmpl", "1248 CC", "bhp", "f")
    raw = spark.createDataFrame([row, row], ddl)
    assert silver.cars_silver(raw).count() == 1 and silver.cars_silver(raw, unique=False).count() == 2
    car = silver.cars_silver(raw).first()
    assert abs(car.mileage - 23.4) < 1e-5 and car.engine == 1248 and car.max_power is None


def test_listing_age_is_strictly_over_sixty(spark):
    ddl = "sales_id int, car_id string, ad_placed_on timestamp, sold_on timestamp, Region string, State string, "
    ddl += "City string, original_selling_price int, seller_type string, owner string"
    def listing(n, day, sold=None):
        return (n, "k", dt.datetime(2024, 1, day), sold, "East", "s", "c", 100 * n, "d", "o")
    sales = spark.createDataFrame(
        [listing(1, 1), listing(2, 2), listing(3, 3), listing(4, 1, dt.datetime(2024, 2, 1))], ddl
    )
    facts = star.fact_sales(sales, F.lit("2024-03-02").cast("date"))
    assert {r.sales_id: (r.days_since_listing, r.is_sold) for r in facts.collect()} == {
        1: (61, 0), 2: (60, 0), 3: (59, 0), 4: (61, 1)
    }
    cars = spark.createDataFrame([("k", "M")], "car_id string, model string")
    mart = marts.inventory_status(facts, cars).collect()
    assert [tuple(r) for r in mart] == [("East", "M", 1, 100, 61)]


def star_frames(spark):
    facts = spark.createDataFrame(
        [("c1", "p1", "u1"), ("c2", "p1", "u1"), ("c3", "p1", "u1"), ("c4", "p2", "u2"), ("c5", None, None)],
        "claim_id string, policy_id string, customer_id string",
    )
    policy = spark.createDataFrame(
        [("p1", 10.0, 5, 100), ("p2", 40.0, None, 200), ("p3", None, 7, 300)],
        "policy_id string, policy_annual_premium double, umbrella_limit int, policy_deductable int",
    )
    customer = spark.createDataFrame(
        [("u1", 10, 1, 0, 1), ("u2", 20, 0, 1, None), ("u3", None, 1, 1, 0)],
        "customer_id string, balance int, default_flag int, CarLoan int, HHInsurance int",
    )
    return facts, policy, customer


def test_kpis_equal_the_fan_out_join(spark):
    facts, policy, customer = star_frames(spark)
    hit = F.sum(F.when(F.col("claim_id").isNotNull(), 1).otherwise(0))
    want = policy.join(facts, "policy_id", "left").agg(
        F.countDistinct("policy_id"), F.avg("policy_annual_premium"), F.sum("umbrella_limit"), F.avg("policy_deductable"),
        hit * 100.0 / F.countDistinct("policy_id"),
    ).first()
    assert tuple(kpi.policy(policy, facts).first()) == pytest.approx(tuple(want))

    def share(col):
        return F.sum(F.when(F.col(col) == 1, 1).otherwise(0)) * 100.0 / F.count("*")
    want = customer.join(facts, "customer_id", "left").agg(
        F.countDistinct("customer_id"), F.avg("balance"), share("default_flag"), hit / F.count("*"), share("CarLoan"),
        share("HHInsurance"),
    ).first()
    assert tuple(kpi.customer(customer, facts).first()) == pytest.approx(tuple(want))


def test_exact_kpis_count_each_entity_once(spark):
    facts, policy, customer = star_frames(spark)
    assert tuple(kpi.policy(policy, facts, exact=True).first()) == pytest.approx((3, 25.0, 12, 200.0, 200 / 3))
    row = kpi.customer(customer, facts, exact=True).first()
    assert (row.total_customers, row.avg_balance, row.claims_per_customer) == pytest.approx((3, 15.0, 4 / 3))


def test_kpis_of_nothing(spark):
    facts, policy, customer = (df.limit(0) for df in star_frames(spark))
    assert kpi.policy(policy, facts).first().total_policies == 0
    assert kpi.customer(customer, facts).first().default_rate is None


def test_summaries_and_union(spark):
    facts, policy, customer = star_frames(spark)
    rows = {"policy_portfolio": kpi.policy(policy, facts), "customer_profile": kpi.customer(customer, facts)}
    got = {r.domain_name: r for r in kpi.summaries(rows, lambda p: f"{'total_policies' in p}").collect()}
    assert got["policy_portfolio"].summary_title == "Policy Portfolio Overview"
    assert got["policy_portfolio"].executive_summary == "True" and got["customer_profile"].executive_summary == "False"
    insights = spark.createDataFrame(list(got.values()))
    assert kpi.summary_of(insights, "customer_profile").count() == 1


def test_claim_performance_matches_the_plain_joins(spark):
    ddl = "claim_id string, policy_id string, customer_id string, processing_time_days int, claim_rejected boolean, "
    ddl += "vehicle double, property double, injury double"
    facts = spark.createDataFrame(
        [("a", "p1", "u1", 2, True, 1.0, 2.0, 3.0), ("b", "p1", "u1", None, None, 1.0, None, 3.0),
         ("c", "p2", "u1", 5, False, 4.0, 4.0, 4.0), ("d", None, None, None, True, 1.0, 1.0, 1.0)], ddl,
    )
    policy = spark.createDataFrame([("p1", "100"), ("p2", "250")], "policy_id string, policy_csl string")
    customer = spark.createDataFrame([("u1", "East")], "customer_id string, region string")
    got = {(r.region, r.policy_type): tuple(r)[2:] for r in marts.claim_performance(facts, customer, policy).collect()}
    assert got == {
        ("East", "100"): (2, 2.0, 50.0, 6.0), ("East", "250"): (1, 5.0, 0.0, 12.0), (None, None): (1, None, 100.0, 3.0)
    }


def test_presets_hold_the_published_weights():
    assert sum(w for _, w, _, _ in presets.RISK_RULES) == 100


def test_wide_cleaning_steps_stay_under_the_jit_limit(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    split_wide_steps(spark)
    assert spark.conf.get(limit) == "8000"
    spark.conf.set(limit, "9000")
    split_wide_steps(spark)
    assert spark.conf.get(limit) == "9000"      # a limit of the user's own stays
    spark.conf.unset(limit)
    for name in ("risk_features", "kpi_policy", "issues_claims"):
        spark.conf.unset(limit)
        QUERIES[name](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(limit) == "8000"
