import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark import presets
from tidemark.operators import quarantine, rules
from tidemark.operators.specs import IssueSpec

RULES = {**rules.not_null("k"), **rules.non_negative("n"), **rules.one_of("w", ("a", "b"))}
ROW = st.tuples(
    st.one_of(st.none(), st.text("xyz", max_size=2)),
    st.one_of(st.none(), st.integers(-3, 3)),
    st.sampled_from([None, "a", "b", "c"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=20))
def test_valid_and_quarantine_are_complements(spark, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, k string, n int, w string")
    good = {r["id"] for r in rules.keep_valid(df, RULES).collect()}
    bad = {r["id"] for r in rules.quarantine(df, RULES).collect()}
    expected = {i for i, (k, n, w) in enumerate(data) if k is not None and n is not None and n >= 0 and w in ("a", "b")}
    assert good == expected and bad == set(range(len(data))) - expected


def test_literal_policy_misses_null_results(spark):
    df = spark.createDataFrame([(1, "x", None, "a"), (2, "x", -1, "a"), (3, "x", 1, None)], "id int, k string, n int, w string")
    assert {r["id"] for r in rules.quarantine(df, RULES, "literal").collect()} == {2}
    assert {r["id"] for r in rules.quarantine(df, RULES).collect()} == {1, 2, 3}
    with pytest.raises(ValueError):
        rules.quarantine(df, RULES, "other")


def test_measure_and_observe_count_the_same(spark):
    df = spark.createDataFrame([("x", 1, "a"), (None, -1, None), ("x", None, "c")], "k string, n int, w string")
    counted = {r["rule"]: (r["rows_seen"], r["violations"]) for r in rules.measure(df, RULES).collect()}
    assert counted == {"k_present": (3, 1), "n_non_negative": (3, 2), "w_listed": (3, 2)}
    watched, seen = rules.observe(df, RULES, "watch")
    assert watched.count() == 3
    assert seen.get == {"rows_seen": 3, "k_present": 1, "n_non_negative": 2, "w_listed": 2}


def test_filter_stays_above_the_cleaning_step(spark):
    df = spark.createDataFrame([("1",)], "t string").selectExpr("try_cast(t AS int) * 2 AS n", "t AS k", "t AS w")
    plan = rules.keep_valid(df, RULES)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Filter")]
    assert len(filters) == 1 and "try_cast" not in filters[0]


SPEC = IssueSpec(
    table="t",
    cases=(("k IS NULL", "k", "no key"), ("n < 0", "n", "below zero")),
    other_column="w",
    other_description="bad word",
    levels=(("k IS NULL", "4"), ("n < 0", "3")),
    other_level="2",
    hidden=("secret",),
)


def test_issue_log_takes_the_first_match_and_keeps_null_fields(spark):
    df = spark.createDataFrame(
        [(None, -1, "c", 1), ("x", -1, "a", 2), ("x", 1, "c", 3), ("x", 1, "a", 4), ("x", None, "a", 5)],
        "k string, n int, w string, secret int",
    )
    log = quarantine.issue_log(df, RULES, SPEC).orderBy("affected_record").collect()
    found = sorted((r.column_name, r.issue_description, r.severity, r.affected_record) for r in log)
    assert found == [
        ("k", "no key", "4", '{"k":null,"n":-1,"w":"c"}'),
        ("n", "below zero", "3", '{"k":"x","n":-1,"w":"a"}'),
        ("w", "bad word", "2", '{"k":"x","n":1,"w":"c"}'),
        ("w", "bad word", "2", '{"k":"x","n":null,"w":"a"}'),
    ]
    assert len({r.issue_id for r in log}) == 4 and all(r.detected_at and r.table_name == "t" for r in log)
    short = quarantine.issue_log(df, RULES, SPEC, keep_null_fields=False).filter("column_name = 'k'").first()
    assert short.affected_record == '{"n":-1,"w":"c"}'


def test_union_and_rollup(spark):
    df = spark.createDataFrame([(None, 1, "a", 1), (None, 2, "b", 2)], "k string, n int, w string, secret int")
    log = quarantine.issue_log(df, RULES, SPEC)
    got = quarantine.rollup(quarantine.union_logs([log, log])).collect()
    assert [(r.table_name, r.column_name, r.issues) for r in got] == [("t", "k", 4)]


def test_explain_has_fifteen_columns_and_takes_either_record_name(spark):
    df = spark.createDataFrame([(None, 1, "a", 1)], "k string, n int, w string, secret int")
    log = quarantine.issue_log(df, RULES, SPEC).withColumnRenamed("affected_record", "affected_records")
    report = quarantine.explain(log, lambda prompt: "fine" if "no key" in prompt else "?")
    assert len(report.columns) == 15
    row = report.first()
    assert row.ai_generated_explanation == "fine" and row.generation_status == "SUCCESS" and row.rule_name is None
    with pytest.raises(ValueError):
        quarantine.explain(log.drop("severity"), str)
    with pytest.raises(ValueError):
        quarantine.explain(log.drop("affected_records"), str)


def test_car_with_null_km_is_labelled_mileage(spark):
    df = spark.createDataFrame([("c1", None, 1.0)], "car_id string, km_driven int, mileage float")
    row = quarantine.issue_log(df, presets.CAR_RULES, presets.CAR_ISSUES).first()
    assert (row.column_name, row.severity) == ("mileage", "2")


def test_claim_severity_does_not_follow_the_column(spark):
    cols = "ClaimID string, PolicyID string, incident_date int, Claim_Logged_On int, Claim_Processed_On int, "
    cols += "injury float, property float, vehicle float, property_damage boolean"
    df = spark.createDataFrame(
        [("a", "p", 0, 0, 0, -1.0, 1.0, 1.0, True), ("b", "p", None, 0, 0, 1.0, 1.0, 1.0, True)], cols
    )
    log = quarantine.issue_log(df, presets.CLAIM_RULES, presets.CLAIM_ISSUES).collect()
    found = {(r.column_name, r.severity) for r in log}
    assert found == {("incident_date", "3"), ("Multiple/Complex", "2")}


def test_rules_over_stored_columns_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    row_rules = {"kind": "event_type IN ('view', 'click')", "floor": "value >= 5"}
    kept = rules.keep_valid(events, row_rules, cleaned=False)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "In(event_type" in pushed and "GreaterThanOrEqual(value" in pushed
    assert kept.count() == rules.keep_valid(events, row_rules).count()
