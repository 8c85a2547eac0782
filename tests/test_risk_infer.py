import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.operators import infer, risk

DDL = (
    "ClaimID string, PolicyID string, Claim_Logged_On int, Claim_Processed_On int, Claim_Rejected boolean, incident_date int, "
    "incident_state string, incident_city string, incident_location string, incident_type string, collision_type string, "
    "incident_severity string, authorities_contacted string, police_report_available boolean, "
    "number_of_vehicles_involved int, bodily_injuries int, witnesses int, injury float, property float, vehicle float, "
    "property_damage boolean, policy_bind_date string, indicate_day_bucket int, Claim_Logged_On_day_bucket int, "
    "Claim_Processed_On_day_bucket int"
)


def claim(name="c", **given):
    base = dict(
        ClaimID=name, PolicyID="p", Claim_Logged_On=1, Claim_Processed_On=1, Claim_Rejected=False, incident_date=1,
        incident_state="NY", incident_city="X", incident_location="Y", incident_type="Theft", collision_type=None,
        incident_severity="Major Damage", authorities_contacted="None", police_report_available=True,
        number_of_vehicles_involved=2, bodily_injuries=0, witnesses=0, injury=2000.0, property=600.0, vehicle=3000.0,
        property_damage=False, policy_bind_date="2020-01-01", indicate_day_bucket=10, Claim_Logged_On_day_bucket=12,
        Claim_Processed_On_day_bucket=15,
    )
    base.update(given)
    return tuple(base.values())


def scored(spark, *rows):
    return {r.ClaimID: r for r in risk.scored(spark.createDataFrame(list(rows), DDL)).collect()}


def test_a_quiet_claim_scores_zero(spark):
    row = scored(spark, claim())["c"]
    assert (row.anomaly_score, row.priority_tier, row.triggered_rules) == (0.0, "NOT_FLAGGED", [])
    assert (row.report_delay_days, row.processing_days, row.claim_lifecycle_days) == (2, 3, 5)


@pytest.mark.parametrize(
    "given,rule",
    [
        ({"Claim_Logged_On_day_bucket": 41, "Claim_Processed_On_day_bucket": 41}, "rule_timing_anomaly"),
        ({"indicate_day_bucket": 3}, "rule_timing_anomaly"),
        ({"Claim_Processed_On_day_bucket": 34}, "rule_processing_delay"),
        ({"number_of_vehicles_involved": 3}, "rule_high_complexity"),
        ({"bodily_injuries": 2}, "rule_high_complexity"),
        ({"authorities_contacted": "police", "police_report_available": False}, "rule_documentation_mismatch"),
        ({"police_report_available": False}, "rule_documentation_mismatch"),
        ({"Claim_Rejected": True}, "rule_rejection_pattern"),
        ({"incident_severity": "Minor Damage", "injury": 5001.0}, "rule_severity_mismatch"),
        (
            {"number_of_vehicles_involved": 1, "injury": 999.0, "property": 499.0, "vehicle": 2499.0},
            "rule_severity_mismatch",
        ),
    ],
)
def test_each_rule_fires_alone(spark, given, rule):
    row = scored(spark, claim(**given))["c"]
    assert [name for name, _, _, _ in presets.RISK_RULES if row[name]] == [rule]
    text = {name: words for name, _, words, _ in presets.RISK_RULES}[rule]
    assert row.triggered_rules == [text]


def test_edges_that_do_not_fire(spark):
    row = scored(
        spark,
        claim(Claim_Logged_On_day_bucket=40, Claim_Processed_On_day_bucket=61, indicate_day_bucket=10),
        claim("null report", police_report_available=None, authorities_contacted="Police"),
        claim("unknown severity", incident_severity="whatever", injury=9000.0),
    )
    assert row["c"].anomaly_score == 0.0
    assert row["null report"].authority_report_mismatch == 0
    assert row["unknown severity"].severity_rank is None and row["unknown severity"].rule_severity_mismatch == 0


def test_nulls_count_as_nothing(spark):
    row = scored(
        spark,
        claim(injury=None, property=None, vehicle=None, number_of_vehicles_involved=None, bodily_injuries=None,
              witnesses=None, property_damage=None, indicate_day_bucket=None),
    )["c"]
    assert row.total_loss_amount == 0.0 and row.complexity_points == 0 and row.report_delay_days is None
    assert row.rule_timing_anomaly == 0 and row.rule_severity_mismatch == 1


def test_claims_per_policy(spark):
    rows = scored(spark, claim("a"), claim("b"), claim("x", PolicyID=None), claim("y", PolicyID=None), claim("z", PolicyID="q"))
    assert {k: r.policy_claim_count for k, r in rows.items()} == {"a": 2, "b": 2, "x": 2, "y": 2, "z": 1}


def test_counting_moves_the_claims_columns_only(spark, capsys):
    """What is added to the claims is added after the join that counts them, and stands before the count."""
    claims = spark.createDataFrame([claim("a")], DDL)
    df = risk.features(claims)
    assert df.columns[-1] == "policy_claim_count"
    df.explain("formatted")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert moved and not [c for c in moved if re.search("severity_norm|total_loss_amount|complexity_points", c)]


def test_tier_edges(spark):
    df = spark.createDataFrame([(100.0,), (70.0,), (69.99,), (45.0,), (25.0,), (24.99,), (None,)], "s double")
    got = [r[0] for r in df.select(risk.tier(F.col("s"))).collect()]
    assert got == ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "NOT_FLAGGED", "NOT_FLAGGED"]


def test_flags_and_summary(spark):
    df = spark.createDataFrame([("a", 45.0), ("b", 44.99), ("c", 90.0)], "claim_id string, anomaly_score double")
    assert risk.flagged(df).count() == 3 and risk.flagged(df, 45).count() == 2
    assert tuple(risk.flag_summary(df, 45).first()) == (3, 2, 66.67)
    assert tuple(risk.flag_summary(df).first()) == (3, 3, 100.0)
    assert tuple(risk.flag_summary(df.limit(0), 45).first()) == (0, 0, 0.0)


def test_top_claims_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 9.0), ("d", 5.0)], "claim_id string, anomaly_score double")
    top = risk.top_claims(df, 3)
    assert [r.claim_id for r in top.collect()] == ["c", "a", "b"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_report_has_forty_columns_and_keeps_failures(spark):
    def write(prompt):
        if "bad" in prompt:
            raise ValueError("refused")
        return "anomaly_score" in prompt.split("Evidence: ")[1] and "brief" or "no evidence"

    frame = risk.scored(spark.createDataFrame([claim("good"), claim("bad")], DDL))
    report = risk.report(frame, write)
    assert len(report.columns) == 40
    rows = {r.claim_id: r for r in report.collect()}
    assert rows["good"].ai_investigation_brief == "brief" and rows["good"].generation_status == "SUCCESS"
    assert rows["bad"].ai_investigation_brief == "ERROR: refused" and rows["bad"].generation_status == "FAILED"
    assert rows["good"].claim_rejected == "False" and rows["good"].police_report_available == "True"


@pytest.mark.parametrize(
    "reply,text,status",
    [
        (" plain answer ", "plain answer", "SUCCESS"),
        ('[{"type":"reasoning","text":"r"},{"type":"text","text":" t "}]', "t", "SUCCESS"),
        ('[{"type":"reasoning","summary":[{"a":1}]},{"type":"text","text":"t"}]', "t", "SUCCESS"),
        ('[{"type":"reasoning","text":"r"}]', None, "EMPTY"),
        ("[]", None, "EMPTY"),
        ("", None, "EMPTY"),
        ('{"type":"other"}', None, "EMPTY"),
        ('[{"type":"text",', None, "PARSE_ERROR"),
    ],
)
def test_reply_shapes(spark, reply, text, status):
    df = spark.createDataFrame([(1, "p")], "id int, prompt string")
    row = infer.map_text(df, "prompt", lambda _: reply).first()
    assert (row.reply_text, row.generation_status) == (text, status)
    assert (row.error_message is not None) == (status == "PARSE_ERROR")


def test_failures_keep_their_row_and_message(spark):
    def fn(prompt):
        return 1 / 0 if prompt == "b" else prompt.upper()

    df = spark.createDataFrame([("a",), ("b",)], "prompt string")
    got = {r.prompt: (r.reply_text, r.generation_status, r.error_message) for r in infer.map_text(df, "prompt", fn).collect()}
    assert got == {"a": ("A", "SUCCESS", None), "b": (None, "FAILED", "division by zero")}


def test_only_throttling_is_retried_with_doubling_pause(monkeypatch):
    pauses, calls = [], []
    monkeypatch.setattr(time, "sleep", pauses.append)

    def busy(_):
        calls.append(1)
        raise infer.Throttled("busy")

    assert infer._ask(busy, "p", 3, 2.0) == (None, "busy") and len(calls) == 3 and pauses == [2.0, 4.0]
    calls.clear()

    def second_time(_):
        calls.append(1)
        if len(calls) < 2:
            raise infer.Throttled("HTTP 429")
        return "ok"

    assert infer._ask(second_time, "p", 3, 2.0) == ("ok", None)
    calls.clear()

    def broken(_):
        calls.append(1)
        raise RuntimeError("no")

    assert infer._ask(broken, "p", 3, 2.0) == (None, "no") and len(calls) == 1
