import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, quarantine, rules
from tidemark.operators.partials import Partials
from tidemark.operators.specs import IssueSpec
from tidemark.plans import marts, star
from tidemark.streaming import flows, pipeline

DDL = "user string, kind string, seq int, value int"
RULES = {**rules.not_null("user"), **rules.non_negative("value")}
SPEC = IssueSpec("events", (("user IS NULL", "user", "no user"),), "value", "bad value", (), "2")


@pytest.fixture
def parts(spark, tmp_path):
    """Rows in several files, so that a stream takes several micro-batches."""
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice("xy"), i, rng.choice([-1, 0, 5, None])) for i in range(60)
    ]
    for n in range(4):
        part = spark.createDataFrame(rows[n * 15 : n * 15 + 15], DDL)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    return stream, spark.createDataFrame(rows, DDL), str(tmp_path)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def batches(spark, path):
    return spark.read.parquet(path).select("batch_id").distinct().count()


def test_split_equals_batch(spark, parts):
    stream, batch, root = parts
    flows.split_flow(stream, lambda df: df, RULES, SPEC, f"{root}/good", f"{root}/bad", f"{root}/ck")
    assert same(flows.read_sink(spark, f"{root}/good"), rules.keep_valid(batch, RULES))
    shown = ("column_name", "affected_record")
    want = quarantine.issue_log(batch, RULES, SPEC).select(*shown)
    assert same(flows.read_sink(spark, f"{root}/bad").select(*shown), want)
    assert spark.read.parquet(f"{root}/good").select("batch_id").distinct().count() >= 3


def test_dedup_holds_across_batches(spark, parts):
    stream, batch, root = parts
    flows.dedup_flow(spark, stream, ["user", "kind"], f"{root}/t", f"{root}/ck", ["seq"])
    got = flows.read_sink(spark, f"{root}/t")
    assert got.count() == batch.select("user", "kind").distinct().count()
    assert got.join(batch, ["user", "kind", "seq"], "left_anti").filter("user IS NOT NULL").count() == 0


def test_native_dedup(spark, parts):
    stream, batch, root = parts
    flows.run_flow(flows.dedup(stream, ["user"]), f"{root}/t", f"{root}/ck")
    assert flows.read_sink(spark, f"{root}/t").count() == 4
    timed = stream.withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    flows.run_flow(flows.dedup(timed, ["user"], ("at", "1 hour")), f"{root}/w", f"{root}/ckw")
    assert flows.read_sink(spark, f"{root}/w").count() == 4


def test_upsert_equals_batch_and_compacts(spark, parts):
    stream, batch, root = parts
    flows.upsert_flow(stream, ["user"], ["value", "seq"], f"{root}/t", f"{root}/ck")
    want = dedup.latest_by_key(batch, ["user"], ["value", "seq"])
    assert same(flows.read_upsert(spark, f"{root}/t", ["user"], ["value", "seq"]), want)
    flows.compact_upsert(spark, f"{root}/t", ["user"], ["value", "seq"], f"{root}/t2")
    assert flows.read_sink(spark, f"{root}/t2").count() == 4
    assert same(flows.read_upsert(spark, f"{root}/t2", ["user"], ["value", "seq"]), want)


def test_a_retried_batch_overwrites_its_own_output(spark, parts):
    stream, batch, root = parts
    flows.run_flow(stream, f"{root}/t", f"{root}/ck")
    path = f"{root}/t/batch_id=0"
    n = spark.read.parquet(f"{root}/t").count()
    again = spark.createDataFrame(spark.read.parquet(path).collect(), DDL)
    again.write.mode("overwrite").parquet(path)
    assert spark.read.parquet(f"{root}/t").count() == n == 60
    flows.run_flow(stream, f"{root}/t", f"{root}/ck")
    assert spark.read.parquet(f"{root}/t").count() == 60


def test_both_static_joins(spark, parts):
    stream, batch, root = parts
    static = spark.createDataFrame([("a", 1), ("b", 2)], "user string, tier int")
    want = batch.join(static, "user", "left").select("user", "kind", "seq", "value", "tier")
    flows.run_flow(flows.enrich(stream, static, ["user"]), f"{root}/n", f"{root}/ckn")
    assert same(flows.read_sink(spark, f"{root}/n").select(*want.columns), want)
    flows.enrich_flow(stream, static, ["user"], f"{root}/s", f"{root}/cks")
    assert same(flows.read_sink(spark, f"{root}/s"), want)


def test_many_flows_one_log(spark, parts):
    stream, batch, root = parts
    named = {k: stream.filter(F.col("kind") == k) for k in "xy"}
    flows.multi_flow(named, f"{root}/log", f"{root}/cks")
    got = flows.read_sink(spark, f"{root}/log")
    assert got.count() == 60 and got.filter("flow <> kind").count() == 0


CLAIM = {
    "Claim_Logged_On": "5:0", "Claim_Processed_On": "5:0", "Claim_Rejected": "Y", "incident_date": "5:0",
    "incident_severity": "major damage", "injury": "1", "property": "2", "vehicle": "3", "property_damage": "YES",
}


def write_raw(spark, folder):
    import json
    import os

    os.makedirs(folder)

    def put(name, text):
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)

    put("policy_1.csv", ",".join(pipeline.FIELDS["policy"]) + "\n"
        + "p1,u1,k1,2020-01-01,oh,100,5,10.5,0\np2,u2,k1,2020-01-01,oh,250,-5,10.5,0\n")
    put("sales_1.csv", ",".join(pipeline.FIELDS["sales"]) + "\n"
        + "1,k1,01-01-2024 10:00,,500,W,s,c,d,o\n2,k1,01-01-2024 10:00,,,W,s,c,d,o\n")
    turned = list(reversed(pipeline.FIELDS["sales"]))       # the same columns in another order
    put("Sales_2.csv", ",".join(turned) + "\no,d,c,s,W,600,,01-01-2024 10:00,k1,1\n")
    put("cars_1.csv", ",".join(pipeline.FIELDS["cars"]) + "\nk1,n,f,t,m,q,10,5,2.5 kmpl,9 CC,7 bhp\n")
    put("customers_1.csv", "CustomerID,Region,City,Marital,Education,Job,Balance,Default,HHInsurance,CarLoan,State\n"
        "u1,W,c,single,primary,na,10,0,0,1,s\nu1,E,c,single,primary,cook,20,0,0,1,s\n")
    put("customers_2.csv", "cust_id,Reg,City_in_state,Marital_status,Edu,Job,Balance,Default,HHInsurance,CarLoan,State\n"
        "u2,Northwest,c,single,primary,na,-3,0,0,1,s\n")
    put("claims_1.json", "\n".join(json.dumps({"ClaimID": c, "PolicyID": p, **CLAIM, **more}) for c, p, more in (
        ("c1", "p1", {}), ("c1", "p1", {"injury": "9"}), ("c2", "p9", {}), ("c3", "p1", {"vehicle": "-1"}))) + "\n")


def test_pipeline_end_to_end(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
    write_raw(spark, raw)
    day = F.lit("2024-06-01").cast("date")
    pipeline.run(spark, raw, root, 1, day)
    issues = {(r.table_name, r.column_name): r.severity for r in pipeline.issues(spark, root).collect()}
    assert issues == {
        ("policy", "policy_deductable"): "3", ("sales", "original_selling_price"): "4", ("customers", "Balance"): "3",
        ("claims", "vehicle"): "3",
    }

    def mart(name):
        return [tuple(r) for r in spark.read.parquet(f"{root}/gold/{name}").collect()]

    assert sorted(mart("agg_customer_identity"), key=str) == [("East", 1, 20.0), ("Northwest", 1, -3.0)]
    assert sorted(mart("agg_claim_performance"), key=str) == [("East", "100", 1, 5.0, 100.0, 6.0), (None, None, 1, None, 100.0, 6.0)]
    # the later copy of a listing does not replace the one already written
    stock = mart("agg_inventory_status")
    assert [(r[0], r[1], r[2], r[4]) for r in stock] == [("West", "M", 1, 152)] and stock[0][3] in (500, 600)
    # nothing new: nothing changes; a late claim file is picked up
    pipeline.run(spark, raw, root, 10, day)
    assert sorted(mart("agg_claim_performance"), key=str)[0][2] == 1
    with open(f"{raw}/claims_2.json", "w") as f:
        import json
        f.write(json.dumps({"ClaimID": "c9", "PolicyID": "p1", **CLAIM}) + "\n")
    pipeline.run(spark, raw, root, 10, day)
    assert ("East", "100", 2, 5.0, 100.0, 12.0) in mart("agg_claim_performance")




def test_replayed_batch_does_not_reach_followers_twice(spark, tmp_path):
    """A batch whose commit was lost runs again after a follower has read its output."""
    import glob
    import os

    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).write.parquet(folder)
    source = lambda: spark.readStream.schema("id long").parquet(folder)
    flows.run_flow(source(), f"{root}/a", f"{root}/ck-a")
    flows.run_flow(flows.stream_sink(spark, f"{root}/a"), f"{root}/b", f"{root}/ck-b")
    for lost in glob.glob(f"{root}/ck-a/commits/*") + glob.glob(f"{root}/ck-a/commits/.*crc"):
        os.replace(lost, str(tmp_path / os.path.basename(lost)))
    flows.run_flow(source(), f"{root}/a", f"{root}/ck-a")
    flows.run_flow(flows.stream_sink(spark, f"{root}/a"), f"{root}/b", f"{root}/ck-b")
    assert flows.read_sink(spark, f"{root}/a").count() == 10 and flows.read_sink(spark, f"{root}/b").count() == 10


def test_bronze_keeps_keys_and_unfit_claims(spark, tmp_path):
    """Keys stay as written on both sides of the claim join; nothing of a claims file is lost."""
    import json

    raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
    write_raw(spark, raw)
    with open(f"{raw}/policy_2.csv", "w") as f:
        f.write(",".join(pipeline.FIELDS["policy"]) + "\n007,u1,k1,2020-02-02,oh,100,5,10.50,0\n1e5,u1,k1,2020-03-03,oh,100,5,10.5,0\n")
    with open(f"{raw}/claims_2.json", "w") as f:
        f.write(json.dumps({"ClaimID": "c7", "PolicyID": "007", **CLAIM, "surprise": 1}) + "\nnot json\n")
        f.write(json.dumps({"ClaimID": "c8", "PolicyID": "1e5", **CLAIM}) + "\n")
    pipeline.bronze(spark, raw, root, 5)
    rescued = {r["_rescued_data"] for r in flows.read_sink(spark, f"{root}/bronze/claims").collect()}
    assert {'{"surprise":1}', "not json"} <= rescued
    pipeline.to_silver(spark, root, 5)
    bound = {r.ClaimID: str(r.policy_bind_date)[:10] for r in flows.read_sink(spark, f"{root}/silver/claims").collect()}
    assert bound["c7"] == "2020-02-02" and bound["c8"] == "2020-03-03"


def test_late_policies_complete_their_claims(spark, tmp_path):
    """Claims before their policies, over several runs: nothing stays NULL that needn't, nothing counts twice."""
    import json

    raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
    write_raw(spark, raw)

    def put(name, text):
        with open(f"{raw}/{name}", "w") as f:
            f.write(text)

    def more_claims(n, *pairs):
        put(f"claims_{n}.json", "\n".join(json.dumps({"ClaimID": c, "PolicyID": p, **CLAIM}) for c, p in pairs) + "\n")

    def more_policies(n, *rows):
        put(f"policy_{n}.csv", ",".join(pipeline.FIELDS["policy"]) + "\n" + "\n".join(rows) + "\n")

    def state():
        pipeline.run(spark, raw, root, 1, F.lit("2024-06-01").cast("date"))
        links = {r.ClaimID: (r.customer_id, str(r.policy_bind_date)[:10], r.indicate_day_bucket) for r in pipeline.claims(spark, root).collect()}
        mart = {(r.region, r.policy_type): r.total_claims for r in spark.read.parquet(f"{root}/gold/agg_claim_performance").collect()}
        return links, mart

    none = (None, "None", None)
    links, mart = state()
    assert links == {"c1": ("u1", "2020-01-01", 6), "c2": none}
    assert mart == {("East", "100"): 1, (None, None): 1}
    more_claims(2, ("c4", "p9"), ("c5", "p8"), ("c2", "p9"))      # c2 again: seen, though it still waits
    links, mart = state()
    assert links == {"c1": ("u1", "2020-01-01", 6), "c2": none, "c4": none, "c5": none}
    assert mart == {("East", "100"): 1, (None, None): 3}
    more_policies(2, "p9,u2,k1,2020-03-03,oh,250,5,10.5,0")
    links, mart = state()
    late = ("u2", "2020-03-03", 8)
    assert links == {"c1": ("u1", "2020-01-01", 6), "c2": late, "c4": late, "c5": none}
    assert mart == {("East", "100"): 1, ("Northwest", "250"): 2, (None, None): 1}
    more_policies(3, "p8,u1,k1,2020-01-01,oh,100,5,10.5,0", "p9,u1,k1,2021-01-01,oh,100,5,10.5,0")      # p9 again: the first stays
    more_claims(3, ("c7", "p8"), ("c4", "p8"))
    put("customers_3.csv", "CustomerID,Region,City,Marital,Education,Job,Balance,Default,HHInsurance,CarLoan,State\n"
        "u2,S,c,single,primary,cook,-3,0,0,1,s\n")       # moves: counted under the new region, old claims too
    links, mart = state()
    assert links == {"c1": ("u1", "2020-01-01", 6), "c2": late, "c4": late, "c5": ("u1", "2020-01-01", 6), "c7": ("u1", "2020-01-01", 6)}
    assert mart == {("East", "100"): 3, ("South", "250"): 2}
    # the marts equal a recompute from all of gold, and their parts hold a row per key and segment
    facts = flows.read_sink(spark, f"{root}/gold/fact_claims")
    settled = pipeline.claims(spark, root)
    again = marts.claim_performance(star.fact_claims(settled), flows.read_sink(spark, f"{root}/gold/dim_customer"))
    assert same(again, spark.read.parquet(f"{root}/gold/agg_claim_performance"))
    assert facts.count() == facts.select("claim_id").distinct().count() == 5


def test_late_policies_in_slices(spark, tmp_path, monkeypatch):
    """Claims looked up and completed in slices: the rows that one slice gives, copies of a claim once, in as many folders."""
    import json

    def state(name, size):
        monkeypatch.setattr(flows, "SLICE", size)
        raw, root = str(tmp_path / name / "raw"), str(tmp_path / name / "out")
        write_raw(spark, raw)
        with open(f"{raw}/claims_2.json", "w") as f:
            for i in range(60):
                more = {"vehicle": "-1"} if i % 7 == 0 else {"injury": str(i)}
                f.write(json.dumps({"ClaimID": f"d{i % 50}", "PolicyID": f"p{i % 3}", **CLAIM, **more}) + "\n")
            f.write(json.dumps({"PolicyID": "p1", **CLAIM}) + "\n")
        pipeline.run(spark, raw, root, 5, F.lit("2024-06-01").cast("date"))
        with open(f"{raw}/policy_2.csv", "w") as f:
            f.write(",".join(pipeline.FIELDS["policy"]) + "\np2,u2,k1,2020-03-03,oh,250,5,10.5,0\n")
        pipeline.run(spark, raw, root, 5, F.lit("2024-06-01").cast("date"))
        claims, issues = pipeline.claims(spark, root).drop("_loaded_at", "_source_file"), pipeline.issues(spark, root)
        flow_folders = [sorted(p.name for p in (tmp_path / name / "out" / at).iterdir() if not p.name.startswith("_") and p.is_dir()) for at in (
            "silver/claims/flow=fresh", "silver/claims/flow=repaired", "silver/claims_waiting", "dq_issues/flow=claims")]
        times = [c for c, kind in issues.dtypes if kind in ("timestamp", "timestamp_ntz")]
        return claims, issues.groupBy(*[c for c in issues.columns if c not in times and "Claim" not in c and c in ("rule", "severity", "entity")]).count(), issues.count(), flow_folders

    whole, cut = state("whole", 1 << 21), state("cut", 25)
    assert same(whole[0], cut[0]) and same(whole[1], cut[1])
    assert whole[2:] == cut[2:]
    assert cut[0].count() == cut[0].select("ClaimID").distinct().count() > 40


def test_a_flow_leaves_no_shuffle_files(spark, parts):
    """Nor do the rows that a micro-batch persisted and let go."""
    import gc
    import time

    stream, batch, root = parts
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()

    def shuffles():
        return status.shuffleStatuses().size()

    def step(rows, _):
        kept = dedup.dedup_first(rows, ["user"]).persist()
        kept.count()
        kept.unpersist()
        return {f"{root}/t": dedup.dedup_first(rows, ["user", "kind"])}

    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)
    before = shuffles()
    flows.run_step(stream, step, f"{root}/ck")
    for _ in range(20):
        if shuffles() <= before:
            break
        time.sleep(0.5)
    assert shuffles() <= before


def test_aggregate_flow_equals_recompute(spark, parts):
    stream, batch, root = parts
    how = Partials(("user",), {"n": ("count", "1"), "v": ("sum", "value"), "lo": ("min", "seq"), "hi": ("max", "value"), "x": ("count_if", "kind = 'x'")})
    flows.aggregate_flow(stream, how.of, how.merge, f"{root}/t", f"{root}/ck", fan=3)
    table = how.table(spark, f"{root}/t", 3)
    assert same(table.read(), how.of(batch))
    assert len(table.batches()) == 4 and table.live() == [(0, 2), (3, 3)]
    assert max(spark.read.parquet(table.folder(*s)).count() for s in table.live()) <= 4
    flows.aggregate_flow(stream, how.of, how.merge, f"{root}/t", f"{root}/ck2", fan=3)     # all batches run again
    assert same(table.read(), how.of(batch))
