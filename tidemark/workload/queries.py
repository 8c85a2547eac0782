"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.functions import columns as c
from tidemark.functions import prompts, text, vectors
from tidemark.operators import dedup, infer, quarantine, retrieval, risk, rules, skew, tfidf
from tidemark.operators.partials import Partials
from tidemark.operators.specs import IssueSpec
from tidemark.plans import kpi, marts, silver, star
from tidemark.session import shared_dir, split_wide_steps
from tidemark.sources import ingest, schema_log, tables
from tidemark.streaming import flows, pipeline
from tidemark.streaming.segments import drop_folder
from tidemark.workload import replies
from tidemark.workload.raw import forget_plans, planned, raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2001-09-01"      # day on which listings are aged


def _fresh(fn: Query) -> Query:
    """Every call builds its plans anew; only within a call are they shared."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        forget_plans()
        split_wide_steps(spark)
        return fn(spark, folder)

    return run


def query(fn: Query) -> Query:
    """Register ``fn``."""
    QUERIES[fn.__name__] = _fresh(fn)
    return fn


def _ts(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def _double(col: str):
    return F.col(col).cast("double").alias(col)


# ---- cleaning -------------------------------------------------------------------------------


@query
def null_tokens(spark, d):
    df = c.null_tokens(raw(spark, d, "claims"), presets.CLAIM_NULL_TOKENS)
    return df.select("ClaimID", "PolicyID", "incident_date", "collision_type", "vehicle", "property_damage")


@query
def force_null(spark, d):
    df = raw(spark, d, "policy")
    return df.select(*[c.force_null(n).alias(n) for n in df.columns])


@query
def recode_region(spark, d):
    df = raw(spark, d, "sales").select("sales_id", F.initcap(c.force_null("Region")).alias("Region"))
    return c.recode(df, "Region", presets.REGION_CODES)


@query
def first_of_aliases(spark, d):
    """Two loads that name the same fields differently; one alias set has a name neither uses."""
    df = raw(spark, d, "customers")
    first = F.col("_source_file") == "load-1"
    split = {
        "CustomerID": ("Customer_ID", "cust_id"),
        "Region": ("Reg", "Region_2"),
        "City": ("City_in_state", "City_2"),
    }
    named = df.select(
        "_source_file",
        *[F.when(first, F.col(old)).alias(a) for old, (a, _) in split.items()],
        *[F.when(~first, F.col(old)).alias(b) for old, (_, b) in split.items()],
    )
    return named.select(
        "_source_file",
        *[
            c.first_of(named, [*presets.CUSTOMER_ALIASES[old], *pair]).alias(old)
            for old, pair in split.items()
        ],
    )


@query
def token_bool(spark, d):
    df = c.null_tokens(raw(spark, d, "claims"), presets.CLAIM_NULL_TOKENS)
    return df.select(
        "ClaimID",
        c.token_bool("Claim_Rejected", "Y", "N").alias("rejected"),
        c.token_bool("police_report_available", "YES", "NO").alias("police_report"),
        c.token_bool("property_damage", "YES", "NO").alias("damage"),
    )


@query
def offset_parse(spark, d):
    df = c.null_tokens(raw(spark, d, "claims"), presets.CLAIM_NULL_TOKENS)
    names = ("Claim_Logged_On", "Claim_Processed_On", "incident_date")
    return df.select("ClaimID", *[c.leading_int(n).alias(n) for n in names])


@query
def unit_extract(spark, d):
    df = c.null_tokens(raw(spark, d, "cars"))
    return df.select(
        "car_id",
        c.number_in("mileage", "([0-9.]+)", "double").alias("mileage"),
        c.number_in("engine", "([0-9]+)", "int").alias("engine"),
        c.number_in("max_power", "([0-9.]+)", "double").alias("max_power"),
    )


@query
def custom_ts_parse(spark, d):
    df = raw(spark, d, "sales")
    for name in ("ad_placed_on", "sold_on"):
        df = df.withColumn(name, c.to_ts(c.force_null(name), presets.SALES_TS_FORMAT))
    return df.select("sales_id", _ts("ad_placed_on"), _ts("sold_on"))


@query
def string_columns_trim(spark, d):
    """Tokens first, trim second: a token inside blanks survives."""
    df = c.null_tokens(raw(spark, d, "policy"), ("?", "NULL", "null", ""))
    return c.map_string_columns(df, F.trim).filter(F.col("policy_number").isNotNull())


# ---- silver entities ------------------------------------------------------------------------


@planned
def _policy(spark, d):
    return silver.policy_silver(raw(spark, d, "policy"))


def _claim_keys(spark, d):
    """The cleaned key of all claims, to look for hot keys in."""
    return silver.claims(raw(spark, d, "claims")).select("PolicyID")


@planned
def _claims(spark, d):
    return silver.claims_silver(raw(spark, d, "claims"), _policy(spark, d))


@query
def silver_policy(spark, d):
    df = _policy(spark, d)
    return df.withColumns(
        {"policy_bind_date": _ts("policy_bind_date"), "policy_annual_premium": _double("policy_annual_premium")}
    )


@query
def silver_claims(spark, d):
    df = _claims(spark, d)
    return df.withColumns(
        {
            "policy_bind_date": _ts("policy_bind_date"),
            **{n: _double(n) for n in ("injury", "property", "vehicle")},
        }
    )


@query
def silver_sales(spark, d):
    df = silver.sales_silver(raw(spark, d, "sales"))
    return df.withColumns({n: _ts(n) for n in ("ad_placed_on", "sold_on")})


@query
def silver_cars(spark, d):
    df = silver.cars_silver(raw(spark, d, "cars"))
    return df.withColumns({n: _double(n) for n in ("mileage", "max_power")})


@query
def silver_customers(spark, d):
    return silver.customers_silver(raw(spark, d, "customers")).withColumn("_loaded_at", _ts("_loaded_at"))


@query
def silver_customers_enforced(spark, d):
    df = silver.customers_silver(raw(spark, d, "customers"), enforce=True)
    return df.withColumn("_loaded_at", _ts("_loaded_at"))


# ---- rules and issues -----------------------------------------------------------------------


@query
def rules_valid(spark, d):
    df = rules.keep_valid(silver.claims(raw(spark, d, "claims")), presets.CLAIM_RULES)
    return df.select("ClaimID", "PolicyID", "incident_date", "Claim_Logged_On", "Claim_Processed_On")


@query
def rules_valid_stored(spark, d):
    """Rules over stored columns: the scan itself skips what breaks them."""
    return rules.keep_valid(tables.read_table(spark, d, "events"), EVENT_RULES, cleaned=False).select("event_id", "event_type")


@query
def rules_quarantine(spark, d):
    df = rules.quarantine(silver.claims(raw(spark, d, "claims")), presets.CLAIM_RULES)
    return df.select("ClaimID", "PolicyID", "incident_date", "Claim_Logged_On", "Claim_Processed_On")


@query
def rules_quarantine_literal(spark, d):
    df = rules.quarantine(silver.customers(raw(spark, d, "customers")), presets.CUSTOMER_RULES, "literal")
    return df.select("CustomerID", "Region", "Balance", "Marital", "Education", "_source_file")


@query
def rules_measure(spark, d):
    return rules.measure(silver.claims(raw(spark, d, "claims")), presets.CLAIM_RULES)


@query
def timeline_rules(spark, d):
    lines = {"t1": presets.TIMELINE_1, "t2": presets.TIMELINE_2, "t3": presets.TIMELINE_3}
    df = silver.claims(raw(spark, d, "claims"))
    return df.select("ClaimID", *[F.expr(rule).alias(n) for n, rule in lines.items()])


ENTITIES = {
    "policy": (silver.policy, presets.POLICY_RULES, presets.POLICY_ISSUES, "policy_number"),
    "claims": (silver.claims, presets.CLAIM_RULES, presets.CLAIM_ISSUES, "ClaimID"),
    "sales": (silver.sales, presets.SALES_RULES, presets.SALES_ISSUES, "sales_id"),
    "customers": (silver.customers, presets.CUSTOMER_RULES, presets.CUSTOMER_ISSUES, "CustomerID"),
    "cars": (silver.cars, presets.CAR_RULES, presets.CAR_ISSUES, "car_id"),
}


def _log(spark, d, name):
    clean, row_rules, spec, _ = ENTITIES[name]
    return quarantine.issue_log(clean(raw(spark, d, name)), row_rules, spec)


def _issues(name: str) -> Query:
    def run(spark, d):
        key = ENTITIES[name][3]
        return _log(spark, d, name).select(
            "table_name",
            "column_name",
            "issue_description",
            "severity",
            F.get_json_object("affected_record", f"$.{key}").alias("record_key"),
        )

    return _fresh(run)


for _name in ENTITIES:
    QUERIES[f"issues_{_name}"] = _issues(_name)


@query
def issue_rollup(spark, d):
    return quarantine.rollup(quarantine.union_logs([_log(spark, d, n) for n in ENTITIES]))


@query
def dq_explain(spark, d):
    report = quarantine.explain(_log(spark, d, "sales"), replies.headline)
    return report.drop("issue_id", "detected_at", "generated_at", "affected_records")


@query
def issue_record(spark, d):
    """The record of each bad row as JSON, NULL fields included."""
    events = tables.read_table(spark, d, "events").select(
        "event_id", "user_id", "event_type", F.when(F.col("value") >= 5, F.floor("value")).alias("value")
    )
    log = quarantine.issue_log(events, {"value_known": "value IS NOT NULL"}, EVENT_ISSUES)
    return log.select("table_name", "column_name", "severity", "affected_record")


@query
def observed_counts(spark, d):
    """Warn-only rules: all rows flow on, counts arrive with the write."""
    lines = tables.read_table(spark, d, "lineitem")
    watched, seen = rules.observe(lines, {"big": "l_quantity >= 25", "taxed": "l_tax > 0"}, "lines")
    watched.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(seen.get.items()), "measure string, n bigint")


@query
def temp_view(spark, d):
    tables.as_view(tables.read_table(spark, d, "events").filter("event_type = 'click'"), "clicks")
    return spark.sql("SELECT user_id, count(*) AS clicks FROM clicks GROUP BY user_id")


@query
def glob_class(spark, d):
    """A character class in the glob takes both spellings of a name and leaves other files alone."""
    root = shared_dir(spark, "globs")
    suppliers = tables.read_table(spark, d, "supplier").select("s_suppkey", "s_name")
    third = F.pmod("s_suppkey", F.lit(3))
    for n, name in enumerate(("cars", "Cars", "bars")):
        folder = f"{root}/{name}"
        suppliers.filter(third == n).coalesce(1).write.option("header", "true").csv(folder)
    read = [ingest.read_files(spark, f"{root}/{name}", "csv", "[Pp]art-*.csv") for name in ("cars", "Cars")]
    none = ingest.read_files(spark, f"{root}/bars", "csv", "[Qq]art-*.csv", "s_suppkey bigint, s_name string")
    rows = reduce(DataFrame.unionByName, [*read, none])
    return rows.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name")


@query
def overwrite_schema(spark, d):
    """A stored table that is written anew with other columns."""
    name = f"tidemark_overwrite_{shared_dir(spark, 'name')[-32:]}"
    tables.overwrite_table(tables.read_table(spark, d, "nation"), name)
    regions = tables.read_table(spark, d, "nation").groupBy("n_regionkey").agg(F.count("*").alias("nations"))
    tables.overwrite_table(tables.store(regions, shared_dir(spark, "regions")), name)
    out = tables.store(spark.table(name), shared_dir(spark, "overwritten"))
    spark.sql(f"DROP TABLE {name}")
    return out


@query
def newest_first(spark, d):
    """The latest 50 entries of a log, with their place in it."""
    log = tables.read_table(spark, d, "events").select("event_id", "ts")
    latest = retrieval.newest_first(log.groupBy("ts").agg(F.max("event_id").alias("event_id")), "ts").limit(50)
    return latest.withColumn("place", F.monotonically_increasing_id()).select("place", "event_id")


@query
def vector_ops(spark, d):
    """Unit vectors and dot products in expressions."""
    rows = tables.read_table(spark, d, "embeddings")
    unit = vectors.normalise(F.col("embedding"))
    return rows.select(
        "vec_id",
        F.round(vectors.dot(unit, unit), 9).alias("length"),
        F.round(vectors.dot(F.col("embedding"), unit), 4).alias("norm"),
        F.round(F.get(unit, F.lit(0)), 6).alias("first"),
    )


# ---- dedup and upsert -----------------------------------------------------------------------


@query
def dedup_first(spark, d):
    lines = tables.read_table(spark, d, "lineitem").drop("l_shipdate")
    return dedup.dedup_first(lines, ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


@query
def dedup_count(spark, d):
    lines = tables.read_table(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    kept = dedup.dedup_first(lines.select(*keys, "l_partkey"), keys).agg(F.count("*").alias("rows_kept"))
    return kept


@query
def completeness(spark, d):
    return silver.customers(raw(spark, d, "customers")).select("CustomerID", "_source_file", "completeness_score")


@query
def upsert_latest(spark, d):
    events = tables.read_table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedup.latest_by_key(events, ["user_id"], ["ts", "event_id"], hide=["ts"])


# ---- star schema, marts, KPIs ---------------------------------------------------------------


@planned
def _facts(spark, d):
    """Claims meet their policies once: bind date, keys and policy type come along."""
    return star.fact_claims(silver.claims_silver(raw(spark, d, "claims"), _policy(spark, d), carry=star.LINKS))


@planned
def _dim_policy(spark, d):
    return star.dim_policy(_policy(spark, d))


@planned
def _dim_customer(spark, d):
    return star.dim_customer(silver.customers_silver(raw(spark, d, "customers")))


@planned
def _dim_car(spark, d):
    return star.dim_car(silver.cars_silver(raw(spark, d, "cars")))


@planned
def _fact_sales(spark, d):
    return star.fact_sales(silver.sales_silver(raw(spark, d, "sales")), F.lit(AS_OF).cast("date"))


@query
def fact_claims(spark, d):
    df = _facts(spark, d).drop("policy_type")
    dates = ("incident_date", "claim_logged_on", "claim_processed_on")
    return df.withColumns(
        {
            **{n: F.col(n).cast("string") for n in dates},
            **{n: _double(n) for n in ("injury", "property", "vehicle")},
        }
    )


@query
def dim_policy(spark, d):
    return _dim_policy(spark, d).withColumns(
        {"policy_bind_date": _ts("policy_bind_date"), "policy_annual_premium": _double("policy_annual_premium")}
    )


@query
def dim_customer(spark, d):
    return _dim_customer(spark, d)


@query
def dim_car(spark, d):
    return _dim_car(spark, d).withColumns({n: _double(n) for n in ("mileage", "max_power")})


@query
def fact_sales_asof(spark, d):
    return _fact_sales(spark, d).withColumns({n: _ts(n) for n in ("ad_placed_on", "sold_on")})


@query
def customer_identity(spark, d):
    return marts.customer_identity(_dim_customer(spark, d))


@query
def claim_performance(spark, d):
    return marts.claim_performance(_facts(spark, d), _dim_customer(spark, d))


@query
def inventory_status(spark, d):
    return marts.inventory_status(_fact_sales(spark, d), _dim_car(spark, d))


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(
        *[F.round(n, digits).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes]
    )


@query
def kpi_claims(spark, d):
    return _rounded(kpi.claims(_facts(spark, d)))


def _kpi_policy(exact: bool) -> Query:
    return _fresh(lambda spark, d: _rounded(kpi.policy(_dim_policy(spark, d), _facts(spark, d), exact)))


def _kpi_customer(exact: bool) -> Query:
    return _fresh(lambda spark, d: _rounded(kpi.customer(_dim_customer(spark, d), _facts(spark, d), exact)))


QUERIES["kpi_policy"] = _kpi_policy(False)
QUERIES["kpi_policy_exact"] = _kpi_policy(True)
QUERIES["kpi_customer"] = _kpi_customer(False)
QUERIES["kpi_customer_exact"] = _kpi_customer(True)


def _kpi_rows(spark, d):
    facts = tables.store(_facts(spark, d), shared_dir(spark, "facts"))     # read three times
    return {
        "claims_performance": kpi.claims(facts),
        "policy_portfolio": kpi.policy(_dim_policy(spark, d), facts),
        "customer_profile": kpi.customer(_dim_customer(spark, d), facts),
    }


@query
def kpi_json(spark, d):
    """The figures survive the trip through JSON."""
    row = kpi.claims(_facts(spark, d))
    back = kpi.as_json(row).select(F.from_json("kpi_json", row.schema).alias("k")).select("k.*")
    return _rounded(back)


@query
def kpi_union(spark, d):
    total = F.coalesce(
        *[F.get_json_object("kpi_json", f"$.total_{what}") for what in ("claims", "policies", "customers")]
    )
    return kpi.union_domains(_kpi_rows(spark, d)).select("domain_name", total.cast("bigint").alias("total"))


@query
def kpi_union_figures(spark, d):
    """Every figure of all three domains, out of the JSON it travels in."""
    figures = F.from_json("kpi_json", "map<string,double>")
    rows = kpi.union_domains(_kpi_rows(spark, d)).select("domain_name", F.explode(figures).alias("figure", "value"))
    return rows.filter("value IS NOT NULL").withColumn("value", F.round("value", 4))


@query
def kpi_summaries(spark, d):
    return kpi.summaries(_kpi_rows(spark, d), replies.headline).drop("kpi_json", "generation_timestamp")


@query
def dq_explain_capped(spark, d):
    """A cap on what is explained: how many reports come out, and that each is of an issue in the log."""
    log = _log(spark, d, "sales")
    report = quarantine.explain(log, replies.headline, limit=7).select("column_name", "severity")
    known = log.select("column_name", "severity").distinct()
    return report.join(known, ["column_name", "severity"], "left_semi").agg(F.count("*").alias("reports"))


@query
def avg_amount_text(spark, d):
    return kpi.average_amount_text(_facts(spark, d))


@query
def explain_amount(spark, d):
    return kpi.ask_about_amount(_facts(spark, d), replies.headline)


@query
def summary_table(spark, d):
    """Create, insert, empty, insert again, read one domain: the stored form of the summaries."""
    path = shared_dir(spark, "summaries")
    name = f"tidemark_insights_{path[-32:]}"
    insights = kpi.summaries(
        {"customer_profile": marts.customer_identity(_dim_customer(spark, d)).agg(
            F.sum("total_unique_customers").alias("total_customers")
        )},
        replies.headline,
    )
    tables.create_table(spark, name, kpi.INSIGHT_COLUMNS, path)
    tables.insert(insights, name)
    tables.truncate(spark, name)
    tables.insert(insights, name)
    spark.sql(f"DROP TABLE {name}")     # external: the files stay
    stored = spark.read.schema(kpi.INSIGHT_COLUMNS).parquet(path)
    total = F.get_json_object("kpi_json", "$.total_customers").cast("bigint")
    figures = stored.select("domain_name", total.alias("total_customers"))
    return kpi.summary_of(stored, "customer_profile").join(figures, "domain_name")


# ---- risk -----------------------------------------------------------------------------------


@planned
def _scored(spark, d):
    return risk.scored(_claims(spark, d), sketch_of=_claim_keys(spark, d))


@query
def policy_claim_count(spark, d):
    claims = silver.claims(raw(spark, d, "claims")).select("ClaimID", "PolicyID")
    return skew.count_per_key(claims, ["PolicyID"], "policy_claim_count")


FEATURES = (
    "report_delay_days",
    "processing_days",
    "claim_lifecycle_days",
    "total_loss_amount",
    "complexity_points",
    "authority_report_mismatch",
    "high_severity_no_police_report",
    "severity_rank",
    "policy_claim_count",
)


@query
def risk_features(spark, d):
    return _scored(spark, d).select("ClaimID", *FEATURES)


@query
def risk_rules(spark, d):
    return _scored(spark, d).select("ClaimID", *[name for name, _, _, _ in presets.RISK_RULES])


@query
def risk_score(spark, d):
    return _scored(spark, d).select("ClaimID", "raw_anomaly_points", "anomaly_score", "priority_tier")


@query
def risk_tier_counts(spark, d):
    return _scored(spark, d).groupBy("priority_tier").agg(F.count("*").alias("claims"))


@query
def risk_fired(spark, d):
    return _scored(spark, d).select("ClaimID", F.array_join("triggered_rules", "; ").alias("triggered_rules"))


@query
def risk_flagged(spark, d):
    return risk.flagged(_scored(spark, d), 45).select("ClaimID", "anomaly_score")


@query
def risk_flag_summary(spark, d):
    return risk.flag_summary(_scored(spark, d), 45)


REPORT_SHOWN = [n for n, _, _ in risk.REPORT_COLUMNS if n != "triggered_rules"]


@query
def risk_report(spark, d):
    report = risk.report(_scored(spark, d), replies.headline)
    return report.select(
        *REPORT_SHOWN,
        F.size("triggered_rules").alias("rules_fired"),
        "ai_investigation_brief",
        "model_name",
        "generation_status",
    )


@query
def risk_top(spark, d):
    scored = _scored(spark, d).withColumnRenamed("ClaimID", "claim_id")
    return risk.top_claims(scored, 3).select("claim_id", "anomaly_score", "priority_tier")


# ---- documents and retrieval ----------------------------------------------------------------


@query
def doc_render(spark, d):
    df = _dim_policy(spark, d).withColumns(
        {"policy_bind_date": _ts("policy_bind_date"), "policy_annual_premium": F.floor("policy_annual_premium")}
    )
    return df.select("policy_id", text.render(presets.POLICY_DOCUMENT).alias("document_text"))


@query
def doc_chunks(spark, d):
    chunks = text.chunk(tables.read_table(spark, d, "documents"), ["doc_id"], "text")
    return chunks.select(
        "doc_id", "chunk_no", F.length("chunk_text").alias("chars"), F.md5("chunk_text").alias("digest")
    )


@query
def doc_chunks_trimmed(spark, d):
    documents = tables.read_table(spark, d, "documents")
    return text.chunk(documents, ["doc_id"], "text", drop_contained=True).groupBy("doc_id").agg(
        F.count("*").alias("chunks"), F.sum(F.length("chunk_text")).alias("chars")
    )


@query
def embed_hash(spark, d):
    documents = vectors.embed(tables.read_table(spark, d, "documents").select("doc_id", "text"), "text")
    counts = documents.select("doc_id", F.posexplode("embedding").alias("place", "words"))
    return counts.filter("words > 0").withColumn("words", _double("words"))


@query
def embed_tfidf(spark, d):
    documents = tables.read_table(spark, d, "documents").select("doc_id", "text")
    encoded = tfidf.encode(documents, ["doc_id"], "text", tfidf.fit(documents, "text"))
    return encoded.withColumn("weight", F.round("weight", 6))


@query
def knn_tfidf(spark, d):
    """The three documents nearest to each benchmark item, by fitted sparse vectors."""
    documents = tables.read_table(spark, d, "documents").select("doc_id", "text")
    model = tfidf.fit(documents, "text")
    asked = tables.read_table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    corpus, questions = (tfidf.encode(t, [i], "text", model) for t, i in ((documents, "doc_id"), (asked, "query_id")))
    return tfidf.nearest(questions, corpus, presets.TOP_K).withColumn("score", F.round("score", 6))


def centroids(spark, d):
    """The mean vector of each label, as queries."""
    places = tables.read_table(spark, d, "embeddings").select(
        F.col("label").alias("query_id"), F.posexplode("embedding").alias("place", "x")
    )
    means = places.groupBy("query_id", "place").agg(F.avg("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "x")))
    return means.groupBy("query_id").agg(F.transform(ordered, lambda p: p["x"]).alias("embedding"))


def _label_hits(spark, d):
    corpus = tables.read_table(spark, d, "embeddings")
    return _score_digits(retrieval.knn(centroids(spark, d), corpus, 5, id_col="vec_id", payload=["label"]))


def _score_digits(hits):
    """Scores as reported; ranks were settled before."""
    return hits.withColumn("score", F.round("score", 6))


@query
def knn_topk(spark, d):
    return _label_hits(spark, d)


@query
def knn_confidence(spark, d):
    return retrieval.confidence(_label_hits(spark, d), "label")


@query
def knn_sources(spark, d):
    return retrieval.sources(_label_hits(spark, d), "label")


def _chunk_hits(spark, d, k=presets.TOP_K):
    chunks = text.chunk(tables.read_table(spark, d, "documents"), ["doc_id"], "text")
    named = chunks.select(F.concat_ws(":", "doc_id", "chunk_no").alias("chunk_id"), "doc_id", "chunk_text")
    corpus = vectors.embed(named, "chunk_text")
    asked = tables.read_table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    questions = vectors.embed(asked, "text")
    return _score_digits(retrieval.knn(questions, corpus, k, id_col="chunk_id", payload=["doc_id", "chunk_text"]))


@query
def knn_all_pairs(spark, d):
    """Every vector as a query, in several blocks, against a corpus in which every id occurs twice."""
    corpus = tables.read_table(spark, d, "embeddings").select("vec_id", "embedding")
    twice = corpus.withColumn("copy", F.lit(0)).unionByName(corpus.withColumn("copy", F.lit(1)))
    asked = corpus.withColumnRenamed("vec_id", "query_id")
    hits = _score_digits(retrieval.knn(asked, twice, 6, id_col="vec_id", block_queries=300))
    return hits.groupBy("query_id", "vec_id", "score").agg(F.count("*").alias("copies"))


@query
def knn_chunks(spark, d):
    return _chunk_hits(spark, d).select("query_id", "chunk_id", "doc_id", "score", "rank")


@query
def rag_context(spark, d):
    return retrieval.context(_chunk_hits(spark, d), "doc_id", "chunk_text")


@query
def rag_history(spark, d):
    """Questions to answers: retrieve, build the prompt, answer, rate, log."""
    hits = _chunk_hits(spark, d, k=10)
    questions = tables.read_table(spark, d, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )
    found = questions.join(retrieval.digest(hits, "doc_id", "chunk_text"), "query_id", "left")
    asked = prompts.prompt(
        found, prompts.ANSWER_TEMPLATE, {"context": F.col("context"), "question": F.col("question")}
    )
    answers = infer.map_text(asked, "prompt", replies.count_sources)
    path = shared_dir(spark, "history")
    tables.append(retrieval.history(answers.withColumnRenamed("reply_text", "answer")), path)
    return retrieval.newest_first(spark.read.parquet(path)).drop("query_timestamp")


# ---- prompts and text functions -------------------------------------------------------------


@query
def prompt_build(spark, d):
    talk = tables.read_table(spark, d, "conversations")
    asked = prompts.prompt(
        talk, "Turn {turn} by {role}:\n{text}\n", {n: F.col(n) for n in ("turn", "role", "text")}
    )
    return asked.select("conv_id", "turn", "prompt")


@query
def reply_text(spark, d):
    """Replies in three shapes: blocks with text, blocks without, plain."""
    talk = tables.read_table(spark, d, "conversations")

    def block(kind: str):
        return F.struct(F.lit(kind).alias("type"), F.col("text"))

    reply = (
        F.when(F.col("role") == "assistant", F.to_json(F.array(block("reasoning"), block("text"))))
        .when(F.col("role") == "system", F.to_json(F.array(block("reasoning"))))
        .otherwise(F.col("text"))
    )
    return talk.select("conv_id", "turn", infer.reply_text(reply).alias("reply"))


@query
def infer_status(spark, d):
    talk = tables.read_table(spark, d, "conversations")
    asked = talk.select("conv_id", "turn", F.concat_ws(": ", "role", "text").alias("prompt"))
    return infer.map_text(asked, "prompt", replies.by_role).drop("prompt")


@query
def infer_kept(spark, d):
    """Two runs over one store of answers: the first on some of the rows, the second on all of them."""
    talk = tables.read_table(spark, d, "conversations")
    asked = talk.select("conv_id", "turn", F.concat_ws(": ", "role", "text").alias("prompt"))
    fn, path = replies.InBatches(replies.by_role), shared_dir(spark, "answers")
    infer.map_text_kept(asked.filter("turn > 0"), "prompt", fn, path, slices=2)
    return infer.map_text_kept(asked, "prompt", fn, path, slices=2).drop("prompt")


@query
def infer_all_statuses(spark, d):
    talk = tables.read_table(spark, d, "conversations").select("conv_id", "turn", "text")
    return infer.map_text(talk, "text", replies.by_length).drop("text")


@query
def infer_retry(spark, d):
    """A function that is throttled on the first call for each prompt."""
    talk = tables.read_table(spark, d, "conversations")
    asked = talk.select("conv_id", "turn", F.concat_ws(" ", "conv_id", "turn", "role").alias("prompt"))
    return infer.map_text(asked, "prompt", replies.OnSecondCall(), backoff=0.0).drop("prompt")


# ---- files ----------------------------------------------------------------------------------

SEGMENT_HEADERS = (
    # segments, header of their files
    (("AUTOMOBILE", "BUILDING"), ("CustomerID", "Region", "Balance")),
    (("FURNITURE", "MACHINERY"), ("Customer_ID", "Reg", "Balance")),
    (("HOUSEHOLD",), ("cust_id", "Reg", "Balance", "Tier")),
)


def _write_drifting(spark, d) -> str:
    """The customer table as CSV files whose headers differ by segment."""
    root = shared_dir(spark, "drift")
    customers = tables.read_table(spark, d, "customer")
    columns = ("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    for n, (segments, header) in enumerate(SEGMENT_HEADERS):
        rows = customers.filter(F.col("c_mktsegment").isin(*segments))
        named = rows.select(*[F.col(old).alias(new) for old, new in zip(columns, header)])
        named.write.option("header", "true").csv(f"{root}/customers_{n}")
    return root


DRIFT_ALIASES = {
    "CustomerID": presets.CUSTOMER_ALIASES["CustomerID"],
    "Region": presets.CUSTOMER_ALIASES["Region"],
    "Balance": ("Balance",),
}


@query
def drifting_csv(spark, d):
    rows = ingest.drifting_csv(spark, _write_drifting(spark, d), "*.csv", DRIFT_ALIASES)
    return rows.select(
        F.col("CustomerID").try_cast("bigint").alias("customer_id"),
        F.col("Region").alias("region"),
        F.col("Balance").try_cast("double").alias("balance"),
        F.get_json_object(ingest.RESCUED, "$.Tier").cast("int").alias("tier"),
    )


def _evolved(spark, d) -> str:
    """Files of three headers arrive one by one; the second adds no column, the last adds Tier."""
    root = shared_dir(spark, "evolving")
    customers = tables.read_table(spark, d, "customer")
    columns = ("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    for n, (segments, header) in enumerate(SEGMENT_HEADERS):
        rows = customers.filter(F.col("c_mktsegment").isin(*segments))
        named = rows.select(*[F.col(old).alias(new) for old, new in zip(columns, header)])
        named.coalesce(1).write.option("header", "true").csv(f"{root}/in/customers_{n}")
        schema_log.csv_flow(spark, f"{root}/in", "*.csv", f"{root}/table", f"{root}/checkpoint", 1, DRIFT_ALIASES)
    return f"{root}/table"


@query
def evolving_csv(spark, d):
    """A column that a later header brings is a column, NULL in older rows, with its own type."""
    rows = schema_log.read(spark, _evolved(spark, d))
    return rows.select(
        F.col("CustomerID").cast("bigint").alias("customer_id"), F.col("Region").alias("region"),
        F.col("Balance").alias("balance"), F.col("Tier").alias("tier"),
    )


@query
def schema_versions(spark, d):
    """What the log holds: the types were found while the rows were written."""
    columns = schema_log.SchemaLog(spark, _evolved(spark, d)).columns()
    return tables.typed_rows(spark, columns, "name string, first_batch long, type string")


@query
def csv_groups(spark, d):
    root = _write_drifting(spark, d)
    groups = [
        ingest.csv_groups(spark, f"{root}/customers_{n}", ["*.csv"]) for n in range(len(SEGMENT_HEADERS))
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
    return rows.select(
        c.first_of(rows, presets.CUSTOMER_ALIASES["CustomerID"]).alias("customer_id"),
        c.first_of(rows, presets.CUSTOMER_ALIASES["Region"]).alias("region"),
        F.col("Balance").try_cast("double").alias("balance"),
        F.col("Tier").alias("tier"),
    )


@query
def csv_ingest(spark, d):
    """CSV with inferred types and lineage, and the warn-only lineage rule."""
    root = shared_dir(spark, "csv")
    tables.read_table(spark, d, "part").write.option("header", "true").csv(f"{root}/cars")
    rows = ingest.read_files(spark, root, "csv", "*.csv")
    return rules.measure(rows, {**presets.LINEAGE_RULES, **rules.non_negative("p_size - 10")})


@query
def json_rescue(spark, d):
    root = shared_dir(spark, "json")
    events = tables.read_table(spark, d, "events")
    written = events.select(
        F.when(
            F.col("event_type") == "error",
            F.to_json(F.struct("event_id", "user_id", "event_type", F.lit("n/a").alias("value"))),
        )
        .when(F.col("event_type") == "signup", F.concat(F.lit("not json "), F.col("event_id").cast("string")))
        .otherwise(F.to_json(F.struct("event_id", "user_id", "event_type", "value")))
        .alias("value")
    )
    written.write.text(f"{root}/claims")
    rows = ingest.json_rescue(spark, root, "*.txt", "event_id bigint, user_id bigint, value double")
    return rows.select("event_id", "user_id", "value", F.col(ingest.RESCUED).alias("rescued"))


def _padded(key: str):
    return F.lpad(F.col(key).cast("string"), 12, "0")


@query
def bronze_text_keys(spark, d):
    """Keys padded with zeros, in CSV on one side and JSON on the other, meet as written."""
    root, bronze = shared_dir(spark, "text-keys"), shared_dir(spark, "text-bronze")
    orders, lines = (tables.read_table(spark, d, t) for t in ("orders", "lineitem"))
    policy = orders.select(_padded("o_orderkey").alias("policy_number"), F.lit("2020-01-01").alias("policy_bind_date"))
    policy.write.option("header", "true").csv(f"{root}/policy")
    claim = F.concat_ws("-", _padded("l_orderkey"), "l_linenumber")
    lines.select(claim.alias("ClaimID"), _padded("l_orderkey").alias("PolicyID")).write.json(f"{root}/claims")
    for name in ("policy", "claims"):
        pipeline.bronze_entity(spark, f"{root}/{name}", bronze, name, "part-*", MAX_FILES)
    claims = silver.claims(flows.read_sink(spark, f"{bronze}/bronze/claims")).select("ClaimID", "PolicyID")
    joined = silver.enrich_claims(
        claims.withColumns({n: F.lit(0) for n in ("incident_date", "Claim_Logged_On", "Claim_Processed_On")}),
        silver.policy(flows.read_sink(spark, f"{bronze}/bronze/policy")),
    )
    return joined.select("ClaimID", "PolicyID", F.date_format("policy_bind_date", "yyyy-MM-dd").alias("bound"))


@query
def bronze_claims_rescue(spark, d):
    """Claims with a field nobody knows, and lines that are no JSON, lose nothing."""
    root, bronze = shared_dir(spark, "rescue"), shared_dir(spark, "rescue-bronze")
    events = tables.read_table(spark, d, "events")
    known = {"ClaimID": F.col("event_id").cast("string"), "PolicyID": F.col("user_id").cast("string")}
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), F.col("event_id").cast("string")))
        .when(F.col("event_type") == "click", F.to_json(F.struct(*[v.alias(k) for k, v in known.items()], F.lit("x").alias("surprise"))))
        .otherwise(F.to_json(F.struct(*[v.alias(k) for k, v in known.items()])))
    )
    events.select(line.alias("value")).write.text(f"{root}/claims")
    pipeline.bronze_entity(spark, f"{root}/claims", bronze, "claims", "part-*", MAX_FILES)
    rows = flows.read_sink(spark, f"{bronze}/bronze/claims")
    return rows.select("ClaimID", "PolicyID", F.col(ingest.RESCUED).alias("rescued"))


# ---- streams --------------------------------------------------------------------------------

EVENT_RULES = {**rules.one_of("event_type", ("view", "click", "purchase", "signup")), "value_floor": "value >= 5"}
EVENT_ISSUES = IssueSpec(
    table="events",
    cases=(("event_type = 'error'", "event_type", "Unexpected event"),),
    other_column="value",
    other_description="Value too small",
    levels=(("event_type = 'error'", "3"),),
    other_level="2",
)


def _events(spark, d):
    return ingest.table_stream(spark, f"{d}/events.parquet")


def _places(spark, purpose: str) -> tuple[str, str]:
    root = shared_dir(spark, purpose)
    return f"{root}/table", f"{root}/checkpoint"


@query
def stream_rules(spark, d):
    good, checkpoint = _places(spark, "stream-rules")
    issues = good.replace("/table", "/issues")
    flows.split_flow(_events(spark, d), lambda df: df, EVENT_RULES, EVENT_ISSUES, good, issues, checkpoint)
    kept = flows.read_sink(spark, good).select("event_id", F.lit("kept").alias("went_to"))
    bad = flows.read_sink(spark, issues).select(
        F.get_json_object("affected_record", "$.event_id").cast("bigint").alias("event_id"),
        F.col("column_name").alias("went_to"),
    )
    return kept.unionByName(bad)


@query
def stream_dedup(spark, d):
    path, checkpoint = _places(spark, "stream-dedup")
    flows.dedup_flow(spark, _events(spark, d), ["user_id", "event_type"], path, checkpoint, ["ts", "event_id"])
    return flows.read_sink(spark, path).select("user_id", "event_type", "event_id")


@query
def stream_static_join(spark, d):
    path, checkpoint = _places(spark, "stream-join")
    customers = tables.read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    flows.enrich_flow(_events(spark, d), customers, ["user_id"], path, checkpoint)
    return flows.read_sink(spark, path).select("event_id", "user_id", "segment")


@query
def stream_upsert(spark, d):
    path, checkpoint = _places(spark, "stream-upsert")
    rows = _events(spark, d).select("user_id", "ts", "event_id", "event_type", "value")
    flows.upsert_flow(rows, ["user_id"], ["ts", "event_id"], path, checkpoint)
    return flows.read_upsert(spark, path, ["user_id"], ["ts", "event_id"], hide=["ts"])


def _in_batches(spark, d, purpose: str, batches: int = 6):
    """The events in several files, one micro-batch each."""
    path = f"{shared_dir(spark, purpose)}/events"
    tables.read_table(spark, d, "events").repartition(batches, "event_id").write.parquet(path)
    return ingest.table_stream(spark, path, max_files=1)


@query
def stream_observed_counts(spark, d):
    """Warn-only rules on a stream of several micro-batches: every row is kept, and counted as it is written."""
    path, checkpoint = _places(spark, "stream-counts")
    counts = path.replace("/table", "/counts")
    flows.watched_flow(_in_batches(spark, d, "counts"), EVENT_RULES, path, counts, checkpoint)
    kept = flows.read_sink(spark, path).agg(F.count("*").alias("rows_kept"))
    return flows.read_counts(spark, counts).join(F.broadcast(kept))      # one row


@query
def stream_dedup_batches(spark, d):
    """Keys that come again in later micro-batches are found by the key index."""
    path, checkpoint = _places(spark, "stream-dedup-batches")
    flows.dedup_flow(spark, _in_batches(spark, d, "dedup"), ["user_id", "event_type"], path, checkpoint, ["ts", "event_id"])
    rows = flows.read_sink(spark, path)
    return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("rows"))


@query
def stream_upsert_batches(spark, d):
    """The upsert store after several micro-batches and a compaction."""
    path, checkpoint = _places(spark, "stream-upsert-batches")
    rows = _in_batches(spark, d, "upsert").select("user_id", "ts", "event_id", "event_type", "value")
    flows.upsert_flow(rows, ["user_id"], ["ts", "event_id"], path, checkpoint)
    return flows.read_upsert(spark, path, ["user_id"], ["ts", "event_id"], hide=["ts"])


@query
def stream_state_upsert(spark, d):
    """Upsert as keyed state: the last row that came out for a user is the user's winner."""
    path, checkpoint = _places(spark, "stream-state-upsert")
    rows = _in_batches(spark, d, "state").select("user_id", "ts", "event_id", "event_type", "value")
    flows.run_flow(flows.state_upsert(rows, ["user_id"], ["ts", "event_id"]), path, checkpoint)
    winners = spark.read.parquet(path).groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type", "value"), "batch_id").alias("r"))
    return winners.select("user_id", "r.event_id", "r.event_type", "r.value")


EVENT_PARTS = Partials(
    ("user_id",),
    {
        "events": ("count", "event_id"),
        "purchases": ("count_if", "event_type = 'purchase'"),
        "spent": ("sum", "CAST(round(value * 100) AS BIGINT)"),
        "first_event": ("min", "event_id"),
        "last_event": ("max", "event_id"),
    },
)


@query
def stream_aggregate(spark, d):
    """Parts of each micro-batch, merged in segments and at the read; a mean is made last."""
    path, checkpoint = _places(spark, "stream-aggregate")
    flows.aggregate_flow(_in_batches(spark, d, "aggregate"), EVENT_PARTS.of, EVENT_PARTS.merge, path, checkpoint)
    return EVENT_PARTS.table(spark, path).read().withColumn("mean_spent", F.round(F.col("spent") / F.col("events"), 6))


@query
def stream_multi_flow(spark, d):
    path, checkpoint = _places(spark, "stream-flows")
    events = _events(spark, d).select("event_id", "event_type")
    names = ("view", "click", "purchase", "signup", "error")
    flows.multi_flow({n: events.filter(F.col("event_type") == n) for n in names}, path, checkpoint)
    return flows.read_sink(spark, path).groupBy("flow", "event_type").agg(F.count("*").alias("events"))


@query
def stream_ingest(spark, d):
    """CSV files found and read as a stream, lineage included."""
    root = shared_dir(spark, "stream-csv")
    tables.read_table(spark, d, "supplier").write.option("header", "true").csv(f"{root}/in")
    stream = ingest.file_stream(spark, f"{root}/in", "csv", "*.csv")
    flows.run_flow(stream, f"{root}/table", f"{root}/checkpoint")
    rows = flows.read_sink(spark, f"{root}/table")
    return rows.select(
        F.col("s_suppkey").cast("bigint").alias("s_suppkey"),
        "s_name",
        F.col("s_acctbal").cast("double").alias("s_acctbal"),
        (F.col("_source_file").isNotNull() & F.col("_loaded_at").isNotNull()).alias("has_lineage"),
    )


MAX_FILES = 1000      # per micro-batch


#: Raw files are compressed, and a compressed file is read by one task: so many lines each at most.
RAW_FILE = {"compression": "gzip", "maxRecordsPerFile": 250_000}


def _write_raw(spark, d, name) -> str:
    """A raw input as the files it stands for: CSV with headers, claims as JSON lines."""
    root = shared_dir(spark, f"raw-{name}")
    rows = raw(spark, d, name).drop("_source_file", "_loaded_at")
    if name == "claims":
        rows.write.options(**RAW_FILE).json(root)
        return root
    if name == "customers":
        rows = rows.withColumnsRenamed({"CustomerID": "cust_id", "Region": "Reg", "City": "City_in_state"})
    keep_blanks = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(**keep_blanks, **RAW_FILE).csv(root)
    return root


def _to_bronze(spark, d, root, names) -> None:
    """Raw inputs through files to bronze. The files are this query's own, and go when bronze has their rows."""
    for name in names:
        source = _write_raw(spark, d, name)
        # each entity has its own folder here, so the file names carry no entity
        pipeline.bronze_entity(spark, source, root, name, "part-*", MAX_FILES)
        drop_folder(spark, source)


@query
def late_policies(spark, d):
    """All claims and half of the policies, then the other half: claims that waited are completed and counted anew."""
    root = shared_dir(spark, "late")
    policy, orders = raw(spark, d, "policy").drop("_source_file", "_loaded_at"), shared_dir(spark, "late-policy")
    odd = F.substring(F.trim("policy_number"), -1, 1).isin(*"13579")
    _to_bronze(spark, d, root, [n for n in (*pipeline.FIELDS, "customers") if n != "policy"])
    for n, rows in enumerate((policy.filter(odd), policy.filter(~F.coalesce(odd, F.lit(False))))):
        rows.write.options(header="true", **RAW_FILE).csv(f"{orders}/{n}")
        pipeline.bronze_entity(spark, orders, root, "policy", "part-*", MAX_FILES)
        pipeline.to_silver(spark, root, MAX_FILES)
        pipeline.to_gold(spark, root, MAX_FILES, F.lit(AS_OF).cast("date"))
        pipeline.to_marts(spark, root, MAX_FILES)
    return spark.read.parquet(f"{root}/gold/agg_claim_performance")


@query
def pipeline_stream(spark, d):
    """All layers as streams from files, up to the claim performance mart."""
    root = shared_dir(spark, "pipeline")
    _to_bronze(spark, d, root, (*pipeline.FIELDS, "customers"))
    pipeline.to_silver(spark, root, MAX_FILES)
    pipeline.to_gold(spark, root, MAX_FILES, F.lit(AS_OF).cast("date"))
    pipeline.to_marts(spark, root, MAX_FILES)
    return spark.read.parquet(f"{root}/gold/agg_claim_performance")
