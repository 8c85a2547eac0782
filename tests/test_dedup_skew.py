import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import dedup, skew


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_first_has_a_total_order_and_collapses_null_keys(spark, collected):
    data = [("a", 2, "y"), ("a", 1, "z"), ("a", 1, "b"), (None, 5, "n"), (None, 4, "n"), ("c", None, "q")]
    for _ in range(3):
        random.shuffle(data)
        df = spark.createDataFrame(data, "k string, n int, t string").repartition(3)
        got = set(collected(dedup.dedup_first(df, ["k"])))
        assert got == {("a", 1, "b"), (None, 4, "n"), ("c", None, "q")}


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS n").repartition(4)
    plan = plan_of(dedup.dedup_first(df, ["k"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_latest_by_key_does_not_depend_on_arrival(spark, collected):
    data = [("u", 1, "2024-01-01", "a"), ("u", 3, "2024-01-01", "b"), ("u", 3, "2024-02-01", "c"), ("v", 0, None, "d")]
    for _ in range(3):
        random.shuffle(data)
        df = spark.createDataFrame(data, "k string, score int, at string, t string").repartition(2)
        got = dedup.latest_by_key(df, ["k"], ["score", "at"], hide=["score"])
        assert got.columns == ["k", "at", "t"]
        assert set(collected(got)) == {("u", "2024-02-01", "c"), ("v", None, "d")}


def test_completeness(spark):
    df = spark.createDataFrame([("x", "na", None), ("a", "b", "c"), (None, None, "na")], "a string, b string, c string")
    assert [r[0] for r in df.select(dedup.completeness("abc")).collect()] == [1, 3, 0]


def skewed(spark):
    """A third of the rows share one key, a third have a NULL key, one orphan key is hot too."""
    return spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL WHEN id % 9 = 2 THEN 'orphan'"
        " ELSE concat('k', id) END AS k",
        "id AS n",
    )


def test_left_join_equals_the_plain_join_under_skew(spark):
    left = skewed(spark)
    right = spark.range(20_000).selectExpr("concat('k', id) AS k", "id * 2 AS v", "CAST(NULL AS string) AS w")
    right = right.unionByName(spark.createDataFrame([("hot", -1, None), (None, -2, "x")], "k string, v long, w string"))
    got = skew.left_join_unique(left, right, ["k"])
    want = left.join(right, "k", "left").select("k", "n", "v", "w")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_rows_do_not_meet_in_one_partition(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = skewed(spark)
        right = left.filter("k IS NOT NULL").select("k").distinct().withColumn("v", F.lit(1))
        joined = skew.left_join_unique(left.repartition(4), right, ["k"])
        assert "SortMergeJoin" in plan_of(joined)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 2 * 30_000 / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_key_list_is_bounded(spark):
    even = spark.range(5_000).selectExpr("id AS k")
    assert skew.hot_hashes(even, ["k"]) == []
    assert len(skew.hot_hashes(skewed(spark), ["k"])) == 2      # NULL never joins
    many = spark.range(400_000, numPartitions=2).selectExpr("id % 1500 AS k")
    assert len(skew.hot_hashes(many, ["k"])) <= skew.HOT_KEYS


def test_sketch_of_another_frame_changes_nothing(spark):
    left = skewed(spark)
    right = left.select("k").filter("k IS NOT NULL").distinct().withColumn("v", F.length("k"))
    a = skew.left_join_unique(left, right, ["k"])
    b = skew.left_join_unique(left, right, ["k"], sketch_of=left.limit(0))
    assert a.exceptAll(b).count() == 0 and b.count() == 30_000


def test_count_per_key_equals_the_window(spark):
    df = skewed(spark)
    got = skew.count_per_key(df, ["k"], "c")
    want = df.withColumn("c", F.count("*").over(Window.partitionBy("k")))
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert "Window" not in plan_of(got)


def test_the_right_side_is_never_broadcast_whole(spark, tmp_path):
    """Repeated values compress so well that files of many keys look small enough to send."""
    right = spark.range(20_000).selectExpr("id AS k", "'same' AS v")
    right.write.parquet(str(tmp_path / "right"))
    joined = skew.left_join_unique(spark.range(30_000).selectExpr("id AS k"), spark.read.parquet(str(tmp_path / "right")), ["k"])
    assert joined.filter("v IS NOT NULL").count() == 20_000
    assert "SortMergeJoin" in plan_of(joined) and "BroadcastHashJoin" not in plan_of(joined)
