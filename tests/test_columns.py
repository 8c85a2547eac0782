from pyspark.sql import functions as F

from tidemark import presets
from tidemark.functions import columns as c


def one(spark, value, expr, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr.alias("y")).first()["y"]


def test_force_null_trims_and_ignores_case(spark):
    values = ["null", " NULL ", "", "  ", "None", "NaN", "?", " a ", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r["y"] for r in df.select(c.force_null("x").alias("y")).collect()]
    assert got == [None] * 6 + ["?", "a", None]


def test_null_tokens_match_exactly_and_only_strings(spark):
    df = spark.createDataFrame([("null", 0), (" null ", 1), ("?", 2), ("", 3), (None, 4)], "x string, n int")
    plain = {r["n"]: r["x"] for r in c.null_tokens(df).collect()}
    assert plain == {0: None, 1: " null ", 2: "?", 3: None, 4: None}
    with_mark = {r["n"]: r["x"] for r in c.null_tokens(df, presets.CLAIM_NULL_TOKENS).collect()}
    assert with_mark[2] is None


def test_token_inside_blanks_survives_trim_after_replace(spark):
    df = spark.createDataFrame([(" ? ",), ("?",)], "x string")
    got = c.map_string_columns(c.null_tokens(df, ("?", "NULL", "null", "")), F.trim)
    assert [r["x"] for r in got.collect()] == ["?", None]


def test_leading_int_null_is_zero_bad_text_is_null(spark):
    values = [None, "12:30.0", "00:00.0", "x:1", "7", "", "-3:1"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(c.leading_int("x")).collect()] == [0, 12, 0, None, 7, None, -3]


def test_to_int_agrees_with_the_cast(spark):
    values = ["1", " 2 ", "-3", "+4", "x", "", " ", "5.5", "99999999999", "\t6", "7\n", "@", "é", None, "1e3", "NaN", "0x1"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [(r.a, r.b) for r in df.select(c.to_int("x").alias("a"), F.col("x").try_cast("int").alias("b")).collect()]
    assert all(a == b for a, b in got) and sum(a is not None for a, _ in got) == 6


def test_token_bool_is_three_valued(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("maybe",), (None,)], "x string")
    assert [r[0] for r in df.select(c.token_bool("x", "Y", "N")).collect()] == [True, False, None, None]


def test_number_in_text(spark):
    assert one(spark, "23.4 kmpl", c.number_in("x", "([0-9.]+)", "double")) == 23.4
    assert one(spark, "CC", c.number_in("x", "([0-9]+)", "int")) is None
    assert one(spark, "1.2.3 x", c.number_in("x", "([0-9.]+)", "float")) is None


def test_timestamps_that_do_not_parse_are_null(spark):
    fmt = presets.SALES_TS_FORMAT
    assert str(one(spark, "13-02-2020 10:05", c.to_ts(F.col("x"), fmt))) == "2020-02-13 10:05:00"
    assert one(spark, "2020-02-13", c.to_ts(F.col("x"), fmt)) is None


def test_first_of_uses_the_aliases_that_exist(spark):
    df = spark.createDataFrame([(None, "a"), ("b", "c"), (None, None)], "Reg string, Region string")
    got = df.select(c.first_of(df, ("Region_X", "Region", "Reg"))).collect()
    assert [r[0] for r in got] == ["a", "c", None]
    assert df.select(c.first_of(df, ("nowhere",))).first()[0] is None


def test_recode_touches_one_column(spark):
    df = spark.createDataFrame([("W", "W"), ("Northwest", "N"), (None, "x")], "Region string, other string")
    got = c.recode(df, "Region", presets.REGION_CODES).collect()
    assert [tuple(r) for r in got] == [("West", "W"), ("Northwest", "N"), (None, "x")]


def test_let_evaluates_to_the_body(spark):
    assert one(spark, "a,b,c", c.let(F.split("x", ","), lambda parts: F.size(parts) * F.size(parts))) == 9
