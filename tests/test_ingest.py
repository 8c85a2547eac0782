import json

import pytest
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.session import shared_dir
from tidemark.sources import ingest, tables
from tidemark.streaming import flows

ALIASES = {
    "CustomerID": presets.CUSTOMER_ALIASES["CustomerID"],
    "Region": presets.CUSTOMER_ALIASES["Region"],
    "Education": presets.CUSTOMER_ALIASES["Education"],
}


@pytest.fixture
def drifting(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "customers_1.csv").write_text("CustomerID,Region,Education\n1,W,primary\n2,,secondary\n")
    (tmp_path / "sub" / "customers_2.csv").write_text('Edu,cust_id,Reg,Note\nprimary,007,East,"a, b"\n')
    (tmp_path / "customers_3.csv").write_text("Customer_ID,Reg\n9,North\n")
    (tmp_path / "Customers_4.csv").write_text("CustomerID\nno\n")
    (tmp_path / "other.csv").write_text("CustomerID\nno\n")
    return str(tmp_path)


def found(df):
    return {
        (r.CustomerID, r.Region, r.Education, r[ingest.RESCUED], r._source_file.rsplit("/", 1)[1]) for r in df.collect()
    }


WANT = {
    ("1", "W", "primary", None, "customers_1.csv"),
    ("2", None, "secondary", None, "customers_1.csv"),
    ("007", "East", "primary", '{"Note":"a, b"}', "customers_2.csv"),
    ("9", "North", None, None, "customers_3.csv"),
}


def test_each_file_is_read_by_its_own_header(spark, drifting):
    assert found(ingest.drifting_csv(spark, drifting, "customers*.csv", ALIASES)) == WANT


def test_values_are_exact_text(spark, tmp_path):
    values = [" 2000 ", "2000", "2020-01-05", "2020-01-05 10:00:00", "10:30", "null", "NaN", "1e3x",
              "007", "1e5", "2.50", "TRUE", "+5", "00.10", "1,5", 'say "hi"', "a\\b"]
    quoted = ['"' + v.replace('"', '\\"') + '"' if "," in v or '"' in v else v for v in values]
    (tmp_path / "a [1].csv").write_text("v,n\n" + "".join(f"{v},{i}\n" for i, v in enumerate(quoted)))
    df = ingest.drifting_csv(spark, str(tmp_path), "*.csv", {"v": ("v",), "n": ("n",)})
    got = {int(r.n): r.v for r in df.collect()}
    assert [got[i] for i in range(len(values))] == values


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v,w,v\n1,2,3\n4,5\n6,7,8,9\n")
    df = ingest.drifting_csv(spark, str(tmp_path), "a.csv", {"v": ("v",), "w": ("w",)})
    got = {r.v: json.loads(r[ingest.RESCUED]) for r in df.collect()}
    assert got["1"] == {"v_2": "3"} and got["4"]["_line"] == "4,5" and got["6"]["_line"] == "6,7,8,9"
    assert ingest.drifting_csv(spark, str(tmp_path), "none*.csv", {"v": ("v",)}).count() == 0


def test_drifting_stream_equals_batch(spark, drifting):
    out = shared_dir(spark, "drift-test")

    def step(files, _):
        return {f"{out}/t": ingest.drifting_csv(spark, [r.path for r in files.collect()], None, ALIASES)}

    flows.run_step(ingest.new_files(spark, drifting, "customers*.csv", 1), step, f"{out}/c")
    assert found(flows.read_sink(spark, f"{out}/t")) == WANT


def test_groups_keep_exact_text(spark, drifting):
    df = ingest.csv_groups(spark, drifting, ["customers_1.csv", "customers_2.csv", "customers_3.csv"])
    assert df.filter("cust_id = '007'").count() == 1
    assert df.count() == 4 and {"CustomerID", "cust_id", "Customer_ID", "Note", "_source_file"} <= set(df.columns)
    assert df.filter("CustomerID = '2'").first().Region is None


def test_a_foreign_header_is_an_error(spark, drifting):
    df = ingest.read_files(spark, drifting, "csv", "customers*.csv", "CustomerID string, Region string, Education string")
    with pytest.raises(Exception, match="header"):
        df.collect()


def test_glob_with_character_class_is_case_sensitive(spark, tmp_path):
    for name in ("Sales_1.csv", "sales_2.csv", "SALES_3.csv", "resales.csv"):
        (tmp_path / name).write_text("sales_id,price\n1,2\n")
    df = ingest.read_files(spark, str(tmp_path), "csv", presets.FILE_GLOBS["sales"])
    assert {r._source_file.rsplit("/", 1)[1] for r in df.collect()} == {"Sales_1.csv", "sales_2.csv"}
    assert dict(df.dtypes)["price"] == "int" and df.filter("_loaded_at IS NULL").count() == 0


def test_json_lines_with_rescue(spark, tmp_path):
    lines = [
        json.dumps({"id": 1, "amount": 2.5, "on": True}),
        json.dumps({"id": "x", "amount": "3", "extra": {"a": [1]}}),
        json.dumps({"id": 3, "amount": None, "other": None}),
        "not json",
        "",
        "[1, 2]",
    ]
    (tmp_path / "claims_1.json").write_text("\n".join(lines))
    df = ingest.json_rescue(spark, str(tmp_path), "claims*.json", "id bigint, amount double, on boolean")
    got = [(r.id, r.amount, r.on, r[ingest.RESCUED]) for r in df.collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, 2.5, True, None),
            (None, 3.0, None, '{"extra":{"a":[1]},"id":"x"}'),
            (3, None, None, None),
            (None, None, None, "not json"),
            (None, None, None, "[1, 2]"),
        ],
        key=str,
    )


def test_incremental_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "cars_1.csv").write_text("car_id,name\na,x\n")
    out = str(tmp_path / "out")

    def load():
        stream = ingest.file_stream(spark, str(source), "csv", "cars*.csv", "car_id string, name string")
        flows.run_flow(stream, f"{out}/t", f"{out}/c")
        return flows.read_sink(spark, f"{out}/t").count()

    assert load() == 1
    (source / "cars_2.csv").write_text("car_id,name\nb,y\nc,z\n")
    (source / "notes.csv").write_text("car_id,name\nq,q\n")
    assert load() == 3


def test_table_preconditions(spark):
    df = spark.createDataFrame([(1, 2)], "a int, affected_record int")
    narrowed, which = tables.require_columns(df, ["a"], ["affected_records", "affected_record"], ["rule_name"])
    assert which == "affected_record" and narrowed.columns == ["a", "affected_record"]
    with pytest.raises(ValueError):
        tables.require_columns(df, ["b"])
    with pytest.raises(ValueError):
        tables.require_table(spark, "no_such_table")


def test_table_life(spark, tmp_path):
    name, path = "tidemark_life", str(tmp_path / "t")
    try:
        for _ in range(2):
            tables.create_table(spark, name, "a INT, b STRING", path)
        rows = tables.typed_rows(spark, [("x", 1)], "b string, a int")
        tables.insert(rows, name)
        tables.insert(rows, name)
        assert [tuple(r) for r in tables.require_table(spark, name).collect()] == [(1, "x")] * 2
        tables.truncate(spark, name)
        assert spark.table(name).count() == 0
        tables.insert(rows, name)
        assert spark.table(name).count() == 1
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_overwrite_may_change_the_schema(spark, tmp_path):
    path = str(tmp_path / "mart")
    tables.refresh(spark.range(3), path)
    tables.refresh(spark.range(2).withColumn("x", F.lit("y")), path)
    tables.append(spark.range(1).withColumn("x", F.lit("z")), path)
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(path).columns == ["id", "x"]
    assert tables.as_view(spark.range(4), "four").count() == 4
    stored = tables.store(spark.range(5).withColumn("x", F.lit(1.5)), str(tmp_path / "s"))
    assert stored.count() == 5 and dict(stored.dtypes)["x"] == "double"


def test_fields_of_a_json_line_are_read_once(spark, tmp_path):
    """The names that fit are found once per line, not once per field of the line."""
    lines = ['{"a":"1","b":"x"}', '{"a":"no","b":"x"}', '{"a":null,"b":null,"c":null}', '{"b":"y","c":{"d":[1]},"e":2}', "[1]", "7", '{"a":"2"', "{}"]
    (tmp_path / "lines.txt").write_text("\n".join(lines))
    rows = ingest.json_rescue(spark, str(tmp_path), "*.txt", "a int, b string")
    got = [(r.a, r.b, r[ingest.RESCUED]) for r in rows.collect()]
    want = [(1, "x", None), (None, "x", '{"a":"no"}'), (None, None, None), (None, "y", '{"c":{"d":[1]},"e":2}'),
            (None, None, "[1]"), (None, None, "7"), (None, None, '{"a":"2"'), (None, None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") == 3      # a, b and the map of all fields
