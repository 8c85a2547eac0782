"""Columns that come over time, their types, watched streams, kept answers."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import infer, rules
from tidemark.sources import ingest, schema_log
from tidemark.streaming import flows

ALIASES = {"id": ("id", "ID_no")}


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    Path(folder, name).write_text(text)


def run(spark, root):
    schema_log.csv_flow(spark, f"{root}/in", "*.csv", f"{root}/t", f"{root}/ck", 1, ALIASES)
    return schema_log.SchemaLog(spark, f"{root}/t").columns()


def test_columns_and_types_grow(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/in", "a.csv", "id,amount,day\n007,1,2024-01-02\n8,,2024-01-03\n")
    assert run(spark, root) == [("id", 0, "int"), ("amount", 0, "int"), ("day", 0, "date")]
    put(f"{root}/in", "b.csv", "Tier,ID_no,AMOUNT\n3,9,2.5\n,10,5000000000\n1,2,3,4\n")
    assert run(spark, root) == [("id", 0, "int"), ("amount", 0, "double"), ("day", 0, "date"), ("Tier", 1, "int")]
    rows = {r["id"]: r for r in schema_log.read(spark, f"{root}/t").collect()}
    assert (rows[7]["amount"], rows[7]["Tier"], str(rows[7]["day"])) == (1.0, None, "2024-01-02")
    assert (rows[9]["amount"], rows[9]["Tier"], rows[9]["day"]) == (2.5, 3, None) and rows[10]["amount"] == 5e9
    # text is kept as written, a line that doesn't fit is kept whole, lineage is there
    text = schema_log.read(spark, f"{root}/t", typed=False)
    assert "007" in {r["id"] for r in text.collect()}
    assert [r[ingest.RESCUED] for r in text.filter(f"{ingest.RESCUED} IS NOT NULL").collect()] == ["1,2,3,4"]
    assert text.filter("_source_file IS NULL OR _loaded_at IS NULL").count() == 0
    put(f"{root}/in", "c.csv", "id,tier\nx,y\n")
    assert run(spark, root)[0] == ("id", 0, "string") and run(spark, root)[3] == ("Tier", 1, "string")
    assert schema_log.SchemaLog(spark, f"{root}/t").columns(below=1) == [("id", 0, "int"), ("amount", 0, "int"), ("day", 0, "date")]


def test_a_run_that_failed_before_the_log_was_written(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(f"{root}/in", "a.csv", "id,n\n1,true\n")

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(schema_log.SchemaLog, "add", lost)
        with pytest.raises(Exception, match="lost"):
            run(spark, root)
    assert run(spark, root) == [("id", 0, "int"), ("n", 0, "boolean")]
    assert schema_log.read(spark, f"{root}/t").count() == 1


@pytest.mark.parametrize(
    "values",
    [
        ("1", "-2", "+3"), ("1", "3000000000"), ("1", "2.5"), ("1e5", "7"), (".5", "5."), ("true", "FALSE"), ("true", "1"), ("2024-01-02", "2024-12-31"),
        ("2024-01-02", "x"), ("2024-01-02 10:00:00", "2024-01-03 11:22:33"), ("2024-02-30", "2024-02-01"), ("", ""), ("a",), ("1", ""),
        ("2024-01-02T10:00:00", ""), ("12-34",),
    ],
)
def test_types_equal_the_readers(spark, tmp_path, values):
    put(str(tmp_path / "in"), "a.csv", "k,v\n" + "".join(f"k,{v}\n" for v in values))
    read = spark.read.options(header=True, inferSchema=True).csv(str(tmp_path / "in"))
    seen = spark.createDataFrame([(v,) for v in values], "v string").agg(F.bit_or(schema_log.kind(F.col("v"))).alias("k")).first()["k"]
    assert schema_log.type_of(seen) == dict(read.dtypes)["v"]


def test_kinds_merge_in_any_order():
    sl = schema_log
    for a in range(1 << 7):
        for b in (sl.INT, sl.LONG, sl.DOUBLE, sl.DATE, sl.TIMESTAMP, sl.BOOLEAN, sl.TEXT):
            wide = sl.type_of(a | b)
            assert wide == sl.type_of(b | a)
            if sl.type_of(a) == "string" and a:
                assert wide == "string"


def test_watched_flow_counts_each_batch_once(spark, tmp_path):
    root, row_rules = str(tmp_path), {**rules.not_null("v"), **rules.non_negative("v")}
    values = [1, None, -1, 5, None, 7]
    for i in range(3):
        spark.createDataFrame([(v,) for v in values[2 * i : 2 * i + 2]], "v int").coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("v int").option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
    flows.watched_flow(stream, row_rules, f"{root}/t", f"{root}/n", f"{root}/ck")
    want = {("v_present", 6, 2), ("v_non_negative", 6, 3)}
    assert {tuple(r) for r in flows.read_counts(spark, f"{root}/n").collect()} == want
    assert spark.read.parquet(f"{root}/n").select("batch_id").distinct().count() == 3 and flows.read_sink(spark, f"{root}/t").count() == 6
    # all batches again: rows are there, so counts of a lost run are measured from the batch
    flows.watched_flow(stream, row_rules, f"{root}/t", f"{root}/again", f"{root}/ck2")
    assert {tuple(r) for r in flows.read_counts(spark, f"{root}/again").collect()} == want


def counting(folder, fail=None):
    """A model that leaves a file for every prompt it is asked."""

    def ask(texts):
        import tempfile

        out = []
        for t in texts:
            if fail and t.startswith(fail) and not os.path.exists(f"{folder}/healed"):
                out.append(ValueError("no"))
                continue
            open(tempfile.mkstemp(dir=folder, suffix=f"-{len(texts)}")[1], "w").close()
            out.append(f"re: {t}")
        return out

    return ask


def test_equal_prompts_are_asked_once_and_answers_are_kept(spark, tmp_path):
    folder, path = str(tmp_path / "calls"), str(tmp_path / "answers")
    os.makedirs(folder)
    df = spark.createDataFrame([(i, None if i == 0 else f"q{i % 10}") for i in range(300)], "i int, p string")
    fn = counting(folder, "q7")
    got = {r["i"]: r for r in infer.map_text_kept(df, "p", fn, path, batch=4, slices=3).collect()}
    assert len(got) == 300 and len(os.listdir(folder)) == 9
    assert got[0]["generation_status"] == "EMPTY" and got[5]["reply_text"] == "re: q5"
    assert (got[17]["generation_status"], got[17]["error_message"]) == ("FAILED", "no")
    Path(folder, "healed").touch()
    again = {r["i"]: r for r in infer.map_text_kept(df, "p", fn, path, batch=4, slices=3).collect()}
    assert len(os.listdir(folder)) == 11 and again[17]["reply_text"] == "re: q7"      # the failed one, and the mark
    infer.map_text_kept(df, "p", fn, path).collect()
    assert len(os.listdir(folder)) == 11
    more = infer.map_text_kept(spark.createDataFrame([("q3",), ("new",)], "p string"), "p", fn, path).collect()
    assert {r["reply_text"] for r in more} == {"re: q3", "re: new"} and len(os.listdir(folder)) == 12


def test_pause_is_shared_and_retries_are_bounded(monkeypatch):
    calls, naps = [], []
    monkeypatch.setattr(infer.time, "sleep", naps.append)

    def fn(texts):
        calls.append(list(texts))
        if len(calls) in (1, 3, 4):
            raise infer.Throttled("slow down")
        return [infer.Throttled("one") if len(calls) == 2 and t == "b" else t.upper() for t in texts]

    asker = infer.Asker(fn, 2, 3, 1.0)
    assert asker.ask(["a", "b", "c"]) == [("A", None), (None, "slow down"), ("C", None)]
    assert calls[0] == ["a", "b"] and calls[1] == ["a", "b"] and calls[2] == ["b"] and calls[3] == ["c"]
    assert naps == [1.0, 2.0, 4.0, 8.0] and len(calls) == 5
    assert infer.Asker(lambda t: t[:-1], 4, 3, 0.0).ask(["x", "y"]) == [(None, "1 replies to 2 prompts")] * 2
