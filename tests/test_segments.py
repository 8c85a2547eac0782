"""Segments, key index and upsert store: right after many batches, flat in what they read, safe to repeat."""

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup
from tidemark.streaming import flows
from tidemark.streaming import segments as sg

DDL = "k string, j int, seq int, v int"


def tiers(n, fan):
    return (fan - 1) * (int(math.log(max(n, 1), fan)) + 1)


def test_live_segments_stay_few_and_hold_every_batch(spark, tmp_path):
    table = sg.Segments(spark, str(tmp_path / "t"), lambda df: df.groupBy("k").agg(F.sum("v").alias("v")), 3)
    for batch in range(20):
        table.add(spark.createDataFrame([(f"k{batch % 4}", 1), ("all", 1)], "k string, v long"), batch)
        spans = table.live()
        assert [b for a, z in spans for b in range(a, z + 1)] == list(range(batch + 1))
        assert len(spans) <= tiers(batch + 1, 3)
    assert {r.k: r.v for r in table.read().collect()} == {"k0": 5, "k1": 5, "k2": 5, "k3": 5, "all": 20}
    assert {r.k: r.v for r in table.read(below=10).collect()}["all"] == 10
    # a batch that runs again changes nothing, and neither does its compaction
    table.add(spark.createDataFrame([("all", 99)], "k string, v long"), 8)
    assert {r.k: r.v for r in table.read().collect()}["all"] == 20
    assert spark.read.parquet(str(tmp_path / "t")).select("batch_id").distinct().count() == 20


def test_a_folder_in_parts_appears_whole_and_compressed(spark, tmp_path):
    at = tmp_path / "t"
    draft = sg.Draft(spark, str(at), "batch_id=0")
    for n in range(3):
        draft.add(spark.range(n, n + 1).toDF("v"))
        assert sg.folders(spark, str(at)) == [] or sg.folders(spark, str(at)) == ["_draft-0"]
    draft.finish()
    assert sorted(r.v for r in spark.read.parquet(str(at)).collect()) == [0, 1, 2]
    assert all(".zstd." in f.name for f in (at / "batch_id=0").glob("part-*"))
    # what a failed run left of a draft isn't kept, and a complete folder is left alone
    sg.Draft(spark, str(at), "batch_id=1").add(spark.range(5).toDF("v"))
    sg.Draft(spark, str(at), "batch_id=1").add(spark.range(2).toDF("v")).finish()
    sg.Draft(spark, str(at), "batch_id=1").add(spark.range(9).toDF("v")).finish()
    assert spark.read.parquet(str(at)).count() == 5
    sg.drop_folder(spark, str(at))
    assert not at.exists()


def test_nothing_to_read(spark, tmp_path):
    assert sg.Segments(spark, str(tmp_path / "none"), lambda df: df).read() is None


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(sg, "BUCKET_KEYS", 16)
    monkeypatch.setattr(sg, "FILTER_BITS", 9)


def test_key_index_reads_flat(spark, tmp_path, small_buckets):
    """Ten batches of new keys, with a few of the first batches' keys among them."""
    path, read = str(tmp_path / "t"), []
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for batch in range(10):
            rows = [(f"n{batch}-{i}", i) for i in range(200)] + ([(f"n0-{i}", i) for i in range(4)] if batch else [])
            df = spark.createDataFrame(rows, "k string, j int")
            index = sg.KeyIndex(spark, (path,), ("k", "j"))
            fresh = index.unseen(df, batch)
            if batch:
                read.append(index.candidates(df, batch)[1])
            sg.write_once(fresh, path, batch)
            assert spark.read.parquet(f"{path}/batch_id={batch}").count() == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    # four buckets of 16 keys hold the repeats; the filters let through about one key in 400
    assert max(read) <= 2.5 * read[0] + 100 and max(read) < 0.25 * 200 * 9
    plan = index.candidates(df, 9)[0]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(bucket" in plan or "PushedFilters: [IsNotNull(bucket), EqualTo(bucket" in plan or "Or(EqualTo(bucket" in plan


def test_key_index_with_null_and_equal_hash_neighbours(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1), (None, 1), ("a", None), (None, None)], "k string, j int")
    sg.write_once(first, path, 0)
    index = sg.KeyIndex(spark, (path,), ("k", "j"))
    again = spark.createDataFrame([("a", 1), (None, None), ("b", None), (None, 2)], "k string, j int")
    assert {tuple(r) for r in index.unseen(again, 1).collect()} == {("b", None), (None, 2)}
    sg.write_once(index.unseen(again, 1).limit(0), path, 1)         # an empty batch
    assert index.unseen(again, 2).count() == 2
    with pytest.raises(ValueError, match="batch 2"):
        index.unseen(again, 5)


def test_dedup_flow_over_many_batches(spark, tmp_path):
    rng, rows = random.Random(1), []
    for n in range(9):
        part = [(rng.choice(["a", "b", "c", None, f"x{n}"]), rng.randint(0, 3), n * 100 + i, i) for i in range(30)]
        rows += part
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    flows.dedup_flow(spark, stream, ["k", "j"], str(tmp_path / "t"), str(tmp_path / "ck"), ["seq"])
    got = flows.read_sink(spark, str(tmp_path / "t"))
    assert got.count() == got.select("k", "j").distinct().count() == len({r[:2] for r in rows})
    assert flows.read_sink(spark, str(tmp_path / "t")).columns == ["k", "j", "seq", "v"]


def test_upsert_store_and_state_equal_batch(spark, tmp_path):
    rng, rows = random.Random(2), []
    for n in range(9):
        part = [(rng.choice(["a", "b", "c", None]), rng.choice([1, None]), rng.randint(0, 50), rng.choice([i, None])) for i in range(20)]
        rows += part
        spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    keys, sequence, path = ["k"], ["seq", "j"], str(tmp_path / "t")
    flows.upsert_flow(stream, keys, sequence, path, str(tmp_path / "ck"))
    want = sorted(map(str, dedup.latest_by_key(spark.createDataFrame(rows, DDL), keys, sequence).collect()))
    assert sorted(map(str, flows.read_upsert(spark, path, keys, sequence).collect())) == want
    store = flows.upsert_store(spark, path, keys, sequence)
    assert len(store.batches()) == 9 and len(store.live()) == 3        # 0-3, 4-7, 8
    # a read meets no key more often than there are live segments, however many batches there were
    assert sum(spark.read.parquet(store.folder(*s)).count() for s in store.live()) <= 4 * 3
    winners = flows.state_upsert(stream, keys, sequence)
    seen = []
    winners.writeStream.foreachBatch(lambda df, _: seen.extend(df.collect())).option(
        "checkpointLocation", str(tmp_path / "ck2")
    ).trigger(availableNow=True).start().awaitTermination()
    last = {r["k"]: r for r in seen}
    assert sorted(map(str, last.values())) == want


def test_state_upsert_holds_many_keys_in_few_state_rows(spark, tmp_path):
    """Ids beyond 2**53 beside null ones, null and tied sequences, times in another zone: each row that comes out beats the one before."""
    ddl, rng, rows = "k long, name string, at timestamp, n long, v double", random.Random(5), []
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for n in range(4):
            part = [
                (rng.choice([None, 2**60 + rng.randint(0, 300), rng.randint(0, 300)]), rng.choice(["a", None]), rng.choice([None, datetime(2024, 7, 1, 12, rng.randint(0, 9))]), rng.randint(0, 3), rng.choice([None, 1.5, -2.0]))
                for _ in range(500)
            ]
            rows += part
            spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
        seen = []
        query = flows.state_upsert(stream, ["k", "name"], ["at", "n"], buckets=16).writeStream.foreachBatch(lambda df, _: seen.extend(df.collect()))
        query = query.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()
        want = dedup.latest_by_key(spark.createDataFrame(rows, ddl), ["k", "name"], ["at", "n"]).collect()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 16
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    rank = lambda r: tuple((x is not None, x) if x is not None else (False,) for x in (r["at"], r["n"], r["v"]))
    last = {}
    for r in seen:
        key = (r["k"], r["name"])
        assert key not in last or rank(r) > rank(last[key])
        last[key] = r
    assert sorted(map(str, last.values())) == sorted(map(str, want))
