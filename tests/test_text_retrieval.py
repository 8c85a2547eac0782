import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.functions import prompts, text, vectors
from tidemark.operators import retrieval


def slices(value, size, overlap):
    out, start = [], 0
    while start < len(value):
        out.append(value[start : start + size])
        start += size - overlap
    return out


@pytest.mark.parametrize(
    "length,count", [(0, 0), (1, 1), (320, 1), (321, 2), (400, 2), (640, 2), (641, 3)]
)
def test_chunk_counts(spark, length, count):
    df = spark.createDataFrame([(1, "x" * length)], "id int, t string")
    assert text.chunk(df, ["id"], "t").count() == count


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text(st.sampled_from("ab\n é😀"), max_size=60), min_size=1, max_size=6),
    st.sampled_from([(10, 2), (10, 5), (10, 7), (10, 0), (3, 2)]),
)
def test_chunks_match_slicing_and_rebuild_the_text(spark, values, shape):
    size, overlap = shape
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    got = {i: [] for i in range(len(values))}
    for r in text.chunk(df, ["id"], "t", size, overlap).orderBy("id", "chunk_no").collect():
        got[r.id].append(r.chunk_text)
    for i, value in enumerate(values):
        assert got[i] == slices(value, size, overlap)
        stride = size - overlap
        assert "".join(c[:stride] for c in got[i]) == value
        assert all(b.startswith(a[stride:]) or a[stride:].startswith(b) for a, b in zip(got[i], got[i][1:]))


def test_drop_contained_loses_no_text(spark):
    df = spark.createDataFrame([(1, "x" * 330), (2, "y" * 401), (3, "z" * 10), (4, "")], "id int, t string")
    got = text.chunk(df, ["id"], "t", drop_contained=True).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in got} == {1: 1, 2: 2, 3: 1}


def test_chunk_rejects_bad_shapes():
    with pytest.raises(ValueError):
        text.chunk_array("t", 10, 10)


def test_render_drops_the_sentence_of_a_null(spark):
    df = spark.createDataFrame([("7", None, "SC")], "policy_id string, policy_csl string, policy_state string")
    parts = (("Policy ", "policy_id"), ("Limit is ", "policy_csl"), ("State is ", "policy_state"))
    assert df.select(text.render(parts)).first()[0] == "Policy 7. State is SC."


def test_prompt_fills_each_place_once(spark):
    df = spark.createDataFrame([("{b}", None, 3)], "a string, b string, n int")
    got = prompts.prompt(df, "a={a} b={b} n={n} {a}.", {c: F.col(c) for c in ("a", "b", "n")}).first()["prompt"]
    assert got == "a={b} b= n=3 {b}."


def test_hashed_words_counts_whole_text(spark):
    df = spark.createDataFrame([("Ab ab, cd!",), ("",), ("…",)], "t string")
    got = [r.embedding for r in vectors.embed(df, "t", vectors.HashedWords(16)).collect()]
    assert [sum(v) for v in got] == [3.0, 0.0, 0.0] and max(got[0]) >= 2
    assert vectors.HashedWords(16, remembered=1)(["x y x"]).sum() == 3


def test_normalise_and_dot(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = df.select(
        vectors.normalise(F.col("a")).alias("a"), vectors.normalise(F.col("z")).alias("z"),
        vectors.dot(F.col("a"), F.col("a")).alias("d"),
    ).first()
    assert np.allclose(row.a, [0.6, 0.8]) and row.z == [0.0, 0.0] and row.d == 25.0


def test_embed_calls_the_function_per_batch(spark):
    df = spark.createDataFrame([("a",), ("bbb",), (None,)], "t string")
    got = vectors.embed(df, "t", lambda texts: [[len(t), 1.0] for t in texts]).collect()
    assert [r.embedding for r in got] == [[1.0, 1.0], [3.0, 1.0], [0.0, 1.0]]


def vector_frames(spark, n_queries=7, n_rows=300, dims=6, seed=5):
    rng = np.random.default_rng(seed)
    corpus = rng.integers(-2, 3, (n_rows, dims)).astype(float)     # small integers: many ties
    queries = rng.integers(-2, 3, (n_queries, dims)).astype(float)
    corpus[3] = 0
    queries[0] = 0
    c = spark.createDataFrame([(i, v.tolist(), f"p{i % 5}") for i, v in enumerate(corpus)],
                              "id long, embedding array<double>, part string")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, embedding array<double>")

    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n > 0, n, 1)

    scores = np.round(np.stack([(unit(corpus) * row).sum(axis=1) for row in unit(queries)]), retrieval.TIE_DIGITS) + 0.0
    return q, c, scores


def brute(scores, k):
    out = set()
    for q, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        out |= {(q, i, rank) for rank, i in enumerate(order, 1)}
    return out


@pytest.mark.parametrize("k", [1, 5, 500])
def test_knn_equals_brute_force_with_ties(spark, k):
    q, c, scores = vector_frames(spark)
    hits = retrieval.knn(q, c.repartition(5), k, payload=["part"]).collect()
    assert {(h.query_id, h.id, h["rank"]) for h in hits} == brute(scores, k)
    assert all(h.part == f"p{h.id % 5}" and h.score == scores[h.query_id][h.id] for h in hits)


def test_knn_in_blocks_equals_one_scan(spark):
    q, c, scores = vector_frames(spark, n_queries=40)
    hits = retrieval.knn(q, c, 4, payload=["part"], block_queries=8)
    assert {(h.query_id, h.id, h["rank"]) for h in hits.collect()} == brute(scores, 4)


def test_knn_blocks_share_scans(spark, monkeypatch):
    """Jobs grow with the numbers in the queries, not with the blocks that they are multiplied in."""
    q, c, scores = vector_frames(spark, n_queries=40)
    stored = []
    monkeypatch.setattr(retrieval.tables, "store", lambda df, path, keep=retrieval.tables.store: stored.append(path) or keep(df, path))
    hits = retrieval.knn(q, c, 4, block_queries=2)
    assert {(h.query_id, h.id, h["rank"]) for h in hits.collect()} == brute(scores, 4) and not stored
    monkeypatch.setattr(retrieval, "BLOCK_VALUES", 20 * len(q.first().embedding))
    hits = retrieval.knn(q, c, 4, block_queries=2)
    assert {(h.query_id, h.id, h["rank"]) for h in hits.collect()} == brute(scores, 4) and len(stored) == 5


@pytest.mark.parametrize("values", [4_000_000, 12])
def test_rows_of_one_query_id_share_its_hits(spark, monkeypatch, values):
    """However queries are dealt, an id has k hits in all."""
    monkeypatch.setattr(retrieval, "BLOCK_VALUES", values)
    c = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)], "id long, embedding array<double>")
    q = spark.createDataFrame([(i % 3, [1.0, 2.0]) for i in range(24)], "query_id long, embedding array<double>")
    hits = retrieval.knn(q, c, 2, block_queries=3).collect()
    assert sorted((h.query_id, h["rank"]) for h in hits) == [(i, r) for i in range(3) for r in (1, 2)]
    assert {h.id for h in hits} == {2}


def test_knn_beyond_one_matrix(spark, monkeypatch):
    """Rows and pairs in several pieces, many of them equal: the ids settle it."""
    q, c, scores = vector_frames(spark)
    for name, n in (("ROWS_AT_ONCE", 7), ("SCORES_AT_ONCE", 21), ("PAIRS_AT_ONCE", 5)):
        monkeypatch.setattr(retrieval, name, n)
    batches = np.array_split(c.toPandas(), 3)
    rows = q.toPandas()
    got = pd.concat(retrieval._scan(rows["query_id"].tolist(), retrieval._unit(np.stack(rows["embedding"])), iter(batches), "id", "embedding", ["part"], 4))
    assert {(r.query_id, r.id) for r in got.itertuples()} == {(a, b) for a, b, _ in brute(scores, 4)}


@pytest.mark.parametrize("block", [1, 10])
def test_repeated_ids_are_rows_of_their_own(spark, block):
    c = spark.createDataFrame([(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "b"), (2, [0.0, 1.0], "c")], "id long, embedding array<double>, part string")
    q = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 2.0]), (8, [0.0, 2.0])], "query_id long, embedding array<double>")
    got = sorted((h.query_id, h.id, h.part, h["rank"]) for h in retrieval.knn(q.limit(2), c, 2, payload=["part"], block_queries=block).collect())
    assert [g[:2] for g in got if g[0] == 7] == [(7, 1), (7, 1)] and {g[2] for g in got if g[0] == 7} == {"a", "b"}
    assert [g[1:3] for g in got if g[0] == 8 and g[3] == 1] == [(2, "c")]


def test_ranks_use_full_precision(spark):
    c = spark.createDataFrame([(1, [1.0, 1e-4]), (2, [1.0, 0.0])], "id long, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert retrieval.knn(q, c, 1).first().id == 2


def test_knn_without_queries_or_rows(spark):
    q, c, _ = vector_frames(spark)
    assert retrieval.knn(q.limit(0), c, 3).count() == 0
    assert retrieval.knn(q, c.limit(0), 3).count() == 0


def hits_frame(spark):
    data = [("q1", 1, 0.9, "a", "x"), ("q1", 2, 0.8, "b", "y"), ("q1", 3, 0.7, "a", "z"), ("q2", 1, 0.0, "c", "w")]
    return spark.createDataFrame(data, "query_id string, rank int, score double, key string, text string")


def test_context_sources_confidence(spark):
    hits = hits_frame(spark)
    assert {r.query_id: r.source_keys for r in retrieval.sources(hits, "key").collect()} == {"q1": "a,b", "q2": "c"}
    context = {r.query_id: r.context for r in retrieval.context(hits, "key", "text").collect()}
    assert context["q1"] == (
        "[Source 1] Policy ID: a\nx\n\n[Source 2] Policy ID: b\ny\n\n[Source 3] Policy ID: a\nz"
    )
    queries = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "query_id string")
    rated = {r.query_id: (r.confidence_score, r.confidence_band, r.unique_keys)
             for r in retrieval.confidence(hits, "key", queries).collect()}
    # a score of 0.0 stays 0.0; no hits rate 0, LOW
    assert rated == {"q1": (0.77, "HIGH", 2), "q2": (0.05, "LOW", 1), "q3": (0.0, "LOW", 0)}
    whole = {r.query_id: r for r in retrieval.digest(hits, "key", "text").collect()}
    assert whole["q1"].context == context["q1"] and whole["q1"].source_keys == "a,b"
    assert whole["q2"].confidence_score == 0.05


def test_history_is_typed_and_newest_first(spark):
    answers = spark.createDataFrame(
        [("q", "a", 0.5, "MEDIUM", 2, "x,y")],
        "question string, answer string, confidence_score double, confidence_band string, unique_keys int, source_keys string",
    )
    log = retrieval.history(answers)
    assert [t for _, t in log.dtypes] == ["string", "string", "double", "string", "int", "string", "timestamp"]
    stamped = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-03-01")], "n int, query_timestamp string")
    assert [r.n for r in retrieval.newest_first(stamped).collect()] == [2, 1]


def test_confidence_bands():
    assert presets.CONFIDENCE_BANDS == (("HIGH", 0.75), ("MEDIUM", 0.50))
