import math
import re
from collections import Counter

import pytest

from tidemark.operators import tfidf

TEXTS = [
    (1, "Der Käse ist gut, der KÄSE ist alt"), (2, "le café est près de l'école"), (3, "the the the"), (4, None), (5, ""), (6, "!!! ..."),
    (7, "the cat"), (8, "the dog 42"), (9, "日本語 the"), (None, "the cat and the dog"),
]


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(TEXTS, "id int, text string")
    return df, tfidf.fit(df, "text")


def by_hand():
    split = {i: Counter(re.findall(r"[^\W_]+", (t or "").lower())) for i, t in TEXTS}
    df = Counter(w for c in split.values() for w in c)
    idf = {w: math.log((1 + len(TEXTS)) / (1 + n)) + 1 for w, n in df.items()}
    out = {}
    for i, c in split.items():
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items()))
        out |= {(i, w): n * idf[w] / norm for w, n in c.items()}
    return df, out


def test_weights_by_hand_in_any_script(model):
    df, fitted = model
    documents, want = by_hand()
    assert {r["word"]: r["documents"] for r in fitted.collect()} == dict(documents)
    got = {(r["id"], r["word"]): r["weight"] for r in tfidf.encode(df, ["id"], "text", fitted).collect()}
    assert got == pytest.approx(want) and {"käse", "école", "日本語"} <= set(documents)


def test_packed_vectors_have_length_one(model):
    df, fitted = model
    rows = tfidf.vectors(tfidf.encode(df, ["id"], "text", fitted), ["id"]).collect()
    assert len(rows) == 7
    assert all(sum(w * w for w in r["weights"]) == pytest.approx(1) and r["words"] == sorted(r["words"]) for r in rows)


def test_nearest_and_unknown_words(spark, model):
    df, fitted = model
    asked = spark.createDataFrame([("a", "cat unheard"), ("b", "unheard of"), ("c", "the Café")], "query_id string, text string")
    corpus = tfidf.encode(df.filter("id IS NOT NULL").withColumnRenamed("id", "doc_id"), ["doc_id"], "text", fitted)
    got = tfidf.nearest(tfidf.encode(asked, ["query_id"], "text", fitted), corpus, 2).orderBy("query_id", "rank").collect()
    assert [r["doc_id"] for r in got if r["query_id"] == "a"] == [7] and all(r["rank"] <= 2 for r in got)
    assert {r["query_id"] for r in got} == {"a", "c"}


def test_no_python_in_the_plan(model):
    df, fitted = model
    plan = tfidf.encode(df, ["id"], "text", fitted)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_words_are_counted_where_their_text_lies(spark):
    """What travels to count words is the texts, not a row per word."""
    df = spark.createDataFrame([(1, "a b a"), (2, "b"), (1, "a c"), (None, "c"), (None, "c c"), (3, None)], "doc_id long, text string")
    counted = tfidf.counts(df, ["doc_id"], "text")
    got = sorted(((r.doc_id, r.word, r.n) for r in counted.collect()), key=str)
    assert got == sorted([(1, "a", 3), (1, "b", 1), (1, "c", 1), (2, "b", 1), (None, "c", 3)], key=str)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression")      # the words come after the shuffle
    physical = counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert physical.count("Exchange hashpartitioning") == 1
