"""Sparse text vectors weighted by how rare a word is in the corpus, all in expressions.

A word's weight is its count times ln((1 + documents) / (1 + documents with it)) + 1; vectors
have length one. Words are runs of letters and digits of any script, lowered. A vector is kept
as rows (ids, word, weight), which join and aggregate as such; ``vectors`` packs them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import skew

WORD = r"[\p{L}\p{N}]+"


def words(text: Column | str) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(column, F.lit(""))), F.lit(WORD), F.lit(0))


def counts(df: DataFrame, ids: Sequence[str], text_col: str) -> DataFrame:
    """How often each word occurs in each row: ids, word, n. Rows of the same ids are one text.

    Whole texts go to their ids' partition, where their words are counted: a text is several
    times smaller than the rows of its words.
    """
    texts = df.select(*ids, F.col(text_col).alias("_text")).repartition(*ids)
    split = texts.select(*ids, F.explode(words("_text")).alias("word"))
    return split.groupBy(*ids, "word").agg(F.count(F.lit(1)).alias("n"))


def fit(df: DataFrame, text_col: str) -> DataFrame:
    """The model: word, documents (with it) and weight. One row per word; a text counts a word once."""
    total = df.count()
    seen = df.select(F.explode(F.array_distinct(words(text_col))).alias("word"))
    per_word = seen.groupBy("word").agg(F.count(F.lit(1)).alias("documents"))
    return per_word.withColumn("weight", F.log((F.lit(1.0) + F.lit(total)) / (F.lit(1.0) + F.col("documents"))) + F.lit(1.0))


def encode(df: DataFrame, ids: Sequence[str], text_col: str, model: DataFrame) -> DataFrame:
    """ids, word, weight. Words that the model doesn't know are left out; a text without any gives no rows.

    A word that is in every text is a hot key of the join with the model; ``skew`` spreads it.
    """
    found = counts(df, ids, text_col)
    each = df.select(F.explode(F.array_distinct(words(text_col))).alias("word"))
    known = skew.left_join_unique(found, model.select("word", F.col("weight").alias("_idf")), ["word"], each)
    raw = known.filter("_idf IS NOT NULL").withColumn("_w", F.col("n") * F.col("_idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*ids)))     # over one text's words
    return raw.select(*ids, "word", (F.col("_w") / norm).alias("weight"))


def vectors(encoded: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per text: its words in order and their weights."""
    entries = F.array_sort(F.collect_list(F.struct("word", "weight")))
    packed = encoded.groupBy(*ids).agg(entries.alias("_e"))
    return packed.select(*ids, F.transform("_e", lambda e: e["word"]).alias("words"), F.transform("_e", lambda e: e["weight"]).alias("weights"))


def nearest(questions: DataFrame, corpus: DataFrame, k: int, question_id: str = "query_id", corpus_id: str = "doc_id") -> DataFrame:
    """The k texts of highest cosine per question, of those that share a word with it: ids, score, rank.

    Both sides as ``encode`` gives them. Scores compare at 12 digits, then ids.
    """
    asked = questions.select(question_id, "word", F.col("weight").alias("_q"))
    pairs = corpus.select(corpus_id, "word", "weight").join(asked, "word")
    scores = pairs.groupBy(question_id, corpus_id).agg(F.sum(F.col("weight") * F.col("_q")).alias("score"))
    best = Window.partitionBy(question_id).orderBy(F.round("score", 12).desc(), F.col(corpus_id).asc())
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
