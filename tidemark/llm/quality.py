"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every whole text: yes, no, or no vote. There are
two questions, low quality and toxic, each with its own labellers. Two of the toxic ones look
for words and word stems that stand out in a bounded sample of labelled documents (``TOXIC``
toxic and ``CLEAN`` other ones, first in a seeded order); without labels they don't vote. Spark counts the vote
patterns of all documents (at most 3**labellers of them); expectation-maximisation over
these counts estimates how each labeller votes on either class, without any gold label,
and gives a posterior for each pattern. Posteriors of a bounded sample (the ``SAMPLE``
documents first in a seeded order) train a linear scorer on hashed words and votes by
stochastic gradient descent. A document's probability joins posterior and scorer; it is
rejected if either probability is above one half.

Defined results: a null or empty text is judged by its pattern as every other (no labeller
finds fault with it). Rows that repeat a doc_id are judged row by row. A null doc_id is
allowed. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, documents, signed, texts, words

BUCKETS = 1 << 12
SAMPLE = 3000
EPOCHS = 8
TOXIC, CLEAN = 2000, 8000
#: Words and stems learned: in at least so many toxic documents, so many times as common there as in others.
SUPPORT, RATIO, LEXICON = 4, 100, 4096
STEM = 6
#: Insults naming a person, and words of contempt.
INSULTS = ("idiot", "moron", "loser", "clown", "scum", "imbecile", "jerk", "creep")
CONTEMPT = ("trash", "pathetic", "worthless", "disgusting", "stupid", "dumb", "filthy")
QUALITY_VOTES = ("symbols", "capitals", "repeats", "variety", "shouting", "bars", "unpunctuated", "plain", "sentences")
TOXIC_VOTES = ("insult", "contempt", "any_two", "learned_word", "learned_stem", "spotless")
NONE, NO, YES = 0, 1, 2

_OTHER, _UPPER, _LOWER, _SPACE, _SYMBOL, _BAR, _END, _SHOUT, _DIGIT, _KINDS = range(10)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A] = _UPPER, _LOWER, _DIGIT
for _chars, _kind in ((" \t\n\r\f\v", _SPACE), ("#$%&*<>{}[]^~=+_\\@", _SYMBOL), ("|", _BAR), (".?", _END), ("!", _SHOUT)):
    for _c in _chars:
        _KIND[ord(_c)] = _kind


def word_hash(word: str) -> int:
    return int(next(words(pa.array([word])))[3][0])


def votes(kinds: np.ndarray, hashes: np.ndarray, stems: np.ndarray, lexicon: dict[str, np.ndarray]) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Both questions' votes on a text, from its byte kinds' counts and its word hashes."""
    n = len(hashes)
    signs, letters = kinds.sum() - kinds[_SPACE], kinds[_UPPER] + kinds[_LOWER]
    insult, contempt = (int(np.isin(hashes, lexicon[k]).sum()) for k in ("insult", "contempt"))
    known = [bool(np.isin(found, lexicon["learned"]).any()) for found in (hashes, stems)]
    # one-sided: a word list says nothing about texts in a language that it doesn't cover
    toxic = (
        YES if insult else NONE,
        YES if contempt else NONE,
        YES if insult + contempt >= 2 else NONE,
        *(YES if k else NONE for k in known),
        NONE if insult + contempt + sum(known) else NO,
    )
    distinct = len(np.unique(hashes))
    ends = kinds[_END] + kinds[_SHOUT]
    symbols, bars, shouts = kinds[_SYMBOL] / max(1, signs), kinds[_BAR] / max(1, n), kinds[_SHOUT] / max(1, n)
    capitals = kinds[_UPPER] / letters if letters else 0.0
    repeats = float((hashes[1:] == hashes[:-1]).mean()) if n >= 10 else 0.0
    signed_little = symbols < 0.04 and bars < 0.05 and shouts < 0.05
    few = n >= 20 and distinct < 0.3 * min(n, 400)
    quality = (
        YES if symbols >= 0.06 else NONE,
        YES if capitals >= 0.5 and n >= 3 else NONE,
        YES if repeats >= 0.1 else NONE,
        YES if few else NONE,
        YES if shouts >= 0.1 else NONE,
        YES if bars >= 0.1 else NONE,
        YES if n >= 60 and n / max(1, ends) > 60 else NONE,
        NO if symbols < 0.02 and bars < 0.02 and shouts < 0.02 and capitals < 0.2 else NONE,
        NO if signed_little and (n < 30 or (n / max(1, ends) <= 30 and repeats < 0.04 and not few)) else NONE,
    )
    return quality, toxic


def _code(vote: tuple[int, ...]) -> int:
    out = 0
    for v in vote:
        out = out * 3 + v
    return out


def _decode(code: int, n: int) -> list[int]:
    return [code // 3 ** (n - 1 - i) % 3 for i in range(n)]


def _kinds(data: np.ndarray) -> np.ndarray:
    out = np.zeros(_KINDS, np.int64)
    for i in range(0, len(data), SLICE):
        out += np.bincount(_KIND[data[i : i + SLICE]], minlength=_KINDS)
    return out


def judged(column: pa.Array, learned: np.ndarray) -> Iterator[tuple[int, np.ndarray, tuple, tuple]]:
    """For each row: its number, word hashes, quality and toxic votes."""
    fixed = {k: np.array([word_hash(w) for w in ws], np.uint64) for k, ws in (("insult", INSULTS), ("contempt", CONTEMPT))}
    data, at = texts(column)
    for first, last, begins, hashes in words(column, STEM):
        for i in range(first, last):
            own = hashes[begins[i - first] : begins[i - first + 1]]
            yield i, own[:, 0], *votes(_kinds(data[at[i] : at[i + 1]]), own[:, 0], own[:, 1], fixed | {"learned": learned})


def learn_words(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Hashes of at most LEXICON words and stems that stand out in toxic documents of the sample."""
    draw = F.md5(F.concat(F.lit("toxic-1:"), F.col("doc_id").cast("string")))
    known = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("id"), (F.col("toxic") > 0).alias("bad"), draw.alias("draw"))
    sample = known.where("bad").orderBy("draw").limit(TOXIC).unionByName(known.where("not bad").orderBy("draw").limit(CLEAN))
    few = F.broadcast(sample.select("id", "bad").distinct())       # TOXIC + CLEAN rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = batch.column("bad").to_numpy(zero_copy_only=False).astype(np.int64)
            found, which = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for first, last, begins, hashes in words(batch.column("text"), STEM):
                for i in range(first, last):
                    own = np.unique(hashes[begins[i - first] : begins[i - first + 1]])
                    found.append(own)
                    which.append(np.full(len(own), bad[i]))
            terms, at = np.unique(np.concatenate(found), return_inverse=True)
            n, toxic = np.bincount(at, minlength=len(terms)), np.bincount(at, np.concatenate(which), minlength=len(terms))
            keep = terms != 0
            yield pa.RecordBatch.from_arrays([pa.array(signed(terms[keep])), pa.array(toxic[keep].astype(np.int64)), pa.array((n - toxic)[keep].astype(np.int64))], names=["term", "bad", "good"])

    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.coalesce(docs["text"], F.lit("")).alias("text")).join(few, "id").select("bad", "text")
    sizes = {r["bad"]: r["n"] for r in sample.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    ratio = RATIO * sizes.get(True, 0) / max(1, sizes.get(False, 0))
    terms = (
        rows.mapInArrow(run, "term long, bad long, good long")
        .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where((F.col("bad") >= SUPPORT) & (F.col("bad") > F.lit(ratio) * (F.col("good") + 0.5)))
        .orderBy(F.col("bad").desc(), "term").limit(LEXICON).select("term").toArrow()
    )
    return np.sort(terms["term"].to_numpy().astype(np.int64).view(np.uint64))


def maximise(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of "yes" for each pattern of votes (rows), by expectation-maximisation.

    Labellers are taken as independent given the class. Each starts out as right in most of
    its votes, and that belief keeps a weight of 2% of the documents.
    """
    total = counts.sum()
    yes, no = (patterns == YES).sum(axis=1), (patterns == NO).sum(axis=1)
    post = (yes + 0.2) / (yes + no + 1.0)
    belief = np.array([[0.2, 0.7, 0.1], [0.2, 0.2, 0.6]]) * 0.02 * total
    onehot = patterns[:, :, None] == np.arange(3)
    for _ in range(rounds):
        each = np.stack([1 - post, post]) * counts
        prior = (each.sum(axis=1) + [0.9, 0.1]) / (total + 1)
        votes_by = np.einsum("cp,pkv->ckv", each, onehot) + belief[:, None, :]
        chance = votes_by / votes_by.sum(axis=2, keepdims=True)
        logs = np.einsum("ckv,pkv->cp", np.log(chance), onehot) + np.log(prior)[:, None]
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    return post


def _dense(quality: tuple, toxic: tuple) -> list[int]:
    all_votes = [*quality, *toxic]
    return [BUCKETS + 2 * k + v - 1 for k, v in enumerate(all_votes) if v != NONE]


WIDTH = BUCKETS + 2 * (len(QUALITY_VOTES) + len(TOXIC_VOTES)) + 1


def features(hashes: np.ndarray, quality: tuple, toxic: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features: hashed words (log counts, unit length), votes, and a constant."""
    counts = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    some = np.flatnonzero(counts)
    weights = np.log1p(counts[some])
    weights /= max(1e-9, float(np.sqrt((weights**2).sum())))
    extra = _dense(quality, toxic)
    return np.concatenate([some, extra, [WIDTH - 1]]).astype(np.int64), np.concatenate([weights, np.ones(len(extra) + 1)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 5) -> np.ndarray:
    """Weights (features x 2) by stochastic gradient descent on soft labels."""
    rng, w = np.random.default_rng(seed), np.zeros((WIDTH, 2))
    for epoch in range(EPOCHS):
        rate = 0.5 / (1 + epoch)
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            w[at] -= rate * np.outer(x, sigmoid(x @ w[at]) - labels[i])
    return w


@dataclass
class Scorer:
    quality: dict[int, float]       # posterior by vote pattern
    toxic: dict[int, float]
    weights: np.ndarray
    learned: np.ndarray             # words and stems, by hash

    def score(self, hashes: np.ndarray, quality: tuple, toxic: tuple) -> tuple[float, float]:
        at, x = features(hashes, quality, toxic)
        post = np.array([self.quality.get(_code(quality), 0.5), self.toxic.get(_code(toxic), 0.5)])
        low, bad = sigmoid((logit(post) + np.clip(x @ self.weights[at], -7, 7)) / 2)
        return float(low), float(bad)


def fit(docs: DataFrame, labels: DataFrame | None = None) -> Scorer:
    """Counts vote patterns over all documents, estimates labellers, trains the scorer."""
    learned = learn_words(docs, labels) if labels is not None else np.zeros(0, np.uint64)
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [(_code(q), _code(t)) for _, _, q, t in judged(batch.column("text"), learned)]
            both, n = np.unique(np.array(codes, np.int64).reshape(-1, 2), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(n)], names=["q", "t", "n"])

    seen = base.mapInArrow(patterns, "q long, t long, n long").groupBy("q", "t").agg(F.sum("n").alias("n")).toPandas()
    posterior = []
    for column, names in (("q", QUALITY_VOTES), ("t", TOXIC_VOTES)):
        by = seen.groupby(column)["n"].sum()
        codes = by.index.to_numpy()
        table = np.array([_decode(int(c), len(names)) for c in codes]).reshape(-1, len(names))
        post = maximise(table, by.to_numpy(dtype=float)) if len(codes) else np.zeros(0)
        posterior.append(dict(zip(map(int, codes), map(float, post), strict=True)))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"doc_id": [], "q": [], "t": [], "at": [], "x": []}
            ids = batch.column("doc_id").to_pylist()
            for i, own, q, t in judged(batch.column("text"), learned):
                at, x = features(own, q, t)
                for k, v in zip(out, (ids[i], _code(q), _code(t), at.astype(np.int32), x.astype(np.float32)), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("doc_id", pa.int64()), ("q", pa.int64()), ("t", pa.int64()), ("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float32()))]))

    draw = F.md5(F.concat(F.lit("quality-1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    few = base.select("doc_id", draw.alias("draw")).orderBy("draw", "doc_id").limit(SAMPLE).select("doc_id").distinct()
    sample = base.join(F.broadcast(few), "doc_id").mapInArrow(chosen, "doc_id long, q long, t long, at array<int>, x array<float>").toArrow()
    sample = sample.sort_by([("doc_id", "ascending"), ("q", "ascending")]).slice(0, SAMPLE)
    rows = [(a.values.to_numpy(), x.values.to_numpy()) for a, x in zip(sample["at"], sample["x"], strict=True)]
    soft = np.array([[posterior[0][q], posterior[1][t]] for q, t in zip(sample["q"].to_pylist(), sample["t"].to_pylist(), strict=True)])
    return Scorer(posterior[0], posterior[1], train(rows, soft) if rows else np.zeros((WIDTH, 2)), learned)


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """One row per row of docs: ``row`` (all its columns), doc_id, low_quality, toxic, kept."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")

    def run(column: pa.Array) -> pa.Array:
        out = [scorer.score(own, q, t) for _, own, q, t in judged(column, scorer.learned)]
        return pa.StructArray.from_arrays([pa.array([x[k] for x in out], pa.float64()) for k in (0, 1)], names=["low_quality", "toxic"])

    judge = F.arrow_udf(run, "low_quality double, toxic double")
    return (
        docs.select(row, docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
        .select("row", "doc_id", judge("text").alias("judged"))
        .select("row", "doc_id", "judged.low_quality", "judged.toxic")
        .withColumn("kept", (F.col("low_quality") <= 0.5) & (F.col("toxic") <= 0.5))
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).select(
        "doc_id", "low_quality", "toxic", (1 - F.greatest("low_quality", "toxic")).alias("score"), "kept"
    )


def accepted(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of docs that the classifier keeps, with all their columns."""
    return scored(docs, fit(docs, labels)).where("kept").select("row.*")


ORACLES: dict[str, str] = {}
QUERIES = {"op2_quality_classifier": op2_quality_classifier}
