"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its subwords: byte runs of three and four that
centre on a letter, with anything that is no letter read as a space. Embeddings and softmax
are trained together by stochastic gradient descent in numpy, on a bounded sample of
labelled documents: at most ``PER_LANGUAGE`` of each language and ``SAMPLE`` in all, those
first in a seeded order; each gives its whole text and one short passage of it. A fifth of
the sample is held back to fit the softmax temperature and the rejection bound.

Since the model is linear after the embedding, a prediction needs only the product of both
tables: one row of class scores per subword bucket.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is
rejected. A null doc_id counts as empty text in the fold, so it is held out. Rows of null
language teach nothing; without any labelled row all predictions are ``und``. Ties go to
the language first in code point order. Extra columns are ignored; repeated rows are rows
of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, SLICE, documents, slices, texts

BUCKETS = 1 << 13
WIDTH = 16
PER_LANGUAGE = 400
SAMPLE = 3200
PASSAGE = 80
EPOCHS = 25
#: Predictions below the bound are flagged; it is set where this share of held-back errors is flagged.
REJECT_SHARE = 0.9

_LETTER = np.zeros(256, bool)
for _a, _b in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _LETTER[_a:_b] = True
_CODE = np.where(_LETTER, LOWER, 0x20).astype(np.uint32)


def subwords(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords in ``data`` and, for each row start in ``at``, where its own begin."""
    n = len(data)
    code = np.full(n + 3, 0x20, np.uint32)
    code[1 : n + 1] = _CODE[data]
    centres = np.flatnonzero(_LETTER[data])
    starts = np.zeros(n + 1, bool)
    starts[at] = True
    left = np.where(starts[centres], 0x20, code[centres])
    middle = code[centres + 1]
    ends = starts[centres + 1]
    right = np.where(ends, 0x20, code[centres + 2])
    further = np.where(ends | starts[np.minimum(centres + 2, n)], 0x20, code[centres + 3])
    three = (left << np.uint32(16)) | (middle << np.uint32(8)) | right
    four = (three << np.uint32(8)) | further
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    pairs = np.empty((len(centres), 2), np.int64)
    pairs[:, 0] = (three * np.uint32(0x9E3779B1)) >> shift
    pairs[:, 1] = (four * np.uint32(0x85EBCA6B)) >> shift
    return pairs.ravel(), 2 * np.searchsorted(centres, at)


def histogram(data: np.ndarray) -> np.ndarray:
    """Subword counts of one text, whatever its length, piece by piece."""
    out = np.zeros(BUCKETS, np.float32)
    for i in range(0, len(data), SLICE):
        lo, hi = max(0, i - 1), min(len(data), i + SLICE + 2)
        buckets, _ = subwords(data[lo:hi], np.array([0, hi - lo]))
        letters = np.flatnonzero(_LETTER[data[lo:hi]]) + lo
        own = np.repeat((letters >= i) & (letters < i + SLICE), 2)
        out += np.bincount(buckets[own], minlength=BUCKETS)
    return out


def averaged(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray          # class scores of each bucket, divided by the temperature
    bound: float

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = softmax(averaged(counts) @ self.scores)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def fit(counts: np.ndarray, langs: list[str], held: np.ndarray, seed: int = 7) -> Model:
    """Stochastic gradient descent over the rows not held back; calibration over those that are."""
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    x = averaged(counts).astype(np.float32)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out = rng.normal(0, 0.1, (WIDTH, len(names))).astype(np.float32)
    train = np.flatnonzero(~held)
    train = train if len(train) else np.arange(len(y))
    share = np.bincount(y[train], minlength=len(names))
    weight = (len(train) / (len(names) * np.maximum(share, 1)))[y].astype(np.float32)
    for epoch in range(EPOCHS):
        rate = np.float32(20 * (1 - epoch / EPOCHS))
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 32)):
            hidden = x[part] @ emb
            error = softmax(hidden @ out)
            error[np.arange(len(part)), y[part]] -= 1
            error *= weight[part, None] / len(part)
            back = error @ out.T
            out -= rate * (hidden.T @ error)
            emb -= rate * (x[part].T @ back)
    scores = emb @ out
    check = np.flatnonzero(held) if held.any() else train
    logits = x[check] @ scores
    heats = np.geomspace(0.05, 20, 61)
    loss = [-np.log(softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-9).mean() for t in heats]
    scores = scores / np.float32(heats[int(np.argmin(loss))])
    p = softmax(x[check] @ scores)
    wrong = p.max(axis=1)[p.argmax(axis=1) != y[check]]
    bound = float(np.quantile(wrong, REJECT_SHARE)) if len(wrong) else 1 / max(2, len(names))
    return Model(names, scores.astype(np.float32), bound)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def sample(docs: DataFrame) -> DataFrame:
    """The bounded sample of labelled documents, as subword counts (bucket, count)."""
    seeded = F.md5(F.concat(F.lit("lang-1:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))))
    labelled = docs.where(docs["lang"].isNotNull() & (fold(docs["doc_id"]) != 0) & docs["text"].rlike(r"\p{L}")).select(
        docs["lang"].alias("lang"), docs["doc_id"].cast("long").alias("doc_id"), fold(docs["doc_id"]).alias("fold"), seeded.alias("draw"), docs["text"].alias("text")
    )
    order = [F.col("draw"), F.col("doc_id")]
    chosen = (
        labelled.drop("text")
        .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("n") <= PER_LANGUAGE)
        .orderBy("n", "draw", "lang")
        .limit(SAMPLE)
        .select("lang", "doc_id")
    )
    few = chosen.distinct().alias("c")      # at most SAMPLE rows
    rows = labelled.alias("l").join(
        F.broadcast(few), (F.col("l.lang") == F.col("c.lang")) & F.col("l.doc_id").eqNullSafe(F.col("c.doc_id"))
    ).select("l.lang", "l.doc_id", "l.fold", "l.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts(batch.column("text"))
            out = {"lang": [], "doc_id": [], "held": [], "bucket": [], "count": []}
            for i in range(batch.num_rows):
                text = data[at[i] : at[i + 1]]
                cut = int(batch.column("doc_id")[i].as_py() or 0) * 7919 % max(1, len(text) - PASSAGE)
                for part in (text, text[cut : cut + PASSAGE]):
                    counts = histogram(part)
                    some = np.flatnonzero(counts)
                    if len(some):
                        out["lang"].append(batch.column("lang")[i].as_py())
                        out["doc_id"].append(batch.column("doc_id")[i].as_py())
                        out["held"].append(batch.column("fold")[i].as_py() == 1)
                        out["bucket"].append(some.astype(np.int16))
                        out["count"].append(counts[some])
            yield pa.RecordBatch.from_pydict(out, pa.schema([("lang", pa.string()), ("doc_id", pa.int64()), ("held", pa.bool_()), ("bucket", pa.list_(pa.int16())), ("count", pa.list_(pa.float32()))]))

    return rows.mapInArrow(run, "lang string, doc_id long, held boolean, bucket array<short>, count array<float>")


def train(docs: DataFrame) -> Model | None:
    got = sample(docs).toArrow().sort_by([("lang", "ascending"), ("doc_id", "ascending")])
    if not len(got):
        return None
    counts = np.zeros((len(got), BUCKETS), np.float32)
    for i, (bucket, count) in enumerate(zip(got["bucket"], got["count"], strict=True)):
        counts[i, bucket.values.to_numpy()] = count.values.to_numpy()
    return fit(counts, got["lang"].to_pylist(), np.array(got["held"].to_pylist(), bool))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts(batch.column("text"))
            letter = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for first, last in slices(at) if model else ():
                if at[last] - at[first] > SLICE:
                    counts = histogram(data[at[first] : at[last]])[None]
                else:
                    buckets, begins = subwords(data[at[first] : at[last]], at[first : last + 1] - at[first])
                    counts = np.stack([np.bincount(buckets[a:b], minlength=BUCKETS) for a, b in zip(begins, begins[1:], strict=False)]).astype(np.float32)
                best[first:last], score[first:last] = model.predict(counts)
            known = letter & (model is not None)
            names = np.array(model.languages if model else ["und"], dtype=object)[best]
            names[~known] = "und"
            score[~known] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(~known | (score < (model.bound if model else 0)))],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (fold(docs["doc_id"]) == 0).alias("held_out"),
        F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)).alias("letter"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, train(docs))


ORACLES: dict[str, str] = {}
QUERIES = {"op8_language_id": op8_language_id}
