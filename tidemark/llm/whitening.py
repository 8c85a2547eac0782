"""Embedding whitening from a covariance weighted by multiplicity.

Vectors become integers, x = floor(64 * c) + 1000000, so equal vectors can be grouped: the
groups are the distinct x vectors with the number of rows that have them. That number (or
one, with ``weights="one"``) is a vector's weight in the fit. Sums are exact integers. Each
task adds up the weighted product of its centred vectors, (n*x - S) / n, whose numerator is
exact; the tasks' products are added in Spark, and only one d x d matrix reaches the driver.
Its eigenvectors go back to the tasks, each distinct vector is whitened once, and the result
is joined to the rows.

Copies collapse before the shuffle, so a vector that a third of all rows hold is one row per
task. In the join, the vectors that hold at least a thousandth of all rows (so a thousand of
them at most) are broadcast and their rows not shuffled; any other vector has fewer rows.

Defined results: rows whose vector is null or has a null or non-finite entry give no rows.
Vectors of one length are a space of their own with its own n, sums and components; an empty
vector has no components. A component without variance (an eigenvalue below 1e-13 of its
dimensions' own variances) is left out: it cannot be whitened. Rows that repeat a vec_id, or
have none, are rows of their own. A deviation beyond 64 bits is null in the query (the operator's is a decimal, null
beyond 38 digits). Entries beyond 2**62 / 64 count as that. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors_io import finite, matrices, scaled

FACTOR, OFFSET = 64, 1_000_000
COMPONENTS = 32
FLAT = 1e-13        # an eigenvalue below this share of its dimensions' own variances is rounding
WIDE = 1e-4         # eigenvalues that span more are found by rotations
HOT = 1_000         # vectors with 1/HOT of all rows are joined by broadcast


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """x, dim and the number of rows that hold x."""
    return rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows")).withColumn("dim", F.size("x"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        weight = np.asarray(batch.column(1))
        for rows, x in matrices(batch.column(0)):
            w = weight[rows]
            exact = len(x) and np.abs(x).max(initial=0).astype(float) * w.sum() < 2.0**62
            total = (w @ x).tolist() if exact else (w.astype(object) @ x.astype(object)).tolist() if x.shape[1] else []
            at = found.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            at[0] += int(w.sum())
            at[1] = [a + b for a, b in zip(at[1], total, strict=True)]
    out = [(d, i, n, Decimal(s)) for d, (n, sums) in found.items() for i, s in enumerate(sums)]
    columns = list(zip(*out, strict=True)) or [()] * 4
    types = (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["dim", "i", "n", "s"])


def fit_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and the exact sum per dimension, by vector length: a few numbers per dimension."""
    parts = vectors.select("x", "weight").mapInArrow(_sums, "dim int, i int, n long, s decimal(38,0)")
    spaces: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim", "i").collect():
        spaces.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    return spaces


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact; Python integers where 64 bits may not do."""
    most = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    if n * most + max(abs(s) for s in sums) < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(d: np.ndarray) -> list[int]:
    """Sum of squares per row, exact."""
    if d.dtype != object and float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 2.0**62:
        d = d.astype(object)
    return (d * d).sum(axis=1).tolist()


def products(points: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray]]]):
    """A task's weighted products of its points: (dim, i, j, v) with j >= i, and the sums as j = -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = defaultdict(lambda: np.float64(0))
        for batch in batches:
            for dim, a, w in points(batch):
                weighted = a * w[:, None]
                total[dim] = total[dim] + np.column_stack([weighted.sum(axis=0), weighted.T @ a])
        out = []
        for dim, m in total.items():
            i, j = np.nonzero(np.triu(np.ones((len(m), len(m)), bool)))
            i, j = np.r_[np.arange(len(m)), i], np.r_[np.full(len(m), -1), j]
            out.append((np.full(len(i), dim), i, j, m[i, j + 1]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0)] * 4
        types = (pa.int32(), pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, types, strict=True)], names=["dim", "i", "j", "v"])

    return run


def covariances(table: DataFrame, points, n_of: dict[int, int]) -> dict[int, np.ndarray]:
    """Covariance over n, by vector length. What comes to the driver is d*d numbers."""
    sums = table.mapInArrow(products(points), "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    by_dim: dict[int, list] = defaultdict(list)
    for r in sums:
        by_dim[r["dim"]].append((r["i"], r["j"], r["v"]))
    out = {}
    for dim, entries in by_dim.items():
        width = max(i for i, _, _ in entries) + 1
        mean, m = np.zeros(width), np.zeros((width, width))
        for i, j, v in entries:
            if j < 0:
                mean[i] = v / n_of[dim]
            else:
                m[i, j] = m[j, i] = v / n_of[dim]
        out[dim] = m - np.outer(mean, mean)
    return out


def rotated(v: np.ndarray, sweeps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors by Jacobi rotations.

    Each rotation is relative to the two variances that it turns, so small eigenvalues of
    dimensions on very different scales keep their digits, which a whole-matrix method loses.
    """
    v, q = v.copy(), np.eye(len(v))
    for _ in range(sweeps):
        turned = False
        for i in range(len(v) - 1):
            for j in range(i + 1, len(v)):
                if abs(v[i, j]) <= 1e-16 * np.sqrt(abs(v[i, i] * v[j, j])):
                    continue
                turned = True
                slope = (v[j, j] - v[i, i]) / (2 * v[i, j])
                t = (1.0 if slope >= 0 else -1.0) / (abs(slope) + np.hypot(1, slope))
                c = 1 / np.hypot(1, t)
                s, moved = t * c, t * v[i, j]
                a, b = c * v[:, i] - s * v[:, j], s * v[:, i] + c * v[:, j]
                ends = v[i, i] - moved, v[j, j] + moved
                v[:, i], v[i, :], v[:, j], v[j, :] = a, a, b, b
                v[i, i], v[j, j], v[i, j], v[j, i] = *ends, 0.0, 0.0
                q[:, [i, j]] = q[:, [i, j]] @ np.array([[c, s], [-s, c]])
        if not turned:
            break
    return np.diag(v), q


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, their unit eigenvectors as columns, and the trace. The largest entry of each is positive."""
    values, vectors = np.linalg.eigh(v)
    if values[0] < WIDE * values[-1]:
        values, vectors = rotated(v)
    # what rounding can make of an eigenvalue: a dimension adds no more than its own scale
    rounding = (np.abs(vectors).T @ np.sqrt(np.diag(v).clip(0))) ** 2
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > FLAT * rounding[order]]
    q = vectors[:, order]
    return values[order], q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])]), float(np.trace(v))


def whitened(rows: DataFrame, most: int = COMPONENTS, weights: str = "count") -> tuple[DataFrame, DataFrame]:
    """The distinct vectors of ``rows`` (any columns and x, an array of longs), whitened, and the spaces.

    First: x, rows (that hold it), dim, deviation and ``white`` (one value per component).
    Second: dim, n, ``explained`` (per component), identity_error; a row per vector length.
    """
    spark = rows.sparkSession
    weight = {"count": F.col("rows"), "one": F.lit(1).cast("long")}[weights]
    vectors = stored(distinct_vectors(rows).withColumn("weight", weight), "vectors")
    spaces = fit_sums(vectors)

    def centred(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        weight = np.asarray(batch.column(1), np.float64)
        for at, x in matrices(batch.column(0)):
            if x.shape[1]:
                n, sums = spaces[x.shape[1]]
                yield x.shape[1], (deviations(x, n, sums) / n).astype(np.float64), weight[at]

    n_of = {d: n for d, (n, _) in spaces.items()}
    fitted = {d: components(v, most) for d, v in covariances(vectors.select("x", "weight"), centred, n_of).items()}

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, held, dim, weight = batch.columns
            white: list = [[]] * len(x)
            deviation: list = [None] * len(x)
            for at, points in matrices(x):
                if not points.shape[1]:
                    continue
                n, sums = spaces[points.shape[1]]
                values, q, _ = fitted[points.shape[1]]
                d = deviations(points, n, sums)
                y = (d / n).astype(np.float64) @ q / np.sqrt(values)
                for k, row, square in zip(at.tolist(), y, squares(d), strict=True):
                    white[k], deviation[k] = row, Decimal(square) if square < 10**38 else None
            arrays = [x, held, dim, weight, pa.array(deviation, pa.decimal128(38, 0)), pa.array(white, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["x", "rows", "dim", "weight", "deviation", "white"])

    schema = "x array<long>, rows long, dim int, weight long, deviation decimal(38,0), white array<double>"
    white = stored(vectors.select("x", "rows", "dim", "weight").mapInArrow(whiten, schema), "white")

    def measured(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        dims, weight = np.asarray(batch.column(0)), np.asarray(batch.column(1), np.float64)
        for at, y in matrices(batch.column(2)):
            for dim in np.unique(dims[at]):
                if y.shape[1]:
                    here = dims[at] == dim
                    yield int(dim), y[here], weight[at][here]

    checks = covariances(white.select("dim", "weight", "white"), measured, n_of)
    error = max((float(np.abs(c - np.eye(len(c))).max()) for c in checks.values()), default=0.0)
    facts = [(d, n_of[d], [float(e / trace) for e in values], error) for d, (values, _, trace) in fitted.items()]
    return white.drop("weight"), spark.createDataFrame(facts, "dim int, n long, explained array<double>, identity_error double")


def joined(rows: DataFrame, white: DataFrame, total: int) -> DataFrame:
    """``rows`` with their vector's whitened form; see above on vectors with very many rows."""
    often = F.col("rows") * HOT >= F.lit(total)
    hot = F.broadcast(white.filter(often))
    few = rows.join(F.broadcast(white.filter(often).select("x")), "x", "left_anti").join(white.filter(~often), "x")
    return rows.join(hot, "x").unionByName(few)


def vector_rows(table: DataFrame, column: str = "embedding", factor: int = FACTOR, offset: int = OFFSET) -> DataFrame:
    """vec_id and x of the rows whose vector is whole and finite."""
    kept = table.filter(finite(table[column]))
    return kept.select(kept["vec_id"].cast("long").alias("vec_id"), scaled(kept[column], factor, offset).alias("x"))


def whiten_table(table: DataFrame, most: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = vector_rows(table)
    white, spaces = whitened(rows, most, weights)
    held = white.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    every = joined(rows, white, held)
    long = every.select("vec_id", "dim", "deviation", F.posexplode("white").alias("at", "whitened"))
    return long.join(F.broadcast(spaces), "dim").select(      # a row per vector length
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.element_at("explained", F.col("at") + 1).alias("explained"),
        "identity_error",
    )


def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all embeddings; components up to 32."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten_table(table).withColumn("deviation", F.col("deviation").try_cast("long"))


ORACLES: dict[str, str] = {}        # SQL has no eigenvectors; the tests compare with brute force
QUERIES = {"op11_whiten_embeddings": op11_whiten_embeddings}
