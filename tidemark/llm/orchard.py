"""Centroid clustering with Orchard's search for the nearest centroid.

Each centroid has a list of the others, sorted by their distance from it. A vector starts at
some centroid and walks that centroid's list: an unvisited centroid is measured and marked;
if it is closer, the search jumps to its list. It ends at the first entry that lies strictly
beyond twice the current distance: by the triangle inequality that one, and all after it,
are farther than the current centroid. At exactly twice it may be as close, so it is still
measured; of equally close centroids the smaller number wins.

All vectors of a batch walk at once, one list entry per step. Distances are exact integers.
A round is one job: a task adds up its vectors per cluster, Spark adds the tasks' sums, and k
centroids come to the driver. The vectors are written once and never shuffled.

Defined results: rows whose vector is null, has another length or a null or non-finite entry
are dropped. Fewer vectors than centroids give that many centroids. Rows that repeat a vec_id
are vectors of their own; of equal ids the smaller vector is drawn first, and rows without an
id last. Integers beyond 2**62 are held there; a distance or inertia beyond 64 bits is null.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors_io import finite, matrices, scaled

DIMENSION, FACTOR = 64, 1024
CENTROIDS, ROUNDS, SEED = 8, 10, "3"
SMALL = 1 << 27     # entries below this have squared distances within 64 bits, up to 64 dimensions
ROWS = 1 << 14      # rows that walk together


def vectors_of(table: DataFrame, column: str = "embedding", dimension: int = DIMENSION, factor: int = FACTOR) -> DataFrame:
    kept = table.filter(finite(table[column]) & (F.size(table[column]) == dimension))
    return kept.select(kept["vec_id"].cast("long").alias("vec_id"), scaled(kept[column], factor).alias("x"))


def seeds(vectors: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> list[list[int]]:
    """The k vectors whose ids come first in a seeded order."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r["x"] for r in vectors.orderBy(draw.asc_nulls_last(), "x").limit(k).collect()]


class Orchard:
    """Nearest of k centroids, exact: ``search`` gives numbers, squared distances and how many were measured."""

    def __init__(self, centroids: list[list[int]]):
        most = max((abs(v) for c in centroids for v in c), default=0)
        self.kind = np.int64 if most < SMALL and all(len(c) <= 64 for c in centroids) else object
        self.centroids = np.array(centroids, self.kind).reshape(len(centroids), -1)
        gaps = self.centroids[:, None, :] - self.centroids[None, :, :]
        between = (gaps * gaps).sum(axis=2)
        k = len(centroids)
        self.lists = np.array([sorted((j for j in range(k) if j != c), key=lambda j: (between[c, j], j)) for c in range(k)], np.int64).reshape(k, -1)
        self.steps = np.take_along_axis(between, self.lists, axis=1)
        #: where a search starts: the centroid whose sum of components is next to the vector's
        sums = self.centroids.sum(axis=1)
        self.by_sum = np.array(sorted(range(k), key=lambda c: (sums[c], c)), np.int64)
        self.sums = sums[self.by_sum].astype(np.float64)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        c = self.centroids
        if self.kind is not object and int(max(x.max(initial=0), -x.min(initial=0))) >= SMALL:
            c = c.astype(object)
        x = x.astype(c.dtype)

        def measure(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
            gap = x[rows] - c[to]
            return (gap * gap).sum(axis=1)

        n, k = len(x), len(c)
        place = np.minimum(np.searchsorted(self.sums, x.sum(axis=1).astype(np.float64)), k - 1)
        best = self.by_sum[place]
        distance = measure(np.arange(n), best)
        visited = np.zeros((n, k), bool)
        visited[np.arange(n), best] = True
        at, measured = np.zeros(n, np.int64), n
        open_ = np.arange(n if k > 1 else 0)
        while len(open_):
            here, entry = best[open_], at[open_]
            beyond = (self.steps[here, entry] > 4 * distance[open_]).astype(bool)       # squared: beyond twice
            open_, here, entry = open_[~beyond], here[~beyond], entry[~beyond]
            to = self.lists[here, entry]
            new = ~visited[open_, to]
            rows, to = open_[new], to[new]
            visited[rows, to] = True
            far = measure(rows, to)
            measured += len(rows)
            closer = ((far < distance[rows]) | ((far == distance[rows]) & (to < best[rows]))).astype(bool)
            at[open_] += 1
            rows, to = rows[closer], to[closer]
            best[rows], distance[rows], at[rows] = to, far[closer], 0       # on to the closer centroid's list
            open_ = open_[at[open_] < k - 1]
        return best, distance, measured


def batches_of(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray]]:
    column = batch.column(batch.schema.get_field_index(name))
    for first in range(0, len(column), ROWS):
        for rows, x in matrices(column.slice(first, ROWS)):
            if len(rows):
                yield first, x


def cluster_sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of each cluster that has vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, found = Orchard(centroids), {}
        for batch in batches:
            for _, x in batches_of(batch, "x"):
                to, _, _ = search.search(x)
                for c in np.unique(to).tolist():
                    members = x[to == c]
                    safe = int(max(members.max(initial=0), -members.min(initial=0))) * len(members) < 2**62
                    sums = (members if safe else members.astype(object)).sum(axis=0).tolist()
                    count, total = found.get(c, (0, [0] * len(sums)))
                    found[c] = count + len(members), [a + b for a, b in zip(total, sums, strict=True)]
        out = [(c, i, count, Decimal(s)) for c, (count, total) in found.items() for i, s in enumerate(total)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        types = (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["c", "i", "n", "s"])

    parts = vectors.select("x").mapInArrow(run, "c int, i int, n long, s decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("c", "i").collect():
        out.setdefault(r["c"], (r["n"], []))[1].append(int(r["s"]))
    return out


def fitted(vectors: DataFrame, start: list[list[int]], rounds: int = ROUNDS) -> list[list[int]]:
    """Centroids after so many rounds; an empty cluster keeps its centroid."""
    centroids = start
    for _ in range(rounds):
        sums = cluster_sums(vectors, centroids)
        moved = [[s // sums[c][0] for s in sums[c][1]] if c in sums else old for c, old in enumerate(centroids)]
        if moved == centroids:      # every further round would give the same
            break
        centroids = moved
    return centroids


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance (decimal) and the centroids measured for the batch's rows, on its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for batch in batches:
            for first, x in batches_of(batch, "x"):
                to, distance, measured = search.search(x)
                ids = batch.column(0).slice(first, len(x))
                exact = pa.array([Decimal(d) if d < 10**38 else None for d in distance.tolist()], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(to, pa.int32()), exact, pa.array([measured] + [0] * (len(x) - 1), pa.int64())],
                    names=["vec_id", "cluster", "distance", "measured"],
                )

    return vectors.select("vec_id", "x").mapInArrow(run, "vec_id long, cluster int, distance decimal(38,0), measured long")


def clustered(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, dimension: int = DIMENSION, factor: int = FACTOR) -> tuple[DataFrame, list[list[int]]]:
    """Assignments (see ``assigned``) and the final centroids."""
    vectors = stored(vectors_of(table, dimension=dimension, factor=factor), "cluster-vectors")
    start = seeds(vectors, k, seed)
    centroids = fitted(vectors, start, rounds) if start else []
    if not start:
        return table.sparkSession.createDataFrame([], "vec_id long, cluster int, distance decimal(38,0), measured long"), []
    return stored(assigned(vectors, centroids), "clusters"), centroids


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings with 64 components: 8 centroids, 10 rounds."""
    return summary(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def summary(table: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    rows, centroids = clustered(table)
    per_cluster = rows.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()     # a row per centroid
    inertia = sum((r["sum"] or 0 for r in per_cluster), Decimal(0))
    facts = [
        (r["cluster"], r["sum"], inertia, hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest())
        for r in per_cluster
    ]
    schema = "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string"
    of_cluster = table.sparkSession.createDataFrame(facts, schema)
    longs = [F.col(c).try_cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")]
    return rows.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", *longs, "centroid_sha256")


def _oracle(k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The rounds as a chain of tables: cK holds the centroids after K rounds, aK the assignment to them."""

    def assignment(n: int) -> str:
        return f"""
        a{n} AS MATERIALIZED (
            SELECT rid, cid, d FROM (
                SELECT p.rid, c.cid, CAST(sum((p.v - c.v) * (p.v - c.v)) AS BIGINT) AS d
                FROM p JOIN c{n} c USING (pos) GROUP BY p.rid, c.cid)
            QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cid) = 1)"""

    steps = []
    for n in range(rounds):
        steps.append(assignment(n))
        steps.append(f"""
        m{n} AS (SELECT a.cid, p.pos, CAST(sum(p.v) AS BIGINT) AS s, CAST(count(*) AS BIGINT) AS q FROM a{n} a JOIN p USING (rid) GROUP BY a.cid, p.pos),
        c{n + 1} AS MATERIALIZED (
            SELECT o.cid, o.pos, CASE WHEN m.q IS NULL THEN o.v ELSE (m.s - ((m.s % m.q) + m.q) % m.q) // m.q END AS v
            FROM c{n} o LEFT JOIN m{n} m ON o.cid = m.cid AND o.pos = m.pos)""")
    steps.append(assignment(rounds))
    return f"""
        WITH r AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        p AS MATERIALIZED (SELECT rid, unnest(range(1, {DIMENSION + 1})) AS pos, unnest(x) AS v FROM r),
        s AS (SELECT rid, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, x) - 1 AS cid FROM r),
        c0 AS MATERIALIZED (SELECT s.cid, p.pos, p.v FROM s JOIN p USING (rid) WHERE s.cid < {k}),
        {",".join(steps)},
        h AS (SELECT cid, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY cid),
        t AS (SELECT cid, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY cid)
        SELECT r.vec_id, CAST(a.cid AS INTEGER) AS cluster, a.d AS distance, t.cluster_inertia,
               (SELECT CAST(sum(d) AS BIGINT) FROM a{rounds}) AS inertia, h.centroid_sha256
        FROM a{rounds} a JOIN r USING (rid) JOIN t USING (cid) JOIN h USING (cid)
    """


ORACLES = {"op12_centroid_clustering": _oracle()}
QUERIES = {"op12_centroid_clustering": op12_centroid_clustering}
