"""Exact dedup by composable polynomial fingerprints.

A text's UTF-8 bytes are cut into chunks; each chunk is hashed by itself, and chunk
hashes combine by length-shifted arithmetic: H(ab) = H(a) * base**len(b) + H(b). Equal
fingerprints only propose a group. The chunks of proposed texts are then compared byte
by byte: one aggregation counts, per proposed group and chunk number, the different
chunk contents. Copies collapse in that aggregation before the shuffle, so a group that
holds a third of all rows sends a few chunks per task. Groups that the comparison breaks
up (colliding fingerprints) are told apart by their text's SHA-256.

Defined results: a null text is an empty one; empty texts equal each other. A null
doc_id is below every other, so it stays only if its whole group has none. Of rows that
repeat both doc_id and text, one stays. Extra columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored, texts

CHUNK = 1 << 15
#: Primes below 2**31, so that a product of byte and power, summed over a chunk, fits 64 bits.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069069)


def chunk_powers(base: int, prime: int, chunk: int) -> np.ndarray:
    """base**(chunk-1), ..., base, 1 modulo prime."""
    out, p = np.empty(chunk, np.uint64), 1
    for i in range(chunk - 1, -1, -1):
        out[i], p = p, p * base % prime
    return out


def combine(left: int, right: int, right_length: int, base: int, prime: int) -> int:
    """Fingerprint of two joined byte strings from those of the parts."""
    return (left * pow(base, right_length, prime) + right) % prime


def fingerprint(data: np.ndarray, tables: list[np.ndarray], bases=BASES, primes=PRIMES) -> int:
    """All primes' fingerprints of ``data`` as one number below 2**62."""
    chunk, out = len(tables[0]), 0
    for table, base, prime in zip(tables, bases, primes, strict=True):
        whole = 0
        for i in range(0, len(data), chunk):
            part = data[i : i + chunk]
            own = int(np.dot(part.astype(np.uint64) + np.uint64(1), table[chunk - len(part) :])) % prime
            whole = combine(whole, own, len(part), base, prime)
        out = (out << 31) | whole
    return out


def fingerprints(docs: DataFrame, chunk: int = CHUNK, primes=PRIMES) -> DataFrame:
    """One row per row of docs: doc_id, fp, n_bytes, text_sha256 and a row number that
    stays the same once the result is stored."""
    schema = "rid long, doc_id long, text_sha256 string, fp long, n_bytes long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [chunk_powers(b, p, chunk) for b, p in zip(BASES, primes, strict=True)]
        for batch in batches:
            data, at = texts(batch.column("text"))
            fps = [fingerprint(data[at[i] : at[i + 1]], tables, BASES, primes) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rid", "doc_id", "text_sha256")), pa.array(fps, pa.int64()), pa.array(np.diff(at))],
                names=["rid", "doc_id", "text_sha256", "fp", "n_bytes"],
            )

    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("rid"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.sha2(text, 256).alias("text_sha256"),
        text.alias("text"),
    ).mapInArrow(run, schema)


def chunk_conflicts(docs: DataFrame, proposed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Fingerprints whose texts differ in some chunk. ``proposed`` names for each doc_id of
    a group of two or more its fingerprint."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("sha"))
    member = proposed.select("doc_id", F.col("text_sha256").alias("sha"), "fp").dropDuplicates()
    pieces = (
        rows.join(member, rows["doc_id"].eqNullSafe(member["doc_id"]) & (rows["sha"] == member["sha"]))
        .select("fp", "text", F.explode(F.sequence(F.lit(0), F.floor(F.length("text") / chunk).cast("int"))).alias("part"))
        .select("fp", "part", F.substring("text", F.col("part") * chunk + 1, F.lit(chunk)).alias("piece"))
    )
    return pieces.groupBy("fp", "part", "piece").agg(F.lit(1)).groupBy("fp", "part").count().where("count > 1").select("fp").distinct()


def exact_groups(docs: DataFrame, chunk: int = CHUNK, primes=PRIMES) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, n_bytes."""
    marks = stored(fingerprints(docs, chunk, primes), "fingerprints")
    # stored, so that joins deal out both sides plainly and Spark can split a group of copies
    repeated = stored(marks.groupBy("fp", "n_bytes").agg(F.count("*").alias("n")).where("n > 1").select("fp", "n_bytes"), "repeated")
    proposed = stored(marks.join(repeated, ["fp", "n_bytes"], "left_semi"), "proposed")
    broken = stored(chunk_conflicts(docs, proposed, chunk).withColumn("broken", F.lit(True)), "conflicts")
    exact = marks.join(broken, "fp", "left").withColumn(
        "part", F.when(F.col("broken"), F.col("text_sha256")).otherwise(F.lit(""))
    )
    groups = stored(
        exact.groupBy("fp", "n_bytes", "part").agg(F.max(F.struct("doc_id", "rid")).alias("best"), F.count("*").alias("group_size")),
        "groups",
    )
    return exact.join(groups, ["fp", "n_bytes", "part"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        "text_sha256",
        "n_bytes",
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    What stays, and whether several rows share its doc_id and text, is settled before whole rows move: they move once.
    """
    marks = exact_groups(docs).select("doc_id", F.unhex("text_sha256").alias("sha"), "kept")
    stays = stored(marks.groupBy("doc_id", "sha").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).where("kept").drop("kept"), "stays")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("id"),
        F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256)).alias("text_sha"),
    )

    def among(some: DataFrame) -> DataFrame:
        return rows.join(some, rows["id"].eqNullSafe(some["doc_id"]) & (rows["text_sha"] == some["sha"]), "left_semi")

    single = among(stays.where("n = 1"))
    # stored, so that Spark knows how few they are and leaves all other rows where they are
    many = stored(stays.where("n > 1"), "repeated-rows")
    if many.isEmpty():
        return single.select("row.*")
    return single.unionByName(among(many).dropDuplicates(["id", "text_sha"])).select("row.*")


ORACLES = {
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """
}
QUERIES = {"op5_exact_dedup": op5_exact_dedup}
