"""Tables that grow by micro-batches and stay cheap to read: folders written once, merged in tiers.

Batch N is the folder ``batch_id=N``. After every ``fan`` batches these are merged into one
segment, after every ``fan`` such segments those into the next, and so on, like the digits of a
counter: n batches are read as at most (fan - 1) * log(n) segments, and a row is rewritten
log(n) times in all. Merged segments lie under ``_merged``, which readers of the folder and
streams that follow it don't see. A segment's name says which batches it holds, so whatever
is run again finds it there and leaves it alone.

Folders appear under their names by a rename once they are complete. On a store without an
atomic rename of folders (most object stores), put such tables on one that has it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 4
COMPRESSION = "zstd"        # of whatever is written here: nothing is deleted, so it is kept small


def _store(spark: SparkSession, path: str):
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return as_path, as_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete folders under ``path``."""
    at, store = _store(spark, path)
    if not store.exists(at):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(at) if f.isDirectory())


class Draft:
    """The folder ``path/name``, written in parts, unless it is there already.

    They are written beside it under a hidden name, which no reader takes, and renamed when
    complete.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.target, self.store = _store(spark, f"{path}/{name}")
        self.there, self.mode = self.store.exists(self.target), "overwrite"
        self.spark, self.draft = spark, f"{path}/_draft-{name.removeprefix('batch_id=')}"

    def add(self, rows: DataFrame) -> Draft:
        if not self.there:
            rows.write.mode(self.mode).option("compression", COMPRESSION).parquet(self.draft)
            self.mode = "append"
        return self

    def finish(self) -> None:
        if not self.there and not self.store.rename(_store(self.spark, self.draft)[0], self.target):
            raise OSError(f"could not rename {self.draft}")


def write_folder(rows: DataFrame, path: str, name: str) -> None:
    """``rows`` as the folder ``path/name``, unless it is there already."""
    Draft(rows.sparkSession, path, name).add(rows).finish()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove files that are used up."""
    at, store = _store(spark, path)
    store.delete(at, True)


def write_once(rows: DataFrame, path: str, batch_id: int) -> None:
    """Rows of one micro-batch. A micro-batch holds the same input whenever it is run again."""
    write_folder(rows, path, f"batch_id={batch_id}")


@dataclass(frozen=True)
class Segments:
    """A table of batches whose rows ``merge`` brings together: of several segments, or of one."""

    spark: SparkSession
    path: str
    merge: Callable[[DataFrame], DataFrame]
    fan: int = FAN

    def batches(self) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in folders(self.spark, self.path) if n.startswith("batch_id="))

    def live(self, below: int | None = None) -> list[tuple[int, int]]:
        """First and last batch of the fewest segments that hold all batches (under ``below``)."""
        there = [b for b in self.batches() if below is None or b < below]
        merged = {}
        for name in folders(self.spark, f"{self.path}/_merged"):
            if not name.startswith("_"):
                first, last = map(int, name.split("-"))
                if below is None or last < below:
                    merged.setdefault(first, []).append(last)
        out, done = [], -1
        for batch in there:
            if batch > done:
                done = max([batch, *merged.get(batch, [])])
                out.append((batch, done))
        return out

    def folder(self, first: int, last: int) -> str:
        return f"{self.path}/batch_id={first}" if first == last else f"{self.path}/_merged/{first}-{last}"

    def _union(self, spans: Sequence[tuple[int, int]]) -> DataFrame:
        parts = [self.spark.read.parquet(self.folder(*span)) for span in spans]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def read(self, below: int | None = None) -> DataFrame | None:
        """The merged rows of all batches (under ``below``); None if there is none."""
        spans = self.live(below)
        return self.merge(self._union(spans)) if spans else None

    def compact(self, batch_id: int) -> None:
        """Merge what batch ``batch_id`` completes."""
        size = self.fan
        while (batch_id + 1) % size == 0:
            first = batch_id + 1 - size
            spans = [s for s in self.live(batch_id + 1) if s[0] >= first]
            if len(spans) > 1:
                write_folder(self.merge(self._union(spans)), f"{self.path}/_merged", f"{first}-{batch_id}")
            size *= self.fan

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch's rows, merged, and compact."""
        write_once(self.merge(rows), self.path, batch_id)
        self.compact(batch_id)


# ---- keys that were seen ----------------------------------------------------------------------

BUCKET_KEYS = 4_096         # keys that a bucket of the index holds, about
FILTER_BITS = 16            # of a bucket's Bloom filter, log2: 16 bits a key
PROBES = 4


def _probes(hashed: Column) -> Column:
    return F.array(*[F.xxhash64(hashed, F.lit(i)).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for i in range(PROBES)])


@dataclass(frozen=True)
class KeyIndex:
    """Which keys earlier batches of a table hold, without reading the table.

    ``tables`` are folders of batches; batch N of all of them together holds the keys of batch N.
    A segment of the index covers a run of batches. Its keys lie in hash buckets of a few
    thousand keys each, more buckets the more keys it has, and each bucket has a Bloom filter.
    A lookup asks the filters and then reads the buckets that may hold one of its keys.
    Segments are built from the tables when they are first needed, and merged in tiers.
    """

    spark: SparkSession
    tables: tuple[str, ...]
    keys: tuple[str, ...]
    fan: int = FAN

    @property
    def path(self) -> str:
        return f"{self.tables[0]}/_keys"

    def _spans(self) -> list[tuple[int, int]]:
        """Runs of batches with a segment; the filters are written last."""
        return [tuple(map(int, n.split("-")[:2])) for n in folders(self.spark, f"{self.path}/filters") if n[0] != "_"]

    def _live(self, below: int) -> list[tuple[int, int]]:
        spans, out, at = self._spans(), [], 0
        while at < below:
            ends = [b for a, b in spans if a == at and b < below]
            if not ends:
                raise ValueError(f"no index of batch {at} of {self.tables[0]}")
            out.append((at, max(ends)))
            at = max(ends) + 1
        return out

    def _write(self, keys: DataFrame, first: int, last: int) -> None:
        """Keys (one row each) as a segment: sorted by bucket, so that a read of some buckets skips the rest."""
        name = f"{first}-{last}"
        hashed = keys.select(*self.keys).withColumn("hash", F.xxhash64(*self.keys))
        depth = max(0, math.ceil(math.log2(max(1, hashed.count()) / BUCKET_KEYS)))
        bucket = F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")
        sorted_keys = hashed.withColumn("bucket", bucket).repartitionByRange("bucket").sortWithinPartitions("bucket", "hash")
        write_folder(sorted_keys, f"{self.path}/keys", name)
        written = self.spark.read.parquet(f"{self.path}/keys/{name}")
        held = written.select("bucket", F.explode(_probes(F.col("hash"))).alias("p")).select(
            "bucket", F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("bits")
        )
        sizes = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        zero, last_word = (F.lit(n).cast("long") for n in (0, (1 << FILTER_BITS - 6) - 1))
        blank = sizes.select("bucket", F.explode(F.sequence(zero, last_word)).alias("word"), zero.alias("bits"))
        words = held.unionByName(blank).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        arrays = words.groupBy("bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))
        filters = arrays.join(sizes, "bucket").withColumns({"segment": F.lit(name), "depth": F.lit(depth)})
        write_folder(filters, f"{self.path}/filters", name)

    def build(self, below: int) -> None:
        """Index batches under ``below`` that aren't yet, and merge full tiers."""
        done = {a for a, b in self._spans() if a == b}
        for batch in range(below):
            if batch not in done:
                parts = [f"{t}/batch_id={batch}" for t in self.tables if f"batch_id={batch}" in folders(self.spark, t)]
                if not parts:
                    raise ValueError(f"batch {batch} of {self.tables[0]} is missing")
                rows = reduce(DataFrame.unionByName, [self.spark.read.parquet(p).select(*self.keys) for p in parts])
                self._write(rows, batch, batch)
            size = self.fan
            while (batch + 1) % size == 0:
                first = batch + 1 - size
                if (first, batch) not in self._spans():
                    spans = [s for s in self._live(batch + 1) if s[0] >= first]
                    keys = self.spark.read.parquet(*[f"{self.path}/keys/{a}-{b}" for a, b in spans])
                    self._write(keys, first, batch)
                size *= self.fan

    def candidates(self, rows: DataFrame, below: int) -> tuple[DataFrame, int]:
        """Keys of earlier batches out of the buckets that may hold keys of ``rows``, and how many were read."""
        self.build(below)
        names = [f"{a}-{b}" for a, b in self._live(below)]
        filters = self.spark.read.parquet(*[f"{self.path}/filters/{n}" for n in names])
        depths = {r["segment"]: r["depth"] for r in filters.select("segment", "depth").distinct().collect()}
        if not depths:
            return self.spark.read.parquet(f"{self.path}/keys/{names[0]}").limit(0), 0
        segments = F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.lit(d).alias("depth")) for s, d in depths.items()]))
        bucket = F.when(F.col("s.depth") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftrightunsigned(hash, CAST(64 - s.depth AS INT))"))
        asked = rows.select(F.xxhash64(*self.keys).alias("hash")).withColumn("s", segments).select("hash", "s.segment", bucket.alias("bucket"))
        hit = F.forall(_probes(F.col("hash")), lambda p: F.col("words")[F.shiftright(p, 6).cast("int")].bitwiseAND(_bit(p)) != 0)
        # a row per bucket and segment: no more than the index has buckets
        found = asked.join(filters.drop("depth"), ["segment", "bucket"]).filter(hit).select("segment", "bucket", "n").distinct().collect()
        wanted: dict[str, list[int]] = {}
        for r in found:
            wanted.setdefault(r["segment"], []).append(r["bucket"])
        parts = [self.spark.read.parquet(f"{self.path}/keys/{s}").filter(F.col("bucket").isin(sorted(b))) for s, b in wanted.items()]
        none = self.spark.read.parquet(f"{self.path}/keys/{names[0]}").limit(0)
        return reduce(DataFrame.unionByName, parts, none), sum(r["n"] for r in found)

    def unseen(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows whose key no earlier batch holds. ``rows`` has one row per key."""
        if batch_id == 0:
            return rows
        seen, _ = self.candidates(rows, batch_id)
        seen = seen.select(*[F.col(f"`{k}`").alias(f"_seen_{k}") for k in self.keys])
        return rows.join(seen, [rows[k].eqNullSafe(seen[f"_seen_{k}"]) for k in self.keys], "left_anti")


def _bit(place: Column) -> Column:
    """The bit of a place within its 64-bit word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
