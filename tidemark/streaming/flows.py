"""Streaming flows. Batch operators run inside ``foreachBatch``; each micro-batch owns one
output folder (``batch_id=N``). The folder appears under that name once it is complete and is
never written again, so a retry leaves it alone and flows that follow the table see each row
exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import IntegralType

from tidemark.operators import dedup as batch_dedup
from tidemark.operators import quarantine, rules, skew
from tidemark.streaming.segments import Draft, KeyIndex, Segments, folders, write_once

Step = Callable[[DataFrame, int], Mapping[str, DataFrame]]


#: Spark's setting to drop a query's shuffle files when it ends, not when the driver collects its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that a step shuffles and keeps at once, about, where it works in slices: what that takes on disk doesn't follow the micro-batch.
SLICE = 1 << 21


def in_slices(rows: DataFrame, keys: Sequence[str], count: int) -> Iterator[DataFrame]:
    """Slices of about SLICE out of ``count`` rows, all rows of a key in one of them. What a slice left on disk goes before the next."""
    slices = max(1, -(-count // SLICE))
    for n in range(slices):
        if n:
            drop_unused(rows.sparkSession)
        yield rows if slices == 1 else rows.filter(F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(slices)) == n)


def drop_unused(spark: SparkSession) -> None:
    """Shuffle files below rows that were persisted go once the driver finds that nothing refers to them."""
    spark.sparkContext._jvm.System.gc()


def _start(stream: DataFrame, checkpoint: str, write, wait: bool) -> StreamingQuery:
    def tidy(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set(_DROP_SHUFFLES, "true")     # a session of the flow's own
        write(batch, batch_id)
        drop_unused(batch.sparkSession)

    query = (
        stream.writeStream.foreachBatch(tidy)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def run_step(stream: DataFrame, step: Step, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Run ``step`` on every micro-batch; it returns {path: rows to write there}."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for path, rows in step(batch, batch_id).items():
            write_once(rows, path, batch_id)

    return _start(stream, checkpoint, write, wait)


def run_flow(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    wait: bool = True,
) -> StreamingQuery:
    """Append ``transform`` of every micro-batch to one table."""
    return run_step(stream, lambda batch, _: {path: transform(batch)}, checkpoint, wait)


def watched_flow(
    stream: DataFrame,
    row_rules: rules.Rules,
    path: str,
    counts: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    wait: bool = True,
) -> StreamingQuery:
    """Warn-only rules on a stream: all rows go to ``path``, and each micro-batch's counts to ``counts``.

    The counts (rule, rows_seen, violations) are taken as the rows are written; only a batch
    whose rows were written by a run that then failed is measured again. ``read_counts`` adds
    them up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        if f"batch_id={batch_id}" in folders(batch.sparkSession, path):
            found = rules.measure(rows, row_rules)
        else:
            observed, seen = rules.observe(rows, row_rules, f"rules-{batch_id}")
            write_once(observed, path, batch_id)
            total = seen.get
            found = batch.sparkSession.createDataFrame(
                [(n, total["rows_seen"], total[n]) for n in row_rules], "rule string, rows_seen long, violations long"
            )
        write_once(found, counts, batch_id)

    return _start(stream, checkpoint, write, wait)


def read_counts(spark: SparkSession, counts: str) -> DataFrame:
    sums = [F.sum(n).alias(n) for n in ("rows_seen", "violations")]
    return spark.read.parquet(counts).groupBy("rule").agg(*sums)


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a flow has written to ``path`` yet."""
    return any("=" in name for name in folders(spark, path))


def stream_sink(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A table that another flow writes, as a stream."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path).drop("batch_id", "flow")


def split_flow(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    row_rules: rules.Rules,
    spec: quarantine.IssueSpec,
    good_path: str,
    issues_path: str,
    checkpoint: str,
    finish: Callable[[DataFrame, int], DataFrame] = lambda good, batch_id: good,
    wait: bool = True,
) -> StreamingQuery:
    """Good rows to one table, issue records to another; each micro-batch is transformed once.

    ``finish`` works on the good rows before they are written, given the batch number.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch).persist()
        try:
            good = finish(rules.keep_valid(rows, row_rules), batch_id)
            bad = quarantine.issue_log(rows, row_rules, spec)
            write_once(good, good_path, batch_id)
            write_once(bad, issues_path, batch_id)
        finally:
            rows.unpersist()

    return _start(stream, checkpoint, write, wait)


def dedup(stream: DataFrame, keys: Sequence[str], watermark: tuple[str, str] | None = None) -> DataFrame:
    """Native streaming dedup. Without a watermark its state keeps every key for good."""
    if watermark is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(keys))


def unseen(
    spark: SparkSession, rows: DataFrame, keys: Sequence[str], path: str | Sequence[str], batch_id: int
) -> DataFrame:
    """Rows whose key no earlier batch has written to ``path``. ``rows`` has one row per key.

    A key index beside the table answers, so a micro-batch reads filters and the few buckets
    that may hold its keys, not the keys of all batches. With several paths, their batches of
    one number make up one batch.
    """
    return KeyIndex(spark, (path,) if isinstance(path, str) else tuple(path), tuple(keys)).unseen(rows, batch_id)


def dedup_flow(
    spark: SparkSession,
    stream: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    order_by: Sequence[str] | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """First row per key over the whole stream, without an ever-growing state store.

    Copies inside a micro-batch go first, most of them before the shuffle; what is left is one
    row per key and anti-joins with those keys that earlier batches may have written.
    """

    def step(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        fresh = batch_dedup.dedup_first(batch, keys, order_by)
        return {path: unseen(spark, fresh, keys, path, batch_id)}

    return run_step(stream, step, checkpoint, wait)


def upsert_store(
    spark: SparkSession, path: str, keys: Sequence[str], sequence: Sequence[str], fan: int = 4
) -> Segments:
    """Winners per key in segments; see ``Segments``."""
    return Segments(spark, path, lambda rows: batch_dedup.latest_by_key(rows, keys, sequence), fan)


def upsert_flow(
    stream: DataFrame, keys: Sequence[str], sequence: Sequence[str], path: str, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    """Keyed upsert: every micro-batch writes its winners, ``read_upsert`` settles them.

    The order in which rows arrive does not matter, only their sequence does. Segments are
    merged on the way, so a read meets a key once per live segment, not once per batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_store(batch.sparkSession, path, keys, sequence).add(batch, batch_id)

    return _start(stream, checkpoint, write, wait)


def read_upsert(
    spark: SparkSession, path: str, keys: Sequence[str], sequence: Sequence[str], hide: Sequence[str] = ()
) -> DataFrame:
    rows = upsert_store(spark, path, keys, sequence).read()
    return (read_sink(spark, path) if rows is None else rows).drop(*hide)


STATE_BUCKETS = 1_024


def state_upsert(stream: DataFrame, keys: Sequence[str], sequence: Sequence[str], buckets: int = STATE_BUCKETS) -> DataFrame:
    """Upsert as keyed state: a row comes out when it beats the key's winner so far.

    The state store holds one row per key, packed in ``buckets`` of keys by their hash: a
    micro-batch calls Python once per bucket, whose rows are ranked in array operations, and not
    once per key. A bucket that gets a row is read and written whole, so give more buckets the
    more keys there are. Followers take the last row they saw of a key, which is its winner. NaN
    counts as missing. For tables that outgrow a state store, ``upsert_flow`` keeps them in folders.
    """
    names, bucket = stream.columns, "_bucket"
    while any(n.startswith(bucket) for n in names):
        bucket = f"_{bucket}"
    order = [*sequence, *[c for c in names if c not in keys and c not in sequence]]
    # frames come and go in local time
    schema = pa.schema([f.with_type(pa.timestamp("us")) if pa.types.is_timestamp(f.type) else f for f in to_arrow_schema(stream.schema)])
    ranked = [(n, "ascending") for n in [*keys, *order]]

    # a pandas column of numbers with nulls would hold floats: numbers come without, and flags tell which are null
    flags = {f.name: f"{bucket}{i}_" for i, f in enumerate(stream.schema) if isinstance(f.dataType, IntegralType)}

    def table(frame: pd.DataFrame) -> pa.Table:
        rows = pa.Table.from_pandas(frame[names], schema, preserve_index=False)
        for c, flag in flags.items():
            none = pa.scalar(None, schema.field(c).type)
            rows = rows.set_column(names.index(c), schema.field(c), pc.if_else(pa.array(frame[flag], pa.bool_()), none, rows[c]))
        return rows

    def winners(rows: pa.Table) -> pa.Array:
        """Places of the last row of each key. Nulls come first, as in ``latest_by_key``."""
        places = pc.sort_indices(rows, sort_keys=ranked, null_placement="at_start")
        last = np.zeros(len(places), bool)
        last[-1:] = True
        for k in keys:
            codes = pc.fill_null(rows[k].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)[places]
            last[:-1] |= codes[1:] != codes[:-1]
        return places.filter(pa.array(last))

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else schema.empty_table()
        best = schema.empty_table()
        for frame in frames:
            best = pa.concat_tables([best, table(frame)])
            best = best.take(winners(best))
        # what is known comes last, and stays if a row is no better
        both = pa.concat_tables([best, before])
        places = winners(both)
        beaten = places.filter(pc.less(places, len(best)))
        if len(beaten):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema) as out:
                out.write_table(both.take(places).combine_chunks())
            state.update((sink.getvalue().to_pybytes(),))
            yield both.take(beaten).to_pandas(integer_object_nulls=True, date_as_object=True).astype(dict.fromkeys(flags, object))

    dealt = stream.withColumn(bucket, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)))
    dealt = dealt.withColumns({flag: F.col(f"`{c}`").isNull() for c, flag in flags.items()})
    dealt = dealt.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(stream.schema[c].dataType)) for c in flags})
    return dealt.groupBy(bucket).applyInPandasWithState(step, stream.schema, "winners binary", "append", "NoTimeout")


def compact_upsert(
    spark: SparkSession, path: str, keys: Sequence[str], sequence: Sequence[str], target: str
) -> None:
    """Rewrite the settled rows as a new table, so later reads have one row per key to scan."""
    read_upsert(spark, path, keys, sequence).write.mode("overwrite").parquet(f"{target}/batch_id=0")


def aggregate_flow(
    stream: DataFrame,
    parts_of: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    fan: int = 4,
    wait: bool = True,
) -> StreamingQuery:
    """Incremental aggregate: each micro-batch adds its parts, and segments of parts merge.

    A refresh reads the rows that are new; a read of the result, a row per key and live segment.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        Segments(batch.sparkSession, path, merge, fan).add(parts_of(batch), batch_id)

    return _start(stream, checkpoint, write, wait)


def enrich(stream: DataFrame, static: DataFrame, on: Sequence[str]) -> DataFrame:
    """Stream-static left join. A static row that comes late leaves NULLs for good; see ``late_flow``."""
    return stream.join(static, list(on), "left")


def enrich_flow(
    stream: DataFrame, static: DataFrame, on: Sequence[str], path: str, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    """``enrich`` written to a table, even when a few keys hold much of the stream.

    ``static`` has one row per key; each micro-batch sees it as it is at that time.
    """
    return run_flow(stream, path, checkpoint, lambda batch: skew.left_join_unique(batch, static, on), wait)


@dataclass(frozen=True)
class Waiting:
    """Rows whose partner hasn't come yet, and those that a late partner has completed since.

    ``waiting`` is a folder of batches, ``repaired`` one that ``late_flow`` writes; ``keys``
    tell rows apart. As segments merge, rows that were completed drop out of them.
    """

    spark: SparkSession
    waiting: str
    repaired: str
    keys: tuple[str, ...]

    def _still(self, rows: DataFrame) -> DataFrame:
        if not has_rows(self.spark, self.repaired):
            return rows
        done = read_sink(self.spark, self.repaired).select(*[F.col(k).alias(f"_done_{k}") for k in self.keys])
        return rows.join(done, [rows[k].eqNullSafe(done[f"_done_{k}"]) for k in self.keys], "left_anti")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        self.finish(self.draft(batch_id).add(rows), batch_id)

    def draft(self, batch_id: int) -> Draft:
        """For the rows of a micro-batch that come in parts."""
        return Draft(self.spark, self.waiting, f"batch_id={batch_id}")

    def finish(self, rows: Draft, batch_id: int) -> None:
        rows.finish()
        self._segments().compact(batch_id)

    def _segments(self) -> Segments:
        return Segments(self.spark, self.waiting, self._still)

    def open(self) -> DataFrame | None:
        """What still waits; None if nothing ever did."""
        return self._segments().read()

    def most(self) -> int:
        """How many rows may still wait, by the sizes of the segments; no row is read."""
        return sum(self.spark.read.parquet(self._segments().folder(*span)).count() for span in self._segments().live())


def late_flow(
    partners: DataFrame,
    waiting: Waiting,
    complete: Callable[[DataFrame, DataFrame], DataFrame],
    checkpoint: str,
    wait: bool = True,
) -> StreamingQuery:
    """Complete waiting rows as their partners come in.

    ``complete(open rows, new partners)`` gives the rows that now have one; each is written once.
    It is given the open rows slice by slice.
    Run it on every batch of partners before the flow that looks partners up runs again: then a
    row either finds its partner or waits in time for it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = waiting.open()
        if rows is None:
            return
        out = Draft(waiting.spark, waiting.repaired, f"batch_id={batch_id}")
        for part in in_slices(rows, waiting.keys, waiting.most()):
            out.add(complete(part, batch))
        out.finish()

    return _start(partners, checkpoint, write, wait)


def multi_flow(
    flows: Mapping[str, DataFrame], root: str, checkpoint_root: str, wait: bool = True
) -> list[StreamingQuery]:
    """Several streams append to one log; each flow owns a folder ``flow=name`` and a checkpoint."""
    started = [
        run_flow(stream, f"{root}/flow={name}", f"{checkpoint_root}/{name}", wait=False)
        for name, stream in flows.items()
    ]
    if wait:
        for query in started:
            query.awaitTermination()
    return started
