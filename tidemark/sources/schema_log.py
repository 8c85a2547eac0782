"""CSV whose columns come and change over time: a versioned schema log beside the stream.

Every micro-batch logs the columns of its files: where each first came, and which kinds of
values it held. Values are stored as exact text, so a column that a new header brings is NULL
in older rows, and a type that widens later rewrites nothing. The kinds are counted while the
rows are written; no file is read a second time to infer types.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import ingest
from tidemark.streaming import flows
from tidemark.streaming.segments import Segments, folders, write_once

#: Kinds of text values. A set of them is a number, and sets merge by OR.
INT, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(7))
LINEAGE = ("_source_file", "_loaded_at")


def kind(value: Column) -> Column:
    """The narrowest kind of a text value; 0 for none. Integers beyond 64 bits count as doubles."""
    number = value.rlike(r"^[-+]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?$")
    whole = value.rlike(r"^[-+]?[0-9]+$")
    return (
        F.when(value.isNull() | (value == ""), 0)
        .when(whole & value.try_cast("int").isNotNull(), INT)
        .when(whole & value.try_cast("bigint").isNotNull(), LONG)
        .when(number, DOUBLE)
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), DATE)
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:") & value.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of(kinds: int) -> str:
    """The narrowest type that holds values of all these kinds."""
    for name, held in (
        ("int", INT), ("bigint", INT | LONG), ("double", INT | LONG | DOUBLE),
        ("date", DATE), ("timestamp", DATE | TIMESTAMP), ("boolean", BOOLEAN),
    ):
        if kinds and not kinds & ~held:
            return name
    return "string"


class SchemaLog:
    """Columns of a table of batches: (name, first batch, place in it, kinds), by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = Segments(spark, f"{path}/_schema", self._merge)

    @staticmethod
    def _merge(rows: DataFrame) -> DataFrame:
        """One row per column; names that differ in case only are one, spelled as they first came."""
        first = F.min(F.struct("first_batch", "place", "name")).alias("f")
        return rows.groupBy(F.lower("name").alias("key")).agg(first, F.bit_or("kinds").alias("kinds")).select("f.*", "kinds")

    def add(self, columns: Sequence[str], kinds: Mapping[str, int], batch_id: int) -> None:
        rows = [(batch_id, i, c, kinds[c]) for i, c in enumerate(columns)]
        self.table.add(self.spark.createDataFrame(rows, "first_batch long, place int, name string, kinds long"), batch_id)

    def columns(self, below: int | None = None) -> list[tuple[str, int, str]]:
        """Name, first batch and type of each column, in the order they came (a row per column)."""
        rows = self.table.read(below)
        if rows is None:
            return []
        return [(r["name"], r["first_batch"], type_of(r["kinds"])) for r in rows.orderBy("first_batch", "place").collect()]


def wide_csv(
    spark: SparkSession, paths: Sequence[str], aliases: Mapping[str, Sequence[str]], known: Sequence[str] = ()
) -> DataFrame:
    """CSV files, each by its own header, with every field a text column under its name.

    ``aliases`` maps a column to the names it goes by. Names that differ in case only, or from
    one that is ``known``, are one column. Lines that don't fit their header are kept whole in
    ``_rescued_data``.
    """
    spelled = {n.lower(): n for n in (*LINEAGE, ingest.RESCUED, *known)}
    renamed = {n.lower(): target for target, names in aliases.items() for n in names}
    parts = []
    for header, files in ingest.header_groups(spark, list(paths)).items():
        rows, place = ingest.read_by_header(spark, header, files)
        columns: dict[str, list[str]] = {}
        for name, at in place.items():
            target = renamed.get(name.lower(), name)
            columns.setdefault(spelled.setdefault(target.lower(), target), []).append(at)
        fields = [F.coalesce(*at).alias(n) for n, at in columns.items() if n not in (*LINEAGE, ingest.RESCUED)]
        parts.append(rows.select(*fields, F.col("_line").alias(ingest.RESCUED), *LINEAGE))
    if not parts:
        return spark.createDataFrame([], f"`{ingest.RESCUED}` string, _source_file string, _loaded_at timestamp")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _fields(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in (*LINEAGE, ingest.RESCUED, "batch_id")]


def _kinds(rows: DataFrame) -> list[Column]:
    return [F.coalesce(F.bit_or(kind(F.col(f"`{c}`"))), F.lit(0)).cast("long").alias(c) for c in _fields(rows)]


def csv_flow(
    spark: SparkSession,
    root: str,
    glob: str | None,
    path: str,
    checkpoint: str,
    max_files: int,
    aliases: Mapping[str, Sequence[str]] | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """New files under ``root`` to the table ``path``, whose columns grow with the files' headers."""
    log = SchemaLog(spark, path)

    def step(files: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        paths = [unquote(r["path"]) for r in files.collect()]       # max_files at most
        rows = wide_csv(spark, paths, aliases or {}, [n for n, _, _ in log.columns(batch_id)])
        if f"batch_id={batch_id}" in folders(spark, path):
            written = spark.read.parquet(f"{path}/batch_id={batch_id}")      # the run that wrote it may not have logged it
            found = written.agg(F.count(F.lit(1)).alias("_rows"), *_kinds(written)).first().asDict()
        else:
            seen = Observation()
            write_once(rows.observe(seen, F.count(F.lit(1)).alias("_rows"), *_kinds(rows)), path, batch_id)
            found = seen.get
        log.add(_fields(rows), found, batch_id)
        return {}

    return flows.run_step(ingest.new_files(spark, root, glob, max_files), step, checkpoint, wait)


def read(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """The table under its present schema: text, or each column under the type that holds all its values."""
    columns = SchemaLog(spark, path).columns()
    names = ", ".join(f"`{n}` string" for n in (*[n for n, _, _ in columns], ingest.RESCUED, "_source_file"))
    rows = spark.read.schema(f"{names}, _loaded_at timestamp").parquet(f"{path}/batch_id=*")
    if not typed:
        return rows
    return rows.select(*[F.col(f"`{n}`").try_cast(t).alias(n) for n, _, t in columns], ingest.RESCUED, *LINEAGE)
