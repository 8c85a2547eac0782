"""Raw files to rows: globbed CSV / JSON, drifting headers, rescued fields, lineage."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import let

RESCUED = "_rescued_data"


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the file each row came from and the time it was loaded."""
    return df.withColumns(
        {"_source_file": F.col("_metadata.file_path"), "_loaded_at": F.current_timestamp()}
    )


def _options(fmt: str, glob: str | None) -> dict[str, str]:
    options = {"recursiveFileLookup": "true"}
    if glob:
        options["pathGlobFilter"] = glob
    if fmt == "csv":
        # a file whose header differs from the schema is an error, not a silent mix of columns
        options.update({"header": "true", "enforceSchema": "false"})
    elif fmt == "json":
        options["multiLine"] = "false"
    return options


def infer_schema(spark: SparkSession, root: str, fmt: str, glob: str | None = None) -> T.StructType:
    """Column types from the files present now; a stream reuses them as its schema."""
    reader = spark.read.format(fmt).options(**_options(fmt, glob))
    if fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(root).schema


def read_files(
    spark: SparkSession, root: str, fmt: str, glob: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read.format(fmt).options(**_options(fmt, glob))
    return with_lineage(reader.schema(schema or infer_schema(spark, root, fmt, glob)).load(root))


def file_stream(
    spark: SparkSession,
    root: str,
    fmt: str,
    glob: str | None = None,
    schema: T.StructType | str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Incremental read of files as they appear under ``root``."""
    options = _options(fmt, glob)
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    reader = spark.readStream.format(fmt).options(**options)
    return with_lineage(reader.schema(schema or infer_schema(spark, root, fmt, glob)).load(root))


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """A stored Parquet table, file or folder, as a stream."""
    options = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    # the bracket makes the path a glob, which a stream accepts for a single file as well
    return (
        spark.readStream.schema(schema or spark.read.parquet(path).schema)
        .options(**options)
        .format("parquet")
        .load(path[:-1] + f"[{path[-1]}]")
    )


def header_groups(spark: SparkSession, source: str | Sequence[str], glob: str | None = None) -> dict[str, list[str]]:
    """The files under ``source`` by their header line. One distributed job over the first lines.

    Only headers and paths reach the driver, which lists the files for any read.
    """
    paths = [source] if isinstance(source, str) else list(source)
    options = {**_options("text", glob), "recursiveFileLookup": "true"}
    lines = spark.read.options(**options).text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    first = lines.filter((F.col("start") == 0) & (F.length(F.trim("value")) > 0)).groupBy("path").agg(
        F.min_by("value", "line").alias("header")
    )
    groups: dict[str, list[str]] = {}
    for r in first.orderBy("path").collect():
        groups.setdefault(r["header"].lstrip("\ufeff").rstrip("\r"), []).append(unquote(r["path"]))
    return groups


def _distinct(names: Sequence[str]) -> list[str]:
    """Header names, told apart by a number where they repeat."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def read_by_header(spark: SparkSession, header: str, files: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Files of one header as text columns, and the column of each name in the header.

    ``_line`` holds a line of more or fewer fields than its header.
    """
    names = _distinct(next(csv.reader([header])))
    cols = [f"_c{i}" for i in range(len(names))]
    schema = T.StructType([*(T.StructField(n, T.StringType()) for n in cols), T.StructField("_line", T.StringType())])
    options = {
        "header": "true",
        "enforceSchema": "true",
        "columnPruning": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_line",
    }
    # brackets and braces in a path would be read as a glob
    escaped = [re.sub(r"([\[\]{}*?\\])", r"\\\1", f) for f in files]
    rows = with_lineage(spark.read.schema(schema).options(**options).csv(escaped))
    return rows, dict(zip(names, cols, strict=True))


def _by_header(spark: SparkSession, header: str, files: Sequence[str], aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    rows, place = read_by_header(spark, header, files)
    names = list(place)
    known = {n for alias in aliases.values() for n in alias}
    wanted = [
        F.coalesce(*[F.col(place[n]) for n in alias if n in place], F.lit(None).cast("string")).alias(target)
        for target, alias in aliases.items()
    ]
    extra = [F.struct(F.lit(n).alias("key"), F.col(place[n]).alias("value")) for n in names if n not in known]
    # a line of more or fewer fields than its header is kept whole
    extra.append(F.struct(F.lit("_line").alias("key"), F.col("_line").alias("value")))
    kept = F.map_from_entries(F.filter(F.array(*extra), lambda e: e["value"].isNotNull()))
    return rows.select(*wanted, F.when(F.size(kept) > 0, F.to_json(kept)).alias(RESCUED), "_source_file", "_loaded_at")


def drifting_csv(
    spark: SparkSession, source: str | Sequence[str], glob: str | None, aliases: Mapping[str, Sequence[str]]
) -> DataFrame:
    """CSV files whose headers differ. Every file is read by its own header, values as exact text.

    ``aliases`` maps each target column to the header names it goes by; the first present,
    non-null one wins. Fields under any other name are kept as JSON in ``_rescued_data``, and
    so are lines that don't fit their header. Files of one header make up one read. ``source``
    is a folder or a list of files; with no file at all the result has no rows.
    """
    parts = [_by_header(spark, header, files, aliases) for header, files in header_groups(spark, source, glob).items()]
    if not parts:
        columns = ", ".join(f"`{n}` string" for n in (*aliases, RESCUED, "_source_file"))
        return spark.createDataFrame([], f"{columns}, _loaded_at timestamp")
    return reduce(DataFrame.unionByName, parts)


def new_files(spark: SparkSession, root: str, glob: str | None, max_files: int) -> DataFrame:
    """Paths of files as they appear under ``root``, as a stream; their contents aren't read."""
    options = {**_options("binaryFile", glob), "maxFilesPerTrigger": str(max_files)}
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).options(**options).load(root).select("path")


def csv_groups(spark: SparkSession, root: str, globs: Sequence[str], stream: bool = False) -> DataFrame:
    """CSV files in groups that share a header each, one glob per group, values as exact text.

    The columns of all groups are united by name; what a group lacks is NULL.
    """
    parts = []
    for glob in globs:
        reader = spark.read.format("csv").options(**_options("csv", glob))
        names = reader.load(root).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        parts.append(
            file_stream(spark, root, "csv", glob, schema) if stream else read_files(spark, root, "csv", glob, schema)
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def json_rescue(
    spark: SparkSession,
    root: str,
    glob: str | None,
    schema: T.StructType | str,
    stream: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """JSON lines against a fixed schema. Unknown or misfitting fields go to ``_rescued_data``.

    A field whose value does not fit its type reads NULL and is kept in the rescue column,
    as are fields outside the schema. A line that is not JSON is kept whole.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = (spark.readStream if stream else spark.read).format("text").options(**_options("text", glob))
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    lines = with_lineage(reader.load(root)).filter(F.length(F.trim("value")) > 0)
    parsed = lines.withColumn("_row", F.try_parse_json("value"))
    row = F.col("_row")
    typed = {f"_typed_{i}": F.try_variant_get(row, f"$['{f.name}']", f.dataType.simpleString()) for i, f in enumerate(wanted)}
    read = parsed.withColumns({**typed, "_fields": F.try_variant_get(row, "$", "map<string,variant>")})
    fields = F.col("_fields")
    settled = F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(f.name)) for n, f in zip(typed, wanted)]))

    def left_over(known: Column) -> Column:
        extra = F.map_filter(fields, lambda k, v: ~F.array_contains(known, k) & ~F.is_variant_null(v))
        return let(extra, lambda e: F.when(F.size(e) > 0, F.to_json(e)))

    # most lines have no field but those that fit: the search for others is left to the rest
    rescued = F.when(fields.isNull(), F.col("value")).otherwise(
        let(settled, lambda known: F.when(F.size(fields) > F.size(known), left_over(known)))
    )
    return read.select(
        *[F.col(n).alias(f.name) for n, f in zip(typed, wanted)],
        rescued.alias(RESCUED),
        "_source_file",
        "_loaded_at",
    )
