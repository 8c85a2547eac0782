"""Tables, views and preconditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def require_table(spark: SparkSession, name: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise ValueError(f"required table not found: {name}")
    return spark.table(name)


def require_columns(
    df: DataFrame, required: Sequence[str], any_of: Sequence[str] = (), optional: Sequence[str] = ()
) -> tuple[DataFrame, str | None]:
    """Check and narrow to the expected columns; returns which of ``any_of`` is there."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    found = next((c for c in any_of if c in df.columns), None)
    if any_of and found is None:
        raise ValueError(f"none of these columns is there: {list(any_of)}")
    extra = [c for c in optional if c in df.columns]
    return df.select(*required, *([found] if found else []), *extra), found


def typed_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A handful of rows the caller holds, under a declared schema."""
    return spark.createDataFrame(rows, schema)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a result that several others read, and carry on from the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh(df: DataFrame, path: str) -> None:
    """Recompute a stored result; its schema may change."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def create_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """Create a typed table unless it exists. ``columns`` is DDL."""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def insert(df: DataFrame, name: str) -> None:
    """Insert by position, in the column order of the table."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def truncate(spark: SparkSession, name: str) -> None:
    """Empty a table, also one whose files lie outside the warehouse."""
    empty = spark.createDataFrame([], spark.table(name).schema)
    empty.write.insertInto(name, overwrite=True)


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
