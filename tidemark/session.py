"""Session helpers shared by tests, the bench and the registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, name: str = "tidemark", scratch: str | None = None) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own.

    ``scratch`` becomes ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.config("spark.checkpoint.dir", scratch) if scratch else SparkSession.builder
    return (
        builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # wide cleaning steps compile to methods past the JIT's size limit; lift the limit
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset, a
    folder in the warehouse takes its place: Spark asks that driver and executors
    share the warehouse as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.scratch"
    return f"{base.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"


_METHOD_LIMIT, _SPARKS_LIMIT = "spark.sql.codegen.hugeMethodLimit", "65535"


def split_wide_steps(spark: SparkSession) -> None:
    """Let Spark cut wide steps into methods that the JIT compiles.

    HotSpot interprets methods of more than 8,000 bytes, and a cleaning step of some twenty
    columns makes one if generated whole. Under this limit Spark generates such a step column by
    column. A limit that the session has set itself stays.
    """
    if spark.conf.get(_METHOD_LIMIT) == _SPARKS_LIMIT:
        spark.conf.set(_METHOD_LIMIT, "8000")
