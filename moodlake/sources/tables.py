"""Table I/O: read a layer, write a layer with its row count.

Layers are directories of a columnar format (parquet by default; `fmt` may
name any format whose jars are on the class path).  A plan must not overwrite
the path it reads, so writers go to folders of their own: one for each attempt
of a run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULT_FORMAT = "parquet"


def run_path(base: str, layer: str, name: str, run_id: str | None = None) -> str:
    """`<base>/<layer>/<name>/run=<id>`: the folder of a run."""
    return f"{base.rstrip('/')}/{layer}/{name}/run={run_id or uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Full-table scan; Catalyst prunes columns and pushes filters into it.
    How many splits it has is up to the files and maxPartitionBytes."""
    return spark.read.format(fmt).load(path)


def _observed(df: DataFrame, metrics: dict[str, Column] | None) -> tuple[DataFrame, Observation]:
    """df whose rows, and what `metrics` counts of them, are counted as they pass."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    counted = [F.count(F.lit(1)).alias("rows"), *[e.alias(n) for n, e in (metrics or {}).items()]]
    return df.observe(obs, *counted), obs


def write_measured(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite",
                   partition_by: list[str] | None = None, metrics: dict[str, Column] | None = None,
                   options: dict[str, str] | None = None) -> dict[str, int]:
    """Write, and return `rows` and the metrics (aggregates of the rows), all
    counted by an Observation during the write itself: no second pass."""
    observed, obs = _observed(df, metrics)
    if partition_by:
        # rows of one partition value go to few tasks (few files per
        # directory); adaptive execution splits a value that is too large
        # and merges small ones, so a hot value does not make one huge task
        observed = observed.hint("rebalance", *partition_by)
    w = observed.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return {k: int(v or 0) for k, v in obs.get.items()}


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> int:
    """Write and return the row count, counted during the write."""
    return write_measured(df, path, fmt, mode, partition_by)["rows"]


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, fmt: str = DEFAULT_FORMAT,
                   partition_by: list[str] | None = None, metrics: dict[str, Column] | None = None) -> dict[str, int]:
    """Write with the rows of each bucket of `key` in files of their own, sorted
    by it.  A frame already clustered by `key` into `buckets` partitions is not
    exchanged and leaves a file for each bucket (and partition value).  The table name Spark asks for is dropped
    again; the files stay."""
    name = f"bucketed_{uuid.uuid4().hex}"
    observed, obs = _observed(df, metrics)
    w = observed.write.format(fmt).bucketBy(buckets, key).sortBy(key).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")
    return {k: int(v or 0) for k, v in obs.get.items()}


def read_bucketed(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int,
                  fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A folder that write_bucketed wrote (of one partition value), clustered
    by `key`: a join or aggregation on it needs no exchange of this side."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    out = spark.table(name)
    out.schema  # resolved before the name goes  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return out
