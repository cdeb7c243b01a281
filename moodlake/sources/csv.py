"""Raw CSV ingest into bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Names a blank leading header column gets: pandas-style and Spark-style.
INDEX_COLUMNS = ["Unnamed: 0", "_c0"]


def read_tracks_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
                    multi_line: bool = False) -> DataFrame:
    """CSV with a header.  Files split by size; pass a schema, or every column
    is text (silver casts each value anyway), so the files are read once.  A
    stray index column is dropped.  With `multi_line` quoted fields may hold
    line breaks, but each file is then parsed by one task."""
    r = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    r = r.schema(schema) if schema is not None else r
    return drop_index_columns(r.csv(path))


def drop_index_columns(df: DataFrame) -> DataFrame:
    """df without the index column that a writer may have left."""
    return df.drop(*[c for c in INDEX_COLUMNS if c in df.columns])


def add_ingest_metadata(df: DataFrame, run_ts: str | Column, source: str) -> DataFrame:
    """Stamp load time and source id on every row."""
    ts = F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts.cast("timestamp")
    return df.withColumns({"ingestion_timestamp": ts, "source": F.lit(source)})
