"""Gold tables made queryable by SQL: temp views, or managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_gold(spark: SparkSession, tables: dict[str, DataFrame], mode: str = "view",
                  database: str | None = None) -> list[str]:
    """mode='view': lazy temp views (each query re-plans from the sources);
    mode='table': materialised managed tables (saveAsTable, overwrite)."""
    names = []
    for name, df in tables.items():
        if mode == "view":
            df.createOrReplaceTempView(name)
            names.append(name)
        elif mode == "table":
            full = f"{database}.{name}" if database else name
            df.write.mode("overwrite").saveAsTable(full)
            names.append(full)
        else:
            raise ValueError(f"unknown mode {mode!r}")
    return names
