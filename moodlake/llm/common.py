"""Helpers shared by the training-data operators: the shared folder, tables
written there to cut lineage, and the names under which a caller's columns
travel so that they never clash with an operator's own."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table of documents."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; only where that is unset
    (tests, one machine) a scratch folder is made and set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="moodlake-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet to a folder of its own in the shared folder
    and read back: later plans start from the files, so a lost executor costs
    a re-read and not a recomputation of everything before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def spent(*tables: DataFrame) -> None:
    """Remove the folders of tables that stored() gave, once everything made of
    them has itself been stored: nothing left to compute reads them."""
    for df in tables:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def step_done(spark: SparkSession, *tables: DataFrame) -> None:
    """Between the large steps of a job: remove spent tables, and let Spark
    delete the shuffle files of the steps before.  It does so when the driver's
    JVM finds that nothing refers to them, which left alone it may not look for
    until far more has been written."""
    import gc

    spent(*tables)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_caches: list = []
_beginner: str | None = None


def kept_by_worker(function):
    """functools.cache for what a Python worker keeps between tasks; it goes
    when tasks of another operator begin there."""
    cached = functools.cache(function)
    _caches.append(cached)
    return cached


def begin(operator: str) -> None:
    """Called where a task of an operator begins: if the worker served another
    one before, what that kept is let go and the memory given back, so that
    the stages of one session do not add up in workers that are used again."""
    global _beginner
    if _beginner != operator:
        _beginner = operator
        for cached in _caches:
            cached.cache_clear()
        give_back()


def give_back() -> None:
    """Return freed memory to the system, as far as the allocators can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_shipped: set[str] = set()

# Spark's 10,000 rows a batch are some 50 MB of texts, held by the JVM and by Python at once, in every task
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_A_BATCH = 1000


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once an application: their Python
    need not find it on a path of its own.  Batches to and from Python hold
    TEXTS_A_BATCH rows at most from then on in this session."""
    if int(spark.conf.get(BATCH_ROWS)) > TEXTS_A_BATCH:
        spark.conf.set(BATCH_ROWS, str(TEXTS_A_BATCH))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="moodlake-zip-"), "moodlake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "moodlake")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def renamed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the given columns, in order, as c0, c1, ...: whatever else the
    caller's table holds, and however it is named, stays out of the way."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


FILTER_BITS_PER_ROW = 16
MAX_ID_FILTER_BITS = 1 << 27  # 16 MB: the largest filter of ids that is broadcast


def id_filter(ids: DataFrame, column: str, bits_per_row: int = FILTER_BITS_PER_ROW):
    """A function of a long column that is true for every id in `ids` and for
    few others: a bit filter of MAX_ID_FILTER_BITS / 8 bytes at most, made by
    aggregation and broadcast.  What it lets through is to be joined exactly."""
    import numpy as np

    bits = 1 << 16
    rows = ids.count()
    while bits < rows * bits_per_row and bits < MAX_ID_FILTER_BITS:
        bits *= 2
    cell = F.pmod(F.xxhash64(column), F.lit(bits))
    words = (ids.select(F.shiftright(cell, 5).alias("word"), F.expr("1L").alias("one"), (cell % 32).cast("int").alias("at"))
             .select("word", F.expr("shiftleft(one, at)").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask"))
             .toArrow())
    table = np.zeros(bits // 32, np.uint32)
    table[words["word"].to_numpy()] = words["mask"].to_numpy().astype(np.uint32)
    shared = ids.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def held(cells):
        import pandas as pd

        begin("id filter")
        at = cells.to_numpy()
        return pd.Series((shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)

    return lambda name: held(F.pmod(F.xxhash64(F.col(f"`{name}`")), F.lit(bits)))
