"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one input table through Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str, compression: str = "snappy", by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and scan it.

    Cuts the lineage like ``checkpoint()``, but keeps column pruning, and the
    planner knows the real size of the table: it broadcasts a side of a join
    only when the bytes on disk are under ``autoBroadcastJoinThreshold``.
    With ``by`` there is a folder per value of that column, so that a filter on
    it reads no other.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache() -> dict:
    """A dict that lives as long as the Python process it is called in.

    Functions shipped by value get fresh module globals in every task; what is
    dear to build (compiled tables) is kept here between tasks of one worker.
    """
    name = "_wardline_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__


#: rows of long texts that go to Python at once
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows (a smaller
    setting stays): texts are long, and a batch is held by the JVM and by the
    Python worker of every running task."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def values(column):
    """The Python values of an Arrow array, one at a time."""
    for x in column:
        yield x.as_py()


def text_or_empty(col: str = "text"):
    """A null text counts as an empty one."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def same_key(a: DataFrame, b: DataFrame, pairs: list[tuple[str, str]]):
    """Null-safe equality of several columns: nulls form a key of their own."""
    cond = F.lit(True)
    for x, y in pairs:
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


def sha(col):
    """Lowercase hex of SHA-256 over the UTF-8 bytes."""
    return F.sha2(col.cast("binary"), 256)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def packed(df: DataFrame) -> DataFrame:
    """All columns in one struct ``_row``, so that no name can clash with what
    an operator adds beside it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def unpacked(df: DataFrame, columns: list[str], *more, **changed) -> DataFrame:
    """The columns of ``_row`` again, some ``changed``, and ``more``."""
    return df.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in columns], *more)
