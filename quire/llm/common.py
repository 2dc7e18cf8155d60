"""Helpers that several corpus operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch handed to Python, so that a batch of long texts stays small.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower Spark's default Arrow batch of 10,000 rows, for as long as the session has that default; a value that the user
    chose stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Where the session names none, a local one is made, but only for a local master:
    on a cluster every executor would write to its own disk."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='quire-')}"
        spark.conf.set("spark.checkpoint.dir", where)
        atexit.register(shutil.rmtree, where.removeprefix("file://"), ignore_errors=True)
    return where


def stable(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: later plans neither recompute them nor depend on executors' disks.

    The shuffle files of the writing job go when it ends. The table goes with ``discard`` once its last reader is done, and
    a local one at the latest when the driver's Python ends; in another store what is left stays for its own expiry."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    if path.startswith("file://"):
        atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    tidy = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(tidy, "false")
    spark.conf.set(tidy, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(tidy, before)
    out = spark.read.schema(schema).parquet(path)
    out._quire_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that ``stable`` returned and that nothing reads any more; anything else is left alone."""
    for df in tables:
        path = getattr(df, "_quire_path", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """Rows with a number each, ``name``, which every later read finds the same: they are written first."""
    return stable(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def fits_broadcast(rows: int, bytes_per_row: int, limit: int = 16 << 20) -> bool:
    return rows * bytes_per_row <= limit


def bounded(df: DataFrame, rows: int, bytes_per_row: int, limit: int = 16 << 20) -> DataFrame:
    """Broadcast a side only if its counted size is below the limit; otherwise Spark shuffles it."""
    return F.broadcast(df) if fits_broadcast(rows, bytes_per_row, limit) else df


#: The contract's white space: space and the control characters 09 to 0D.
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words without making them: each run of word characters becomes one mark."""
    return F.length(F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_SPACE, "x"), SPACES, "")).cast("long")
