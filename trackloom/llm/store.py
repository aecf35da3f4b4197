"""Where operators keep intermediate results: only in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Frees a finished query's shuffle files at once; Spark versions without it leave them to their cleaner.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TABLE = "_settled_at"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where none is set and all runs on this machine."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d is None:
        d = spark.sparkContext.getCheckpointDir()
    if d is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines of the cluster share")
        d = "file://" + tempfile.mkdtemp(prefix="trackloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Sets ``key`` for a while, then restores what the caller had."""
    had = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if had is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, had)


def settle(df: DataFrame, *done: DataFrame) -> DataFrame:
    """Runs ``df`` once into a Parquet table in the shared folder and reads it back: lineage ends there.

    The table outlives a lost executor, and later readers get column pruning and
    pushdown.  The shuffle files of the run are freed with it.  ``done`` are settled
    tables that nothing reads any more; they are removed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/trackloom-{uuid.uuid4().hex}"
    with setting(spark, _CLEAN, "true"):
        df.write.parquet(path)
    discard(*done)
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _TABLE, path)
    return out


def discard(*done: DataFrame) -> None:
    """Removes settled tables that nothing reads any more."""
    for df in done:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(getattr(df, _TABLE))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def join_dealt(rows: DataFrame, counts: DataFrame, key: str | list[str], spread: str, least: int = 1024, share: int = 10_000) -> DataFrame:
    """``rows`` joined with ``counts`` on ``key``, hot keys dealt over several tasks.

    ``counts`` has one row a key, with its number of rows in ``n``, which is left out of the result.  Keys that hold more
    than ``least`` rows and one in ``share`` of all, of which there are at most ``share``, are broadcast with the number of
    tasks they are dealt over; ``spread`` is a column of ``rows`` whose hash deals them.
    """
    bar = max(least, (counts.agg(F.sum("n")).first()[0] or 0) // share)
    times = F.ceil(F.col("n") / bar).cast("int")
    keys = [key] if isinstance(key, str) else key
    hot = counts.where(F.col("n") > bar).select(*keys, times.alias("_times"))
    rows = rows.join(F.broadcast(hot), keys, "left").withColumn("_deal", F.pmod(F.xxhash64(spread), F.coalesce("_times", F.lit(1))).cast("int")).drop("_times")
    dealt = counts.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.greatest(times, F.lit(1)) - 1))).drop("n")
    return rows.join(dealt, [*keys, "_deal"]).drop("_deal")


def versions(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long column ``name`` that tells the texts of a repeated doc_id apart; 0 for ids of one row, and for null ids."""
    again = free_name(docs, "again")
    twice = settle(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(again)))
    if twice.isEmpty():
        return docs.withColumn(name, F.lit(0).cast("long"))
    own = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit((1 << 24) - 1)) + 1
    joined = docs.join(twice, F.col("doc_id") == F.col(again), "left")
    return joined.withColumn(name, F.when(F.col(again).isNotNull(), own).otherwise(F.lit(0)).cast("long")).select(*docs.columns, name)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def small_batches(spark: SparkSession) -> None:
    """Arrow batches that stay small when texts are long; for the session, since results are computed after the call."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    except Exception as e:  # noqa: BLE001  the setting is newer than the others
        if "CANNOT_MODIFY" not in str(e) and "maxBytesPerBatch" not in str(e):
            raise
