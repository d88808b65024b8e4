"""Sinks that say when they are whole: two tables from one stream, versions behind a pointer, files in global order."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _file_system(spark: SparkSession, path: str):
    """Hadoop's path and the file system it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    where, files = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


# --- several tables from one stream -------------------------------------------------------------------------------


def write_tables(stream: DataFrame, path: str, checkpoint: str, tables: dict[str, Callable[[DataFrame], DataFrame]], **trigger) -> StreamingQuery:
    """Starts a query that writes each micro-batch to several tables, ``path/name``, from one reading of the batch.

    Each table holds a folder for each batch, which a repeated batch replaces, and a batch counts once all its tables are written: ``path/done``
    says which. A query that is killed anywhere and started again with its ``checkpoint`` finds each row once (see ``read_table``).
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, of in tables.items():
                of(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
            where, files = _file_system(batch.sparkSession, f"{path}/done/{number:012d}")
            files.create(where, True).close()
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """The rows of one of the tables of ``write_tables``, of whole batches only, with the number of their ``batch``."""
    done = [int(n) for n in _names(spark, f"{path}/done")]
    if not done:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    rows = spark.read.schema(f"{schema}, batch int").parquet(f"{path}/{name}")
    # Batches are done in order, so that the last number says all.
    return rows.filter(F.col("batch") <= max(done))


# --- versions behind a pointer ------------------------------------------------------------------------------------


def write_version(df: DataFrame, path: str) -> int:
    """Writes ``df`` as the next version of the table at ``path`` and makes it the current one; returns its number.

    ``df`` may read the table itself: no file of an earlier version is touched. A version counts once its pointer exists, which is created only if nobody
    else has taken the number; of two writers at once the later one fails with what it wrote unseen.
    """
    spark = df.sparkSession
    number = (current_version(spark, path) or 0) + 1
    folder = f"versions/{number:08d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    where, files = _file_system(spark, f"{path}/current/{number:08d}")
    out = files.create(where, False)
    out.write(bytearray(folder.encode()))
    out.close()
    return number


def current_version(spark: SparkSession, path: str) -> int | None:
    pointers = _names(spark, f"{path}/current")
    return int(pointers[-1]) if pointers else None


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The current version of a table, or an earlier one."""
    number = current_version(spark, path) if number is None else number
    if number is None:
        raise FileNotFoundError(f"{path} has no version")
    folder = spark.read.text(f"{path}/current/{number:08d}").first()[0]
    return spark.read.parquet(f"{path}/{folder}")


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all but the last ``keep`` versions, pointers first; nobody may read them any more."""
    for name in _names(spark, f"{path}/current")[: -max(1, keep)]:
        folder = spark.read.text(f"{path}/current/{name}").first()[0]
        for old in (f"{path}/current/{name}", f"{path}/{folder}"):
            where, files = _file_system(spark, old)
            files.delete(where, True)


# --- global order -------------------------------------------------------------------------------------------------


def write_ordered(df: DataFrame, path: str, order: list[str | Column], files: int) -> None:
    """Writes ``df`` so that its files, read by name, give its rows in order: ranges of the order from sampled bounds, sorted within.

    Give the full key, so that ties are in order too. No task sorts more than its range.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    df.repartitionByRange(files, *columns).sortWithinPartitions(*columns).write.mode("error").parquet(path)


def ordered_files(spark: SparkSession, path: str) -> list[str]:
    """The files of ``write_ordered`` by name."""
    return [f"{path}/{n}" for n in _names(spark, path) if n.startswith("part-")]
