"""Stored Parquet tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobtide.schemas import ATTEMPT, BAD, BATCH, GOOD, MALFORMED, ORIGIN, PATH, STATE, STORED_MOVEMENTS
from jobtide.sources.files import exists
from jobtide.sources.ledger import ledger_path, read_ledger, versions

# Files that a task keeps open at once; beyond that Spark sorts the rest of the task's rows.
OPEN_FILES = 16
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ran to its end: its success marker is there."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def write_once(table: DataFrame, path: str, partition_by: str | None = None) -> bool:
    """Write ``table`` unless a complete copy is there; a torn copy is replaced."""
    if is_complete(table.sparkSession, path):
        return False
    if partition_by:
        write_gathered(table, path, partition_by)
    else:
        table.write.mode("overwrite").parquet(path)
    return True


def write_gathered(
    fact: DataFrame, path: str, *partition_by: str, keep_others: bool = False
) -> None:
    """Partitioned Parquet with even files; ``keep_others`` leaves other partitions alone.

    The rebalance hint shuffles by the partition columns, then lets AQE join
    small outputs and split a large one, so a year that holds a third of all
    rows is still written by many tasks.
    """
    (
        fact.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Let tasks write several partitions side by side, without sorting their rows by partition first."""
    own = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, str(OPEN_FILES))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(WRITERS)
        else:
            spark.conf.set(WRITERS, own)


def write_fact(fact: DataFrame, path: str, *partition_by: str) -> None:
    """Partitioned Parquet, each row written by the task that has it, without a shuffle or a sort.

    For rows that already lie in tasks of even size, as those of a scan or a join do: a task
    writes a file for each partition it has rows of, so large partitions are written by many tasks.
    """
    with _open_files(fact.sparkSession):
        fact.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_versions(spark: SparkSession, path: str, ledger: DataFrame | None = None) -> DataFrame:
    """All committed lines of the movements, with their commit, file and state; columns a file lacks are NULL.

    Folders that no commit names, left by a run that stopped, are not read.
    """
    ledger = read_ledger(spark, ledger_path(path)) if ledger is None else ledger
    # A row for each commit.
    held = ledger.where(F.col("registros") + F.col("malformados") > 0).select(BATCH, ATTEMPT).distinct()
    folders = sorted(f"{path}/{BATCH}={row[0]}/{ATTEMPT}={row[1]}" for row in held.collect())
    if not folders:
        return spark.createDataFrame([], STORED_MOVEMENTS)
    return spark.read.schema(STORED_MOVEMENTS).option("basePath", path).parquet(*folders)


def read_movements(spark: SparkSession, path: str) -> DataFrame:
    """The movements of the current version of every file, with their commit and file."""
    ledger = read_ledger(spark, ledger_path(path))
    good = read_versions(spark, path, ledger).where(F.col(STATE) == GOOD).drop(ATTEMPT, STATE, MALFORMED)
    return without_retired(good, retired(ledger))


def read_malformed(spark: SparkSession, path: str) -> DataFrame:
    """(caminho, lote, linha_malformada): the lines of all commits that did not fit their header."""
    ledger = read_ledger(spark, ledger_path(path))
    bad = read_versions(spark, path, ledger).where(F.col(STATE) == BAD)
    return bad.join(ledger.select(PATH, ORIGIN, BATCH), [ORIGIN, BATCH]).select(PATH, BATCH, MALFORMED)


def retired(ledger: DataFrame, commit: int | None = None) -> list[tuple[int, str]]:
    """(commit, file) of the versions that were replaced or withdrawn, by one commit or by any.

    The list has an entry for each republished file.
    """
    out = F.col("retirado_em")
    gone = versions(ledger).where(out.isNotNull() if commit is None else out == commit)
    return sorted((row[0], row[1]) for row in gone.select(BATCH, ORIGIN).collect())


def without_retired(rows: DataFrame, gone: list[tuple[int, str]]) -> DataFrame:
    """Rows of the versions that still count. The list has one entry for each republished file."""
    if not gone:
        return rows
    listed = rows.sparkSession.createDataFrame(gone, f"{BATCH} int, {ORIGIN} string")
    return rows.join(F.broadcast(listed), [BATCH, ORIGIN], "left_anti")


def combine_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several Parquet parts as one dataset, columns matched by name."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def file_counts(table: DataFrame, part: str | None = None, *more: Column) -> DataFrame:
    """Records per file of a file scan, with the running total in name order.

    ``part`` is a pattern whose first group names what files are counted together;
    ``more`` are further sums.
    """
    path = F.col("_metadata.file_path")
    name = F.regexp_extract(path, part, 1) if part else path
    per_file = table.groupBy(name.alias("arquivo")).agg(F.count("*").alias("registros"), *more)
    return running_total(per_file, "arquivo")


def running_total(counts: DataFrame, order: str) -> DataFrame:
    """Adds the running sum of ``registros``. For tables of counts, not for facts."""
    upto_here = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("acumulado", F.sum("registros").over(upto_here))
