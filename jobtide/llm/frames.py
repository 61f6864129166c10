"""Helpers shared by the operators: column picking, stored intermediate tables, text coercion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.session import shared_folder


def place(df: DataFrame, name: str) -> int | None:
    """Where a column is: the first exact match, else the first match without regard to case, else None."""
    same = [i for i, c in enumerate(df.columns) if c == name]
    close = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    return (same or close or [None])[0]


def by_place(df: DataFrame) -> DataFrame:
    """`df` with its columns named `_0`, `_1` ..., so that names that repeat, clash or hold dots do no harm.

    `toDF(*names)` gives the names back.
    """
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast to the given types.

    Columns are found by `place`, so further columns that repeat a name, or differ
    from it in case only, do no harm.
    """
    plain = by_place(df)
    out = []
    for name, kind in kinds.items():
        at = place(df, name)
        if at is None:
            raise ValueError(f"no column {name} among {df.columns}")
        out.append(plain[f"_{at}"].cast(kind).alias(name))
    return plain.select(*out)


def stored(df: DataFrame, label: str, *keys: str) -> DataFrame:
    """`df` written as Parquet below the shared folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    writer = df.write.mode("overwrite")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(value: str | None) -> bytes:
    """A text's bytes; null is empty."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """`df` stored in `buckets` buckets of `key`, so that grouping by the key shuffles it no more.

    The catalog has it only while it is written and opened; its files go when the application ends.
    """
    spark = df.sparkSession
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .option("path", shared_folder(spark, label))
        .mode("overwrite")
        .saveAsTable(name)
    )
    opened = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return opened
