"""Numbers that Parquet footers know, without reading a row.

These scans go through the second version of the Parquet source, which answers counts, least and
largest values from the footers: a row for each file, not for each record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    # All but Parquet stay with the first version.
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads Parquet through its footers where it can."""
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    return session


def footer_counts(
    spark: SparkSession, paths: list[str], *by: str, schema: str | None = None, base: str | None = None
) -> DataFrame:
    """`registros` of the Parquet files below some folders, for each value of partition columns `by`.

    An empty folder needs a schema; without `by` it gives one row with 0.
    """
    reader = footer_session(spark).read
    if schema:
        reader = reader.schema(schema)
    if base:
        reader = reader.option("basePath", base)
    table = reader.parquet(*paths)
    count = F.count("*").alias("registros")
    return table.groupBy(*by).agg(count) if by else table.agg(count)


def footer_range(spark: SparkSession, path: str, column: str) -> DataFrame:
    """`registros`, `minimo` and `maximo` of a number or date column of a Parquet table.

    Every file must hold a value of the column, as it does for keys; for a column that is NULL throughout a
    file, footers have no range.
    """
    table = footer_session(spark).read.parquet(path)
    return table.agg(
        F.count("*").alias("registros"), F.min(column).alias("minimo"), F.max(column).alias("maximo")
    )
