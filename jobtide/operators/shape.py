"""Pivots and value domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pivot_balance(table: DataFrame, index: str, column: str, values: list[str]) -> DataFrame:
    """Balance sums with one column per listed value; an absent cell is NULL.

    The list fixes the width and the order, and spares a pass to find the values.
    """
    return (
        table.dropna(subset=[index, column])
        .groupBy(index)
        .pivot(column, values)
        .agg(F.sum("saldo").cast("bigint"))
    )


def domains(table: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column with the column's smallest and largest value.

    Values are ordered in the column's own type and written as text after that. The
    distinct combinations are found first, so the fact is read once and only those
    few rows are repeated per column.
    """
    combinations = table.select(*columns).distinct()
    owner = F.coalesce(*[F.when(F.grouping(name) == 0, name) for name in columns])
    domain = Window.partitionBy("dominio")

    def as_text(extreme):
        return F.coalesce(*[extreme(F.col(name)).over(domain).cast("string") for name in columns])

    return (
        combinations.groupingSets([[name] for name in columns], *columns)
        .agg(owner.alias("dominio"))
        .where(F.coalesce(*[F.col(name).cast("string") for name in columns]).isNotNull())
        .select(
            "dominio",
            F.coalesce(*[F.col(name).cast("string") for name in columns]).alias("valor"),
            as_text(F.min).alias("minimo"),
            as_text(F.max).alias("maximo"),
            *columns,
        )
        .orderBy("dominio", *columns)
        .select("dominio", "valor", "minimo", "maximo")
    )
