"""Balance sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUBE_KEYS = ("ano", "mes", "nome_municipio", "sigla_uf", "regiao", "fase_pandemia", "setor")


def balance_by(table: DataFrame, *keys: str) -> DataFrame:
    """Sum of ``saldo`` per key.

    Rows with a NULL key are left out and a group of NULLs sums to 0. The sum is
    combined within each task before the shuffle, so a key with a large share of
    the rows costs one row per task.
    """
    for key in keys:
        if table.schema[key].nullable:
            table = table.where(F.col(key).isNotNull())
    return table.groupBy(*keys).agg(
        F.coalesce(F.sum("saldo"), F.lit(0)).cast("bigint").alias("saldo")
    )


def balance_by_month(table: DataFrame) -> DataFrame:
    """Sum of ``saldo`` per month. Year and month follow from the date, so only it is grouped."""
    sums = balance_by(table, "ano_mes")
    return sums.select(
        F.year("ano_mes").alias("ano"), F.month("ano_mes").alias("mes"), "ano_mes", "saldo"
    )


def base_cube(table: DataFrame, *keys: str) -> DataFrame:
    """Finest sums, NULL keys kept, from which coarser sums are rolled up."""
    return table.groupBy(*(keys or CUBE_KEYS)).agg(F.sum("saldo").cast("bigint").alias("saldo"))


def merge_cubes(cubes: DataFrame, *keys: str) -> DataFrame:
    """Sums and row counts of several cubes with ``registros``, as one.

    Cubes may take out what others have put in. A cell that changes neither is left out; one that
    trades rows for as many others still changes the sum.
    """
    return (
        cubes.groupBy(*(keys or CUBE_KEYS))
        .agg(F.sum("saldo").cast("bigint").alias("saldo"), F.sum("registros").cast("bigint").alias("registros"))
        .where("registros <> 0 OR saldo <> 0")
    )


def rollups(cube: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """Several roll-ups of one cube in one pass, labelled in column ``tabela``.

    Each row carries the keys of its own roll-up and NULL for the others. Cubes with ``registros``
    may take out what others have put in; a group without rows is left out.
    """
    keys = list(dict.fromkeys(key for names in sets.values() for key in names))
    labels = [
        F.when(
            reduce(lambda a, b: a & b, [F.grouping(k) == int(k not in names) for k in keys]), label
        )
        for label, names in sets.items()
    ]
    counted = "registros" in cube.columns
    key_given = [(F.grouping(k) == 1) | F.col(k).isNotNull() for k in keys]
    summed = cube.groupingSets([list(names) for names in sets.values()], *keys).agg(
        F.coalesce(*labels).alias("tabela"),
        reduce(lambda a, b: a & b, key_given).alias("_completa"),
        F.coalesce(F.sum("saldo"), F.lit(0)).cast("bigint").alias("saldo"),
        (F.sum("registros") if counted else F.lit(1)).alias("_registros"),
    )
    return summed.where("_completa AND _registros <> 0").select("tabela", *keys, "saldo")


def outer_balance(base: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Full outer join of two balance tables; a side without the key counts 0."""
    left = base.select(key, F.col("saldo").alias("saldo_base"))
    right = target.select(key, F.col("saldo").alias("saldo_alvo"))
    return left.join(right, key, "full").fillna(0, ["saldo_base", "saldo_alvo"])
