"""The municipality dimension, from nested JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.text import municipality_key, strip, title_case
from jobtide.operators.enrich import TIDY
from jobtide.schemas import MUNICIPALITY_JSON


def flatten(nested: DataFrame, key: Callable[[Column], Column] = municipality_key) -> DataFrame:
    """Nested municipality objects as flat rows; a missing parent gives ``""``.

    ``key`` brings the code to its stored form; the real codes have six digits.
    """

    def text(path: str):
        return F.coalesce(F.col(path), F.lit(""))

    uf = "microrregiao.mesorregiao.UF"
    return nested.select(
        key(F.col("id")).alias("cod_municipio"),
        text("nome").alias("nome_municipio"),
        text(f"{uf}.sigla").alias("sigla_uf"),
        text(f"{uf}.nome").alias("nome_uf"),
        text(f"{uf}.regiao.nome").alias("regiao"),
    )


def read_municipalities(
    spark: SparkSession, path: str, key: Callable[[Column], Column] = municipality_key
) -> DataFrame:
    """Municipalities from a JSON array file."""
    return flatten(spark.read.schema(MUNICIPALITY_JSON).json(path, multiLine=True), key)


def tidy(municipalities: DataFrame) -> DataFrame:
    """Trimmed, title-cased names.

    The cleaned fact shows these names. Tidying the dimension gives the same
    text at the cost of one row per municipality instead of one per movement.
    """
    return municipalities.withColumns(
        {name: title_case(strip(F.col(name))) for name in ("nome_municipio", "regiao")}
    )


def with_tidy(municipalities: DataFrame) -> DataFrame:
    """The municipalities with tidied names beside the original ones."""
    return municipalities.withColumns(
        {tidied: title_case(strip(F.col(name))) for name, tidied in TIDY.items()}
    )


def duplicate_codes(municipalities: DataFrame) -> DataFrame:
    """Codes that occur more than once and so would multiply fact rows in a join."""
    return municipalities.groupBy("cod_municipio").count().where("count > 1")
