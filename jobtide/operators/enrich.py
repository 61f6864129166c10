"""From stored movements to the integrated table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.codes import DEFAULT_CODEBOOK, NOT_IDENTIFIED, NOT_INFORMED, Codebook
from jobtide.functions.lookup import decode
from jobtide.functions.periods import parse_month
from jobtide.functions.text import municipality_key, strip

# Names of the municipality, and the columns that hold them tidied where both are kept.
TIDY = {"nome_municipio": "nome_municipio_limpo", "regiao": "regiao_limpa"}

# Brings a municipality code to the form it is joined on.
Key = Callable[[Column], Column]


def add_period(movements: DataFrame) -> DataFrame:
    """``ano_mes`` as a date, with its year and month; a date column is kept as it is."""
    if dict(movements.dtypes)["ano_mes"] != "date":
        movements = movements.withColumn("ano_mes", parse_month(F.col("ano_mes")))
    return movements.withColumns({"ano": F.year("ano_mes"), "mes": F.month("ano_mes")})


def add_balance(movements: DataFrame) -> DataFrame:
    """``saldo``: the movement code, +1 for a hiring and -1 for a dismissal."""
    return movements.withColumn("saldo", F.col("tipo_mov"))


def decode_labels(movements: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Code columns as labels. Columns the table does not have are left out."""
    tables = {
        "sexo": (book.sex, NOT_IDENTIFIED),
        "raca_cor": (book.race, NOT_IDENTIFIED),
        "escolaridade": (book.schooling, NOT_INFORMED),
    }
    labels = {
        name: decode(F.col(name), codes, default)
        for name, (codes, default) in tables.items()
        if name in movements.columns
    }
    if "secao_cnae" in movements.columns:
        # Most codes are clean; only the others pay for trimming.
        section = F.col("secao_cnae")
        trimmed = strip(F.upper(section))
        labels["setor"] = F.coalesce(
            decode(section, book.sector), decode(trimmed, book.sector), F.lit(NOT_INFORMED)
        )
    return movements.withColumns(labels)


def join_municipality(
    fact: DataFrame,
    municipalities: DataFrame,
    key: Key = municipality_key,
) -> DataFrame:
    """Left join to the municipality table; unmatched rows keep NULLs.

    ``key`` brings both codes to one form. There is no broadcast hint: the
    planner broadcasts the dimension while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and beyond that sorts and merges,
    with AQE splitting a municipality that holds a large share of the rows. Names
    that were tidied beside the original ones (``TIDY``) are carried along.
    """
    dimension = municipalities.select(
        key(F.col("cod_municipio")).alias("_codigo"),
        "nome_municipio",
        F.col("sigla_uf").alias("sigla_uf_ibge"),
        "nome_uf",
        "regiao",
        *[name for name in TIDY.values() if name in municipalities.columns],
    )
    return (
        fact.withColumn("_codigo", key(F.col("cod_municipio")))
        .join(dimension, "_codigo", "left")
        .drop("_codigo")
    )


def integrate(
    movements: DataFrame,
    municipalities: DataFrame,
    book: Codebook = DEFAULT_CODEBOOK,
    key: Key = municipality_key,
) -> DataFrame:
    """Stored movements as the integrated table: dates, labels, municipality.

    They are joined as they are, and decoded behind a shuffle: the codes are shorter than their labels.
    """

    def decoded(rows: DataFrame) -> DataFrame:
        return decode_labels(add_balance(add_period(rows)), book)

    own = decoded(movements).columns
    integrated = decoded(join_municipality(movements, municipalities, key))
    return integrated.select(*own, *[name for name in integrated.columns if name not in own])
