"""Numeric codes and period columns derived from cleaned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.codes import DEFAULT_CODEBOOK, FINE_PHASES, Codebook
from jobtide.functions.lookup import decode
from jobtide.functions.periods import phase, season, year_month_number


def derive(cleaned: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Adds category codes, season, historical phase and ``yyyyMM`` number."""
    codes = {
        "escolaridade": ("escolaridade_cod", book.schooling_code, -1),
        "regiao": ("regiao_cod_num", book.region_code, 0),
        "sexo": ("sexo_cod", book.sex_code, -1),
    }
    year, month = F.col("ano"), F.col("mes")
    columns = {
        target: decode(F.col(source), table, default)
        for source, (target, table, default) in codes.items()
        if source in cleaned.columns
    }
    columns["periodo_sazonal"] = season(month)
    columns["fase_pandemia"] = phase(year, month, FINE_PHASES, book.first_year)
    columns["ano_mes_int"] = year_month_number(year, month)
    return cleaned.withColumns(columns)
