"""Which monthly files exist, and which are still to be ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest(names: DataFrame, token: str, suffix: str = ".7Z") -> DataFrame:
    """Movement archives among file ``nome``s, with their stem and stored name.

    A name counts if it contains ``token`` and ends in ``suffix``, in any case.
    """
    upper = F.upper("nome")
    stem = F.replace(upper, F.lit(suffix.upper()), F.lit(""))
    stored = F.replace(upper, F.lit(suffix.upper()), F.lit(".parquet"))
    return names.where(
        upper.contains(token.upper()) & upper.endswith(suffix.upper())
    ).withColumns({"stem": stem, "arquivo_saida": stored})


def missing_files(available: DataFrame, present: DataFrame, on: str | list[str] = "stem") -> DataFrame:
    """Rows of ``available`` with no match in ``present``."""
    return available.join(present, on, "left_anti")
