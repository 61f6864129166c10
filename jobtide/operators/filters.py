"""The filters a reader of the reports can set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_years(table: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Years from ``first`` to ``last``, both included; ``None`` leaves an end open."""
    if first is not None:
        table = table.where(F.col("ano") >= first)
    if last is not None:
        table = table.where(F.col("ano") <= last)
    return table


def in_sectors(table: DataFrame, sectors: list[str] | None) -> DataFrame:
    """Rows of the given sectors; no selection means all."""
    return table.where(F.col("setor").isin(sectors)) if sectors else table


def uf_regions(region_ufs: DataFrame) -> DataFrame:
    """(region, list of UFs) rows as one (UF, region) row per UF."""
    return region_ufs.select(F.explode("ufs").alias("sigla_uf"), "regiao")


def in_regions(table: DataFrame, regions: list[str] | None, region_ufs: DataFrame) -> DataFrame:
    """Rows of the UFs in the given regions; no selection means all.

    A region that is not in the table adds no UF.
    """
    if not regions:
        return table
    chosen = uf_regions(region_ufs.where(F.col("regiao").isin(regions))).select("sigla_uf")
    return table.join(chosen, "sigla_uf", "left_semi")
