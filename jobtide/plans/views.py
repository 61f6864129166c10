"""The tables behind the four report pages.

Each function takes balance tables and the reader's choices and returns one
DataFrame per chart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.codes import (
    COARSE_PHASES,
    DEFAULT_CODEBOOK,
    FINE_PHASES,
    MONTHS,
    Codebook,
    phase_order,
)
from jobtide.functions.lookup import rank_in
from jobtide.functions.numbers import is_gain, signed_percent, signed_thousands
from jobtide.functions.periods import month_label, month_name, phase
from jobtide.functions.text import place_label
from jobtide.operators.aggregate import balance_by
from jobtide.operators.filters import in_regions, in_sectors, in_years, uf_regions
from jobtide.operators.ranking import order_by_category, top_k
from jobtide.operators.series import indicators
from jobtide.operators.shape import domains, pivot_balance

PLACE = ["nome_municipio", "sigla_uf", "regiao"]


def with_sign(table: DataFrame) -> DataFrame:
    """Adds the sign class that colours a bar."""
    return table.withColumn("ganho", is_gain(F.col("saldo")))


def headline(monthly: DataFrame, totals: dict[str, list[int] | None]) -> DataFrame:
    """Indicator cards with their printed value."""
    return indicators(monthly, totals).withColumn("rotulo", signed_thousands(F.col("saldo")))


def overview_indicators(monthly: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Whole balance, first and last year, best and worst month."""
    return headline(
        monthly, {"saldo_total": None, "saldo_inicial": [first_year], "saldo_final": [last_year]}
    )


def ufs(by_uf: DataFrame) -> DataFrame:
    """Balance per UF over all years."""
    return with_sign(balance_by(by_uf, "sigla_uf"))


def sectors(by_sector: DataFrame) -> DataFrame:
    """Balance per sector over all years, ascending."""
    return with_sign(balance_by(by_sector, "setor")).orderBy("saldo", "setor")


def phases(by_phase: DataFrame) -> DataFrame:
    """Balance per historical phase, in phase order."""
    totals = with_sign(balance_by(by_phase, "fase_pandemia"))
    return order_by_category(totals, "fase_pandemia", phase_order(FINE_PHASES))


def uf_ranking(
    by_uf: DataFrame,
    region_ufs: DataFrame,
    years: tuple[int | None, int | None] = (None, None),
    regions: list[str] | None = None,
) -> DataFrame:
    """Balance per UF within years and regions, ascending."""
    chosen = in_regions(in_years(by_uf, *years), regions, region_ufs)
    return ufs(chosen).orderBy("saldo", "sigla_uf")


def municipality_ranking(
    by_municipality: DataFrame,
    region_ufs: DataFrame,
    years: tuple[int | None, int | None] = (None, None),
    regions: list[str] | None = None,
    uf: str | None = None,
    k: int = 10,
    largest: bool = True,
) -> DataFrame:
    """Top or bottom municipalities. A chosen UF takes precedence over the regions."""
    chosen = in_years(by_municipality, *years)
    if uf:
        chosen = chosen.where(F.col("sigla_uf") == uf)
    else:
        chosen = in_regions(chosen, regions, region_ufs)
    ranked = top_k(balance_by(chosen, *PLACE), k, PLACE, largest)
    label = place_label(F.col("nome_municipio"), F.col("sigla_uf"))
    display = F.asc("saldo") if largest else F.desc("saldo")
    return ranked.withColumn("rotulo", label).orderBy(display, *PLACE)


def sector_evolution(
    by_sector: DataFrame,
    years: tuple[int | None, int | None] = (None, None),
    chosen: list[str] | None = None,
) -> DataFrame:
    """Yearly balance of the chosen sectors."""
    return in_sectors(in_years(by_sector, *years), chosen).orderBy("setor", "ano")


def sector_growth(grown: DataFrame, chosen: list[str] | None = None) -> DataFrame:
    """Percent growth of the chosen sectors with its label, ascending."""
    change = F.col("variacao_pct")
    return (
        in_sectors(grown, chosen)
        .withColumns({"rotulo": signed_percent(change), "ganho": is_gain(change)})
        .orderBy("variacao_pct", "setor")
    )


def seasonality(
    by_month: DataFrame, years: tuple[int | None, int | None] = (None, None)
) -> DataFrame:
    """Year by month name."""
    named = in_years(by_month, *years).withColumn("mes_nome", month_name(F.col("mes")))
    return pivot_balance(named, "ano", "mes_nome", MONTHS).orderBy("ano")


def crisis_indicators(
    monthly: DataFrame, crisis_years: list[int], later_years: list[int]
) -> DataFrame:
    """Balance in and after the crisis, their sum, best and worst month."""
    return headline(
        monthly,
        {
            "saldo_pandemia": crisis_years,
            "saldo_pos_pandemia": later_years,
            "saldo_liquido": crisis_years + later_years,
        },
    )


def months_of(monthly: DataFrame, years: list[int]) -> DataFrame:
    """Monthly balance of a set of years."""
    chosen = monthly.where(F.col("ano").isin(years))
    label = month_label(F.col("ano"), F.col("mes"))
    return with_sign(chosen.withColumn("rotulo", label)).orderBy("ano_mes")


def sector_phase_matrix(by_phase: DataFrame) -> DataFrame:
    """Sector by historical phase."""
    return pivot_balance(by_phase, "setor", "fase_pandemia", phase_order(FINE_PHASES)).orderBy("setor")


def sector_years(by_sector: DataFrame, years: list[int]) -> DataFrame:
    """Sector balance in each of a few years, ascending within a year."""
    return by_sector.where(F.col("ano").isin(years)).orderBy("ano", "saldo", "setor")


def region_phases(by_uf: DataFrame, region_ufs: DataFrame, first_year: int) -> DataFrame:
    """Balance per region and coarse phase, phases in order."""
    placed = by_uf.join(uf_regions(region_ufs), "sigla_uf", "left")
    coarse = phase(F.col("ano"), F.lit(None).cast("int"), COARSE_PHASES, first_year)
    totals = balance_by(placed.withColumn("fase", coarse), "regiao", "fase")
    return totals.orderBy(rank_in(F.col("fase"), phase_order(COARSE_PHASES)), "regiao")


def region_table(spark: SparkSession, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """(regiao, ufs) from the code tables, as the regional and the crisis page take it."""
    return spark.createDataFrame(list(book.region_ufs.items()), "regiao string, ufs array<string>")


def regional_choices(by_uf: DataFrame, region_ufs: DataFrame) -> DataFrame:
    """What the regional page lets its reader choose: years, regions and UFs, with the extremes."""
    placed = by_uf.join(uf_regions(region_ufs), "sigla_uf", "left")
    return domains(placed, ["ano", "regiao", "sigla_uf"])


def sectoral_choices(by_sector: DataFrame) -> DataFrame:
    """What the sector page lets its reader choose: years and sectors, with the extremes."""
    return domains(by_sector, ["ano", "setor"])


def overview_page(
    monthly: DataFrame,
    by_uf: DataFrame,
    by_sector: DataFrame,
    by_phase: DataFrame,
    first_year: int = 2020,
    last_year: int = 2026,
) -> dict[str, DataFrame]:
    """All tables of the overview page."""
    return {
        "indicadores": overview_indicators(monthly, first_year, last_year),
        "tendencia": with_sign(monthly).orderBy("ano_mes"),
        "ufs": ufs(by_uf),
        "setores": sectors(by_sector),
        "fases": phases(by_phase),
    }


def regional_page(
    by_uf: DataFrame,
    by_municipality: DataFrame,
    region_ufs: DataFrame,
    years: tuple[int | None, int | None] = (None, None),
    regions: list[str] | None = None,
    uf: str | None = None,
) -> dict[str, DataFrame]:
    """All tables of the regional page. The chosen UF narrows only the municipalities."""
    choice = {"region_ufs": region_ufs, "years": years, "regions": regions}
    return {
        "escolhas": regional_choices(by_uf, region_ufs),
        "ranking_ufs": uf_ranking(by_uf, **choice),
        "maiores": municipality_ranking(by_municipality, **choice, uf=uf),
        "menores": municipality_ranking(by_municipality, **choice, uf=uf, largest=False),
    }


def sectoral_page(
    by_sector: DataFrame,
    grown: DataFrame,
    by_month: DataFrame,
    years: tuple[int | None, int | None] = (None, None),
    chosen: list[str] | None = None,
) -> dict[str, DataFrame]:
    """All tables of the sector page."""
    return {
        "escolhas": sectoral_choices(by_sector),
        "evolucao": sector_evolution(by_sector, years, chosen),
        "crescimento": sector_growth(grown, chosen),
        "sazonalidade": seasonality(by_month, years),
    }


def crisis_page(
    monthly: DataFrame,
    by_phase: DataFrame,
    by_sector: DataFrame,
    by_uf: DataFrame,
    region_ufs: DataFrame,
    first_year: int = 2020,
    last_year: int = 2026,
) -> dict[str, DataFrame]:
    """All tables of the crisis-and-recovery page."""
    later = list(range(first_year + 2, last_year + 1))
    return {
        "indicadores": crisis_indicators(monthly, [first_year, first_year + 1], later),
        "zoom": months_of(monthly, list(range(first_year - 1, first_year + 3))),
        "setor_fase": sector_phase_matrix(by_phase),
        "setor_anos": sector_years(by_sector, list(range(first_year, first_year + 3))),
        "regiao_fase": region_phases(by_uf, region_ufs, first_year),
    }
