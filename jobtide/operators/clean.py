"""Row validity, the account of rejected rows, and the null profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.codes import DEFAULT_CODEBOOK, MOVEMENT, Codebook
from jobtide.functions.lookup import decode
from jobtide.functions.numbers import is_missing
from jobtide.functions.periods import quarter_label, year_quarter_label
from jobtide.functions.text import strip, title_case
from jobtide.operators.enrich import TIDY

RULES = ("sem_uf", "uf_invalida", "mov_invalida")


def _has_uf(uf: Column) -> Column:
    return uf.isNotNull() & (uf != "")


def _official_uf(integrated: DataFrame) -> DataFrame:
    """The municipality's UF replaces the recorded one, also where it is NULL."""
    if "sigla_uf_ibge" not in integrated.columns:
        return integrated
    return integrated.withColumn("sigla_uf", F.col("sigla_uf_ibge"))


def reject_reason(uf: Column, movement: Column, book: Codebook = DEFAULT_CODEBOOK) -> Column:
    """The first rule a row breaks, NULL for a valid row."""
    valid_movement = F.coalesce(movement.isin(*MOVEMENT), F.lit(False))
    return (
        F.when(~_has_uf(uf), "sem_uf")
        .when(~uf.isin(*book.valid_ufs), "uf_invalida")
        .when(~valid_movement, "mov_invalida")
    )


def clean(
    integrated: DataFrame, book: Codebook = DEFAULT_CODEBOOK, names_are_tidy: bool = False
) -> DataFrame:
    """Valid rows with standard texts, movement label and quarter.

    The rules are written as plain predicates so that they reach the scans. The
    UF is tested before it is trimmed, so trimming is left out where the list of
    valid UFs is trimmed itself. ``names_are_tidy`` says the texts were tidied in
    the municipality and code tables, which spares doing it per row; so do tidied names
    beside the original ones (``TIDY``), which take their place.
    """
    uf = F.col("sigla_uf")
    valid = _official_uf(integrated).where(
        _has_uf(uf) & uf.isin(*book.valid_ufs) & F.col("tipo_mov").isin(*MOVEMENT)
    )
    texts = {}
    if any(name != name.strip().upper() for name in book.valid_ufs):
        texts["sigla_uf"] = F.upper(strip(uf))
    if not names_are_tidy:
        casings = {"nome_municipio": title_case, "regiao": title_case, "setor": lambda text: text}
        for name, casing in casings.items():
            if TIDY.get(name) in valid.columns:
                texts[name] = F.col(TIDY[name])
            elif name in valid.columns and (name != "setor" or untidy(book)):
                texts[name] = casing(strip(F.col(name)))
    movement = F.col("tipo_mov").cast("int")
    quarter = quarter_label(F.col("mes"))
    return (
        (valid.withColumns(texts) if texts else valid)
        .withColumns(
            {
                "tipo_mov": movement,
                "saldo": F.col("saldo").cast("int"),
                "tipo_mov_label": decode(movement, MOVEMENT),
                "trimestre": quarter,
                "ano_trimestre": year_quarter_label(F.col("ano"), quarter),
            }
        )
        .drop("sigla_uf_ibge", "regiao_cod", *TIDY.values())
    )


def untidy(book: Codebook) -> bool:
    """Whether any sector label has to be trimmed."""
    return any(label != label.strip() for label in book.sector.values())


def account_counts(integrated: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> dict[tuple[str, str], Column]:
    """The counts behind the reject report and the null profile, by (``conta``, ``nome``).

    They can be taken by an aggregation or observed while the table is written.
    """
    uf = "sigla_uf_ibge" if "sigla_uf_ibge" in integrated.columns else "sigla_uf"
    motive = reject_reason(F.col(uf), F.col("tipo_mov"), book)
    return {
        ("rejeitados", "total_entrada"): F.count(F.lit(1)),
        **{("rejeitados", rule): F.count_if(motive == rule) for rule in RULES},
        ("rejeitados", "total_saida"): F.count_if(motive.isNull()),
        ("rejeitados", "removidos"): F.count(motive),
        ("nulos", ""): F.count(F.lit(1)),
        **{
            ("nulos", name): F.count_if(is_missing(F.col(f"`{name}`"), kind in ("double", "float")))
            for name, kind in integrated.dtypes
            if name not in TIDY.values()
        },
    }


def account(integrated: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """All counts behind the reject report and the null profile, in one pass.

    Rows (``conta``, ``nome``, ``registros``): the rows in, those charged to each rule,
    out and removed, and the nulls of each column. Accounts of parts can be added up.
    """
    counts = account_counts(integrated, book)
    numbered = [count.alias(f"c{i}") for i, count in enumerate(counts.values())]
    entries = [
        F.struct(F.lit(kind).alias("conta"), F.lit(name).alias("nome"), F.col(f"c{i}").alias("registros"))
        for i, (kind, name) in enumerate(counts)
    ]
    return integrated.agg(*numbered).select(F.inline(F.array(*entries)))


def _shares(accounts: DataFrame, kind: str, total: str, name: str, count: str) -> DataFrame:
    """The sums of one kind of account with their percentage of a total."""
    sums = accounts.where(F.col("conta") == kind).groupBy("nome").agg(F.sum("registros").alias(count))
    whole = Window.partitionBy()  # a row for each rule or column
    entry = F.max(F.when(F.col("nome") == total, F.col(count))).over(whole)
    share = F.coalesce(F.try_divide(count, entry) * 100, F.lit(0.0))
    return sums.select(F.col("nome").alias(name), count, share.alias("pct"))


def reject_shares(accounts: DataFrame) -> DataFrame:
    """Rows in, rows charged to each rule, rows out and rows removed."""
    return _shares(accounts, "rejeitados", "total_entrada", "motivo", "registros")


def null_shares(accounts: DataFrame) -> DataFrame:
    """Nulls and their percentage for every column that has any."""
    return _shares(accounts, "nulos", "", "coluna", "nulos").where("coluna <> '' AND nulos > 0")


def reject_report(integrated: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """Rows in, rows charged to each rule, rows out and rows removed, in one pass."""
    rows = _official_uf(integrated).select(
        reject_reason(F.col("sigla_uf"), F.col("tipo_mov"), book).alias("motivo")
    )
    motive = F.col("motivo")
    totals = rows.agg(
        F.count("*").alias("total_entrada"),
        *[F.count_if(motive == rule).alias(rule) for rule in RULES],
        F.count_if(motive.isNull()).alias("total_saida"),
        F.count("motivo").alias("removidos"),
    )
    names = totals.columns
    return (
        totals.withColumn("_entrada", F.col("total_entrada"))
        .unpivot("_entrada", names, "motivo", "registros")
        .select(
            "motivo",
            "registros",
            F.coalesce(F.try_divide("registros", "_entrada") * 100, F.lit(0.0)).alias("pct"),
        )
    )


def null_profile(table: DataFrame) -> DataFrame:
    """Nulls and their percentage for every column that has any, in one pass."""
    nulls = [
        F.count_if(is_missing(table[f"`{name}`"], kind in ("double", "float"))).alias(name)
        for name, kind in table.dtypes
    ]
    return (
        table.agg(F.count("*").alias("_linhas"), *nulls)
        .unpivot("_linhas", [f"`{name}`" for name in table.columns], "coluna", "nulos")
        .where("nulos > 0")
        .select("coluna", "nulos", (F.col("nulos") / F.col("_linhas") * 100).alias("pct"))
    )
