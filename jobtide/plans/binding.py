"""The star-schema test tables seen as movements.

A line item is a movement, its customer the municipality, the nation the UF and
the part type the sector. Nation 24 has no UF, nations 22 and 23 are not in the
list of valid UFs, and return flag N is no valid movement code, so every reject
rule has rows.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobtide.codes import Codebook
from jobtide.functions.lookup import decode
from jobtide.functions.text import municipality_key, strip, title_case, zero_fill
from jobtide.operators.clean import clean
from jobtide.operators.derive import derive
from jobtide.operators.enrich import add_balance, add_period, decode_labels, join_municipality
from jobtide.operators.sizing import broadcast_if_small
from jobtide.sources.municipalities import tidy

NO_UF_NATION = 24
FIRST_YEAR, LAST_YEAR = 1995, 2001
MOVEMENT_OF_FLAG = {"A": 1.0, "R": -1.0, "N": 0.0}

# Part type STANDARD has no entry and takes the default sector.
BOOK = Codebook(
    sex={"O": "Masculino", "F": "Feminino"},
    sector={
        "ECONOMY": "Agropecuária",
        "LARGE": "Indústria extrativa",
        "MEDIUM": "Construção civil",
        "PROMO": "Comércio",
        "SMALL": "Educação",
    },
    region_code={"Africa": 1, "America": 2, "Asia": 3, "Europe": 4, "Middle East": 5},
    valid_ufs=tuple(f"NATION_{key}" for key in range(22)),
    first_year=FIRST_YEAR,
)

# Customer keys grow with the data: compare them whole, never their first digits.
WHOLE_CODE_WIDTH = 19


def whole_code(code: Column) -> Column:
    """Join key that keeps every digit of a customer key."""
    return municipality_key(code, WHOLE_CODE_WIDTH)


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    """Schema from the file footers, looked up once per session."""
    return spark.read.parquet(path).schema


class Tables:
    """The Parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        table = self.spark.read.schema(_schema(self.spark, path)).parquet(path)
        setattr(self, name, table)
        return table

    def ufs(self) -> DataFrame:
        """UF and region of each nation that has one."""
        nation = self.nation.where(F.col("n_nationkey") != NO_UF_NATION)
        return nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            "n_nationkey",
            F.col("n_name").alias("sigla_uf"),
            F.concat(F.lit("Estado "), F.col("n_name")).alias("nome_uf"),
            F.col("r_name").alias("regiao"),
        )

    def municipalities(self) -> DataFrame:
        """One row per customer, with tidy names. The code stays a number."""
        customer = self.customer
        ufs = broadcast_if_small(self.ufs(), self.nation)
        placed = customer.join(ufs, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        municipalities = tidy(
            placed.select(
                F.col("c_custkey").alias("cod_municipio"),
                F.col("c_name").alias("nome_municipio"),
                "sigla_uf",
                "nome_uf",
                "regiao",
            )
        )
        return broadcast_if_small(municipalities, customer)

    def region_ufs(self) -> DataFrame:
        """(region, list of its UFs), from the 25 nations."""
        return (
            self.ufs()
            .groupBy(title_case(strip(F.col("regiao"))).alias("regiao"))
            .agg(F.sort_array(F.collect_list("sigla_uf")).alias("ufs"))
        )

    def lines(
        self,
        accepted_only: bool = False,
        years: tuple[int | None, int | None] = (None, None),
        raw: Column | None = None,
    ) -> DataFrame:
        """Line items as movements without a place, those that a predicate on the raw columns chooses.

        ``accepted_only`` also filters the raw flag, and ``years`` (first, last) the
        raw date. These reach the scan, unlike filters on what is computed from them.
        """
        lines = self.lineitem
        if raw is not None:
            lines = lines.where(raw)
        first, last = years
        if first is not None:
            lines = lines.where(F.col("l_shipdate") >= F.lit(f"{first}-01-01").cast("date"))
        if last is not None:
            lines = lines.where(F.col("l_shipdate") < F.lit(f"{last + 1}-01-01").cast("date"))
        if accepted_only:
            lines = lines.where(F.col("l_returnflag").isin("A", "R"))
        return lines.select(
            "l_orderkey",
            "l_partkey",
            F.trunc(F.col("l_shipdate").cast("date"), "month").alias("ano_mes"),
            decode(F.col("l_returnflag"), MOVEMENT_OF_FLAG).alias("tipo_mov"),
            F.col("l_extendedprice").alias("salario"),
            F.col("l_linestatus").alias("sexo"),
        )

    def orders_with_code(self) -> DataFrame:
        """What an order says about its movements."""
        return self.orders.select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("cod_municipio"),
            F.substring("o_orderpriority", 1, 1).alias("escolaridade"),
        )

    def integrated(
        self,
        accepted_only: bool = False,
        sector: bool = False,
        years: tuple[int | None, int | None] = (None, None),
        counted: bool = False,
    ) -> DataFrame:
        """Movements with period, labels, municipality and, if asked for, sector.

        The municipality is joined to the orders, a fraction of the line items,
        so the line items are shuffled for one join at most. With ``counted`` they are
        counted per month, code, UF and part (``vezes``) before the join to the parts, so
        that a hot part is no more than a few rows in each task there.
        """
        placed = join_municipality(
            self.orders_with_code(), self.municipalities(), key=lambda code: code
        )
        placed = broadcast_if_small(placed, self.orders)
        fact = self.lines(accepted_only, years).join(placed, "l_orderkey", "left")
        if counted:
            same = ("ano_mes", "tipo_mov", "l_partkey", "sigla_uf_ibge")
            fact = fact.groupBy(*same).agg(F.count("*").alias("vezes"))
        if sector:
            part = self.part.select(
                F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("secao_cnae")
            )
            fact = fact.join(part, "l_partkey", "left")
        return decode_labels(
            add_balance(add_period(fact.drop("l_orderkey", "l_partkey"))), BOOK
        ).withColumn("sigla_uf", F.lit(None).cast("string"))

    def cleaned(
        self, sector: bool = False, years: tuple[int | None, int | None] = (None, None)
    ) -> DataFrame:
        """Valid movements, of some years if bounds are given."""
        return clean(self.integrated(True, sector, years), BOOK, names_are_tidy=True)

    def sums(self, years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
        """Valid movements with their sector, added up per month, UF and part."""
        rows = clean(self.integrated(True, True, years, counted=True), BOOK, names_are_tidy=True)
        return rows.withColumn("saldo", F.col("saldo") * F.col("vezes"))

    def transformed(self, sector: bool = False) -> DataFrame:
        """Valid movements with derived columns."""
        return derive(self.cleaned(sector), BOOK)

    def lines_with_code(self, raw: Column | None = None) -> DataFrame:
        """Movements, the chosen ones if any, with what their order says about them."""
        orders = broadcast_if_small(self.orders_with_code(), self.orders)
        lines = self.lines(raw=raw)
        return lines.join(orders, "l_orderkey", "left")

    def movements_with_order_code(self, raw: Column | None = None) -> DataFrame:
        """Movements in the stored form: month as text, municipality as text code."""
        return self.lines_with_code(raw).select(
            F.date_format("ano_mes", "yyyyMM").alias("ano_mes"),
            zero_fill(F.col("cod_municipio").cast("string"), 6).alias("cod_municipio"),
            "tipo_mov",
            "salario",
            "sexo",
            "escolaridade",
        )
