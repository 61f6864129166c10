"""Monthly balance kept up to date as new month files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.codes import DEFAULT_CODEBOOK, Codebook
from jobtide.operators.aggregate import balance_by, balance_by_month
from jobtide.operators.clean import clean
from jobtide.operators.enrich import integrate
from jobtide.schemas import MOVEMENTS
from jobtide.sources.municipalities import tidy


def monthly_preparation(
    municipalities: DataFrame, book: Codebook = DEFAULT_CODEBOOK
) -> Callable[[DataFrame], DataFrame]:
    """How stored movements become cleaned rows for the monthly sum.

    Movements that agree in month, municipality and code are counted before the join.
    """
    places = tidy(municipalities)

    def prepare(arrivals: DataFrame) -> DataFrame:
        counted = arrivals.groupBy("ano_mes", "cod_municipio", "tipo_mov").agg(
            F.count("*").alias("vezes")
        )
        unplaced = counted.withColumn("sigla_uf", F.lit(None).cast("string"))
        cleaned = clean(integrate(unplaced, places, book), book, names_are_tidy=True)
        return cleaned.withColumn("saldo", F.col("saldo") * F.col("vezes"))

    return prepare


def refresh_monthly(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    out: str,
    prepare: Callable[[DataFrame], DataFrame],
    columns: tuple[str, ...] = ("ano_mes", "cod_municipio", "tipo_mov"),
) -> None:
    """Process the movement files that arrived since the last call.

    ``prepare`` turns stored movements, of which ``columns`` are read, into cleaned
    rows. Sums can be added, so a batch stores just its own sum per month, under
    its batch number: no state is held, no row is too late, a correction may touch
    any past month, and a batch that is run again replaces its own output.
    """

    def store(batch: DataFrame, number: int) -> None:
        # A stream runs without AQE; a batch of it needs AQE to split hot keys.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        sums = balance_by_month(prepare(batch))
        sums.write.mode("overwrite").parquet(f"{out}/lote={number}")

    (
        spark.readStream.schema(MOVEMENTS)
        .parquet(source)
        .select(*columns)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
        .awaitTermination()
    )


def current_monthly(spark: SparkSession, out: str) -> DataFrame:
    """Sum of every month over all batches."""
    batches = spark.read.schema("ano int, mes int, ano_mes date, saldo bigint, lote bigint").parquet(out)
    return balance_by(batches, "ano", "mes", "ano_mes")
