"""All balance tables kept up to date as commits reach the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobtide.codes import DEFAULT_CODEBOOK, Codebook
from jobtide.functions.text import municipality_key
from jobtide.operators.aggregate import CUBE_KEYS
from jobtide.operators.enrich import Key
from jobtide.plans.delta import CHANGE, changed_movements, cube_of
from jobtide.plans.stages import balance_tables, cube_rollups
from jobtide.schemas import BATCH, LEDGER
from jobtide.sources.files import exists
from jobtide.sources.ledger import ledger_path

CUBE = ", ".join(f"{key} {'int' if key in ('ano', 'mes') else 'string'}" for key in CUBE_KEYS)
SCHEMA = f"{CUBE}, saldo bigint, registros bigint, {CHANGE} int"


def refresh_tables(
    spark: SparkSession,
    movements_path: str,
    municipalities: DataFrame,
    checkpoint: str,
    out: str,
    book: Codebook = DEFAULT_CODEBOOK,
    key: Key = municipality_key,
) -> None:
    """Process the commits that the ledger has got since the last call.

    The stream follows the ledger, not the files of the movements, so what a stopped ingest left behind
    is never summed. A commit's change of the base cube, corrected and withdrawn files included, is stored
    under the commit's own number: a batch that is run again, with this checkpoint or a new one,
    replaces the same changes. No state is held and no movement is too late.
    """

    def store(lines: DataFrame, number: int) -> None:
        # A row for each commit that has arrived.
        commits = sorted(row[0] for row in lines.select(BATCH).distinct().collect())
        # By the outer session, which runs with AQE; a stream's own does not.
        changed = changed_movements(spark, movements_path, commits)
        (
            cube_of(changed, municipalities, book, key)
            .hint("rebalance", CHANGE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(CHANGE)
            .parquet(out)
        )

    (
        spark.readStream.schema(LEDGER)
        .json(ledger_path(movements_path))
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
        .awaitTermination()
    )


def current_tables(
    spark: SparkSession, out: str, first_year: int = 2020, last_year: int = 2026
) -> dict[str, DataFrame]:
    """The seven balance tables over all commits processed so far."""
    if exists(spark, out):
        changes = spark.read.schema(SCHEMA).parquet(out)
    else:
        changes = spark.createDataFrame([], SCHEMA)
    return balance_tables(cube_rollups(changes), first_year, last_year)
