"""Movements laid out by municipality, so that joining and summing them by place shuffles nothing.

The movements of each commit are shuffled once, when they are added, into buckets of municipality and
slice, and the municipality table lies in the same buckets. So the join, and the sums
by municipality above it, run bucket by bucket; a corrected municipality table is stored anew and joined again
without moving a movement. A municipality with more rows than an even bucket is cut
into slices, of which each has the municipality's row beside it.

Files are added to one folder, under an attempt of their own that one record publishes. Rows of
attempts that no record names are not read. A layout that has outgrown its buckets is written
again with more of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.codes import DEFAULT_CODEBOOK, Codebook
from jobtide.functions.text import municipality_key
from jobtide.operators.aggregate import balance_by
from jobtide.operators.clean import clean
from jobtide.operators.enrich import Key, add_balance, add_period, decode_labels
from jobtide.operators.sizing import BYTES_PER_PARTITION, file_bytes
from jobtide.schemas import ATTEMPT, BATCH, GOOD, MOVEMENTS, ORIGIN, STATE
from jobtide.sources.files import names, remove
from jobtide.sources.ledger import ledger_path, read_ledger
from jobtide.sources.log import numbers, publish, read_record, record
from jobtide.sources.municipalities import duplicate_codes, tidy
from jobtide.sources.tables import read_versions, retired, without_retired

# What rows are laid out by: the municipality's key and the slice of a municipality with many rows.
PLACE, SLICE = "_codigo", "_fatia"
BY_MUNICIPALITY = ("ano", "nome_municipio", "sigla_uf", "regiao")
# A layout is written again once it should have so many times its buckets.
OUTGROWN = 4

FACT = T.StructType(
    [
        *MOVEMENTS,
        T.StructField(BATCH, T.IntegerType()),
        T.StructField(ORIGIN, T.StringType()),
        T.StructField(ATTEMPT, T.StringType()),
        T.StructField(PLACE, T.StringType()),
        T.StructField(SLICE, T.IntegerType()),
    ]
)
DIMENSION = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in ("nome_municipio", "sigla_uf_ibge", "nome_uf", "regiao")],
        T.StructField(PLACE, T.StringType()),
        T.StructField(SLICE, T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Layout:
    """What the last record says: the ledger's last commit, folders, buckets, the attempt of each commit, slices of each sliced place."""

    number: int
    upto: int
    folder: str
    buckets: int
    commits: dict[int, str]
    slices: dict[str | None, int]
    places: str


def _log(out: str) -> str:
    return f"{out}/layouts"


def newest_layout(spark: SparkSession, out: str) -> Layout | None:
    """The layout that was last published below ``out``, if any."""
    known = numbers(spark, _log(out))
    if not known:
        return None
    return _layout(spark, out, known[-1])


def _layout(spark: SparkSession, out: str, number: int) -> Layout:
    (line,) = read_record(spark, _log(out), number)
    commits, slices = dict(line["lotes"]), dict(line["fatias"])
    return Layout(number, line["ate"], line["pasta"], line["baldes"], commits, slices, line["municipios"])


def _publish(spark: SparkSession, out: str, layout: Layout) -> None:
    line = {
        "ate": layout.upto,
        "pasta": layout.folder,
        "baldes": layout.buckets,
        "lotes": sorted(layout.commits.items()),
        "fatias": list(layout.slices.items()),
        "municipios": layout.places,
    }
    publish(spark, [line], _log(out), layout.number)


@contextmanager
def _bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> Iterator[str]:
    """The name of a folder as a bucketed table while it is opened or added to; the files outlive the name."""
    name = f"lugares_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({PLACE}, {SLICE}) SORTED BY ({PLACE}, {SLICE}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _append(rows: DataFrame, path: str, schema: T.StructType, buckets: int) -> None:
    """Add rows to the buckets of a folder; one shuffle, one file for each bucket that gets rows."""
    with _bucketed(rows.sparkSession, path, schema, buckets) as name:
        (
            rows.select(*schema.fieldNames())
            .repartition(buckets, PLACE, SLICE)
            .write.bucketBy(buckets, PLACE, SLICE)
            .sortBy(PLACE, SLICE)
            .mode("append")
            .format("parquet")
            .saveAsTable(name)
        )


def _open(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    with _bucketed(spark, path, schema, buckets) as name:
        return spark.table(name)


def large_places(rows: DataFrame, buckets: int) -> dict[str | None, int]:
    """Slices of the municipalities with more rows than an even bucket has; there are fewer than ``buckets`` of them."""
    total = rows.count()
    counts = rows.groupBy(PLACE).agg(F.count("*").alias("n")).where(F.col("n") * buckets > total)
    return {row[PLACE]: -(-row.n * buckets // total) for row in counts.collect()}


def _listed(spark: SparkSession, slices: dict[str | None, int]) -> DataFrame:
    return spark.createDataFrame(list(slices.items()), "_grande string, _fatias int")


def sliced(rows: DataFrame, slices: dict[str | None, int]) -> DataFrame:
    """Rows of a file scan with their slice: by file and place in it, so equal rows part too and a task that runs again agrees."""
    if not slices:
        return rows.withColumn(SLICE, F.lit(0))
    row_id = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    numbered = rows.withColumn("_linha", row_id)
    # Fewer than a few times the buckets: what large_places lists.
    listed = F.broadcast(_listed(rows.sparkSession, slices))
    joined = numbered.join(listed, F.col(PLACE).eqNullSafe(F.col("_grande")), "left")
    own = F.coalesce(F.pmod("_linha", "_fatias"), F.lit(0)).cast("int")
    return joined.withColumn(SLICE, own).drop("_linha", "_grande", "_fatias")


def _dimension(municipalities: DataFrame, key: Key, slices: dict[str | None, int]) -> DataFrame:
    """The municipality table with tidy names, a row for each slice."""
    if not duplicate_codes(municipalities.select(key(F.col("cod_municipio")).alias("cod_municipio"))).isEmpty():
        raise ValueError("municipality codes are not unique")
    rows = tidy(municipalities).select(
        "nome_municipio",
        F.col("sigla_uf").alias("sigla_uf_ibge"),
        "nome_uf",
        "regiao",
        key(F.col("cod_municipio")).cast("string").alias(PLACE),
    )
    listed = F.broadcast(_listed(rows.sparkSession, slices))
    joined = rows.join(listed, F.col(PLACE) == F.col("_grande"), "left")
    last = F.coalesce("_fatias", F.lit(1)) - 1
    return joined.withColumn(SLICE, F.explode(F.sequence(F.lit(0), last))).drop("_grande", "_fatias")


def _with_places(spark: SparkSession, out: str, layout: Layout, municipalities: DataFrame, key: Key) -> Layout:
    places = f"municipios={uuid.uuid4().hex}"
    _append(_dimension(municipalities, key, layout.slices), f"{out}/{places}", DIMENSION, layout.buckets)
    return replace(layout, places=places)


def _buckets_for(movements: DataFrame) -> int:
    return max(8, -(-file_bytes(movements) // BYTES_PER_PARTITION))


def lay_out(
    spark: SparkSession,
    movements_path: str,
    municipalities: DataFrame,
    out: str,
    key: Key = municipality_key,
    buckets: int | None = None,
) -> int:
    """Bring the layout below ``out`` up to the ledger of the movements; returns how many commits were added.

    Each commit is added as a whole; a run that stops has added nothing that a reader sees. ``buckets`` is the number for a new
    layout; without it there is one for each 256 MB of movements, and a layout that should have
    ``OUTGROWN`` times as many as it has is written anew. A municipality that was once sliced keeps its slices, and rows
    without a code are sliced like those of a municipality.
    """
    upto = max(numbers(spark, ledger_path(movements_path)), default=0)
    layout = newest_layout(spark, out)
    if upto == (layout.upto if layout else 0):
        return 0
    ledger = read_ledger(spark, ledger_path(movements_path)).where(F.col(BATCH) <= upto)
    held = ledger.where(F.col("registros") > 0).select(BATCH).distinct()
    known = {row[BATCH] for row in held.collect()}  # a row for each commit
    wanted = buckets or _buckets_for(read_versions(spark, movements_path, ledger))
    before = layout.number if layout else 0
    if layout is None or (not buckets and wanted >= OUTGROWN * layout.buckets):
        layout = Layout(before, 0, f"movimentos={uuid.uuid4().hex}", wanted, {}, {}, "")
    new, attempt = sorted(known - set(layout.commits)), uuid.uuid4().hex
    slices, commits = dict(layout.slices), {**layout.commits, **dict.fromkeys(new, attempt)}
    if new:
        rows = read_versions(spark, movements_path, ledger.where(F.col(BATCH).isin(new))).where(F.col(STATE) == GOOD)
        keyed = rows.withColumn(PLACE, key(F.col("cod_municipio")).cast("string"))
        for place, count in large_places(keyed, layout.buckets).items():
            slices[place] = max(count, slices.get(place, 1))
        _append(sliced(keyed, slices).withColumn(ATTEMPT, F.lit(attempt)), f"{out}/{layout.folder}", FACT, layout.buckets)
    grown = replace(layout, number=before + 1, upto=upto, commits=commits, slices=slices)
    if not layout.places or slices != layout.slices:
        grown = _with_places(spark, out, grown, municipalities, key)
    _publish(spark, out, grown)
    return len(new)


def remove_old_layouts(spark: SparkSession, out: str, keep: int = 2) -> int:
    """Delete the folders that none of the last ``keep`` records names; returns how many. No run may be under way."""
    known = numbers(spark, _log(out))
    kept = [_layout(spark, out, number) for number in known[-keep:]]
    named = {folder for layout in kept for folder in (layout.folder, layout.places)}
    gone = [name for name in names(spark, out) if name.startswith(("movimentos=", "municipios=")) and name not in named]
    for name in gone:
        remove(spark, f"{out}/{name}")
    for number in known[:-keep]:
        remove(spark, record(_log(out), number))
    return len(gone)


def replace_municipalities(
    spark: SparkSession, municipalities: DataFrame, out: str, key: Key = municipality_key
) -> None:
    """Put another municipality table beside the movements, which stay where they are."""
    layout = newest_layout(spark, out)
    if layout is None:
        raise ValueError(f"no layout in {out}")
    changed = replace(layout, number=layout.number + 1)
    _publish(spark, out, _with_places(spark, out, changed, municipalities, key))


def integrated_by_place(
    spark: SparkSession, movements_path: str, out: str, book: Codebook = DEFAULT_CODEBOOK
) -> DataFrame:
    """The integrated table of the current version of every file in the layout, with the columns that it lies by.

    The join runs bucket by bucket; rows without a matching municipality keep NULLs.
    """
    layout = newest_layout(spark, out)
    if layout is None:
        raise ValueError(f"no layout in {out}")
    ledger = read_ledger(spark, ledger_path(movements_path)).where(F.col(BATCH) <= layout.upto)
    fact = _open(spark, f"{out}/{layout.folder}", FACT, layout.buckets)
    counted = fact.where(F.col(ATTEMPT).isin(sorted(set(layout.commits.values()))))
    counted = without_retired(counted, retired(ledger)).drop(BATCH, ORIGIN, ATTEMPT)
    places = _open(spark, f"{out}/{layout.places}", DIMENSION, layout.buckets)
    decoded = decode_labels(add_balance(add_period(counted)), book)
    return decoded.join(places, [PLACE, SLICE], "left")


def balance_by_place(integrated: DataFrame, book: Codebook = DEFAULT_CODEBOOK) -> DataFrame:
    """The balance by year and municipality of ``integrated_by_place``.

    Movements are summed for each slice where they lie; what is shuffled is one row for each year and slice.
    """
    cleaned = clean(integrated, book, names_are_tidy=True)
    return balance_by(balance_by_slice(cleaned), *BY_MUNICIPALITY)


def balance_by_slice(cleaned: DataFrame) -> DataFrame:
    """The balance by year, municipality and slice, without a shuffle."""
    return cleaned.groupBy(PLACE, SLICE, *BY_MUNICIPALITY).agg(F.sum("saldo").alias("saldo"))
