"""Movements laid out by municipality: no shuffle below the sums, every version of a file counted once."""

import os
import re

import pytest
from pyspark.sql import functions as F

from jobtide.operators.aggregate import balance_by
from jobtide.operators.clean import clean
from jobtide.operators.enrich import integrate
from jobtide.plans import places
from jobtide.plans.ingest import ingest_missing, withdraw
from jobtide.plans.places import (
    BY_MUNICIPALITY,
    PLACE,
    SLICE,
    balance_by_place,
    balance_by_slice,
    integrated_by_place,
    lay_out,
    newest_layout,
    remove_old_layouts,
    replace_municipalities,
)
from jobtide.sources.files import names
from jobtide.sources.municipalities import tidy
from jobtide.sources.tables import read_movements

HEADER = "competênciamov;município;saldomovimentação"
HOT = "100007"


def month(folder, name, first, count, year=2021, at=None):
    """One file of movements, a third of them identical rows of one municipality, some without a code."""
    lines = []
    for i in range(first, first + count):
        code = HOT if i % 3 == 0 else "" if i % 31 == 0 else str(100000 + i % 50)
        lines.append(f"{year}{i % 12 + 1:02d};{code};{1 if i % 5 else -1}" if i % 3 else f"{year}01;{code};1")
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    if at:
        os.utime(path, (at, at))
    return str(path)


@pytest.fixture(scope="module")
def towns(spark):
    rows = [(str(100000 + i), f"vila {i % 40}", "SP" if i % 2 else "RJ", "Estado", "sudeste") for i in range(45)]
    return spark.createDataFrame(rows, "cod_municipio string, nome_municipio string, sigla_uf string, nome_uf string, regiao string")


def plain(spark, movements, towns):
    """The balances by the ordinary join and sum."""
    rows = clean(integrate(read_movements(spark, movements).drop("lote", "arquivo", "origem"), tidy(towns)), names_are_tidy=True)
    return sorted(balance_by(rows, *BY_MUNICIPALITY).collect())


def laid(spark, movements, out):
    return sorted(balance_by_place(integrated_by_place(spark, movements, out)).collect())


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_joined_and_summed_without_an_exchange(spark, tmp_path, towns, no_broadcast):
    movements, out = str(tmp_path / "movimentos"), str(tmp_path / "lugares")
    for number in range(2):
        ingest_missing(spark, [month(tmp_path, f"m{number}.txt", 1000 * number, 900)], movements)
        assert lay_out(spark, movements, towns, out, buckets=16) == 1
    assert lay_out(spark, movements, towns, out, buckets=16) == 0
    joined = integrated_by_place(spark, movements, out)
    sliced = balance_by_slice(clean(joined, names_are_tidy=True))
    sliced.collect()
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    whole = balance_by_place(joined)
    whole.collect()
    final = re.split("== Initial Plan ==", whole._jdf.queryExecution().executedPlan().toString())[0]
    assert len(re.findall(r"\bExchange ", final)) == 1
    assert sorted(whole.collect()) == plain(spark, movements, towns)


def test_a_hot_municipality_is_split_even_if_its_rows_are_equal(spark, tmp_path, towns):
    movements, out = str(tmp_path / "movimentos"), str(tmp_path / "lugares")
    ingest_missing(spark, [month(tmp_path, "m.txt", 0, 3000)], movements)
    lay_out(spark, movements, towns, out, buckets=16)
    slices = newest_layout(spark, out).slices
    assert slices[HOT] >= 6
    rows = integrated_by_place(spark, movements, out).where(F.col(PLACE) == HOT).groupBy(SLICE).count().collect()
    assert len(rows) == slices[HOT] and max(row["count"] for row in rows) < 3 * 3000 / 16
    assert laid(spark, movements, out) == plain(spark, movements, towns)


def test_corrections_withdrawals_and_stopped_runs(spark, tmp_path, towns, monkeypatch):
    movements, out = str(tmp_path / "movimentos"), str(tmp_path / "lugares")
    a, b = month(tmp_path, "a.txt", 0, 300, at=1000), month(tmp_path, "b.txt", 500, 200)
    ingest_missing(spark, [a], movements)
    lay_out(spark, movements, towns, out, buckets=8)
    month(tmp_path, "a.txt", 7, 310, at=2000)
    ingest_missing(spark, [a, b], movements)
    before = laid(spark, movements, out)
    with monkeypatch.context() as patch:
        patch.setattr(places, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            lay_out(spark, movements, towns, out, buckets=8)
    assert laid(spark, movements, out) == before
    assert lay_out(spark, movements, towns, out, buckets=8) == 1
    assert laid(spark, movements, out) == plain(spark, movements, towns)
    withdraw(spark, [b], movements)
    assert lay_out(spark, movements, towns, out, buckets=8) == 0
    assert laid(spark, movements, out) == plain(spark, movements, towns)


def test_other_municipalities_leave_the_movements_where_they_are(spark, tmp_path, towns):
    movements, out = str(tmp_path / "movimentos"), str(tmp_path / "lugares")
    ingest_missing(spark, [month(tmp_path, "m.txt", 0, 400)], movements)
    lay_out(spark, movements, towns, out, buckets=8)
    folder = newest_layout(spark, out).folder
    files = names(spark, f"{out}/{folder}")
    renamed = towns.withColumn("nome_municipio", F.concat(F.lit("nova "), "nome_municipio"))
    replace_municipalities(spark, renamed, out)
    replace_municipalities(spark, renamed, out)
    assert laid(spark, movements, out) == plain(spark, movements, renamed)
    assert names(spark, f"{out}/{folder}") == files
    assert remove_old_layouts(spark, out, keep=1) == 2
    assert laid(spark, movements, out) == plain(spark, movements, renamed)


def test_an_outgrown_layout_is_written_anew(spark, tmp_path, towns, monkeypatch):
    movements, out = str(tmp_path / "movimentos"), str(tmp_path / "lugares")
    for number, wanted in enumerate((2, 3, 8)):
        monkeypatch.setattr(places, "_buckets_for", lambda _, wanted=wanted: wanted)
        ingest_missing(spark, [month(tmp_path, f"m{number}.txt", 300 * number, 300)], movements)
        lay_out(spark, movements, towns, out)
        assert newest_layout(spark, out).buckets == (8 if wanted == 8 else 2)
        assert laid(spark, movements, out) == plain(spark, movements, towns)


def test_nothing_to_lay_out(spark, tmp_path, towns):
    assert lay_out(spark, str(tmp_path / "movimentos"), towns, str(tmp_path / "lugares")) == 0
    with pytest.raises(ValueError):
        integrated_by_place(spark, str(tmp_path / "movimentos"), str(tmp_path / "lugares"))
