"""The stored stages over small raw files with one row per special case."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from jobtide.codes import DEFAULT_CODEBOOK
from jobtide.operators.clean import clean
from jobtide.operators.enrich import integrate
from jobtide.operators.series import growth
from jobtide.plans.stages import build_tables, ingest_missing, read_ledger, store_municipalities
from jobtide.plans.views import crisis_page, overview_page, region_table, regional_page, sectoral_page
from jobtide.schemas import MOVEMENTS, SOURCE_FILE
from jobtide.sources.raw import EXTRA, read_raw, read_raw_month
from jobtide.sources.tables import (
    WRITERS,
    combine_parts,
    file_counts,
    is_complete,
    read_malformed,
    read_movements,
    write_fact,
    write_once,
)
from jobtide.streaming.monthly import current_monthly, monthly_preparation, refresh_monthly

HEADER = (
    "competênciamov;região;uf;município;seção;subclasse;saldomovimentação;saldomensalremuneração;"
    "sexotrabalhador;raçacortrabalhador;graudeinstruçãotrabalhador;tipoempregador;"
    "tipomovimentação;tamestab"
)
FIRST = [
    "202001;3;35;355030;G;4711;1;1500.5;1;1;5;0;10;4",
    "202001;3;35;3550308; g ;4711;-1;1234,56;3;6;7;0;31;4",
    " 202002 ;3;35;355030;Z;4711;1.0;2000;7;2;99;0;10;4",
    "202013;3;35;355030;;4711;1;NA;9;9;;0;10;4",
    "20201;3;35;355030;A;4711;-1;900;1;3;1;0;10;4",
    "202003;3;35;355030;A;4711;x;900;1;3;1;0;10;4",
    "202003;3;35;355030;A;4711;;900;1;3;1;0;10;4",
    "202003;3;35;355030;A;4711;0;900;1;3;1;0;10;4",
    "202003;3;35;355030;A;4711;2;900;1;3;1;0;10;4",
    "202003;3;35;355030;A;4711;1.5;900;1;3;1;0;10;4",
    "202003;3;35;355030;A;4711;1d;900;1;3;1;0;10;4",
    "202006;5;52;520010;F;4711;1;900;1;3;2;0;10;4",
    "202007;5;52;520010;F;4711;1;900;1;3;2;0;10;4",
]
SECOND_HEADER = (
    "saldomovimentação;competênciamov;extra;município;seção;sexotrabalhador;"
    "graudeinstruçãotrabalhador"
)
SECOND = [
    "1;202101;q;355030;G;3;8",
    "1;202101;q;355030;G;3;8",
    "-1;202312;q;12;A;1;9",
    "1;202401;q;12;A;1;9",
    "1;202402;q;999999;A;1;9",
    "1;202402;q;777777;A;1;9",
    "1;202402;q;888888;A;1;9",
    "1;202402;q;666666;A;1;9",
]


def _uf(sigla, nome, regiao):
    return {"mesorregiao": {"UF": {"sigla": sigla, "nome": nome, "regiao": {"nome": regiao}}}}


PLACES = [
    {"id": 3550308, "nome": "SÃO PAULO", "microrregiao": _uf("SP", "São Paulo", "Sudeste")},
    {"id": 5200100, "nome": " são joão d'aliança", "microrregiao": _uf("GO", "Goiás", "centro-oeste")},
    {"id": 12, "nome": "vila-nova", "microrregiao": _uf("AC", "Acre", "Norte")},
    {"id": 9999990, "nome": "Sem pai", "microrregiao": None},
    {"id": 7777770, "nome": "Fora", "microrregiao": _uf("XX", "Xis", "Norte")},
    {"id": 8888880, "nome": "Espaço", "microrregiao": _uf(" sp", "São Paulo", "Sudeste")},
]


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    files = {
        "MOVS202001.txt": [HEADER, *FIRST],
        "MOVS202101.txt": [SECOND_HEADER, *SECOND],
    }
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    (folder / "municipios.json").write_text(json.dumps(PLACES, ensure_ascii=False), encoding="utf-8")
    return folder


@pytest.fixture(scope="module")
def tables(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    paths = sorted(str(path) for path in raw.glob("*.txt"))
    return build_tables(spark, paths, str(raw / "municipios.json"), out, keep_steps=True)


def test_files_with_other_columns_keep_their_meaning(spark, raw):
    paths = [str(raw / name) for name in ("MOVS202001.txt", "MOVS202101.txt")]
    rows = read_raw(spark, paths)
    assert rows.columns == MOVEMENTS.fieldNames() + EXTRA
    second = rows.where("arquivo = 'MOVS202101'").collect()
    assert len(second) == 8
    assert second[0].ano_mes == "202101" and second[0].tipo_mov == 1.0
    assert second[0].salario is None and second[0].raca_cor is None


def test_mixed_headers_in_one_scan_fail_instead_of_swapping(spark, raw):
    both = [str(raw / "MOVS202001.txt"), str(raw / "MOVS202101.txt")]
    with pytest.raises(Exception, match="header does not conform"):
        read_raw_month(spark, both).select("tamestab", "uf").collect()


def test_numbers_and_missing_tokens(tables):
    salaries = {row.salario for row in tables["movimentos"].where("ano_mes = '202001'").collect()}
    assert salaries == {1500.5, None}
    assert tables["movimentos"].where("ano_mes = '202013'").first().salario is None
    moves = tables["movimentos"].where("ano_mes = '202003'").collect()
    assert sorted(m.tipo_mov for m in moves if m.tipo_mov is not None) == [0.0, 1.5, 2.0]


def test_municipalities(tables):
    rows = {row.cod_municipio: row for row in tables["municipios"].collect()}
    assert set(rows) == {"355030", "520010", "000012", "999999", "777777", "888888"}
    assert rows["999999"].sigla_uf == "" and rows["999999"].regiao == ""


def test_integrated_keeps_every_row(tables):
    assert tables["integrado"].count() == len(FIRST) + len(SECOND)
    unmatched = tables["integrado"].where("cod_municipio = '666666'").first()
    assert unmatched.sigla_uf_ibge is None and unmatched.nome_municipio is None


def test_decoded_labels(tables):
    by_code = tables["integrado"].where("cod_municipio = '3550308'").first()
    assert by_code.setor == "Comércio" and by_code.sexo == "Feminino"
    assert by_code.raca_cor == "Amarela" and by_code.escolaridade == "Superior completo"
    assert by_code.nome_municipio == "SÃO PAULO" and by_code.salario is None
    odd = tables["integrado"].where("mes = 2 AND ano = 2020").first()
    assert odd.setor == "Não informado" and odd.sexo == "Não identificado"
    assert odd.escolaridade == "Não informado" and odd.ano_mes == date(2020, 2, 1)


def test_reject_report(tables):
    counts = {row.motivo: row.registros for row in tables["rejeitados"].collect()}
    assert counts == {
        "total_entrada": 21,
        "sem_uf": 2,
        "uf_invalida": 2,
        "mov_invalida": 6,
        "total_saida": 11,
        "removidos": 10,
    }


def test_clean_rows(tables):
    cleaned = tables["limpo"]
    assert "sigla_uf_ibge" not in cleaned.columns and "regiao_cod" not in cleaned.columns
    names = {row.nome_municipio: row.regiao for row in cleaned.collect()}
    assert names == {
        "São Paulo": "Sudeste",
        "São João D'Aliança": "Centro-Oeste",
        "Vila-Nova": "Norte",
    }
    undated = cleaned.where("ano_mes IS NULL").collect()
    assert len(undated) == 2
    assert all(row.trimestre is None and row.ano_trimestre is None for row in undated)
    assert cleaned.where("ano = 2021").count() == 2


def test_derived_columns(tables):
    rows = tables["transformado"].collect()
    phases = {(row.ano, row.mes): row.fase_pandemia for row in rows}
    assert phases == {
        (2020, 1): "Pandemia aguda",
        (2020, 2): "Pandemia aguda",
        (2020, 6): "Pandemia aguda",
        (2020, 7): "Pandemia inicial",
        (2021, 1): "Pandemia tardia",
        (2023, 12): "Normalização",
        (2024, 1): "Expansão pós-pandemia",
        (None, None): "Expansão pós-pandemia",
    }
    june = next(row for row in rows if (row.ano, row.mes) == (2020, 6))
    assert (june.trimestre, june.ano_trimestre, june.periodo_sazonal) == ("T2", "2020-T2", "Abr-Jun")
    assert (june.ano_mes_int, june.regiao_cod_num, june.escolaridade_cod, june.sexo_cod) == (
        202006,
        5,
        1,
        0,
    )
    undated = next(row for row in rows if row.ano is None)
    assert undated.periodo_sazonal == "Não informado" and undated.ano_mes_int is None


def test_balances_agree(tables):
    total = tables["transformado"].agg(F.sum("saldo")).first()[0]
    dated = tables["transformado"].where("ano IS NOT NULL").agg(F.sum("saldo")).first()[0]

    def whole(name):
        return tables[name].agg(F.sum("saldo")).first()[0]

    assert whole("agg_saldo_fase") == total == 5
    for name in ("agg_saldo_mensal", "agg_saldo_uf", "agg_setor_ano", "agg_mes_ano", "agg_municipios"):
        assert whole(name) == dated


def test_null_profile(tables):
    nulls = {row.coluna: row.nulos for row in tables["nulos"].collect()}
    assert nulls["ano_mes"] == 2 and nulls["ano"] == 2
    assert nulls["tipo_mov"] == 3
    assert "setor" not in nulls and "sexo" not in nulls
    assert nulls["sigla_uf_ibge"] == 1
    assert nulls["salario"] == 2 + len(SECOND)


def test_second_run_adds_only_new_files(spark, raw, tmp_path):
    path = str(tmp_path / "movimentos")
    first, second = str(raw / "MOVS202001.txt"), str(raw / "MOVS202101.txt")
    assert ingest_missing(spark, [first], path) == 1
    assert ingest_missing(spark, [first, second], path) == 1
    assert ingest_missing(spark, [first, second], path) == 0
    stored = read_movements(spark, path)
    counts = {row[SOURCE_FILE]: row["count"] for row in stored.groupBy(SOURCE_FILE).count().collect()}
    assert counts == {"MOVS202001": len(FIRST), "MOVS202101": len(SECOND)}


def test_write_once_skips_complete_and_replaces_torn(spark, tmp_path):
    path = str(tmp_path / "tabela")
    assert write_once(spark.range(3), path)
    assert not write_once(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "tabela" / "_SUCCESS").unlink()
    assert not is_complete(spark, path)
    assert write_once(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_second_build_makes_nothing_again(spark, raw, tmp_path):
    def files():
        return {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("*") if f.is_file()}

    paths = [str(raw / "MOVS202001.txt"), str(raw / "MOVS202101.txt")]
    build_tables(spark, paths, str(raw / "municipios.json"), str(tmp_path))
    before = files()
    build_tables(spark, paths, str(raw / "municipios.json"), str(tmp_path))
    assert files() == before


def test_duplicate_municipality_fails(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([PLACES[0], PLACES[0]]), encoding="utf-8")
    with pytest.raises(ValueError):
        store_municipalities(spark, str(tmp_path / "m.json"), str(tmp_path / "m"))


def test_parts_combine_by_name_and_are_counted(spark, tmp_path):
    one, two = str(tmp_path / "lote_01"), str(tmp_path / "lote_02")
    spark.range(3).select("id", F.lit("a").alias("x")).coalesce(1).write.parquet(one)
    spark.range(2).coalesce(1).write.parquet(two)
    both = combine_parts(spark, [one, two])
    assert both.count() == 5 and both.where("x IS NULL").count() == 2
    counts = file_counts(both).orderBy("arquivo").collect()
    assert [row.registros for row in counts] == [3, 2]
    assert [row.acumulado for row in counts] == [3, 5]


def test_year_filter_prunes_partitions(tables):
    plan = tables["transformado"].where("ano = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_rules_reach_both_scans(tables):
    cleaned = clean(integrate(tables["movimentos"], tables["municipios"]))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "In(tipo_mov, [-1.0,1.0])" in plan and "In(sigla_uf, [AC," in plan
    assert "BroadcastHashJoin" in plan and "Inner" in plan


def balances(tables):
    return {
        name: sorted(map(tuple, tables[name].collect()), key=str)
        for name in tables
        if name.startswith("agg_") or name in ("rejeitados", "nulos")
    }


def test_new_months_reach_every_table(spark, raw, tmp_path):
    first, second = (str(raw / f"{name}.txt") for name in ("MOVS202001", "MOVS202101"))
    places = str(raw / "municipios.json")
    grown, whole = str(tmp_path / "grown"), str(tmp_path / "whole")
    early = build_tables(spark, [first], places, grown)
    assert early["transformado"].count() == 7
    later = build_tables(spark, [first, second], places, grown)
    once = build_tables(spark, [second, first], places, whole)
    assert later["transformado"].count() == once["transformado"].count() == 11
    assert balances(later) == balances(once)
    assert {"saldo_2020", "saldo_2026"} < set(later["agg_crescimento_setor"].columns)


def test_files_are_told_apart_by_their_path(spark, raw, tmp_path):
    text = (raw / "MOVS202001.txt").read_text(encoding="utf-8")
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "MOVS202001.txt").write_text(text, encoding="utf-8")
    path = str(tmp_path / "movimentos")
    one, two = (str(tmp_path / folder / "MOVS202001.txt") for folder in "ab")
    assert ingest_missing(spark, [one], path) == 1
    assert ingest_missing(spark, [one, two], path) == 1
    assert read_movements(spark, path).count() == 2 * len(FIRST)
    both = str(tmp_path / "juntos")
    assert ingest_missing(spark, [one, two], both) == 2
    assert read_movements(spark, both).count() == 2 * len(FIRST)


def test_outcome_of_every_file(spark, raw, tmp_path):
    good, broken, empty, blank = (tmp_path / f"{name}.txt" for name in ("good", "broken", "empty", "blank"))
    good.write_text("\n".join([HEADER, *FIRST]) + "\n", encoding="utf-8")
    broken.write_text("\n".join([SECOND_HEADER, *SECOND, "1;202101", SECOND[0] + ";more"]) + "\n", encoding="utf-8")
    empty.write_text(HEADER + "\n", encoding="utf-8")
    blank.write_text("", encoding="utf-8")
    lost = tmp_path / "lost.txt"
    path = str(tmp_path / "movimentos")
    paths = [str(f) for f in (good, broken, empty, blank, lost)]
    assert ingest_missing(spark, paths, path) == 2
    rows = {
        row.caminho.rsplit("/", 1)[1]: (row.registros, row.malformados, row.situacao)
        for row in read_ledger(spark, f"{path}_arquivos").collect()
    }
    assert rows == {
        "good.txt": (len(FIRST), 0, "gravado"),
        "broken.txt": (len(SECOND), 2, "gravado"),
        "empty.txt": (0, 0, "vazio"),
        "blank.txt": (0, 0, "ilegivel"),
        "lost.txt": (0, 0, "ausente"),
    }
    kept = read_malformed(spark, path)
    assert {row.caminho.rsplit("/", 1)[1] for row in kept.collect()} == {"broken.txt"}
    assert {row.linha_malformada for row in kept.collect()} == {"1;202101", SECOND[0] + ";more"}
    lost.write_text("\n".join([HEADER, FIRST[0]]) + "\n", encoding="utf-8")
    assert ingest_missing(spark, paths, path) == 1
    assert read_movements(spark, path).count() == len(FIRST) + len(SECOND) + 1


def test_headers_take_one_job(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"m{i}.txt").write_text("\n".join([HEADER, *FIRST]) + "\n", encoding="utf-8")
    tracker = spark.sparkContext.statusTracker()

    def jobs(count):
        spark.sparkContext.setJobGroup(f"headers-{count}", "")
        read_raw(spark, [str(tmp_path / f"m{i}.txt") for i in range(count)])
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"headers-{count}"))

    assert jobs(2) == jobs(12)


def test_fact_is_read_once(spark, raw, tmp_path, monkeypatch):
    from jobtide.plans import stages

    reads = []
    original = stages.integrate
    monkeypatch.setattr(stages, "integrate", lambda *a: reads.append(a[0]) or original(*a))
    build_tables(spark, [str(raw / "MOVS202001.txt")], str(raw / "municipios.json"), str(tmp_path))
    assert len(reads) == 1
    from pyspark.sql import DataFrame

    assert isinstance(reads[0], DataFrame)


def test_fact_is_written_by_the_tasks_that_have_it(spark, tmp_path):
    years = [F.col("id"), (2020 + F.col("id") % 3).cast("int").alias("ano")]
    rows = spark.range(0, 3000, 1, 4).select(*years)
    before = spark.conf.get(WRITERS, None)
    write_fact(rows, str(tmp_path / "fato"), "ano")
    # Moved to their years the rows would lie in one small file each.
    assert {len(list((tmp_path / "fato" / f"ano={year}").glob("*.parquet"))) for year in (2020, 2021, 2022)} == {4}
    assert sorted(spark.read.parquet(str(tmp_path / "fato")).collect()) == sorted(rows.collect())
    assert spark.conf.get(WRITERS, None) == before


def test_fact_with_more_partitions_than_open_files(spark, tmp_path):
    rows = spark.range(0, 500, 1, 2).select("id", (F.col("id") % 50).alias("parte"))
    write_fact(rows, str(tmp_path / "fato"), "parte")
    assert sorted(spark.read.parquet(str(tmp_path / "fato")).collect()) == sorted(rows.collect())


def test_from_raw_files_to_all_pages(spark, raw, tables):
    regions = region_table(spark)
    t = tables
    pages = {
        **overview_page(t["agg_saldo_mensal"], t["agg_saldo_uf"], t["agg_setor_ano"], t["agg_saldo_fase"]),
        **regional_page(t["agg_saldo_uf"], t["agg_municipios"], regions),
        **sectoral_page(t["agg_setor_ano"], growth(t["agg_setor_ano"], "setor", 2020, 2026), t["agg_mes_ano"]),
        **crisis_page(t["agg_saldo_mensal"], t["agg_saldo_fase"], t["agg_setor_ano"], t["agg_saldo_uf"], regions),
    }
    assert all(page.count() for page in pages.values())
    choices = regional_page(t["agg_saldo_uf"], t["agg_municipios"], regions)["escolhas"].collect()
    assert {c.valor for c in choices if c.dominio == "regiao"} <= set(DEFAULT_CODEBOOK.region_ufs)
    years = sorted(int(c.valor) for c in choices if c.dominio == "ano")
    assert {(int(c.minimo), int(c.maximo)) for c in choices if c.dominio == "ano"} == {(years[0], years[-1])}


def test_monthly_refresh_of_real_movements(spark, raw, tmp_path):
    paths = [str(raw / name) for name in ("MOVS202001.txt", "MOVS202101.txt")]
    out = str(tmp_path / "out")
    state, sums = str(tmp_path / "state"), str(tmp_path / "sums")
    for upto in (1, 2):
        built = build_tables(spark, paths[:upto], str(raw / "municipios.json"), out)
        refresh_monthly(spark, f"{out}/movimentos", state, sums, monthly_preparation(built["municipios"]))
        monthly = built["agg_saldo_mensal"].select("ano", "mes", "ano_mes", "saldo")
        now = current_monthly(spark, sums).select("ano", "mes", "ano_mes", "saldo")
        assert sorted(map(tuple, now.collect())) == sorted(map(tuple, monthly.collect()))
