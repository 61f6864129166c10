"""Operators on small tables, special cases first."""

import random
from collections import defaultdict
from datetime import date
from hashlib import md5

from pyspark.sql import functions as F

from jobtide.codes import FINE_PHASES, phase_order
from jobtide.operators import aggregate, clean, enrich, filters, ranking, series, shape
from jobtide.plans import views
from jobtide.sources import manifest

SECTOR_YEAR = "ano int, setor string, saldo bigint"
MONTHLY = "ano int, mes int, ano_mes date, saldo bigint"


def rows(table, *order):
    return [tuple(row) for row in (table.orderBy(*order) if order else table).collect()]


def monthly(spark, balances, start=2020):
    data = [(start + i // 12, i % 12 + 1, date(start + i // 12, i % 12 + 1, 1), b) for i, b in balances]
    return spark.createDataFrame(data, MONTHLY)


def test_balance_drops_null_keys_and_sums_nulls_to_zero(spark):
    table = spark.createDataFrame([("a", None), ("a", None), (None, 5), ("b", 2)], "k string, saldo int")
    assert rows(aggregate.balance_by(table, "k"), "k") == [("a", 0), ("b", 2)]


def test_balance_with_a_hot_key_matches_brute_force(spark):
    random.seed(1)
    data = [("hot" if random.random() < 0.4 else f"k{random.randrange(50)}", random.choice([1, -1])) for _ in range(6000)]
    expected = defaultdict(int)
    for key, value in data:
        expected[key] += value
    table = spark.createDataFrame(data, "k string, saldo int").repartition(8)
    assert dict(rows(aggregate.balance_by(table, "k"))) == expected


def test_rollups_equal_separate_sums(spark):
    data = [(2020, 1, "SP", "x", 3), (2020, 2, "SP", None, 4), (None, None, "RJ", "x", 5), (2021, 1, "RJ", "x", -1)]
    cube = aggregate.base_cube(
        spark.createDataFrame(data, "ano int, mes int, sigla_uf string, setor string, saldo int"),
        "ano", "mes", "sigla_uf", "setor",
    )
    sets = {"uf": ["ano", "sigla_uf"], "setor": ["ano", "setor"], "mes": ["ano", "mes"]}
    both = aggregate.rollups(cube, sets)
    for name, keys in sets.items():
        ours = both.where(F.col("tabela") == name).select(*keys, "saldo")
        assert rows(ours, *keys) == rows(aggregate.balance_by(cube, *keys), *keys)


def test_outer_balance_fills_gaps(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "setor string, saldo bigint")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "setor string, saldo bigint")
    assert rows(aggregate.outer_balance(a, b, "setor"), "setor") == [("x", 1, 0), ("y", 2, 3), ("z", 0, 4)]


def test_growth_equals_outer_join_of_the_years(spark):
    data = [(2020, "x", 10), (2026, "x", 15), (2020, "y", 0), (2026, "y", 3), (2026, "z", 5), (2020, "w", -4), (2023, "v", 1)]
    table = spark.createDataFrame(data, SECTOR_YEAR)
    grown = series.growth(table, "setor", 2020, 2026)
    assert rows(grown, "setor") == [("w", -4, 0, 100.0), ("x", 10, 15, 50.0), ("y", 0, 3, 300.0), ("z", 0, 5, 500.0)]
    joined = aggregate.outer_balance(table.where("ano = 2020"), table.where("ano = 2026"), "setor")
    assert rows(joined, "setor") == rows(grown.drop("variacao_pct"), "setor")


def test_moving_average_counts_rows_not_months(spark):
    table = monthly(spark, [(0, 3), (1, 6), (4, 9), (5, None), (6, 1), (7, 2)])
    means = [r[-1] for r in rows(series.moving_average(table), "ano_mes")]
    assert means == [None, 6.0, None, None, None, None]
    assert [r[-1] for r in rows(series.moving_average(monthly(spark, [(0, 3), (1, 6)])))] == [None, None]


def test_min_max(spark):
    same = spark.createDataFrame([("a", 5), ("b", 5)], "k string, saldo bigint")
    assert [r[-1] for r in rows(series.min_max(same))] == [0.0, 0.0]
    other = spark.createDataFrame([("a", -5), ("b", 0), ("c", 15)], "k string, saldo bigint")
    assert [r[-1] for r in rows(series.min_max(other), "k")] == [0.0, 0.25, 1.0]


def test_extremes_take_the_earliest_month(spark):
    table = monthly(spark, [(0, 7), (1, 9), (2, -4), (3, 9), (4, -4)])
    found = {r.indicador: (r.saldo, r.periodo) for r in series.indicators(table, {"todos": None, "nenhum": [1999]}).collect()}
    assert found == {"todos": (17, None), "nenhum": (0, None), "melhor_mes": (9, "Fev/2020"), "pior_mes": (-4, "Mar/2020")}


def test_top_k_ties_take_the_smaller_key(spark):
    data = [(f"m{i:02}", 5 if i < 15 else i) for i in range(20)]
    table = spark.createDataFrame(data, "nome string, saldo bigint").repartition(5)
    top = [r[0] for r in ranking.top_k(table, 10, ["nome"]).collect()]
    assert top == ["m19", "m18", "m17", "m16", "m15", "m00", "m01", "m02", "m03", "m04"]
    bottom = [r[0] for r in ranking.top_k(table, 3, ["nome"], largest=False).collect()]
    assert bottom == ["m00", "m01", "m02"]
    assert ranking.top_bottom(table.limit(2), 3, ["nome"]).count() == 4


def test_fixed_sample(spark):
    table = spark.range(500).withColumn("x", F.col("id") % 7)
    sample = ranking.fixed_sample(table, 50)
    assert sample.count() == 50 and sample.distinct().count() == 50
    assert rows(sample, "id") == rows(ranking.fixed_sample(table.repartition(7), 50), "id")
    assert rows(sample, "id") != rows(ranking.fixed_sample(table, 50, seed=7), "id")
    assert ranking.fixed_sample(table, 900).count() == 500


def test_fixed_sample_with_many_copies_matches_brute_force(spark):
    data = [("copy", 1)] * 700 + [(f"r{i}", i) for i in range(1400)]
    table = spark.createDataFrame(data, "x string, y int").repartition(8)

    def place(row):
        return md5(f"{row[0]}|{row[1]}|42".encode()).hexdigest(), *row

    in_order = sorted(data, key=place)
    first_copy = next(i for i, row in enumerate(in_order) if row[0] == "copy")
    for n in (1, 30, first_copy + 5, first_copy + 699, 2100):
        assert rows(ranking.fixed_sample(table, n), "x", "y") == sorted(in_order[:n])


def test_unknown_categories_sort_last(spark):
    order = phase_order(FINE_PHASES)
    table = spark.createDataFrame([(name,) for name in ["zzz", *reversed(order)]], "fase string")
    assert [r[0] for r in rows(ranking.order_by_category(table, "fase", order))] == [*order, "zzz"]


def test_pivot_keeps_listed_columns(spark):
    table = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "w", 4), ("a", None, 9)], "k string, c string, saldo bigint")
    wide = shape.pivot_balance(table, "k", "c", ["x", "y"])
    assert wide.columns == ["k", "x", "y"]
    assert rows(wide, "k") == [("a", 3, None), ("b", None, None)]


def test_domains(spark):
    table = spark.createDataFrame([(2020, "b"), (2021, "a"), (2021, None)], "ano int, setor string")
    assert rows(shape.domains(table, ["ano", "setor"])) == [
        ("ano", "2020", "2020", "2021"),
        ("ano", "2021", "2020", "2021"),
        ("setor", "a", "a", "b"),
        ("setor", "b", "a", "b"),
    ]


def test_region_filter(spark):
    by_uf = spark.createDataFrame([(2020, "SP", 1), (2021, "AC", 2), (2022, "RJ", 4)], "ano int, sigla_uf string, saldo bigint")
    regions = spark.createDataFrame([("Sudeste", ["SP", "RJ"]), ("Norte", ["AC"])], "regiao string, ufs array<string>")
    pick = lambda chosen: [r[1] for r in rows(filters.in_regions(by_uf, chosen, regions).select("ano", "sigla_uf"), "ano")]
    assert pick(None) == pick([]) == ["SP", "AC", "RJ"]
    assert pick(["Sudeste", "Nenhures"]) == ["SP", "RJ"]
    assert pick(["Nenhures"]) == []
    assert rows(views.uf_ranking(by_uf, regions, (2021, 2022), ["Sudeste"])) == [("RJ", 4, True)]


def test_chosen_uf_takes_precedence_for_municipalities_only(spark):
    place = "ano int, nome_municipio string, sigla_uf string, regiao string, saldo bigint"
    towns = spark.createDataFrame([(2020, "A", "SP", "Sudeste", 5), (2020, "B", "AC", "Norte", 3), (2021, "B", "AC", "Norte", 4)], place)
    by_uf = spark.createDataFrame([(2020, "SP", 5), (2020, "AC", 7)], "ano int, sigla_uf string, saldo bigint")
    regions = spark.createDataFrame([("Sudeste", ["SP"]), ("Norte", ["AC"])], "regiao string, ufs array<string>")
    page = views.regional_page(by_uf, towns, regions, regions=["Sudeste"], uf="AC")
    assert rows(page["ranking_ufs"]) == [("SP", 5, True)]
    assert rows(page["maiores"]) == rows(page["menores"]) == [("B", "AC", "Norte", 7, "B (AC)")]


def test_homonyms_in_one_uf_merge(spark):
    place = "ano int, nome_municipio string, sigla_uf string, regiao string, cod int, saldo int"
    towns = spark.createDataFrame([(2020, "A", "SP", "Sudeste", 1, 1), (2020, "A", "SP", "Sudeste", 2, 1)], place)
    merged = aggregate.balance_by(towns, "ano", "nome_municipio", "sigla_uf", "regiao")
    assert rows(merged) == [(2020, "A", "SP", "Sudeste", 2)]


def test_pages_have_all_their_tables(spark):
    table = monthly(spark, [(i, i - 6) for i in range(30)])
    by_uf = spark.createDataFrame([(2020, "SP", 5), (2021, "AC", -7)], "ano int, sigla_uf string, saldo bigint")
    by_sector = spark.createDataFrame([(2020, "x", 5), (2021, "y", -7), (2026, "x", 6)], SECTOR_YEAR)
    by_phase = spark.createDataFrame([("Recuperação", "x", 4), ("Pandemia aguda", "x", 1)], "fase_pandemia string, setor string, saldo bigint")
    regions = spark.createDataFrame([("Sudeste", ["SP"]), ("Norte", ["AC"])], "regiao string, ufs array<string>")
    overview = views.overview_page(series.moving_average(table), by_uf, by_sector, by_phase)
    assert [r[0] for r in rows(overview["fases"])] == ["Pandemia aguda", "Recuperação"]
    assert [r[0] for r in rows(overview["setores"])] == ["y", "x"]
    assert overview["indicadores"].count() == 5 and overview["tendencia"].count() == 30
    crisis = views.crisis_page(table, by_phase, by_sector, by_uf, regions)
    assert crisis["zoom"].count() == 30 and crisis["setor_anos"].count() == 2
    assert rows(crisis["regiao_fase"]) == [("Sudeste", "Pandemia (2020)", 5), ("Norte", "Pandemia tardia", -7)]
    sector = views.sectoral_page(by_sector, series.growth(by_sector, "setor", 2020, 2026), aggregate.balance_by(table, "ano", "mes"), (2020, 2021), ["x"])
    assert rows(sector["evolucao"]) == [(2020, "x", 5)]
    assert rows(sector["crescimento"]) == [("x", 5, 6, 20.0, "+20.0%", True)]
    assert sector["sazonalidade"].count() == 2


def test_first_failing_rule_is_charged(spark):
    cases = [(None, 9.0), ("", 1.0), ("XX", 9.0), (" SP", 1.0), ("SP", None), ("SP", 0.0), ("SP", 1.5), ("SP", 1.0), ("SP", -1.0)]
    table = spark.createDataFrame([(i, *case) for i, case in enumerate(cases)], "i int, uf string, m double")
    found = [r.y for r in table.select("i", clean.reject_reason(F.col("uf"), F.col("m")).alias("y")).orderBy("i").collect()]
    assert found == ["sem_uf", "sem_uf", "uf_invalida", "uf_invalida", "mov_invalida", "mov_invalida", "mov_invalida", None, None]


def test_null_profile_counts_nan(spark):
    table = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, "a")], "a int, `b c` double, d string")
    assert rows(clean.null_profile(table), "coluna") == [("b c", 1, 50.0), ("d", 1, 50.0)]


def test_duplicate_dimension_rows_multiply_and_unmatched_stay(spark):
    fact = spark.createDataFrame([("355030", 1.0), ("9", 1.0), (None, 1.0)], "cod_municipio string, tipo_mov double")
    place = "cod_municipio string, nome_municipio string, sigla_uf string, nome_uf string, regiao string"
    towns = spark.createDataFrame([("355030", "A", "SP", "S", "r"), ("355030", "B", "SP", "S", "r")], place)
    joined = enrich.join_municipality(fact, towns)
    assert joined.count() == 4 and joined.where("nome_municipio IS NULL").count() == 2


def test_manifest_and_missing(spark):
    names = [("Mov202001.7z",), ("MOV202002.7Z",), ("other202001.7z",), ("mov202003.zip",), ("mov202004.7z",)]
    available = manifest.manifest(spark.createDataFrame(names, "nome string"), token="mov")
    assert rows(available, "stem") == [
        ("Mov202001.7z", "MOV202001", "MOV202001.parquet"),
        ("MOV202002.7Z", "MOV202002", "MOV202002.parquet"),
        ("mov202004.7z", "MOV202004", "MOV202004.parquet"),
    ]
    present = spark.createDataFrame([("MOV202002",)], "stem string")
    assert [r[0] for r in rows(manifest.missing_files(available, present).select("stem"), "stem")] == ["MOV202001", "MOV202004"]
