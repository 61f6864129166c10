"""The registered queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.codes import COARSE_PHASES, FINE_PHASES, MOVEMENT, NOT_IDENTIFIED, NOT_INFORMED
from jobtide.functions.lookup import decode
from jobtide.functions.numbers import to_number
from jobtide.functions.periods import (
    month_text,
    parse_month,
    phase,
    quarter_label,
    season,
    year_month_number,
    year_quarter_label,
)
from jobtide.functions.text import strip, title_case
from jobtide.operators.aggregate import (
    balance_by,
    balance_by_month,
    base_cube,
    outer_balance,
    rollups,
)
from jobtide.operators.clean import clean, null_profile, reject_reason, reject_report
from jobtide.operators.enrich import add_balance, add_period, decode_labels, join_municipality
from jobtide.operators.ranking import fixed_sample, top_bottom
from jobtide.operators.series import growth, min_max, moving_average
from jobtide.operators.shape import domains
from jobtide.operators.sizing import size_shuffles
from jobtide.plans import views
from jobtide.plans.binding import BOOK, FIRST_YEAR, LAST_YEAR, Tables, whole_code
from jobtide.plans.ingest import ingest_missing, withdraw
from jobtide.plans.places import balance_by_place, integrated_by_place, lay_out
from jobtide.plans.stages import build_tables
from jobtide.schemas import MOVEMENTS, MUNICIPALITY_JSON
from jobtide.session import shared_folder
from jobtide.sources.files import move_new, remove
from jobtide.sources.footers import footer_counts, footer_range
from jobtide.sources.manifest import manifest
from jobtide.sources.municipalities import flatten
from jobtide.sources.raw import conform, read_raw_month, union_months
from jobtide.sources.tables import combine_parts, file_counts, running_total, write_once
from jobtide.streaming.monthly import current_monthly, refresh_monthly
from jobtide.streaming.tables import current_tables, refresh_tables

Years = tuple[int | None, int | None]
ALL_YEARS = (None, None)
YEARS = (FIRST_YEAR + 1, LAST_YEAR - 1)
REGIONS = ["Asia", "Europe", "Atlantis"]
SECTORS = ["Comércio", "Educação", NOT_INFORMED]
UF = "NATION_7"
LAST_ARRIVAL_YEAR = 2000


def _monthly(t: Tables) -> DataFrame:
    return moving_average(balance_by_month(t.cleaned()))


def _by_uf(t: Tables, years: Years = ALL_YEARS) -> DataFrame:
    return balance_by(t.cleaned(years=years), "ano", "sigla_uf")


def _by_sector(t: Tables, years: Years = ALL_YEARS) -> DataFrame:
    return balance_by(t.sums(years), "ano", "setor")


def _by_phase(t: Tables) -> DataFrame:
    fine = phase(F.col("ano"), F.col("mes"), FINE_PHASES, FIRST_YEAR)
    return balance_by(t.sums().withColumn("fase_pandemia", fine), "fase_pandemia", "setor")


def _by_municipality(t: Tables, years: Years = ALL_YEARS) -> DataFrame:
    return balance_by(t.cleaned(years=years), "ano", "nome_municipio", "sigla_uf", "regiao")


def _by_month(t: Tables, years: Years = ALL_YEARS) -> DataFrame:
    return balance_by_month(t.cleaned(years=years)).drop("ano_mes")


def monthly_balance(t: Tables) -> DataFrame:
    return views.with_sign(_monthly(t)).orderBy("ano_mes")


def overview_kpis(t: Tables) -> DataFrame:
    return views.overview_indicators(_monthly(t), FIRST_YEAR, LAST_YEAR)


def balance_by_uf(t: Tables) -> DataFrame:
    return views.ufs(_by_uf(t))


def balance_by_sector(t: Tables) -> DataFrame:
    return views.sectors(_by_sector(t))


def balance_by_phase(t: Tables) -> DataFrame:
    return views.phases(_by_phase(t))


def sector_phase_matrix(t: Tables) -> DataFrame:
    return views.sector_phase_matrix(_by_phase(t))


def region_phase(t: Tables) -> DataFrame:
    return views.region_phases(_by_uf(t), t.region_ufs(), FIRST_YEAR)


def uf_ranking(t: Tables) -> DataFrame:
    return views.uf_ranking(_by_uf(t, YEARS), t.region_ufs(), YEARS, REGIONS)


def top_municipalities(t: Tables) -> DataFrame:
    return views.municipality_ranking(_by_municipality(t, YEARS), t.region_ufs(), YEARS, REGIONS)


def bottom_municipalities(t: Tables) -> DataFrame:
    return views.municipality_ranking(
        _by_municipality(t, YEARS), t.region_ufs(), YEARS, REGIONS, uf=UF, largest=False
    )


def municipality_years(t: Tables) -> DataFrame:
    return _by_municipality(t)


def sector_evolution(t: Tables) -> DataFrame:
    return views.sector_evolution(_by_sector(t, YEARS), YEARS, SECTORS)


def sector_growth(t: Tables) -> DataFrame:
    both = (FIRST_YEAR, LAST_YEAR)
    return views.sector_growth(growth(_by_sector(t, both), "setor", *both))


def schooling_year_pair(t: Tables) -> DataFrame:
    """Balance by schooling in the first and in the last year, by full outer join."""
    first, last = (
        balance_by(t.cleaned(years=(year, year)), "escolaridade") for year in (FIRST_YEAR, LAST_YEAR)
    )
    return outer_balance(first, last, "escolaridade")


def month_year_matrix(t: Tables) -> DataFrame:
    years = (FIRST_YEAR, LAST_YEAR - 1)
    return views.seasonality(_by_month(t, years), years)


def sector_three_years(t: Tables) -> DataFrame:
    years = list(range(FIRST_YEAR, FIRST_YEAR + 3))
    return views.sector_years(_by_sector(t, (years[0], years[-1])), years)


def phase_kpis(t: Tables) -> DataFrame:
    later = list(range(FIRST_YEAR + 2, LAST_YEAR + 1))
    return views.crisis_indicators(_monthly(t), [FIRST_YEAR, FIRST_YEAR + 1], later)


def first_years_zoom(t: Tables) -> DataFrame:
    years = list(range(FIRST_YEAR - 1, FIRST_YEAR + 3))
    monthly = balance_by_month(t.cleaned(years=(years[0], years[-1])))
    return views.months_of(monthly, years)


def uf_min_max(t: Tables) -> DataFrame:
    return top_bottom(min_max(balance_by(t.cleaned(), "sigla_uf")), 3, ["sigla_uf"])


def reject_report_query(t: Tables) -> DataFrame:
    return reject_report(t.integrated(), BOOK)


def null_profile_query(t: Tables) -> DataFrame:
    return null_profile(t.integrated(sector=True))


def decoded_rows(t: Tables) -> DataFrame:
    """Labels and numeric codes per combination of raw codes; the fact is grouped first."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("secao"))
    raw = t.lines_with_code().join(part, "l_partkey", "left")
    codes = raw.groupBy("sexo", "escolaridade", "secao", "tipo_mov").agg(
        F.count("*").alias("registros")
    )
    sex = decode(F.col("sexo"), BOOK.sex, NOT_IDENTIFIED)
    schooling = decode(F.col("escolaridade"), BOOK.schooling, NOT_INFORMED)
    return codes.select(
        F.col("sexo").alias("sexo_bruto"),
        F.col("escolaridade").alias("escolaridade_bruta"),
        F.col("secao").alias("secao_bruta"),
        F.col("tipo_mov").cast("int").alias("tipo_mov"),
        sex.alias("sexo"),
        schooling.alias("escolaridade"),
        decode(strip(F.upper("secao")), BOOK.sector, NOT_INFORMED).alias("setor"),
        decode(F.col("tipo_mov").cast("int"), MOVEMENT).alias("tipo_mov_label"),
        decode(sex, BOOK.sex_code, -1).alias("sexo_cod"),
        decode(schooling, BOOK.schooling_code, -1).alias("escolaridade_cod"),
        "registros",
    )


def enriched_rows(t: Tables) -> DataFrame:
    """Matched and unmatched movements per UF, joined on zero-filled text codes.

    Movements are counted per code before the join, so a municipality that holds a
    large share of them is one row there.
    """
    municipalities = t.municipalities().where("sigla_uf IS NOT NULL")
    codes = t.movements_with_order_code().groupBy("cod_municipio").agg(F.count("*").alias("vezes"))
    joined = join_municipality(codes, municipalities, whole_code)
    matched = F.col("nome_municipio").isNotNull()

    def total(rows):
        return F.coalesce(F.sum(rows), F.lit(0)).cast("bigint")

    return joined.groupBy("sigla_uf_ibge", "nome_uf", "regiao").agg(
        total(F.col("vezes")).alias("registros"),
        total(F.when(matched, F.col("vezes"))).alias("com_municipio"),
        total(F.when(~matched, F.col("vezes"))).alias("sem_municipio"),
    )


def derived_periods(t: Tables) -> DataFrame:
    """Period columns per month, parsed from its text form; the fact is grouped first."""
    months = t.lines().groupBy(F.date_format("ano_mes", "yyyyMM").alias("ano_mes")).count()
    dated = add_period(months)
    year, month = F.col("ano"), F.col("mes")
    quarter = quarter_label(month)
    return dated.select(
        "ano",
        "mes",
        "ano_mes",
        quarter.alias("trimestre"),
        year_quarter_label(year, quarter).alias("ano_trimestre"),
        season(month).alias("periodo_sazonal"),
        phase(year, month, FINE_PHASES, FIRST_YEAR).alias("fase_pandemia"),
        phase(year, month, COARSE_PHASES, FIRST_YEAR).alias("fase"),
        year_month_number(year, month).alias("ano_mes_int"),
        F.col("count").alias("registros"),
    )


def title_case_query(t: Tables) -> DataFrame:
    """Raw and title-cased texts of three tables; each distinct text is cased once."""
    sources = {
        "prioridade": t.orders.select(F.col("o_orderpriority").alias("texto")),
        "produto": t.part.select(F.col("p_name").alias("texto")),
        "regiao": t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(F.col("r_name").alias("texto")),
    }
    counted = union_months(
        [
            texts.groupBy("texto").agg(F.count("*").alias("registros")).withColumn(
                "origem", F.lit(origin)
            )
            for origin, texts in sources.items()
        ]
    )
    return counted.withColumn("titulo", title_case(strip(F.col("texto"))))


def fixed_sample_query(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return fixed_sample(lines, 1000, seed=42)


def merged_sample(t: Tables) -> DataFrame:
    """The sample of the fact from the stored samples of its years, which is that of ``fixed_sample``."""
    folder = shared_folder(t.spark, "amostras")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    turn = F.lit(f"{LAST_ARRIVAL_YEAR}-01-01").cast("date")
    shipped = F.col("l_shipdate")
    parts = (shipped.isNull() | (shipped < turn), shipped >= turn)
    for number, own in enumerate(parts):
        write_once(fixed_sample(lines.where(own).drop("l_shipdate"), 1000, seed=42), f"{folder}/parte={number}")
    drawn = t.spark.read.parquet(*[f"{folder}/parte={number}" for number in range(len(parts))])
    return fixed_sample(drawn, 1000, seed=42)


def missing_months(t: Tables) -> DataFrame:
    """(month, municipality) pairs that occur in the raw fact but have no valid movement.

    The anti-join of the pairs with the valid pairs, folded into one aggregation: a
    pair is missing if none of its rows is valid.
    """
    valid = F.count_if(F.col("tipo_mov").isin(*MOVEMENT)).alias("_validos")
    pairs = t.lines_with_code().groupBy("ano_mes", "cod_municipio")
    return pairs.agg(F.count("*").alias("registros"), valid).where("_validos = 0").drop("_validos")


def missing_files_query(t: Tables) -> DataFrame:
    """Archives of (month, UF) pairs with no accepted movement, by file name.

    Both sides of the anti-join would come from one sum per pair, and a pair names one file, so a file is
    missing if its own sum has nothing accepted: one scan of the fact, and no join.
    """
    reason = reject_reason(F.col("sigla_uf_ibge"), F.col("tipo_mov"), BOOK)
    files = (
        t.integrated()
        .groupBy("ano_mes", "sigla_uf_ibge")
        .agg(F.count_if(reason.isNull()).alias("aceitos"))
    )
    month = F.date_format("ano_mes", "yyyyMM")
    uf = F.coalesce("sigla_uf_ibge", F.lit("x"))
    name = F.concat(F.lit("movimento_"), month, F.lit("_"), uf, F.lit(".7z"))
    missing = files.where("aceitos = 0").select(name.alias("nome"), "aceitos")
    return manifest(missing, token="Movimento")


def domains_query(t: Tables) -> DataFrame:
    return domains(t.sums(), ["ano", "mes", "setor", "sigla_uf"])


def drifted_union(t: Tables) -> DataFrame:
    """Two parts of the fact with different columns, brought to one schema."""
    month = F.date_format("l_shipdate", "yyyyMM")
    movement = decode(F.col("l_returnflag"), {"A": "1", "R": "-1.0", "N": "x"})
    full = t.lineitem.where("l_linestatus = 'O'").select(
        month.alias("competênciamov"),
        movement.alias("saldomovimentação"),
        F.col("l_linestatus").alias("sexotrabalhador"),
        F.col("l_extendedprice").cast("string").alias("saldomensalremuneração"),
    )
    narrow = t.lineitem.where("l_linestatus <> 'O' OR l_linestatus IS NULL").select(
        F.col("l_suppkey").alias("coluna_desconhecida"),
        movement.alias("saldomovimentação"),
        month.alias("competênciamov"),
    )
    both = union_months([conform(full), conform(narrow)])
    decoded = decode_labels(add_balance(add_period(both.drop("secao_cnae"))), BOOK)
    return decoded.groupBy("ano", "sexo").agg(
        F.count("*").alias("registros"),
        F.count("tipo_mov").alias("com_movimento"),
        F.count("salario").alias("com_salario"),
        F.sum("saldo").cast("bigint").alias("saldo"),
    )


def base_cube_rollups(t: Tables) -> DataFrame:
    """Balances by UF, by sector and by month from one cube, in one scan of the fact."""
    cube = base_cube(t.sums(), "ano", "mes", "sigla_uf", "setor")
    return rollups(
        cube,
        {
            "agg_saldo_uf": ["ano", "sigla_uf"],
            "agg_setor_ano": ["ano", "setor"],
            "agg_mes_ano": ["ano", "mes"],
        },
    )


def parse_movement_codes(t: Tables) -> DataFrame:
    """How many texts parse as a number or a month, and the sum of those that do."""
    priority = F.col("o_orderpriority")
    year_and_number = F.concat(
        F.year("l_shipdate").cast("string"), F.lpad(F.col("l_quantity").cast("int"), 2, "0")
    )
    order_texts = t.orders.select(
        priority.alias("prioridade"), F.substring(priority, 1, 1).alias("prioridade_inicial")
    )
    line_texts = t.lineitem.select(
        F.col("l_quantity").cast("string").alias("quantidade"),
        year_and_number.alias("competencia"),
    )

    def month_number(text):
        return F.month(parse_month(text)).cast("double")

    def counts(texts: DataFrame, fields: dict) -> DataFrame:
        parsed = texts.select(*[parse(F.col(name)).alias(name) for name, parse in fields.items()])
        per_field = [
            F.struct(
                F.lit(name).alias("campo"),
                F.count_if(F.col(name).isNull()).alias("nulos"),
                F.count(name).alias("validos"),
                F.coalesce(F.sum(name), F.lit(0.0)).alias("soma"),
            )
            for name in fields
        ]
        return parsed.agg(F.array(*per_field).alias("campos")).select(F.inline("campos"))

    return union_months(
        [
            counts(order_texts, {"prioridade": to_number, "prioridade_inicial": to_number}),
            counts(line_texts, {"quantidade": to_number, "competencia": month_number}),
        ]
    )


def flatten_nested(t: Tables) -> DataFrame:
    """Customers as nested municipality objects in JSON text, read back and flattened."""
    placed = t.customer.join(t.ufs(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    uf = F.struct(
        F.col("sigla_uf").alias("sigla"),
        F.col("nome_uf").alias("nome"),
        F.struct(F.col("regiao").alias("nome")).alias("regiao"),
    )
    parents = F.struct(F.struct(uf.alias("UF")).alias("mesorregiao"))
    text = F.to_json(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("nome"),
            F.when(F.col("sigla_uf").isNotNull(), parents).alias("microrregiao"),
        )
    )
    parsed = placed.select(F.from_json(text, MUNICIPALITY_JSON).alias("m")).select("m.*")
    return flatten(parsed, whole_code)


def monthly_record_counts(t: Tables) -> DataFrame:
    """Records per month with the running total."""
    counts = t.lines().groupBy("ano_mes").agg(F.count("*").alias("registros"))
    return running_total(counts, "ano_mes")


def transformed_profile(t: Tables) -> DataFrame:
    """Every derived column of the transformed table, counted per combination."""
    columns = [
        "ano",
        "tipo_mov_label",
        "trimestre",
        "ano_trimestre",
        "regiao",
        "regiao_cod_num",
        "sexo",
        "sexo_cod",
        "periodo_sazonal",
        "fase_pandemia",
    ]
    return (
        t.transformed()
        .groupBy(*columns)
        .agg(
            F.count("*").alias("registros"),
            F.sum("saldo").alias("saldo"),
            F.min("ano_mes_int").alias("primeiro_mes"),
            F.max("ano_mes_int").alias("ultimo_mes"),
        )
    )


def delimited_months(t: Tables) -> DataFrame:
    """The fact written as two sets of delimited files with different columns, and read back."""
    folder = shared_folder(t.spark, "texto")
    male = t.movements_with_order_code(F.col("l_linestatus") == "O").select(
        F.col("ano_mes").alias("competênciamov"),
        F.col("cod_municipio").alias("município"),
        F.col("tipo_mov").alias("saldomovimentação"),
        F.col("sexo").alias("sexotrabalhador"),
    )
    other = t.lines().where("sexo <> 'O' OR sexo IS NULL").select(
        F.col("salario").alias("coluna_nova"),
        F.col("tipo_mov").alias("saldomovimentação"),
        F.date_format("ano_mes", "yyyyMM").alias("competênciamov"),
    )
    for name, part in (("a", male), ("b", other)):
        part.write.csv(f"{folder}/{name}", sep=";", header=True)
    months = [conform(read_raw_month(t.spark, f"{folder}/{name}")) for name in "ab"]
    dated = add_balance(add_period(union_months(months)))
    return dated.groupBy("ano_mes").agg(
        F.count("*").alias("registros"),
        F.count("cod_municipio").alias("com_municipio"),
        F.sum("saldo").cast("bigint").alias("saldo"),
    )


def incremental_month(t: Tables) -> DataFrame:
    """Monthly balance refreshed twice: after the first arrivals and after the rest.

    Movements that agree in month, municipality and code are counted before the
    join to the municipality.
    """
    folder = shared_folder(t.spark, "chegadas")
    municipalities = t.municipalities()
    same = ("ano_mes", "cod_municipio", "tipo_mov")

    def prepare(arrivals: DataFrame) -> DataFrame:
        counted = arrivals.groupBy(*same).agg(F.count("*").alias("vezes"))
        dated = add_balance(add_period(counted))
        placed = join_municipality(dated, municipalities, whole_code)
        cleaned = clean(placed, BOOK, names_are_tidy=True)
        return cleaned.withColumn("saldo", F.col("saldo") * F.col("vezes"))

    # On the raw date, so that each arrival reads its own part of the fact.
    turn = F.lit(f"{LAST_ARRIVAL_YEAR}-01-01").cast("date")
    shipped = F.col("l_shipdate")
    for number, months in enumerate((shipped.isNull() | (shipped < turn), shipped >= turn)):
        arrived = conform_stored(t.movements_with_order_code(months))
        write_once(arrived, f"{folder}/movimentos/chegada={number}")
        refresh_monthly(
            t.spark, f"{folder}/movimentos", f"{folder}/posicao", f"{folder}/saldo", prepare
        )
    return current_monthly(t.spark, f"{folder}/saldo")


def combined_parts(t: Tables) -> DataFrame:
    """Records per part, with the running total, of a fact stored in two parts.

    The parts have different columns; they are combined by name.
    """
    folder = shared_folder(t.spark, "lotes")
    lines = t.lines()
    parts = {
        "lote_a": lines.where("sexo = 'O'").select("ano_mes", "tipo_mov", "salario"),
        "lote_b": lines.where("sexo <> 'O' OR sexo IS NULL").select("tipo_mov", "ano_mes"),
    }
    paths = [f"{folder}/{name}" for name in parts]
    for path, rows in zip(paths, parts.values()):
        write_once(rows, path)
    salaries = F.count("salario").alias("com_salario")
    return file_counts(combine_parts(t.spark, paths), r"/(lote_[a-z])/", salaries)


def _raw_months(t: Tables) -> DataFrame:
    """The fact as raw text columns, with ``cedo`` for the months that arrive first."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("seção"))
    raw = t.lines_with_code().join(part, "l_partkey", "left")
    return raw.select(
        month_text(F.col("ano_mes")).alias("competênciamov"),
        F.col("cod_municipio").cast("string").alias("município"),
        "seção",
        F.col("tipo_mov").cast("string").alias("saldomovimentação"),
        F.col("sexo").alias("sexotrabalhador"),
        F.coalesce(F.col("ano_mes") < f"{LAST_ARRIVAL_YEAR}-01-01", F.lit(True)).alias("cedo"),
    )


def _write_text(raw: DataFrame, folder: str) -> list[str]:
    """Raw months as text files; their paths."""
    raw.drop("cedo").write.mode("overwrite").csv(folder, sep=";", header=True)
    return sorted(raw.sparkSession.read.text(folder).inputFiles())


def _republish(t: Tables, old: list[str], new: list[str], movements: str) -> list[str]:
    """Put new files in the place of old ones, and withdraw old ones that have no successor; the paths."""
    for before, after in zip(old, new):
        remove(t.spark, before)
        move_new(t.spark, after, before)
    withdraw(t.spark, old[len(new) :], movements)
    return old[: len(new)] + new[len(old) :]


def _places(t: Tables) -> DataFrame:
    return t.municipalities().withColumn("cod_municipio", whole_code(F.col("cod_municipio")))


def _three_balances(tables: dict[str, DataFrame]) -> DataFrame:
    keys = {
        "agg_saldo_uf": ["ano", "sigla_uf"],
        "agg_setor_ano": ["ano", "setor"],
        "agg_mes_ano": ["ano", "mes"],
    }
    return union_months(
        [
            tables[name].select(F.lit(name).alias("tabela"), *columns, "saldo")
            for name, columns in keys.items()
        ]
    ).select("tabela", "ano", "mes", "sigla_uf", "setor", "saldo")


def rebuilt_balances(t: Tables) -> DataFrame:
    """Stored balance tables after two ingests of raw text, the second of later months."""
    folder = shared_folder(t.spark, "meses")
    raw = _raw_months(t)
    write_once(_places(t), f"{folder}/tabelas/municipios")
    paths: list[str] = []
    for early in (True, False):
        paths += _write_text(raw.where(F.col("cedo") == early), f"{folder}/texto_{early}")
        tables = build_tables(
            t.spark, paths, "", f"{folder}/tabelas", BOOK, last_year=LAST_YEAR, key=whole_code
        )
    return _three_balances(tables)


def republished_months(t: Tables) -> DataFrame:
    """Stored balance tables after the early months, first published with hirings and dismissals
    exchanged, were published again under the same names, together with later months."""
    folder = shared_folder(t.spark, "correcao")
    raw = _raw_months(t)
    out = f"{folder}/tabelas"
    rows = footer_counts(t.spark, [f"{t.folder}/lineitem.parquet"]).first()[0]

    def write(months: DataFrame, name: str) -> list[str]:
        size_shuffles(t.lineitem, rows)
        return _write_text(months, f"{folder}/{name}")

    write_once(_places(t), f"{out}/municipios")
    early = raw.where("cedo")
    code = F.col("saldomovimentação").cast("double")
    paths = write(early.withColumn("saldomovimentação", (-code).cast("string")), "errado")
    build_tables(t.spark, paths, "", out, BOOK, last_year=LAST_YEAR, key=whole_code)
    right = write(early, "certo")
    paths = _republish(t, paths, right, f"{out}/movimentos")
    paths += write(raw.where("NOT cedo"), "novo")
    tables = build_tables(t.spark, paths, "", out, BOOK, last_year=LAST_YEAR, key=whole_code)
    return _three_balances(tables)


def streamed_tables(t: Tables) -> DataFrame:
    """The seven balance tables from the stream over commits: two arrivals and a correction of the first.

    Every row has the keys of its own table; ``indice`` is the moving mean or the growth.
    """
    folder = shared_folder(t.spark, "fluxo")
    raw = _raw_months(t)
    movements = f"{folder}/movimentos"
    early = raw.where("cedo")
    men = F.coalesce(F.col("sexotrabalhador") == "O", F.lit(False))
    first = _write_text(early.where(men), f"{folder}/homens")
    arrivals = [
        lambda: first,
        lambda: _republish(t, first, _write_text(early, f"{folder}/todos"), movements),
        lambda: _write_text(raw.where("NOT cedo"), f"{folder}/novo"),
    ]
    for arrive in arrivals:
        ingest_missing(t.spark, arrive(), movements)
        refresh_tables(
            t.spark, movements, _places(t), f"{folder}/posicao", f"{folder}/cubo", BOOK, whole_code
        )
    tables = current_tables(t.spark, f"{folder}/cubo", FIRST_YEAR, LAST_YEAR)
    growing = tables["agg_crescimento_setor"]
    tables["agg_crescimento_setor"] = growing.select(
        "setor",
        F.col(f"saldo_{LAST_YEAR}").alias("saldo"),
        F.col(f"saldo_{FIRST_YEAR}").alias("saldo_base"),
        F.col("variacao_pct").alias("indice"),
    )
    tables["agg_saldo_mensal"] = tables["agg_saldo_mensal"].withColumnRenamed("media_movel_3m", "indice")
    labelled = [table.select(F.lit(name).alias("tabela"), "*") for name, table in tables.items()]
    return union_months(labelled).select(
        "tabela", "ano", "mes", "ano_mes", "nome_municipio", "sigla_uf", "regiao", "fase_pandemia", "setor",
        "saldo", "saldo_base", "indice",
    )


def colocated_municipalities(t: Tables) -> DataFrame:
    """Balance by year and municipality of movements laid out by municipality, in two arrivals."""
    folder = shared_folder(t.spark, "lugares")
    raw, movements, out = _raw_months(t), f"{folder}/movimentos", f"{folder}/por_municipio"
    for early in (True, False):
        ingest_missing(t.spark, _write_text(raw.where(F.col("cedo") == early), f"{folder}/texto_{early}"), movements)
        lay_out(t.spark, movements, _places(t), out, whole_code)
    return balance_by_place(integrated_by_place(t.spark, movements, out, BOOK), BOOK)


def footer_ranges(t: Tables) -> DataFrame:
    """Rows, least and largest key of four tables, from the footers of their files."""
    keys = {"lineitem": "l_orderkey", "orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}
    ranges = [
        footer_range(t.spark, f"{t.folder}/{name}.parquet", key).select(F.lit(name).alias("tabela"), "*")
        for name, key in keys.items()
    ]
    return union_months(ranges)


def conform_stored(rows: DataFrame) -> DataFrame:
    """Adds the stored columns that ``rows`` lacks as typed NULLs, in schema order."""
    absent = {
        f.name: F.lit(None).cast(f.dataType) for f in MOVEMENTS if f.name not in rows.columns
    }
    return rows.withColumns(absent).select(*MOVEMENTS.fieldNames())


QUERIES = {
    "monthly_balance": monthly_balance,
    "overview_kpis": overview_kpis,
    "balance_by_uf": balance_by_uf,
    "balance_by_sector": balance_by_sector,
    "balance_by_phase": balance_by_phase,
    "sector_phase_matrix": sector_phase_matrix,
    "region_phase": region_phase,
    "uf_ranking": uf_ranking,
    "top_municipalities": top_municipalities,
    "bottom_municipalities": bottom_municipalities,
    "municipality_years": municipality_years,
    "sector_evolution": sector_evolution,
    "sector_growth": sector_growth,
    "schooling_year_pair": schooling_year_pair,
    "month_year_matrix": month_year_matrix,
    "sector_three_years": sector_three_years,
    "phase_kpis": phase_kpis,
    "first_years_zoom": first_years_zoom,
    "uf_min_max": uf_min_max,
    "reject_report": reject_report_query,
    "null_profile": null_profile_query,
    "decoded_rows": decoded_rows,
    "enriched_rows": enriched_rows,
    "derived_periods": derived_periods,
    "title_case": title_case_query,
    "fixed_sample": fixed_sample_query,
    "missing_months": missing_months,
    "missing_files": missing_files_query,
    "domains": domains_query,
    "drifted_union": drifted_union,
    "base_cube_rollups": base_cube_rollups,
    "parse_movement_codes": parse_movement_codes,
    "flatten_nested": flatten_nested,
    "monthly_record_counts": monthly_record_counts,
    "transformed_profile": transformed_profile,
    "delimited_months": delimited_months,
    "incremental_month": incremental_month,
    "combined_parts": combined_parts,
    "rebuilt_balances": rebuilt_balances,
    "republished_months": republished_months,
    "streamed_tables": streamed_tables,
    "footer_ranges": footer_ranges,
    "merged_sample": merged_sample,
    "colocated_municipalities": colocated_municipalities,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """Result of a registered query over the tables in ``folder``."""
    tables = Tables(spark, folder)
    size_shuffles(tables.lineitem)
    return QUERIES[name](tables)
