"""The registered queries once more, as plain SQL over the same tables."""

from __future__ import annotations

BASE = r"""
WITH ufs AS (
  SELECT n_nationkey, n_name AS sigla_uf, 'Estado ' || n_name AS nome_uf, r_name AS regiao_bruta,
         CASE r_name WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'America' WHEN 'ASIA' THEN 'Asia'
                     WHEN 'EUROPE' THEN 'Europe' WHEN 'MIDDLE EAST' THEN 'Middle East' END AS regiao
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey <> 24
),
municipios AS (
  SELECT c_custkey AS cod_municipio, c_name AS nome_municipio, sigla_uf, nome_uf, regiao
  FROM customer LEFT JOIN ufs ON c_nationkey = n_nationkey
),
integrado AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ano_mes,
         CAST(year(l_shipdate) AS INT) AS ano,
         CAST(month(l_shipdate) AS INT) AS mes,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN -1 WHEN 'N' THEN 0 END AS tipo_mov,
         o_custkey AS cod_municipio, nome_municipio, m.sigla_uf, m.nome_uf, m.regiao,
         l_extendedprice AS salario,
         l_linestatus AS sexo_bruto,
         CASE l_linestatus WHEN 'O' THEN 'Masculino' WHEN 'F' THEN 'Feminino'
                           ELSE 'Não identificado' END AS sexo,
         left(o_orderpriority, 1) AS escolaridade_bruta,
         CASE left(o_orderpriority, 1)
           WHEN '1' THEN 'Analfabeto' WHEN '2' THEN 'Fundamental incompleto'
           WHEN '3' THEN 'Fundamental completo' WHEN '4' THEN 'Médio incompleto'
           WHEN '5' THEN 'Médio completo' ELSE 'Não informado' END AS escolaridade,
         p_type AS secao_bruta,
         CASE upper(trim(p_type))
           WHEN 'ECONOMY' THEN 'Agropecuária' WHEN 'LARGE' THEN 'Indústria extrativa'
           WHEN 'MEDIUM' THEN 'Construção civil' WHEN 'PROMO' THEN 'Comércio'
           WHEN 'SMALL' THEN 'Educação' ELSE 'Não informado' END AS setor
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN municipios m ON o_custkey = m.cod_municipio
  LEFT JOIN part ON l_partkey = p_partkey
),
julgado AS (
  SELECT *,
         CASE WHEN sigla_uf IS NULL OR sigla_uf = '' THEN 'sem_uf'
              WHEN sigla_uf NOT IN (SELECT 'NATION_' || k FROM range(22) r(k)) THEN 'uf_invalida'
              WHEN tipo_mov IS NULL OR tipo_mov NOT IN (1, -1) THEN 'mov_invalida' END AS motivo,
         CASE WHEN ano = 1995 AND mes <= 6 THEN 'Pandemia aguda'
              WHEN ano = 1995 AND mes > 6 THEN 'Pandemia inicial'
              WHEN ano = 1996 THEN 'Pandemia tardia'
              WHEN ano = 1997 THEN 'Recuperação'
              WHEN ano = 1998 THEN 'Normalização'
              ELSE 'Expansão pós-pandemia' END AS fase_pandemia,
         CASE WHEN ano = 1995 THEN 'Pandemia (2020)'
              WHEN ano = 1996 THEN 'Pandemia tardia'
              WHEN ano = 1997 THEN 'Recuperação'
              WHEN ano = 1998 THEN 'Normalização'
              ELSE 'Expansão pós-pandemia' END AS fase
  FROM integrado
),
limpo AS (SELECT * FROM julgado WHERE motivo IS NULL),
mensal AS (
  SELECT ano, mes, ano_mes, CAST(sum(tipo_mov) AS BIGINT) AS saldo
  FROM limpo WHERE ano_mes IS NOT NULL GROUP BY ALL
),
por_uf AS (
  SELECT ano, sigla_uf, CAST(sum(tipo_mov) AS BIGINT) AS saldo
  FROM limpo WHERE ano IS NOT NULL GROUP BY ALL
),
por_setor AS (
  SELECT ano, setor, CAST(sum(tipo_mov) AS BIGINT) AS saldo
  FROM limpo WHERE ano IS NOT NULL GROUP BY ALL
),
por_fase AS (
  SELECT fase_pandemia, setor, CAST(sum(tipo_mov) AS BIGINT) AS saldo FROM limpo GROUP BY ALL
),
por_municipio AS (
  SELECT ano, nome_municipio, sigla_uf, regiao, CAST(sum(tipo_mov) AS BIGINT) AS saldo
  FROM limpo WHERE ano IS NOT NULL AND nome_municipio IS NOT NULL AND regiao IS NOT NULL
  GROUP BY ALL
),
nomes_mes AS (
  SELECT * FROM (VALUES (1, 'Jan'), (2, 'Fev'), (3, 'Mar'), (4, 'Abr'), (5, 'Mai'), (6, 'Jun'),
    (7, 'Jul'), (8, 'Ago'), (9, 'Set'), (10, 'Out'), (11, 'Nov'), (12, 'Dez')) v(mes_no, mes_nome)
)
"""

THOUSANDS = "CASE WHEN saldo > 0 THEN '+' ELSE '' END || format('{:,}', saldo)"

CARDS = """,
meses AS (
  SELECT saldo, ano_mes, mes_nome || '/' || ano AS periodo FROM mensal JOIN nomes_mes ON mes = mes_no
),
cartoes AS (
  %s
  UNION ALL (SELECT 'melhor_mes', saldo, periodo FROM meses ORDER BY saldo DESC, ano_mes LIMIT 1)
  UNION ALL (SELECT 'pior_mes', saldo, periodo FROM meses ORDER BY saldo, ano_mes LIMIT 1)
)
SELECT indicador, saldo, periodo, {0} AS rotulo FROM cartoes
""".replace("{0}", THOUSANDS)


def _card(name: str, condition: str = "TRUE") -> str:
    return (
        f"SELECT '{name}' AS indicador, CAST(coalesce(sum(saldo), 0) AS BIGINT) AS saldo, "
        f"CAST(NULL AS VARCHAR) AS periodo FROM mensal WHERE {condition}"
    )


def _cards(*cards: str) -> str:
    return CARDS.replace("%s", " UNION ALL ".join(cards))


def _pivot(table: str, index: str, column: str, values: list[str], where: str = "TRUE") -> str:
    cells = ", ".join(
        f"CAST(sum(saldo) FILTER (WHERE {column} = '{value}') AS BIGINT) AS \"{value}\""
        for value in values
    )
    return f"SELECT {index}, {cells} FROM {table} WHERE {where} GROUP BY {index}"


def _ranking(direction: str, where: str) -> str:
    return f"""
SELECT *, nome_municipio || ' (' || sigla_uf || ')' AS rotulo FROM (
  SELECT nome_municipio, sigla_uf, regiao, CAST(sum(saldo) AS BIGINT) AS saldo
  FROM por_municipio WHERE ano BETWEEN 1996 AND 2000 AND {where} GROUP BY ALL
  ORDER BY saldo {direction}, nome_municipio, sigla_uf, regiao LIMIT 10)
"""


def _nulls(columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{out}' AS coluna, count(*) - count({expr}) AS nulos, count(*) AS linhas FROM integrado"
        for out, expr in columns
    )
    return (
        f"SELECT coluna, CAST(nulos AS BIGINT) AS nulos, CAST(nulos AS DOUBLE) / linhas * 100 AS pct "
        f"FROM ({parts}) WHERE nulos > 0"
    )


FINE = [
    "Pandemia aguda",
    "Pandemia inicial",
    "Pandemia tardia",
    "Recuperação",
    "Normalização",
    "Expansão pós-pandemia",
]
MONTHS = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
TITLE = (
    r"array_to_string(list_transform(regexp_extract_all(texto, '(\p{L}+|[^\p{L}]+)'), "
    r"lambda w: upper(w[1]) || lower(w[2:])), '')"
)

BODIES = {
    "monthly_balance": """
SELECT *, saldo >= 0 AS ganho FROM (
  SELECT ano, mes, ano_mes, saldo,
         CASE WHEN count(*) OVER w = 3 THEN avg(saldo) OVER w END AS media_movel_3m
  FROM mensal WINDOW w AS (ORDER BY ano_mes ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
""",
    "overview_kpis": _cards(
        _card("saldo_total"), _card("saldo_inicial", "ano = 1995"), _card("saldo_final", "ano = 2001")
    ),
    "balance_by_uf": """
SELECT sigla_uf, CAST(sum(saldo) AS BIGINT) AS saldo, sum(saldo) >= 0 AS ganho
FROM por_uf GROUP BY sigla_uf
""",
    "balance_by_sector": """
SELECT setor, CAST(sum(saldo) AS BIGINT) AS saldo, sum(saldo) >= 0 AS ganho
FROM por_setor GROUP BY setor
""",
    "balance_by_phase": """
SELECT fase_pandemia, CAST(sum(saldo) AS BIGINT) AS saldo, sum(saldo) >= 0 AS ganho
FROM por_fase GROUP BY fase_pandemia
""",
    "sector_phase_matrix": _pivot("por_fase", "setor", "fase_pandemia", FINE),
    "region_phase": """
SELECT u.regiao, CASE ano WHEN 1995 THEN 'Pandemia (2020)' WHEN 1996 THEN 'Pandemia tardia'
         WHEN 1997 THEN 'Recuperação' WHEN 1998 THEN 'Normalização'
         ELSE 'Expansão pós-pandemia' END AS fase, CAST(sum(saldo) AS BIGINT) AS saldo
FROM por_uf JOIN ufs u USING (sigla_uf) WHERE u.regiao IS NOT NULL GROUP BY ALL
""",
    "uf_ranking": """
SELECT sigla_uf, CAST(sum(saldo) AS BIGINT) AS saldo, sum(saldo) >= 0 AS ganho FROM por_uf
WHERE ano BETWEEN 1996 AND 2000
  AND sigla_uf IN (SELECT sigla_uf FROM ufs WHERE regiao IN ('Asia', 'Europe', 'Atlantis'))
GROUP BY sigla_uf
""",
    "top_municipalities": _ranking(
        "DESC", "sigla_uf IN (SELECT sigla_uf FROM ufs WHERE regiao IN ('Asia', 'Europe', 'Atlantis'))"
    ),
    "bottom_municipalities": _ranking("ASC", "sigla_uf = 'NATION_7'"),
    "municipality_years": "SELECT * FROM por_municipio",
    "sector_evolution": """
SELECT * FROM por_setor
WHERE ano BETWEEN 1996 AND 2000 AND setor IN ('Comércio', 'Educação', 'Não informado')
""",
    "sector_growth": """,
crescimento AS (
  SELECT setor, saldo_base, saldo_alvo,
         round_even((saldo_alvo - saldo_base) / CAST(coalesce(nullif(abs(saldo_base), 0), 1) AS DOUBLE)
                    * 100, 1) AS variacao_pct
  FROM (SELECT setor,
               CAST(coalesce(sum(saldo) FILTER (WHERE ano = 1995), 0) AS BIGINT) AS saldo_base,
               CAST(coalesce(sum(saldo) FILTER (WHERE ano = 2001), 0) AS BIGINT) AS saldo_alvo
        FROM por_setor WHERE ano IN (1995, 2001) GROUP BY setor)
)
SELECT *, printf('%+.1f%%', variacao_pct) AS rotulo, variacao_pct >= 0 AS ganho FROM crescimento
""",
    "schooling_year_pair": """,
escolas AS (
  SELECT ano, escolaridade, CAST(sum(tipo_mov) AS BIGINT) AS saldo FROM limpo GROUP BY ALL
)
SELECT escolaridade, coalesce(a.saldo, 0) AS saldo_base, coalesce(b.saldo, 0) AS saldo_alvo
FROM (SELECT * FROM escolas WHERE ano = 1995) a
FULL JOIN (SELECT * FROM escolas WHERE ano = 2001) b USING (escolaridade)
""",
    "month_year_matrix": _pivot(
        "mensal JOIN nomes_mes ON mes = mes_no", "ano", "mes_nome", MONTHS, "ano BETWEEN 1995 AND 2000"
    ),
    "sector_three_years": "SELECT * FROM por_setor WHERE ano IN (1995, 1996, 1997)",
    "phase_kpis": _cards(
        _card("saldo_pandemia", "ano IN (1995, 1996)"),
        _card("saldo_pos_pandemia", "ano BETWEEN 1997 AND 2001"),
        _card("saldo_liquido", "ano BETWEEN 1995 AND 2001"),
    ),
    "first_years_zoom": """
SELECT ano, mes, ano_mes, saldo, mes_nome || '/' || ano AS rotulo, saldo >= 0 AS ganho
FROM mensal JOIN nomes_mes ON mes = mes_no WHERE ano IN (1994, 1995, 1996, 1997)
""",
    "uf_min_max": """,
normal AS (
  SELECT sigla_uf, saldo,
         coalesce((saldo - min(saldo) OVER ()) / CAST(nullif(max(saldo) OVER () - min(saldo) OVER (), 0)
                  AS DOUBLE), 0) AS saldo_normalizado
  FROM (SELECT sigla_uf, CAST(sum(tipo_mov) AS BIGINT) AS saldo FROM limpo GROUP BY sigla_uf)
)
(SELECT *, 'maiores' AS grupo FROM normal ORDER BY saldo DESC, sigla_uf LIMIT 3)
UNION ALL
(SELECT *, 'menores' AS grupo FROM normal ORDER BY saldo, sigla_uf LIMIT 3)
""",
    "reject_report": """,
contagem AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE motivo = 'sem_uf') AS sem_uf,
         count(*) FILTER (WHERE motivo = 'uf_invalida') AS uf_invalida,
         count(*) FILTER (WHERE motivo = 'mov_invalida') AS mov_invalida,
         count(*) FILTER (WHERE motivo IS NULL) AS saida
  FROM julgado
)
SELECT motivo, CAST(registros AS BIGINT) AS registros,
       CAST(registros AS DOUBLE) / total * 100 AS pct
FROM (SELECT 'total_entrada' AS motivo, total AS registros, total FROM contagem
      UNION ALL SELECT 'sem_uf', sem_uf, total FROM contagem
      UNION ALL SELECT 'uf_invalida', uf_invalida, total FROM contagem
      UNION ALL SELECT 'mov_invalida', mov_invalida, total FROM contagem
      UNION ALL SELECT 'total_saida', saida, total FROM contagem
      UNION ALL SELECT 'removidos', total - saida, total FROM contagem)
""",
    "null_profile": _nulls(
        [
            ("ano_mes", "ano_mes"),
            ("ano", "ano"),
            ("mes", "mes"),
            ("tipo_mov", "tipo_mov"),
            ("saldo", "tipo_mov"),
            ("salario", "salario"),
            ("sexo", "sexo"),
            ("escolaridade", "escolaridade"),
            ("setor", "setor"),
            ("secao_cnae", "secao_bruta"),
            ("cod_municipio", "cod_municipio"),
            ("nome_municipio", "nome_municipio"),
            ("sigla_uf_ibge", "sigla_uf"),
            ("nome_uf", "nome_uf"),
            ("regiao", "regiao"),
            ("sigla_uf", "CAST(NULL AS VARCHAR)"),
        ]
    ),
    "decoded_rows": """
SELECT sexo_bruto, escolaridade_bruta, secao_bruta, tipo_mov, sexo, escolaridade, setor,
       CASE tipo_mov WHEN 1 THEN 'Admissão' WHEN -1 THEN 'Desligamento' END AS tipo_mov_label,
       CASE sexo WHEN 'Masculino' THEN 0 WHEN 'Feminino' THEN 1 ELSE -1 END AS sexo_cod,
       CASE escolaridade WHEN 'Analfabeto' THEN 0 WHEN 'Fundamental incompleto' THEN 1
         WHEN 'Fundamental completo' THEN 2 WHEN 'Médio incompleto' THEN 3
         WHEN 'Médio completo' THEN 4 ELSE -1 END AS escolaridade_cod,
       count(*) AS registros
FROM integrado GROUP BY ALL
""",
    "enriched_rows": """
SELECT m.sigla_uf AS sigla_uf_ibge, m.nome_uf, m.regiao, count(*) AS registros,
       count(m.nome_municipio) AS com_municipio, count(*) - count(m.nome_municipio) AS sem_municipio
FROM integrado i
LEFT JOIN (SELECT * FROM municipios WHERE sigla_uf IS NOT NULL) m ON i.cod_municipio = m.cod_municipio
GROUP BY ALL
""",
    "derived_periods": """
SELECT ano, mes, ano_mes, 'T' || quarter(ano_mes) AS trimestre,
       ano || '-T' || quarter(ano_mes) AS ano_trimestre,
       CASE quarter(ano_mes) WHEN 1 THEN 'Jan-Mar' WHEN 2 THEN 'Abr-Jun' WHEN 3 THEN 'Jul-Set'
            WHEN 4 THEN 'Out-Dez' ELSE 'Não informado' END AS periodo_sazonal,
       fase_pandemia, fase, ano * 100 + mes AS ano_mes_int, count(*) AS registros
FROM julgado GROUP BY ALL
""",
    "title_case": f"""
SELECT *, {TITLE} AS titulo FROM (
  SELECT o_orderpriority AS texto, count(*) AS registros, 'prioridade' AS origem
  FROM orders GROUP BY ALL
  UNION ALL SELECT p_name, count(*), 'produto' FROM part GROUP BY ALL
  UNION ALL SELECT r_name, count(*), 'regiao'
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
""",
    "fixed_sample": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
ORDER BY md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                       CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_returnflag, '42')),
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag
LIMIT 1000
""",
    "missing_months": """
SELECT ano_mes, cod_municipio, (SELECT count(*) FROM integrado j
         WHERE j.ano_mes IS NOT DISTINCT FROM f.ano_mes
           AND j.cod_municipio IS NOT DISTINCT FROM f.cod_municipio) AS registros
FROM (SELECT ano_mes, cod_municipio FROM integrado
      EXCEPT SELECT ano_mes, cod_municipio FROM integrado WHERE tipo_mov IN (1, -1)) f
""",
    "missing_files": """
SELECT upper(nome) AS stem, nome || '.7z' AS nome, upper(nome) || '.parquet' AS arquivo_saida,
       CAST(0 AS BIGINT) AS aceitos
FROM (
  SELECT 'movimento_' || strftime(ano_mes, '%Y%m') || '_' || coalesce(sigla_uf, 'x') AS nome
  FROM (SELECT ano_mes, sigla_uf FROM julgado EXCEPT SELECT ano_mes, sigla_uf FROM limpo))
WHERE nome IS NOT NULL
""",
    "domains": """,
valores AS (
  SELECT DISTINCT 'ano' AS dominio, ano AS numero, CAST(NULL AS VARCHAR) AS texto FROM limpo
  UNION SELECT 'mes', mes, NULL FROM limpo
  UNION SELECT 'setor', NULL, setor FROM limpo
  UNION SELECT 'sigla_uf', NULL, sigla_uf FROM limpo
)
SELECT dominio, coalesce(CAST(numero AS VARCHAR), texto) AS valor,
       coalesce(CAST(min(numero) OVER w AS VARCHAR), min(texto) OVER w) AS minimo,
       coalesce(CAST(max(numero) OVER w AS VARCHAR), max(texto) OVER w) AS maximo
FROM valores WHERE coalesce(CAST(numero AS VARCHAR), texto) IS NOT NULL
WINDOW w AS (PARTITION BY dominio)
""",
    "drifted_union": """
SELECT CAST(year(l_shipdate) AS INT) AS ano,
       CASE WHEN l_linestatus = 'O' THEN 'Masculino' ELSE 'Não identificado' END AS sexo,
       count(*) AS registros,
       count(*) FILTER (WHERE l_returnflag IN ('A', 'R')) AS com_movimento,
       count(*) FILTER (WHERE l_linestatus = 'O' AND l_extendedprice IS NOT NULL) AS com_salario,
       CAST(sum(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN -1 END) AS BIGINT) AS saldo
FROM lineitem GROUP BY ALL
""",
    "base_cube_rollups": """
SELECT 'agg_saldo_uf' AS tabela, ano, CAST(NULL AS INT) AS mes, sigla_uf,
       CAST(NULL AS VARCHAR) AS setor, saldo FROM por_uf
UNION ALL SELECT 'agg_setor_ano', ano, NULL, NULL, setor, saldo FROM por_setor
UNION ALL SELECT 'agg_mes_ano', ano, mes, NULL, NULL, saldo FROM mensal
""",
    "parse_movement_codes": """
SELECT campo, count(*) - count(valor) AS nulos, count(valor) AS validos,
       coalesce(sum(valor), 0) AS soma
FROM (SELECT 'prioridade' AS campo, TRY_CAST(o_orderpriority AS DOUBLE) AS valor FROM orders
      UNION ALL SELECT 'prioridade_inicial', TRY_CAST(left(o_orderpriority, 1) AS DOUBLE) FROM orders
      UNION ALL SELECT 'quantidade', TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) FROM lineitem
      UNION ALL SELECT 'competencia', CASE WHEN l_quantity BETWEEN 1 AND 12 AND l_shipdate IS NOT NULL
                                           THEN CAST(l_quantity AS DOUBLE) END FROM lineitem)
GROUP BY campo
""",
    "flatten_nested": """
SELECT CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 19 THEN CAST(c_custkey AS VARCHAR)
            ELSE lpad(CAST(c_custkey AS VARCHAR), 19, '0') END AS cod_municipio,
       coalesce(c_name, '') AS nome_municipio, coalesce(sigla_uf, '') AS sigla_uf,
       coalesce(nome_uf, '') AS nome_uf, coalesce(regiao_bruta, '') AS regiao
FROM customer LEFT JOIN ufs ON c_nationkey = n_nationkey
""",
    "monthly_record_counts": """
SELECT ano_mes, registros, CAST(sum(registros) OVER (ORDER BY ano_mes NULLS FIRST) AS BIGINT) AS acumulado
FROM (SELECT ano_mes, count(*) AS registros FROM integrado GROUP BY ano_mes)
""",
    "transformed_profile": """
SELECT ano, CASE tipo_mov WHEN 1 THEN 'Admissão' ELSE 'Desligamento' END AS tipo_mov_label,
       'T' || quarter(ano_mes) AS trimestre, ano || '-T' || quarter(ano_mes) AS ano_trimestre,
       regiao,
       CASE regiao WHEN 'Africa' THEN 1 WHEN 'America' THEN 2 WHEN 'Asia' THEN 3
                   WHEN 'Europe' THEN 4 WHEN 'Middle East' THEN 5 ELSE 0 END AS regiao_cod_num,
       sexo, CASE sexo WHEN 'Masculino' THEN 0 WHEN 'Feminino' THEN 1 ELSE -1 END AS sexo_cod,
       CASE quarter(ano_mes) WHEN 1 THEN 'Jan-Mar' WHEN 2 THEN 'Abr-Jun' WHEN 3 THEN 'Jul-Set'
            WHEN 4 THEN 'Out-Dez' ELSE 'Não informado' END AS periodo_sazonal,
       fase_pandemia, count(*) AS registros, CAST(sum(tipo_mov) AS BIGINT) AS saldo,
       min(ano * 100 + mes) AS primeiro_mes, max(ano * 100 + mes) AS ultimo_mes
FROM limpo GROUP BY ALL
""",
    "delimited_months": """
SELECT ano_mes, count(*) AS registros,
       count(*) FILTER (WHERE sexo_bruto = 'O' AND cod_municipio IS NOT NULL) AS com_municipio,
       CAST(sum(tipo_mov) AS BIGINT) AS saldo
FROM integrado GROUP BY ano_mes
""",
    "incremental_month": "SELECT ano, mes, ano_mes, saldo FROM mensal",
    "combined_parts": """
SELECT arquivo, registros, CAST(sum(registros) OVER (ORDER BY arquivo) AS BIGINT) AS acumulado, com_salario
FROM (SELECT CASE WHEN sexo_bruto = 'O' THEN 'lote_a' ELSE 'lote_b' END AS arquivo, count(*) AS registros,
             count(salario) FILTER (WHERE sexo_bruto = 'O') AS com_salario
      FROM integrado GROUP BY 1)
""",
}
BODIES["rebuilt_balances"] = BODIES["republished_months"] = BODIES["base_cube_rollups"]
BODIES["streamed_tables"] = """,
medias AS (
  SELECT ano, mes, ano_mes, saldo, CASE WHEN count(*) OVER w = 3 THEN avg(saldo) OVER w END AS media
  FROM mensal WINDOW w AS (ORDER BY ano_mes ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
),
extremos AS (
  SELECT setor, CAST(coalesce(sum(saldo) FILTER (WHERE ano = 1995), 0) AS BIGINT) AS saldo_base,
         CAST(coalesce(sum(saldo) FILTER (WHERE ano = 2001), 0) AS BIGINT) AS saldo
  FROM por_setor WHERE ano IN (1995, 2001) GROUP BY setor
),
tabelas AS (
  SELECT 'agg_saldo_mensal' AS tabela, ano, mes, ano_mes, saldo, media AS indice FROM medias
  UNION ALL BY NAME SELECT 'agg_saldo_uf' AS tabela, ano, sigla_uf, saldo FROM por_uf
  UNION ALL BY NAME SELECT 'agg_saldo_fase' AS tabela, fase_pandemia, setor, saldo FROM por_fase
  UNION ALL BY NAME SELECT 'agg_municipios' AS tabela, ano, nome_municipio, sigla_uf, regiao, saldo FROM por_municipio
  UNION ALL BY NAME SELECT 'agg_setor_ano' AS tabela, ano, setor, saldo FROM por_setor
  UNION ALL BY NAME SELECT 'agg_mes_ano' AS tabela, ano, mes, saldo FROM mensal
  UNION ALL BY NAME SELECT 'agg_crescimento_setor' AS tabela, setor, saldo, saldo_base,
         round_even((saldo - saldo_base) / CAST(coalesce(nullif(abs(saldo_base), 0), 1) AS DOUBLE)
                    * 100, 1) AS indice FROM extremos
)
SELECT tabela, ano, mes, ano_mes, nome_municipio, sigla_uf, regiao, fase_pandemia, setor, saldo, saldo_base, indice
FROM tabelas
"""
BODIES["merged_sample"] = BODIES["fixed_sample"]
BODIES["colocated_municipalities"] = BODIES["municipality_years"]
BODIES["footer_ranges"] = "UNION ALL ".join(
    f"SELECT '{name}' AS tabela, count(*) AS registros, min({key}) AS minimo, max({key}) AS maximo FROM {name}\n"
    for name, key in (
        ("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"),
    )
)


def oracle_sql() -> dict[str, str]:
    """One SQL text per registered query."""
    return {name: BASE + body for name, body in BODIES.items()}
