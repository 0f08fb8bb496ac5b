"""The registered questions once more, as DuckDB SQL over the same Parquet tables.

Written from the meaning of each report, mostly with the joins the Spark side avoids. Shared
table roles are CTEs; a query names the ones it needs.
"""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"


def half_up(x: str, digits: int) -> str:
    """Round a double half up the way Spark does, on its decimal digits."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def exact_ratio(a: str, b: str, digits: int) -> str:
    """a / b of non-negative whole numbers, rounded half up without any binary fraction."""
    scale = 10**digits
    return f"CAST((2 * {scale} * CAST({a} AS HUGEINT) + {b}) // NULLIF(2 * ({b}), 0) AS DOUBLE) / {scale}"


def years(days: str, n: str, digits: int = 2) -> str:
    return exact_ratio(f"100 * ({days})", f"36525 * ({n})", digits)


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


_CLASS = "lpad(CAST(1113 + ({}) * 3877 AS VARCHAR), 5, '0')"
_SEVEN = (
    _CLASS.format("(o_orderkey % 50) % 25")
    + " || lpad(CAST((o_orderkey % 50) // 25 + 1 AS VARCHAR), 2, '0')"
)
_ACTIVITY = f"CAST(CAST({_SEVEN} AS INTEGER) AS VARCHAR)"


def _entry(index: str) -> str:
    digits = _CLASS.format(index)
    return f"substr({digits}, 1, 4) || '-' || substr({digits}, 5, 1)"


_STATE = "'U' || lpad(CAST({} AS VARCHAR), 2, '0')"
_COUNTRY = "lpad(CAST({} AS VARCHAR), 3, '0')"

ROLES = {
    "trade": f"""
        SELECT CASE WHEN l_linestatus = 'O' THEN 'EXP' ELSE 'IMP' END AS fluxo,
               CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
               lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS co_ncm,
               CASE WHEN l_linestatus = 'O' THEN {_COUNTRY.format('c_nationkey')}
                    ELSE {_COUNTRY.format('s_nationkey')} END AS co_pais,
               CASE WHEN l_linestatus = 'O' THEN {_STATE.format('s_nationkey')}
                    ELSE {_STATE.format('c_nationkey')} END AS sigla_uf_ncm,
               o_orderpriority AS co_via,
               CAST(l_quantity AS BIGINT) AS kg_liquido,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS vl_fob
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "ex": "SELECT * FROM trade WHERE fluxo = 'EXP'",
    "im": "SELECT * FROM trade WHERE fluxo = 'IMP'",
    "ncm": """
        SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS co_ncm, p_name AS no_ncm_por,
               upper(p_name) AS no_ncm_ing, substr(lpad(CAST(p_partkey AS VARCHAR), 8, '0'), 1, 6) AS co_sh6,
               p_type AS co_fat_agreg, p_brand AS co_cuci_item,
               lpad(CAST(p_size AS VARCHAR), 4, '0') AS co_isic_classe
        FROM part""",
    "pais": f"SELECT {_COUNTRY.format('n_nationkey')} AS co_pais, n_name AS no_pais FROM nation WHERE n_nationkey <> 13",
    "bloco": f"""
        SELECT {_COUNTRY.format('n_nationkey')} AS co_pais, r_name AS no_bloco
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 13
        UNION ALL
        SELECT {_COUNTRY.format('n_nationkey')}, 'BLOCO PAR' FROM nation
        WHERE n_nationkey <> 13 AND n_nationkey % 2 = 0""",
    "uf": f"""
        SELECT {_STATE.format('CASE WHEN n_nationkey = 24 THEN 99 ELSE n_nationkey END')} AS sg_uf, n_name AS no_uf,
               CASE WHEN n_regionkey = 4 THEN 'REGIÃO NÃO DECLARADA' ELSE r_name END AS no_regiao,
               CAST(n_nationkey AS VARCHAR) AS co_uf
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "via": """
        SELECT DISTINCT o_orderpriority AS co_via, substr(o_orderpriority, 3) AS no_via
        FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "price": f"""
        SELECT COALESCE(e.co_ncm, i.co_ncm) AS CO_NCM,
               COALESCE(e.v, 0) AS VL_FOB_EXP, COALESCE(e.k, 0) AS KG_LIQUIDO_EXP,
               COALESCE({half_up(div('e.v', 'e.k'), 2)}, 0) AS PRECO_MEDIO_EXP,
               COALESCE(i.v, 0) AS VL_FOB_IMP, COALESCE(i.k, 0) AS KG_LIQUIDO_IMP,
               COALESCE({half_up(div('i.v', 'i.k'), 2)}, 0) AS PRECO_MEDIO_IMP
        FROM (SELECT co_ncm, CAST(sum(vl_fob) AS BIGINT) AS v, CAST(sum(kg_liquido) AS BIGINT) AS k
              FROM ex GROUP BY co_ncm) e
        FULL JOIN (SELECT co_ncm, CAST(sum(vl_fob) AS BIGINT) AS v, CAST(sum(kg_liquido) AS BIGINT) AS k
                   FROM im GROUP BY co_ncm) i ON e.co_ncm = i.co_ncm""",
    "ranked": """
        SELECT CO_NCM,
               row_number() OVER (ORDER BY VL_FOB_EXP DESC, VL_FOB_IMP DESC, CO_NCM) AS re,
               row_number() OVER (ORDER BY VL_FOB_IMP DESC, VL_FOB_EXP DESC, CO_NCM) AS ri
        FROM price""",
    "base_top": """
        SELECT CO_NCM, CASE WHEN re <= 5 THEN 'EXPORTAÇÃO' ELSE 'IMPORTAÇÃO' END AS origem
        FROM ranked WHERE re <= 5 OR ri <= 5""",
    "extra_top": """
        SELECT CO_NCM, 'EXPORTAÇÃO_EXTRA' AS origem FROM (
            SELECT CO_NCM, row_number() OVER (ORDER BY re) AS n FROM ranked
            WHERE CO_NCM NOT IN (SELECT CO_NCM FROM base_top))
        WHERE n <= 10 - (SELECT count(*) FROM base_top)""",
    "top10": "SELECT * FROM base_top UNION ALL SELECT * FROM extra_top",
    "bridge_file": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS NCM, p_name AS NCM_DESC,
               CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 9 THEN 'abc'
                    WHEN p_size % 10 = 8 THEN ''
                    ELSE {_entry('p_size % 25')} || '; ' || {_entry('(p_size * 7 + 3) % 25')} END AS CNAE
        FROM part""",
    "bridge_rows": """
        SELECT NCM, NCM_DESC,
               NULLIF(regexp_extract(regexp_replace(trim(item), '[.\\-]', '', 'g'), '^(\\d+)', 1), '') AS CNAE
        FROM (SELECT NCM, NCM_DESC, unnest(string_split(CNAE, ';')) AS item
              FROM bridge_file WHERE CNAE IS NOT NULL)""",
    "pairs": "SELECT DISTINCT NCM, CNAE FROM bridge_rows",
    "bridge": """
        SELECT DISTINCT lpad(NCM, 8, '0') AS co_ncm, lpad(CNAE, 5, '0') AS classe
        FROM pairs WHERE CNAE IS NOT NULL""",
    "top_pairs": "SELECT * FROM bridge WHERE co_ncm IN (SELECT CO_NCM FROM top10)",
    "cnaes": f"""
        SELECT DISTINCT {_ACTIVITY} AS codigo_cnae, 'Atividade ' || {_SEVEN} AS descricao_cnae FROM orders""",
    "classes": """
        SELECT substr(lpad(codigo_cnae, 7, '0'), 1, 5) AS codigo_cnae,
               arg_min(descricao_cnae, codigo_cnae) AS descricao_cnae,
               substr(lpad(any_value(codigo_cnae), 7, '0'), 1, 2) AS cnae_divisao,
               count(DISTINCT codigo_cnae) AS qtd_subclasses
        FROM cnaes GROUP BY 1""",
    "empresas": """
        SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS razao_social,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '00' WHEN 'BUILDING' THEN '01'
                    WHEN 'FURNITURE' THEN '03' WHEN 'HOUSEHOLD' THEN '05' ELSE '5' END AS porte_empresa,
               CAST(c_acctbal AS DECIMAL(18,2)) AS capital_social
        FROM customer""",
    "estab": f"""
        SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
               lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS cnpj_ordem,
               lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj_dv,
               CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '2' END AS identificador_matriz_filial,
               'Loja ' || o_orderkey AS nome_fantasia,
               CASE WHEN o_orderstatus = 'O' THEN '02' WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN '2'
                    ELSE '08' END AS situacao_cadastral,
               CAST(o_orderdate AS DATE) AS data_inicio_atividade,
               {_ACTIVITY} AS cnae_fiscal_principal,
               substr({_SEVEN}, 1, 5) AS classe,
               CASE WHEN o_orderkey % 101 <> 0 THEN {_STATE.format('(o_custkey + o_orderkey) % 25')} END AS uf,
               lpad(CAST(o_custkey % 25 AS VARCHAR), 4, '0') AS municipio,
               date_diff('day', CAST(o_orderdate AS DATE), {AS_OF}) AS dias
        FROM orders""",
    "ativas": "SELECT * FROM estab WHERE CAST(situacao_cadastral AS INTEGER) = 2",
    "vol": """
        SELECT classe, sigla_uf_ncm AS uf,
               sum(CASE WHEN fluxo = 'EXP' THEN vl_fob END) AS ve, sum(CASE WHEN fluxo = 'EXP' THEN kg_liquido END) AS ke,
               count(CASE WHEN fluxo = 'EXP' THEN 1 END) AS ne,
               sum(CASE WHEN fluxo = 'IMP' THEN vl_fob END) AS vi, sum(CASE WHEN fluxo = 'IMP' THEN kg_liquido END) AS ki,
               count(CASE WHEN fluxo = 'IMP' THEN 1 END) AS ni
        FROM top_pairs JOIN trade USING (co_ncm) GROUP BY 1, 2""",
    "fato": f"""
        SELECT e.classe AS codigo_cnae, e.uf, lpad(p.porte_empresa, 2, '0') AS codigo_porte,
               count(DISTINCT e.cnpj_basico) AS qtd_empresas,
               count(DISTINCT CASE WHEN identificador_matriz_filial = '1' THEN e.cnpj_basico END) AS qtd_matrizes,
               {years('sum(dias)', 'count(dias)')} AS longevidade_media_anos,
               {years('min(dias)', '1')} AS longevidade_min_anos,
               {years('max(dias)', '1')} AS longevidade_max_anos,
               CAST(COALESCE(max(ve), 0) AS BIGINT) AS volume_exportacao,
               CAST(COALESCE(max(ke), 0) AS BIGINT) AS kg_exportacao,
               CAST(COALESCE(max(ne), 0) AS BIGINT) AS operacoes_exportacao,
               CAST(COALESCE(max(vi), 0) AS BIGINT) AS volume_importacao,
               CAST(COALESCE(max(ki), 0) AS BIGINT) AS kg_importacao,
               CAST(COALESCE(max(ni), 0) AS BIGINT) AS operacoes_importacao
        FROM ativas e JOIN empresas p USING (cnpj_basico)
        LEFT JOIN vol v ON v.classe = e.classe AND v.uf = e.uf
        WHERE e.uf IS NOT NULL AND e.classe IN (SELECT classe FROM top_pairs)
        GROUP BY 1, 2, 3""",
    "porte": """
        SELECT * FROM (VALUES ('00', 'Não Informado'), ('01', 'Microempresa'),
            ('03', 'Empresa de Pequeno Porte'), ('05', 'Demais')) AS t(codigo_porte, descricao_porte)""",
}

_TRADE = ["trade", "ex", "im"]
_TOP = [*_TRADE, "price", "ranked", "base_top", "extra_top", "top10"]
_BRIDGE = ["bridge_file", "bridge_rows", "pairs", "bridge"]
_FACT = [*_TOP, *_BRIDGE, "top_pairs", "empresas", "estab", "ativas", "vol", "fato"]


def with_roles(roles: list[str], body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({ROLES[name].strip()})" for name in roles)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


_TOTALS = "CAST(sum(qtd_empresas) AS BIGINT) AS total_empresas, CAST(sum(qtd_matrizes) AS BIGINT) AS total_matrizes"
_CENTS = "sum(CAST(round(longevidade_media_anos * 100) AS HUGEINT) * qtd_empresas)"
_AGE = exact_ratio(_CENTS, "100 * sum(qtd_empresas)", 2)


def _country(flow: str, value: str) -> str:
    return with_roles([*_TOP, "pais"], f"""
        SELECT no_pais, co_ncm AS produto_ncm, {value}
        FROM (SELECT co_pais, co_ncm, CAST(sum(vl_fob) AS BIGINT) AS {value} FROM {flow}
              WHERE co_ncm IN (SELECT CO_NCM FROM top10) GROUP BY 1, 2) LEFT JOIN pais USING (co_pais)""")


def _route(flow: str, suffix: str) -> str:
    return with_roles([*_TOP, "via"], f"""
        SELECT co_via, co_ncm, kg_{suffix}, vl_fob_{suffix}, no_via AS NO_VIA
        FROM (SELECT co_via, co_ncm, CAST(sum(kg_liquido) AS DOUBLE) AS kg_{suffix},
                     CAST(sum(vl_fob) AS DOUBLE) AS vl_fob_{suffix}
              FROM {flow} WHERE co_ncm IN (SELECT CO_NCM FROM top10) GROUP BY 1, 2)
        LEFT JOIN via USING (co_via)""")


def _factor_share(total_e: str, total_i: str) -> str:
    return with_roles([*_TRADE, "ncm"], f"""
        , e AS (SELECT ano, co_fat_agreg AS f, CAST(sum(vl_fob) AS BIGINT) AS v FROM ex JOIN ncm USING (co_ncm) GROUP BY 1, 2),
        i AS (SELECT ano, co_fat_agreg AS f, CAST(sum(vl_fob) AS BIGINT) AS v FROM im JOIN ncm USING (co_ncm) GROUP BY 1, 2)
        SELECT e.ano AS ANO, e.f AS NO_FAT_AGREG,
               e.v AS VL_FOB_EXP, {half_up('(' + div('e.v', total_e) + ') * 100', 2)} AS PERC_TOTAL_EXP,
               i.v AS VL_FOB_IMP, {half_up('(' + div('i.v', total_i) + ') * 100', 2)} AS PERC_TOTAL_IMP
        FROM e JOIN i ON e.ano = i.ano AND e.f = i.f""")


def _change(v: str) -> str:
    lag = f"lag({v}) OVER w"
    return f"COALESCE({half_up('(' + div(f'{v} - {lag}', lag) + ') * 100', 2)}, 0)"


def _value_coverage(rows: str) -> str:
    share = lambda part: half_up("(" + div(part, "sum(vl_fob)") + ") * 100", 2)
    known, unknown = (
        f"sum(CASE WHEN b.k IS {test} THEN vl_fob ELSE 0 END)" for test in ("NOT NULL", "NULL")
    )
    return with_roles([*_TRADE, "bridge_file", "bridge_rows", "pairs"], f"""
        SELECT {share(known)} AS perc_fob_com_match_ncm, {share(unknown)} AS perc_fob_sem_match_ncm,
               CAST({known} AS DOUBLE) / 1000000000 AS vl_fob_com_match_bilhoes,
               CAST({unknown} AS DOUBLE) / 1000000000 AS vl_fob_sem_match_bilhoes
        FROM ex LEFT JOIN ({rows}) b ON co_ncm = b.k WHERE ano >= 1999""")


_LATEST_LINE = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
            l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
            l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
        FROM {source}) WHERE rn = 1"""


def _latest(source: str) -> str:
    return _LATEST_LINE.format(source=source)


_LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate"
)
_UPSERTED = f"""
    WITH old AS ({_latest("(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')")}),
    new AS ({_latest("(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')")})
    SELECT {_LINE_COLUMNS} FROM old
    WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.l_orderkey = old.l_orderkey AND new.l_linenumber = old.l_linenumber)
    UNION ALL SELECT {_LINE_COLUMNS} FROM new"""

_CUT = "TIMESTAMP '2024-01-15 00:00:00'"

_ORDERS_TYPED = """
    SELECT o_orderkey AS pedido, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS cliente,
           o_orderstatus AS situacao, o_orderpriority AS prioridade,
           CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS valor,
           CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS data
    FROM orders"""
_PARTS = """
    SELECT CAST(p_partkey AS VARCHAR) AS chave, p_name || '; "ação" ' || p_type AS nome, p_brand AS marca
    FROM part"""
_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value"


def _event_files(rows: str) -> str:
    return f"""
        SELECT upper(substr(event_type, 1, 1)) || substr(event_type, 2) || CAST(user_id % 1000 AS VARCHAR) || '.zip'
                   AS table_name, any_value(event_type) AS kind, max(ts) AS modificationTime, count(*) AS size
        FROM events WHERE {rows} GROUP BY 1"""


_LISTED = "'12.3-' || c_custkey || 'x'"
_DAYS = f"date_diff('day', CAST(o_orderdate AS DATE), {AS_OF})"


def oracle_sql() -> dict[str, str]:
    return {
        "monthly_balance": with_roles(_TRADE, """
            SELECT make_date(COALESCE(e.ano, i.ano), COALESCE(e.mes, i.mes), 1) AS DATA,
                   e.v AS VL_FOB_EXP, i.v AS VL_FOB_IMP, e.v - i.v AS VL_SALDO_COMERCIAL
            FROM (SELECT ano, mes, CAST(sum(vl_fob) AS BIGINT) AS v FROM ex GROUP BY 1, 2) e
            FULL JOIN (SELECT ano, mes, CAST(sum(vl_fob) AS BIGINT) AS v FROM im GROUP BY 1, 2) i
            ON e.ano = i.ano AND e.mes = i.mes"""),
        "yearly_totals": with_roles(_TRADE, """
            SELECT ano AS ANO, CAST(sum(CASE WHEN fluxo = 'EXP' THEN vl_fob END) AS BIGINT) AS VL_FOB_EXP,
                   CAST(sum(CASE WHEN fluxo = 'IMP' THEN vl_fob END) AS BIGINT) AS VL_FOB_IMP
            FROM trade GROUP BY 1"""),
        "factor_share": _factor_share("(SELECT sum(v) FROM e)", "(SELECT sum(v) FROM i)"),
        "factor_share_within_year": _factor_share(
            "(SELECT sum(v) FROM e x WHERE x.ano = e.ano)", "(SELECT sum(v) FROM i x WHERE x.ano = i.ano)"
        ),
        "product_price": with_roles([*_TRADE, "price"], "SELECT * FROM price"),
        "product_mom": with_roles(_TRADE, f"""
            , m AS (SELECT ano, mes, co_ncm AS CO_NCM,
                       CAST(sum(CASE WHEN fluxo = 'EXP' THEN vl_fob END) AS BIGINT) AS e,
                       CAST(sum(CASE WHEN fluxo = 'IMP' THEN vl_fob END) AS BIGINT) AS i
                   FROM trade GROUP BY 1, 2, 3)
            SELECT make_date(ano, mes, 1) AS DATA, CO_NCM,
                   COALESCE(e, 0) AS VL_FOB_EXP, {_change('e')} AS VAR_PERC_MES_EXP,
                   COALESCE(i, 0) AS VL_FOB_IMP, {_change('i')} AS VAR_PERC_MES_IMP
            FROM m WINDOW w AS (PARTITION BY CO_NCM ORDER BY ano, mes)"""),
        "top10_refill": with_roles(_TOP, "SELECT CO_NCM, origem FROM top10"),
        "date_dim": with_roles(["trade"], "SELECT DISTINCT ano AS ANO, mes AS MES, make_date(ano, mes, 1) AS DATA FROM trade"),
        "product_dim": with_roles(["ncm"], "SELECT DISTINCT co_ncm AS CO_NCM, no_ncm_por AS NO_NCM_POR FROM ncm"),
        "country_exports": _country("ex", "valor_exportado"),
        "country_imports": _country("im", "valor_importado"),
        "bloc_trade": with_roles([*_TOP, "bloco"], """
            SELECT no_bloco AS NO_BLOCO, co_ncm, CAST(sum(vl_fob) AS BIGINT) AS valor_fob,
                   CASE fluxo WHEN 'EXP' THEN 'EXPORTACAO' ELSE 'IMPORTACAO' END AS tipo_operacao
            FROM trade LEFT JOIN bloco USING (co_pais)
            WHERE co_ncm IN (SELECT CO_NCM FROM top10) GROUP BY no_bloco, co_ncm, fluxo"""),
        "state_balance": with_roles([*_TOP, "uf"], """
            SELECT sigla_uf_ncm, co_ncm, no_uf, no_regiao,
                   CAST(e AS DOUBLE) AS VL_FOB_EXP, CAST(i AS DOUBLE) AS VL_FOB_IMP,
                   CAST(COALESCE(e, 0) - COALESCE(i, 0) AS DOUBLE) AS SALDO_COMERCIAL
            FROM (SELECT sigla_uf_ncm, co_ncm, sum(vl_fob) AS e FROM ex GROUP BY 1, 2)
            FULL JOIN (SELECT sigla_uf_ncm, co_ncm, sum(vl_fob) AS i FROM im GROUP BY 1, 2) USING (sigla_uf_ncm, co_ncm)
            LEFT JOIN uf ON sg_uf = sigla_uf_ncm WHERE co_ncm IN (SELECT CO_NCM FROM top10)"""),
        "route_exports": _route("ex", "exp"),
        "route_imports": _route("im", "imp"),
        "class_dim": with_roles(["cnaes", "classes"], "SELECT * FROM classes"),
        "company_fact": with_roles(_FACT, "SELECT * FROM fato"),
        "top_product_dim": with_roles([*_TOP, "ncm"], """
            SELECT top10.CO_NCM AS co_ncm, no_ncm_por AS descricao_ncm
            FROM top10 LEFT JOIN ncm ON ncm.co_ncm = top10.CO_NCM"""),
        "top_bridge": with_roles([*_TOP, *_BRIDGE, "top_pairs"], "SELECT co_ncm, classe AS codigo_cnae FROM top_pairs"),
        "companies_by_state": with_roles([*_FACT, "uf"], f"""
            SELECT codigo_cnae, fato.uf, no_uf, no_regiao, {_TOTALS}, {_AGE} AS longevidade_media
            FROM fato JOIN uf ON fato.uf = sg_uf GROUP BY 1, 2, 3, 4"""),
        "size_profile": with_roles([*_FACT, "porte"], f"""
            SELECT codigo_cnae, codigo_porte, descricao_porte, {_TOTALS}
            FROM fato JOIN porte USING (codigo_porte) GROUP BY 1, 2, 3"""),
        "top_classes_by_region": with_roles([*_FACT, "uf", "cnaes", "classes"], f"""
            SELECT codigo_cnae, nome_classe_cnae, cnae_divisao, no_regiao, total_empresas, total_matrizes,
                   longevidade_media, CAST(ranking AS INTEGER) AS ranking
            FROM (SELECT *, row_number() OVER (PARTITION BY no_regiao ORDER BY total_empresas DESC, codigo_cnae) AS ranking
                  FROM (SELECT codigo_cnae, descricao_cnae AS nome_classe_cnae, cnae_divisao, no_regiao, {_TOTALS},
                               {_AGE} AS longevidade_media
                        FROM fato JOIN uf ON fato.uf = sg_uf JOIN classes USING (codigo_cnae)
                        WHERE no_regiao <> 'REGIÃO NÃO DECLARADA' GROUP BY 1, 2, 3, 4))
            WHERE ranking <= 10"""),
        "class_age": with_roles([*_FACT, "cnaes", "classes"], f"""
            SELECT codigo_cnae, nome_classe_cnae, cnae_divisao, media AS longevidade_media_anos,
                   total_empresas, total_matrizes,
                   CASE WHEN centavos >= 2000 * total_empresas THEN 'Setor Maduro (20+ anos)'
                        WHEN centavos >= 1000 * total_empresas THEN 'Setor Estabelecido (10-20 anos)'
                        WHEN centavos >= 500 * total_empresas THEN 'Setor Emergente (5-10 anos)'
                        ELSE 'Setor Novo (< 5 anos)' END AS classificacao_maturidade,
                   volume_exportacao_total, volume_importacao_total
            FROM (SELECT codigo_cnae, descricao_cnae AS nome_classe_cnae, cnae_divisao, {_AGE} AS media, {_CENTS} AS centavos, {_TOTALS},
                         CAST(sum(volume_exportacao) AS BIGINT) AS volume_exportacao_total,
                         CAST(sum(volume_importacao) AS BIGINT) AS volume_importacao_total
                  FROM fato JOIN classes USING (codigo_cnae) GROUP BY 1, 2, 3)"""),
        "company_dim": with_roles(["empresas", "estab"], """
            SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj_completo,
                   razao_social, nome_fantasia, CAST(cnae_fiscal_principal AS INTEGER) AS co_cnae, uf,
                   'Cidade ' || n_name AS municipio, porte_empresa, CAST(capital_social AS DOUBLE) AS capital_social,
                   CAST(situacao_cadastral AS INTEGER) AS situacao_cadastral, data_inicio_atividade
            FROM estab LEFT JOIN empresas USING (cnpj_basico)
            LEFT JOIN nation ON CAST(municipio AS INTEGER) = n_nationkey AND n_nationkey <> 13"""),
        "product_dim_wide": with_roles(["ncm"], """
            SELECT co_ncm, no_ncm_por, co_isic_classe,
                   CASE WHEN p_size <> 50 THEN 'Classe ' || p_size END AS no_isic_classe,
                   CASE WHEN p_size <> 50 THEN 'Seção ' || (p_size % 5) END AS no_isic_secao,
                   'Grupo ' || co_cuci_item AS no_cuci_grupo
            FROM ncm JOIN part ON co_ncm = lpad(CAST(p_partkey AS VARCHAR), 8, '0')"""),
        "opportunities": with_roles([*_TOP, *_BRIDGE, "top_pairs", "estab", "ativas", "ncm"], f"""
            SELECT no_ncm_por AS desc_ncm, total_exportado,
                   qtd_empresas_habilitadas, longevidade_media_anos
            FROM (SELECT co_ncm, total_exportado, count(DISTINCT cnpj_basico) AS qtd_empresas_habilitadas,
                         {exact_ratio('sum(dias)', '365 * count(dias)', 1)} AS longevidade_media_anos
                  FROM (SELECT co_ncm, CAST(sum(vl_fob) AS BIGINT) AS total_exportado FROM ex
                        WHERE co_ncm IN (SELECT CO_NCM FROM top10) GROUP BY 1)
                  JOIN top_pairs USING (co_ncm) JOIN ativas USING (classe) GROUP BY 1, 2)
            LEFT JOIN ncm USING (co_ncm)"""),
        "bridge_code_coverage": with_roles([*_TRADE, "bridge_file", "bridge_rows", "pairs"], f"""
            , codes AS (SELECT DISTINCT co_ncm AS k FROM ex),
            known AS (SELECT lpad(NCM, 8, '0') AS k, count(*) AS n FROM pairs GROUP BY 1)
            SELECT 'Cobertura de Produtos (NCMs)' AS Metrica,
                   {half_up('(' + div('(SELECT count(*) FROM codes WHERE k IN (SELECT k FROM known))',
                                      '(SELECT count(*) FROM codes)') + ') * 100', 2)} AS Valor,
                   'Alta' AS Status
            UNION ALL
            SELECT 'Média de CNAEs por Produto', {half_up('(SELECT avg(n) FROM known)', 2)}, 'Complexidade N:N'"""),
        "bridge_value_coverage": _value_coverage("SELECT DISTINCT lpad(NCM, 8, '0') AS k FROM pairs"),
        "bridge_value_coverage_weighted": _value_coverage("SELECT lpad(NCM, 8, '0') AS k FROM pairs"),
        "state_dim": with_roles(["uf"], "SELECT DISTINCT sg_uf, no_uf, no_regiao, co_uf FROM uf"),
        "product_labels": with_roles(["ncm"], "SELECT DISTINCT co_ncm, no_ncm_por, no_ncm_ing, co_sh6, co_fat_agreg FROM ncm"),
        "bridge_explode": with_roles(["bridge_file", "bridge_rows"], "SELECT NCM, NCM_DESC, CNAE FROM bridge_rows"),
        # An empty field of a file is read as null.
        "bridge_from_file": with_roles(["bridge_file", "bridge_rows"], """
            SELECT NCM, NCM_DESC, CNAE FROM bridge_rows
            WHERE NCM NOT IN (SELECT NCM FROM bridge_file WHERE CNAE = '')"""),
        "dedup_latest": f"SELECT {_LINE_COLUMNS} FROM ({_latest('lineitem')})",
        "upsert_scd1": _UPSERTED,
        "upsert_table_scd1": _UPSERTED,
        "upsert_bucketed": _UPSERTED,
        "stream_upsert": f"SELECT {_LINE_COLUMNS} FROM ({_latest('lineitem')})",
        "upsert_accumulate": f"""
            SELECT event_type AS table_name, max(ts) AS last_ingestion_timestamp, max(ts) AS last_update,
                   count(*) AS records_processed, CASE WHEN max(ts) > {_CUT} THEN 'run-2' ELSE 'run-1' END AS execution_id
            FROM events GROUP BY 1""",
        "upsert_newer_only": f"SELECT {_LINE_COLUMNS} FROM ({_latest('lineitem')})",
        "silver_incremental": _UPSERTED,
        "silver_report": """
            SELECT execucao, 'linhas' AS table_name, CASE execucao WHEN 'run-1' THEN 'created' ELSE 'updated' END AS status,
                   count(*) AS records
            FROM (SELECT DISTINCT l_orderkey, l_linenumber,
                         CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 'run-1' ELSE 'run-2' END AS execucao FROM lineitem)
            GROUP BY 1
            UNION ALL SELECT 'run-1', 'ausente', 'failed', 0 UNION ALL SELECT 'run-2', 'ausente', 'failed', 0""",
        "silver_control": """
            SELECT 'linhas' AS table_name, date_diff('day', DATE '1970-01-01', DATE '2024-02-01')::INTEGER AS dia,
                   count(*) AS records_processed, 'run-2' AS execution_id
            FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate < TIMESTAMP '1999-01-01' FROM lineitem)""",
        "stream_once": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "latest_control": """
            SELECT event_type AS table_name, arg_max(event_id, (ts, event_id)) AS execucao, max(ts) AS last_update
            FROM events GROUP BY 1""",
        "country_exports_top": _country("ex", "valor_exportado")
            + " ORDER BY valor_exportado DESC, produto_ncm, no_pais NULLS FIRST LIMIT 10",
        "typed_mapping": _ORDERS_TYPED,
        "delimited_headered": _ORDERS_TYPED,
        "delimited_headerless": _PARTS,
        "positional_names": _PARTS,
        "archive_expand": _PARTS,
        "binary_scan": "SELECT CAST(p_partkey AS VARCHAR) AS chave, true AS completo FROM part",
        "dimension_load": """
            SELECT CAST(n_nationkey AS VARCHAR) AS N_NATIONKEY, n_name AS N_NAME,
                   CASE WHEN n_nationkey % 2 = 1 THEN CAST(n_regionkey AS VARCHAR) END AS N_REGIONKEY, 'loaded' AS status
            FROM nation""",
        "register_load": """
            SELECT CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) END AS codigo_motivo,
                   CASE WHEN p_partkey % 2 = 0 THEN p_name || '; "ação" ' || p_type END AS descricao_motivo,
                   CASE WHEN p_partkey % 2 = 1 THEN CAST(p_partkey AS VARCHAR) END AS _c0,
                   CASE WHEN p_partkey % 2 = 1 THEN p_name || '; "ação" ' || p_type END AS _c1,
                   CASE WHEN p_partkey % 2 = 1 THEN p_brand END AS _c2,
                   'failed, loaded' AS status
            FROM part""",
        "stream_csv_facts": """
            SELECT CAST(year(l_shipdate) AS VARCHAR) AS CO_ANO, lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS CO_MES,
                   lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS CO_NCM, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS KG_LIQUIDO,
                   CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS VARCHAR) AS VL_FOB,
                   CASE WHEN l_returnflag = 'N' THEN l_linestatus END AS SITUACAO
            FROM lineitem""",
        "table_place": "SELECT r_regionkey, true AS na_pasta FROM region",
        "ordered_files": "SELECT o_orderkey, o_custkey, o_totalprice, true AS varios, 0::BIGINT AS sobrepostos FROM orders",
        "lineage_columns": "SELECT o_orderkey, true AS mesma_data, true AS origem FROM orders",
        "changed_files": f"""
            WITH files AS ({_event_files("event_type <> 'error'")}),
            loaded AS ({_event_files("event_type <> 'signup' AND ts <= TIMESTAMP '2024-01-28'")})
            SELECT '/landing/' || table_name AS path, table_name, size, modificationTime, 'CNPJ' AS container_name,
                   kind AS target_table
            FROM files WHERE table_name NOT IN (SELECT table_name FROM loaded WHERE loaded.modificationTime >= files.modificationTime)""",
        "unseen_versions": f"""
            WITH files AS ({_event_files("true")}),
            earlier AS ({_event_files("user_id % 7 > 0 OR event_type <> 'click'")}),
            known AS (SELECT *, CAST(regexp_extract(table_name, '([0-9]+)', 1) AS INTEGER) % 5 AS n FROM earlier)
            SELECT '/landing/' || f.table_name AS path, f.size, f.kind AS target_table
            FROM files f LEFT JOIN known k USING (table_name)
            WHERE k.table_name IS NULL OR k.n IN (1, 2, 4) OR (k.n = 0 AND (k.modificationTime, k.size) <> (f.modificationTime, f.size))
               OR (k.n = 3 AND f.modificationTime > TIMESTAMP '2024-01-28')""",
        "stream_readmitted": """
            SELECT lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS CO_NCM, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS KG_LIQUIDO,
                   CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS VARCHAR) AS VL_FOB, 0::BIGINT AS recusados
            FROM lineitem""",
        "hot_keys": "SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 0.008 * (SELECT count(*) FROM events)",
        "append_partitioned": f"SELECT {_EVENT_COLUMNS}, props FROM events",
        "append_widened": f"SELECT {_EVENT_COLUMNS}, CASE WHEN event_type = 'view' THEN props END AS props FROM events",
        "create_or_append": f"SELECT {_EVENT_COLUMNS}, CASE WHEN event_type = 'view' THEN props END AS props FROM events",
        "replace_and_copy": "SELECT o_orderkey, o_custkey FROM orders",
        "scalar_codes": f"""
            SELECT c_custkey, {_LISTED} AS aparado, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS produto,
                   substr(lpad(CAST(c_custkey * 97 AS VARCHAR), 7, '0'), 1, 5) AS classe,
                   substr(lpad(CAST(c_nationkey AS VARCHAR), 5, '0'), 1, 2) AS divisao,
                   '123' || c_custkey || 'x' AS sem_pontuacao, '123' || c_custkey AS digitos,
                   CASE WHEN c_custkey % 5 = 0 THEN '7' END AS sem_digitos,
                   c_mktsegment || CASE WHEN c_nationkey > 5 THEN c_name ELSE '' END || c_nationkey AS identificador,
                   c_mktsegment || '-' || c_nationkey AS unido, c_mktsegment LIKE 'AUTO%' AS prefixo,
                   lower(c_mktsegment) || c_custkey AS arquivo, lower(c_mktsegment) AS tabela,
                   c_custkey % 5 IN (0, 1, 3) AS ativa, CAST(len(string_split(c_name, '0')) AS INTEGER) AS partes,
                   CASE WHEN c_mktsegment = 'BUILDING' THEN 'nenhum' ELSE c_mktsegment END AS preenchido
            FROM customer""",
        "scalar_numbers": f"""
            SELECT o_orderkey, make_date(year(o_orderdate)::INT, month(o_orderdate)::INT, 1) AS mes,
                   CAST(o_orderdate AS DATE) AS data, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS valor,
                   CAST(o_orderkey AS INTEGER) AS inteiro, CAST(o_orderkey AS BIGINT) AS longo,
                   CAST({_DAYS} AS INTEGER) AS dias, {years(_DAYS, '1')} AS anos,
                   CASE WHEN {years(_DAYS, '1', 4)} * 4 >= 20 THEN 'Setor Maduro (20+ anos)'
                        WHEN {years(_DAYS, '1', 4)} * 4 >= 10 THEN 'Setor Estabelecido (10-20 anos)'
                        WHEN {years(_DAYS, '1', 4)} * 4 >= 5 THEN 'Setor Emergente (5-10 anos)'
                        ELSE 'Setor Novo (< 5 anos)' END AS faixa,
                   {half_up(div('o_totalprice', 'o_orderkey % 4'), 2)} AS razao,
                   {half_up('(' + div('o_orderkey', 'o_custkey % 9') + ') * 100', 2)} AS percentual,
                   {half_up('(' + div('o_orderkey - o_custkey', 'o_custkey') + ') * 100', 2)} AS variacao,
                   o_orderkey * 1000 AS milissegundos
            FROM orders""",
        "incremental_filter": f"SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts > {_CUT}",
        "watermark_advance": f"""
            SELECT event_type AS table_name, max(ts) AS last_ingestion_timestamp,
                   count(*) AS records_processed FROM events WHERE ts > {_CUT} GROUP BY 1""",
    }
