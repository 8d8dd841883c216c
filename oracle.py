"""The registered queries as DuckDB SQL over the raw tables, one text per query.

They start from the raw tables and share no step with the Spark side. Ratios are rounded
in whole-number arithmetic, so a value that ends in an exact half rounds as a decimal does.
"""

from __future__ import annotations

# One row per line item in canonical columns, as sources/tables.py defines it.
SALES = """
lines AS (
    SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
        l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag,
        l_linestatus) AS row_id
    FROM lineitem
),
sales AS (
    SELECT row_id,
        CAST(o_orderkey AS VARCHAR) AS order_id,
        CAST(o_orderdate AS DATE) AS order_date,
        CAST(l_shipdate AS DATE) AS ship_date,
        o_orderpriority AS ship_mode,
        CAST(c_custkey AS VARCHAR) AS customer_id,
        c_name AS customer_name,
        c_mktsegment AS segment,
        'ALL' AS country,
        'CITY_' || (c_custkey % 10) AS city,
        n_name AS state,
        CASE WHEN c_custkey % 7 IN (0, 1, 2) THEN NULL
             ELSE CAST(10000 + c_custkey % 10 AS VARCHAR) END AS postal_code,
        r_name AS region,
        'P' || p_partkey AS product_id,
        p_type AS category,
        p_brand AS sub_category,
        p_name AS product_name,
        CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(12,4)) AS sales,
        CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_discount AS DECIMAL(6,4)) AS discount,
        CAST(l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice
             AS DECIMAL(12,4)) AS profit,
        l_returnflag, l_linestatus
    FROM lines
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
)
"""

CANONICAL = (
    "row_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, "
    "country, city, state, postal_code, region, product_id, category, sub_category, "
    "product_name, CAST(sales AS DOUBLE) AS sales, CAST(quantity AS BIGINT) AS quantity, "
    "CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit"
)
ROW_MARGIN = (
    "CAST(CASE WHEN sales <> 0 THEN round(CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) * 100, 4)"
    " ELSE 0 END AS DOUBLE)"
)


def _units(expression: str) -> str:
    """A sum of DECIMAL(.,4) as a whole number of ten-thousandths."""
    return f"CAST({expression} * 10000 AS HUGEINT)"


def _half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator in hundredths, half away from zero, as DOUBLE."""
    n, d = f"({numerator}) * 100", f"({denominator})"
    size = f"((2 * abs({n}) + {d}) // (2 * {d}))"
    return f"CAST(sign({numerator}) * {size} AS DOUBLE) / 100"


MARGIN = (
    "CASE WHEN sum(sales) > 0 THEN "
    + _half_up(f"{_units('sum(profit)')} * 100", _units("sum(sales)"))
    + " ELSE 0.0 END"
)
TICKET = _half_up(_units("sum(sales)"), "count(*) * 10000")


def _sum(column: str, name: str) -> str:
    kind = "BIGINT" if column == "quantity" else "DOUBLE"
    return f"CAST(sum({column}) AS {kind}) AS {name}"


MONTHS = (
    "['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', "
    "'Setembro', 'Outubro', 'Novembro', 'Dezembro']"
)
WEEKDAYS = "['Segunda', 'Terça', 'Quarta', 'Quinta', 'Sexta', 'Sábado', 'Domingo']"


def _calendar(day: str) -> str:
    return f"""
        CAST(day({day}) AS BIGINT) AS dia, CAST(month({day}) AS BIGINT) AS mes,
        CAST(year({day}) AS BIGINT) AS ano, CAST(quarter({day}) AS BIGINT) AS trimestre,
        CAST((month({day}) + 5) // 6 AS BIGINT) AS semestre,
        {MONTHS}[month({day})] AS nome_mes, 'Q' || quarter({day}) AS nome_trimestre,
        strftime({day}, '%Y-%m') AS ano_mes, CAST(isodow({day}) - 1 AS BIGINT) AS dia_semana,
        {WEEKDAYS}[isodow({day})] AS nome_dia_semana
    """


MONTH = "strftime(order_date, '%Y-%m')"
MONTH_COLUMNS = (
    f"{MONTH} AS ano_mes, CAST(year(order_date) AS BIGINT) AS ano, "
    f"CAST(month(order_date) AS BIGINT) AS mes, {MONTHS}[month(order_date)] AS nome_mes"
)

DIMENSIONS = """
seen AS (
    SELECT DISTINCT unnest([order_date, ship_date]) AS data FROM sales
),
tempo AS (SELECT row_number() OVER (ORDER BY data) AS sk_tempo, data FROM seen),
produto AS (
    SELECT row_number() OVER (ORDER BY first_row) AS sk_produto, * FROM (
        SELECT product_id, arg_min(product_name, row_id) AS nome_produto,
               arg_min(category, row_id) AS categoria,
               arg_min(sub_category, row_id) AS subcategoria, min(row_id) AS first_row
        FROM sales GROUP BY product_id)
),
cliente AS (
    SELECT row_number() OVER (ORDER BY first_row) AS sk_cliente, * FROM (
        SELECT customer_id, arg_min(customer_name, row_id) AS nome_cliente,
               arg_min(segment, row_id) AS segmento, min(row_id) AS first_row
        FROM sales GROUP BY customer_id)
),
localizacao AS (
    SELECT row_number() OVER (ORDER BY min(row_id)) AS sk_localizacao, country AS pais,
           region AS regiao, state AS estado, city AS cidade, postal_code AS cep
    FROM sales GROUP BY ALL
),
envio AS (
    SELECT row_number() OVER (ORDER BY min(row_id)) AS sk_envio, ship_mode
    FROM sales GROUP BY ship_mode
)
"""


def _on_sales(body: str) -> str:
    return f"WITH {SALES} {body}"


def _on_star(body: str, more: str = "") -> str:
    return f"WITH {SALES}, {DIMENSIONS} {more} {body}"


def _report(by: str, measures: list[str], where: str = "", tail: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = "GROUP BY ALL" if by else ""
    return _on_sales(f"SELECT {keys}{', '.join(measures)} FROM sales {where} {group} {tail}")


SUBCATEGORY = "category AS categoria, sub_category AS subcategoria"
PRODUCT = f"product_name AS nome_produto, {SUBCATEGORY}"
STATE = "region AS regiao, state AS estado"
RECEITA, LUCRO = _sum("sales", "receita"), _sum("profit", "lucro")
MARGEM = f"{MARGIN} AS margem"
VIEW_TOTALS = [
    _sum("sales", "receita_total"), _sum("profit", "lucro_total"),
    _sum("quantity", "quantidade_vendida"), f"{MARGIN} AS margem_lucro_pct",
]
ORDERS = "count(DISTINCT order_id)"
CUSTOMERS = "count(DISTINCT customer_id)"
KPI = [
    "CAST(coalesce(sum(sales), 0) AS DOUBLE) AS receita",
    "CAST(coalesce(sum(profit), 0) AS DOUBLE) AS lucro",
    "CAST(coalesce(sum(quantity), 0) AS BIGINT) AS itens",
    MARGEM,
]
# The filter of the *_filtered queries; __spark_entry__ uses the same values.
CHOSEN = (
    "WHERE segment IN ('BUILDING', 'MACHINERY') AND region IN ('ASIA', 'EUROPE', 'AMERICA') "
    "AND category IN ('ECONOMY', 'PROMO', 'LARGE') AND year(order_date) IN (1996, 1997, 1998)"
)


def _top(by: str, measures: list[str], order: str, count: int, where: str = "") -> str:
    return _report(by, measures, where, f"ORDER BY {order} LIMIT {count}")


def _habits(where: str = "") -> str:
    return _report(
        f"segment AS tipo_cliente, {MONTH} AS ano_mes",
        [f"{ORDERS} AS pedidos", f"{CUSTOMERS} AS clientes", _sum("quantity", "itens"),
         f"{TICKET} AS ticket_medio", RECEITA],
        where,
    )


def _states(where: str = "") -> str:
    return _report(STATE, [RECEITA, LUCRO, f"{ORDERS} AS pedidos"], where)


def _monthly(where: str = "") -> str:
    return _report(f"{MONTH} AS ano_mes, segment AS tipo_mercado", [RECEITA, LUCRO, MARGEM], where)


VIEW_ORACLES = {
    "vw_vendas_detalhadas": _on_sales(f"""
        SELECT row_id, order_id, order_date AS data_pedido, {MONTH_COLUMNS},
               ship_date AS data_envio, ship_mode AS modo_envio, customer_id,
               customer_name AS nome_cliente, segment AS tipo_cliente, region AS regiao,
               state AS estado, city AS cidade, country AS pais, product_id, {PRODUCT},
               CAST(sales AS DOUBLE) AS vendas, CAST(quantity AS BIGINT) AS quantidade,
               CAST(discount AS DOUBLE) AS desconto, CAST(profit AS DOUBLE) AS lucro,
               {ROW_MARGIN} AS margem_lucro_pct
        FROM sales"""),
    "vw_receita_lucro_subcategoria": _report(SUBCATEGORY, VIEW_TOTALS),
    "vw_rentabilidade_produto": _report(f"product_id, {PRODUCT}", VIEW_TOTALS),
    "vw_vendas_lucro_estado": _report(
        STATE,
        [_sum("sales", "receita_total"), _sum("profit", "lucro_total"),
         f"{ORDERS} AS total_pedidos", f"{CUSTOMERS} AS clientes_unicos",
         f"{MARGIN} AS margem_lucro_pct"]),
    "vw_habitos_compra_segmento": _report(
        f"segment AS tipo_mercado, {MONTH_COLUMNS}",
        [f"{ORDERS} AS total_pedidos", f"{CUSTOMERS} AS clientes_unicos",
         _sum("quantity", "itens_comprados"), f"{TICKET} AS ticket_medio_item",
         _sum("sales", "receita_total"), _sum("profit", "lucro_total")]),
    "vw_vendas_mensais": _report(f"{MONTH_COLUMNS}, segment AS tipo_mercado", VIEW_TOTALS),
}

ESTADOS_ROLLUP = """
, states AS (
    SELECT region AS regiao, state AS estado, sum(sales) AS receita, sum(profit) AS lucro
    FROM sales GROUP BY ALL
)
SELECT regiao, estado, CAST(grouping(regiao, estado) AS BIGINT) AS nivel,
       CAST(sum(receita) AS DOUBLE) AS receita,
       round(sum(CAST(lucro AS DOUBLE) * CAST(receita AS DOUBLE))
             / nullif(sum(CAST(receita AS DOUBLE)), 0), 2) AS lucro_ponderado
FROM states GROUP BY ROLLUP (regiao, estado)
"""

# A second file: names in capitals, urgent sales under new product ids, no PROMO products.
SECOND_PRODUCTS = """
, again AS (
    SELECT key AS product_id, arg_min(name, row_id) AS nome_produto,
           arg_min(category, row_id) AS categoria, arg_min(sub_category, row_id) AS subcategoria,
           min(row_id) AS first_row
    FROM (SELECT CASE WHEN ship_mode = '1-URGENT' THEN 'X' || product_id ELSE product_id END AS key,
                 upper(product_name) AS name, * FROM sales WHERE category <> 'PROMO')
    GROUP BY key
)
SELECT sk_produto, product_id, coalesce(a.nome_produto, p.nome_produto) AS nome_produto,
       coalesce(a.categoria, p.categoria) AS categoria,
       coalesce(a.subcategoria, p.subcategoria) AS subcategoria
FROM produto p LEFT JOIN again a USING (product_id)
UNION ALL
SELECT (SELECT max(sk_produto) FROM produto) + row_number() OVER (ORDER BY a.first_row),
       product_id, a.nome_produto, a.categoria, a.subcategoria
FROM again a ANTI JOIN produto p USING (product_id)
"""

# A second file one year later: known dates keep their key, new ones follow the last.
SECOND_DATES = f"""
, later AS (
    SELECT DISTINCT unnest([order_date + INTERVAL 365 DAY, ship_date + INTERVAL 365 DAY])::DATE
        AS data FROM sales
),
merged AS (
    SELECT * FROM tempo
    UNION ALL
    SELECT (SELECT max(sk_tempo) FROM tempo) + row_number() OVER (ORDER BY data), data
    FROM later ANTI JOIN tempo USING (data)
)
SELECT sk_tempo, data, {_calendar("data")} FROM merged
"""

FACT = f"""
SELECT row_id AS sk_venda, row_id, order_id, tp.sk_tempo AS sk_tempo_pedido,
       te.sk_tempo AS sk_tempo_envio, sk_produto, sk_cliente, sk_localizacao, sk_envio,
       CAST(sales AS DOUBLE) AS vendas, CAST(quantity AS BIGINT) AS quantidade,
       CAST(discount AS DOUBLE) AS desconto, CAST(profit AS DOUBLE) AS lucro,
       {ROW_MARGIN} AS margem_lucro_pct
FROM sales s
JOIN tempo tp ON tp.data = s.order_date
JOIN tempo te ON te.data = s.ship_date
JOIN produto USING (product_id)
JOIN cliente USING (customer_id)
JOIN envio USING (ship_mode)
JOIN localizacao l ON l.pais = s.country AND l.regiao = s.region AND l.estado = s.state
    AND l.cidade = s.city AND l.cep IS NOT DISTINCT FROM s.postal_code
"""

# The constraints, as names of the quality report.
NOT_NULL = {
    "dim_tempo": "sk_tempo data dia mes ano trimestre semestre nome_mes nome_trimestre ano_mes "
                 "dia_semana nome_dia_semana",
    "dim_produto": "sk_produto product_id nome_produto categoria subcategoria",
    "dim_cliente": "sk_cliente customer_id nome_cliente segmento",
    "dim_localizacao": "sk_localizacao pais regiao estado cidade",
    "dim_envio": "sk_envio ship_mode",
    "fato_vendas": "sk_venda row_id order_id sk_tempo_pedido sk_tempo_envio sk_produto sk_cliente "
                   "sk_localizacao sk_envio vendas quantidade desconto lucro margem_lucro_pct "
                   "ano_pedido",
}
LENGTH = {
    "dim_tempo": "nome_mes nome_trimestre ano_mes nome_dia_semana",
    "dim_produto": "product_id nome_produto categoria subcategoria",
    "dim_cliente": "customer_id nome_cliente segmento",
    "dim_localizacao": "pais regiao estado cidade cep",
    "dim_envio": "ship_mode",
    "fato_vendas": "order_id",
}
UNIQUE = {
    "dim_tempo": ["sk_tempo", "data"],
    "dim_produto": ["sk_produto", "product_id"],
    "dim_cliente": ["sk_cliente", "customer_id"],
    "dim_localizacao": ["sk_localizacao", "pais, regiao, estado, cidade, cep"],
    "dim_envio": ["sk_envio", "ship_mode"],
    "fato_vendas": ["sk_venda", "row_id"],
}
FOREIGN = ["sk_tempo_pedido", "sk_tempo_envio", "sk_produto", "sk_cliente", "sk_localizacao",
           "sk_envio"]


def _quality(violations: str = "CAST(0 AS BIGINT)", rows: str = "n") -> str:
    checks = []
    for table in UNIQUE:
        checks += [(table, f"not_null {table}.{c}") for c in NOT_NULL[table].split()]
        checks += [(table, f"length {table}.{c}") for c in LENGTH[table].split()]
        checks += [(table, f"unique {table}({c})") for c in UNIQUE[table]]
    checks += [("fato_vendas", f"foreign_key fato_vendas.{c}") for c in FOREIGN]
    values = ", ".join(f"('{table}', '{check}')" for table, check in checks)
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n FROM {source}"
        for name, source in [
            ("dim_tempo", "tempo"), ("dim_produto", "produto"), ("dim_cliente", "cliente"),
            ("dim_localizacao", "localizacao"), ("dim_envio", "envio"), ("fato_vendas", "sales"),
        ]
    )
    return _on_star(
        f"""SELECT c.check_name AS "check", {rows} AS rows_checked, {violations} AS violations
            FROM (VALUES {values}) c(name, check_name) JOIN counts USING (name)""",
        f", counts AS ({counts})",
    )


# What the spoiled quality report breaks: see quality_spoiled() in __spark_entry__.
SPOILED_ROWS = "CASE WHEN c.name = 'dim_envio' THEN 2 * n ELSE n END"
SPOILED = """
    CASE WHEN c.check_name IN ('length fato_vendas.order_id', 'not_null fato_vendas.lucro',
                               'foreign_key fato_vendas.sk_produto')
         THEN (SELECT count(*) FROM sales WHERE year(order_date) = 1996)
         WHEN c.check_name LIKE 'unique dim_envio(%' THEN n ELSE 0 END
"""

# A second file: names in capitals, no MACHINERY, buyers of urgent sales under new ids.
SECOND_CUSTOMERS = """
, again AS (
    SELECT key AS customer_id, arg_min(name, row_id) AS nome_cliente,
           arg_min(segment, row_id) AS segmento, min(row_id) AS first_row
    FROM (SELECT CASE WHEN ship_mode = '1-URGENT' THEN 'X' || customer_id ELSE customer_id END AS key,
                 upper(customer_name) AS name, * FROM sales WHERE segment <> 'MACHINERY')
    GROUP BY key
)
SELECT sk_cliente, customer_id, coalesce(a.nome_cliente, c.nome_cliente) AS nome_cliente,
       coalesce(a.segmento, c.segmento) AS segmento
FROM cliente c LEFT JOIN again a USING (customer_id)
UNION ALL
SELECT (SELECT max(sk_cliente) FROM cliente) + row_number() OVER (ORDER BY a.first_row),
       customer_id, a.nome_cliente, a.segmento
FROM again a ANTI JOIN cliente c USING (customer_id)
"""

SECOND_MODES = """
, again AS (
    SELECT CASE WHEN ship_mode IN ('2-HIGH', '5-LOW') THEN 'NEW ' || ship_mode ELSE ship_mode END
               AS ship_mode, min(row_id) AS first_row
    FROM sales GROUP BY 1
)
SELECT * FROM envio
UNION ALL
SELECT (SELECT max(sk_envio) FROM envio) + row_number() OVER (ORDER BY first_row), ship_mode
FROM again ANTI JOIN envio USING (ship_mode)
"""

DIRTY_TEXT = """
SELECT row_id,
       CASE row_id % 7 WHEN 2 THEN '10' WHEN 3 THEN '15' WHEN 5 THEN '01234' END AS postal_code,
       CASE WHEN row_id % 5 <> 4 THEN order_date END AS order_date,
       CAST(0 AS DOUBLE) AS discount,
       CASE WHEN row_id % 5 = 4 THEN 'order_date' END AS problems
FROM sales
"""

LENIENT = """
, good AS (SELECT * FROM sales WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F'))
SELECT 'extracted' AS name, count(*) AS rows FROM sales
UNION ALL SELECT 'loaded', count(*) FROM good
UNION ALL SELECT 'rejected', (SELECT count(*) FROM sales) - count(*) FROM good
UNION ALL SELECT 'dim_tempo', count(DISTINCT d) FROM (
    SELECT unnest([order_date, ship_date]) AS d FROM good)
UNION ALL SELECT 'dim_produto', count(DISTINCT product_id) FROM good
UNION ALL SELECT 'dim_cliente', count(DISTINCT customer_id) FROM good
UNION ALL SELECT 'dim_envio', count(DISTINCT ship_mode) FROM good
UNION ALL SELECT 'dim_localizacao', count(*) FROM (
    SELECT DISTINCT country, region, state, city, postal_code FROM good)
"""

GATES = """
SELECT 'missing columns' AS gate, 'sales, profit' AS found
UNION ALL SELECT 'repeated row ids', CAST(count(*) AS VARCHAR) FROM sales WHERE ship_mode = '5-LOW'
UNION ALL SELECT 'repeated row ids', 'row_id occurs more than once'
UNION ALL SELECT 'unknown members', CAST(count(*) AS VARCHAR) FROM sales JOIN produto USING (product_id)
    WHERE produto.categoria = 'PROMO'
UNION ALL SELECT 'source found', 'second.csv'
UNION ALL SELECT 'ready before create', 'False'
UNION ALL SELECT 'tables after create', '6'
UNION ALL SELECT 'ready after create', 'False'
UNION ALL SELECT 'ready after load', CASE WHEN count(*) > 0 THEN 'True' ELSE 'False' END FROM sales
"""


def _placed(report: str, order: str, by: str = "") -> str:
    return f"SELECT *, row_number() OVER ({by} ORDER BY {order}) AS posicao FROM ({report})"


# What the rejects query spoils: see spoiled() in __spark_entry__.
REJECTED = """
, flags AS (
    SELECT l_returnflag = 'R' AND l_linestatus = 'F' AS no_sales,
           ship_mode = '4-NOT SPECIFIED' AS long_mode,
           segment = 'HOUSEHOLD' AND l_linestatus = 'O' AS bad_date,
           region = 'ASIA' AS no_name,
           category = 'PROMO' AND sales < 20000 AS huge
    FROM sales
)
SELECT "column", count(*) AS rows FROM (
    SELECT unnest(list_filter([
        CASE WHEN no_sales THEN 'sales' END,
        CASE WHEN long_mode THEN 'ship_mode' END,
        CASE WHEN bad_date THEN 'order_date' END,
        CASE WHEN no_name THEN 'customer_name' END,
        CASE WHEN huge THEN 'profit' END,
        CASE WHEN huge AND NOT no_sales THEN 'margem_lucro_pct' END
    ], lambda x: x IS NOT NULL)) AS "column" FROM flags
) GROUP BY "column"
"""

SOURCE_TOTALS = _report(
    "segment, ship_mode, sub_category",
    ["count(*) AS rows", "count(postal_code) AS postal_codes", "min(order_date) AS first_order",
     "max(ship_date) AS last_ship", "max(row_id) AS last_row",
     "CAST(sum(sales) AS DOUBLE) AS sales", "CAST(sum(profit) AS DOUBLE) AS profit",
     "CAST(sum(discount) AS DOUBLE) AS discount", "CAST(sum(quantity) AS BIGINT) AS quantity",
     f"CAST(sum({ROW_MARGIN}::DECIMAL(8,4)) AS DOUBLE) AS margins"])


SUMMARISED = [
    "vw_vendas_lucro_estado", "vw_habitos_compra_segmento", "tab_estados", "tab_habitos",
    "tab_estados_filtered", "tab_subcategorias", "tab_mensal_filtered", "kpi_filtered",
    "modo_envio_rollup",
]


def oracles() -> dict[str, str]:
    queries = {
        "staging_clean": _on_sales(
            f"SELECT {CANONICAL}, {ROW_MARGIN} AS margem_lucro_pct FROM sales"),
        "source_csv_english": SOURCE_TOTALS,
        "source_csv_portuguese": SOURCE_TOTALS,
        "source_csv_mixed": SOURCE_TOTALS,
        "source_csv_malformed": _on_sales("""
            SELECT 'line' AS "column", count(*) AS rows FROM sales
            WHERE l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linestatus = 'F')"""),
        "staging_dirty_text": _on_sales(DIRTY_TEXT),
        "source_xlsx": SOURCE_TOTALS,
        "rejected_rows": _on_sales(REJECTED),
        "dim_tempo": _on_star(f"SELECT sk_tempo, data, {_calendar('data')} FROM tempo"),
        "dim_produto": _on_star("SELECT * EXCLUDE (first_row) FROM produto"),
        "dim_cliente": _on_star("SELECT * EXCLUDE (first_row) FROM cliente"),
        "dim_localizacao": _on_star("SELECT * FROM localizacao"),
        "dim_envio": _on_star("SELECT * FROM envio"),
        "dim_produto_first_wins": _on_sales("""
            SELECT 'P' || (CAST(product_id[2:] AS BIGINT) % 50) AS product_id,
                   arg_min(product_name, row_id) AS nome_produto,
                   arg_min(category, row_id) AS categoria,
                   arg_min(sub_category, row_id) AS subcategoria
            FROM sales GROUP BY 1"""),
        "dim_upsert_type1": _on_star(SECOND_PRODUCTS),
        "dim_upsert_cliente": _on_star(SECOND_CUSTOMERS),
        "dim_envio_second_load": _on_star(SECOND_MODES),
        "dim_produto_late_null": _on_star("SELECT * EXCLUDE (first_row) FROM produto"),
        "dim_tempo_null_dates": _on_sales(f"""
            SELECT row_number() OVER (ORDER BY data) AS sk_tempo, data, {_calendar("data")} FROM (
                SELECT DISTINCT unnest([
                    CASE WHEN row_id % 3 <> 0 THEN order_date END, ship_date]) AS data FROM sales)
            WHERE data IS NOT NULL"""),
        "dim_insert_absent": _on_star(SECOND_DATES),
        "dim_localizacao_rerun": _on_star("SELECT * FROM localizacao"),
        "fato_vendas": _on_star(FACT),
        "fato_vendas_gap_ids": _on_star(FACT.replace(
            "row_id AS sk_venda, row_id,", "row_id AS sk_venda, row_id * 3 + 5 AS row_id,")),
        "load_summary": _on_star("""
            SELECT 'dim_tempo' AS name, count(*) AS rows FROM tempo
            UNION ALL SELECT 'dim_produto', count(*) FROM produto
            UNION ALL SELECT 'dim_cliente', count(*) FROM cliente
            UNION ALL SELECT 'dim_localizacao', count(*) FROM localizacao
            UNION ALL SELECT 'dim_envio', count(*) FROM envio
            UNION ALL SELECT 'fato_vendas', count(*) FROM sales"""),
        "load_summary_lenient": _on_sales(LENIENT),
        "load_gates": _on_star(GATES),
        "tab_subcategorias_order": _placed(
            _report(SUBCATEGORY, [RECEITA, LUCRO]), "receita DESC, categoria, subcategoria"),
        "tab_habitos_order": _placed(_habits(), "ano_mes, tipo_cliente"),
        "tab_estados_order": _placed(_states(), "receita DESC, regiao, estado"),
        "kpi_all": _report("", KPI),
        "kpi_filtered": _report("", KPI, CHOSEN),
        "kpi_empty": _report("", KPI, "WHERE region = 'ATLANTIS'"),
        "kpi_formatted": f"""
            SELECT format('${{:,.2f}}', receita) AS receita, format('${{:,.2f}}', lucro) AS lucro,
                   format('{{:,}}', itens) AS itens, printf('%.2f%%', margem) AS margem
            FROM ({_report("", KPI)})""",
        "tab_subcategorias": _report(SUBCATEGORY, [RECEITA, LUCRO]),
        "subcat_top10": _top(SUBCATEGORY, [RECEITA, LUCRO],
                             "sum(sales) DESC, categoria, subcategoria", 10),
        "subcat_bottom10": _top(SUBCATEGORY, [RECEITA, LUCRO],
                                "sum(sales), categoria, subcategoria", 10),
        "tab_produtos": _report(PRODUCT, [RECEITA, LUCRO, MARGEM]),
        "prod_top15": _top(PRODUCT, [RECEITA, LUCRO, MARGEM],
                           "sum(profit) DESC, nome_produto, categoria, subcategoria", 15),
        "prod_bottom15": _top(PRODUCT, [RECEITA, LUCRO, MARGEM],
                              "sum(profit), nome_produto, categoria, subcategoria", 15),
        "prod_bottom15_filtered": _top(PRODUCT, [RECEITA, LUCRO, MARGEM],
                                       "sum(profit), nome_produto, categoria, subcategoria", 15,
                                       CHOSEN),
        "tab_estados": _states(),
        "tab_estados_filtered": _states(CHOSEN),
        "estados_rollup": _on_sales(ESTADOS_ROLLUP),
        "tab_habitos": _habits(),
        "tab_habitos_filtered": _habits(CHOSEN),
        "ticket_mean_of_means": f"""
            SELECT tipo_cliente, round(avg(ticket_medio), 6) AS ticket_medio
            FROM ({_habits()}) GROUP BY tipo_cliente""",
        "modo_envio": _report("segment AS segmento, ship_mode", ["count(*) AS qtd"]),
        "modo_envio_rollup": _on_sales("""
            SELECT segment AS segmento, ship_mode,
                   CAST(grouping(segment, ship_mode) AS BIGINT) AS nivel, count(*) AS qtd
            FROM sales GROUP BY ROLLUP (segment, ship_mode)"""),
        "tab_mensal": _monthly(),
        "tab_mensal_filtered": _monthly(CHOSEN),
        "filter_options": _on_sales("""
            SELECT 'segmentos' AS tipo, segment AS valor FROM sales GROUP BY ALL
            UNION ALL SELECT 'regioes', region FROM sales GROUP BY ALL
            UNION ALL SELECT 'categorias', category FROM sales GROUP BY ALL
            UNION ALL SELECT 'anos', CAST(ano AS VARCHAR) FROM (
                SELECT DISTINCT year(unnest([order_date, ship_date])) AS ano FROM sales)"""),
        "quality_report": _quality(),
        "quality_report_spoiled": _quality(SPOILED, SPOILED_ROWS),
        "sql_params": _report(
            f"{STATE}, {MONTH} AS ano_mes", [RECEITA, "count(*) AS vendas"],
            "WHERE region = 'EUROPE' AND year(order_date) = 1997"),
    }
    queries["filter_options_order"] = _placed(
        queries["filter_options"], "valor", "PARTITION BY tipo")
    queries.update(VIEW_ORACLES)
    queries.update({f"sql_{name}": text for name, text in VIEW_ORACLES.items()})
    # The same questions answered from stored summaries.
    queries.update({f"resumo_{name}": queries[name] for name in SUMMARISED})
    queries["resumo_distinct_rollup"] = _on_sales("""
        SELECT region AS regiao, state AS estado,
               CAST(grouping(region, state) AS BIGINT) AS nivel,
               count(DISTINCT order_id) AS pedidos, count(DISTINCT customer_id) AS clientes
        FROM sales GROUP BY ROLLUP (region, state)""")
    return queries
