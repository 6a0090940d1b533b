"""Independent SQL for each registered query, for an ANSI engine over the same files.

Where an operator has a clever form, its oracle uses the plain one: stock gaps by category come
from a day-by-day calendar, cohorts from a self-join, duplicates from set arithmetic.
"""

from __future__ import annotations

ADAPTER = """
WITH stores AS (
  SELECT n_nationkey AS store_id, n_name AS store_name, r_name AS country, n_name AS city,
         CASE n_nationkey % 4 WHEN 0 THEN 'HIPERMERCADO' WHEN 1 THEN 'SUPERMERCADO'
              WHEN 2 THEN 'DESCUENTO' ELSE 'EXPRESS' END AS format,
         200 + 137 * n_nationkey AS size_sqm,
         CAST(DATE '1994-01-01' + n_nationkey * INTERVAL '100' DAY AS DATE) AS opening_date, r_name AS region
  FROM nation JOIN region ON r_regionkey = n_regionkey),
vendors AS (
  SELECT s_suppkey AS vendor_id, s_name AS vendor_name, CAST(s_nationkey AS VARCHAR) AS country,
         CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS tier, s_acctbal > 0 AS is_shared_catalog
  FROM supplier),
products AS (
  SELECT p_partkey AS item_id, p_name AS item_name, p_brand AS brand, CASE WHEN p_partkey % 11 = 10 THEN -1 ELSE p_partkey % 10 END AS vendor_id,
         p_type AS category, 'Dep ' || substr(p_type, 1, 3) AS department, p_retailprice * CAST(0.6 AS DOUBLE) AS cost
  FROM part),
transactions AS (
  SELECT o_orderkey AS transaction_id, CASE WHEN o_custkey % 5 < 3 THEN NULL ELSE o_custkey END AS customer_id,
         CAST(o_orderdate AS DATE) AS transaction_date, c_nationkey AS store_id, o_totalprice AS total_amount,
         o_orderpriority AS payment_method, o_custkey % 5 >= 3 AS loyalty_card,
         CASE WHEN o_orderstatus = 'P' THEN 'RETURNED' ELSE 'COMPLETED' END AS status
  FROM orders JOIN customer ON c_custkey = o_custkey),
transaction_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_item_id,
         l_orderkey AS transaction_id, l_partkey AS item_id, CAST(l_quantity AS INT) AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_discount >= 0.08 AS was_on_promo
  FROM lineitem),
store_promotions AS (
  SELECT n_nationkey AS store_id, 'Exhibicion' AS promo_name,
         CASE WHEN n_nationkey % 2 = 0 THEN 'CONTROL' ELSE 'TREATMENT' END AS variant,
         DATE '2000-09-01' AS start_date, DATE '2000-10-12' AS end_date, 'EXHIBICION' AS promo_type
  FROM nation
  UNION ALL
  SELECT n_nationkey, 'Exhibicion', CASE WHEN n_nationkey % 2 = 0 THEN 'TREATMENT' ELSE 'CONTROL' END,
         DATE '2000-09-01', DATE '2000-10-12', 'EXHIBICION'
  FROM nation WHERE n_nationkey IN (8, 17)),
feed AS (
  SELECT event_id AS transaction_id, ts, user_id % 25 AS store_id, value AS total_amount,
         CASE WHEN event_type = 'error' THEN 'RETURNED' ELSE 'COMPLETED' END AS status
  FROM events)
"""

AMT = "CAST(total_amount AS DECIMAL(18,2))"
NET = f"(CASE WHEN status = 'RETURNED' THEN -1 ELSE 1 END * {AMT})"
LINE = "CAST(quantity * unit_price AS DECIMAL(18,4))"
COST = "CAST(quantity * cost AS DECIMAL(18,4))"
WEEK = "CAST(date_trunc('week', transaction_date) AS DATE)"
TS = "'%Y-%m-%d %H:%M:%S.%f'"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def total(expression: str) -> str:
    return f"CAST(SUM({expression}) AS DOUBLE)"


def div(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0))"


def key(*parts: str) -> str:
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    text = " || ".join(f"COALESCE(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts)
    return f"CASE WHEN COALESCE({', '.join(texts)}) IS NOT NULL THEN CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT) END"


SALTED = "sha256('benchmark-salt' || CAST(customer_id AS VARCHAR))"
CUSTOMER_KEY = f"COALESCE(substr({SALTED}, 1, 32), '-1')"

ORACLES: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    """``body`` is either a SELECT, or CTEs that continue the adapter's list."""
    text = body.strip()
    ORACLES[name] = ADAPTER + (text if text.upper().startswith("SELECT") else "," + text)


# ---------------------------------------------------------------- sources, sinks, SQL
oracle("load_csv", """
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(customer_id AS VARCHAR) AS customer_id,
       transaction_date, CAST(store_id AS VARCHAR) AS store_id, total_amount,
       'a "quoted",' || IF(transaction_id % 2 = 0, ' ', chr(10)) || payment_method AS payment_method, loyalty_card, status
FROM transactions""")
oracle("load_csv_bad_rows", """
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, IF(transaction_id % 17 = 0, 'total_amount', '') AS failed
FROM transactions""")
oracle("load_csv_dates", f"""
SELECT transaction_id, transaction_date, status, CASE WHEN status = 'RETURNED' THEN -1 ELSE 1 END AS sign,
       {dbl(NET)} AS net_gmv FROM transactions""")
_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, COUNT(*) AS filas FROM {t}"
    for t in ("stores", "vendors", "products", "transactions", "transaction_items", "store_promotions")
)
oracle("table_counts", _COUNTS)
oracle("load_validation", f"""
SELECT c.tabla, c.filas,
       CASE WHEN c.tabla = 'transactions' THEN (SELECT MIN(transaction_date) FROM transactions) END AS fecha_minima,
       CASE WHEN c.tabla = 'transactions' THEN (SELECT MAX(transaction_date) FROM transactions) END AS fecha_maxima
FROM ({_COUNTS}) c""")
oracle("net_transactions", f"SELECT *, {dbl(NET)} AS ventas_netas FROM transactions")
oracle("item_sales", f"""
SELECT i.transaction_item_id, i.transaction_id, i.item_id, p.item_name, p.category, p.vendor_id, i.quantity,
       i.unit_price, p.cost, i.was_on_promo, {dbl(LINE)} AS ventas_brutas_item, {dbl(COST)} AS costo_item
FROM transaction_items i JOIN products p ON p.item_id = i.item_id""")
oracle("sales_enriched", f"""
SELECT i.*, t.* EXCLUDE (transaction_id), p.* EXCLUDE (item_id),
       s.store_name, s.country AS store_country, s.city, s.format, s.size_sqm, s.opening_date, s.region,
       v.vendor_name, v.country AS vendor_country, v.tier, v.is_shared_catalog,
       {dbl(LINE)} AS line_gmv, {dbl(NET)} AS net_gmv,
       CASE WHEN status = 'RETURNED' THEN -1.0 ELSE 1.0 END * {dbl(LINE)} AS net_line_gmv,
       CASE WHEN status = 'RETURNED' THEN -1.0 ELSE 1.0 END * {dbl(COST)} AS net_cost
FROM transaction_items i JOIN transactions t ON t.transaction_id = i.transaction_id
LEFT JOIN products p ON p.item_id = i.item_id LEFT JOIN stores s ON s.store_id = t.store_id
LEFT JOIN vendors v ON v.vendor_id = p.vendor_id""")
_STORE_DAY = f"""
SELECT transaction_date AS date, s.store_id, s.store_name, s.country, s.format, s.region, s.size_sqm,
       {total(NET)} AS gmv, COUNT(DISTINCT transaction_id) AS tx
FROM transactions t JOIN stores s ON s.store_id = t.store_id
"""
_STORE_DAY_KEYS = " GROUP BY ALL"
oracle("store_day", _STORE_DAY + _STORE_DAY_KEYS)
oracle("store_day_filtered", _STORE_DAY + """ WHERE s.country = 'AMERICA' AND s.format = 'SUPERMERCADO'
  AND transaction_date BETWEEN DATE '2001-01-01' AND DATE '2001-08-01'""" + _STORE_DAY_KEYS)
oracle("store_day_stored", _STORE_DAY + """ WHERE s.country = 'AMERICA' AND s.format = 'SUPERMERCADO'
  AND transaction_date BETWEEN DATE '2001-01-01' AND DATE '2001-08-01'""" + _STORE_DAY_KEYS)
oracle("store_day_quarter", _STORE_DAY + " WHERE quarter(transaction_date) = 2" + _STORE_DAY_KEYS)
oracle("distinct_rollup", f"""
SELECT CAST(strftime(transaction_date, '%Y%m') AS INTEGER) AS month, format, {total(NET)} AS gmv,
       COUNT(DISTINCT transaction_id) AS tickets, COUNT(DISTINCT customer_id) AS customers,
       TRUE AS tickets_within, TRUE AS customers_within
FROM transactions t JOIN stores s ON s.store_id = t.store_id GROUP BY ALL""")
oracle("save_table", _STORE_DAY + _STORE_DAY_KEYS)
oracle("export_json", f"SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM ({_STORE_DAY + _STORE_DAY_KEYS})")
oracle("preview", f"""
SELECT transaction_id, store_id, {dbl(NET)} AS ventas_netas FROM transactions ORDER BY transaction_id LIMIT 20""")
oracle("adhoc_sql", f"""
SELECT country, format, {total(NET)} AS ventas_netas, COUNT(*) AS transacciones
FROM transactions t JOIN stores s ON s.store_id = t.store_id GROUP BY country, format""")

# ---------------------------------------------------------------- data quality
oracle("dq_null_customer", f"""
SELECT COUNT(*) - COUNT(customer_id) AS sin_cliente, COUNT(*) AS total,
       {div('COUNT(*) - COUNT(customer_id)', 'COUNT(*)')} * 100 AS pct FROM transactions""")
oracle("dq_loyalty_consistency", """
SELECT (SELECT COUNT(*) FROM transactions WHERE customer_id IS NULL AND loyalty_card) AS tarjeta_sin_cliente,
       (SELECT COUNT(*) FROM transactions WHERE customer_id IS NOT NULL AND NOT loyalty_card) AS cliente_sin_tarjeta""")
oracle("dq_loyalty_matrix", """
SELECT loyalty_card, IF(customer_id IS NULL, 'SIN_CLIENTE', 'CON_CLIENTE') AS estado_cliente, COUNT(*) AS transacciones
FROM transactions GROUP BY ALL""")
_DELTAS = f"""
deltas AS (
  SELECT t.transaction_id, MAX({AMT}) - SUM({LINE}) AS delta
  FROM transactions t JOIN transaction_items i ON i.transaction_id = t.transaction_id GROUP BY t.transaction_id)
"""
oracle("dq_amount_mismatch", _DELTAS + f"""
SELECT COUNT(*) AS transacciones_con_diferencia, (SELECT COUNT(*) FROM transactions) AS total,
       {div('COUNT(*)', '(SELECT COUNT(*) FROM transactions)')} * 100 AS pct,
       {dbl('MAX(ABS(delta))')} AS diferencia_maxima,
       {div('COUNT(*) FILTER (delta < 0)', 'COUNT(*)')} AS proporcion_negativa
FROM deltas WHERE ABS(delta) > 0.01""")
oracle("dq_duplicate_keys", """
SELECT COUNT(*) - COUNT(DISTINCT transaction_item_id) AS duplicados, COUNT(*) AS total FROM transaction_items""")
oracle("dq_nonpositive_total", """
SELECT COUNT(*) AS transacciones_no_positivas FROM transactions WHERE total_amount <= 0""")
oracle("dq_zero_price_no_promo", """
SELECT COUNT(*) AS items_precio_cero FROM transaction_items WHERE unit_price = 0 AND NOT was_on_promo""")
oracle("dq_orphan_store", """
SELECT COUNT(*) AS huerfanos FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM stores s WHERE s.store_id = t.store_id)""")
oracle("dq_orphan_item", """
SELECT COUNT(*) AS huerfanos FROM transaction_items i
WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.item_id = i.item_id)""")
_LOST_VENDOR = "FROM products p WHERE NOT EXISTS (SELECT 1 FROM vendors v WHERE v.vendor_id = p.vendor_id)"
oracle("dq_orphan_vendor_count", f"SELECT COUNT(*) AS productos_con_vendor_inexistente {_LOST_VENDOR}")
oracle("dq_orphan_vendor_list", f"SELECT item_id, item_name, vendor_id, category {_LOST_VENDOR}")
_SILENT = """
bounds AS (SELECT MIN(transaction_date) AS lo, MAX(transaction_date) AS hi FROM transactions),
calendar AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
absent AS (
  SELECT s.store_id, c.d FROM (SELECT DISTINCT store_id FROM transactions) s CROSS JOIN calendar c
  EXCEPT SELECT store_id, transaction_date FROM transactions),
islands AS (
  SELECT store_id, d, d - CAST(ROW_NUMBER() OVER (PARTITION BY store_id ORDER BY d) AS INT) AS grp FROM absent),
runs AS (
  SELECT store_id, MIN(d) AS s, MAX(d) AS e, COUNT(*) AS n,
         ROW_NUMBER() OVER (PARTITION BY store_id ORDER BY COUNT(*) DESC, MIN(d)) AS place
  FROM islands GROUP BY store_id, grp),
silent AS (
  SELECT store_id, CAST(SUM(n) AS BIGINT) AS missing_days, COUNT(*) AS gap_runs,
         MAX(s) FILTER (place = 1) AS max_gap_start, MAX(e) FILTER (place = 1) AS max_gap_end,
         MAX(n) AS max_gap_days
  FROM runs GROUP BY store_id)
"""
oracle("dq_store_missing_days", _SILENT + "SELECT * FROM silent")
oracle("dq_before_opening", """
SELECT COUNT(*) AS transacciones, COUNT(DISTINCT t.store_id) AS tiendas,
       MIN(transaction_date) AS fecha_minima, MAX(transaction_date) AS fecha_maxima
FROM transactions t JOIN stores s ON s.store_id = t.store_id WHERE transaction_date < opening_date""")
oracle("dq_multi_variant_stores", """
SELECT store_id, COUNT(DISTINCT variant) AS variantes_distintas,
       string_agg(DISTINCT variant, ', ' ORDER BY variant) AS variantes_detectadas
FROM store_promotions GROUP BY store_id HAVING COUNT(DISTINCT variant) > 1""")
oracle("dq_profile", """
SELECT (SELECT MIN(transaction_date) FROM transactions) AS desde, (SELECT MAX(transaction_date) FROM transactions) AS hasta,
       (SELECT COUNT(*) FROM transactions) AS transactions, (SELECT COUNT(*) FROM transaction_items) AS transaction_items,
       (SELECT COUNT(*) FROM stores) AS stores, (SELECT COUNT(*) FROM products) AS products,
       (SELECT COUNT(*) FROM vendors) AS vendors, (SELECT COUNT(*) FROM store_promotions) AS store_promotions""")
oracle("dq_findings", _DELTAS.strip() + "," + _SILENT + f""",
sizes AS (SELECT (SELECT COUNT(*) FROM transactions) AS tx, (SELECT COUNT(*) FROM transaction_items) AS li,
                 (SELECT COUNT(*) FROM products) AS pr, (SELECT COUNT(*) FROM stores) AS st),
early AS (SELECT COUNT(*) AS n, MIN(transaction_date) AS lo, MAX(transaction_date) AS hi
          FROM transactions t JOIN stores s ON s.store_id = t.store_id WHERE transaction_date < opening_date),
dual AS (SELECT store_id FROM store_promotions GROUP BY store_id HAVING COUNT(DISTINCT variant) > 1),
found(dimension, "check", failed, total, detail) AS (
  SELECT 'Completitud', 'transacciones_sin_cliente', (SELECT COUNT(*) FROM transactions WHERE customer_id IS NULL), tx, NULL FROM sizes
  UNION ALL SELECT 'Consistencia', 'tarjeta_sin_cliente', (SELECT COUNT(*) FROM transactions WHERE customer_id IS NULL AND loyalty_card), tx, NULL FROM sizes
  UNION ALL SELECT 'Consistencia', 'cliente_sin_tarjeta', (SELECT COUNT(*) FROM transactions WHERE customer_id IS NOT NULL AND NOT loyalty_card), tx, NULL FROM sizes
  UNION ALL SELECT 'Validez', 'total_no_positivo', (SELECT COUNT(*) FROM transactions WHERE total_amount <= 0), tx, NULL FROM sizes
  UNION ALL SELECT 'Consistencia', 'total_distinto_de_items', (SELECT COUNT(*) FROM deltas WHERE ABS(delta) > 0.01), tx,
       (SELECT CAST(CAST(MAX(ABS(delta)) AS DECIMAL(18,2)) AS VARCHAR) FROM deltas WHERE ABS(delta) > 0.01) FROM sizes
  UNION ALL SELECT 'Unicidad', 'transaction_id_duplicado', tx - (SELECT COUNT(DISTINCT transaction_id) FROM transactions), tx, NULL FROM sizes
  UNION ALL SELECT 'Validez', 'precio_cero_sin_promocion', (SELECT COUNT(*) FROM transaction_items WHERE unit_price = 0 AND NOT was_on_promo), li, NULL FROM sizes
  UNION ALL SELECT 'Integridad referencial', 'store_id_invalido', (SELECT COUNT(*) FROM transactions WHERE store_id NOT IN (SELECT store_id FROM stores)), tx, NULL FROM sizes
  UNION ALL SELECT 'Integridad referencial', 'item_id_invalido', (SELECT COUNT(*) FROM transaction_items WHERE item_id NOT IN (SELECT item_id FROM products)), li, NULL FROM sizes
  UNION ALL SELECT 'Integridad referencial', 'producto_sin_vendor', (SELECT COUNT(*) FROM products WHERE vendor_id NOT IN (SELECT vendor_id FROM vendors)), pr, NULL FROM sizes
  UNION ALL SELECT 'Frescura', 'tiendas_con_dias_sin_venta', (SELECT COUNT(*) FROM silent), st, (SELECT CAST(MAX(max_gap_days) AS VARCHAR) FROM silent) FROM sizes
  UNION ALL SELECT 'Integridad temporal', 'venta_antes_de_apertura', (SELECT n FROM early), tx, (SELECT strftime(lo, '%Y-%m-%d') || '..' || strftime(hi, '%Y-%m-%d') FROM early) FROM sizes
  UNION ALL SELECT 'Prueba A/B', 'tienda_en_dos_variantes', (SELECT COUNT(*) FROM dual), st, NULL FROM sizes)
SELECT *, {div('failed', 'total')} * 100 AS pct FROM found""")
# ---------------------------------------------------------------- comparable sales, productivity
_COMPARABLE = f"""
halves AS (
  SELECT store_id,
         SUM(CASE WHEN year(transaction_date) = 2001 THEN {NET} ELSE 0 END) AS now_sum,
         SUM(CASE WHEN year(transaction_date) = 2000 THEN {NET} ELSE 0 END) AS old_sum
  FROM transactions WHERE year(transaction_date) IN (2000, 2001) AND month(transaction_date) <= 6 GROUP BY store_id),
comparable AS (
  SELECT s.country, s.format, s.store_id, s.store_name, now_sum, old_sum, {div('now_sum', 'old_sum')} - 1 AS g
  FROM halves JOIN stores s ON s.store_id = halves.store_id
  WHERE s.opening_date <= DATE '2000-01-01' AND now_sum <> 0 AND old_sum <> 0)
"""
oracle("comp_sales_store", _COMPARABLE + f"""
SELECT country, format, store_id, store_name, {dbl('now_sum')} AS ventas_netas_periodo_actual,
       {dbl('old_sum')} AS ventas_netas_periodo_anterior, g AS crecimiento_ventas_comparables_pct,
       DENSE_RANK() OVER (PARTITION BY format ORDER BY g DESC) AS ranking_crecimiento_tienda_formato
FROM comparable""")
_GROWTH = f"{total('now_sum')} AS gmv_current, {total('old_sum')} AS gmv_previous"
_GROWTH_PCT = f"{div('SUM(now_sum)', 'SUM(old_sum)')} - 1 AS growth_pct"
for _name, _keys in {
    "comp_sales_country_format": "country, format",
    "comp_sales_by_format": "format",
    "comp_sales_by_country": "country",
}.items():
    oracle(_name, _COMPARABLE + f"""
SELECT {_keys}, {_GROWTH}, COUNT(*) AS stores, {_GROWTH_PCT} FROM comparable GROUP BY {_keys}""")
oracle("comp_sales_levels", _COMPARABLE + f"""
SELECT 'format' AS level, format AS member, {_GROWTH}, {_GROWTH_PCT} FROM comparable GROUP BY format
UNION ALL SELECT 'country', country, {_GROWTH}, {_GROWTH_PCT} FROM comparable GROUP BY country
UNION ALL SELECT 'total', 'ALL', {_GROWTH}, {_GROWTH_PCT} FROM comparable""")
oracle("comp_sales_extremes", _COMPARABLE + f""",
placed AS (
  SELECT 'MEJOR' AS extremo, ROW_NUMBER() OVER (ORDER BY g DESC, store_id) AS posicion, * FROM comparable
  UNION ALL SELECT 'PEOR', ROW_NUMBER() OVER (ORDER BY g, store_id), * FROM comparable)
SELECT extremo, posicion, store_id, store_name, country, format, {dbl('now_sum')} AS ventas_netas_periodo_actual,
       g AS crecimiento_ventas_comparables_pct
FROM placed WHERE posicion <= 4""")
oracle("comp_sales_card", _COMPARABLE + f"""
SELECT {total('now_sum + old_sum')} AS ventas_comparables, {div('SUM(now_sum)', 'SUM(old_sum)')} - 1 AS crecimiento
FROM comparable""")
_QUARTER = f"""
quarter_sales AS (
  SELECT store_id, {total(NET)} AS net, COUNT(DISTINCT transaction_id) AS n FROM transactions
  WHERE transaction_date BETWEEN DATE '2001-04-01' AND DATE '2001-06-30' GROUP BY store_id),
scored AS (
  SELECT s.store_id, s.store_name, s.country, s.format, s.region, s.size_sqm, net AS ventas_netas, n AS transacciones,
         {div('net', 'size_sqm')} AS ventas_netas_por_metro_cuadrado,
         {div('n', 'size_sqm')} AS transacciones_por_metro_cuadrado, {div('net', 'n')} AS ticket_promedio
  FROM quarter_sales q JOIN stores s ON s.store_id = q.store_id),
linear AS (
  SELECT *, quantile_cont(ventas_netas_por_metro_cuadrado, 0.25) OVER (PARTITION BY format) AS p25 FROM scored),
placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY format ORDER BY ventas_netas_por_metro_cuadrado, store_id) AS pos,
         COUNT(*) OVER (PARTITION BY format) AS cnt FROM scored),
lower_p AS (
  SELECT a.* EXCLUDE (pos, cnt), b.ventas_netas_por_metro_cuadrado AS p25
  FROM placed a JOIN placed b ON b.format = a.format AND b.pos = floor((b.cnt - 1) * 0.25) + 1)
"""


def _flagged(source: str, p25: str) -> str:
    return f"""
SELECT * EXCLUDE (p25), {p25} AS percentil_25_ventas_por_metro_cuadrado,
       DENSE_RANK() OVER (PARTITION BY format ORDER BY ventas_netas_por_metro_cuadrado DESC) AS ranking_en_formato,
       IF(ventas_netas_por_metro_cuadrado < p25, 'BAJO_RENDIMIENTO', 'OK') AS alerta_rendimiento FROM {source}"""


oracle("store_productivity", _QUARTER + _flagged("linear", "ROUND(p25, 6)"))
oracle("store_productivity_p25_lower", _QUARTER + _flagged("lower_p", "p25"))
oracle("productivity_bottom_n", _QUARTER + f"""
SELECT store_id, store_name, country, format, region, ventas_netas, ventas_netas_por_metro_cuadrado,
       ticket_promedio, alerta_rendimiento FROM ({_flagged('lower_p', 'p25')})
ORDER BY ventas_netas_por_metro_cuadrado, store_id LIMIT 12""")
oracle("low_stores_by_format", _QUARTER + """
SELECT format, COUNT(*) AS tiendas FROM linear WHERE ventas_netas_por_metro_cuadrado < p25 GROUP BY format
UNION ALL SELECT 'TOTAL', COUNT(*) FROM linear WHERE ventas_netas_por_metro_cuadrado < p25""")

# ---------------------------------------------------------------- net sales, mix
oracle("net_sales_total", f"SELECT {total(NET)} AS ventas_netas FROM transactions")
for _name, _keys in {"net_sales_by_format": "format", "net_sales_by_country_format": "country, format"}.items():
    oracle(_name, f"""
SELECT {_keys}, {total(NET)} AS ventas_netas, COUNT(DISTINCT transaction_id) AS transacciones,
       {div(f'SUM({NET})', 'COUNT(DISTINCT transaction_id)')} AS ticket_promedio
FROM transactions t JOIN stores s ON s.store_id = t.store_id GROUP BY {_keys}""")
oracle("top_stores", f"""
SELECT s.store_id, store_name, country, format, {total(NET)} AS ventas_netas
FROM transactions t JOIN stores s ON s.store_id = t.store_id GROUP BY ALL
ORDER BY ventas_netas DESC, s.store_id LIMIT 10""")
_LINES = f"""
sold_lines AS (
  SELECT t.transaction_id, t.store_id, t.transaction_date, t.status, i.item_id, i.quantity, {LINE} AS line,
         p.category, p.vendor_id, {COST} AS line_cost
  FROM transaction_items i JOIN transactions t ON t.transaction_id = i.transaction_id
  JOIN products p ON p.item_id = i.item_id),
done AS (SELECT * FROM sold_lines WHERE status = 'COMPLETED')
"""
oracle("category_sales", _LINES + f"""
SELECT category, {total('line')} AS ventas_brutas, CAST(SUM(quantity) AS BIGINT) AS unidades FROM done GROUP BY category""")
oracle("returns_by_format", f"""
SELECT format, COUNT(*) AS transacciones_devueltas, {total(AMT)} AS monto_devuelto
FROM transactions t JOIN stores s ON s.store_id = t.store_id WHERE status = 'RETURNED' GROUP BY format""")
oracle("stores_by_format", "SELECT format, COUNT(*) AS tiendas FROM stores GROUP BY format")
_PARETO = _LINES.strip() + f""",
mix AS (
  SELECT s.format, category, SUM(CASE WHEN status = 'RETURNED' THEN -line ELSE line END) AS net
  FROM sold_lines l JOIN stores s ON s.store_id = l.store_id GROUP BY ALL),
ranked AS (
  SELECT *, SUM(net) OVER (PARTITION BY format) AS whole,
         SUM(net) OVER (PARTITION BY format ORDER BY net DESC, category ROWS UNBOUNDED PRECEDING) AS upto,
         ROW_NUMBER() OVER (PARTITION BY format ORDER BY net DESC, category) AS place
  FROM mix)
"""
oracle("pareto", _PARETO + f"""
SELECT format, category, {dbl('net')} AS net_line_gmv, {div('net', 'whole')} AS share, {div('upto', 'whole')} AS cum_share
FROM ranked""")
oracle("pareto_top_categories", _PARETO + f"""
SELECT category, {total('net')} AS net_line_gmv FROM mix GROUP BY category ORDER BY SUM(net) DESC, category LIMIT 8""")
oracle("pareto_top_by_format", _PARETO + f"""
SELECT format, category, place AS posicion, ROUND({div('net', 'whole')} * 100, 1) AS participacion_pct,
       ROUND({div('upto', 'whole')} * 100, 1) AS participacion_acumulada_pct FROM ranked WHERE place <= 3""")
oracle("category_share", _PARETO + f"""
SELECT category, {total('net')} AS net_line_gmv, {div('SUM(net)', '(SELECT SUM(net) FROM mix)')} AS share
FROM mix GROUP BY category""")
oracle("category_recommendation", _LINES + f""",
per_category AS (SELECT category, SUM(line) AS line FROM done GROUP BY category),
idle AS (
  SELECT category, COUNT(*) AS n FROM (
    SELECT category, store_id, item_id FROM done GROUP BY ALL HAVING DATE '2001-08-01' - MAX(transaction_date) >= 3)
  GROUP BY category),
shares AS (
  SELECT c.category, line, {div('line', '(SELECT SUM(line) FROM per_category)')} AS share, COALESCE(n, 0) AS n
  FROM per_category c LEFT JOIN idle ON idle.category = c.category)
SELECT category, {dbl('line')} AS ventas_brutas_categoria, share AS participacion_ventas,
       n AS productos_tienda_con_gap_activo,
       CASE WHEN n = 0 THEN 'MONITOREO' WHEN share >= 0.20 THEN 'PRIORIDAD_ALTA' ELSE 'PRIORIDAD_MEDIA' END AS recomendacion
FROM shares""")
_MARGIN = _LINES.strip() + f""",
margins AS (
  SELECT d.vendor_id, COALESCE(MAX(vendor_name), 'SIN_VENDOR') AS vendor_name, category,
         SUM(line) AS sales, SUM(line_cost) AS costs, COUNT(DISTINCT item_id) AS items, SUM(quantity) AS units,
         MAX(transaction_date) - MIN(transaction_date) + 1 AS days
  FROM done d LEFT JOIN vendors v ON v.vendor_id = d.vendor_id GROUP BY d.vendor_id, category),
returns AS (SELECT *, {div('sales - costs', 'costs')} AS r FROM margins)
"""
oracle("vendor_margin_return", _MARGIN + f"""
SELECT vendor_id, vendor_name, category, {dbl('sales')} AS ventas_brutas_items, {dbl('costs')} AS costo_total,
       {dbl('sales - costs')} AS margen_bruto, r AS retorno_margen_bruto_sobre_costo, items AS items_activos,
       {div('units', 'days')} AS velocidad_unidades_por_dia,
       IF(r < 1, 'RETORNO_MARGEN_BAJO_1', 'OK') AS alerta_retorno_margen FROM returns""")
oracle("vendor_margin_low", _MARGIN + """
SELECT COUNT(*) FILTER (r < 1) AS proveedores_categoria_bajos, COUNT(*) AS proveedores_categoria FROM returns""")
oracle("vendor_margin_worst", _MARGIN + f"""
SELECT vendor_id, vendor_name, category, r AS retorno_margen_bruto_sobre_costo, {dbl('sales - costs')} AS margen_bruto
FROM returns ORDER BY r, vendor_id, category LIMIT 5""")
oracle("kpi_margin_return", _MARGIN + """
SELECT vendor_id, vendor_name, category, r AS retorno_margen_bruto_sobre_costo, r > 1.5 AS meets_target FROM returns""")
_PROMO = f"""
tx_cat AS (
  SELECT t.transaction_id, p.category, bool_or(was_on_promo) AS promo_tx, SUM(quantity) AS units,
         SUM({LINE}) AS line, MAX({AMT}) AS ticket
  FROM transactions t JOIN transaction_items i ON i.transaction_id = t.transaction_id
  JOIN products p ON p.item_id = i.item_id WHERE t.status = 'COMPLETED' GROUP BY t.transaction_id, p.category),
sides AS (
  SELECT category, promo_tx, COUNT(DISTINCT transaction_id) AS transactions,
         {div('SUM(line)', 'COUNT(*)')} AS avg_category_gmv, {div('SUM(units)', 'COUNT(*)')} AS avg_units,
         {div('SUM(ticket)', 'COUNT(*)')} AS avg_ticket FROM tx_cat GROUP BY category, promo_tx)
"""
oracle("promo_impact_long", _PROMO + "SELECT * FROM sides")
oracle("export_csv", _PROMO + "SELECT * FROM sides")
_PROMO_WIDE = _PROMO.strip() + """,
wide AS (
  SELECT c.category, y.transactions AS transacciones_con_promocion, n.transactions AS transacciones_sin_promocion,
         y.avg_ticket AS ticket_promedio_con_promocion, n.avg_ticket AS ticket_promedio_sin_promocion,
         y.avg_units AS unidades_promedio_con_promocion, n.avg_units AS unidades_promedio_sin_promocion,
         y.avg_category_gmv - n.avg_category_gmv AS diferencia_ventas_categoria_promedio,
         y.avg_ticket - n.avg_ticket AS diferencia_ticket_promedio,
         y.avg_units - n.avg_units AS diferencia_unidades_promedio,
         CASE WHEN NOT COALESCE(y.avg_units > n.avg_units, FALSE) THEN 'SIN_UPLIFT_CLARO'
              WHEN y.avg_ticket >= n.avg_ticket THEN 'UPLIFT_REAL'
              ELSE 'MAS_UNIDADES_CON_MENOR_TICKET' END AS lectura_promocion
  FROM (SELECT DISTINCT category FROM sides) c
  LEFT JOIN sides y ON y.category = c.category AND y.promo_tx LEFT JOIN sides n ON n.category = c.category AND NOT n.promo_tx)
"""
oracle("promo_impact", _PROMO_WIDE + "SELECT * FROM wide")
oracle("promo_impact_ranked", _PROMO_WIDE + """
SELECT category, ticket_promedio_con_promocion, ticket_promedio_sin_promocion, diferencia_ticket_promedio,
       unidades_promedio_con_promocion, unidades_promedio_sin_promocion, diferencia_unidades_promedio,
       lectura_promocion FROM wide""")

# ---------------------------------------------------------------- cohorts
_COHORT = f"""
buys AS (
  SELECT customer_id, CAST(date_trunc('month', transaction_date) AS DATE) AS m, {AMT} AS amt FROM transactions
  WHERE loyalty_card AND customer_id IS NOT NULL AND status = 'COMPLETED'),
firsts AS (SELECT customer_id, MIN(m) AS c FROM buys GROUP BY customer_id),
cohort_sizes AS (SELECT c, COUNT(*) AS n FROM firsts GROUP BY c),
activity AS (
  SELECT f.c AS mes_cohorte, CAST(date_diff('month', f.c, b.m) AS BIGINT) AS mes_relativo,
         COUNT(DISTINCT b.customer_id) AS clientes_activos, {div('SUM(amt)', 'COUNT(*)')} AS ticket_promedio,
         MAX(z.n) AS clientes_cohorte, {div('COUNT(DISTINCT b.customer_id)', 'MAX(z.n)')} AS tasa_retencion
  FROM buys b JOIN firsts f ON f.customer_id = b.customer_id JOIN cohort_sizes z ON z.c = f.c GROUP BY 1, 2)
"""
oracle("cohort_activity", _COHORT + "SELECT * FROM activity WHERE mes_relativo IN (0, 1, 2, 3, 6)")
_MONTHS = (0, 1, 2, 3, 6)


def _at(column: str, m: int) -> str:
    return f"MAX({column}) FILTER (mes_relativo = {m})"


oracle("cohort_retention", _COHORT + f"""
SELECT mes_cohorte, MAX(clientes_cohorte) AS clientes_cohorte,
       {', '.join(f"{_at('tasa_retencion', m)} AS retencion_mes_{m}" for m in _MONTHS)},
       {', '.join(f"{_at('ticket_promedio', m)} AS ticket_promedio_mes_{m}" for m in _MONTHS)},
       CASE sign({_at('ticket_promedio', 6)} - {_at('ticket_promedio', 0)}) WHEN 1 THEN 'CRECE' WHEN -1 THEN 'DECRECE'
            ELSE 'SIN_DATOS' END AS tendencia_ticket_mes_0_a_mes_6
FROM activity WHERE mes_relativo IN (0, 1, 2, 3, 6) GROUP BY mes_cohorte""")
oracle("dashboard_retention", _COHORT + f"""
SELECT strftime(mes_cohorte, '%Y-%m') AS cohort,
       {', '.join(f"ROUND({_at('tasa_retencion', m)} * 100, 1) AS m{m}" for m in _MONTHS)}
FROM activity WHERE mes_relativo IN (0, 1, 2, 3, 6) GROUP BY mes_cohorte""")
oracle("cohort_group_compare", _COHORT + """
SELECT ROUND(AVG(tasa_retencion) FILTER (mes_cohorte <= DATE '1995-03-01'), 8) AS retencion_tempranas,
       ROUND(AVG(tasa_retencion) FILTER (mes_cohorte BETWEEN DATE '1995-04-01' AND DATE '1995-06-01'), 8) AS retencion_recientes
FROM activity WHERE mes_relativo = 1""")
oracle("customer_first_month", _COHORT + "SELECT customer_id, c AS mes_primera_compra FROM firsts")
oracle("fact_cohort_month", _COHORT + """
SELECT strftime(mes_cohorte, '%Y%m') AS cohort_month_key, mes_relativo, clientes_activos, tasa_retencion, ticket_promedio
FROM activity""")
oracle("kpi_retention_m1", _COHORT + """
SELECT mes_cohorte, clientes_activos, clientes_cohorte, tasa_retencion, tasa_retencion >= 0.7 AS meets_target
FROM activity WHERE mes_relativo = 1""")

oracle("dq_kpi_rules", _COHORT.strip() + f""",
weekly AS (SELECT store_id, {WEEK} AS w, COUNT(*) AS tx FROM transactions GROUP BY ALL),
drops AS (
  SELECT tx, AVG(tx) OVER (PARTITION BY store_id ORDER BY w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS m FROM weekly),
sold AS (
  SELECT p.item_id, MAX(t.transaction_date) AS last_day
  FROM products p LEFT JOIN (transaction_items i JOIN transactions t
    ON t.transaction_id = i.transaction_id AND t.status = 'COMPLETED') ON i.item_id = p.item_id
  GROUP BY p.item_id),
stored_months AS (
  SELECT IF(customer_id % 11 <> 0, customer_id, NULL) AS customer_id,
         CAST(IF(customer_id % 7 = 0, c + INTERVAL 2 MONTH, c) AS DATE) AS c FROM firsts),
bought AS (
  SELECT DISTINCT customer_id, CAST(date_trunc('month', transaction_date) AS DATE) AS m FROM transactions
  WHERE status = 'COMPLETED' AND loyalty_card AND customer_id IS NOT NULL),
compared AS (SELECT m < c AS early FROM bought JOIN stored_months USING (customer_id)),
first_sales AS (
  SELECT store_id, item_id, MIN(transaction_date) AS f FROM transaction_items i JOIN transactions t
    ON t.transaction_id = i.transaction_id AND t.status = 'COMPLETED' GROUP BY ALL),
stored_gaps AS (
  SELECT store_id, item_id, IF(item_id % 13 = 0, a - 400, a) AS a FROM (
    SELECT store_id, item_id, d + 1 AS a, COALESCE(LEAD(d) OVER (PARTITION BY store_id, item_id ORDER BY d) - 1, DATE '2001-08-01') AS b
    FROM (SELECT DISTINCT store_id, item_id, transaction_date AS d FROM transaction_items i JOIN transactions t
            ON t.transaction_id = i.transaction_id AND t.status = 'COMPLETED' WHERE transaction_date <= DATE '2001-08-01'))
  WHERE b - a + 1 >= 3)
SELECT 'superficie_nula_o_cero' AS rule, COUNT(*) FILTER (size_sqm IS NULL OR size_sqm <= 0) AS failed, COUNT(*) AS total FROM stores
UNION ALL SELECT 'venta_negativa_sin_devolucion', COUNT(*) FILTER (total_amount < 0 AND status <> 'RETURNED'), COUNT(*) FROM transactions
UNION ALL SELECT 'ticket_no_positivo', COUNT(*) FILTER (total_amount <= 0), COUNT(*) FROM transactions
UNION ALL SELECT 'tarjeta_sin_cliente', COUNT(*) FILTER (customer_id IS NULL AND loyalty_card), COUNT(*) FROM transactions
UNION ALL SELECT 'caida_de_transacciones', COUNT(*) FILTER (tx < m * CAST(1 - CAST(0.3 AS DOUBLE) AS DOUBLE)), COUNT(*) FROM drops
UNION ALL SELECT 'mes_relativo_negativo', COUNT(*) FILTER (early), COUNT(*) FROM compared
UNION ALL SELECT 'cohorte_sin_cliente', COUNT(*) FILTER (customer_id IS NULL), COUNT(*) FROM stored_months
UNION ALL SELECT 'ausencia_sin_ventas_previas', COUNT(*) FILTER (f IS NULL OR f >= a), COUNT(*) FROM stored_gaps LEFT JOIN first_sales USING (store_id, item_id)
UNION ALL SELECT 'costo_nulo_o_cero', COUNT(*) FILTER (cost IS NULL OR cost <= 0), COUNT(*) FROM products
UNION ALL SELECT 'vendor_inexistente', COUNT(*) FILTER (vendor_id IS NULL OR vendor_id NOT IN (SELECT vendor_id FROM vendors)), COUNT(*) FROM products
UNION ALL SELECT 'item_sin_ventas_recientes', COUNT(*) FILTER (last_day IS NULL OR DATE '2001-08-01' - last_day > 180), COUNT(*) FROM sold
UNION ALL SELECT 'item_sin_historia', COUNT(*) FILTER (last_day IS NULL), COUNT(*) FROM sold""")

# ---------------------------------------------------------------- stock gaps
oracle("daily_item_sales", _LINES + f"""
SELECT store_id, item_id, transaction_date AS fecha_venta, CAST(SUM(quantity) AS BIGINT) AS unidades,
       {total('line')} AS ventas_brutas FROM done GROUP BY ALL""")
_SPINE = _LINES.strip() + """,
daily AS (SELECT store_id, category, transaction_date AS d, SUM(line) AS g FROM done GROUP BY ALL),
spine AS (
  SELECT store_id, category, CAST(UNNEST(generate_series(f, DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT store_id, category, MIN(d) AS f FROM daily GROUP BY ALL))
"""
oracle("date_spine", _SPINE + "SELECT store_id, category, d AS fecha_calendario FROM spine")
_CALENDAR = _SPINE.strip() + f""",
silent AS (SELECT s.* FROM spine s ANTI JOIN daily USING (store_id, category, d)),
islands AS (
  SELECT *, d - CAST(ROW_NUMBER() OVER (PARTITION BY store_id, category ORDER BY d) AS INT) AS grp FROM silent),
runs AS (
  SELECT store_id, category, MIN(d) AS a, MAX(d) AS b, COUNT(*) AS n FROM islands
  GROUP BY store_id, category, grp HAVING COUNT(*) >= 3),
priced AS (
  SELECT r.store_id, r.category, r.a, r.b, r.n, {div('SUM(x.g)', '14')} AS avg_before
  FROM runs r JOIN daily x ON x.store_id = r.store_id AND x.category = r.category AND x.d BETWEEN r.a - 14 AND r.a - 1
  GROUP BY ALL),
gaps AS (
  SELECT r.store_id, r.category, store_name, country, format, region, a AS fecha_inicio_ausencia,
         b AS fecha_fin_ausencia, n AS dias_sin_venta, avg_before AS venta_diaria_promedio_previa,
         avg_before * n AS venta_estimada_perdida, b = DATE '2001-08-01' AS active_gap
  FROM priced r JOIN stores s ON s.store_id = r.store_id)
"""
oracle("stock_gaps", _CALENDAR + "SELECT * FROM gaps")
oracle("stock_gaps_calendar", _CALENDAR + "SELECT * FROM gaps")
oracle("dashboard_stock", _CALENDAR + """
SELECT store_id, store_name, country, format, region, category, dias_sin_venta, venta_estimada_perdida FROM gaps
WHERE active_gap ORDER BY venta_estimada_perdida DESC, store_id, category, fecha_inicio_ausencia LIMIT 250""")
# At item grain a calendar is large, so these use consecutive sale days and a look-back self-join.
_ITEM_GAPS = _LINES.strip() + f""",
daily AS (SELECT store_id, item_id, transaction_date AS d, SUM(line) AS g FROM done GROUP BY ALL),
steps AS (SELECT *, LEAD(d) OVER (PARTITION BY store_id, item_id ORDER BY d) AS nxt FROM daily),
runs AS (
  SELECT store_id, item_id, d + 1 AS a, COALESCE(nxt - 1, DATE '2001-08-01') AS b, nxt IS NULL AS open_run FROM steps),
long_runs AS (SELECT *, CAST(b - a + 1 AS BIGINT) AS n FROM runs WHERE b - a + 1 >= 3),
priced AS (
  SELECT r.store_id, r.item_id, r.a, r.b, r.n, r.open_run, {div('SUM(x.g)', '14')} AS avg_before
  FROM long_runs r JOIN daily x ON x.store_id = r.store_id AND x.item_id = r.item_id AND x.d BETWEEN r.a - 14 AND r.a - 1
  GROUP BY ALL),
gaps AS (
  SELECT r.store_id, r.item_id, store_name, s.country, format, region, item_name, category, p.vendor_id,
         COALESCE(v.vendor_name, 'SIN_VENDOR') AS vendor_name, a AS fecha_inicio_ausencia, b AS fecha_fin_ausencia,
         n AS dias_sin_venta, avg_before AS venta_diaria_promedio_previa, avg_before * n AS venta_estimada_perdida,
         open_run AS active_gap
  FROM priced r JOIN stores s ON s.store_id = r.store_id JOIN products p ON p.item_id = r.item_id
  LEFT JOIN vendors v ON v.vendor_id = p.vendor_id)
"""
oracle("stock_gaps_item", _ITEM_GAPS + "SELECT * FROM gaps")
_LOST = "CAST(SUM(CAST(venta_estimada_perdida AS DECIMAL(28,6))) AS DOUBLE) AS ventas_estimadas_perdidas"
oracle("lost_sales_by_category", _ITEM_GAPS + f"SELECT category, {_LOST} FROM gaps GROUP BY category")
oracle("lost_sales_by_vendor", _ITEM_GAPS + f"""
SELECT vendor_id, vendor_name, {_LOST} FROM gaps GROUP BY ALL ORDER BY ventas_estimadas_perdidas DESC, vendor_id LIMIT 5""")
_TOP_GAPS = "ORDER BY venta_estimada_perdida DESC, store_id, item_id, fecha_inicio_ausencia LIMIT"
oracle("active_gaps", _ITEM_GAPS + f"SELECT * FROM gaps WHERE active_gap {_TOP_GAPS} 250")
oracle("top_gaps", _ITEM_GAPS + f"SELECT * FROM gaps {_TOP_GAPS} 1000")
oracle("gap_totals", _ITEM_GAPS + f"""
SELECT COUNT(*) AS ausencias, COUNT(*) FILTER (active_gap) AS ausencias_activas, {_LOST} FROM gaps""")
oracle("fact_stock_gap", _ITEM_GAPS + f"""
SELECT {key('store_id')} AS store_key, {key('item_id')} AS product_key, fecha_inicio_ausencia, fecha_fin_ausencia,
       dias_sin_venta, venta_diaria_promedio_previa, venta_estimada_perdida FROM gaps""")
oracle("kpi_stockout_index", _ITEM_GAPS + f""",
lost AS (SELECT store_id, CAST(SUM(CAST(venta_estimada_perdida AS DECIMAL(28,6))) AS DOUBLE) AS lost FROM gaps GROUP BY store_id),
net AS (SELECT store_id, {total(NET)} AS net_sales FROM transactions WHERE transaction_date <= DATE '2001-08-01' GROUP BY store_id)
SELECT net.store_id, COALESCE(lost, 0) AS lost, net_sales,
       {div('COALESCE(lost, 0)', 'net_sales')} AS stockout_index,
       {div('COALESCE(lost, 0)', 'net_sales')} < 0.02 AS meets_target
FROM net LEFT JOIN lost ON lost.store_id = net.store_id""")
# ---------------------------------------------------------------- weekly series
_WEEKLY = f"""
weekly AS (
  SELECT {WEEK} AS week_start, format, {total(NET)} AS net_gmv
  FROM transactions t JOIN stores s ON s.store_id = t.store_id WHERE transaction_date <= DATE '2001-07-29' GROUP BY ALL),
exact AS (
  SELECT {WEEK} AS week_start, format, SUM({NET}) AS v
  FROM transactions t JOIN stores s ON s.store_id = t.store_id WHERE transaction_date <= DATE '2001-07-29' GROUP BY ALL),
changes AS (
  SELECT week_start, format, {dbl('v')} AS net_gmv,
         {dbl('v - LAG(v) OVER (PARTITION BY format ORDER BY week_start)')} AS wow_abs,
         {div('v', 'LAG(v) OVER (PARTITION BY format ORDER BY week_start)')} - 1 AS wow_pct FROM exact)
"""
oracle("weekly_sales", _WEEKLY + "SELECT * FROM weekly")
oracle("weekly_change", _WEEKLY + "SELECT * FROM changes")
oracle("format_volatility", _WEEKLY + f"""
SELECT format, {div('SUM(v)', 'COUNT(*)')} AS mean, ROUND(stddev_samp({dbl('v')}), 3) AS std,
       ROUND(stddev_samp({dbl('v')}) / {div('SUM(v)', 'COUNT(*)')}, 8) AS cv FROM exact GROUP BY format""")
oracle("weekly_extremes", _WEEKLY + """
SELECT * FROM (SELECT *, 'SUBIDA' AS tipo FROM changes ORDER BY wow_abs DESC NULLS LAST, week_start, format LIMIT 3)
UNION ALL
SELECT * FROM (SELECT *, 'CAIDA' AS tipo FROM changes ORDER BY wow_abs ASC NULLS LAST, week_start, format LIMIT 3)""")

# ---------------------------------------------------------------- experiments
_TRIAL = f"""
clean AS (SELECT store_id, MIN(variant) AS variant FROM store_promotions GROUP BY store_id HAVING COUNT(DISTINCT variant) = 1),
spans(name, a, b) AS (VALUES ('pre', DATE '2000-07-21', DATE '2000-08-31'), ('test', DATE '2000-09-01', DATE '2000-10-12')),
span_sales AS (
  SELECT name, c.store_id, c.variant, SUM({AMT}) AS gmv, COUNT(DISTINCT transaction_id) AS n
  FROM transactions t JOIN spans ON t.transaction_date BETWEEN a AND b JOIN clean c ON c.store_id = t.store_id
  WHERE status = 'COMPLETED' GROUP BY ALL),
span_metrics AS (
  SELECT name, store_id, variant, {div('gmv', '6')} AS wg, {div('n', '6')} AS wt, {div('gmv', 'n')} AS tk FROM span_sales)
"""
oracle("ab_clean_assignment", _TRIAL + "SELECT * FROM clean")
oracle("ab_period_metrics", _TRIAL + """
SELECT store_id, variant, wg AS test_weekly_gmv, wt AS test_weekly_tx, tk AS test_ticket FROM span_metrics WHERE name = 'test'""")
_WIDE = """
SELECT p.store_id, p.variant, p.wg AS pre_weekly_gmv, p.wt AS pre_weekly_tx, p.tk AS pre_ticket,
       t.wg AS test_weekly_gmv, t.wt AS test_weekly_tx, t.tk AS test_ticket,
       t.wg - p.wg AS gmv_change, t.wt - p.wt AS tx_change, t.tk - p.tk AS ticket_change
FROM span_metrics p JOIN span_metrics t ON t.store_id = p.store_id AND p.name = 'pre' AND t.name = 'test'"""
oracle("ab_wide", _TRIAL + _WIDE)
oracle("ab_format_counts", _TRIAL + f"""
SELECT variant, {', '.join(f"COUNT(*) FILTER (format = '{f}') AS {f}" for f in ('DESCUENTO', 'EXPRESS', 'HIPERMERCADO', 'SUPERMERCADO'))}
FROM clean c JOIN stores s ON s.store_id = c.store_id GROUP BY variant""")
oracle("ab_size_summary", _TRIAL + """
SELECT variant, COUNT(*) AS count, ROUND(AVG(size_sqm), 6) AS mean, CAST(MEDIAN(size_sqm) AS DOUBLE) AS median,
       MIN(size_sqm) AS min, MAX(size_sqm) AS max FROM clean c JOIN stores s ON s.store_id = c.store_id GROUP BY variant""")
for _name in ("pre", "test"):
    oracle(f"ab_{_name}_summary", _TRIAL + f"""
SELECT variant, COUNT(*) AS n, ROUND(AVG(wg), 4) AS avg_weekly_gmv, ROUND(AVG(wt), 6) AS avg_weekly_tx,
       ROUND(AVG(tk), 4) AS avg_ticket FROM span_metrics WHERE name = '{_name}' GROUP BY variant""")


def _welch(values: str, segment: str = "") -> str:
    comma = f"{segment}, " if segment else ""
    return f""",
long AS ({values}),
moments AS (
  SELECT metric, {comma}COUNT(*) FILTER (variant = 'CONTROL') AS n1, COUNT(*) FILTER (variant = 'TREATMENT') AS n2,
         AVG(value) FILTER (variant = 'CONTROL') AS m1, AVG(value) FILTER (variant = 'TREATMENT') AS m2,
         var_samp(value) FILTER (variant = 'CONTROL') AS v1, var_samp(value) FILTER (variant = 'TREATMENT') AS v2
  FROM long GROUP BY ALL),
welch AS (
  SELECT *, m2 - m1 AS diff, sqrt(v1 / n1 + v2 / n2) AS se,
         (v1 / n1 + v2 / n2) * (v1 / n1 + v2 / n2)
           / NULLIF((v1 / n1) * (v1 / n1) / NULLIF(n1 - 1, 0) + (v2 / n2) * (v2 / n2) / NULLIF(n2 - 1, 0), 0) AS df
  FROM moments)
"""


def _welch_columns(segment: str = "", se: bool = True) -> str:
    return f"""metric, {segment + ', ' if segment else ''}n1 AS n_control, n2 AS n_treatment, ROUND(m1, 3) AS control_mean,
       ROUND(m2, 3) AS treatment_mean, ROUND(diff, 3) AS diff, ROUND(diff / NULLIF(m1, 0) * 100, 6) AS lift_pct,
       {'ROUND(se, 3) AS se, ' if se else ''}ROUND(diff / NULLIF(se, 0), 6) AS t, ROUND(df, 6) AS df"""


_DURING = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, variant, {c} AS value {{extra}} FROM span_metrics {{join}} WHERE name = 'test'"
    for m, c in (("test_weekly_gmv", "wg"), ("test_weekly_tx", "wt"), ("test_ticket", "tk"))
)
_DURING_PLAIN = _DURING.format(extra="", join="")
_DURING_FORMAT = _DURING.format(extra=", format", join="JOIN stores USING (store_id)")
_CHANGES = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, variant, {m} AS value FROM ({_WIDE})" for m in ("gmv_change", "tx_change", "ticket_change")
)
# The t distribution by numeric integration of its density on a fine grid (trapezoids), inverted
# by interpolation: an oracle independent of the library's quadrature.
_T_GRID = """,
grid AS (SELECT UNNEST(range(0, 300001)) AS i),
density AS (
  SELECT metric, df, i, exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
           * pow(1 + (i * 0.0001) * (i * 0.0001) / df, -(df + 1) / 2) AS f
  FROM welch CROSS JOIN grid),
central AS (
  SELECT metric, i, SUM(f * 0.0001) OVER (PARTITION BY metric ORDER BY i ROWS UNBOUNDED PRECEDING)
                    - 0.00005 * (f + FIRST_VALUE(f) OVER (PARTITION BY metric ORDER BY i)) AS mass
  FROM density),
steps AS (
  SELECT metric, i, mass, LEAD(mass) OVER (PARTITION BY metric ORDER BY i) AS next_mass FROM central),
crit AS (
  SELECT metric, (i + (0.475 - mass) / (next_mass - mass)) * 0.0001 AS c FROM steps
  WHERE mass <= 0.475 AND next_mass > 0.475),
tails AS (
  SELECT w.metric, 1 - 2 * (mass + (next_mass - mass) * (abs(diff / se) / 0.0001 - i)) AS p
  FROM welch w JOIN steps s ON s.metric = w.metric AND s.i = CAST(floor(abs(diff / se) / 0.0001) AS BIGINT))
"""
_T_SELECT = f"""
SELECT w.{_welch_columns(se=False)}, ROUND(p, 7) AS p_value, ROUND(diff - c * se, 1) AS ci_low, ROUND(diff + c * se, 1) AS ci_high
FROM welch w LEFT JOIN crit USING (metric) LEFT JOIN tails USING (metric)"""
oracle("welch_stats", _TRIAL.strip() + _welch(_DURING_PLAIN) + f"SELECT {_welch_columns()} FROM welch")
oracle("welch_stats_by_format",
       _TRIAL.strip() + _welch(_DURING_FORMAT, "format") + f"SELECT {_welch_columns('format')} FROM welch")
oracle("welch_test", _TRIAL.strip() + _welch(_DURING_PLAIN).rstrip() + _T_GRID + _T_SELECT)
oracle("ab_did", _TRIAL.strip() + _welch(_CHANGES).rstrip() + _T_GRID + _T_SELECT)

# ---------------------------------------------------------------- star schema
_PROMO_KEY = key("promo_name", "variant", "start_date", "end_date", "promo_type")
oracle("fact_sales_item", f"""
active AS (
  SELECT t.transaction_id, COUNT(DISTINCT {_PROMO_KEY}) AS n, MIN({_PROMO_KEY}) AS k
  FROM transactions t JOIN store_promotions p ON p.store_id = t.store_id AND t.transaction_date BETWEEN start_date AND end_date
  GROUP BY t.transaction_id)
SELECT i.transaction_item_id, i.transaction_id, strftime(t.transaction_date, '%Y%m%d') AS date_key,
       {key('t.store_id')} AS store_key, {key('i.item_id')} AS product_key, {CUSTOMER_KEY} AS customer_key,
       CASE WHEN n = 1 THEN k END AS promotion_key, COALESCE(n, 0) AS promociones_vigentes, i.quantity, i.unit_price,
       {dbl(LINE)} AS ventas_brutas_item,
       {dbl(f"CASE WHEN status = 'RETURNED' THEN -{LINE} ELSE {LINE} END")} AS ventas_netas_item,
       {dbl('CAST(cost AS DECIMAL(18,6))')} AS costo_unitario,
       {dbl(f"CASE WHEN status = 'RETURNED' THEN -1 ELSE 1 END * ({LINE} - quantity * CAST(cost AS DECIMAL(18,6)))")} AS margen_bruto
FROM transaction_items i JOIN transactions t ON t.transaction_id = i.transaction_id
LEFT JOIN products p ON p.item_id = i.item_id LEFT JOIN active ON active.transaction_id = i.transaction_id""")
oracle("fact_transaction", f"""
SELECT transaction_id, strftime(transaction_date, '%Y%m%d') AS date_key, {key('store_id')} AS store_key,
       {CUSTOMER_KEY} AS customer_key, payment_method, status, total_amount, {dbl(NET)} AS ventas_netas, loyalty_card
FROM transactions""")
oracle("fact_store_day", f"""
SELECT strftime(transaction_date, '%Y%m%d') AS date_key, {key('s.store_id')} AS store_key, {total(NET)} AS ventas_netas,
       COUNT(DISTINCT transaction_id) AS transacciones, {div(f'SUM({NET})', 'COUNT(DISTINCT transaction_id)')} AS ticket_promedio,
       {div(f'SUM({NET})', 'MAX(size_sqm)')} AS ventas_netas_por_metro_cuadrado,
       COALESCE(CAST(SUM({AMT}) FILTER (status = 'RETURNED') AS DOUBLE), 0) AS monto_devoluciones
FROM transactions t JOIN stores s ON s.store_id = t.store_id GROUP BY transaction_date, s.store_id""")
oracle("dim_date", """
days AS (
  SELECT CAST(UNNEST(generate_series(MIN(transaction_date), MAX(transaction_date), INTERVAL 1 DAY)) AS DATE) AS fecha
  FROM transactions)
SELECT strftime(fecha, '%Y%m%d') AS date_key, fecha, CAST(date_trunc('week', fecha) AS DATE) AS inicio_semana,
       month(fecha) AS mes, quarter(fecha) AS trimestre, year(fecha) AS anio, week(fecha) AS semana_fiscal FROM days""")
oracle("dim_store", f"SELECT {key('store_id')} AS store_key, * FROM stores")
oracle("dim_product", f"""
SELECT {key('item_id')} AS product_key, * EXCLUDE (vendor_id), {key('vendor_id')} AS vendor_key FROM products""")
oracle("dim_vendor", f"SELECT {key('vendor_id')} AS vendor_key, * FROM vendors")
oracle("dim_customer", f"""
SELECT substr({SALTED}, 1, 32) AS customer_key, {SALTED} AS customer_hash,
       IF(bool_or(loyalty_card), 'LEALTAD', 'SIN_TARJETA') AS segmento_lealtad,
       CAST(date_trunc('month', MIN(transaction_date) FILTER (loyalty_card AND status = 'COMPLETED')) AS DATE) AS mes_primera_compra
FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id
UNION ALL SELECT '-1', NULL, 'ANONIMO', NULL""")
oracle("dim_promotion", f"""
SELECT DISTINCT {_PROMO_KEY} AS promotion_key, promo_name, variant, start_date, end_date, promo_type FROM store_promotions""")

# ---------------------------------------------------------------- KPIs
_STORE_WEEKS = f"""
store_weeks AS (
  SELECT {WEEK} AS week_start, s.store_id, s.format, {div(f'SUM({NET})', 'MAX(size_sqm)')} AS sales_value,
         {div('COUNT(DISTINCT transaction_id)', 'MAX(size_sqm)')} AS tx_value
  FROM transactions t JOIN stores s ON s.store_id = t.store_id GROUP BY 1, 2, 3)
"""
for _name, _value, _digits in (("kpi_sales_per_sqm", "sales_value", 6), ("kpi_tx_per_sqm", "tx_value", 8)):
    oracle(_name, _STORE_WEEKS + f"""
SELECT week_start, store_id, format, {_value} AS value, ROUND(p50, {_digits}) AS p50_format, {_value} >= p50 AS meets_target
FROM (SELECT *, quantile_cont({_value}, 0.5) OVER (PARTITION BY week_start, format) AS p50 FROM store_weeks)""")
oracle("kpi_avg_ticket", f"""
per_day AS (
  SELECT transaction_date AS d, {div(f'SUM({NET})', 'COUNT(DISTINCT transaction_id)')} AS ticket FROM transactions GROUP BY 1)
SELECT a.d AS date, a.ticket, b.ticket AS previous_ticket, {div('a.ticket', 'b.ticket')} - 1 AS growth,
       {div('a.ticket', 'b.ticket')} - 1 >= 0.03 AS meets_target
FROM per_day a LEFT JOIN per_day b ON b.d = CAST(a.d - INTERVAL 1 YEAR AS DATE)""")
oracle("kpi_loyalty_conversion", f"""
SELECT {WEEK} AS week_start, COUNT(*) FILTER (loyalty_card) AS loyalty_tx, COUNT(*) AS tx,
       {div('COUNT(*) FILTER (loyalty_card)', 'COUNT(*)')} AS conversion,
       {div('COUNT(*) FILTER (loyalty_card)', 'COUNT(*)')} >= 0.45 AS meets_target FROM transactions GROUP BY 1""")


def _availability(horizon: str) -> str:
    return _LINES.strip() + f""",
pair_last AS (
  SELECT store_id, category, DATE '{horizon}' - MAX(transaction_date) AS silent_days FROM done
  WHERE transaction_date <= DATE '{horizon}' GROUP BY store_id, category),
avail AS (
  SELECT store_id, COUNT(*) AS active_items, COUNT(*) FILTER (silent_days >= 3) AS idle_items,
         1.0 - {div('COUNT(*) FILTER (silent_days >= 3)', 'COUNT(*)')} AS availability
  FROM pair_last WHERE silent_days <= 180 GROUP BY store_id)
"""


oracle("kpi_availability", _availability("2001-08-01") + "SELECT *, availability >= 0.97 AS meets_target FROM avail")
oracle("kpi_health_score", _availability("2001-06-30") + f""",
parts AS (
  SELECT s.store_id, s.format, {div(f'SUM({NET})', 'MAX(size_sqm)')} AS sales_per_sqm,
         {div('COUNT(DISTINCT transaction_id)', 'MAX(size_sqm)')} AS tx_per_sqm,
         {div(f'SUM({NET})', 'COUNT(DISTINCT transaction_id)')} AS ticket, MAX(availability) AS availability
  FROM transactions t JOIN stores s ON s.store_id = t.store_id LEFT JOIN avail a ON a.store_id = t.store_id
  WHERE transaction_date BETWEEN DATE '2001-04-01' AND DATE '2001-06-30' GROUP BY s.store_id, s.format),
scaled AS (
  SELECT *, {', '.join(f"({c} - MIN({c}) OVER w) / NULLIF(MAX({c}) OVER w - MIN({c}) OVER w, 0) AS {c}_scaled"
                        for c in ('sales_per_sqm', 'tx_per_sqm', 'ticket', 'availability'))}
  FROM parts WINDOW w AS (PARTITION BY format)),
final AS (
  SELECT *, (sales_per_sqm_scaled * CAST(0.4 AS DOUBLE) + tx_per_sqm_scaled * CAST(0.25 AS DOUBLE)
             + ticket_scaled * CAST(0.2 AS DOUBLE) + availability_scaled * CAST(0.15 AS DOUBLE)) * 100 AS score FROM scaled)
SELECT * EXCLUDE (score), ROUND(score, 8) AS health_score, score >= 75 AS meets_target FROM final""")

# The series from calendars: every day of every item, where the operators only sweep over events.
def _daily_availability(first: str, last: str) -> str:
    return _LINES.strip() + f""",
sold AS (
  SELECT DISTINCT store_id, category, transaction_date AS s FROM done
  WHERE transaction_date BETWEEN DATE '{first}' - 180 AND DATE '{last}'),
covered AS (
  SELECT store_id, category, CAST(UNNEST(generate_series(
           GREATEST(s, DATE '{first}'), LEAST(s + 180, DATE '{last}'), INTERVAL 1 DAY)) AS DATE) AS date, s FROM sold),
pair_days AS (
  SELECT store_id, category, date, date - s AS silent_days
  FROM (SELECT store_id, category, date, MAX(s) AS s FROM covered GROUP BY ALL)),
avail AS (
  SELECT store_id, date, COUNT(*) AS active_items, COUNT(*) FILTER (silent_days >= 3) AS idle_items,
         1.0 - {div('COUNT(*) FILTER (silent_days >= 3)', 'COUNT(*)')} AS availability
  FROM pair_days GROUP BY store_id, date)
"""


oracle("kpi_availability_daily", _daily_availability("2001-01-01", "2001-08-01") + """
SELECT *, availability >= 0.97 AS meets_target FROM avail""")
oracle("kpi_stockout_daily", _CALENDAR.strip() + f""",
amounts AS (
  SELECT store_id, fecha_inicio_ausencia AS a, fecha_fin_ausencia AS b, dias_sin_venta AS n,
         CAST(CAST(venta_diaria_promedio_previa AS DECIMAL(28,6)) AS DECIMAL(38,6)) AS daily,
         CAST(CAST(venta_estimada_perdida AS DECIMAL(28,6)) AS DECIMAL(38,6)) AS whole FROM gaps),
each_day AS (
  SELECT store_id, CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date, b, daily, whole - daily * n AS rest
  FROM amounts),
lost AS (
  SELECT store_id, date, SUM(daily + CASE WHEN date = b THEN rest ELSE 0 END) AS lost FROM each_day GROUP BY ALL),
net AS (
  SELECT store_id, transaction_date AS date, {total(NET)} AS net_sales FROM transactions
  WHERE transaction_date <= DATE '2001-08-01' GROUP BY ALL)
SELECT store_id, date, CAST(COALESCE(lost, 0) AS DOUBLE) AS lost, net_sales,
       {div('COALESCE(lost, 0)', 'net_sales')} AS stockout_index,
       {div('COALESCE(lost, 0)', 'net_sales')} < 0.02 AS meets_target
FROM net FULL JOIN (SELECT * FROM lost WHERE lost <> 0) lost USING (store_id, date)""")
oracle("kpi_margin_return_monthly", f"""
sold AS (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, vendor_id, category, SUM({LINE}) AS v,
         SUM(quantity * CAST(cost AS DECIMAL(18,6))) AS c
  FROM transaction_items i JOIN transactions t ON t.transaction_id = i.transaction_id AND status = 'COMPLETED'
  JOIN products p ON p.item_id = i.item_id GROUP BY ALL)
SELECT month, sold.vendor_id, COALESCE(vendor_name, 'SIN_VENDOR') AS vendor_name, category, {dbl('v')} AS ventas_brutas_items,
       {dbl('c')} AS costo_total, {div('v - c', 'c')} AS retorno_margen_bruto_sobre_costo, {div('v - c', 'c')} > 1.5 AS meets_target
FROM sold LEFT JOIN vendors v ON v.vendor_id = sold.vendor_id""")
oracle("kpi_health_score_weekly", _daily_availability("2001-01-01", "2001-06-30") + f""",
parts AS (
  SELECT {WEEK} AS week_start, s.store_id, s.format, {div(f'SUM({NET})', 'MAX(size_sqm)')} AS sales_per_sqm,
         {div('COUNT(DISTINCT transaction_id)', 'MAX(size_sqm)')} AS tx_per_sqm,
         {div(f'SUM({NET})', 'COUNT(DISTINCT transaction_id)')} AS ticket
  FROM transactions t JOIN stores s ON s.store_id = t.store_id
  WHERE {WEEK} >= DATE '2001-01-01' AND {WEEK} + 6 <= DATE '2001-06-30' GROUP BY ALL),
joined AS (
  SELECT p.*, availability FROM parts p LEFT JOIN avail a ON a.store_id = p.store_id AND a.date = p.week_start + 6),
scaled AS (
  SELECT *, {', '.join(f"({c} - MIN({c}) OVER w) / NULLIF(MAX({c}) OVER w - MIN({c}) OVER w, 0) AS {c}_scaled"
                        for c in ('sales_per_sqm', 'tx_per_sqm', 'ticket', 'availability'))}
  FROM joined WINDOW w AS (PARTITION BY week_start, format)),
final AS (
  SELECT *, (sales_per_sqm_scaled * CAST(0.4 AS DOUBLE) + tx_per_sqm_scaled * CAST(0.25 AS DOUBLE)
             + ticket_scaled * CAST(0.2 AS DOUBLE) + availability_scaled * CAST(0.15 AS DOUBLE)) * 100 AS score FROM scaled)
SELECT * EXCLUDE (score), ROUND(score, 8) AS health_score, score >= 75 AS meets_target FROM final""")

# ---------------------------------------------------------------- incremental and streaming
_FEED_TOTALS = f"COUNT(*) AS tickets, {total(NET)} AS ventas_netas"
oracle("stream_ingest", f"""
SELECT event_id, strftime(ts, {TS}) AS ts, user_id, event_type, value, TRUE AS hashed, TRUE AS dated FROM events""")
_PARTS = ", ".join(
    f"CAST(SUM(CAST(CAST('0x' || substr(h, {at}, 8) AS BIGINT) AS HUGEINT)) AS VARCHAR)" for at in (1, 9, 17, 25)
)
oracle("stream_ingest_ledger", f"""
hashed AS (
  SELECT user_id % 4 AS part, event_id, sha256('{{"event_id":' || event_id || ',"event_type":' || to_json(event_type)
           || ',"props":' || to_json(props) || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || user_id
           || ',"value":' || to_json(value) || '}}') AS h FROM events)
SELECT part, sha256(concat_ws('|', CAST(COUNT(*) AS VARCHAR), {_PARTS})) AS source_hash, COUNT(*) AS rows,
       COUNT(DISTINCT event_id) AS events, CAST(1 AS BIGINT) AS files
FROM hashed GROUP BY part""")
oracle("stream_validate", f"""
SELECT transaction_id, strftime(ts, {TS}) AS ts, store_id, total_amount, status,
       IF(total_amount <= 1, 'nonpositive_amount', 'ok') AS verdict FROM feed""")
oracle("stream_findings", f"""
SELECT 'Staging' AS dimension, IF(total_amount <= 1, 'nonpositive_amount', 'ok') AS "check", COUNT(*) AS failed,
       (SELECT COUNT(*) FROM feed) AS total, {div('COUNT(*)', '(SELECT COUNT(*) FROM feed)')} * 100 AS pct
FROM feed WHERE total_amount <= 1 GROUP BY ALL""")
oracle("stream_dedup", "SELECT transaction_id, store_id, total_amount, status FROM feed")
oracle("stream_hourly_sales", f"""
SELECT strftime(date_trunc('hour', ts), {TS}) AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {TS}) AS window_end, store_id, {_FEED_TOTALS}
FROM feed WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 2 HOUR FROM feed) GROUP BY ALL""")
_ROLLING = f"""
windows AS (
  SELECT date_trunc('hour', ts) - back * INTERVAL 1 HOUR AS ws, feed.* FROM feed CROSS JOIN (VALUES (0), (1), (2)) b(back)),
rolled AS (
  SELECT ws, ws + INTERVAL 3 HOUR AS we, store_id, {_FEED_TOTALS} FROM windows GROUP BY ALL)
SELECT strftime(ws, {TS}) AS window_start, strftime(we, {TS}) AS window_end, store_id, tickets, ventas_netas FROM rolled
"""
oracle("rolling_sales", _ROLLING)
oracle("stream_rolling_sales", _ROLLING + " WHERE we <= (SELECT MAX(ts) - INTERVAL 2 HOUR FROM feed)")
_SILENCE = """
nexts AS (SELECT store_id, ts, LEAD(ts) OVER (PARTITION BY store_id ORDER BY ts) AS nxt, ts AS since FROM feed
  UNION ALL SELECT store_id, NULL, NULL, (SELECT MIN(ts) FROM feed) FROM stores
  WHERE store_id NOT IN (SELECT store_id FROM feed)),
-- Opening hours are 8 to 22.  Two of them have passed at since + 2 h if all of that lies within
-- them, else two hours after the next opening.
due AS (
  SELECT *, CAST(since AS DATE) AS d, since - date_trunc('day', since) AS t FROM nexts),
alerts AS (
  SELECT store_id, ts, nxt, CASE
      WHEN t < INTERVAL 8 HOUR THEN CAST(d AS TIMESTAMP) + INTERVAL 10 HOUR
      WHEN t < INTERVAL 20 HOUR THEN since + INTERVAL 2 HOUR
      ELSE CAST(d AS TIMESTAMP) + INTERVAL 34 HOUR END AS alert_at FROM due
  WHERE COALESCE(nxt, (SELECT MAX(ts) FROM feed)) >= CASE
      WHEN t < INTERVAL 8 HOUR THEN CAST(d AS TIMESTAMP) + INTERVAL 10 HOUR
      WHEN t < INTERVAL 20 HOUR THEN since + INTERVAL 2 HOUR
      ELSE CAST(d AS TIMESTAMP) + INTERVAL 34 HOUR END)
"""
oracle("silent_intervals", _SILENCE + f"""
SELECT store_id, strftime(ts, {TS}) AS last_ts, strftime(alert_at, {TS}) AS alert_at, strftime(nxt, {TS}) AS next_ts FROM alerts""")
oracle("stream_no_data_alert", _SILENCE + f"""
SELECT store_id, strftime(ts, {TS}) AS last_ts, strftime(alert_at, {TS}) AS alert_at FROM alerts
WHERE ts IS NOT NULL AND alert_at <= (SELECT MAX(ts) - INTERVAL 2 HOUR FROM feed)""")
# Live, each active store is watched from the first opening on, also those that never report.
oracle("stream_live_alerts", _SILENCE.replace("""  UNION ALL SELECT store_id, NULL, NULL, (SELECT MIN(ts) FROM feed) FROM stores
  WHERE store_id NOT IN (SELECT store_id FROM feed)),""", """  UNION ALL
  SELECT w.store_id, NULL, (SELECT MIN(ts) FROM feed f WHERE f.store_id = w.store_id), TIMESTAMP '2024-01-01 08:00:00'
  FROM (SELECT store_id FROM stores UNION ALL SELECT store_id + 100 FROM stores WHERE store_id < 2) w),""") + f"""
SELECT store_id, strftime(ts, {TS}) AS last_ts, strftime(alert_at, {TS}) AS alert_at FROM alerts
WHERE alert_at <= (SELECT MAX(ts) - INTERVAL 2 HOUR FROM feed)""")
oracle("reprocess_window", f"""
SELECT store_id, strftime(date_trunc('hour', ts), {TS}) AS hour, {_FEED_TOTALS} FROM feed
WHERE date_trunc('hour', ts) >= (SELECT date_trunc('hour', MAX(ts)) - INTERVAL 72 HOUR FROM feed)
  AND date_trunc('hour', ts) < (SELECT date_trunc('hour', MAX(ts)) FROM feed)
GROUP BY store_id, date_trunc('hour', ts)""")
oracle("reprocess_written", f"""
span AS (SELECT date_trunc('hour', MAX(ts)) - INTERVAL 72 HOUR AS a, date_trunc('hour', MAX(ts)) AS b FROM feed),
told AS (
  SELECT feed.* FROM feed, span
  WHERE CASE WHEN ts >= a AND ts < b THEN hour(ts) <> 3 ELSE NOT (ts >= a AND transaction_id % 5 = 0) END)
SELECT store_id, strftime(date_trunc('hour', ts), {TS}) AS hour, {_FEED_TOTALS} FROM told
GROUP BY store_id, date_trunc('hour', ts)""")
oracle("published_days", f"""
sent AS (SELECT *, CAST(ts AS DATE) AS date FROM feed WHERE NOT (day(ts) % 3 = 0 AND store_id = 7)),
per_day AS (SELECT store_id, date, {_FEED_TOTALS} FROM sent GROUP BY ALL)
SELECT * FROM per_day WHERE date IN (
  SELECT date FROM per_day WHERE store_id IN (SELECT store_id FROM stores WHERE opening_date <= date)
  GROUP BY date HAVING COUNT(*) = (SELECT COUNT(*) FROM stores))""")
oracle("freshness_expected", f"""
hourly AS (SELECT store_id, date_trunc('hour', ts) AS h, COUNT(*) AS n FROM feed GROUP BY ALL),
spine AS (
  SELECT store_id, never, UNNEST(generate_series(f, (SELECT MAX(h) FROM hourly), INTERVAL 1 HOUR)) AS h
  FROM (SELECT store_id, FALSE AS never, MIN(h) AS f FROM hourly GROUP BY store_id
        UNION ALL SELECT store_id, TRUE, (SELECT MIN(h) FROM hourly) FROM stores
        WHERE store_id NOT IN (SELECT store_id FROM hourly))),
dense AS (SELECT s.store_id, never, s.h, COALESCE(n, 0) AS n FROM spine s LEFT JOIN hourly USING (store_id, h)),
slots AS (
  SELECT *, SUM(n) OVER w AS s, COUNT(*) OVER w AS c FROM dense
  WINDOW w AS (PARTITION BY store_id, dayofweek(h), hour(h) ORDER BY h ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT store_id, strftime(h, {TS}) AS hour, n AS tickets, {div('s', 'c')} AS expected,
       never OR COALESCE(n < {div('s', 'c')} * 0.5, FALSE) AS late FROM slots""")
# The batch form's own week, with one more store that never reports.
oracle("stream_freshness", f"""
watched AS (SELECT store_id FROM stores UNION ALL SELECT 100),
live AS (
  SELECT * FROM feed WHERE ts < TIMESTAMP '2024-01-29'),
hourly AS (SELECT store_id, date_trunc('hour', ts) AS h, COUNT(*) AS n FROM live GROUP BY ALL),
begun AS (SELECT store_id, MIN(h) AS f FROM hourly WHERE h < TIMESTAMP '2024-01-22' GROUP BY store_id),
spine AS (
  SELECT w.store_id, f IS NULL AS never, UNNEST(generate_series(
           COALESCE(f, TIMESTAMP '2024-01-01'), TIMESTAMP '2024-01-28 23:00:00', INTERVAL 1 HOUR)) AS h
  FROM watched w LEFT JOIN begun USING (store_id)),
dense AS (SELECT s.store_id, never, s.h, COALESCE(n, 0) AS n FROM spine s LEFT JOIN hourly USING (store_id, h)),
slots AS (
  SELECT *, SUM(n) OVER w AS s, COUNT(*) OVER w AS c FROM dense
  WINDOW w AS (PARTITION BY store_id, dayofweek(h), hour(h) ORDER BY h ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT store_id, strftime(h, {TS}) AS hour, n AS tickets, CASE WHEN NOT never THEN {div('s', 'c')} END AS expected,
       never OR COALESCE(n < {div('s', 'c')} * 0.5, FALSE) AS late
FROM slots WHERE h >= (SELECT MIN(h) FROM hourly WHERE h >= TIMESTAMP '2024-01-22')
  AND h <= (SELECT MAX(h) FROM hourly WHERE h + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 2 HOUR FROM live))""")
_UPDATED = "ROUND(total_amount + IF(status = 'RETURNED', 1, 0), 2)"
oracle("merge_upsert", f"""
SELECT * REPLACE ({_UPDATED} AS total_amount),
       CASE WHEN transaction_date >= DATE '2001-01-01' THEN 'inserted' WHEN status = 'RETURNED' THEN 'updated'
            ELSE 'unchanged' END AS merge_action FROM transactions""")
oracle("upsert_partitions", f"SELECT * REPLACE ({_UPDATED} AS total_amount) FROM transactions")
oracle("stream_upsert", f"""
SELECT transaction_id, {_UPDATED} AS total_amount, status, payment_method, 1 AS version FROM transactions""")
oracle("latest_per_key", """
SELECT transaction_item_id, MAX(transaction_id) AS transaction_id, MAX(unit_price) AS unit_price
FROM transaction_items GROUP BY transaction_item_id""")
_EXPECTED = """
days AS (SELECT CAST(UNNEST(generate_series(DATE '2001-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS date),
expected AS (SELECT store_id, date FROM stores CROSS JOIN days WHERE opening_date <= date),
seen AS (SELECT DISTINCT store_id, transaction_date AS date FROM transactions)
"""
oracle("day_certification", _EXPECTED + """
SELECT e.date, COUNT(*) AS stores_expected, COUNT(s.store_id) AS stores_reported,
       COUNT(*) - COUNT(s.store_id) AS stores_missing, COUNT(*) = COUNT(s.store_id) AS certified
FROM expected e LEFT JOIN seen s ON s.store_id = e.store_id AND s.date = e.date GROUP BY e.date""")
oracle("missing_store_days", _EXPECTED + "SELECT store_id, date FROM expected EXCEPT SELECT store_id, date FROM seen")
oracle("close_day", f"""
SELECT store_id, transaction_date, {total(NET)} AS ventas_netas, COUNT(*) AS transacciones FROM transactions
WHERE transaction_date = (SELECT MAX(transaction_date) - 1 FROM transactions) GROUP BY ALL""")
oracle("reconcile_metric", f"""
by_ticket AS (SELECT store_id, status, SUM({NET}) AS v, COUNT(*) AS n FROM transactions GROUP BY ALL),
by_line AS (
  SELECT store_id, status, SUM(CASE WHEN status = 'RETURNED' THEN -{LINE} ELSE {LINE} END) AS v,
         COUNT(DISTINCT t.transaction_id) AS n
  FROM transactions t JOIN transaction_items i ON i.transaction_id = t.transaction_id GROUP BY ALL)
SELECT a.store_id, a.status, {dbl('a.v')} AS ventas_tickets, {dbl('COALESCE(b.v, 0)')} AS ventas_items,
       {dbl('a.v - COALESCE(b.v, 0)')} AS diferencia, a.n AS tickets, COALESCE(b.n, 0) AS tickets_con_items
FROM by_ticket a LEFT JOIN by_line b ON b.store_id = a.store_id AND b.status = a.status""")

# Row counts of the stored marts, from the marts' own oracles.
_MART_NAMES = {
    "ventas_comparables": "comp_sales_store",
    "productividad_tienda": "store_productivity",
    "cohortes_lealtad": "cohort_retention",
    "retorno_margen": "vendor_margin_return",
    "quiebres_stock": "stock_gaps",
    "promociones": "promo_impact",
}
ORACLES["run_marts"] = " UNION ALL ".join(
    f"SELECT '{mart}' AS tabla, COUNT(*) AS filas FROM ({ORACLES[name]})" for mart, name in _MART_NAMES.items()
)

ORACLES["stored_layout"] = ORACLES["category_sales"]
_REPORTS = {
    "comp_sales_store": "comp_sales_store", "comp_sales_country_format": "comp_sales_country_format",
    "productivity_store": "store_productivity", "cohort_retention": "cohort_retention", "cohort_ticket": "cohort_retention",
    "vendor_margin": "vendor_margin_return", "promo_basket_category": "promo_impact_long",
    "weekly_sales_format": "weekly_change", "pareto_category_format": "pareto",
}
ORACLES["export_reports"] = " UNION ALL ".join(
    [f"SELECT '{report}' AS reporte, COUNT(*) AS filas FROM ({ORACLES[name]})" for report, name in _REPORTS.items()]
    + [f"SELECT 'stock_gaps_top', LEAST(1000, COUNT(*)) FROM ({ORACLES['stock_gaps']})"]
)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
