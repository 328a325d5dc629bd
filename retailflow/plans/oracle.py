"""Oracle SQL (DuckDB dialect) for every registered query.

The driver tables are pre-registered as views. Each statement recomputes the
query independently, from the raw tables, with exact decimal arithmetic.

Rounding rules used to compare across engines:
* money is cast to DECIMAL(18,2) before any arithmetic;
* ratios of exact values are rounded half-up with integer arithmetic on
  cents, ``(2*a*10^k + b) // (2*b) / 10^k``, because DuckDB's ``round`` on a
  double rounds the binary value (1.005 -> 1.0) where Spark rounds the
  shortest decimal form (1.005 -> 1.01);
* Spark's half-up rounding of a double ``x`` is reproduced from the exact
  decimal that ``x`` approximates (``spark_round``);
* DuckDB's ``dayofweek`` is 0-based (Sunday 0), Spark's 1-based.
"""

from __future__ import annotations


class C:
    """Constants of the statements, written out here: the oracle shares none with the code that it checks."""

    BAND_LABELS = ("Baixo", "Médio", "Alto")
    PRICE_CUTS = (10, 20)
    STOCK_CUTS = (105, 115)
    POPULARITY_LABELS = ("Top", "Média", "Long tail")
    POPULARITY_CUTS = (10, 40)
    STAR_RANK = 10
    COST_RATE = 0.65
    REGION_IN_LABEL, REGION_OUT_LABEL = "Grande Vitória", "Interior"
    WEEKEND_DAYS = (1, 7)


class CAL:
    MONTH_NAMES = {
        "en": ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
               "November", "December"),
        "pt": ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro",
               "novembro", "dezembro"),
    }
    WEEKDAY_NAMES = {
        "en": ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"),
        "pt": ("domingo", "segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sábado"),
    }


class fx:
    SKU_WIDTH, ZIPF_EXPONENT, STOCK_TOP_RANK, STOCK_BASE, STOCK_SPREAD, STOCK_SALT = 6, 1.1, 40, 100, 20, "stock"
    FIXTURE_PRICE_CUTS = (933, 967)
    FIXTURE_CORE_CITIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
    FIXTURE_CAPITAL, FIXTURE_STATE = "EUROPE", "ES"


class SY:
    TX_DIVISOR, TX_LOW, TX_WIDTH, SEASON_AMPLITUDE, BASKET_MAX, U_RESOLUTION = 6, 0.8, 0.4, 0.15, 6, 1_000_000
    PICK_FACTOR, QTY_P2, QTY_P3, DISC_P, DISC_LOW, DISC_WIDTH = 3.0, 0.35, 0.10, 0.12, 0.05, 0.15
    ZIPF_S, PRICE_BASE, PRICE_MOD, PRICE_SPREAD, STATE = 1.1, 5, 20, 10, "ES"
    CATEGORIES = ("Acessórios", "Bebidas", "Cozinha", "Limpeza", "Higiene", "Snacks")
    BRANDS = ("MarcaA", "MarcaB", "MarcaC", "MarcaD")
    CITIES = ("Vitoria", "Serra", "Vila Velha", "Cariacica", "Guarapari", "Linhares")


def spark_round(x: str, exact: str, k: int) -> str:
    """Spark's round(double, k) of a double ``x`` that approximates the exact
    decimal ``exact``. Spark rounds the shortest decimal form of x half-up:
    when x is the double nearest to ``exact`` that form is ``exact`` itself;
    otherwise x sits a few ulps off and rounding x directly decides the side."""
    return (f"CASE WHEN ({x}) = CAST(({exact}) AS DOUBLE) THEN CAST(round(({exact}), {k}) AS DOUBLE) "
            f"ELSE round(({x}), {k}) END")


def half_up_ratio(a: str, b: str, k: int) -> str:
    """round(a / b, k) half-up for money a, b >= 0 (as DECIMAL(_,2)); b > 0."""
    ia, ib = f"CAST(({a}) * 100 AS HUGEINT)", f"CAST(({b}) * 100 AS HUGEINT)"
    return f"((2 * {ia} * {10 ** k} + {ib}) // (2 * {ib})) / CAST({10 ** k} AS DOUBLE)"


def half_up_per_count(a: str, n: str, k: int = 2) -> str:
    """round(a / n, k) half-up for money a >= 0 and a count n > 0."""
    ia = f"CAST(({a}) * 100 AS HUGEINT)"
    scale = 10 ** k // 100 if k >= 2 else 1
    return f"((2 * {ia} * {scale} + ({n})) // (2 * ({n}))) / CAST({10 ** k} AS DOUBLE)"


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---------------------------------------------------------------- fixtures --
SALES_CTE = """
sales AS (
  SELECT CAST(l.l_shipdate AS DATE) AS sale_date,
         l.l_orderkey AS order_id,
         sr.store_id,
         l.l_partkey AS product_id,
         CAST(trunc(l.l_quantity) AS INTEGER) AS qty,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(5,4))), 2) AS DECIMAL(18,2)) AS net,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS discount
  FROM lineitem l
  LEFT JOIN (SELECT s.s_suppkey, CAST(n.n_regionkey AS VARCHAR) AS store_id
             FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey) sr
         ON l.l_suppkey = sr.s_suppkey
),
silver_sales AS (
  SELECT *, net + discount AS gross FROM sales
)"""

PRODUCTS_CTE = f"""
sold AS (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_partkey),
ranked AS (
  SELECT p.p_partkey AS product_id,
         'SKU-' || CASE WHEN length(CAST(p.p_partkey AS VARCHAR)) > {fx.SKU_WIDTH}
                        THEN CAST(p.p_partkey AS VARCHAR)
                        ELSE lpad(CAST(p.p_partkey AS VARCHAR), {fx.SKU_WIDTH}, '0') END AS sku,
         p.p_name AS product_name, p.p_type AS category, p.p_brand AS brand,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS list_price,
         CAST(row_number() OVER (ORDER BY coalesce(s.q, 0) DESC, p.p_partkey) AS INTEGER) AS rank
  FROM part p LEFT JOIN sold s ON s.l_partkey = p.p_partkey
),
weighted AS (
  SELECT *, pow(1.0::DOUBLE / rank, {fx.ZIPF_EXPONENT}::DOUBLE)
            / sum(pow(1.0::DOUBLE / rank, {fx.ZIPF_EXPONENT}::DOUBLE)) OVER () AS weight
  FROM ranked
),
costed AS (
  SELECT *, {spark_round(f"CAST(list_price AS DOUBLE) * {C.COST_RATE}::DOUBLE",
                         f"list_price * CAST({C.COST_RATE} AS DECIMAL(4,2))", 2)} AS est_cost FROM weighted
),
margined AS (
  SELECT *, round(CAST(list_price AS DOUBLE) - est_cost, 2) AS margin FROM costed
),
products AS (
  SELECT product_id, sku, product_name, category, brand, list_price,
         CASE WHEN list_price < {fx.FIXTURE_PRICE_CUTS[0]} THEN '{C.BAND_LABELS[0]}'
              WHEN list_price < {fx.FIXTURE_PRICE_CUTS[1]} THEN '{C.BAND_LABELS[1]}'
              ELSE '{C.BAND_LABELS[2]}' END AS price_band,
         rank,
         CAST(row_number() OVER (PARTITION BY category ORDER BY list_price DESC, product_id) AS INTEGER)
           AS price_rank_in_category,
         CASE WHEN rank <= {C.POPULARITY_CUTS[0]} THEN '{C.POPULARITY_LABELS[0]}'
              WHEN rank <= {C.POPULARITY_CUTS[1]} THEN '{C.POPULARITY_LABELS[1]}'
              ELSE '{C.POPULARITY_LABELS[2]}' END AS popularity,
         rank <= {C.STAR_RANK} AS is_star,
         weight, est_cost, margin,
         CASE WHEN list_price > 0 THEN round(margin / CAST(list_price AS DOUBLE), 4) ELSE 0.0::DOUBLE END
           AS margin_pct
  FROM margined
)"""

STORES_CTE = f"""
stores AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS store_id,
         CAST(r_regionkey AS INTEGER) AS store_id_int,
         'Loja ' || CAST(r_regionkey AS VARCHAR) AS store_name,
         r_name AS city,
         CASE WHEN r_name IN ({_q(fx.FIXTURE_CORE_CITIES)}) THEN '{C.REGION_IN_LABEL}'
              ELSE '{C.REGION_OUT_LABEL}' END AS region,
         '{fx.FIXTURE_STATE}' AS state,
         r_name = '{fx.FIXTURE_CAPITAL}' AS is_capital
  FROM region
)"""

STOCK_CTE = f"""
span AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
days AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS stock_date FROM span
),
top_products AS (SELECT product_id FROM ranked WHERE rank <= {fx.STOCK_TOP_RANK}),
stock AS (
  SELECT d.stock_date, CAST(r.r_regionkey AS VARCHAR) AS store_id, t.product_id,
         CAST({fx.STOCK_BASE} + (('0x' || substr(md5(CAST(t.product_id AS VARCHAR) || '|' ||
              CAST(r.r_regionkey AS VARCHAR) || '|' || CAST(d.stock_date AS VARCHAR) || '|{fx.STOCK_SALT}'), 1, 8))::BIGINT
              % {fx.STOCK_SPREAD}) AS INTEGER) AS stock_qty
  FROM region r, top_products t, days d
)"""


def calendar_cte(locale: str) -> str:
    return f"""
cal_span AS (SELECT make_date(year(min(l_shipdate)), 1, 1) AS lo,
                    make_date(year(max(l_shipdate)), 12, 31) AS hi FROM lineitem),
calendar AS (
  SELECT day,
         CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
         CAST(day(day) AS INTEGER) AS day_of_month, CAST(quarter(day) AS INTEGER) AS quarter,
         strftime(day, '%Y-%m') AS year_month,
         [{_q(CAL.MONTH_NAMES[locale])}][month(day)] AS month_name,
         CAST(dayofweek(day) + 1 AS INTEGER) AS weekday_num,
         [{_q(CAL.WEEKDAY_NAMES[locale])}][dayofweek(day) + 1] AS weekday_name,
         dayofweek(day) + 1 IN ({", ".join(str(d) for d in C.WEEKEND_DAYS)}) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM cal_span)
)"""


CALENDAR_CTE = calendar_cte("en")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _fact_measures(stock_col: str | None = "stock_qty") -> str:
    stock = (f""",
  CASE WHEN count({stock_col}) > 0
       THEN ((200 * sum({stock_col}) + count({stock_col})) // (2 * count({stock_col}))) / 100.0::DOUBLE END AS stock_avg,
  max({stock_col}) AS stock_final""" if stock_col else """,
  CAST(NULL AS DOUBLE) AS stock_avg, CAST(NULL AS INTEGER) AS stock_final""")
    return f"""
  CAST(sum(qty) AS BIGINT) AS qty_sold,
  CAST(count(DISTINCT order_id) AS BIGINT) AS orders,
  CAST(sum(gross) AS DOUBLE) AS gross_total,
  CAST(sum(net) AS DOUBLE) AS net_total,
  CAST(sum(discount) AS DOUBLE) AS discount_total,
  CASE WHEN sum(gross) > 0 THEN {half_up_ratio('sum(discount)', 'sum(gross)', 4)} ELSE 0.0::DOUBLE END AS discount_pct,
  CASE WHEN sum(qty) > 0 THEN {half_up_per_count('sum(gross)', 'sum(qty)')} END AS unit_value,
  CASE WHEN count(DISTINCT order_id) > 0
       THEN {half_up_per_count('sum(net)', 'count(DISTINCT order_id)')} ELSE 0.0::DOUBLE END AS avg_ticket{stock}"""


SALES_WITH_STOCK = """
lines AS (
  SELECT s.*, k.stock_qty FROM silver_sales s
  LEFT JOIN stock k ON s.sale_date = k.stock_date AND s.store_id = k.store_id AND s.product_id = k.product_id
)"""

SQL: dict[str, str] = {}

SQL["fact_daily_sales"] = _with(SALES_CTE, PRODUCTS_CTE, STOCK_CTE, SALES_WITH_STOCK) + f"""
SELECT sale_date, store_id, product_id,{_fact_measures()}
FROM lines GROUP BY sale_date, store_id, product_id"""

SQL["fact_daily_sales_by_store"] = _with(SALES_CTE, PRODUCTS_CTE, STOCK_CTE, SALES_WITH_STOCK) + f"""
SELECT sale_date, store_id,{_fact_measures()}
FROM lines GROUP BY sale_date, store_id"""

SQL["fact_monthly_sales_by_category"] = _with(SALES_CTE, PRODUCTS_CTE, STOCK_CTE, STORES_CTE, SALES_WITH_STOCK) + f"""
SELECT strftime(l.sale_date, '%Y-%m') AS year_month, st.region, p.category,{_fact_measures()}
FROM lines l LEFT JOIN products p ON l.product_id = p.product_id
             LEFT JOIN stores st ON l.store_id = st.store_id
GROUP BY 1, 2, 3"""

SQL["silver_sales"] = _with(SALES_CTE) + f"""
SELECT sale_date, order_id, store_id, product_id, qty,
       CAST(gross AS DOUBLE) AS gross, CAST(net AS DOUBLE) AS net, CAST(discount AS DOUBLE) AS discount,
       CASE WHEN gross > 0 THEN {half_up_ratio('discount', 'gross', 4)} ELSE 0.0::DOUBLE END AS discount_pct,
       CASE WHEN qty > 0 THEN {half_up_per_count('gross', 'qty')} END AS unit_value
FROM silver_sales"""

_PRODUCT_COLS = """product_id, sku, product_name, category, brand, CAST(list_price AS DOUBLE) AS list_price,
       price_band, rank, price_rank_in_category, popularity, is_star, round(weight, 10) AS weight,
       est_cost, margin, margin_pct"""

SQL["silver_products"] = _with(PRODUCTS_CTE) + f"\nSELECT {_PRODUCT_COLS} FROM products"
SQL["dim_products"] = SQL["silver_products"]

SQL["silver_stores"] = _with(STORES_CTE) + "\nSELECT * FROM stores"
SQL["dim_stores"] = SQL["silver_stores"]

_STOCK_BAND = f"""CASE WHEN stock_qty < {C.STOCK_CUTS[0]} THEN '{C.BAND_LABELS[0]}'
              WHEN stock_qty < {C.STOCK_CUTS[1]} THEN '{C.BAND_LABELS[1]}'
              ELSE '{C.BAND_LABELS[2]}' END"""

SQL["silver_stock"] = _with(PRODUCTS_CTE, STOCK_CTE) + f"""
SELECT stock_date, store_id, product_id, stock_qty, {_STOCK_BAND} AS stock_band FROM stock"""
SQL["fact_daily_stock"] = SQL["silver_stock"]

SQL["dim_calendar"] = _with(CALENDAR_CTE) + "\nSELECT * FROM calendar"
SQL["dim_calendar_pt"] = _with(calendar_cte("pt")) + "\nSELECT * FROM calendar"
SQL["fact_daily_sales_by_store_preaggregated"] = SQL["fact_daily_sales_by_store"]
SQL["written_fact_by_store"] = SQL["fact_daily_sales_by_store"]

SQL["dedup_order_lines"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       CAST(l_shipdate AS DATE) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                            l_discount, l_shipdate) AS rn
      FROM lineitem)
WHERE rn = 1"""

SQL["average_ticket"] = _with(SALES_CTE, STORES_CTE) + f"""
SELECT st.region, CAST(year(s.sale_date) AS INTEGER) AS sale_year,
       CAST(sum(s.net) AS DOUBLE) AS net_total,
       CAST(count(DISTINCT s.order_id) AS BIGINT) AS orders,
       CASE WHEN count(DISTINCT s.order_id) > 0
            THEN {half_up_per_count('sum(s.net)', 'count(DISTINCT s.order_id)')} ELSE 0.0::DOUBLE END AS avg_ticket
FROM silver_sales s LEFT JOIN stores st ON s.store_id = st.store_id
GROUP BY 1, 2"""

SQL["abc_products"] = _with(SALES_CTE) + """,
rev AS (SELECT product_id, sum(net) AS revenue FROM sales GROUP BY product_id),
cum AS (
  SELECT product_id, revenue,
         sum(revenue) OVER (ORDER BY revenue DESC, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_value,
         sum(revenue) OVER () AS total
  FROM rev
)
SELECT product_id, CAST(revenue AS DOUBLE) AS revenue, CAST(cum_value AS DOUBLE) AS cum_value,
       round(CAST(cum_value AS DOUBLE) / CAST(total AS DOUBLE), 10) AS cum_share,
       CASE WHEN cum_value - revenue < total * 0.80 THEN 'A'
            WHEN cum_value - revenue < total * 0.95 THEN 'B' ELSE 'C' END AS abc_class
FROM cum"""

SQL["load_report"] = _with(SALES_CTE, PRODUCTS_CTE, STOCK_CTE) + """
SELECT 'products' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM ranked
UNION ALL SELECT 'stores', CAST(count(*) AS BIGINT) FROM region
UNION ALL SELECT 'stock', CAST(count(*) AS BIGINT) FROM stock
UNION ALL SELECT 'sales', CAST(count(*) AS BIGINT) FROM sales"""

SQL["dq_null_keys"] = _with(SALES_CTE) + """
SELECT 'sale_date' AS column_name, CAST(count(*) FILTER (WHERE sale_date IS NULL) AS BIGINT) AS null_count FROM sales
UNION ALL SELECT 'order_id', CAST(count(*) FILTER (WHERE order_id IS NULL) AS BIGINT) FROM sales
UNION ALL SELECT 'store_id', CAST(count(*) FILTER (WHERE store_id IS NULL) AS BIGINT) FROM sales
UNION ALL SELECT 'product_id', CAST(count(*) FILTER (WHERE product_id IS NULL) AS BIGINT) FROM sales"""

SQL["dq_duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS dup_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

SQL["dq_orphans"] = """
SELECT 'lineitem' AS child_table, 'orders' AS parent_table,
       CAST(count(*) AS BIGINT) AS violations
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
UNION ALL
SELECT 'lineitem', 'part', CAST(count(*) AS BIGINT)
FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
UNION ALL
SELECT 'lineitem', 'supplier', CAST(count(*) AS BIGINT)
FROM lineitem WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)"""


def _pk(rule: str, table: str, key: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{table}' AS table_name, '{key}' AS key_columns,
       CAST((SELECT count(*) FROM {table} WHERE {key} IS NULL)
          + (SELECT count(*) - count(DISTINCT {key}) FROM {table} WHERE {key} IS NOT NULL) AS BIGINT) AS violations"""


def _fk(rule: str, table: str, key: str, ref: str, ref_key: str) -> str:
    return f"""SELECT '{rule}', '{table}', '{key}',
       CAST((SELECT count(*) FROM {table} t WHERE t.{key} IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM {ref} r WHERE r.{ref_key} = t.{key})) AS BIGINT)"""


SQL["gold_key_report"] = _with(
    SALES_CTE, PRODUCTS_CTE, STOCK_CTE, STORES_CTE, CALENDAR_CTE,
    """
dim_stores AS (SELECT * FROM stores),
dim_products AS (SELECT * FROM products),
dim_calendar AS (SELECT * FROM calendar),
fact_daily_sales AS (SELECT DISTINCT sale_date, store_id, product_id FROM sales),
fact_daily_stock AS (SELECT * FROM stock)""") + "\nSELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'violated' END AS status FROM (\n" + "\nUNION ALL\n".join([
    _pk("pk_dim_stores", "dim_stores", "store_id"),
    _pk("pk_dim_products", "dim_products", "product_id"),
    _pk("pk_dim_calendar", "dim_calendar", "day"),
    _fk("fk_fact_sales_dim_calendar", "fact_daily_sales", "sale_date", "dim_calendar", "day"),
    _fk("fk_fact_sales_dim_stores", "fact_daily_sales", "store_id", "dim_stores", "store_id"),
    _fk("fk_fact_sales_dim_products", "fact_daily_sales", "product_id", "dim_products", "product_id"),
    _fk("fk_fact_stock_dim_calendar", "fact_daily_stock", "stock_date", "dim_calendar", "day"),
    _fk("fk_fact_stock_dim_stores", "fact_daily_stock", "store_id", "dim_stores", "store_id"),
    _fk("fk_fact_stock_dim_products", "fact_daily_stock", "product_id", "dim_products", "product_id"),
]) + "\n)"


def _u(keys: str, salt: str) -> str:
    """Keyed uniform draw: first 8 hex digits of md5('k1|k2|...|salt') / 2^32."""
    return f"(('0x' || substr(md5({keys} || '|{salt}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


_DS = "CAST(day AS VARCHAR) || '|' || store_id"
_DSO = _DS + " || '|' || CAST(local_order AS VARCHAR)"
_DSOI = _DSO + " || '|' || CAST(item_no AS VARCHAR)"
_LINE = _DSOI + " || '|' || CAST(product_id AS VARCHAR)"

SYNTHETIC_CTE = f"""
synth_span AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
vol AS (SELECT (SELECT count(*) FROM orders)::DOUBLE / (date_diff('day', lo, hi) + 1)::DOUBLE AS tx_per_day
        FROM synth_span),
grid AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day,
         CAST(r.r_regionkey AS VARCHAR) AS store_id
  FROM synth_span, region r
),
tx AS (
  SELECT day, store_id,
         CAST(floor(round(greatest(1.0::DOUBLE,
              (SELECT tx_per_day FROM vol) / {float(SY.TX_DIVISOR)}::DOUBLE
              * (1.0::DOUBLE + {SY.SEASON_AMPLITUDE}::DOUBLE * sin(2.0::DOUBLE * pi() * (dayofweek(day)) / 7.0::DOUBLE))
              * ({SY.TX_LOW}::DOUBLE + {_u(_DS, 'tx')} * {SY.TX_WIDTH}::DOUBLE)), 9)) AS INTEGER) AS tx
  FROM grid
),
orders_ AS (SELECT day, store_id, unnest(generate_series(1, tx)) AS local_order FROM tx),
baskets AS (
  SELECT *, CAST(ceil(least({float(SY.BASKET_MAX)}::DOUBLE,
              1.0::DOUBLE + 3.0::DOUBLE * {_u(_DSO, 'basket1')} + 2.0::DOUBLE * {_u(_DSO, 'basket2')})) AS INTEGER) AS n_items
  FROM orders_
),
items AS (
  SELECT day, store_id, local_order, item_no,
         floor({_u(_DSOI.replace('item_no', 'item_no'), 'item')} * {float(SY.U_RESOLUTION)}::DOUBLE) / {float(SY.U_RESOLUTION)}::DOUBLE AS u
  FROM (SELECT *, unnest(generate_series(1, n_items)) AS item_no FROM baskets)
),
picked AS (
  SELECT i.*, w.product_id, w.list_price
  FROM items i JOIN weighted w ON i.u < w.weight * {SY.PICK_FACTOR}::DOUBLE
),
priced AS (
  SELECT *,
         CAST(1 + CAST({_u(_LINE, 'qty2')} < {SY.QTY_P2} AS INTEGER)
                + CAST({_u(_LINE, 'qty3')} < {SY.QTY_P3} AS INTEGER) AS INTEGER) AS qty,
         CASE WHEN {_u(_LINE, 'disc')} < {SY.DISC_P}
              THEN CAST({SY.DISC_LOW}::DOUBLE + {_u(_LINE, 'rate')} * {SY.DISC_WIDTH}::DOUBLE AS DECIMAL(5,4))
              ELSE CAST(0 AS DECIMAL(5,4)) END AS rate
  FROM picked
),
synthetic AS (
SELECT day AS sale_date,
       strftime(day, '%Y%m%d') || '-' || store_id || '-' ||
         CASE WHEN length(CAST(local_order AS VARCHAR)) > 6 THEN CAST(local_order AS VARCHAR)
              ELSE lpad(CAST(local_order AS VARCHAR), 6, '0') END AS order_id,
       store_id, product_id, qty,
       CAST(round(list_price * qty * (1 - rate), 2) AS DECIMAL(18,2)) AS net,
       CAST(round(list_price * qty * rate, 2) AS DECIMAL(18,2)) AS discount
FROM priced
)"""

SQL["synthetic_sales"] = _with(PRODUCTS_CTE, SYNTHETIC_CTE) + """
SELECT sale_date, order_id, store_id, product_id, qty, CAST(net AS DOUBLE) AS net, CAST(discount AS DOUBLE) AS discount
FROM synthetic"""

SQL["synthetic_fact_by_store"] = _with(PRODUCTS_CTE, SYNTHETIC_CTE, STOCK_CTE, """
lines AS (
  SELECT s.*, net + discount AS gross, k.stock_qty FROM synthetic s
  LEFT JOIN stock k ON s.sale_date = k.stock_date AND s.store_id = k.store_id AND s.product_id = k.product_id
)""") + f"""
SELECT sale_date, store_id,{_fact_measures()}
FROM lines GROUP BY sale_date, store_id"""

GENERATED_CTE = f"""
s AS (SELECT CAST(p_partkey + 1 AS INTEGER) AS p FROM part),
w AS (SELECT *, pow(1.0::DOUBLE / p, {SY.ZIPF_S}::DOUBLE) AS w0 FROM s),
generated AS (
SELECT p AS rank,
       'P' || CASE WHEN length(CAST(p AS VARCHAR)) > 4 THEN CAST(p AS VARCHAR) ELSE lpad(CAST(p AS VARCHAR), 4, '0') END
         AS product_id,
       'SKU-' || CASE WHEN length(CAST(p AS VARCHAR)) > 4 THEN CAST(p AS VARCHAR) ELSE lpad(CAST(p AS VARCHAR), 4, '0') END
         AS sku,
       'Produto ' || CAST(p AS VARCHAR) AS name,
       [{_q(SY.CATEGORIES)}][p % {len(SY.CATEGORIES)} + 1] AS category,
       [{_q(SY.BRANDS)}][p % {len(SY.BRANDS)} + 1] AS brand,
       CAST({SY.PRICE_BASE} + p % {SY.PRICE_MOD} + {_u("CAST(p AS VARCHAR)", "price")} * {SY.PRICE_SPREAD}
                 AS DECIMAL(18,2)) AS list_price,
       w0 / sum(w0) OVER () AS weight
FROM w
)"""

SQL["generated_products"] = _with(GENERATED_CTE) + """
SELECT rank, product_id, sku, name, category, brand, CAST(list_price AS DOUBLE) AS list_price, round(weight, 10) AS weight
FROM generated"""

SQL["silver_generated_products"] = _with(GENERATED_CTE, f"""
costed AS (
  SELECT *, {spark_round(f"CAST(list_price AS DOUBLE) * {C.COST_RATE}::DOUBLE",
                         f"list_price * CAST({C.COST_RATE} AS DECIMAL(4,2))", 2)} AS est_cost FROM generated
),
margined AS (SELECT *, round(CAST(list_price AS DOUBLE) - est_cost, 2) AS margin FROM costed)""") + f"""
SELECT product_id, sku, name AS product_name, category, brand, CAST(list_price AS DOUBLE) AS list_price,
       CASE WHEN list_price < {C.PRICE_CUTS[0]} THEN '{C.BAND_LABELS[0]}'
            WHEN list_price < {C.PRICE_CUTS[1]} THEN '{C.BAND_LABELS[1]}' ELSE '{C.BAND_LABELS[2]}' END AS price_band,
       rank, CAST(row_number() OVER (PARTITION BY category ORDER BY list_price DESC, product_id) AS INTEGER)
         AS price_rank_in_category,
       CASE WHEN rank <= {C.POPULARITY_CUTS[0]} THEN '{C.POPULARITY_LABELS[0]}'
            WHEN rank <= {C.POPULARITY_CUTS[1]} THEN '{C.POPULARITY_LABELS[1]}'
            ELSE '{C.POPULARITY_LABELS[2]}' END AS popularity,
       rank <= {C.STAR_RANK} AS is_star, round(weight, 10) AS weight, est_cost, margin,
       CASE WHEN list_price > 0 THEN round(margin / CAST(list_price AS DOUBLE), 4) ELSE 0.0::DOUBLE END AS margin_pct
FROM margined"""

SQL["generated_stores"] = f"""
SELECT CAST(i AS VARCHAR) AS store_id, 'Loja ' || CAST(i AS VARCHAR) AS name,
       [{_q(SY.CITIES)}][(i - 1) % {len(SY.CITIES)} + 1] AS city, '{SY.STATE}' AS state
FROM (SELECT CAST(s_suppkey + 1 AS INTEGER) AS i FROM supplier)"""

# tables that were written, replaced, appended to or refreshed hold what the plain query gives
SQL["fact_monthly_sales_by_category_spread"] = SQL["fact_monthly_sales_by_category"]
SQL["average_ticket_from_sets"] = SQL["average_ticket"]
SQL["reloaded_fact_by_store"] = SQL["fact_daily_sales_by_store"]
SQL["replaced_sales"] = SQL["silver_sales"]
SQL["appended_sales"] = SQL["silver_sales"]
SQL["refreshed_fact_by_store"] = SQL["fact_daily_sales_by_store"]
SQL["refreshed_key_report"] = SQL["gold_key_report"]
SQL["load_audit"] = SQL["load_report"]

SQL["orders_by_revenue_weight"] = _with(SALES_CTE, f"""
revenue AS (SELECT product_id, CAST(sum(net) AS DOUBLE) AS revenue FROM silver_sales GROUP BY product_id),
total AS (SELECT sum(revenue) AS t FROM revenue),
draws AS (SELECT o_orderkey AS order_id, {_u("CAST(o_orderkey AS VARCHAR)", "revenue")} AS u FROM orders)""") + """
SELECT order_id, product_id FROM draws JOIN (SELECT product_id, revenue / t AS weight FROM revenue, total) w ON u < weight * 3.0::DOUBLE"""

SQL["part_key_series"] = """
WITH span AS (SELECT min(p_partkey) AS lo, max(p_partkey) AS hi FROM part),
series AS (SELECT CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS n FROM span)
SELECT n, count(l_partkey) AS lines_sold FROM series LEFT JOIN lineitem ON l_partkey = n GROUP BY n"""
