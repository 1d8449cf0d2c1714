"""Independent SQL statement of the adapter and the one-pass warehouse.

DuckDB runs these CTEs over the pre-registered test tables; every oracle
query of ``__spark_entry__.oracle_sql`` is ``WITH <ctes> SELECT ...``.  The
SQL is written from the table rules, not generated from the Spark plans, so
that agreement is evidence of correctness.
"""

from __future__ import annotations

SOURCE_CTES = """
src_header AS (
  SELECT o_orderkey AS sales_order_id, o_orderdate AS order_date,
         o_orderdate + INTERVAL 12 DAY AS due_date, o_orderdate + INTERVAL 7 DAY AS ship_date,
         CAST(5 AS INTEGER) AS status,
         'SO' || CAST(o_orderkey AS VARCHAR) AS sales_order_number,
         'PO' || CAST(o_orderkey AS VARCHAR) AS purchase_order_number,
         'AW' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS account_number,
         o_custkey AS customer_id,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_custkey % 100 END AS salesperson_id,
         CAST(o_totalprice AS DECIMAL(19,4)) AS subtotal,
         CAST(CAST(o_totalprice AS DECIMAL(19,4)) * CAST('0.08' AS DECIMAL(4,3)) AS DECIMAL(19,4)) AS tax_amt,
         CAST(CAST(o_totalprice AS DECIMAL(19,4)) * CAST('0.025' AS DECIMAL(4,3)) AS DECIMAL(19,4)) AS freight,
         CAST(NULL AS INTEGER) AS currency_rate_id,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS ship_method_id,
         CAST(NULL AS VARCHAR) AS comment
  FROM orders),
src_header2 AS (
  SELECT *, CAST(subtotal + tax_amt + freight AS DECIMAL(19,4)) AS total_due FROM src_header),
src_detail AS (
  SELECT l.l_orderkey AS sales_order_id, l.detail_id AS sales_order_detail_id,
         l.l_partkey AS product_id,
         CAST(CAST(l.l_quantity AS INTEGER) AS SMALLINT) AS order_qty,
         CAST(CAST(p.p_retailprice AS DECIMAL(9,4)) AS DECIMAL(19,4)) AS unit_price,
         CAST(CAST(l.l_discount AS DECIMAL(9,4)) AS DECIMAL(19,4)) AS unit_price_discount,
         CAST(CAST(CAST(l.l_quantity AS INTEGER) AS DECIMAL(5,0)) * CAST(p.p_retailprice AS DECIMAL(9,4))
              * (CAST(1 AS DECIMAL(1,0)) - CAST(l.l_discount AS DECIMAL(9,4))) AS DECIMAL(38,6)) AS line_total
  FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                     l_quantity, l_extendedprice, l_discount, l_shipdate) AS detail_id
        FROM lineitem) l
  JOIN part p ON l.l_partkey = p.p_partkey),
src_customer AS (
  SELECT c.c_custkey AS customer_id,
         CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE CAST(c.c_nationkey AS BIGINT) END AS store_id,
         c.c_name AS account_number, CAST(n.n_regionkey AS BIGINT) AS territory_id
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
src_store AS (
  SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS store_name,
         CASE WHEN n_nationkey % 10 = 0 THEN NULL ELSE CAST(n_nationkey AS BIGINT) END AS store_salesperson_id
  FROM nation),
src_product AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         'PN-' || CAST(p_partkey AS VARCHAR) AS product_number,
         string_split(p_name, ' ')[1] AS color, CAST(p_size AS VARCHAR) AS size,
         'CM' AS size_unit_measure_code,
         CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'LB' END AS weight_unit_measure_code,
         CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size AS DECIMAL(8,2)) END AS weight,
         CAST(CAST(p_retailprice AS DECIMAL(19,4)) * CAST('0.95' AS DECIMAL(3,2)) AS DECIMAL(19,4)) AS standard_cost,
         CAST(p_retailprice AS DECIMAL(19,4)) AS list_price,
         CASE WHEN p_size >= 46 THEN NULL ELSE string_split(p_name, ' ')[-1] END AS product_model_name,
         CASE WHEN p_size > 5 THEN p_brand END AS product_subcategory_name,
         CASE WHEN p_size > 5 THEN p_type END AS product_category_name,
         TIMESTAMP '1994-01-01 00:00:00' AS sell_start_date,
         CAST(NULL AS TIMESTAMP) AS sell_end_date, CAST(NULL AS TIMESTAMP) AS discontinued_date
  FROM part),
src_salesperson AS (
  SELECT s_suppkey AS salesperson_id,
         trim(coalesce(string_split(s_name, '#')[1], '')
              || coalesce(' ' || CASE WHEN s_suppkey % 3 = 0 THEN 'Q' END, '')
              || coalesce(' ' || string_split(s_name, '#')[-1], '')) AS full_name,
         CASE WHEN s_suppkey % 2 = 1 THEN 'Sales Representative' END AS title,
         CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_acctbal AS DECIMAL(19,4)) END AS sales_quota,
         CAST(abs(CAST(s_acctbal AS DECIMAL(19,4))) * CAST('0.1' AS DECIMAL(2,1)) AS DECIMAL(19,4)) AS bonus,
         CAST(CAST('0.01' AS DECIMAL(10,4)) + CAST(s_suppkey % 5 AS DECIMAL(10,4)) * CAST('0.005' AS DECIMAL(4,3))
              AS DECIMAL(10,4)) AS commission_pct,
         CAST(abs(CAST(s_acctbal AS DECIMAL(19,4))) * CAST(3 AS DECIMAL(1,0)) AS DECIMAL(19,4)) AS sales_ytd,
         CAST(abs(CAST(s_acctbal AS DECIMAL(19,4))) * CAST(2 AS DECIMAL(1,0)) AS DECIMAL(19,4)) AS sales_last_year
  FROM supplier)"""

WAREHOUSE_CTES = """
so AS (
  SELECT h.*, c.store_id, c.account_number AS c_account, c.territory_id,
         CAST((year(h.order_date) - 1995) * 12 + month(h.order_date) AS INTEGER) AS period
  FROM src_header2 h JOIN src_customer c ON h.customer_id = c.customer_id
  WHERE c.store_id IS NOT NULL AND h.order_date >= TIMESTAMP '1995-01-01 00:00:00'),
so_st AS (
  SELECT so.*, st.store_name, st.store_salesperson_id
  FROM so JOIN src_store st ON so.store_id = st.store_id),
dc AS (
  SELECT customer_id, store_id, store_name, c_account AS account_number, territory_id,
         store_salesperson_id, min(period) AS first_period
  FROM so_st GROUP BY customer_id, store_id, store_name, c_account, territory_id, store_salesperson_id),
dim_store_customer AS (
  SELECT CAST(row_number() OVER (ORDER BY first_period, customer_id) AS BIGINT) AS customer_key,
         customer_id, store_id, store_name, account_number, territory_id, store_salesperson_id
  FROM dc),
dp AS (
  SELECT d.product_id, min(so.period) AS first_period
  FROM so JOIN src_detail d ON so.sales_order_id = d.sales_order_id GROUP BY d.product_id),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY dp.first_period, dp.product_id) AS BIGINT) AS product_key, p.*
  FROM dp JOIN src_product p ON dp.product_id = p.product_id),
dim_time AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_key, d AS full_date,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(month(d) AS INTEGER) AS month_num,
         monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_num,
         CAST(year(d) AS INTEGER) AS year_num, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
         dayname(d) AS day_name, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT DISTINCT CAST(order_date AS DATE) AS d FROM so) t),
dsp AS (
  SELECT coalesce(salesperson_id, store_salesperson_id) AS salesperson_id, min(period) AS first_period
  FROM so_st WHERE coalesce(salesperson_id, store_salesperson_id) IS NOT NULL
  GROUP BY coalesce(salesperson_id, store_salesperson_id)),
dim_salesperson AS (
  SELECT CAST(1 AS BIGINT) AS salesperson_key, CAST(-1 AS BIGINT) AS salesperson_id, 'Unknown' AS full_name,
         CAST(NULL AS VARCHAR) AS title, CAST(NULL AS DECIMAL(19,4)) AS sales_quota,
         CAST(NULL AS DECIMAL(19,4)) AS bonus, CAST(NULL AS DECIMAL(10,4)) AS commission_pct,
         CAST(NULL AS DECIMAL(19,4)) AS sales_ytd, CAST(NULL AS DECIMAL(19,4)) AS sales_last_year
  UNION ALL
  SELECT CAST(1 + row_number() OVER (ORDER BY dsp.first_period, dsp.salesperson_id) AS BIGINT),
         dsp.salesperson_id, coalesce(s.full_name, ''), s.title, s.sales_quota, s.bonus,
         s.commission_pct, s.sales_ytd, s.sales_last_year
  FROM dsp LEFT JOIN src_salesperson s ON dsp.salesperson_id = s.salesperson_id),
raw_store_sales AS (
  SELECT CAST(row_number() OVER (ORDER BY so_st.period, so_st.sales_order_id, d.sales_order_detail_id) AS BIGINT)
           AS raw_store_sales_id,
         so_st.sales_order_id, d.sales_order_detail_id, so_st.order_date, so_st.due_date, so_st.ship_date,
         so_st.status, so_st.sales_order_number, so_st.purchase_order_number, so_st.account_number,
         so_st.customer_id, so_st.store_id, so_st.store_name,
         coalesce(so_st.salesperson_id, so_st.store_salesperson_id) AS salesperson_id,
         so_st.territory_id, d.product_id, d.order_qty, d.unit_price, d.unit_price_discount, d.line_total,
         so_st.subtotal, so_st.tax_amt, so_st.freight, so_st.total_due, so_st.currency_rate_id,
         so_st.ship_method_id, so_st.comment, so_st.period
  FROM so_st JOIN src_detail d ON so_st.sales_order_id = d.sales_order_id),
fact_stage AS (
  SELECT r.*, c.customer_key, p.product_key, p.standard_cost, t.time_key, s.salesperson_key
  FROM raw_store_sales r
  LEFT JOIN dim_store_customer c ON r.customer_id = c.customer_id
  LEFT JOIN dim_product p ON r.product_id = p.product_id
  LEFT JOIN dim_time t ON CAST(r.order_date AS DATE) = t.full_date
  LEFT JOIN dim_salesperson s ON coalesce(r.salesperson_id, -1) = s.salesperson_id),
fact_store_sales AS (
  SELECT raw_store_sales_id AS fact_store_sales_key, sales_order_id, sales_order_detail_id,
         sales_order_number, customer_key, product_key, time_key AS order_date_key, salesperson_key,
         order_qty, unit_price, unit_price_discount,
         CAST(CAST(order_qty AS DECIMAL(5,0)) * CAST(unit_price AS DECIMAL(15,4)) AS DECIMAL(19,4)) AS gross_amount,
         CAST(CAST(order_qty AS DECIMAL(5,0)) * CAST(unit_price AS DECIMAL(15,4))
              * CAST(unit_price_discount AS DECIMAL(9,4)) AS DECIMAL(19,4)) AS discount_amount,
         CAST(round(CAST(line_total AS DECIMAL(30,6))
                    - CAST(CAST(order_qty AS DECIMAL(5,0)) * CAST(standard_cost AS DECIMAL(15,4)) AS DECIMAL(19,4)),
                    4) AS DECIMAL(38,6)) AS margin_amount,
         CAST(line_total AS DECIMAL(38,6)) AS net_amount,
         subtotal AS header_subtotal, tax_amt AS header_tax_amt, freight AS header_freight,
         total_due AS header_total_due
  FROM fact_stage)"""

PANEL_CTES = """
star AS (
  SELECT f.*, p.product_id, p.product_name, p.product_category_name, p.product_subcategory_name,
         p.product_model_name, p.color, p.size, p.weight, p.standard_cost, p.list_price,
         c.customer_id, c.store_id, c.store_name, c.territory_id,
         s.salesperson_id, s.sales_quota, s.bonus, s.commission_pct, s.sales_ytd, s.sales_last_year,
         t.year_num, t.month_num, t.quarter_num
  FROM fact_store_sales f
  JOIN dim_product p ON f.product_key = p.product_key
  JOIN dim_store_customer c ON f.customer_key = c.customer_key
  JOIN dim_time t ON f.order_date_key = t.time_key
  JOIN dim_salesperson s ON f.salesperson_key = s.salesperson_key),
monthly AS (
  SELECT product_key, product_id, product_name, product_category_name, product_subcategory_name,
         product_model_name, color, size, weight, standard_cost, list_price,
         customer_key, customer_id, store_id, store_name, territory_id,
         salesperson_key, salesperson_id, sales_quota, bonus, commission_pct, sales_ytd, sales_last_year,
         year_num, month_num, quarter_num,
         CAST(sum(order_qty) AS BIGINT) AS current_month_order_qty,
         sum(gross_amount) AS g_sum, sum(discount_amount) AS d_sum, sum(net_amount) AS n_sum,
         sum(margin_amount) AS m_sum,
         CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_unit_price,
         CAST(sum(unit_price_discount) AS DOUBLE) / count(unit_price_discount) AS avg_unit_price_discount,
         CAST(count(DISTINCT sales_order_id) AS BIGINT) AS number_of_orders,
         CAST(count(*) AS BIGINT) AS number_of_order_lines
  FROM star
  GROUP BY product_key, product_id, product_name, product_category_name, product_subcategory_name,
         product_model_name, color, size, weight, standard_cost, list_price,
         customer_key, customer_id, store_id, store_name, territory_id,
         salesperson_key, salesperson_id, sales_quota, bonus, commission_pct, sales_ytd, sales_last_year,
         year_num, month_num, quarter_num),
with_next AS (
  SELECT * FROM (
    SELECT *, lead(n_sum) OVER (PARTITION BY product_key, store_id
                                ORDER BY year_num, month_num, customer_key, salesperson_key) AS next_sum
    FROM monthly) x
  WHERE next_sum IS NOT NULL),
feat AS (
  SELECT *,
    CAST(lag(n_sum) OVER w AS DOUBLE) AS prev_d,
    CAST(lag(m_sum) OVER w AS DOUBLE) AS prev_m,
    CASE WHEN count(n_sum) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) > 0
         THEN CAST(sum(n_sum) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS DOUBLE)
              / count(n_sum) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS roll_d
  FROM with_next
  WINDOW w AS (PARTITION BY product_key, store_id ORDER BY year_num, month_num, customer_key, salesperson_key)),
engineered AS (
  SELECT product_key, product_id, product_name, product_category_name, product_subcategory_name,
         product_model_name, color, size, weight, standard_cost, list_price,
         customer_key, customer_id, store_id, store_name, territory_id,
         salesperson_key, salesperson_id, sales_quota, bonus, commission_pct, sales_ytd, sales_last_year,
         year_num, month_num, quarter_num, current_month_order_qty,
         CAST(g_sum AS DOUBLE) AS current_month_gross_sales,
         CAST(d_sum AS DOUBLE) AS current_month_discount_amount,
         CAST(n_sum AS DOUBLE) AS current_month_net_sales,
         CAST(m_sum AS DOUBLE) AS current_month_margin_amount,
         avg_unit_price, avg_unit_price_discount, number_of_orders, number_of_order_lines,
         CAST(next_sum AS DOUBLE) AS next_period_net_sales,
         make_date(year_num, month_num, 1) AS year_month_date,
         coalesce(prev_d, 0.0) AS previous_month_sales,
         coalesce(roll_d, CAST(n_sum AS DOUBLE)) AS rolling_avg_sales_3m,
         coalesce(prev_m, 0.0) AS previous_month_margin,
         CASE WHEN CAST(g_sum AS DOUBLE) = 0 THEN 0.0 ELSE CAST(d_sum AS DOUBLE) / CAST(g_sum AS DOUBLE) END
           AS discount_percentage,
         CASE WHEN CAST(n_sum AS DOUBLE) = 0 THEN 0.0 ELSE CAST(m_sum AS DOUBLE) / CAST(n_sum AS DOUBLE) END
           AS product_profitability_ratio,
         CASE WHEN quarter_num = 4 THEN 1 ELSE 0 END AS is_q4,
         CASE WHEN month_num IN (11, 12) THEN 1 ELSE 0 END AS is_year_end_season,
         CASE WHEN month_num IN (6, 7) THEN 1 ELSE 0 END AS is_mid_year,
         sin(2 * pi() * CAST(month_num AS DOUBLE) / 12) AS month_sin,
         cos(2 * pi() * CAST(month_num AS DOUBLE) / 12) AS month_cos,
         CASE WHEN prev_d = 0 THEN 0.0 ELSE (CAST(n_sum AS DOUBLE) - prev_d) / prev_d END
           AS sales_growth_previous_period
  FROM feat)"""


def with_ctes(select_sql: str, panel: bool = False) -> str:
    parts = [SOURCE_CTES.strip(), WAREHOUSE_CTES.strip()]
    if panel:
        parts.append(PANEL_CTES.strip())
    return "WITH " + ",\n".join(parts) + "\n" + select_sql.strip()
