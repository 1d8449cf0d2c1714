"""Oracle SQL (DuckDB) for every registered query that SQL can express."""

from __future__ import annotations

from ..operators import importance as IM
from .oracle_base import with_ctes

# The panel's group columns.
_PANEL_GROUP = """product_key, product_id, product_name, product_category_name, product_subcategory_name,
  product_model_name, color, size, weight, standard_cost, list_price, customer_key, customer_id, store_id,
  store_name, territory_id, salesperson_key, salesperson_id, sales_quota, bonus, commission_pct, sales_ytd,
  sales_last_year, year_num, month_num, quarter_num"""

SQL = {
    "engineered_features": with_ctes("SELECT * FROM engineered", panel=True),
    "monthly_panel": with_ctes(f"""
SELECT {_PANEL_GROUP}, current_month_order_qty,
  CAST(g_sum AS DOUBLE) AS current_month_gross_sales, CAST(d_sum AS DOUBLE) AS current_month_discount_amount,
  CAST(n_sum AS DOUBLE) AS current_month_net_sales, CAST(m_sum AS DOUBLE) AS current_month_margin_amount,
  avg_unit_price, avg_unit_price_discount, number_of_orders, number_of_order_lines
FROM monthly""", panel=True),
    "next_period_target": with_ctes("""
SELECT product_key, store_id, customer_key, salesperson_key, year_num, month_num,
  CAST(n_sum AS DOUBLE) AS current_month_net_sales, CAST(next_sum AS DOUBLE) AS next_period_net_sales
FROM with_next""", panel=True),
    "table_counts": with_ctes("""
SELECT 'dim_store_customer' AS table_name, count(*) AS row_count FROM dim_store_customer
UNION ALL SELECT 'dim_product', count(*) FROM dim_product
UNION ALL SELECT 'dim_time', count(*) FROM dim_time
UNION ALL SELECT 'dim_salesperson', count(*) FROM dim_salesperson
UNION ALL SELECT 'raw_store_sales', count(*) FROM raw_store_sales
UNION ALL SELECT 'fact_store_sales', count(*) FROM fact_store_sales"""),
}

# The mart's columns and their Spark types.
_MART_TYPES = {
    "fact_store_sales_key": "bigint", "sales_order_id": "bigint", "sales_order_detail_id": "bigint",
    "sales_order_number": "string", "customer_id": "bigint", "store_id": "bigint", "store_name": "string",
    "territory_id": "bigint", "product_id": "bigint", "product_name": "string",
    "product_subcategory_name": "string", "product_category_name": "string", "order_date": "date",
    "year_num": "int", "month_num": "int", "month_name": "string", "year_month": "string",
    "salesperson_id": "bigint", "salesperson_name": "string", "order_qty": "smallint",
    "unit_price": "decimal(19,4)", "unit_price_discount": "decimal(19,4)", "gross_amount": "decimal(19,4)",
    "discount_amount": "decimal(19,4)", "margin_amount": "decimal(38,6)", "net_amount": "decimal(38,6)",
    "header_subtotal": "decimal(19,4)", "header_tax_amt": "decimal(19,4)", "header_freight": "decimal(19,4)",
    "header_total_due": "decimal(19,4)",
}

MART_CTES = """,
mart AS (
  SELECT f.fact_store_sales_key, f.sales_order_id, f.sales_order_detail_id, f.sales_order_number,
         c.customer_id, c.store_id, c.store_name, c.territory_id, p.product_id, p.product_name,
         p.product_subcategory_name, p.product_category_name, t.full_date AS order_date, t.year_num,
         t.month_num, t.month_name,
         CAST(t.year_num AS VARCHAR) || '-' || lpad(CAST(t.month_num AS VARCHAR), 2, '0') AS year_month,
         s.salesperson_id, s.full_name AS salesperson_name, f.order_qty, f.unit_price, f.unit_price_discount,
         f.gross_amount, f.discount_amount, f.margin_amount, f.net_amount, f.header_subtotal,
         f.header_tax_amt, f.header_freight, f.header_total_due
  FROM fact_store_sales f
  LEFT JOIN dim_store_customer c ON f.customer_key = c.customer_key
  LEFT JOIN dim_product p ON f.product_key = p.product_key
  LEFT JOIN dim_time t ON f.order_date_key = t.time_key
  LEFT JOIN dim_salesperson s ON f.salesperson_key = s.salesperson_key),
clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sales_order_id, sales_order_detail_id
                                 ORDER BY order_date, sales_order_id, sales_order_detail_id,
                                          fact_store_sales_key) AS rn
    FROM mart) x
  WHERE rn = 1 AND order_qty > 0 AND unit_price >= 0
    AND coalesce(unit_price_discount BETWEEN 0 AND 1, false) AND net_amount >= 0)"""


def _mart(select_sql: str) -> str:
    base = with_ctes("SELECT 1")
    return base[: base.rindex("SELECT 1")].rstrip() + MART_CTES + "\n" + select_sql.strip()


# The fingerprinted columns in order.
_FP_COLS = ["fact_store_sales_key", "sales_order_id", "sales_order_detail_id", "sales_order_number",
            "customer_key", "product_key", "order_date_key", "salesperson_key", "order_qty", "unit_price",
            "unit_price_discount", "gross_amount", "discount_amount", "margin_amount", "net_amount",
            "header_subtotal", "header_tax_amt", "header_freight", "header_total_due"]


def _fp(cols=_FP_COLS, net="net_amount") -> str:
    parts = [f"coalesce(CAST({net if c == 'net_amount' else c} AS VARCHAR), '<NULL>')" for c in cols]
    return "sha256(concat_ws('||', " + ", ".join(parts) + "))"


_TAMPER = f"""
SELECT fact_store_sales_key, sales_order_id, sales_order_detail_id,
       CASE WHEN order_qty = 50 THEN NULL ELSE {_fp()} END AS stored,
       {_fp(net="CAST(CASE WHEN unit_price_discount = 0.1 THEN CAST(net_amount + 10 AS DECIMAL(38,6)) ELSE net_amount END AS DECIMAL(38,6))")} AS expected
FROM fact_store_sales"""

_VERIFIED = f"""
SELECT *, CASE WHEN stored IS NULL OR stored = '' THEN 'MISSING_FINGERPRINT'
               WHEN stored <> expected THEN 'FINGERPRINT_MISMATCH' ELSE 'OK' END AS status
FROM ({_TAMPER}) t"""

_PERF = """CAST(sum(net_amount) AS DOUBLE) AS net_sales, CAST(sum(margin_amount) AS DOUBLE) AS margin_value,
  CAST(sum(discount_amount) AS DOUBLE) AS discount_value, count(sales_order_detail_id) AS order_lines,
  CAST(sum(margin_amount) AS DOUBLE) / CAST(sum(net_amount) AS DOUBLE) * 100 AS margin_pct"""

SQL.update({
    "star_mart_denormalised": _mart("SELECT * FROM mart"),
    "dim_time_build": with_ctes("SELECT * FROM dim_time"),
    "dim_product_flatten": with_ctes("SELECT * FROM src_product"),
    "dim_salesperson_names": with_ctes("SELECT * FROM dim_salesperson"),
    "surrogate_keys": with_ctes("""
SELECT 'dim_store_customer' AS dimension, customer_id AS natural_id, customer_key AS surrogate_key FROM dim_store_customer
UNION ALL SELECT 'dim_product', product_id, product_key FROM dim_product
UNION ALL SELECT 'dim_salesperson', salesperson_id, salesperson_key FROM dim_salesperson"""),
    "new_customers_antijoin": with_ctes("""
SELECT DISTINCT customer_id, store_id, store_name, c_account AS account_number, territory_id, store_salesperson_id
FROM so_st
WHERE order_date >= TIMESTAMP '1995-03-01' AND order_date < TIMESTAMP '1995-04-01'
  AND customer_id NOT IN (SELECT customer_id FROM so_st WHERE order_date < TIMESTAMP '1995-03-01')"""),
    "raw_extract_period": with_ctes("""
SELECT * EXCLUDE (raw_store_sales_id, period) FROM raw_store_sales
WHERE order_date >= TIMESTAMP '1995-03-01' AND order_date < TIMESTAMP '1995-04-01'"""),
    "fact_transform": with_ctes("SELECT * FROM fact_store_sales"),
    "fact_keys_missing": with_ctes("""
SELECT count(*) FILTER (WHERE customer_key IS NULL) AS missing_customer_keys,
       count(*) FILTER (WHERE product_key IS NULL) AS missing_product_keys,
       count(*) FILTER (WHERE time_key IS NULL) AS missing_time_keys,
       count(*) FILTER (WHERE salesperson_key IS NULL) AS missing_salesperson_keys,
       count(*) AS staged_rows
FROM fact_stage"""),
    "unique_key_violations": with_ctes("""
SELECT table_name, key_columns, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS violating_keys,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS violating_rows
FROM (
  SELECT 'dim_store_customer' AS table_name, 'customer_id' AS key_columns, count(*) AS n FROM dim_store_customer GROUP BY customer_id
  UNION ALL SELECT 'dim_product', 'product_id', count(*) FROM dim_product GROUP BY product_id
  UNION ALL SELECT 'dim_time', 'full_date', count(*) FROM dim_time GROUP BY full_date
  UNION ALL SELECT 'dim_salesperson', 'salesperson_id', count(*) FROM dim_salesperson GROUP BY salesperson_id
  UNION ALL SELECT 'raw_store_sales', 'sales_order_id,sales_order_detail_id', count(*) FROM raw_store_sales GROUP BY sales_order_id, sales_order_detail_id
  UNION ALL SELECT 'fact_store_sales', 'sales_order_id,sales_order_detail_id', count(*) FROM fact_store_sales GROUP BY sales_order_id, sales_order_detail_id
) g GROUP BY table_name, key_columns"""),
    "fk_orphans": with_ctes("""
SELECT 'customer_key' AS foreign_key, count(*) AS orphan_rows FROM fact_store_sales f
  WHERE NOT EXISTS (SELECT 1 FROM dim_store_customer d WHERE d.customer_key = f.customer_key)
UNION ALL SELECT 'product_key', count(*) FROM fact_store_sales f
  WHERE NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.product_key = f.product_key)
UNION ALL SELECT 'order_date_key', count(*) FROM fact_store_sales f
  WHERE NOT EXISTS (SELECT 1 FROM dim_time d WHERE d.time_key = f.order_date_key)
UNION ALL SELECT 'salesperson_key', count(*) FROM fact_store_sales f
  WHERE NOT EXISTS (SELECT 1 FROM dim_salesperson d WHERE d.salesperson_key = f.salesperson_key)"""),
    "quality_summary": _mart("""
SELECT 'Duplicate fact rows by (sales_order_id, sales_order_detail_id)' AS "Check",
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS IssueCount
  FROM (SELECT count(*) AS n FROM mart GROUP BY sales_order_id, sales_order_detail_id) d
UNION ALL SELECT 'Missing store dimension attributes', count(*) FILTER (WHERE store_name IS NULL) FROM mart
UNION ALL SELECT 'Missing product dimension attributes', count(*) FILTER (WHERE product_name IS NULL) FROM mart
UNION ALL SELECT 'Missing time dimension attributes', count(*) FILTER (WHERE order_date IS NULL) FROM mart
UNION ALL SELECT 'Missing salesperson dimension attributes', count(*) FILTER (WHERE salesperson_name IS NULL) FROM mart
UNION ALL SELECT 'Invalid discount rate (< 0 or > 1)',
       count(*) FILTER (WHERE NOT coalesce(unit_price_discount BETWEEN 0 AND 1, false)) FROM mart
UNION ALL SELECT 'Non-positive order quantity', count(*) FILTER (WHERE order_qty <= 0) FROM mart
UNION ALL SELECT 'Negative unit price', count(*) FILTER (WHERE unit_price < 0) FROM mart"""),
    "cleansed_rows": _mart("SELECT * FROM clean"),
    # the columns' Spark types are part of the report: fixed values
    "column_profile": _mart(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null,
  CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST(count(*) - count({c}) AS DOUBLE) * 100 / count(*) END AS null_pct,
  count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value
FROM clean""" for c, t in _MART_TYPES.items())),
    "store_performance_top10": _mart(f"""
SELECT store_name, {_PERF}, CAST(sum(gross_amount) AS DOUBLE) AS gross_sales
FROM clean WHERE store_name IS NOT NULL GROUP BY store_name HAVING sum(net_amount) > 0
ORDER BY sum(net_amount) DESC, store_name LIMIT 10"""),
    "discount_profitability_top20": _mart("""
SELECT *, net_sales / max(net_sales) OVER () * 800 AS bubble_size FROM (
  SELECT store_name, CAST(sum(gross_amount) AS DOUBLE) AS gross_sales,
         CAST(sum(discount_amount) AS DOUBLE) AS discount_value, CAST(sum(net_amount) AS DOUBLE) AS net_sales,
         CAST(sum(margin_amount) AS DOUBLE) AS margin_value, count(sales_order_detail_id) AS order_lines,
         CAST(sum(discount_amount) AS DOUBLE) / CAST(sum(gross_amount) AS DOUBLE) * 100 AS discount_ratio_pct,
         CAST(sum(margin_amount) AS DOUBLE) / CAST(sum(net_amount) AS DOUBLE) * 100 AS margin_pct
  FROM clean WHERE store_name IS NOT NULL GROUP BY store_name
  HAVING sum(gross_amount) > 0 AND sum(net_amount) > 0
  ORDER BY sum(net_amount) DESC, store_name LIMIT 20) t"""),
    "category_performance": _mart(f"""
SELECT product_category_name, {_PERF}
FROM clean WHERE product_category_name IS NOT NULL GROUP BY product_category_name HAVING sum(net_amount) > 0
ORDER BY sum(net_amount) DESC, product_category_name LIMIT 10"""),
    "salesperson_margin_top10": _mart(f"""
SELECT salesperson_name, {_PERF}
FROM clean WHERE salesperson_name IS NOT NULL GROUP BY salesperson_name HAVING sum(net_amount) > 0
ORDER BY sum(margin_amount) DESC, salesperson_name LIMIT 10"""),
    "sales_by_month_store_person_top20": with_ctes("""
SELECT t.year_num, t.month_name, c.store_name, s.full_name AS salesperson,
       CAST(sum(f.net_amount) AS DOUBLE) AS total_sales
FROM fact_store_sales f
JOIN dim_store_customer c ON f.customer_key = c.customer_key
JOIN dim_product p ON f.product_key = p.product_key
JOIN dim_time t ON f.order_date_key = t.time_key
JOIN dim_salesperson s ON f.salesperson_key = s.salesperson_key
GROUP BY t.year_num, t.month_name, c.store_name, s.full_name
ORDER BY sum(f.net_amount) DESC, t.year_num, t.month_name, c.store_name, s.full_name LIMIT 20"""),
    "fingerprints": with_ctes(f"SELECT fact_store_sales_key, {_fp()} AS fingerprint FROM fact_store_sales"),
    "fingerprint_verify": with_ctes(f"""
SELECT fact_store_sales_key, sales_order_id, sales_order_detail_id, status,
  CASE WHEN status = 'FINGERPRINT_MISMATCH'
       THEN status || ' | fact_store_sales_key=' || fact_store_sales_key || ' | sales_order_id=' || sales_order_id
            || ' | sales_order_detail_id=' || sales_order_detail_id || ' | stored=' || stored || ' | expected=' || expected
       ELSE status || ' | fact_store_sales_key=' || fact_store_sales_key || ' | sales_order_id=' || sales_order_id
            || ' | sales_order_detail_id=' || sales_order_detail_id END AS report_line
FROM ({_VERIFIED}) v WHERE status <> 'OK'"""),
    "fingerprint_summary": with_ctes(f"""
SELECT count(*) AS rows_checked, count(*) FILTER (WHERE status <> 'OK') AS invalid_rows FROM ({_VERIFIED}) v"""),
})

# ---------------------------------------------------------------- monitoring over events

_LOG = """
log AS (
  SELECT ts AS timestamp, event_id AS seq,
    CASE event_type WHEN 'click' THEN 'gradient_boosting' WHEN 'view' THEN 'random_forest' ELSE 'legacy_unknown' END AS model_key,
    CASE event_type WHEN 'click' THEN 'Gradient Boosting' WHEN 'view' THEN 'Random Forest' ELSE 'Legacy / Unknown' END
      AS model_display_name,
    value AS predicted_next_period_net_sales, user_id, value,
    TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type, dayname(ts) AS day_name
  FROM events),
sides AS (
  SELECT *, model_key AS model,
         CASE WHEN timestamp < TIMESTAMP '2024-01-16 00:00:00' THEN 'ref' ELSE 'prod' END AS side
  FROM log)"""


def _log(select_sql: str) -> str:
    return "WITH " + _LOG.strip() + "\n" + select_sql.strip()


_EXACT_MEAN = "CAST(sum(CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / count({c})"

SQL.update({
    "model_summary": _log(f"""
SELECT m.model_key, m.model, CAST(coalesce(a.requests, 0) AS BIGINT) AS requests, a.avg_predicted_sales,
       a.latest_prediction, 'test_rmse' AS tracked_metric, CAST(NULL AS DOUBLE) AS tracked_metric_value
FROM (VALUES ('gradient_boosting', 'Gradient Boosting'), ('random_forest', 'Random Forest')) m(model_key, model)
LEFT JOIN (
  SELECT model_key, count(*) AS requests,
         {_EXACT_MEAN.format(c='predicted_next_period_net_sales')} AS avg_predicted_sales,
         first(predicted_next_period_net_sales ORDER BY timestamp DESC, seq DESC) AS latest_prediction
  FROM log GROUP BY model_key) a ON m.model_key = a.model_key"""),
    "log_kpis": _log(f"""
SELECT count(*) AS total_requests, {_EXACT_MEAN.format(c='predicted_next_period_net_sales')} AS avg_prediction,
       first(predicted_next_period_net_sales ORDER BY timestamp DESC, seq DESC) AS latest_prediction
FROM log"""),
    "requests_per_model": _log('SELECT model_display_name AS "Model", count(*) AS "Requests" FROM log GROUP BY 1'),
    "ab_success_count": _log("""
SELECT count(*) FILTER (WHERE model_key IN ('gradient_boosting', 'random_forest')) AS ab_prediction_count FROM log"""),
    "prediction_trend_pivot": _log("""
SELECT timestamp,
  avg(predicted_next_period_net_sales) FILTER (WHERE model_display_name = 'Gradient Boosting') AS "Gradient Boosting",
  avg(predicted_next_period_net_sales) FILTER (WHERE model_display_name = 'Random Forest') AS "Random Forest",
  avg(predicted_next_period_net_sales) FILTER (WHERE model_display_name = 'Legacy / Unknown') AS "Legacy / Unknown"
FROM log WHERE timestamp IS NOT NULL AND predicted_next_period_net_sales IS NOT NULL GROUP BY timestamp"""),
    "latest_predictions": _log("""
SELECT seq, timestamp, model_display_name, predicted_next_period_net_sales FROM log ORDER BY seq DESC LIMIT 20"""),
    "ab_assignment": """
SELECT event_id, explicit_model_key,
  coalesce(explicit_model_key,
           CASE (row_number() OVER (PARTITION BY explicit_model_key IS NULL ORDER BY event_id) - 1) % 2
                WHEN 0 THEN 'gradient_boosting' ELSE 'random_forest' END) AS model_key
FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'gradient_boosting' WHEN 'view' THEN 'random_forest' END
             AS explicit_model_key FROM events) r""",
    "numeric_drift_d": _log("""
, long AS (
  SELECT * FROM (
    SELECT model, 'value' AS feature, side, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM sides
    UNION ALL SELECT model, 'user_id', side, TRY_CAST(CAST(user_id AS VARCHAR) AS DOUBLE) FROM sides
    UNION ALL SELECT model, 'k', side, TRY_CAST(CAST(k AS VARCHAR) AS DOUBLE) FROM sides) u
  WHERE value IS NOT NULL AND NOT isnan(value)),
cnt AS (
  SELECT model, feature, value, count(*) FILTER (WHERE side = 'ref') AS c_ref,
         count(*) FILTER (WHERE side = 'prod') AS c_prod
  FROM long GROUP BY model, feature, value),
tot AS (
  SELECT model, feature, count(*) FILTER (WHERE side = 'ref') AS n_ref, count(*) FILTER (WHERE side = 'prod') AS n_prod,
         sum(CAST(value AS DECIMAL(38,10))) FILTER (WHERE side = 'ref') AS s_ref,
         sum(CAST(value AS DECIMAL(38,10))) FILTER (WHERE side = 'prod') AS s_prod
  FROM long GROUP BY model, feature),
cum AS (
  SELECT model, feature, value,
         sum(c_ref) OVER (PARTITION BY model, feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
         sum(c_prod) OVER (PARTITION BY model, feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cp
  FROM cnt),
d AS (
  SELECT cum.model, cum.feature,
         max(CASE WHEN n_ref > 0 AND n_prod > 0
                  THEN abs(CAST(cr AS DOUBLE) / n_ref - CAST(cp AS DOUBLE) / n_prod) END) AS ks_d
  FROM cum JOIN tot ON cum.model = tot.model AND cum.feature = tot.feature GROUP BY cum.model, cum.feature)
SELECT t.model, t.feature, CAST(n_ref AS BIGINT) AS reference_count, CAST(n_prod AS BIGINT) AS production_count,
       round(CASE WHEN n_ref > 0 THEN CAST(s_ref AS DOUBLE) / n_ref END, 4) AS reference_mean,
       round(CASE WHEN n_prod > 0 THEN CAST(s_prod AS DOUBLE) / n_prod END, 4) AS production_mean, d.ks_d
FROM tot t LEFT JOIN d ON t.model = d.model AND t.feature = d.feature"""),
    "categorical_drift": _log("""
, cl AS (
  SELECT model, 'event_type' AS feature, side, coalesce(CAST(event_type AS VARCHAR), 'MISSING') AS category FROM sides
  UNION ALL SELECT model, 'day_name', side, coalesce(CAST(day_name AS VARCHAR), 'MISSING') FROM sides),
cc AS (
  SELECT model, feature, category, count(*) FILTER (WHERE side = 'ref') AS c_ref,
         count(*) FILTER (WHERE side = 'prod') AS c_prod
  FROM cl GROUP BY model, feature, category),
ct AS (SELECT model, feature, sum(c_ref) AS n_ref, sum(c_prod) AS n_prod FROM cc GROUP BY model, feature),
sh AS (
  SELECT cc.model, cc.feature, cc.category, n_ref, n_prod,
         CASE WHEN n_ref > 0 AND n_prod > 0 THEN abs(CAST(c_prod AS DOUBLE) / n_prod - CAST(c_ref AS DOUBLE) / n_ref) END
           AS shift
  FROM cc JOIN ct ON cc.model = ct.model AND cc.feature = ct.feature),
best AS (
  SELECT model, feature, n_ref, n_prod, max(shift) AS max_shift,
         first(category ORDER BY shift DESC, category) AS cat
  FROM sh GROUP BY model, feature, n_ref, n_prod)
SELECT model, feature, 'categorical' AS type,
  CASE WHEN n_ref > 0 AND n_prod > 0
       THEN 'Max frequency shift: ' || coalesce(CASE WHEN max_shift > 0 THEN cat END, 'None')
       ELSE 'Frequency shift' END AS test,
  CAST(n_ref AS BIGINT) AS reference_count, CAST(n_prod AS BIGINT) AS production_count,
  CAST(NULL AS DOUBLE) AS reference_mean, CAST(NULL AS DOUBLE) AS production_mean, CAST(NULL AS DOUBLE) AS p_value,
  CASE WHEN n_ref > 0 AND n_prod > 0 THEN round(max_shift, 4) END AS frequency_shift,
  CASE WHEN NOT (n_ref > 0 AND n_prod > 0) THEN 'Not enough data'
       WHEN max_shift >= 0.25 THEN 'Possible Drift' ELSE 'No Drift' END AS drift_status
FROM best"""),
})

_KS_TERM = "(CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END) * exp(-2.0::DOUBLE * k * k * lam * lam)"
SQL["numeric_drift_p"] = f"""
WITH s AS ({SQL['numeric_drift_d']}),
e AS (SELECT *, reference_count >= 2 AND production_count >= 2 AS enough,
             sqrt(CAST(reference_count AS DOUBLE) * production_count / (reference_count + production_count)) AS en FROM s),
l AS (SELECT *, (en + 0.12::DOUBLE + 0.11::DOUBLE / en) * ks_d AS lam FROM e),
p AS (SELECT *, CASE WHEN enough THEN CASE WHEN lam < 1e-8 THEN 1.0::DOUBLE ELSE least(greatest(
               list_sum(list_transform(range(1, 101), lambda k: {_KS_TERM})), 0.0::DOUBLE), 1.0::DOUBLE) END END AS pv FROM l)
SELECT model, feature, 'numeric' AS type, 'KS test' AS test, reference_count, production_count,
       CASE WHEN enough THEN reference_mean END AS reference_mean, CASE WHEN enough THEN production_mean END AS production_mean,
       round(pv, 6) AS p_value, CAST(NULL AS DOUBLE) AS frequency_shift,
       CASE WHEN pv IS NULL THEN 'Not enough data' WHEN pv < 0.05 THEN 'Possible Drift' ELSE 'No Drift' END AS drift_status
FROM p"""
SQL["combined_drift"] = f"SELECT * FROM ({SQL['numeric_drift_p']}) n UNION ALL BY NAME SELECT * FROM ({SQL['categorical_drift']}) c"
SQL["drift_feature_counts"] = f"""
SELECT model, count(*) FILTER (WHERE drift_status = 'Possible Drift') AS possible_drift_features
FROM ({SQL['combined_drift']}) d GROUP BY model"""
SQL["fact_key_gate"] = with_ctes(" UNION ALL ".join(f"""
SELECT '{k}' AS key, count(*) FILTER (WHERE {k} IS NULL) AS missing_rows, count(*) AS staged_rows,
       count(*) FILTER (WHERE {k} IS NULL) = 0 AS passes
FROM fact_stage""" for k in ["customer_key", "product_key", "time_key", "salesperson_key"]))

# ---------------------------------------------------------------- training table, importance, explorer

_NUMERIC = ["product_key", "weight", "standard_cost", "list_price", "customer_key", "store_id", "territory_id",
            "salesperson_key", "sales_quota", "bonus", "commission_pct", "sales_ytd", "sales_last_year",
            "year_num", "month_num", "quarter_num", "current_month_order_qty", "current_month_gross_sales",
            "current_month_discount_amount", "current_month_net_sales", "current_month_margin_amount",
            "avg_unit_price", "avg_unit_price_discount", "number_of_orders", "number_of_order_lines",
            "previous_month_sales", "rolling_avg_sales_3m", "previous_month_margin", "discount_percentage",
            "product_profitability_ratio", "is_q4", "is_year_end_season", "is_mid_year", "month_sin", "month_cos",
            "sales_growth_previous_period"]
_CATEGORICAL = ["product_category_name", "product_subcategory_name", "product_model_name", "color", "size"]
_SPLIT_KEY = "concat_ws('|', product_key, store_id, customer_key, salesperson_key, year_num, month_num)"
_BUCKET = f"CAST(CAST(('0x' || substr(md5({_SPLIT_KEY}), 1, 8)) AS BIGINT) % 10 AS INTEGER)"

_SPLIT_CTES = f""",
splitted AS (
  SELECT *, CASE WHEN {_BUCKET} < 7 THEN 'train' WHEN {_BUCKET} < 8 THEN 'validation' ELSE 'test' END AS split
  FROM engineered),
train AS (SELECT * FROM splitted WHERE split = 'train')"""


def _panel(select_sql: str, split: bool = False) -> str:
    base = with_ctes("SELECT 1", panel=True)
    return base[: base.rindex("SELECT 1")].rstrip() + (_SPLIT_CTES if split else "") + "\n" + select_sql.strip()


def _cm(x: str) -> str:
    return (f"(CASE WHEN lower(trim(CAST({x} AS VARCHAR))) IN ('', 'nan', 'none', 'null') THEN NULL "
            f"ELSE CAST({x} AS VARCHAR) END)")


_PRODUCT_PARTS = ", ".join(_cm(c) for c in ["product_name", "product_model_name", "product_subcategory_name",
                                            "product_category_name"])
_DISPLAY = f"""
  (CASE WHEN len(list_filter([{_PRODUCT_PARTS}], lambda x: x IS NOT NULL)) > 0
        THEN array_to_string(list_filter([{_PRODUCT_PARTS}], lambda x: x IS NOT NULL)[1:3], ' / ')
        ELSE 'Product ' || product_key END) || ' (Product ' || product_key || ')' AS product_key_display,
  CASE WHEN {_cm('store_name')} IS NOT NULL THEN {_cm('store_name')} || ' (Store ' || store_id || ')'
       ELSE 'Store ' || store_id END AS store_id_display,
  CASE WHEN {_cm('store_name')} IS NOT NULL THEN {_cm('store_name')} || ' (Customer ' || customer_key || ')'
       ELSE 'Customer ' || customer_key END AS customer_key_display,
  'Territory ' || territory_id AS territory_id_display,
  CASE WHEN {_cm('salesperson_id')} IS NOT NULL THEN {_cm('salesperson_id')} || ' (Salesperson ' || salesperson_key || ')'
       ELSE 'Salesperson ' || salesperson_key END AS salesperson_key_display"""

# Optional measures of the explorer summary.
_OPTIONAL = ["current_month_order_qty", "current_month_net_sales", "previous_month_sales", "rolling_avg_sales_3m",
             "current_month_discount_amount", "current_month_gross_sales", "previous_month_margin"]

_ATTR_NUM = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{c}' AS raw_feature, CAST({c} AS DOUBLE) AS x, next_period_net_sales AS y FROM train"
    for c in _NUMERIC)
_LEVELS = "\n  UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS raw_feature, coalesce(CAST({c} AS VARCHAR), 'MISSING') AS level FROM train"
    for c in _CATEGORICAL)
_OWN = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS raw_feature, coalesce(CAST({c} AS VARCHAR), 'MISSING') AS own, next_period_net_sales AS y FROM train"
    for c in _CATEGORICAL)

_SHARES = f""",
attr_long AS (
  SELECT * FROM (
  {_ATTR_NUM}
  UNION ALL
  SELECT o.raw_feature || '=' || l.level AS feature, o.raw_feature, CASE WHEN o.own = l.level THEN 1.0 ELSE 0.0 END AS x, o.y
  FROM ({_OWN}) o JOIN ({_LEVELS}) l ON o.raw_feature = l.raw_feature) u
  WHERE x IS NOT NULL AND y IS NOT NULL),
mom AS (
  SELECT feature, raw_feature, avg(x) AS mx,
         CASE WHEN var_pop(x) > 0 THEN covar_pop(x, y) / var_pop(x) ELSE 0.0 END AS slope
  FROM attr_long GROUP BY feature, raw_feature),
attr AS (
  SELECT a.feature, a.raw_feature, abs(first(m.slope) * avg(abs(a.x - m.mx))) AS mean_abs
  FROM attr_long a JOIN mom m ON a.feature = m.feature AND a.raw_feature = m.raw_feature
  GROUP BY a.feature, a.raw_feature),
grouped AS (
  SELECT raw_feature, sum(mean_abs) AS imp FROM attr GROUP BY raw_feature),
shares AS (
  SELECT raw_feature, imp AS mean_abs_shap,
         CASE WHEN total = 0 THEN 0.0 ELSE imp / total END AS importance_share,
         CASE WHEN total = 0 THEN 0.0 ELSE cum / total END AS cumulative_importance_share,
         rank
  FROM (SELECT raw_feature, imp, sum(imp) OVER () AS total,
               sum(imp) OVER (ORDER BY tie DESC, raw_feature ROWS UNBOUNDED PRECEDING) AS cum,
               row_number() OVER (ORDER BY tie DESC, raw_feature) AS rank
        FROM (SELECT *, CASE WHEN sum(imp) OVER () = 0 THEN 0.0 ELSE round(imp / sum(imp) OVER (), 9) END AS tie FROM grouped) t) g)"""

_ROUNDED_SHARES = """raw_feature, round(mean_abs_shap, 4) AS mean_abs_shap, round(importance_share, 8) AS importance_share,
       round(cumulative_importance_share, 8) AS cumulative_importance_share, rank"""

_MEDIANS = "\n  UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM train WHERE {c} IS NOT NULL"
                                  for c in _NUMERIC)
_MODES = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY 2"
    for c in _CATEGORICAL)

SQL.update({
    "split_assignment": _panel("""
SELECT product_key, store_id, customer_key, salesperson_key, year_num, month_num, split FROM splitted""", split=True),
    "impute_median_mode": _panel(f"""
SELECT feature, 'median' AS strategy, avg(x) AS median_value, CAST(NULL AS VARCHAR) AS mode_value
FROM (SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS r,
             count(*) OVER (PARTITION BY feature) AS n
      FROM ({_MEDIANS}) m) r
WHERE r = floor((n - 1) / 2) OR r = ceil((n - 1) / 2)
GROUP BY feature
UNION ALL
SELECT feature, 'most_frequent', CAST(NULL AS DOUBLE), first(v ORDER BY n DESC, v) FROM ({_MODES}) c GROUP BY feature""",
                                 split=True),
    "regression_metrics": _panel("""
SELECT split, count(*) AS n, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
       CASE WHEN var_pop(yd) = 0 THEN NULL ELSE round(1 - avg(e * e) / var_pop(yd), 8) END AS r2
FROM (SELECT split, CAST(next_period_net_sales AS DOUBLE) AS yd,
             CAST(next_period_net_sales AS DOUBLE) - CAST(rolling_avg_sales_3m AS DOUBLE) AS e
      FROM splitted WHERE next_period_net_sales IS NOT NULL AND rolling_avg_sales_3m IS NOT NULL) t
GROUP BY split""", split=True),
    "importance_shares": _panel(_SHARES + f"\nSELECT {_ROUNDED_SHARES} FROM shares", split=True),
    "coverage_selection": _panel(_SHARES + f"""
SELECT {_ROUNDED_SHARES} FROM (
  SELECT *, coalesce(lag(cumulative_importance_share) OVER (ORDER BY rank), 0.0) AS prev,
         max(mean_abs_shap) OVER () AS mx
  FROM shares) s
WHERE CASE WHEN mx = 0 THEN rank <= 10 ELSE prev < 0.95 END""", split=True),
    "product_store_summary": _panel(f"""
SELECT product_key_display, product_category_name, product_subcategory_name, product_model_name,
       store_id_display, customer_key_display, territory_id_display,
       {_EXACT_MEAN.format(c='current_month_net_sales')} AS avg_monthly_sales,
       count(current_month_net_sales) AS historical_records,
       {", ".join(_EXACT_MEAN.format(c=c) + f" AS avg_{c}" for c in _OPTIONAL)},
       concat_ws(' | ', {_cm('product_model_name')}, {_cm('product_key_display')}, {_cm('store_id_display')},
                 {_cm('customer_key_display')}) AS combination_label
FROM (SELECT *, {_DISPLAY} FROM engineered) d
GROUP BY product_key_display, product_category_name, product_subcategory_name, product_model_name,
         store_id_display, customer_key_display, territory_id_display"""),
    "lookup_labels": _panel(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, label, CAST(max(id) AS BIGINT) AS id
FROM (SELECT DISTINCT {c}_display AS label, {c} AS id FROM (SELECT *, {_DISPLAY} FROM engineered) d
      WHERE {c} IS NOT NULL) x GROUP BY label""" for c in ["product_key", "store_id", "customer_key", "salesperson_key", "territory_id"])),
    "request_normalise": _panel("""
SELECT concat_ws('|', product_key, store_id, customer_key, salesperson_key, year_num, month_num) AS request_id,
       product_key, store_id, month_num, current_month_net_sales, current_month_gross_sales,
       current_month_discount_amount, current_month_margin_amount, previous_month_sales,
       CAST(ceil(CAST(month_num AS DOUBLE) / 3) AS INTEGER) AS quarter_num,
       CASE WHEN CAST(ceil(CAST(month_num AS DOUBLE) / 3) AS INTEGER) = 4 THEN 1 ELSE 0 END AS is_q4,
       CASE WHEN month_num IN (11, 12) THEN 1 ELSE 0 END AS is_year_end_season,
       CASE WHEN month_num IN (6, 7) THEN 1 ELSE 0 END AS is_mid_year,
       sin(2 * pi() * CAST(month_num AS DOUBLE) / 12) AS month_sin,
       cos(2 * pi() * CAST(month_num AS DOUBLE) / 12) AS month_cos,
       CASE WHEN current_month_gross_sales = 0 THEN 0.0
            ELSE current_month_discount_amount / current_month_gross_sales END AS discount_percentage,
       CASE WHEN current_month_net_sales = 0 THEN 0.0
            ELSE current_month_margin_amount / current_month_net_sales END AS product_profitability_ratio,
       CASE WHEN previous_month_sales = 0 THEN 0.0
            ELSE (current_month_net_sales - previous_month_sales) / previous_month_sales END
         AS sales_growth_previous_period, false AS unreadable
FROM engineered"""),
})

SQL.update({
    "streaming_fingerprints": SQL["fingerprints"],
    "streaming_log_monitor": _log("""
SELECT time_bucket(INTERVAL 1 DAY, timestamp) AS window_start,
       time_bucket(INTERVAL 1 DAY, timestamp) + INTERVAL 1 DAY AS window_end, model_key,
       count(*) AS requests,
       CAST(sum(CAST(predicted_next_period_net_sales AS DECIMAL(38,6))) AS DOUBLE) / count(*) AS avg_prediction
FROM log GROUP BY 1, 2, 3"""),
})

# Columns of the profile.
_DESCRIBE_COLS = [*_NUMERIC, "next_period_net_sales"]
_DESC_LONG = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM splitted WHERE {c} IS NOT NULL" for c in _DESCRIBE_COLS)


def _quart(q: float, name: str) -> str:
    return f"""
q_{name} AS (
  SELECT column_name, min(x) + (max(x) - min(x)) * first(f) AS {name} FROM (
    SELECT column_name, x, (n - 1) * {q} - floor((n - 1) * {q}) AS f
    FROM ranked WHERE r = floor((n - 1) * {q}) OR r = ceil((n - 1) * {q})) t GROUP BY column_name)"""


_SUMMARY_SQL = SQL["product_store_summary"]
_SUMMARY_BODY = _SUMMARY_SQL[_SUMMARY_SQL.index("SELECT product_key_display, product_category_name"):]
_SUMMARY_PREFIX = _SUMMARY_SQL[: _SUMMARY_SQL.index("SELECT product_key_display, product_category_name")].rstrip()

SQL.update({
    "column_describe": _panel(f""", desc_long AS (
  {_DESC_LONG}),
ranked AS (
  SELECT column_name, x, row_number() OVER (PARTITION BY column_name ORDER BY x) - 1 AS r,
         count(*) OVER (PARTITION BY column_name) AS n
  FROM desc_long),
stats AS (
  SELECT column_name, count(*) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, max(x) AS max
  FROM desc_long GROUP BY column_name),{_quart(0.25, "q25")},{_quart(0.5, "q50")},{_quart(0.75, "q75")}
SELECT s.column_name, s.count, s.mean, s.std, s.min, q_q25.q25, q_q50.q50, q_q75.q75, s.max
FROM stats s JOIN q_q25 USING (column_name) JOIN q_q50 USING (column_name) JOIN q_q75 USING (column_name)""",
                              split=True).replace("WITH ", "WITH ", 1).replace("\n, desc_long", ",\ndesc_long"),
    "split_sizes": _panel("""
SELECT split, count(*) AS rows, 41 AS feature_count FROM splitted GROUP BY split""", split=True),
    "table_preview_fact": with_ctes("SELECT * FROM fact_store_sales ORDER BY fact_store_sales_key LIMIT 10"),
    "table_preview_raw": with_ctes("SELECT * EXCLUDE (period) FROM raw_store_sales ORDER BY raw_store_sales_id LIMIT 10"),
    "table_preview_customer": with_ctes("SELECT * FROM dim_store_customer ORDER BY customer_key LIMIT 10"),
    "table_preview_product": with_ctes("SELECT * FROM dim_product ORDER BY product_key LIMIT 10"),
    "table_preview_time": with_ctes("SELECT * FROM dim_time ORDER BY time_key LIMIT 10"),
    "table_preview_salesperson": with_ctes("SELECT * FROM dim_salesperson ORDER BY salesperson_key LIMIT 10"),
    "explorer_kpis": _SUMMARY_PREFIX + ",\nsummary AS (" + _SUMMARY_BODY + """)
SELECT CAST(sum(historical_records) AS BIGINT) AS historical_rows, count(*) AS combinations,
       CAST(sum(CAST(avg_monthly_sales AS DECIMAL(38,6))) AS DOUBLE) / count(avg_monthly_sales) AS mean_avg_monthly_sales
FROM summary""",
    "explorer_top20": _SUMMARY_PREFIX + ",\nsummary AS (" + _SUMMARY_BODY + """)
SELECT * FROM summary ORDER BY avg_monthly_sales DESC, combination_label, territory_id_display LIMIT 20""",
    "feature_options": _panel("""
SELECT DISTINCT 'product_category_name' AS feature, CAST(product_category_name AS VARCHAR) AS option FROM engineered WHERE product_category_name IS NOT NULL
UNION ALL SELECT DISTINCT 'product_subcategory_name', CAST(product_subcategory_name AS VARCHAR) FROM engineered WHERE product_subcategory_name IS NOT NULL
UNION ALL SELECT DISTINCT 'product_model_name', CAST(product_model_name AS VARCHAR) FROM engineered WHERE product_model_name IS NOT NULL
UNION ALL SELECT DISTINCT 'color', CAST(color AS VARCHAR) FROM engineered WHERE color IS NOT NULL
UNION ALL SELECT DISTINCT 'size', option FROM (SELECT CAST(size AS VARCHAR) AS option FROM engineered WHERE size IS NOT NULL UNION SELECT '') t
UNION ALL SELECT DISTINCT 'weight', option FROM (SELECT CAST(weight AS VARCHAR) AS option FROM engineered WHERE weight IS NOT NULL UNION SELECT '') t"""),
})

# The mart's columns.
_MART_COLS = ['fact_store_sales_key', 'sales_order_id', 'sales_order_detail_id', 'sales_order_number', 'customer_id', 'store_id', 'store_name', 'territory_id', 'product_id', 'product_name', 'product_subcategory_name', 'product_category_name', 'order_date', 'year_num', 'month_num', 'month_name', 'year_month', 'salesperson_id', 'salesperson_name', 'order_qty', 'unit_price', 'unit_price_discount', 'gross_amount', 'discount_amount', 'margin_amount', 'net_amount', 'header_subtotal', 'header_tax_amt', 'header_freight', 'header_total_due']
SQL["null_counts_mart"] = _mart(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM mart" for c in _MART_COLS))

SQL["lag_rolling_features"] = with_ctes("""
SELECT product_key, store_id, customer_key, salesperson_key, year_num, month_num, current_month_net_sales,
       previous_month_sales, rolling_avg_sales_3m, previous_month_margin, sales_growth_previous_period
FROM engineered""", panel=True)

# Keys of a representative record.
_REP_KEYS = ["product_key_display", "product_category_name", "product_subcategory_name", "product_model_name",
             "store_id_display", "customer_key_display", "territory_id_display"]
# Its replaced measures.
_REP_REPLACE = ["current_month_order_qty", "current_month_net_sales", "previous_month_sales", "rolling_avg_sales_3m",
                "current_month_discount_amount", "current_month_gross_sales", "previous_month_margin"]
_REP_ON = " AND ".join(f"CAST(d.{k} AS VARCHAR) IS NOT DISTINCT FROM CAST(s.{k} AS VARCHAR)" for k in _REP_KEYS)
_REP_SUMMARY_COLS = ", ".join(f"s.avg_{c}" for c in _REP_REPLACE) + ", s.avg_monthly_sales"
SQL["representative_records"] = _SUMMARY_PREFIX + _SPLIT_CTES + ",\nsummary AS (" + _SUMMARY_BODY + f"""),
d AS (SELECT * EXCLUDE (split), {_DISPLAY} FROM splitted),
ranked AS (
  SELECT d.*, {_REP_SUMMARY_COLS},
         row_number() OVER (PARTITION BY {", ".join("s." + k for k in _REP_KEYS)}
                            ORDER BY d.current_month_net_sales DESC NULLS LAST, d.product_key, d.customer_key,
                                     d.year_num, d.month_num) AS rn
  FROM d JOIN summary s ON {_REP_ON})
SELECT * EXCLUDE (rn, avg_monthly_sales, {", ".join("avg_" + c for c in _REP_REPLACE)})
       REPLACE ({", ".join(f"avg_{c} AS {c}" for c in _REP_REPLACE)}), avg_monthly_sales AS monthly_sales
FROM ranked WHERE rn = 1"""

SQL.update({
    "stamped_versions": SQL["fingerprints"],
    "monthly_load_replay": SQL["fact_transform"],
    "streaming_incremental_load": with_ctes("""
SELECT f.sales_order_id, f.sales_order_detail_id, c.customer_id, p.product_id, s.salesperson_id, f.order_date_key, f.order_qty,
       f.gross_amount, f.discount_amount, f.net_amount, f.margin_amount
FROM fact_store_sales f JOIN dim_store_customer c USING (customer_key) JOIN dim_product p USING (product_key)
JOIN dim_salesperson s USING (salesperson_key)"""),
})

# Drift of the scored log: train rows against the other rows, whose arms alternate in request order, validation first.
_WATCHED = ["current_month_net_sales", "previous_month_sales", "rolling_avg_sales_3m", "month_num"]
_WATCHED_CATEGORIES = ["product_category_name", "color"]
_SCORED_SIDES = f""", sides AS (
  SELECT model, 'ref' AS side, {", ".join(_WATCHED + _WATCHED_CATEGORIES)}
  FROM splitted, (VALUES ('gradient_boosting'), ('random_forest')) m(model) WHERE split = 'train'
  UNION ALL
  SELECT CASE WHEN i % 2 = 0 THEN 'gradient_boosting' ELSE 'random_forest' END, 'prod', {", ".join(_WATCHED + _WATCHED_CATEGORIES)}
  FROM (SELECT *, row_number() OVER (ORDER BY CASE split WHEN 'validation' THEN 0 ELSE 1 END,
                  concat_ws('|', product_key, store_id, customer_key, salesperson_key, year_num, month_num)) - 1 AS i
        FROM splitted WHERE split <> 'train') r)"""


def _scored(kind: str, rows: str, opening: str, closing: str) -> str:
    """The statement of the event log's drift, over the scored log's sides and features."""
    body = SQL[kind][SQL[kind].index(opening):]
    first, last = body.index("SELECT model, '"), body.index(closing)
    return _panel(_SCORED_SIDES + "\n" + body[:first] + rows + body[last:], split=True)


_SCORED_D = _scored("numeric_drift_d", " UNION ALL ".join(
    f"SELECT model, '{c}' AS feature, side, CAST({c} AS DOUBLE) AS value FROM sides" for c in _WATCHED), ", long AS", ") u")
_SCORED_C = _scored("categorical_drift", " UNION ALL ".join(
    f"SELECT model, '{c}' AS feature, side, coalesce(CAST({c} AS VARCHAR), 'MISSING') AS category FROM sides" for c in _WATCHED_CATEGORIES), ", cl AS", "),\ncc AS")
SQL["scored_drift"] = (f"SELECT * FROM ({SQL['numeric_drift_p'].replace(SQL['numeric_drift_d'], _SCORED_D)}) n "
                       f"UNION ALL BY NAME SELECT * FROM ({_SCORED_C}) c")


# The visible inputs of a model on the features that the coverage rule selects.
def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


_VISIBLE = _SHARES + f""",
selected AS (
  SELECT raw_feature FROM (SELECT *, coalesce(lag(cumulative_importance_share) OVER (ORDER BY rank), 0.0) AS prev,
                                  max(mean_abs_shap) OVER () AS mx FROM shares) s
  WHERE CASE WHEN mx = 0 THEN rank <= 10 ELSE prev < 0.95 END),
dep(derived, parent) AS (VALUES {_values((d, x) for d, xs in IM.DERIVED_DEPENDENCIES.items() for x in xs)}),
name(feature, label) AS (VALUES {_values(IM.FEATURE_LABELS.items())}),
own AS (SELECT raw_feature AS feature, true AS needed FROM selected
        UNION ALL SELECT f, false FROM (VALUES {_values((f,) for f in IM.SCENARIO_ADJUSTMENT_FEATURES)}) d(f)),
edge AS (SELECT feature, CASE WHEN needed THEN coalesce(parent, feature) ELSE feature END AS visible, needed FROM own LEFT JOIN dep ON feature = derived),
node AS (SELECT visible, bool_or(needed) AS needed FROM edge GROUP BY visible),
source AS (SELECT visible, feature AS source FROM edge WHERE needed UNION SELECT visible, visible FROM node),
pct AS (SELECT visible, sum(coalesce(importance_share, 0.0)) AS p FROM source LEFT JOIN shares ON raw_feature = source GROUP BY visible),
seen AS (
  SELECT n.visible AS feature, coalesce(label, n.visible) AS label, round(p, 8) AS importance_pct, needed AS is_model_required_or_dependency,
         CASE WHEN n.visible LIKE 'product\\_%' ESCAPE '\\' OR n.visible IN ({", ".join(f"'{c}'" for c in IM.PRODUCT_INPUTS)}) THEN 'Product inputs'
              WHEN n.visible LIKE 'customer\\_%' ESCAPE '\\' OR n.visible IN ({", ".join(f"'{c}'" for c in IM.CUSTOMER_INPUTS)}) THEN 'Customer and store inputs'
              WHEN n.visible LIKE 'salesperson%' OR n.visible IN ({", ".join(f"'{c}'" for c in IM.PERSON_INPUTS)}) THEN 'Salesperson inputs'
              WHEN n.visible IN ({", ".join(f"'{c}'" for c in IM.TIME_INPUTS)}) THEN 'Time inputs'
              ELSE 'Sales and demand inputs' END AS "group"
  FROM node n JOIN pct ON pct.visible = n.visible LEFT JOIN name ON name.feature = n.visible)
"""
SQL["visible_features"] = _panel(_VISIBLE + "SELECT * FROM seen", split=True)
SQL["feature_groups"] = _panel(_VISIBLE + """SELECT "group", string_agg(feature, ',' ORDER BY feature) AS features FROM seen GROUP BY "group" """, split=True)

SQL["default_filled_records"] = _panel(f"""
SELECT product_key, store_id, customer_key, salesperson_key, year_num, month_num, coalesce({_cm('size')}, '') AS size, coalesce({_cm('color')}, 'Red') AS color,
       coalesce({_cm('product_category_name')}, 'Clothing') AS product_category_name, coalesce({_cm('product_model_name')}, 'Mountain Socks') AS product_model_name,
       coalesce(sales_quota, 5000.0) AS sales_quota, weight, 'Customer 200' AS customer_name
FROM engineered""")
