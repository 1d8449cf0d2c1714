"""Declared schemas of the warehouse tables (DDL strings → StructType)."""

from __future__ import annotations

from pyspark.sql.types import StructType

_DDL = {
    "dim_store_customer": "customer_key long, customer_id long, store_id long, store_name string, "
                          "account_number string, territory_id long, store_salesperson_id long",
    "dim_product": "product_key long, product_id long, product_name string, product_number string, "
                   "color string, size string, size_unit_measure_code string, "
                   "weight_unit_measure_code string, weight decimal(8,2), standard_cost decimal(19,4), "
                   "list_price decimal(19,4), product_model_name string, "
                   "product_subcategory_name string, product_category_name string, "
                   "sell_start_date timestamp_ntz, sell_end_date timestamp_ntz, discontinued_date timestamp_ntz",
    "dim_time": "time_key int, full_date date, day_of_month int, month_num int, month_name string, "
                "quarter_num int, year_num int, week_of_year int, day_name string, is_weekend int",
    "dim_salesperson": "salesperson_key long, salesperson_id long, full_name string, title string, "
                       "sales_quota decimal(19,4), bonus decimal(19,4), commission_pct decimal(10,4), "
                       "sales_ytd decimal(19,4), sales_last_year decimal(19,4)",
    "raw_store_sales": "raw_store_sales_id long, sales_order_id long, sales_order_detail_id long, "
                       "order_date timestamp_ntz, due_date timestamp_ntz, ship_date timestamp_ntz, status int, "
                       "sales_order_number string, purchase_order_number string, "
                       "account_number string, customer_id long, store_id long, store_name string, "
                       "salesperson_id long, territory_id long, product_id long, order_qty short, "
                       "unit_price decimal(19,4), unit_price_discount decimal(19,4), "
                       "line_total decimal(38,6), subtotal decimal(19,4), tax_amt decimal(19,4), "
                       "freight decimal(19,4), total_due decimal(19,4), currency_rate_id int, "
                       "ship_method_id int, comment string",
    "fact_store_sales": "fact_store_sales_key long, sales_order_id long, sales_order_detail_id long, "
                        "sales_order_number string, customer_key long, product_key long, "
                        "order_date_key int, salesperson_key long, order_qty short, "
                        "unit_price decimal(19,4), unit_price_discount decimal(19,4), "
                        "gross_amount decimal(19,4), discount_amount decimal(19,4), "
                        "margin_amount decimal(38,6), net_amount decimal(38,6), "
                        "header_subtotal decimal(19,4), header_tax_amt decimal(19,4), "
                        "header_freight decimal(19,4), header_total_due decimal(19,4)",
}

WAREHOUSE: dict[str, StructType] = {k: StructType.fromDDL(v) for k, v in _DDL.items()}

IMPORTANCE = StructType.fromDDL(
    "raw_feature string, mean_abs_shap double, importance_share double, "
    "cumulative_importance_share double")
