"""The scalar functions under SQL names, for use in `spark.sql`.

All are SQL expressions that the optimizer inlines; none runs Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "event_hour(ts BIGINT)": ("INT", "hour(timestamp_millis(ts))"),
    "event_time(ts BIGINT)": ("TIMESTAMP", "timestamp_millis(ts)"),
    "month_end(ts TIMESTAMP)": ("DATE", "last_day(ts)"),
    "day_key(ts TIMESTAMP)": ("INT", "cast(date_format(ts, 'yyyyMMdd') AS INT)"),
    "weekend(ts TIMESTAMP)": ("BOOLEAN", "weekday(ts) >= 5"),
    "concat_pair(a STRING, b STRING)": ("STRING", "coalesce(a || ', ' || b, a, b)"),
    "nice_name(name STRING)": (
        "STRING",
        "concat(upper(substring(name, 1, 1)), lower(substring(name, 2)))",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, (returns, body) in FUNCTIONS.items():
        declared = f"{signature} RETURNS {returns}"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {declared} RETURN {body}")

# Table functions over the views `inventory` and `rental`.
STOCK_FUNCTIONS = {
    "film_in_stock(film INT, store INT) RETURNS TABLE (inventory_id INT)": (
        "SELECT i.inventory_id FROM inventory i LEFT ANTI JOIN"
        " (SELECT inventory_id FROM rental WHERE return_date IS NULL) o"
        " ON i.inventory_id = o.inventory_id WHERE i.film_id = film AND i.store_id = store"
    ),
    "film_not_in_stock(film INT, store INT) RETURNS TABLE (inventory_id INT)": (
        "SELECT i.inventory_id FROM inventory i LEFT SEMI JOIN"
        " (SELECT inventory_id FROM rental WHERE return_date IS NULL) o"
        " ON i.inventory_id = o.inventory_id WHERE i.film_id = film AND i.store_id = store"
    ),
    "item_held_by(item INT) RETURNS TABLE (customer_id INT)": (
        "SELECT customer_id FROM rental WHERE return_date IS NULL AND inventory_id = item"
    ),
}


def register_stock_functions(spark: SparkSession) -> None:
    """For single films and items; whole tables are answered by `rental_reports`."""
    for signature, body in STOCK_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
