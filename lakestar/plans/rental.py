"""Reports of the rental business on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestar.operators import rental_reports as r
from lakestar.plans import tables as t
from lakestar.plans.registry import query

PLACE = "JOIN nation ON {} = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(f"""
    SELECT c_custkey AS id, replace(c_name, '#', ' ') AS name, n_name AS address,
           n_nationkey::VARCHAR AS zip_code, '+' || n_nationkey AS phone, n_name AS city,
           r_name AS country, CASE WHEN c_acctbal >= 0 THEN 'active' ELSE '' END AS notes,
           c_nationkey AS sid
    FROM customer {PLACE.format('c_nationkey')}
""")
def customer_list(spark, sf):
    return r.customer_list(t.customer(spark, sf), *t.address_parts(spark, sf))


@query(f"""
    SELECT s_suppkey AS id, replace(s_name, '#', ' ') AS name, n_name AS address,
           n_nationkey::VARCHAR AS zip_code, '+' || n_nationkey AS phone, n_name AS city,
           r_name AS country, s_suppkey AS sid
    FROM supplier {PLACE.format('s_nationkey')}
""")
def staff_list(spark, sf):
    return r.staff_list(t.staff(spark, sf), *t.address_parts(spark, sf))


def _sellers_as_cast(spark, sf):
    """(product, nation selling it) pairs, and the nations as people.

    A product has at most as many of them as there are nations, so its list stays short.
    """
    lines = t.order_lines(spark, sf)
    supplier = t.table(spark, sf, "supplier")
    cast = lines.join(supplier, F.col("store_id") == F.col("s_suppkey")).select(
        "film_id", F.col("s_nationkey").alias("actor_id")
    )
    nation = t.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("actor_id"),
        F.substring_index("n_name", "_", 1).alias("first_name"),
        F.substring_index("n_name", "_", -1).alias("last_name"),
    )
    return cast.distinct(), nation


def _film_list_sql(name):
    return f"""
    SELECT p_partkey AS fid, p_name AS title, p_brand AS description, p_type AS category,
           p_retailprice::DECIMAL(18,2)::DOUBLE AS price, p_size AS length, p_brand AS rating,
           actors
    FROM part JOIN (
      SELECT l_partkey, string_agg({name}, ', ' ORDER BY {name}) AS actors
      FROM (SELECT DISTINCT l_partkey, n_name FROM lineitem
            JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
      GROUP BY l_partkey) ON l_partkey = p_partkey
    """


def _film_list(spark, sf, nice):
    cast, people = _sellers_as_cast(spark, sf)
    film = t.film(spark, sf)
    links, category = t.film_category(spark, sf), t.category(spark, sf)
    films = r.film_list(film, links, category, cast, people, nice_names=nice)
    return t.in_units(films, "price")


@query(_film_list_sql("replace(n_name, '_', ' ')"))
def film_list_like(spark, sf):
    return _film_list(spark, sf, nice=False)


@query(_film_list_sql("replace(replace(n_name, 'NATION', 'Nation'), '_', '')"))
def film_list_nice(spark, sf):
    return _film_list(spark, sf, nice=True)


@query("""
    WITH titles AS (
      SELECT s_suppkey, p_type, string_agg(p_name, ', ' ORDER BY p_name) AS titles
      FROM (SELECT DISTINCT l_suppkey AS s_suppkey, p_type, p_name
            FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1, 2),
    info AS (
      SELECT s_suppkey, string_agg(p_type || ': ' || titles, ', ' ORDER BY p_type || ': ' || titles)
             AS film_info
      FROM titles GROUP BY 1)
    SELECT s.s_suppkey AS actor_id, split_part(s_name, '#', 1) AS first_name,
           split_part(s_name, '#', 2) AS last_name, film_info
    FROM supplier s LEFT JOIN info i ON s.s_suppkey = i.s_suppkey
""")
def actor_info_like(spark, sf):
    """Suppliers with the titles they sell, by category.

    A film here is a title within a category, so a text holds each title once.
    """
    titles = t.products(spark, sf).select("film_id", "category", "title")
    key = F.concat_ws("/", "category", "title").alias("film_id")
    pairs = titles.select("category", "title").distinct()
    film = pairs.select(key, "title")
    links = pairs.select(key, F.col("category").alias("category_id"))
    sold = t.order_lines(spark, sf).select("film_id", "store_id").join(titles, "film_id")
    roles = sold.select("store_id", "category", "title").distinct()
    cast = roles.select(F.col("store_id").alias("actor_id"), key)
    actor = t.staff(spark, sf).withColumnRenamed("staff_id", "actor_id")
    return r.actor_info(actor, cast, film, links, t.category(spark, sf))


@query("""
    WITH d AS (SELECT DISTINCT l_suppkey, p_type, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
    u AS (
      SELECT *, sum(length(p_name) + 2) OVER (PARTITION BY l_suppkey, p_type ORDER BY p_name
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(p_name) - 2 AS before FROM d)
    SELECT s_suppkey AS actor_id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
           p_type AS category, (before // 500)::BIGINT AS page, string_agg(p_name, ', ' ORDER BY p_name) AS titles
    FROM u JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL
""")
def actor_info_paged(spark, sf):
    """Suppliers with the titles they sell, by category, in cells that do not grow with the catalogue."""
    titles = t.products(spark, sf).select("film_id", "category", "title")
    sold = t.order_lines(spark, sf).select("film_id", F.col("store_id").alias("actor_id")).join(titles, "film_id")
    actor = t.staff(spark, sf).withColumnRenamed("staff_id", "actor_id")
    return r.actor_info_pages(actor, sold, page_chars=500)


ITEMS = """
    WITH items AS (
      SELECT DISTINCT l_partkey || '-' || l_suppkey AS inventory_id, l_partkey AS film_id,
             l_suppkey AS store_id FROM lineitem),
    out AS (SELECT l_partkey || '-' || l_suppkey AS inventory_id FROM lineitem
            WHERE l_returnflag = 'N')
"""


@query(ITEMS + "SELECT * FROM items WHERE inventory_id NOT IN (SELECT inventory_id FROM out)")
def in_stock_items(spark, sf):
    return r.in_stock(t.inventory(spark, sf), t.item_states(spark, sf))


@query(ITEMS + "SELECT * FROM items WHERE inventory_id IN (SELECT inventory_id FROM out)")
def not_in_stock_items(spark, sf):
    return r.not_in_stock(t.inventory(spark, sf), t.item_states(spark, sf))


@query("""
    SELECT DISTINCT l_partkey || '-' || l_suppkey AS inventory_id, o_custkey AS customer_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'N'
""")
def item_holder(spark, sf):
    return r.item_holders(t.rental(spark, sf))


def _balance_sql(extra=""):
    return f"""
    WITH charges AS (
      SELECT o_custkey, p_retailprice::DECIMAL(18,2) AS rate, p_size,
             CASE WHEN l_returnflag <> 'N'
                  THEN greatest(date_diff('day', o_orderdate, l_shipdate) - p_size, 0)
                  ELSE 0 END AS late
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      WHERE o_orderdate <= TIMESTAMP '1999-06-30'),
    owed AS (SELECT o_custkey, sum(rate) + sum(late) {extra} AS owed FROM charges GROUP BY 1),
    paid AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS paid FROM orders
             WHERE o_orderdate <= TIMESTAMP '1999-06-30' GROUP BY 1)
    SELECT c_custkey AS customer_id,
           (coalesce(owed, 0) - coalesce(paid, 0))::DECIMAL(28,2)::DOUBLE AS balance
    FROM customer LEFT JOIN owed o ON c_custkey = o.o_custkey
    LEFT JOIN paid p ON c_custkey = p.o_custkey
    """


def _balance(spark, sf, replacement):
    rental = t.rental(spark, sf).drop("inventory_id")
    terms = t.film(spark, sf).select(
        "film_id", "rental_rate", "rental_duration", "replacement_cost"
    )
    charges = rental.join(terms, "film_id")
    payment = t.payment(spark, sf)
    as_of = t.day("1999-06-30")
    balance = r.customer_balance(
        t.customer(spark, sf), charges, payment, as_of, replacement, late_fee=100
    )
    return t.in_units(balance, "balance")


@query(_balance_sql())
def customer_balance(spark, sf):
    return _balance(spark, sf, replacement=False)


@query(_balance_sql("+ sum(CASE WHEN late > 2 * p_size THEN rate ELSE 0 END)"))
def customer_balance_replacement(spark, sf):
    """With the replacement cost of films that are very late."""
    return _balance(spark, sf, replacement=True)


@query("""
    SELECT c_custkey AS customer_id, c_name FROM customer WHERE c_custkey IN (
      SELECT o_custkey FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate < TIMESTAMP '1998-03-01'
      GROUP BY 1 HAVING sum(o_totalprice::DECIMAL(18,2)) > 100000 AND count(*) > 1)
""")
def rewards_report(spark, sf):
    customer = t.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name"
    )
    as_of = F.lit("1998-05-20").cast("date")
    return r.rewards_report(customer, t.payment(spark, sf), 1, 100_000_00, as_of)


@query("""
    SELECT p_type AS category, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def sales_by_category(spark, sf):
    lines = t.order_lines(spark, sf)
    sums = r.sales_by_category(lines, t.film_category(spark, sf), t.category(spark, sf))
    return t.in_units(sums, "total_sales")


@query(f"""
    SELECT s_suppkey AS store_id, n_name || ',' || r_name AS store,
           replace(s_name, '#', ' ') AS manager,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total_sales
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey {PLACE.format('s_nationkey')}
    GROUP BY ALL
""")
def sales_by_store(spark, sf):
    staff = t.staff(spark, sf).select("staff_id", "first_name", "last_name")
    places = t.address_parts(spark, sf)
    sums = r.sales_by_store(t.order_lines(spark, sf), t.store(spark, sf), staff, *places)
    return t.in_units(sums, "total_sales")
