"""Cube questions on the sales star, and the star benchmark."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakestar.operators import olap
from lakestar.operators import star_benchmark as ssb
from lakestar.operators.joins import colocated_join
from lakestar.plans import tables as t
from lakestar.plans.registry import query
from lakestar.session import ensure_checkpoint_dir
from lakestar.sinks.tables import save_colocated

# The SQL twin of `tables.sales` with all attributes.
SALES = """
    WITH sales AS (
      SELECT l_extendedprice::DECIMAL(18,2) AS amount, o_orderdate AS payment_date,
             day(o_orderdate)::INT AS day, month(o_orderdate)::INT AS month,
             p_name AS title, p_type AS category, c_name AS customer,
             c_mktsegment AS city, cn.n_name AS district, cr.r_name AS country,
             s_name AS store, sn.n_name AS store_district, sr.r_name AS store_country
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN part ON l_partkey = p_partkey
      JOIN customer ON o_custkey = c_custkey
      JOIN nation cn ON c_nationkey = cn.n_nationkey
      JOIN region cr ON cn.n_regionkey = cr.r_regionkey
      JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation sn ON s_nationkey = sn.n_nationkey
      JOIN region sr ON sn.n_regionkey = sr.r_regionkey)
"""


def _by_day(spark, sf, place, where=None):
    """The largest sums per day, category and place."""
    rows = t.sales(spark, sf, buyer=[place], product=["category"])
    return t.in_units(
        olap.revenue_by(rows, ["day", "category", place], "amount", where, top=20), "revenue"
    )


def _top(place, where=""):
    return f"""{SALES} SELECT day, category, {place}, sum(amount)::DOUBLE AS revenue FROM sales
    {where} GROUP BY ALL ORDER BY revenue DESC, day, category, {place} LIMIT 20"""


@query(_top("city"))
def olap_simple_cube(spark, sf):
    return _by_day(spark, sf, "city")


@query(_top("city", "WHERE category = 'PROMO'"))
def olap_slice(spark, sf):
    return _by_day(spark, sf, "city", {"category": ["PROMO"]})


@query(_top("city", "WHERE category IN ('PROMO', 'SMALL') AND city IN ('BUILDING', 'MACHINERY')"
                    " AND day IN (1, 15, 30)"))
def olap_dice(spark, sf):
    where = {
        "category": ["PROMO", "SMALL"],
        "city": ["BUILDING", "MACHINERY"],
        "day": [1, 15, 30],
    }
    return _by_day(spark, sf, "city", where)


@query(_top("country"))
def olap_rollup_level(spark, sf):
    return _by_day(spark, sf, "country")


@query(_top("district"))
def olap_drilldown_level(spark, sf):
    return _by_day(spark, sf, "district")


@query("SELECT sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue FROM lineitem")
def revenue_total(spark, sf):
    total = t.order_lines(spark, sf).agg(F.sum("amount").alias("revenue"))
    return t.in_units(total, "revenue")


def _with_store(sums, spark, sf):
    """Sums per store with the attributes of the store: only the sums meet the store table."""
    return sums.join(t.stores(spark, sf, ["country"]), "store_id")


@query(SALES + """
    SELECT store_country AS country, sum(amount)::DOUBLE AS revenue FROM sales GROUP BY 1
""")
def revenue_by_country(spark, sf):
    per_store = olap.revenue_by(t.order_lines(spark, sf), ["store_id"], "amount", name="amount")
    named = _with_store(per_store, spark, sf)
    return t.in_units(olap.revenue_by(named, ["country"], "amount"), "revenue")


@query(SALES + "SELECT month, sum(amount)::DOUBLE AS revenue FROM sales GROUP BY 1")
def revenue_by_month(spark, sf):
    rows = t.order_sums(spark, sf)
    return t.in_units(olap.revenue_by(rows, ["month"], "amount"), "revenue")


def _month_country(spark, sf):
    """Sums per month and store with the store's country: far fewer rows than sales, so a cube
    multiplies only these."""
    sums = olap.revenue_by(t.sales(spark, sf), ["month", "store_id"], "amount", name="amount")
    return _with_store(sums, spark, sf)


@query(SALES + """
    SELECT month, store_country AS country, sum(amount)::DOUBLE AS revenue FROM sales GROUP BY 1, 2
""")
def revenue_by_month_country(spark, sf):
    sums = olap.revenue_by(_month_country(spark, sf), ["month", "country"], "amount")
    return t.in_units(sums, "revenue")


@query(SALES + """
    SELECT month, store_country AS country, sum(amount)::DOUBLE AS revenue,
           grouping(month, store_country)::INT AS grouping_id
    FROM sales GROUP BY GROUPING SETS ((), (month), (store_country), (month, store_country))
""")
def olap_grouping_sets(spark, sf):
    sets = [[], ["month"], ["country"], ["month", "country"]]
    rows = _month_country(spark, sf)
    sums = olap.grouping_sets(rows, sets, ["month", "country"], "amount")
    return t.in_units(sums, "revenue")


@query(SALES + """
    SELECT month, store_country AS country, sum(amount)::DOUBLE AS revenue,
           grouping(month, store_country)::INT AS grouping_id
    FROM sales GROUP BY CUBE (month, store_country)
""")
def olap_cube(spark, sf):
    sums = olap.cube(_month_country(spark, sf), ["month", "country"], "amount")
    return t.in_units(sums, "revenue")


@query(SALES + """
    SELECT NULL::VARCHAR AS month, NULL AS country, sum(amount)::DOUBLE AS revenue FROM sales
    UNION ALL SELECT NULL, store_country, sum(amount)::DOUBLE FROM sales GROUP BY store_country
    UNION ALL SELECT month::VARCHAR, NULL, sum(amount)::DOUBLE FROM sales GROUP BY month
    UNION ALL SELECT month::VARCHAR, store_country, sum(amount)::DOUBLE FROM sales
    GROUP BY month, store_country
""")
def olap_cube_union(spark, sf):
    sums = olap.cube_by_union(_month_country(spark, sf), "month", "country", "amount")
    return t.in_units(sums, "revenue")


@query("""
    SELECT p_name AS title, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
    ORDER BY revenue DESC, title LIMIT 10
""")
def top10_parts(spark, sf):
    """Best-selling titles. Lines are summed per part first, so a hot part is one row per task."""
    per_part = olap.revenue_by(t.order_lines(spark, sf), ["film_id"], "amount", name="amount")
    named = per_part.join(t.products(spark, sf), "film_id")
    return t.in_units(olap.revenue_by(named, ["title"], "amount", top=10), "revenue")


@query(SALES + """
    SELECT district, sum(amount)::DOUBLE AS revenue FROM sales GROUP BY district
    ORDER BY revenue DESC, district LIMIT 10
""")
def top10_cities(spark, sf):
    """Summed per order, then per customer, before a place is known."""
    sums = t.order_sums(spark, sf)
    per_buyer = olap.revenue_by(sums, ["customer_id"], "amount", name="amount")
    placed = per_buyer.join(t.buyers(spark, sf, ["district"]), "customer_id")
    return t.in_units(olap.revenue_by(placed, ["district"], "amount", top=10), "revenue")


@query("""
    SELECT n_name AS district, count(*) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
    ORDER BY customers DESC, district LIMIT 10
""")
def count_by_district(spark, sf):
    counts = t.table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("customers")
    )
    nation = t.table(spark, sf, "nation")
    named = counts.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        named.select(F.col("n_name").alias("district"), "customers")
        .orderBy(F.col("customers").desc(), "district")
        .limit(10)
    )


@query(SALES + """
    SELECT title, city, month, sum(amount)::DOUBLE AS revenue FROM sales GROUP BY 1, 2, 3
""")
def revenue_by_part_segment_month(spark, sf):
    """Ordered by month, then revenue; ties by title and city."""
    rows = t.sales(spark, sf, buyer=["city"], product=["title"])
    sums = t.in_units(olap.revenue_by(rows, ["title", "city", "month"], "amount"), "revenue")
    return sums.orderBy("month", F.col("revenue").desc(), "title", "city")


@query(SALES + """
    SELECT title, amount::DOUBLE AS amount, payment_date, month, city, district FROM sales
""")
def payment_detail(spark, sf):
    rows = t.sales(spark, sf, buyer=["city", "district"], product=["title"])
    return t.in_units(rows, "amount").select(
        "title", "amount", "payment_date", "month", "city", "district"
    )


# --- star benchmark ----------------------------------------------------------------------------


def _revenue(df):
    """Cents times percent as units."""
    return t.in_units(df, "revenue", scale=10_000)


@query("""
    SELECT sum(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::DOUBLE AS revenue
    FROM lineitem, orders
    WHERE l_orderkey = o_orderkey AND year(o_orderdate) = 1997
      AND l_discount::DECIMAL(4,2) BETWEEN 0.01 AND 0.03 AND l_quantity < 24
""")
def ssb_one_dim(spark, sf):
    return _revenue(ssb.one_dim(t.lineorder(spark, sf), 1997, 1, 3, 24))


@query("""
    SELECT sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS revenue,
           year(o_orderdate)::INT AS d_year, p_brand AS p_brand1
    FROM lineitem, orders, part, supplier, nation, region
    WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey AND l_suppkey = s_suppkey
      AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
      AND p_type = 'PROMO' AND r_name = 'AMERICA'
    GROUP BY d_year, p_brand1
""")
def ssb_two_dim(spark, sf):
    brands = ssb.brands_of(t.benchmark_part(spark, sf), "PROMO")
    sellers = ssb.sellers_of(t.benchmark_supplier(spark, sf), "AMERICA")
    links = [
        (sellers, "lo_suppkey", "s_suppkey", "left_semi"),
        (brands, "lo_partkey", "p_partkey", "inner"),
    ]
    return _revenue(ssb.revenue_by_brand(t.lineorder(spark, sf, of_lines=links)))


@query("""
    SELECT cn.n_name AS c_city, sn.n_name AS s_city, year(o_orderdate)::INT AS d_year,
           sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS revenue
    FROM customer, lineitem, orders, supplier, nation cn, nation sn
    WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND l_suppkey = s_suppkey
      AND c_nationkey = cn.n_nationkey AND s_nationkey = sn.n_nationkey
      AND (cn.n_name = 'NATION_1' OR cn.n_name = 'NATION_5')
      AND (sn.n_name = 'NATION_2' OR sn.n_name = 'NATION_20')
      AND o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    GROUP BY 1, 2, 3
""")
def ssb_drill(spark, sf):
    customer, supplier = t.benchmark_customer(spark, sf), t.benchmark_supplier(spark, sf)
    buyers = ssb.in_cities(customer, "c_city", ["NATION_1", "NATION_5"], "c_custkey")
    sellers = ssb.in_cities(supplier, "s_city", ["NATION_2", "NATION_20"], "s_suppkey")
    rows = t.lineorder(
        spark,
        sf,
        of_lines=[(sellers, "lo_suppkey", "s_suppkey", "inner")],
        of_orders=[(buyers, "lo_custkey", "c_custkey", "inner")],
    )
    return _revenue(ssb.revenue_by_cities(rows, "1997-12-01", "1998-01-01"))


@query("""
    SELECT l_shipdate AS lo_orderdate,
           sum(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::DOUBLE AS revenue
    FROM lineitem, part WHERE l_partkey = p_partkey GROUP BY l_shipdate ORDER BY l_shipdate
""")
def ssb_same_dist(spark, sf):
    sums = ssb.same_dist(t.shipped_lines(spark, sf), t.benchmark_part(spark, sf))
    return _revenue(sums.orderBy("lo_orderdate"))


@query("""
    SELECT l_shipdate AS lo_orderdate,
           sum(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::DOUBLE AS revenue
    FROM lineitem, part WHERE l_partkey = p_partkey GROUP BY l_shipdate
""")
def ssb_same_dist_colocated(spark, sf):
    """The same question on a pair of tables that are bucketed by product: the join moves no row."""
    lines = t.shipped_lines(spark, sf)
    part = t.benchmark_part(spark, sf).select(F.col("p_partkey").alias("lo_partkey"))
    mark = uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/colocated-{mark}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = (f"lines_{mark}", f"part_{mark}")
    fact, dimension = save_colocated(lines, part, tables, "lo_partkey", buckets, path)
    joined = colocated_join(fact, dimension, "lo_partkey", "left_semi")
    return _revenue(joined.groupBy("lo_orderdate").agg(F.sum(ssb.discount_revenue()).alias("revenue")))
