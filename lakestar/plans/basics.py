"""Scans, filters, joins and plain aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestar.functions.text import capitalized, count_values, group_concat, paged_concat, words
from lakestar.operators import audit
from lakestar.operators.joins import first_match
from lakestar.operators.normalize import denormalize
from lakestar.plans import tables as t
from lakestar.plans.registry import query
from lakestar.sources.events import consolidate, drop_incomplete


@query("SELECT * FROM orders")
def scan_parquet(spark, sf):
    return t.table(spark, sf, "orders")


@query(
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders"
    " ORDER BY o_orderdate DESC, o_orderkey LIMIT 5"
)
def sample_rows(spark, sf):
    """Example records of a table: the newest five."""
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.orderBy(F.col("o_orderdate").desc(), "o_orderkey").limit(5)


@query(
    "SELECT event_id, ts, user_id, event_type, value FROM events"
    " WHERE event_type IS NOT NULL AND trim(event_type) <> ''"
)
def consolidate_events(spark, sf):
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return consolidate(t.table(spark, sf, "events"), "event_type", columns)


@query(
    "SELECT p_partkey AS product_id, p_name AS title, p_brand AS brand,"
    " p_retailprice * 2 AS double_price FROM part"
)
def project_alias(spark, sf):
    return t.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        (F.col("p_retailprice") * 2).alias("double_price"),
    )


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf):
    events = t.table(spark, sf, "events").where(F.col("event_type") == "purchase")
    return events.select("event_id", "user_id", "value")


@query(
    "SELECT event_id, user_id, event_type, value FROM events"
    " WHERE (event_type = 'purchase' OR event_type = 'signup') AND value > 5"
)
def filter_or(spark, sf):
    kind = F.col("event_type")
    wanted = ((kind == "purchase") | (kind == "signup")) & (F.col("value") > 5)
    return t.table(spark, sf, "events").where(wanted).select(
        "event_id", "user_id", "event_type", "value"
    )


@query(
    "SELECT o_orderkey, o_totalprice FROM orders"
    " WHERE o_orderstatus = 'F' AND o_totalprice >= 100000"
)
def filter_param(spark, sf):
    """Values bound as parameters of a SQL text, never pasted into it."""
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders}"
        " WHERE o_orderstatus = :status AND o_totalprice >= :least",
        args={"status": "F", "least": 100000.0},
        orders=t.table(spark, sf, "orders"),
    )


@query(
    "SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    " WHERE quality IS NOT NULL AND lang IS NOT NULL"
)
def dropna_subset(spark, sf):
    documents = t.table(spark, sf, "documents").select("doc_id", "lang")
    labelled = documents.join(t.table(spark, sf, "labels"), "doc_id", "left")
    return drop_incomplete(labelled, ["quality", "lang"]).select("doc_id", "lang", "quality")


@query(
    "SELECT count(*) AS documents, count(quality) AS labelled,"
    " count(*) - count(quality) AS unlabelled"
    " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
def not_null_pairs(spark, sf):
    """How many rows found their match."""
    documents = t.table(spark, sf, "documents").select("doc_id")
    labelled = documents.join(t.table(spark, sf, "labels"), "doc_id", "left")
    return labelled.agg(
        F.count("*").alias("documents"),
        F.count("quality").alias("labelled"),
        F.count_if(F.col("quality").isNull()).alias("unlabelled"),
    )


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_values(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS num_rows FROM {name}" for name in t.NAMES
))
def table_counts(spark, sf):
    return audit.row_counts({name: t.table(spark, sf, name) for name in t.NAMES})


# --- joins -------------------------------------------------------------------------------------


@query(
    "SELECT o_orderkey, c_custkey, c_name, o_totalprice"
    " FROM orders JOIN customer ON o_custkey = c_custkey"
)
def join_inner(spark, sf):
    """Joining on one name keeps the key column once."""
    orders = t.table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = orders.join(t.table(spark, sf, "customer"), "c_custkey")
    return joined.select("o_orderkey", "c_custkey", "c_name", "o_totalprice")


@query("""
    WITH catalogue AS (
      SELECT p_name AS title, p_brand AS artist, min(p_partkey) AS song_id
      FROM part GROUP BY 1, 2)
    SELECT title, artist, min(song_id) AS song_id, count(*) AS plays
    FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN catalogue ON p_name = title AND p_brand = artist GROUP BY title, artist
""")
def join_two_keys(spark, sf):
    """Plays per catalogue title. Plays are counted per title first, then matched on two keys."""
    sold = t.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("_n"))
    part = t.table(spark, sf, "part")
    titles = sold.join(part, F.col("l_partkey") == F.col("p_partkey"))
    keys = [F.col("p_name").alias("title"), F.col("p_brand").alias("artist")]
    plays = titles.groupBy(*keys).agg(F.sum("_n").alias("plays"))
    catalogue = part.select(*keys, F.col("p_partkey").alias("song_id"))
    return first_match(plays, catalogue, ["title", "artist"], ["song_id"], how="inner")


@query("""
    WITH catalogue AS (
      SELECT p_name, p_brand, p_retailprice, min(p_partkey) AS song_id
      FROM part GROUP BY 1, 2, 3)
    SELECT l_orderkey, l_linenumber, l_partkey, song_id
    FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN catalogue c ON part.p_name = c.p_name AND part.p_brand = c.p_brand
      AND part.p_retailprice = c.p_retailprice
""")
def lookup_join_single(spark, sf):
    """At most one catalogue entry per line, by title, artist and price; no line is multiplied.

    The match depends on the product alone, so products are matched and lines only pick it up.
    """
    part = t.table(spark, sf, "part")
    on = ["p_name", "p_brand", "price"]
    parts = part.select("p_partkey", "p_name", "p_brand", t.cents("p_retailprice").alias("price"))
    catalogue = part.select(
        "p_name",
        "p_brand",
        t.cents("p_retailprice").alias("price"),
        F.col("p_partkey").alias("song_id"),
    )
    matched = first_match(parts, catalogue, on, ["song_id"]).select("p_partkey", "song_id")
    lines = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(matched, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


@query("""
    SELECT a.o_orderkey, b.c_name, a.o_totalprice
    FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F') a
    JOIN (SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING') b
    ON a.o_custkey = b.c_custkey
""")
def join_derived(spark, sf):
    finished = t.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    builders = t.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    joined = finished.join(builders, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_name", "o_totalprice")


@query("""
    SELECT r_name, n_name, c_custkey FROM region
    LEFT JOIN nation ON r_regionkey = n_regionkey
    LEFT JOIN customer ON n_nationkey = c_nationkey AND c_acctbal < 0
""")
def left_chain(spark, sf):
    """Every region and nation, with its customers in debt if there are any."""
    debtors = t.table(spark, sf, "customer").where(F.col("c_acctbal") < 0)
    region, nation = t.table(spark, sf, "region"), t.table(spark, sf, "nation")
    places = region.join(nation, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    # Customers are the large side of an inner join, which can be cut on a hot nation; as the right
    # side of an outer join they could not. Places without one are few and added.
    names = ["r_name", "n_name", "c_custkey"]
    here = F.col("n_nationkey") == F.col("c_nationkey")
    some = debtors.join(places, here).select(*names)
    owing = debtors.select("c_nationkey").distinct()
    none = places.join(owing, here, "left_anti").withColumn("c_custkey", F.lit(None).cast("bigint"))
    return some.unionByName(none.select(*names))


@query("""
    SELECT o_orderkey, o_totalprice, c_name, c_mktsegment, n_name FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def denormalize_orders(spark, sf):
    orders = t.table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    nation = t.table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    wide = denormalize(
        orders, [(t.table(spark, sf, "customer"), "c_custkey"), (nation, "c_nationkey")]
    )
    return wide.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "n_name")


# --- aggregates --------------------------------------------------------------------------------


@query("""
    SELECT p_name AS title, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
""")
def revenue_by_part(spark, sf):
    """Revenue per title in one grouping after the join."""
    joined = t.order_lines(spark, sf).join(t.products(spark, sf), "film_id")
    return t.in_units(joined.groupBy("title").agg(F.sum("amount").alias("revenue")), "revenue")


@query("""
    WITH per_price AS (
      SELECT l_partkey, l_extendedprice::DECIMAL(18,2) AS price, count(*) AS n
      FROM lineitem GROUP BY 1, 2)
    SELECT p_name AS title, sum(price * n)::DOUBLE AS revenue
    FROM per_price JOIN part ON l_partkey = p_partkey GROUP BY p_name
""")
def revenue_by_part_two_step(spark, sf):
    """The same revenue by counting equal prices per part first, then price times count."""
    lines = t.order_lines(spark, sf)
    counts = lines.groupBy("film_id", "amount").agg(F.count("*").alias("_n"))
    named = counts.join(t.products(spark, sf), "film_id")
    sums = named.groupBy("title").agg(F.sum(F.col("amount") * F.col("_n")).alias("revenue"))
    return t.in_units(sums, "revenue")


@query("""
    SELECT p_name, sum(p_retailprice::DECIMAL(18,2))::DOUBLE AS total, count(*) AS n
    FROM part GROUP BY p_name
""")
def sum_by_name(spark, sf):
    """A narrow table answers the sum per name without a join."""
    sums = t.table(spark, sf, "part").groupBy("p_name").agg(
        F.sum(t.cents("p_retailprice")).alias("total"), F.count("*").alias("n")
    )
    return t.in_units(sums, "total")


@query("""
    SELECT o_custkey, count(*) AS orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
    FROM orders GROUP BY o_custkey
    HAVING count(*) > 12 AND sum(o_totalprice::DECIMAL(18,2)) > 3000000
""")
def having_multi(spark, sf):
    grouped = t.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum(t.cents("o_totalprice")).alias("total")
    )
    kept = grouped.where((F.col("orders") > 12) & (F.col("total") > 3_000_000_00))
    return t.in_units(kept, "total")


@query("""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word
""")
def word_count(spark, sf):
    """How often each word occurs in all texts; counted in every task before the shuffle."""
    return count_values(words(t.table(spark, sf, "documents"), "text"), "word")


@query("""
    SELECT lower(p_name) AS title, count(*) AS n FROM part GROUP BY 1
""")
def lower_titles(spark, sf):
    titles = t.table(spark, sf, "part").select(F.lower("p_name").alias("title"))
    return count_values(titles, "title")


@query("""
    SELECT p_name,
           ((2 * sum(round(l_quantity * 100)::BIGINT) + count(*)) // (2 * count(*))) / 100 AS avg_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
    GROUP BY p_name ORDER BY avg_quantity DESC, p_name LIMIT 20
""")
def avg_by_group_in_range(spark, sf):
    """Best average per title in one year. Sums and counts are made per part before the join."""
    shipped = F.col("l_shipdate").between(t.day("1998-01-01"), t.day("1998-12-31"))
    per_part = (
        t.table(spark, sf, "lineitem")
        .where(shipped)
        .groupBy("l_partkey")
        .agg(
            F.sum(t.cents("l_quantity")).alias("_sum"),
            F.count("l_quantity").alias("_n"),
        )
    )
    part = t.table(spark, sf, "part").select("p_partkey", "p_name")
    named = per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
    averages = named.groupBy("p_name").agg(
        F.expr("floor((2 * sum(_sum) + sum(_n)) / (2 * sum(_n))) / 100").alias("avg_quantity")
    )
    return averages.orderBy(F.col("avg_quantity").desc(), "p_name").limit(20)


@query("""
    SELECT category, string_agg(brand, ', ' ORDER BY brand) AS brands
    FROM (SELECT DISTINCT p_type AS category, p_brand AS brand FROM part) GROUP BY category
""")
def string_agg_members(spark, sf):
    part = t.products(spark, sf)
    return group_concat(part, ["category"], "brand", "brands", distinct=True)


@query("""
    SELECT category, string_agg(name, ', ' ORDER BY name) AS names FROM (
      SELECT DISTINCT p_type AS category,
             upper(p_name[1]) || lower(p_name[2:]) AS name FROM part) GROUP BY category
""")
def nice_names(spark, sf):
    part = t.products(spark, sf).select("category", capitalized("title").alias("name"))
    return group_concat(part, ["category"], "name", "names", distinct=True)


@query("SELECT o_orderkey, last_day(o_orderdate)::VARCHAR AS month_end FROM orders")
def last_day_of_month(spark, sf):
    return t.table(spark, sf, "orders").select(
        "o_orderkey", F.last_day("o_orderdate").alias("month_end")
    )


@query("""
    WITH d AS (SELECT DISTINCT p_type AS category, upper(p_name[1]) || lower(p_name[2:]) AS name FROM part),
    u AS (
      SELECT *, sum(length(name) + 2) OVER (PARTITION BY category ORDER BY name
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(name) - 2 AS before FROM d)
    SELECT category, (before // 1000)::BIGINT AS page, string_agg(name, ', ' ORDER BY name) AS names FROM u GROUP BY 1, 2
""")
def nice_names_paged(spark, sf):
    """The names of a category in cells of bounded size."""
    part = t.products(spark, sf).select("category", capitalized("title").alias("name"))
    return paged_concat(part, ["category"], "name", "names", distinct=True, page_chars=1000)


@query("""
    WITH u AS (
      SELECT p_type AS category, p_brand AS brand, sum(length(p_brand) + 2) OVER (PARTITION BY p_type ORDER BY p_brand
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(p_brand) - 2 AS before FROM part)
    SELECT category, (before // 1000)::BIGINT AS page, string_agg(brand, ', ' ORDER BY brand) AS brands FROM u GROUP BY 1, 2
""")
def string_agg_paged(spark, sf):
    """Every product's brand, copies included, in cells of bounded size."""
    return paged_concat(t.products(spark, sf), ["category"], "brand", "brands", page_chars=1000)
