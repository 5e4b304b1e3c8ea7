"""Normal forms, keys, keyed writes and star schemas on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestar.operators import audit
from lakestar.operators import event_star as es
from lakestar.operators import keyed, keys, normalize, ordering
from lakestar.operators import rental_star as rs
from lakestar.plans import tables as t
from lakestar.plans.registry import query

AS_OF = "2001-12-31"

# --- normal forms ------------------------------------------------------------------------------


@query("""
    SELECT vec_id, label, (generate_subscripts(embedding, 1) - 1)::INT AS position,
           unnest(embedding)::DOUBLE AS element
    FROM embeddings
""")
def normalize_1nf(spark, sf):
    vectors = t.table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    rows = normalize.list_to_rows(vectors, "embedding", "element", "position")
    return rows.withColumn("element", F.col("element").cast("double"))


@query("""
    WITH rows AS (
      SELECT doc_id, (generate_subscripts(lines, 1) - 1)::INT AS line_no, unnest(lines) AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
    SELECT row_number() OVER (ORDER BY doc_id, line_no) AS line_id, doc_id, line_no, line FROM rows
""")
def normalize_2nf(spark, sf):
    """The line table: document attributes split off, every line with its own id."""
    documents = t.table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return normalize.list_to_numbered_rows(
        documents, "doc_id", "lines", "line", "line_no", "line_id"
    )


@query("SELECT DISTINCT doc_id, lang, source FROM documents WHERE text IS NOT NULL")
def normalize_2nf_parent(spark, sf):
    """The other half: one row per document that has lines, with what depends on the document only."""
    documents = t.table(spark, sf, "documents").where(F.col("text").isNotNull())
    return documents.select("doc_id", "lang", "source").distinct()


@query("""
    WITH segments AS (
      SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS segment_id
      FROM (SELECT DISTINCT c_mktsegment FROM customer))
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, segment_id
    FROM customer JOIN segments USING (c_mktsegment)
""")
def normalize_3nf(spark, sf):
    customer = t.table(spark, sf, "customer")
    return normalize.extract_dimension(customer, ["c_mktsegment"], "segment_id")[0]


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def recompose_3nf(spark, sf):
    """Joining the normal form back gives the original table."""
    customer = t.table(spark, sf, "customer")
    narrow, segments = normalize.extract_dimension(customer, ["c_mktsegment"], "segment_id")
    return normalize.denormalize(narrow, [(segments, "segment_id")]).select(*customer.columns)


# --- keys and keyed writes ---------------------------------------------------------------------


@query("""
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id,
           o_orderkey, o_orderdate FROM orders
""")
def surrogate_key(spark, sf):
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ordering.add_row_numbers(orders, ["o_orderdate", "o_orderkey"], "order_id", ties=[])


@query("""
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS line_id,
           l_orderkey, l_linenumber FROM lineitem
""")
def surrogate_key_copies(spark, sf):
    """Numbers from 0 for rows that may be equal."""
    lines = ordering.source_row(t.table(spark, sf, "lineitem")).select("l_orderkey", "l_linenumber", "_row")
    numbered = ordering.add_row_numbers(lines, ["l_orderkey"], "line_id", 0, ["l_linenumber", "_row"])
    return numbered.drop("_row")


@query("""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1
""")
def lww_by_key(spark, sf):
    lines = t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    return keyed.latest_by(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _writes(spark, sf):
    """(the user table on the first morning, the events after it)"""
    events = t.activity(spark, sf).select("user_id", "page", "ts", "event_id")
    morning = F.col("ts") < t.day("2024-01-01 06:00:00")
    users = keyed.first_by(events.where(morning), ["user_id"], ["ts", "event_id"])
    return users, events.where(~morning)


WRITES = """
    WITH early AS (
      SELECT user_id, event_type AS page, ts, event_id FROM events
      WHERE ts < TIMESTAMP '2024-01-01 06:00:00'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
    late AS (
      SELECT user_id, event_type AS page, ts, event_id,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS up,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS down
      FROM events WHERE ts >= TIMESTAMP '2024-01-01 06:00:00')
"""


@query(WRITES + """
    SELECT user_id, page, ts, event_id FROM early
    UNION ALL SELECT user_id, page, ts, event_id FROM late
    WHERE up = 1 AND user_id NOT IN (SELECT user_id FROM early)
""")
def upsert_insert_ignore(spark, sf):
    users, events = _writes(spark, sf)
    return keyed.insert_ignore(users, events, ["user_id"], ["ts", "event_id"])


@query(WRITES + """
    SELECT coalesce(e.user_id, f.user_id) AS user_id, coalesce(l.page, e.page) AS page,
           coalesce(e.ts, f.ts) AS ts, coalesce(e.event_id, f.event_id) AS event_id
    FROM early e FULL JOIN (SELECT * FROM late WHERE up = 1) f ON e.user_id = f.user_id
    LEFT JOIN (SELECT * FROM late WHERE down = 1) l ON f.user_id = l.user_id
""")
def upsert_update_level(spark, sf):
    """Only the page (the level) is updated; the rest stays as first written."""
    users, events = _writes(spark, sf)
    return keyed.upsert(users, events, ["user_id"], ["page"], ["ts", "event_id"])


# --- sales star --------------------------------------------------------------------------------


@query("""
    SELECT DISTINCT strftime(o_orderdate, '%Y%m%d')::INT AS date_key,
           strftime(o_orderdate, '%Y-%m-%d') AS date, year(o_orderdate)::INT AS year,
           quarter(o_orderdate)::INT AS quarter, month(o_orderdate)::INT AS month,
           day(o_orderdate)::INT AS day, week(o_orderdate)::INT AS week,
           isodow(o_orderdate) IN (6, 7) AS is_weekend
    FROM orders
""")
def dim_date(spark, sf):
    return rs.dim_date(t.table(spark, sf, "orders"), "o_orderdate")


@query(f"""
    SELECT c_custkey AS customer_key, c_custkey AS customer_id,
           split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
           c_mktsegment AS email, n_name AS address, NULL::VARCHAR AS address2,
           n_name AS district, n_name AS city, r_name AS country,
           n_nationkey::VARCHAR AS postal_code, '+' || n_nationkey AS phone,
           (CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END)::INT AS active,
           '1995-01-01' AS create_date, '{AS_OF}' AS start_date, '{AS_OF}' AS end_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def dim_customer(spark, sf):
    as_of = F.lit(AS_OF).cast("date")
    return rs.dim_customer(t.customer(spark, sf), *t.address_parts(spark, sf), as_of)


@query("""
    SELECT p_partkey AS movie_key, p_partkey AS film_id, p_name AS title, p_brand AS description,
           NULL::INT AS release_year, lower(p_type) AS language,
           CASE WHEN p_size >= 25 THEN lower(p_type) END AS original_language,
           p_size AS rental_duration, p_size AS length, p_brand AS rating,
           p_type AS special_features
    FROM part
""")
def dim_product(spark, sf):
    return rs.dim_movie(t.film(spark, sf), t.language(spark, sf))


@query(f"""
    SELECT s_suppkey AS store_key, s_suppkey AS store_id, n_name AS address,
           NULL::VARCHAR AS address2, n_name AS district, n_name AS city, r_name AS country,
           n_nationkey::VARCHAR AS postal_code, split_part(s_name, '#', 1) AS manager_first_name,
           split_part(s_name, '#', 2) AS manager_last_name,
           '{AS_OF}' AS start_date, '{AS_OF}' AS end_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def dim_store(spark, sf):
    as_of = F.lit(AS_OF).cast("date")
    staff = t.staff(spark, sf).select("staff_id", "first_name", "last_name")
    return rs.dim_store(t.store(spark, sf), staff, *t.address_parts(spark, sf), as_of)


FACT = """
    SELECT strftime(o_orderdate, '%Y%m%d')::INT AS date_key, o_custkey AS customer_key,
           l_partkey AS movie_key, l_suppkey AS store_key,
           l_extendedprice::DECIMAL(18,2)::DOUBLE AS sales_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


@query(FACT)
def fact_sales(spark, sf):
    return t.in_units(rs.fact_sales(t.sales(spark, sf)), "sales_amount")


@query(f"""
    SELECT row_number() OVER (
             ORDER BY date_key, customer_key, movie_key, store_key, sales_amount) - 1 AS sales_key,
           * FROM ({FACT})
""")
def fact_sales_keyed(spark, sf):
    fact = rs.fact_sales(t.sales(spark, sf, line=["_row"]), "_row")
    return t.in_units(rs.number_sales(fact, row_key="_row"), "sales_amount")


@query("""
    SELECT cn.n_name AS buyer_nation, sn.n_name AS seller_nation,
           count(*) AS lines, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey AND sn.n_regionkey <> cn.n_regionkey
    GROUP BY 1, 2
""")
def role_playing_dim(spark, sf):
    """The nation table twice: the buyer's, and the seller's if it lies in another region."""
    customer = t.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    supplier = t.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    buyers = t.orders(spark, sf).join(customer, F.col("customer_id") == F.col("c_custkey"))
    sellers = t.order_lines(spark, sf).join(supplier, F.col("store_id") == F.col("s_suppkey"))
    sums = (
        sellers.join(buyers, "order_id")
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count("*").alias("lines"), F.sum("amount").alias("amount"))
    )
    nation = t.table(spark, sf, "nation")
    buyer, seller = nation.alias("b"), nation.alias("s")
    named = sums.join(buyer, F.col("c_nationkey") == F.col("b.n_nationkey")).join(
        seller,
        (F.col("s_nationkey") == F.col("s.n_nationkey"))
        & (F.col("s.n_regionkey") != F.col("b.n_regionkey")),
        "left",
    )
    keys = F.col("b.n_name").alias("buyer_nation"), F.col("s.n_name").alias("seller_nation")
    totals = named.groupBy(*keys).agg(
        F.sum("lines").alias("lines"), F.sum("amount").alias("revenue")
    )
    return t.in_units(totals, "revenue")


@query("""
    SELECT c_name, p_name, c_acctbal >= 0 AS rewards, l_extendedprice AS spent
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > 100000
""")
def star_spent_over(spark, sf):
    """Who spent more than the bound on one line, and on what."""
    lines = t.table(spark, sf, "lineitem").where(F.col("l_extendedprice") > 100000)
    part = t.table(spark, sf, "part").select("p_partkey", "p_name")
    customer = t.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "c_name",
            "p_name",
            (F.col("c_acctbal") >= 0).alias("rewards"),
            F.col("l_extendedprice").alias("spent"),
        )
    )


@query("""
    SELECT s_name AS store, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS spent
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name
""")
def star_sum_per_store(spark, sf):
    sums = t.order_lines(spark, sf).groupBy("store_id").agg(F.sum("amount").alias("spent"))
    supplier = t.table(spark, sf, "supplier")
    named = sums.join(supplier, F.col("store_id") == F.col("s_suppkey"))
    return t.in_units(named.select(F.col("s_name").alias("store"), "spent"), "spent")


# --- event star --------------------------------------------------------------------------------


@query("""
    SELECT DISTINCT ts AS start_time, hour(ts)::INT AS hour, day(ts)::INT AS day,
           week(ts)::INT AS week, month(ts)::INT AS month, year(ts)::INT AS year,
           (isodow(ts) - 1)::INT AS weekday
    FROM events
""")
def time_dim(spark, sf):
    return es.time_dim(t.table(spark, sf, "events"), "ts")


@query("""
    SELECT p_partkey::VARCHAR AS song_id, p_name AS title, p_brand AS artist_id, p_size AS year,
           p_retailprice::DECIMAL(10,5)::DOUBLE AS duration FROM part
""")
def songs_dim(spark, sf):
    return es.songs_dim(t.songs_raw(spark, sf))


@query("""
    SELECT row_number() OVER (ORDER BY title, artist_id, year, duration) AS song_id, * FROM (
      SELECT DISTINCT p_name AS title, p_brand AS artist_id, p_size AS year,
             p_retailprice::DECIMAL(10,5)::DOUBLE AS duration FROM part)
""")
def songs_by_content(spark, sf):
    return es.songs_by_content(t.songs_raw(spark, sf))


@query("""
    SELECT p_brand AS artist_id, min(p_brand || ' with ' || p_type) AS name, min(p_type) AS location,
           NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude FROM part GROUP BY p_brand
""")
def artists_dim(spark, sf):
    return es.artists_dim(t.songs_raw(spark, sf))


@query("""
    SELECT o_custkey::BIGINT AS user_id, o_orderstatus AS first_name, o_orderpriority AS last_name,
           l_linestatus AS gender, o_orderpriority AS level
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'N'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, l_orderkey DESC,
      l_linenumber DESC, o_orderstatus DESC, o_orderpriority DESC, l_linestatus DESC) = 1
""")
def users_dim(spark, sf):
    return es.users_dim(t.log(spark, sf))


@query("""
    WITH catalogue AS (
      SELECT p_name, p_brand || ' with ' || p_type AS artist, p_retailprice,
             min((p_partkey::VARCHAR, p_brand)) AS ids
      FROM part GROUP BY 1, 2, 3),
    plays AS (
      SELECT o_orderdate AS start_time, o_custkey::BIGINT AS user_id, o_orderpriority AS level,
             ids[1] AS song_id, ids[2] AS artist_id, l_orderkey AS session_id,
             l_returnflag AS location, l_linestatus AS user_agent
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part p ON l_partkey = p_partkey
      LEFT JOIN catalogue c ON p.p_name = c.p_name AND p.p_retailprice = c.p_retailprice
        AND c.artist = CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_brand || ' with ' || p_type END
      WHERE l_returnflag = 'N')
    SELECT row_number() OVER (ORDER BY start_time, user_id, level, song_id NULLS FIRST,
             artist_id NULLS FIRST, session_id, location, user_agent) AS songplay_id, * FROM plays
""")
def fact_songplays(spark, sf):
    """The play fact with at most one song per play, by title, artist and duration."""
    return es.songplays(t.log(spark, sf), t.songs_raw(spark, sf), use_duration=True, row_key="_row")


@query("""
    WITH plays AS (
      SELECT o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N')
    SELECT 'songs' AS table_name, count(DISTINCT p_partkey) AS num_rows FROM part
    UNION ALL SELECT 'artists', count(DISTINCT p_brand) FROM part
    UNION ALL SELECT 'users', count(DISTINCT o_custkey) FROM plays
    UNION ALL SELECT 'time', count(DISTINCT o_orderdate) FROM plays
    UNION ALL SELECT 'songplays', count(*) FROM plays
""")
def event_star_sizes(spark, sf):
    """The whole event star, built as one; rows per table."""
    star = es.build_event_star(t.songs_raw(spark, sf), t.log(spark, sf))
    return audit.row_counts(star)


GROWN = """
    WITH known AS (
      SELECT p_type, p_brand, row_number() OVER (ORDER BY p_type, p_brand) AS product_id FROM (
        SELECT DISTINCT p_type, p_brand FROM part WHERE p_partkey IN (
          SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-10')
          AND p_size < 20)),
    keys AS (
      SELECT * FROM known UNION ALL
      SELECT p_type, p_brand, (SELECT coalesce(max(product_id), 0) FROM known)
             + row_number() OVER (ORDER BY p_type, p_brand)
      FROM (SELECT DISTINCT p_type, p_brand FROM part ANTI JOIN known USING (p_type, p_brand)))
"""


def _grown(spark, sf):
    """(all products, the key map of types and brands after a first run on what had been sold early)"""
    part = t.table(spark, sf, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    early = t.table(spark, sf, "lineitem").where(F.col("l_shipdate") < t.day("1995-01-10 00:00:00"))
    sold = part.join(early.select("l_partkey").distinct(), F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    small = sold.where(F.col("p_size") < 20)
    return part, keys.extend_keys(small, ["p_type", "p_brand"], "product_id")


@query(GROWN + " SELECT * FROM keys")
def dimension_keys_grown(spark, sf):
    """The key map after a second run on all products: early values keep their keys."""
    part, known = _grown(spark, sf)
    return keys.extend_keys(part, ["p_type", "p_brand"], "product_id", known)


@query(GROWN + " SELECT p_partkey, product_id FROM part JOIN keys USING (p_type, p_brand)")
def keyed_by_grown_map(spark, sf):
    """All products with the key of that map."""
    part, known = _grown(spark, sf)
    grown = keys.extend_keys(part, ["p_type", "p_brand"], "product_id", known)
    narrow = part.select("p_partkey", "p_type", "p_brand")
    return keys.replace_by_key(narrow, grown, ["p_type", "p_brand"], "product_id")
