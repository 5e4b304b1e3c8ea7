"""Questions on user events."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestar.operators import activity as a
from lakestar.plans import tables as t
from lakestar.plans.registry import query
from lakestar.sinks.tables import lookup


@query("""
    SELECT hour(ts)::INT AS hour, count(*) AS plays FROM events
    WHERE event_type = 'click' GROUP BY 1
""")
def plays_by_hour(spark, sf):
    clicks = t.activity(spark, sf).where(F.col("page") == "click")
    return a.count_by_hour(clicks, "ts").orderBy("hour")


@query("""
    SELECT event_type AS page, count(event_type) AS plays FROM events GROUP BY 1
    ORDER BY plays DESC, page LIMIT 1
""")
def top_group(spark, sf):
    return a.top_value(t.activity(spark, sf), "page")


@query("SELECT count(DISTINCT user_id) AS users FROM events WHERE event_type = 'purchase'")
def distinct_users(spark, sf):
    return a.count_users(t.activity(spark, sf).where(F.col("page") == "purchase"), "user_id")


@query("""
    SELECT DISTINCT p_brand AS brand FROM part WHERE p_brand NOT IN (
      SELECT p_brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN part ON l_partkey = p_partkey WHERE o_custkey = 10)
""")
def pages_not_visited(spark, sf):
    """Brands one customer has never ordered."""
    own = t.orders(spark, sf).where(F.col("customer_id") == 10).select("order_id")
    ordered = t.order_lines(spark, sf).join(own, "order_id", "left_semi")
    products = t.products(spark, sf)
    bought = ordered.select("film_id").distinct()
    seen = products.join(bought, "film_id", "left_semi")
    return a.never_seen(products, seen, ["brand"])


@query("""
    SELECT event_id, user_id, (CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)::INT AS homevisit
    FROM events WHERE event_type = 'signup' OR event_type = 'view'
""")
def homevisit_flag(spark, sf):
    page = F.col("page")
    rows = t.activity(spark, sf).where((page == "signup") | (page == "view"))
    return a.mark(rows, page == "signup", "homevisit").select("event_id", "user_id", "homevisit")


@query("""
    SELECT event_id, user_id, ts, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts DESC
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS phase
    FROM events
""")
def phase_running_sum_range(spark, sf):
    rows = a.with_phase(
        t.activity(spark, sf), "user_id", ["-ts"], F.col("page") == "error", peers=True
    )
    return rows.select("event_id", "user_id", "ts", "phase")


@query("""
    SELECT event_id, user_id, ts, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS phase
    FROM events
""")
def phase_running_sum_rows(spark, sf):
    rows = a.with_phase(
        t.activity(spark, sf), "user_id", ["-ts", "-event_id"], F.col("page") == "error"
    )
    return rows.select("event_id", "user_id", "ts", "phase")


@query("""
    WITH periods AS (
      SELECT user_id, event_type, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period
      FROM events WHERE event_type IN ('signup', 'view')),
    counts AS (
      SELECT count(*) AS n FROM periods WHERE event_type = 'view' GROUP BY user_id, period)
    SELECT sum(n)::DOUBLE / count(*) AS songs FROM counts
""")
def avg_songs_between_home(spark, sf):
    page = F.col("page")
    return a.average_between(
        t.activity(spark, sf).select("user_id", "ts", "event_id", "page"),
        "user_id",
        ["-ts", "-event_id"],
        page == "signup",
        page == "view",
        "songs",
    )


@query("""
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS level FROM events GROUP BY user_id
""")
def users_latest_level(spark, sf):
    events = t.activity(spark, sf).withColumnRenamed("page", "level")
    return a.latest_level(events, "user_id", "level", ["ts", "event_id"])


@query("""
    SELECT user_id, count(DISTINCT event_type) AS levels FROM events GROUP BY user_id
    HAVING count(DISTINCT event_type) > 1
""")
def level_changers(spark, sf):
    return a.level_changers(t.activity(spark, sf), "user_id", "page")


@query("""
    SELECT DISTINCT user_id, event_type AS page, strftime(ts, '%Y-%m-%d') AS day FROM events
    WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1)
""")
def level_changers_history(spark, sf):
    return a.level_history(t.activity(spark, sf), "user_id", "page", "ts")


@query("""
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS page FROM events GROUP BY user_id
    HAVING count(DISTINCT event_type) > 1
""")
def level_changers_now(spark, sf):
    return a.level_changers_now(t.activity(spark, sf), "user_id", "page", ["ts", "event_id"])


@query("SELECT (isodow(ts) - 1)::INT AS weekday, count(*) AS n FROM events GROUP BY 1")
def counts_by_weekday(spark, sf):
    events = t.activity(spark, sf)
    return events.groupBy(F.weekday("ts").alias("weekday")).agg(F.count("*").alias("n"))


@query("""
    SELECT week(o_orderdate)::INT AS week, isoyear(o_orderdate)::INT AS year, count(*) AS n
    FROM orders GROUP BY 1, 2
""")
def counts_by_week(spark, sf):
    """ISO weeks, with the year that the week belongs to."""
    orders = t.table(spark, sf, "orders")
    year = F.expr("extract(YEAROFWEEK FROM o_orderdate)")
    keys = [F.weekofyear("o_orderdate").alias("week"), year.alias("year")]
    return orders.groupBy(*keys).agg(F.count("*").alias("n"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def counts_by_date(spark, sf):
    events = t.activity(spark, sf)
    return events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority AS level, count(*) AS n FROM orders GROUP BY 1 ORDER BY n, level")
def counts_by_level(spark, sf):
    orders = t.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("level"))
    return orders.groupBy("level").agg(F.count("*").alias("n")).orderBy("n", "level")


@query("SELECT l_linestatus AS gender, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n, gender")
def counts_by_gender(spark, sf):
    lines = t.table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("gender"))
    return lines.groupBy("gender").agg(F.count("*").alias("n")).orderBy("n", "gender")


@query("SELECT user_id, count(*) AS plays FROM events WHERE event_type = 'click' GROUP BY user_id")
def plays_per_user(spark, sf):
    clicks = t.activity(spark, sf).where(F.col("page") == "click")
    return clicks.groupBy("user_id").agg(F.count("*").alias("plays"))


# --- lookups of one key, which is what these tables are laid out for ---------------------------


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey = 3 AND l_linenumber = 2
""")
def lookup_session_item(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    found = lookup(lines, {"l_orderkey": 3, "l_linenumber": 2})
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("""
    SELECT event_id, ts, event_type AS page FROM events WHERE user_id = 10 ORDER BY ts, event_id
""")
def session_history(spark, sf):
    found = lookup(t.activity(spark, sf), {"user_id": 10}, ["ts", "event_id"])
    return found.select("event_id", "ts", "page")


@query("SELECT DISTINCT event_type AS page, user_id FROM events WHERE event_type = 'purchase'")
def listeners_of(spark, sf):
    return lookup(t.activity(spark, sf), {"page": "purchase"}).select("page", "user_id").distinct()


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_suppkey = 7")
def lookup_non_prefix(spark, sf):
    found = lookup(t.table(spark, sf, "lineitem"), {"l_suppkey": 7})
    return found.select("l_orderkey", "l_partkey", "l_suppkey")
