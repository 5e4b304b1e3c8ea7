"""The given tables, plain and in the shapes of the event, rental and benchmark domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.operators.ordering import source_row

NAMES = list(schemas.GIVEN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is declared, so no job has to look into the files first."""
    return spark.read.schema(schemas.GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    """A price as whole cents in 64 bits.

    Sums are exact, whatever the order of the rows, and far cheaper than sums of wide decimals.
    64 bits hold 9 * 10^16 units; a sum beyond that is an error, never a wrong number.
    """
    return F.rint(F.col(column) * 100).cast("long")


def in_units(df: DataFrame, *columns: str, scale: int = 100) -> DataFrame:
    """Sums of cents turned into units, for the result."""
    return df.withColumns({c: F.col(c) / scale for c in columns})


def day(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- sales star --------------------------------------------------------------------------------


def places(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """Nations (district), with their region (country) if wanted."""
    nation = table(spark, sf_dir, "nation")
    if "country" in columns:
        region = table(spark, sf_dir, "region")
        nation = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        nation = nation.withColumn("country", F.col("r_name"))
    return nation.withColumn("district", F.col("n_name")).select("n_nationkey", *columns)


def _placed(spark: SparkSession, sf_dir: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df`, which knows its nation, with its place as far as wanted."""
    wanted = [c for c in columns if c in ("district", "country")]
    return df.join(places(spark, sf_dir, wanted), "n_nationkey") if wanted else df


def buyers(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    return _placed(spark, sf_dir, customer, columns).select("customer_id", *columns)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
    )


def stores(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store"),
        F.col("s_nationkey").alias("n_nationkey"),
    )
    return _placed(spark, sf_dir, supplier, columns).select("store_id", *columns)


def order_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Order lines with their amount in cents; `_row`, if wanted, is their place in the files."""
    return source_row(table(spark, sf_dir, "lineitem")).select(
        *more,
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("store_id"),
        cents("l_extendedprice").alias("amount"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the parts of their day, worked out before they meet their lines."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("payment_date"),
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
    )


def sales(
    spark: SparkSession,
    sf_dir: str,
    buyer: Sequence[str] = (),
    product: Sequence[str] = (),
    line: Sequence[str] = (),
) -> DataFrame:
    """One row per order line, with the wanted attributes of buyer, product and line.

    Attributes of the buyer are joined to the orders, which are fewer than their lines, so the
    lines are shuffled by order once whatever the number of order attributes. Join attributes of
    the store after summing per store.
    """
    bought, lines = orders(spark, sf_dir), order_lines(spark, sf_dir, *line)
    if buyer:
        bought = bought.join(buyers(spark, sf_dir, buyer), "customer_id")
    if product:
        lines = lines.join(products(spark, sf_dir).select("film_id", *product), "film_id")
    return lines.join(bought, "order_id")


def order_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the sum of its lines.

    The sum and the join share one shuffle of the lines, and an order with very many lines is a
    single row by then.
    """
    per_order = order_lines(spark, sf_dir).groupBy("order_id").agg(F.sum("amount").alias("amount"))
    return per_order.join(orders(spark, sf_dir), "order_id")


# --- events ------------------------------------------------------------------------------------


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.col("event_type").alias("page"), "value"
    )


def artist_name() -> Column:
    """The name an artist (a brand) goes by on a product: one per type of product."""
    return F.concat_ws(" with ", "p_brand", "p_type")


def songs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products as the song catalogue: titles repeat, and an artist has several names."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_id"),
        artist_name().alias("artist_name"),
        F.col("p_type").alias("artist_location"),
        F.lit(None).cast("decimal(10,6)").alias("artist_latitude"),
        F.lit(None).cast("decimal(10,6)").alias("artist_longitude"),
        F.col("p_size").alias("year"),
        F.col("p_retailprice").cast("decimal(10,5)").alias("duration"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an activity log: lines not returned are plays of the ordered product. `_row` is
    their place in the files."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        # Some plays carry a name that the catalogue does not have.
        F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).otherwise(artist_name()).alias("_artist"),
        F.col("p_retailprice").cast("decimal(10,5)").alias("length"),
    )
    ordered = table(spark, sf_dir, "orders")
    lines = source_row(table(spark, sf_dir, "lineitem")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    joined = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("_artist").alias("artist"),
        F.col("p_name").alias("song"),
        "length",
        F.col("o_custkey").cast("string").alias("userId"),
        F.col("o_orderstatus").alias("firstName"),
        F.col("o_orderpriority").alias("lastName"),
        F.col("l_linestatus").alias("gender"),
        F.col("o_orderpriority").alias("level"),
        F.when(F.col("l_returnflag") == "N", "NextSong").otherwise("Home").alias("page"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        F.col("l_orderkey").alias("sessionId"),
        F.col("l_linenumber").alias("itemInSession"),
        F.col("l_returnflag").alias("location"),
        F.col("l_linestatus").alias("userAgent"),
        "_row",
    )


# --- rental business ---------------------------------------------------------------------------


def country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country")
    )


def city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city"),
        F.col("n_regionkey").alias("country_id"),
    )


def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("address_id"),
        F.col("n_name").alias("address"),
        F.lit(None).cast("string").alias("address2"),
        F.col("n_name").alias("district"),
        F.col("n_nationkey").alias("city_id"),
        F.col("n_nationkey").cast("string").alias("postal_code"),
        F.concat(F.lit("+"), F.col("n_nationkey").cast("string")).alias("phone"),
    )


def address_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return address(spark, sf_dir), city(spark, sf_dir), country(spark, sf_dir)


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; `Customer#17` is read as first and last name."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("store_id"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        F.col("c_mktsegment").alias("email"),
        F.col("c_nationkey").alias("address_id"),
        (F.col("c_acctbal") >= 0).alias("activebool"),
        F.lit("1995-01-01").cast("date").alias("create_date"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("active"),
    )


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("staff_id"),
        F.substring_index("s_name", "#", 1).alias("first_name"),
        F.substring_index("s_name", "#", -1).alias("last_name"),
        F.col("s_nationkey").alias("address_id"),
        F.col("s_suppkey").alias("store_id"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_suppkey").alias("manager_staff_id"),
        F.col("s_nationkey").alias("address_id"),
    )


def film(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as films; the original language is known for large ones only."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("description"),
        F.lit(None).cast("int").alias("release_year"),
        F.col("p_type").alias("language_id"),
        F.when(F.col("p_size") >= 25, F.col("p_type")).alias("original_language_id"),
        F.col("p_size").alias("rental_duration"),
        cents("p_retailprice").alias("rental_rate"),
        F.col("p_size").alias("length"),
        cents("p_retailprice").alias("replacement_cost"),
        F.col("p_brand").alias("rating"),
        F.col("p_type").alias("special_features"),
    )


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "part").select(F.col("p_type").alias("language_id")).distinct()
    return types.withColumn("name", F.lower("language_id"))


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "part").select(F.col("p_type").alias("category_id")).distinct()
    return types.withColumn("name", F.col("category_id"))


def film_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("film_id"), F.col("p_type").alias("category_id")
    )


def _item() -> Column:
    return F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))


def _returned() -> Column:
    return F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per product and store that sold it."""
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return pairs.select(
        _item().alias("inventory_id"),
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("store_id"),
    )


def item_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rentals without their customer, for questions on stock. Flag N means not returned yet."""
    return table(spark, sf_dir, "lineitem").select(
        _item().alias("inventory_id"), _returned().alias("return_date")
    )


def rental(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").alias("rental_date"),
        _item().alias("inventory_id"),
        F.col("l_partkey").alias("film_id"),
        F.col("o_custkey").alias("customer_id"),
        _returned().alias("return_date"),
    )


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("customer_id"),
        cents("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
    )


# --- star benchmark ----------------------------------------------------------------------------


def _price_and_discount() -> list[Column]:
    """Whole cents and whole percent, as the benchmark has them."""
    return [
        cents("l_extendedprice").alias("lo_extendedprice"),
        cents("l_discount").alias("lo_discount"),
        (cents("l_extendedprice") * (100 - cents("l_discount"))).alias("lo_revenue"),
    ]


#: A dimension with the fact's key and its own, and how it is joined.
Link = tuple[DataFrame, str, str, str]


def _linked(df: DataFrame, links: Sequence[Link]) -> DataFrame:
    for dimension, key, own, how in links:
        df = df.join(dimension, F.col(key) == F.col(own), how)
    return df


def lineorder(
    spark: SparkSession, sf_dir: str, of_lines: Sequence[Link] = (), of_orders: Sequence[Link] = ()
) -> DataFrame:
    """Order lines with their order's buyer and day.

    Dimensions of the lines and of the orders are joined before the two meet, so that selective
    ones shrink what is shuffled by order.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("lo_partkey"),
        F.col("l_suppkey").alias("lo_suppkey"),
        F.col("l_quantity").alias("lo_quantity"),
        *_price_and_discount(),
    )
    ordered = orders(spark, sf_dir).select(
        "order_id",
        F.col("customer_id").alias("lo_custkey"),
        F.col("payment_date").alias("lo_orderdate"),
    )
    return _linked(lines, of_lines).join(_linked(ordered, of_orders), "order_id")


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines dated by shipping, so no other table is needed."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("lo_partkey"),
        F.col("l_shipdate").alias("lo_orderdate"),
        *_price_and_discount(),
    )


def benchmark_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("p_category"), F.col("p_brand").alias("p_brand1")
    )


def benchmark_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores(spark, sf_dir, ["district", "country"]).select(
        F.col("store_id").alias("s_suppkey"),
        F.col("district").alias("s_city"),
        F.col("country").alias("s_region"),
    )


def benchmark_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buyers(spark, sf_dir, ["district"]).select(
        F.col("customer_id").alias("c_custkey"), F.col("district").alias("c_city")
    )
