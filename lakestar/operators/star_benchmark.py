"""The star benchmark questions.

Order dates are real dates here: a range on them reaches the file scan, and year or month are
functions of the date, so the calendar table need not be joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_order_date(lineorder: DataFrame) -> DataFrame:
    """The integer order day turned into a date."""
    day = F.to_date(F.col("lo_orderdate").cast("string"), "yyyyMMdd")
    return lineorder.withColumn("lo_orderdate", day)


def _between_days(df: DataFrame, first: str, after: str) -> DataFrame:
    kind = df.schema["lo_orderdate"].dataType
    day = F.col("lo_orderdate")
    return df.where((day >= F.lit(first).cast(kind)) & (day < F.lit(after).cast(kind)))


def discount_revenue():
    return F.col("lo_extendedprice") * F.col("lo_discount")


def one_dim(lineorder: DataFrame, year: int, low, high, quantity_below) -> DataFrame:
    """Revenue from discounts within a band, on small quantities, in one year."""
    rows = _between_days(lineorder, f"{year}-01-01", f"{year + 1}-01-01").where(
        F.col("lo_discount").between(low, high) & (F.col("lo_quantity") < quantity_below)
    )
    return rows.agg(F.sum(discount_revenue()).alias("revenue"))


def brands_of(part: DataFrame, category: str) -> DataFrame:
    return part.where(F.col("p_category") == category).select("p_partkey", "p_brand1")


def sellers_of(supplier: DataFrame, region: str) -> DataFrame:
    return supplier.where(F.col("s_region") == region).select("s_suppkey")


def in_cities(df: DataFrame, city: str, cities: Sequence[str], key: str) -> DataFrame:
    return df.where(F.col(city).isin(list(cities))).select(key, city)


def revenue_by_brand(rows: DataFrame) -> DataFrame:
    """Revenue by year and brand of lines that know their brand."""
    return rows.groupBy(F.year("lo_orderdate").alias("d_year"), "p_brand1").agg(
        F.sum("lo_revenue").alias("revenue")
    )


def revenue_by_cities(rows: DataFrame, first: str, after: str) -> DataFrame:
    """Revenue within some days of lines that know both cities, largest first per year."""
    return (
        _between_days(rows, first, after)
        .groupBy("c_city", "s_city", F.year("lo_orderdate").alias("d_year"))
        .agg(F.sum("lo_revenue").alias("revenue"))
        .orderBy(F.col("d_year").asc(), F.col("revenue").desc(), "c_city", "s_city")
    )


def two_dim(
    lineorder: DataFrame, part: DataFrame, supplier: DataFrame, category: str, region: str
) -> DataFrame:
    """Revenue by year and brand, for one product category and supplier region."""
    brands, suppliers = brands_of(part, category), sellers_of(supplier, region)
    rows = lineorder.join(
        suppliers, F.col("lo_suppkey") == F.col("s_suppkey"), "left_semi"
    ).join(brands, F.col("lo_partkey") == F.col("p_partkey"))
    return revenue_by_brand(rows)


def drill(
    lineorder: DataFrame,
    customer: DataFrame,
    supplier: DataFrame,
    customer_cities: Sequence[str],
    supplier_cities: Sequence[str],
    first: str,
    after: str,
) -> DataFrame:
    """Revenue between cities within some days, largest first per year."""
    buyers = in_cities(customer, "c_city", customer_cities, "c_custkey")
    sellers = in_cities(supplier, "s_city", supplier_cities, "s_suppkey")
    rows = lineorder.join(sellers, F.col("lo_suppkey") == F.col("s_suppkey")).join(
        buyers, F.col("lo_custkey") == F.col("c_custkey")
    )
    return revenue_by_cities(rows, first, after)


def same_dist(lineorder: DataFrame, part: DataFrame) -> DataFrame:
    """Discount revenue per order day of lines with a known part.

    On tables bucketed by part the join needs no shuffle.
    """
    known = lineorder.join(part, F.col("lo_partkey") == F.col("p_partkey"), "left_semi")
    return known.groupBy("lo_orderdate").agg(F.sum(discount_revenue()).alias("revenue"))
