"""The sales star out of the rental tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions import calendar
from lakestar.operators.ordering import add_row_numbers


def dim_date(events: DataFrame, column: str) -> DataFrame:
    """One row per day on which something happened."""
    days = events.select(F.to_date(column).alias("date")).dropna().distinct()
    day = F.col("date")
    return days.select(calendar.date_key(day).alias("date_key"), "date", *calendar.date_parts(day))


def with_place(
    df: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame
) -> DataFrame:
    """`df` with its address, city and country.

    The places are put together first, so `df` is joined once, by address, and never by a city or
    country that very many rows may share.
    """
    places = address.join(city.join(country, "country_id"), "city_id")
    return df.join(places, "address_id")


def dim_customer(
    customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame, as_of: Column
) -> DataFrame:
    """Customers with their place. The validity dates are both `as_of`."""
    placed = with_place(customer, address, city, country)
    return placed.select(
        F.col("customer_id").alias("customer_key"),
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "address",
        "address2",
        "district",
        "city",
        "country",
        "postal_code",
        "phone",
        "active",
        "create_date",
        as_of.alias("start_date"),
        as_of.alias("end_date"),
    )


def dim_movie(film: DataFrame, language: DataFrame) -> DataFrame:
    """Films with the names of their language and, if known, original language."""
    names = language.select("language_id", "name")
    spoken = names.select("language_id", F.col("name").alias("language"))
    original = names.select(
        F.col("language_id").alias("original_language_id"),
        F.col("name").alias("original_language"),
    )
    named = film.join(spoken, "language_id").join(original, "original_language_id", "left")
    return named.select(
        F.col("film_id").alias("movie_key"),
        "film_id",
        "title",
        "description",
        "release_year",
        "language",
        "original_language",
        "rental_duration",
        "length",
        "rating",
        "special_features",
    )


def dim_store(
    store: DataFrame,
    staff: DataFrame,
    address: DataFrame,
    city: DataFrame,
    country: DataFrame,
    as_of: Column,
) -> DataFrame:
    """Stores with their place and manager."""
    managers = staff.select(
        F.col("staff_id").alias("manager_staff_id"),
        F.col("first_name").alias("manager_first_name"),
        F.col("last_name").alias("manager_last_name"),
    )
    placed = with_place(store.join(managers, "manager_staff_id"), address, city, country)
    return placed.select(
        F.col("store_id").alias("store_key"),
        "store_id",
        "address",
        "address2",
        "district",
        "city",
        "country",
        "postal_code",
        "manager_first_name",
        "manager_last_name",
        as_of.alias("start_date"),
        as_of.alias("end_date"),
    )


def rental_sales(payment: DataFrame, rental: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per payment: when, who, which film, which store, how much."""
    return (
        payment.select("rental_id", "customer_id", "payment_date", "amount")
        .join(rental.select("rental_id", "inventory_id"), "rental_id")
        .join(inventory, "inventory_id")
        .select("payment_date", "customer_id", "film_id", "store_id", "amount")
    )


def fact_sales(sales: DataFrame, *more: str) -> DataFrame:
    """The sales fact, keyed for the star, and `more` columns; see `number_sales` for a sales key."""
    return sales.select(
        calendar.date_key(F.col("payment_date")).alias("date_key"),
        F.col("customer_id").alias("customer_key"),
        F.col("film_id").alias("movie_key"),
        F.col("store_id").alias("store_key"),
        F.col("amount").alias("sales_amount"),
        *more,
    )


def number_sales(fact: DataFrame, start: int = 0, row_key: str | None = None) -> DataFrame:
    """The sales fact with a gapless `sales_key`, in key order, then by amount.

    With `row_key`, a column that differs from row to row, sales move once to get their number; without
    it equal sales are counted first.
    """
    order: Sequence[str] = ["date_key", "customer_key", "movie_key", "store_key"]
    if row_key is None:
        return add_row_numbers(fact, order, "sales_key", start)
    return add_row_numbers(fact, order, "sales_key", start, ["sales_amount", row_key]).drop(row_key)


def build_rental_star(tables: Mapping[str, DataFrame], as_of: Column) -> dict[str, DataFrame]:
    """All dimensions and the fact from the operational tables."""
    place = (tables["address"], tables["city"], tables["country"])
    sales = rental_sales(tables["payment"], tables["rental"], tables["inventory"])
    return {
        "dimDate": dim_date(tables["payment"], "payment_date"),
        "dimCustomer": dim_customer(tables["customer"], *place, as_of),
        "dimMovie": dim_movie(tables["film"], tables["language"]),
        "dimStore": dim_store(tables["store"], tables["staff"], *place, as_of),
        "factSales": number_sales(fact_sales(sales)),
    }
