"""Reports of the rental business."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions import calendar
from lakestar.functions.text import capitalized, full_name, group_concat, paged_concat
from lakestar.operators.rental_star import with_place


def customer_list(
    customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame
) -> DataFrame:
    """Customers flat, with name, place and an activity note."""
    return with_place(customer, address, city, country).select(
        F.col("customer_id").alias("id"),
        full_name("first_name", "last_name").alias("name"),
        "address",
        F.col("postal_code").alias("zip_code"),
        "phone",
        "city",
        "country",
        F.when(F.col("activebool"), "active").otherwise("").alias("notes"),
        F.col("store_id").alias("sid"),
    )


def staff_list(
    staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame
) -> DataFrame:
    """Staff flat, with name and place."""
    return with_place(staff, address, city, country).select(
        F.col("staff_id").alias("id"),
        full_name("first_name", "last_name").alias("name"),
        "address",
        F.col("postal_code").alias("zip_code"),
        "phone",
        "city",
        "country",
        F.col("store_id").alias("sid"),
    )


def _named(category: DataFrame, name: str) -> DataFrame:
    """Category names by id. Few categories share all films, so they should not be a join key
    that rows are shuffled by."""
    return category.select("category_id", F.col("name").alias(name))


def film_list(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    film_actor: DataFrame,
    actor: DataFrame,
    nice_names: bool = False,
) -> DataFrame:
    """Films with their actors as one text. Films without a category or an actor are left out.

    `nice_names` writes `JohnSmith`, with capitals, instead of `JOHN SMITH`.
    """
    name = (
        F.concat(capitalized("first_name"), capitalized("last_name"))
        if nice_names
        else full_name("first_name", "last_name")
    )
    names = actor.select("actor_id", name.alias("_name"))
    cast = film_actor.join(names, "actor_id")
    actors = group_concat(cast, ["film_id"], "_name", "actors")
    categories = film_category.join(_named(category, "category"), "category_id")
    return (
        film.join(categories, "film_id")
        .join(actors, "film_id")
        .select(
            F.col("film_id").alias("fid"),
            "title",
            "description",
            "category",
            F.col("rental_rate").alias("price"),
            "length",
            "rating",
            "actors",
        )
    )


def actor_info_pages(
    actor: DataFrame, roles: DataFrame, page_chars: int = 1 << 16
) -> DataFrame:
    """Actors with the titles of each category as pages of text, for actors with any number of films.

    `roles` has `actor_id`, `category` and `title`; a title counts once.
    """
    pages = paged_concat(roles, ["actor_id", "category"], "title", "titles", True, page_chars=page_chars)
    named = actor.select("actor_id", "first_name", "last_name")
    return named.join(pages, "actor_id")


def actor_info(
    actor: DataFrame,
    film_actor: DataFrame,
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
) -> DataFrame:
    """Actors with `category: title, title` texts; null for an actor without films."""
    categories = film_category.join(_named(category, "_category"), "category_id")
    titled = film.select("film_id", "title").join(categories, "film_id")
    roles = film_actor.join(titled, "film_id")
    titles = group_concat(roles, ["actor_id", "_category"], "title", "_titles")
    lines = titles.withColumn("_line", F.concat("_category", F.lit(": "), "_titles"))
    info = group_concat(lines, ["actor_id"], "_line", "film_info")
    return actor.select("actor_id", "first_name", "last_name").join(info, "actor_id", "left")


def out_items(rental: DataFrame) -> DataFrame:
    """Items that are out: one row per item with an open rental."""
    return rental.where(F.col("return_date").isNull()).select("inventory_id").distinct()


def in_stock(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Items never rented or with every rental returned."""
    return inventory.join(out_items(rental), "inventory_id", "left_anti")


def not_in_stock(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    return inventory.join(out_items(rental), "inventory_id", "left_semi")


def item_holders(rental: DataFrame) -> DataFrame:
    """Who holds each item that is out."""
    held = rental.where(F.col("return_date").isNull())
    return held.select("inventory_id", "customer_id").distinct()


def rental_charges(rental: DataFrame, inventory: DataFrame, film: DataFrame) -> DataFrame:
    """Rentals with the terms of their film."""
    terms = film.select("film_id", "rental_rate", "rental_duration", "replacement_cost")
    return (
        rental.join(inventory.select("inventory_id", "film_id"), "inventory_id")
        .join(terms, "film_id")
        .select(
            "customer_id",
            "rental_date",
            "return_date",
            "rental_rate",
            "rental_duration",
            "replacement_cost",
        )
    )


def customer_balance(
    customer: DataFrame,
    charges: DataFrame,
    payment: DataFrame,
    as_of: Column,
    charge_replacement: bool = False,
    late_fee: int = 1,
) -> DataFrame:
    """What every customer owes at `as_of`: rates, plus `late_fee` per late day, minus payments.

    All customers in one pass each over rentals and payments. With `charge_replacement`, a film
    overdue by more than twice its duration also costs its replacement.
    """
    late = calendar.late_days(
        F.col("rental_date"), F.col("return_date"), F.col("rental_duration")
    )
    cost = F.sum("rental_rate") + F.sum(late * F.lit(late_fee))
    if charge_replacement:
        lost = late > F.col("rental_duration") * 2
        cost = cost + F.sum(F.when(lost, F.col("replacement_cost")).otherwise(F.lit(0)))
    owed = (
        charges.where(F.col("rental_date") <= as_of)
        .groupBy("customer_id")
        .agg(cost.alias("_owed"))
    )
    paid = (
        payment.where(F.col("payment_date") <= as_of)
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("_paid"))
    )
    balance = F.coalesce("_owed", F.lit(0)) - F.coalesce("_paid", F.lit(0))
    return (
        customer.select("customer_id")
        .join(owed, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select("customer_id", balance.alias("balance"))
    )


def rewards_report(
    customer: DataFrame, payment: DataFrame, min_purchases: int, min_amount, as_of: Column
) -> DataFrame:
    """Customers with more than `min_purchases` payments and more than `min_amount` paid in the
    month three months before `as_of`."""
    if min_purchases <= 0:
        raise ValueError("min_purchases must be above 0")
    if min_amount <= 0:
        raise ValueError("min_amount must be above 0")
    start, end = calendar.months_back(as_of, 3)
    in_month = (F.col("payment_date") >= start) & (F.col("payment_date") < F.date_add(end, 1))
    winners = (
        payment.where(in_month)
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("_amount"), F.count("*").alias("_n"))
        .where((F.col("_amount") > min_amount) & (F.col("_n") > min_purchases))
    )
    return customer.join(winners, "customer_id", "left_semi")


def sales_by_category(
    sales: DataFrame, film_category: DataFrame, category: DataFrame
) -> DataFrame:
    """Sales per category. Sales are summed per film first, so a best-seller joins as one row."""
    per_film = sales.groupBy("film_id").agg(F.sum("amount").alias("_amount"))
    categories = film_category.join(_named(category, "category"), "category_id")
    named = per_film.join(categories, "film_id")
    return named.groupBy("category").agg(F.sum("_amount").alias("total_sales"))


def sales_by_store(
    sales: DataFrame,
    store: DataFrame,
    staff: DataFrame,
    address: DataFrame,
    city: DataFrame,
    country: DataFrame,
) -> DataFrame:
    """Sales per store, with place and manager. Sales are summed per store before the joins."""
    per_store = sales.groupBy("store_id").agg(F.sum("amount").alias("total_sales"))
    manager = staff.select(
        F.col("staff_id").alias("manager_staff_id"),
        full_name("first_name", "last_name").alias("manager"),
    )
    placed = with_place(
        per_store.join(store, "store_id").join(manager, "manager_staff_id"), address, city, country
    )
    return placed.select(
        "store_id",
        F.concat("city", F.lit(","), "country").alias("store"),
        "manager",
        "total_sales",
    )
