from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lakestar import schemas
from lakestar.operators import rental_reports as r
from lakestar.operators import rental_star as rs
from tests.conftest import rows

ROWS = {
    "country": [(1, "Canada")],
    "city": [(1, "Lethbridge", 1), (2, "Calgary", 1)],
    "address": [
        (1, "47 Drive", None, "Alberta", 1, "T1", "555"),
        (2, "28 Way", None, "Alberta", 2, None, "556"),
    ],
    "customer": [
        (1, 1, "MARY", "SMITH", "m@x", 1, True, date(2006, 2, 14), 1),
        (2, 1, "JO", "DOE", None, 2, False, date(2006, 2, 14), 0),
    ],
    "language": [(1, "English"), (2, "French")],
    "film": [
        (1, "ALPHA", "a", 2006, 1, 2, 3, D("2.99"), 90, D("20.00"), "PG", ["Trailers"]),
        (2, "BETA", "b", 2006, 1, None, 5, D("0.99"), 80, D("10.00"), "G", []),
        (3, "GAMMA", "c", 2006, 1, None, 5, D("0.99"), 80, D("10.00"), "G", []),
    ],
    "category": [(1, "Action"), (2, "Drama")],
    "film_category": [(1, 1), (2, 2)],
    "actor": [(1, "PENELOPE", "GUINESS"), (2, "NICK", "WAHLBERG"), (3, "NO", "FILMS")],
    "film_actor": [(1, 1), (2, 1), (1, 2), (1, 3)],
    "store": [(1, 1, 1)],
    "staff": [(1, "Mike", "Hillyer", 1, "x", 1, True, "Mike")],
    "inventory": [(1, 1, 1), (2, 1, 1), (3, 2, 1)],
    "rental": [
        # On time; late by 2.5 days; still out; after the balance date.
        (1, datetime(2005, 5, 1, 10), 1, 1, datetime(2005, 5, 3, 10), 1),
        (2, datetime(2005, 5, 10, 10), 1, 1, datetime(2005, 5, 15, 22), 1),
        (3, datetime(2005, 5, 20, 10), 3, 1, None, 1),
        (4, datetime(2005, 8, 1, 10), 1, 1, datetime(2005, 8, 30, 10), 1),
    ],
    "payment": [
        (1, 1, 1, 1, D("2.99"), datetime(2005, 5, 1, 11)),
        (2, 1, 1, 2, D("3.50"), datetime(2005, 5, 31, 23, 59)),
        (3, 1, 1, 4, D("9.99"), datetime(2005, 8, 1, 12)),
    ],
}


@pytest.fixture(scope="module")
def t(spark):
    return {
        name: spark.createDataFrame(data, schemas.RENTAL[name]) for name, data in ROWS.items()
    }


def place(t):
    return t["address"], t["city"], t["country"]


def at(text):
    return F.lit(text).cast("timestamp")


def test_stock(t):
    assert rows(r.in_stock(t["inventory"], t["rental"]), "inventory_id") == [(1,), (2,)]
    assert rows(r.not_in_stock(t["inventory"], t["rental"]), "inventory_id") == [(3,)]
    assert rows(r.item_holders(t["rental"])) == [(3, 1)]


def test_stock_in_sql(spark, t):
    from lakestar.functions.sql import register_stock_functions

    t["inventory"].createOrReplaceTempView("inventory")
    t["rental"].createOrReplaceTempView("rental")
    register_stock_functions(spark)
    assert rows(spark.sql("SELECT * FROM film_in_stock(1, 1)")) == [(1,), (2,)]
    assert rows(spark.sql("SELECT * FROM film_in_stock(2, 1)")) == []
    assert rows(spark.sql("SELECT * FROM film_not_in_stock(2, 1)")) == [(3,)]
    assert rows(spark.sql("SELECT * FROM item_held_by(3)")) == [(1,)]


def test_balance_counts_whole_late_days(t):
    charges = r.rental_charges(t["rental"], t["inventory"], t["film"])
    balance = r.customer_balance(t["customer"], charges, t["payment"], at("2005-06-30"))
    # 2.99 + 2.99 + 0.99, two late days, minus 6.49 paid. The second customer has nothing.
    assert rows(balance) == [(1, D("2.48")), (2, D("0.00"))]
    later = r.customer_balance(t["customer"], charges, t["payment"], at("2005-12-31"))
    with_cost = r.customer_balance(t["customer"], charges, t["payment"], at("2005-12-31"), True)
    # 26 days late is more than twice the duration.
    assert rows(with_cost)[0][1] - rows(later)[0][1] == D("20.00")


def test_rewards(t):
    found = r.rewards_report(t["customer"], t["payment"], 1, D("6.00"), F.lit(date(2005, 8, 20)))
    assert rows(found, "customer_id") == [(1,)]
    none = r.rewards_report(t["customer"], t["payment"], 2, D("6.00"), F.lit(date(2005, 8, 20)))
    assert none.count() == 0
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            r.rewards_report(t["customer"], t["payment"], *bad, F.lit(date(2005, 8, 20)))


def test_lists(t):
    assert rows(r.customer_list(t["customer"], *place(t)), "name", "zip_code", "notes") == [
        ("JO DOE", None, ""),
        ("MARY SMITH", "T1", "active"),
    ]
    assert rows(r.staff_list(t["staff"].drop("email", "active"), *place(t)), "name", "city") == [
        ("Mike Hillyer", "Lethbridge")
    ]
    tables = (t["film"], t["film_category"], t["category"], t["film_actor"], t["actor"])
    # Film 3 has no category and is left out.
    assert rows(r.film_list(*tables), "title", "category", "actors") == [
        ("ALPHA", "Action", "NICK WAHLBERG, PENELOPE GUINESS"),
        ("BETA", "Drama", "PENELOPE GUINESS"),
    ]
    assert rows(r.film_list(*tables, nice_names=True), "actors")[0] == (
        "NickWahlberg, PenelopeGuiness",
    )
    info = r.actor_info(
        t["actor"], t["film_actor"], t["film"], t["film_category"], t["category"]
    )
    assert rows(info, "actor_id", "film_info") == [
        (1, "Action: ALPHA, Drama: BETA"),
        (2, "Action: ALPHA"),
        (3, None),
    ]


def test_sales(t):
    sales = rs.rental_sales(t["payment"], t["rental"], t["inventory"])
    assert rows(r.sales_by_category(sales, t["film_category"], t["category"])) == [
        ("Action", D("16.48"))
    ]
    staff = t["staff"].select("staff_id", "first_name", "last_name")
    by_store = r.sales_by_store(sales, t["store"], staff, *place(t))
    assert rows(by_store) == [(1, "Lethbridge,Canada", "Mike Hillyer", D("16.48"))]


def test_star(t):
    tables = dict(t, staff=t["staff"].select("staff_id", "first_name", "last_name"))
    star = rs.build_rental_star(tables, F.lit(date(2020, 1, 1)))
    for name, df in star.items():
        assert df.schema.names == schemas.RENTAL_STAR[name].names, name
    assert rows(star["dimDate"], "date_key", "week", "is_weekend") == [
        (20050501, 17, True),
        (20050531, 22, False),
        (20050801, 31, False),
    ]
    assert rows(star["dimMovie"], "film_id", "language", "original_language") == [
        (1, "English", "French"),
        (2, "English", None),
        (3, "English", None),
    ]
    assert rows(star["dimStore"], "store_key", "manager_first_name", "country") == [
        (1, "Mike", "Canada")
    ]
    assert rows(star["factSales"], "sales_key", "date_key", "movie_key", "sales_amount") == [
        (0, 20050501, 1, D("2.99")),
        (1, 20050531, 1, D("3.50")),
        (2, 20050801, 1, D("9.99")),
    ]
    assert star["dimCustomer"].count() == 2
