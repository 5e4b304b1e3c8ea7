"""Declared schemas. Production reads never infer."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<float>": T.ArrayType(T.FloatType()),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(fields: str) -> T.StructType:
    """Fields written as `name type, name type`. Needs no running session, unlike a DDL text."""

    def data_type(text: str) -> T.DataType:
        if text.startswith("decimal"):
            return T.DecimalType(*map(int, text[8:-1].split(",")))
        return _TYPES[text]

    pairs = (field.split() for field in fields.split(", "))
    return T.StructType([T.StructField(name, data_type(kind)) for name, kind in pairs])


# --- event domain, raw -------------------------------------------------------------------------

SONGS_RAW = _schema(
    "num_songs int, artist_id string, artist_latitude decimal(10,6),"
    " artist_longitude decimal(10,6), artist_location string, artist_name string,"
    " song_id string, title string, duration decimal(10,5), year int"
)

LOG_RAW = _schema(
    "artist string, auth string, firstName string, gender string, itemInSession int,"
    " lastName string, length decimal(10,5), level string, location string, method string,"
    " page string, registration double, sessionId int, song string, status int, ts bigint,"
    " userAgent string, userId string"
)

EVENT_CSV = _schema(
    "artist string, auth string, firstName string, gender string, itemInSession int,"
    " lastName string, length double, level string, location string, method string, page string,"
    " registration string, sessionId int, song string, status int, ts string, userId int"
)

# --- event domain, star ------------------------------------------------------------------------

SONGPLAYS = _schema(
    "songplay_id bigint, start_time timestamp, user_id bigint, level string, song_id string,"
    " artist_id string, session_id int, location string, user_agent string"
)
USERS = _schema("user_id bigint, first_name string, last_name string, gender string, level string")
SONGS = _schema("song_id string, title string, artist_id string, year int, duration decimal(10,5)")
ARTISTS = _schema(
    "artist_id string, name string, location string, latitude decimal(10,6),"
    " longitude decimal(10,6)"
)
TIME = _schema(
    "start_time timestamp, hour int, day int, week int, month int, year int, weekday int"
)

# The user table kept by the stream, with the order of its last event.
LEVELS = _schema(
    "userId bigint, firstName string, lastName string, gender string, level string, ts bigint,"
    " sessionId int, itemInSession int"
)

EVENT_STAR = {
    "songplays": SONGPLAYS,
    "users": USERS,
    "songs": SONGS,
    "artists": ARTISTS,
    "time": TIME,
}

# --- rental domain, operational ----------------------------------------------------------------

RENTAL = {
    "customer": _schema(
        "customer_id int, store_id smallint, first_name string, last_name string, email string,"
        " address_id int, activebool boolean, create_date date, active int"
    ),
    "film": _schema(
        "film_id int, title string, description string, release_year int, language_id int,"
        " original_language_id int, rental_duration int, rental_rate decimal(4,2), length int,"
        " replacement_cost decimal(5,2), rating string, special_features array<string>"
    ),
    "inventory": _schema("inventory_id int, film_id int, store_id smallint"),
    "rental": _schema(
        "rental_id int, rental_date timestamp, inventory_id int, customer_id int,"
        " return_date timestamp, staff_id int"
    ),
    "payment": _schema(
        "payment_id int, customer_id int, staff_id int, rental_id int, amount decimal(5,2),"
        " payment_date timestamp"
    ),
    "address": _schema(
        "address_id int, address string, address2 string, district string, city_id int,"
        " postal_code string, phone string"
    ),
    "city": _schema("city_id int, city string, country_id int"),
    "country": _schema("country_id int, country string"),
    "language": _schema("language_id int, name string"),
    "store": _schema("store_id smallint, manager_staff_id int, address_id int"),
    "staff": _schema(
        "staff_id int, first_name string, last_name string, address_id int, email string,"
        " store_id smallint, active boolean, username string"
    ),
    "actor": _schema("actor_id int, first_name string, last_name string"),
    "category": _schema("category_id int, name string"),
    "film_actor": _schema("actor_id int, film_id int"),
    "film_category": _schema("film_id int, category_id int"),
}

# --- rental domain, star -----------------------------------------------------------------------

RENTAL_STAR = {
    "dimDate": _schema(
        "date_key int, date date, year int, quarter int, month int, day int, week int,"
        " is_weekend boolean"
    ),
    "dimCustomer": _schema(
        "customer_key int, customer_id int, first_name string, last_name string, email string,"
        " address string, address2 string, district string, city string, country string,"
        " postal_code string, phone string, active int, create_date date, start_date date,"
        " end_date date"
    ),
    "dimMovie": _schema(
        "movie_key int, film_id int, title string, description string, release_year int,"
        " language string, original_language string, rental_duration int, length int,"
        " rating string, special_features string"
    ),
    "dimStore": _schema(
        "store_key int, store_id smallint, address string, address2 string, district string,"
        " city string, country string, postal_code string, manager_first_name string,"
        " manager_last_name string, start_date date, end_date date"
    ),
    "factSales": _schema(
        "sales_key bigint, date_key int, customer_key int, movie_key int, store_key int,"
        " sales_amount decimal(5,2)"
    ),
}

# --- star benchmark ----------------------------------------------------------------------------

STAR_BENCHMARK = {
    "lineorder": _schema(
        "lo_orderkey int, lo_linenumber int, lo_custkey int, lo_partkey int, lo_suppkey int,"
        " lo_orderdate int, lo_orderpriority string, lo_shippriority string, lo_quantity int,"
        " lo_extendedprice int, lo_ordertotalprice int, lo_discount int, lo_revenue int,"
        " lo_supplycost int, lo_tax int, lo_commitdate int, lo_shipmode string"
    ),
    "part": _schema(
        "p_partkey int, p_name string, p_mfgr string, p_category string, p_brand1 string,"
        " p_color string, p_type string, p_size int, p_container string"
    ),
    "supplier": _schema(
        "s_suppkey int, s_name string, s_address string, s_city string, s_nation string,"
        " s_region string, s_phone string"
    ),
    "customer": _schema(
        "c_custkey int, c_name string, c_address string, c_city string, c_nation string,"
        " c_region string, c_phone string, c_mktsegment string"
    ),
    "dwdate": _schema(
        "d_datekey int, d_date string, d_dayofweek string, d_month string, d_year int,"
        " d_yearmonthnum int, d_yearmonth string, d_daynuminweek int, d_daynuminmonth int,"
        " d_daynuminyear int, d_monthnuminyear int, d_weeknuminyear int, d_sellingseason string,"
        " d_lastdayinweekfl string, d_lastdayinmonthfl string, d_holidayfl string,"
        " d_weekdayfl string"
    ),
}

# --- single tables -----------------------------------------------------------------------------

REVIEWS = _schema(
    "customer_id string, review_date date, review_rating int, review_votes int,"
    " review_helpful_votes int, product_id string, product_title string,"
    " product_sales_rank bigint, product_group string, product_category string,"
    " product_subcategory string, similar_product_ids string"
)
TICKETS = _schema(
    "id double, sporting_event_id double, sport_location_id double, seat_level decimal(1,0),"
    " seat_section string, seat_row string, seat string, ticketholder_id double,"
    " ticket_price decimal(8,2)"
)

# --- the given tables --------------------------------------------------------------------------

GIVEN = {
    "region": _schema("r_regionkey int, r_name string"),
    "nation": _schema("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _schema(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": _schema("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _schema(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": _schema(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _schema(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": _schema(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
    "documents": _schema(
        "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ),
    "embeddings": _schema("vec_id bigint, embedding array<float>, label int"),
    "pages": _schema("page_id bigint, url string, html string"),
    "benchmark": _schema("item_id bigint, text string"),
    "labels": _schema("doc_id bigint, quality int, toxic int"),
    "conversations": _schema("conv_id bigint, turn bigint, role string, text string"),
}
