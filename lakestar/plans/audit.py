"""Checks on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakestar import schemas
from lakestar.operators import audit
from lakestar.operators.samples import sample_by, sample_rows
from lakestar.plans import tables as t
from lakestar.plans.registry import query
from lakestar.session import statistics_session

KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}
COLUMNS = {name: schemas.GIVEN[name].names for name in KEYS}
NUMBERS = {
    name: [f.name for f in schemas.GIVEN[name] if isinstance(f.dataType, NumericType)]
    for name in KEYS
}
#: Conditions that both engines read alike.
RULES = {
    "customer": {"customer_nation": "c_nationkey BETWEEN 0 AND 24"},
    "part": {"part_size": "p_size BETWEEN 1 AND 49", "part_price": "p_retailprice > 0"},
    "orders": {"order_status": "o_orderstatus IN ('F', 'O')", "order_total": "o_totalprice >= 0"},
    "lineitem": {
        "flag": "l_returnflag IN ('A', 'R')",
        "quantity": "l_quantity BETWEEN 1 AND 49",
        "year": "year(l_shipdate) BETWEEN 1901 AND 2155",
        "key": "l_orderkey IS NOT NULL",
    },
    "events": {"event_kind": "event_type IS NOT NULL", "event_value": "value >= 0"},
    "documents": {"document_length": "n_chars >= 0", "document_text": "text IS NOT NULL"},
    "labels": {"label_toxic": "toxic IN (0, 1)", "label_quality": "quality BETWEEN 0 AND 3"},
    "conversations": {"turn_number": "turn >= 0"},
}
LINKS = {
    "lineitem_orders": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "lineitem_part": ("lineitem", "l_partkey", "part", "p_partkey"),
    "lineitem_supplier": ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    "orders_customer": ("orders", "o_custkey", "customer", "c_custkey"),
    "customer_nation": ("customer", "c_nationkey", "nation", "n_nationkey"),
    "documents_labels": ("documents", "doc_id", "labels", "doc_id"),
}


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS num_rows, count(DISTINCT {key}) AS uniq_pk"
    f" FROM {name}" for name, key in KEYS.items()
))
def pk_audit(spark, sf):
    return audit.key_audit({name: (t.table(spark, sf, name), key) for name, key in KEYS.items()})


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name,"
    f" count(*) FILTER ({c} IS NULL) AS num_nulls FROM {name}"
    for name, columns in COLUMNS.items() for c in columns
))
def null_audit(spark, sf):
    spark = statistics_session(spark)
    return audit.null_audit(
        {name: t.table(spark, sf, name).select(*columns) for name, columns in COLUMNS.items()}
    )


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS link, count(*) AS orphans FROM {child}"
    f" WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})"
    for name, (child, key, parent, parent_key) in LINKS.items()
))
def fk_audit(spark, sf):
    """Rows pointing nowhere per link; documents without a label show a link that is not full."""
    return audit.reference_audit(
        {
            name: (t.table(spark, sf, child), key, t.table(spark, sf, parent), parent_key)
            for name, (child, key, parent, parent_key) in LINKS.items()
        }
    )


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{label}' AS rule,"
    f" count(*) FILTER (NOT ({rule})) AS violations FROM {name}"
    for name, rules in RULES.items() for label, rule in rules.items()
))
def domain_audit(spark, sf):
    return audit.each_table(
        {
            name: audit.domain_audit(
                t.table(spark, sf, name), {label: F.expr(rule) for label, rule in rules.items()}
            )
            for name, rules in RULES.items()
        }
    )


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, min({c})::DOUBLE AS min_value,"
    f" max({c})::DOUBLE AS max_value FROM {name}"
    for name, columns in NUMBERS.items() for c in columns
))
def min_max_profile(spark, sf):
    return audit.each_table(
        {name: audit.range_audit(t.table(spark, sf, name), c) for name, c in NUMBERS.items()}
    )


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, count({c})::DOUBLE AS count,"
    f" round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,"
    f" min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM {name}"
    for name, columns in NUMBERS.items() for c in columns
))
def describe_numeric(spark, sf):
    stats = audit.each_table(
        {name: audit.describe(t.table(spark, sf, name), c) for name, c in NUMBERS.items()}
    )
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query(" UNION ALL ".join(
    f"(SELECT '{name}' AS table_name, {key}::BIGINT AS row_key FROM {name} ORDER BY {key} LIMIT 5)"
    for name, key in KEYS.items()
))
def sample_keys(spark, sf):
    """Example records of every table: the five smallest keys."""
    frames = {
        name: t.table(spark, sf, name).select(F.col(key).cast("long").alias("row_key"))
        for name, key in KEYS.items()
    }
    return audit.each_table({n: df.orderBy("row_key").limit(5) for n, df in frames.items()})


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    ORDER BY md5('0|' || o_orderkey), o_orderkey LIMIT 5
""")
def sample_of_orders(spark, sf):
    """Five whole orders, the same ones in every run."""
    return sample_rows(t.table(spark, sf, "orders"), ["o_orderkey"], 5)


@query("""
    SELECT doc_id, text, lang, source, n_chars FROM documents
    ORDER BY md5('0|' || doc_id), doc_id LIMIT 5
""")
def sample_of_documents(spark, sf):
    """Five whole documents."""
    return sample_rows(t.table(spark, sf, "documents"), ["doc_id"], 5)


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('0|' || c_custkey), c_custkey) <= 3
""")
def sample_of_segments(spark, sf):
    """Three whole customers of every segment."""
    return sample_by(t.table(spark, sf, "customer"), ["c_mktsegment"], ["c_custkey"], 3)


@query("""
    SELECT event_id, ts, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('7|' || event_id), event_id) <= 4
""")
def sample_of_event_types(spark, sf):
    """Four whole events of every type."""
    events = t.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return sample_by(events, ["event_type"], ["event_id"], 4, seed=7)
