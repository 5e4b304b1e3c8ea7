"""Row numbers and running sums over a whole table, without a one-task sort.

Both rest on the same step. Bounds that cut the full sort order into parts of about equal size are taken
from a sample as plain values, so the part of a row is a function of the row. The rows are shuffled once,
by part; what the parts before a row add up to is a small table, one row per part, from a second look at
the few columns that it needs. No job runs while a plan is built, nothing is checkpointed, and a task
that runs again after a lost executor finds the same parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts per shuffle partition, and sampled rows per part.
PARTS, SAMPLED = 2, 20
# Copies of one row written out from one list.
BLOCK = 100_000
#: Hashes are compared as fractions of this.
RANGE = 1 << 30


def _split(order: Sequence[str]) -> list[tuple[str, bool]]:
    """Column names, and whether they descend: a leading minus means so."""
    return [(c.removeprefix("-"), c.startswith("-")) for c in order]


def _sort(order: Sequence[str]) -> list[Column]:
    """Sort columns: nulls first, or last where the order descends."""
    return [F.desc(c) if down else F.asc(c) for c, down in _split(order)]


def _plain(order: Sequence[str]) -> list[str]:
    return [c for c, _ in _split(order)]


def _descending(value: Column, kind: T.DataType) -> list[Column]:
    """Values that ascend, nulls last, where `value` descends."""
    if isinstance(kind, T.IntegralType):
        turned = F.bitwise_not(value)
    elif isinstance(kind, T.BooleanType):
        turned = ~value
    elif isinstance(kind, T.DateType):
        turned = -F.unix_date(value)
    elif isinstance(kind, T.TimestampType):
        turned = -F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        turned = F.lit("1970-01-01").cast("timestamp_ntz") - value
    elif isinstance(kind, T.FractionalType):
        # Not a number is the largest number.
        first = F.when(F.isnan(value), 0).otherwise(1) if not isinstance(kind, T.DecimalType) else F.lit(1)
        return [value.isNull(), first, -value]
    elif isinstance(kind, T.StringType):
        # The complement of each half byte, and an end that is larger than all of them.
        turned = F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    else:
        raise TypeError(f"no descending order by {kind.simpleString()}")
    return [value.isNull(), turned]


def _key(df: DataFrame, order: Sequence[str]) -> Column:
    """The order columns as one value that ascends with the order."""
    schema, parts = df.schema, []
    for name, down in _split(order):
        parts += _descending(F.col(name), schema[name].dataType) if down else [F.col(name)]
    return F.struct(*(c.alias(f"c{i}") for i, c in enumerate(parts)))


def bounds(df: DataFrame, order: Sequence[str], parts: int) -> Column:
    """Up to `parts - 1` keys that cut `df` into parts of about equal size, as one array value: a scalar
    subquery, evaluated with the query that uses it.

    The sample is drawn by a hash of the order columns, so it is the same whenever it is drawn, and rows
    equal in them are drawn together and count once: name columns that tell most rows apart.
    """
    every = df.agg(F.count("*")).scalar()
    hashed = F.pmod(F.xxhash64(*_plain(order)), F.lit(RANGE))
    drawn = df.where(hashed * every <= F.lit(RANGE * SAMPLED * parts))
    sample = F.sort_array(F.collect_set(_key(df, order)))

    def cut(s: Column) -> Column:
        number = F.greatest(F.least(F.lit(parts), F.size(s)), F.lit(1))
        places = F.sequence(F.lit(1), F.greatest(number, F.lit(2)) - 1)
        return F.transform(places, lambda i: F.get(s, F.floor(i * F.size(s) / number).cast("int")))

    # One value of a list of one, so that the sample is sorted once.
    return drawn.agg(F.transform(F.array(sample), cut)[0]).scalar()


def with_rank(df: DataFrame, order: Sequence[str], cuts: Column, parts: int, name: str) -> DataFrame:
    """`df` with `name`, how many of up to `parts - 1` bounds a row has reached.

    A binary search with one projection for each step, which stay in generated code: as a lambda function it
    takes several times as long.
    """
    found = df.select("*", cuts.alias("_bounds"), _key(df, order).alias("_key"), F.lit(0).alias(name))
    for step in (1 << i for i in reversed(range(parts.bit_length()))):
        there = F.get("_bounds", F.col(name) + F.lit(step - 1)) <= F.col("_key")
        found = found.withColumn(name, F.when(there, F.col(name) + F.lit(step)).otherwise(F.col(name)))
    return found.drop("_bounds", "_key")


def with_part(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df` with `_part`, the number of a row's part; rows equal in `order` share a part."""
    parts = PARTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_rank(df, order, bounds(df, order, parts), parts, "_part")


def written_out(df: DataFrame, counts: str, copy: str) -> DataFrame:
    """Every row of `df` as often as its column `counts` says, with `copy` from 0.

    In two steps with a shuffle of the blocks between them, so that no list gets long and the copies of
    one row are written by many tasks.
    """
    last = F.col(counts) - 1
    starts = F.sequence(F.lit(0).cast("long"), last, F.lit(BLOCK).cast("long"))
    blocks = df.withColumn("_block", F.explode(starts))
    key = F.xxhash64(*df.columns, "_block")
    end = F.least(F.col("_block") + F.lit(BLOCK - 1), last)
    return blocks.repartition(key).withColumn(copy, F.explode(F.sequence(F.col("_block"), end))).drop("_block")


def add_row_numbers(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int = 1,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """A gapless key in the order of `order`, then `ties`, then the other columns (nulls first).

    `ties` should be short columns that, after `order`, tell most rows apart, such as a natural key or
    `source_row`: parts are cut by them, and rows move once. Without `ties`, rows may have any number of
    copies: equal rows are counted, their counts summed up, and the copies written out again; this groups
    by all columns, so it is for narrow rows.
    """
    columns = df.columns
    if ties is None:
        rest = [c for c in columns if c not in _plain(order)]
        counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
        summed = running_sum(counted, [], [*order, *rest], "_n", "_upto", ties=[])
        copies = written_out(summed, "_n", "_copy")
        number = F.col("_upto") - F.col("_n") + F.col("_copy") + F.lit(start)
        return copies.select(number.alias(name), *columns)
    full = [*order, *(c for c in ties if c not in _plain(order))]
    placed = with_part(df, full)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per part, whatever the size of the data: a window and a broadcast will do.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    settled = [*full, *(c for c in columns if c not in _plain(full) and _orderable(df, c))]
    position = F.row_number().over(Window.partitionBy("_part").orderBy(*_sort(settled)))
    numbered = placed.withColumn("_pos", position).join(F.broadcast(offsets), "_part")
    number = F.col("_off") + F.col("_pos") + F.lit(start - 1)
    return numbered.select(number.alias(name), *columns)


def _orderable(df: DataFrame, column: str) -> bool:
    """Maps and variants have no order."""
    kind = df.schema[column].dataType.simpleString()
    return "map<" not in kind and "variant" not in kind


def source_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """A table read from files, with the place of each row in them: a key that never changes."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return df.select("*", place.alias(name))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    peers: bool = False,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Sum of `value` per key from the first row in `order` up to the current one.

    `order` names columns, a leading minus means descending. `peers=False` is a ROWS frame, with
    rows equal in `order` taken by `ties` (by default all other columns); `peers=True` is a RANGE
    frame, where such rows share one result. Parts are cut by key and order, so no key is too large
    for a task, and there is one way whatever the size.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c not in _plain(order)]
    if not peers:
        return _spread_rows(df, keys, [*order, *ties], value, name)
    # One row per group of peers: the group may be large, its sum is not.
    groups = df.groupBy(*keys, *_plain(order)).agg(F.sum(value).alias("_sum"))
    totals = _spread_rows(groups, keys, order, "_sum", name).drop("_sum")
    on = [*keys, *_plain(order)]
    totals = totals.select(*(F.col(c).alias(f"_r_{c}") for c in on), name)
    return df.join(totals, _same(on)).select(*df.columns, name)


def _same(columns: Sequence[str]) -> Column:
    match = F.lit(True)
    for c in columns:
        match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return match


def _spread_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    full = [*keys, *order]
    placed = with_part(df, full)
    parts = placed.groupBy("_part", *keys).agg(F.sum(value).alias("_sum"))
    seen = Window.partitionBy(*keys).orderBy("_part")
    # A bound falls inside at most one key, so the carried sums are fewer than the parts and can be
    # broadcast.
    before = F.sum("_sum").over(seen.rowsBetween(Window.unboundedPreceding, -1))
    named = [F.col(c).alias(f"_r_{c}") for c in ("_part", *keys)]
    carried = parts.select(*named, F.row_number().over(seen).alias("_nth"), before.alias("_carry")).where("_nth > 1")
    local = Window.partitionBy("_part", *keys).orderBy(*_sort(order))
    inside = F.sum(value).over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = placed.withColumn("_inside", inside).join(F.broadcast(carried), _same(["_part", *keys]), "left")
    # Null until a value has been seen, as in a plain window.
    total = F.when(
        F.col("_inside").isNotNull() | F.col("_carry").isNotNull(),
        F.coalesce(F.col("_inside"), F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0)),
    )
    return summed.select(*df.columns, total.alias(name))
