"""What users do: counts, phases between marked events, things not done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.operators.keyed import latest_by
from lakestar.operators.ordering import running_sum


def count_by_hour(events: DataFrame, time: str, name: str = "plays") -> DataFrame:
    """Events per hour of day."""
    return events.groupBy(F.hour(time).alias("hour")).agg(F.count("*").alias(name))


def top_value(events: DataFrame, column: str, name: str = "plays", n: int = 1) -> DataFrame:
    """The most frequent values; nulls are not counted, equal counts go by value."""
    counts = events.groupBy(column).agg(F.count(column).alias(name))
    return counts.orderBy(F.col(name).desc(), column).limit(n)


def count_users(events: DataFrame, user: str, name: str = "users") -> DataFrame:
    """Number of different users."""
    return events.agg(F.count_distinct(user).alias(name))


def never_seen(everything: DataFrame, seen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Different values of `columns` that occur in `everything` but not in `seen`."""
    values = everything.select(*columns).distinct()
    return values.join(seen.select(*columns).distinct(), list(columns), "left_anti")


def mark(events: DataFrame, condition: Column, name: str) -> DataFrame:
    """A 0/1 column telling the rows that meet `condition`."""
    return events.withColumn(name, F.when(condition, 1).otherwise(0))


def with_phase(
    events: DataFrame,
    user: str,
    order: Sequence[str],
    is_boundary: Column,
    name: str = "phase",
    peers: bool = False,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Numbers the stretches of each user's events between boundary events.

    Counted from the latest event back (give `order` descending), so 0 is the stretch after the
    last boundary. `peers=True` gives events at one time the same phase; else `ties` settle which
    of them comes first, by default all other columns.
    """
    marked = mark(events, is_boundary, "_boundary")
    summed = running_sum(marked, [user], order, "_boundary", name, peers, ties)
    return summed.drop("_boundary")


def average_between(
    events: DataFrame,
    user: str,
    order: Sequence[str],
    is_boundary: Column,
    is_counted: Column,
    name: str,
) -> DataFrame:
    """Average number of counted events per user and stretch that has any."""
    # Only what the count needs: one row per event with its two marks.
    marks = [is_boundary.alias("_is_boundary"), is_counted.alias("_is_counted")]
    plain = [c.removeprefix("-") for c in order]
    wanted = events.where(is_boundary | is_counted).select(user, *plain, *marks)
    phases = with_phase(
        wanted, user, order, F.col("_is_boundary"), "_phase"
    )
    counted = phases.where("_is_counted")
    counts = counted.groupBy(user, "_phase").agg(F.count("*").alias("_n"))
    return counts.agg((F.sum("_n") / F.count("*")).alias(name))


def latest_level(
    events: DataFrame, user: str, level: str, order: Sequence[str]
) -> DataFrame:
    """The level of each user's last event."""
    return latest_by(events.select(user, level, *order), [user], order).select(user, level)


def level_changers(events: DataFrame, user: str, level: str) -> DataFrame:
    """Users seen with more than one level."""
    pairs = events.select(user, level).distinct()
    return pairs.groupBy(user).agg(F.count("*").alias("levels")).where(F.col("levels") > 1)


def level_history(events: DataFrame, user: str, level: str, time: str) -> DataFrame:
    """The levels of level changers by day."""
    days = events.select(user, level, F.to_date(time).alias("day")).distinct()
    return days.join(level_changers(events, user, level), user, "left_semi")


def level_changers_now(
    events: DataFrame, user: str, level: str, order: Sequence[str]
) -> DataFrame:
    """The current level of level changers."""
    current = latest_level(events, user, level, order)
    return current.join(level_changers(events, user, level), user, "left_semi")
