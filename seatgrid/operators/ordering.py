"""Time-to-event feature and the output orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatgrid.functions.times import time_to_event

LISTING_ORDER = ["eventId", "sectionId", "Time_to_event"]
CURVE_ORDER = ["eventId", "days_difference"]


def _descending(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(name).desc_nulls_last() for name in columns])


def order_listings(df: DataFrame) -> DataFrame:
    """By event, then section, then time to event, all descending: one sort on the whole key.

    The range partitioning uses the whole key too, so a hot event spreads over several tasks.
    """
    return _descending(df, LISTING_ORDER)


def range_snapshots(snapshots: DataFrame, hot: Sequence) -> DataFrame:
    """Timed snapshots in partitions that follow each other in listing order, their sections still nested.

    A snapshot is shuffled once, not once a section. An event lies whole in one partition; only the sections of the events ``hot``,
    which are known to hold many rows, go out one by one, on the whole key. Flatten the sections, then :func:`sort_ranges`.
    """
    ranges = [F.col("eventId")]
    if hot:
        is_hot = F.col("eventId").isin(*hot)
        single = F.transform("section_stats", lambda section: F.array(section))
        snapshots = snapshots.withColumn("section_stats", F.explode(F.when(is_hot, single).otherwise(F.array("section_stats"))))
        section = F.get("section_stats", F.lit(0))["sectionId"]
        ranges += [F.when(is_hot, key) for key in (section, F.col("Time_to_event"))]
    return snapshots.repartitionByRange(*[key.desc_nulls_last() for key in ranges])


def sort_ranges(df: DataFrame) -> DataFrame:
    """:func:`order_listings` of rows that :func:`range_snapshots` has laid out; nothing is shuffled."""
    return df.sortWithinPartitions(*[F.col(name).desc_nulls_last() for name in LISTING_ORDER])


def order_price_curve(df: DataFrame) -> DataFrame:
    """By event, then days to it, both descending."""
    return _descending(df, CURVE_ORDER)


def top_listings(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows in listing order, ties broken by the other columns; no full sort is made."""
    others = [F.col(name).desc_nulls_last() for name in df.columns if name not in LISTING_ORDER]
    return df.orderBy(*[F.col(name).desc_nulls_last() for name in LISTING_ORDER], *others).limit(n)


def with_time_to_event(joined: DataFrame, strict: bool = False) -> DataFrame:
    return joined.withColumn("Time_to_event", time_to_event("timestamp", "event_date_utc", strict))


def add_time_to_event(joined: DataFrame, strict: bool = False) -> DataFrame:
    """The feature, in listing order."""
    return order_listings(with_time_to_event(joined, strict))


def distinct_events(df: DataFrame) -> DataFrame:
    return df.select("eventId").distinct()
