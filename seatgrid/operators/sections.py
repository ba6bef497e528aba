"""Inventory snapshots and their per-section rows.

A snapshot row carries all sections of an event at one instant. Joins are cheaper on snapshots than on the
rows flattened out of them, so jobs join first and call :func:`flatten_sections` last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SECTION_COLUMNS = {
    "sectionId": "sectionId",
    "averageTicketPrice": "averageTicketPrice",
    "minTicketPrice": "minSectionTicketPrice",
    "totalListings": "totalSectionListings",
    "totalTickets": "totalSectionTickets",
}


def snapshot_rows(inventory: DataFrame) -> DataFrame:
    """Inventory with output names, sections still nested."""
    return inventory.select(
        F.col("current_timestamp").alias("timestamp"),
        "eventId",
        F.col("totalListings").alias("totalStadiumListings"),
        F.col("totalTickets").alias("totalStadiumTickets"),
        "section_stats",
    )


def keep_section_fields(snapshots: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Only some fields of the nested sections, so that neither the scan nor a shuffle carries the others."""
    kept = F.arrays_zip(*[F.col(f"section_stats.{field}") for field in fields])
    return snapshots.withColumn("section_stats", kept)


def flatten_sections(
    snapshots: DataFrame, carry: Sequence[str] = (), fields: Sequence[str] = tuple(SECTION_COLUMNS)
) -> DataFrame:
    """One row per section, with the stadium totals and any ``carry`` columns repeated.

    A null or empty section list gives no row.
    """
    exploded = snapshots.select(
        "timestamp", "eventId", "totalStadiumListings", "totalStadiumTickets", *carry,
        F.explode("section_stats").alias("section"),
    )
    return exploded.select(
        "timestamp", "eventId",
        *[F.col(f"section.{field}").alias(SECTION_COLUMNS[field]) for field in fields],
        "totalStadiumListings", "totalStadiumTickets", *carry,
    )


def explode_sections(inventory: DataFrame) -> DataFrame:
    """Inventory to one row per section."""
    return flatten_sections(snapshot_rows(inventory))
