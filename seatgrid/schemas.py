"""Declared schemas of the three input collections, as DDL text.

Declaring them removes the inference pass over the data and makes the corrupt-line column exist whether
or not a bad line was seen.
"""

from __future__ import annotations

CORRUPT = "_corrupt_record"

SECTION_STATS = (
    "array<struct<sectionId:bigint,averageTicketPrice:double,minTicketPrice:double,"
    "totalListings:bigint,totalTickets:bigint>>"
)

PERFORMERS = "array<struct<id:bigint,name:string,role:string>>"

EVENTS = (
    "array<struct<id:bigint,eventDateUTC:string,eventDateLocal:string,originalName:string,"
    f"performersCollection:{PERFORMERS},performers:array<struct<id:bigint,name:string>>,"
    "groupingsCollection:array<struct<id:bigint>>>>"
)

INVENTORY = (
    "current_timestamp bigint, eventId bigint, totalListings bigint, totalTickets bigint, "
    f"section_stats {SECTION_STATS}, {CORRUPT} string"
)

META = f"current_timestamp bigint, current_date string, events {EVENTS}, {CORRUPT} string"


def performance_schema(extra: str = "") -> str:
    """``team`` and ``current_timestamp`` plus the pass-through columns named in ``extra`` (DDL)."""
    between = f", {extra}" if extra else ""
    return f"team string, current_timestamp bigint{between}, {CORRUPT} string"
