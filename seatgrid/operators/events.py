"""Event metadata: first event of a record, team resolution, one row per event."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatgrid.functions.teams import away_found, away_pick, home_found, home_pick, team_id, team_name
from seatgrid.functions.times import game_time, iso_weekday
from seatgrid.operators.quality import Watched, watched_audit

TEAM_COLUMNS = ["Home_Team_Id", "Home_Team_Name", "Away_Team_Id", "Away_Team_Name"]


def first_event(meta: DataFrame) -> DataFrame:
    """Snapshot time and date plus the first event as a struct, null where there is none."""
    return meta.select(
        F.col("current_timestamp").alias("timestamp"), "current_date", F.get("events", F.lit(0)).alias("event")
    )


def event_dates(meta: DataFrame, event_key: str = "event") -> DataFrame:
    """``timestamp, id, event_date`` of each record's first event.

    ``event_key="grouping"`` takes the id of the event's first grouping instead of its own.
    """
    ids = {"event": F.col("event.id"), "grouping": F.get("event.groupingsCollection", F.lit(0))["id"]}
    return first_event(meta).select(
        "timestamp", ids[event_key].alias("id"), F.col("event.eventDateUTC").alias("event_date")
    )


def latest_event_date(meta: DataFrame, event_key: str = "event") -> DataFrame:
    """Text maximum of the event date per id."""
    return event_dates(meta, event_key).groupBy("id").agg(F.max("event_date").alias("event_date"))


def _performers_have_role(meta: DataFrame) -> bool:
    event = meta.schema["events"].dataType.elementType
    performer = event["performersCollection"].dataType.elementType
    return isinstance(performer, T.StructType) and "role" in performer.names


def home_away_teams(meta: DataFrame) -> DataFrame:
    """Each record's first event with its dates and resolved teams."""
    has_role = _performers_have_role(meta)
    collection = F.col("event.performersCollection")
    found = first_event(meta).select(
        "*",
        home_found(collection, has_role).alias("home_found"),
        away_found(collection, has_role).alias("away_found"),
    )
    picks = F.struct(
        home_pick(F.col("home_found"), F.col("event.performers")).alias("home"),
        away_pick(F.col("away_found"), collection, F.col("event.originalName")).alias("away"),
    )
    # A row of its own for the picks: a condition on team columns then reads them and does not work out the rules again.
    picked = found.select(
        "timestamp", "current_date", F.col("event.id").alias("id"),
        F.col("event.eventDateUTC").alias("event_date_utc"),
        F.col("event.eventDateLocal").alias("event_date_local"),
        F.inline(F.array(picks)),
    )
    home, away = F.col("home"), F.col("away")
    return picked.select(
        "timestamp", "current_date", "id", "event_date_utc", "event_date_local",
        team_id(home).alias("Home_Team_Id"), team_name(home).alias("Home_Team_Name"),
        team_id(away).alias("Away_Team_Id"), team_name(away).alias("Away_Team_Name"),
    )


def consolidate_events(resolved: DataFrame, require: Sequence[str] = (), audit: Watched | None = None) -> DataFrame:
    """One row per event: the maximum of each column by itself, team ids compared as text.

    The values of one row may come from different snapshots. Snapshots with a null in any of ``require`` do
    not count, as if dropped before; deciding that inside the aggregate keeps Spark from evaluating the team
    rules once more in a filter. ``audit`` (see :func:`team_audit`) watches the nulls of the snapshots, counted in the same aggregate.
    """
    kept = ["event_date_utc", "event_date_local", "Home_Team_Id", "Home_Team_Name", "Away_Team_Id"]
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in require], F.lit(True))
    merged = resolved.groupBy("id").agg(
        *[F.max(F.when(complete, F.col(name))).alias(name) for name in kept],
        F.count_if(complete).alias("_complete"),
        *[F.count_if(F.col(name).isNull()).alias(_nulls(name)) for name in TEAM_COLUMNS if audit is not None],
    )
    if audit is not None:
        merged = audit.over(merged)
    return merged.filter(F.col("_complete") > 0).drop("_complete", *map(_nulls, TEAM_COLUMNS))


def _nulls(name: str) -> str:
    return f"_{name}_nulls"


def team_audit() -> Watched:
    """The null audit of the team columns, to be gathered while the events are written."""
    return watched_audit(TEAM_COLUMNS, lambda name: F.col(_nulls(name)))


def add_calendar(events: DataFrame, strict: bool = False) -> DataFrame:
    """Weekday and time of day of the local event date."""
    local = F.col("event_date_local")
    return events.withColumns({"DayofWeek": iso_weekday(local, strict), "GameTime": game_time(local, strict)})


def resolve_events(meta: DataFrame, strict: bool = False, audit: Watched | None = None) -> DataFrame:
    """Metadata snapshots to one calendar-featured row per event with both team ids; ``audit`` as in :func:`consolidate_events`."""
    events = consolidate_events(home_away_teams(meta), ["Away_Team_Id", "Home_Team_Id"], audit)
    return add_calendar(events, strict)
