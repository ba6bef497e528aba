"""Equivalent SQL for the catalog, stated flat on the order tables, for a second engine to check.

The shared clauses never build the nested values the queries read, so an error in an adapter or in an
operator shows up as a difference.
"""

from __future__ import annotations

INVENTORY_SQL = """
inv AS (
  SELECT CASE WHEN (l_orderkey + l_linenumber) % 50 <> 0
              THEN epoch_ms(l_shipdate + INTERVAL 7305 DAY) + l_linenumber * 3600000 + l_partkey % 1000 END AS ts,
         l_orderkey AS event_id, CAST(l_linenumber + 3 AS BIGINT) AS listings,
         CAST(l_quantity AS BIGINT) * 2 AS tickets, l_partkey % 20 AS kind,
         CAST(l_linenumber AS BIGINT) AS section_a, 10 + l_suppkey % 10 AS section_b,
         l_extendedprice / l_quantity AS price_a,
         l_extendedprice * (1 - l_discount) / l_quantity AS min_a,
         l_extendedprice * (1 + l_tax) / l_quantity AS price_b,
         CAST(l_quantity AS BIGINT) AS section_tickets
  FROM lineitem
),
all_sections AS (
  SELECT ts, event_id, section_a AS section_id, price_a AS price, min_a AS min_price,
         CAST(1 AS BIGINT) AS section_listings, section_tickets, listings, tickets
  FROM inv WHERE kind > 1
  UNION ALL
  SELECT ts, event_id, section_b, price_b, price_a, CAST(2 AS BIGINT), section_tickets, listings, tickets
  FROM inv WHERE kind > 1
),
sections AS (SELECT * FROM all_sections WHERE ts IS NOT NULL)"""

META_SQL = """
order_days AS (
  SELECT o_orderkey AS ok, k, o_orderdate + INTERVAL 7305 DAY AS day,
         (o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN k ELSE 0 END) % 25 AS h,
         ((o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN k ELSE 0 END) % 25 + 1 + o_orderkey % 24) % 25 AS a,
         o_orderkey % 41 <> 0 AND o_orderkey % 37 <> 0 AS has_event
  FROM orders CROSS JOIN (VALUES (0), (1)) AS snapshot(k)
),
flat AS (
  SELECT ok, has_event,
         CASE WHEN ok % 53 <> 0 OR k = 0 THEN epoch_ms(day) + k * 86400000 END AS ts,
         strftime(day, '%Y-%m-%d') AS snapshot_date,
         CASE WHEN has_event THEN CASE WHEN ok % 11 = 0 THEN -ok ELSE ok END END AS id,
         CASE WHEN has_event AND ok % 13 <> 0 THEN CASE WHEN ok % 11 = 0 THEN -ok ELSE ok END END AS grouping_id,
         h, a, replace(hn.n_name, '_', ' ') AS h_name, replace(an.n_name, '_', ' ') AS a_name,
         has_event AND ok % 31 <> 0 AND ok % 29 <> 0 AS has_roles,
         CASE WHEN NOT has_event THEN NULL WHEN ok % 47 = 0 THEN 'TBD' WHEN ok % 43 <> 0
              THEN strftime(day + to_days(k) + to_hours(ok % 24 + 5), '%Y-%m-%dT%H:%M:%S') || 'Z' END AS utc,
         CASE WHEN NOT has_event THEN NULL WHEN ok % 47 = 0 THEN 'TBD' WHEN ok % 43 <> 0
              THEN strftime(day + to_days(k) + to_hours(ok % 24), '%Y-%m-%dT%H:%M:%S') || '-0500' END AS local,
         CASE WHEN has_event THEN replace(an.n_name, '_', ' ') || ' Utd at ' || replace(hn.n_name, '_', ' ') END
           AS original_name,
         CASE WHEN NOT has_event THEN NULL
              WHEN ok % 31 = 0 OR (ok % 29 <> 0 AND ok % 5 = 0)
                THEN CASE WHEN ok % 10 = 0 THEN CAST(h AS VARCHAR) END
              WHEN ok % 29 <> 0 THEN CAST(h AS VARCHAR) END AS home_id,
         CASE WHEN NOT has_event THEN NULL
              WHEN ok % 31 = 0 OR (ok % 29 <> 0 AND ok % 5 = 0)
                THEN CASE WHEN ok % 10 = 0 THEN replace(hn.n_name, '_', '-') END
              WHEN ok % 29 <> 0 THEN replace(hn.n_name, '_', '-') END AS home_name,
         CASE WHEN NOT has_event OR ok % 31 = 0 OR ok % 29 = 0 THEN NULL
              WHEN ok % 5 = 0 AND ok % 3 = 0 THEN CAST(h AS VARCHAR)
              ELSE CAST(a AS VARCHAR) END AS away_id,
         CASE WHEN NOT has_event THEN NULL
              WHEN ok % 31 = 0 OR (ok % 29 <> 0 AND ok % 5 = 0) THEN replace(an.n_name, '_', '-') || '-Utd'
              WHEN ok % 29 <> 0 THEN replace(an.n_name, '_', '-') END AS away_name
  FROM order_days
  JOIN nation AS hn ON hn.n_nationkey = h
  JOIN nation AS an ON an.n_nationkey = a
),
timed AS (SELECT * FROM flat WHERE ts IS NOT NULL),
merged AS (
  SELECT id, max(utc) AS utc, max(local) AS local, max(home_id) AS home_id, max(home_name) AS home_name,
         max(away_id) AS away_id
  FROM timed WHERE home_id IS NOT NULL AND away_id IS NOT NULL GROUP BY id
),
featured AS (
  SELECT *, CAST(isodow(starts) AS VARCHAR) AS weekday,
         CASE WHEN hour(starts) < 14 THEN 'd' WHEN hour(starts) < 18 THEN 'a' WHEN starts IS NOT NULL THEN 'n' END AS game_time
  FROM (SELECT *, try_cast(substr(local, 1, 19) AS TIMESTAMP) AS starts FROM merged)
),
dates AS (SELECT id, max(utc) AS event_date FROM timed GROUP BY id),
grouping_dates AS (SELECT grouping_id AS id, max(utc) AS event_date FROM flat GROUP BY grouping_id)"""

PERFORMANCE_SQL = """
perf AS (
  SELECT CASE WHEN l_suppkey % 40 <> 0 THEN replace(n_name, '_', '-') END AS team,
         CASE WHEN (l_orderkey + l_linenumber) % 50 <> 0
              THEN epoch_ms(l_shipdate + INTERVAL 7305 DAY) + l_linenumber * 3600000 END AS ts,
         CAST(l_linenumber AS BIGINT) AS wins, l_extendedprice AS score
  FROM lineitem JOIN nation ON n_nationkey = l_suppkey % 25
),
perf_keyed AS (
  SELECT *, CASE WHEN ts IS NOT NULL THEN coalesce(team, 'None') || '#' || {day_ts} END AS team_day FROM perf
),
perf_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY team_day ORDER BY ts DESC NULLS LAST, team ASC NULLS FIRST,
                                                       wins ASC NULLS FIRST, score ASC NULLS FIRST) AS place
  FROM perf_keyed
),
team_days AS (SELECT team, ts, wins, score, team_day FROM perf_ranked WHERE place = 1)"""


def _utc_day(ms: str) -> str:
    at = f"make_timestamp(CAST(substr(CAST({ms} AS VARCHAR), 1, 10) AS BIGINT) * 1000000)"
    return f"year({at}) || '#' || month({at}) || '#' || day({at})"


PERFORMANCE_SQL = PERFORMANCE_SQL.replace("{day_ts}", _utc_day("ts"))


def _days(date: str, ms: str) -> str:
    return f"CAST(epoch_ms(try_cast(substr({date}, 1, 19) AS TIMESTAMP)) - {ms} AS DOUBLE) / 1000 / 60 / 60 / 24"


LISTINGS_SQL = f"""
dated AS (
  SELECT sections.*, event_date, {_days("event_date", "ts")} AS days
  FROM sections JOIN dates ON event_id = id
),
grouped AS (
  SELECT all_sections.*, event_date, {_days("event_date", "ts")} AS days
  FROM all_sections LEFT JOIN grouping_dates ON event_id = id
),
matched AS (
  SELECT sections.*, featured.* EXCLUDE (id, starts),
         coalesce(home_name, 'None') || '#' || {_utc_day("sections.ts")} AS home_day,
         {_days("utc", "sections.ts")} AS days
  FROM sections JOIN featured ON event_id = id
),
listings AS (
  SELECT matched.*, team, team_days.ts AS perf_ts, wins, score, team_day
  FROM matched LEFT JOIN team_days ON home_day = team_day
),
labels AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY position ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_index
  FROM (
    SELECT 0 AS position, home_id AS label, count(*) AS n FROM matched WHERE home_id IS NOT NULL GROUP BY 2
    UNION ALL
    SELECT 1, away_id, count(*) FROM matched WHERE home_id IS NOT NULL AND away_id IS NOT NULL GROUP BY 2
    UNION ALL
    SELECT 2, CAST(section_id AS VARCHAR), count(*) FROM matched
    WHERE home_id IS NOT NULL AND away_id IS NOT NULL AND section_id IS NOT NULL GROUP BY 2
    UNION ALL
    SELECT 3, weekday, count(*) FROM matched
    WHERE home_id IS NOT NULL AND away_id IS NOT NULL AND section_id IS NOT NULL AND weekday IS NOT NULL GROUP BY 2
    UNION ALL
    SELECT 4, game_time, count(*) FROM matched
    WHERE home_id IS NOT NULL AND away_id IS NOT NULL AND section_id IS NOT NULL AND weekday IS NOT NULL
      AND game_time IS NOT NULL GROUP BY 2
  ) AS counted
),
widths AS (
  SELECT count(*) FILTER (position < 1) AS from_1, count(*) FILTER (position < 2) AS from_2,
         count(*) FILTER (position < 3) AS from_3, count(*) FILTER (position < 4) AS from_4, count(*) AS all_labels
  FROM labels
)"""

SHARED = ",".join([INVENTORY_SQL, META_SQL, PERFORMANCE_SQL, LISTINGS_SQL])

SECTION_COLUMNS = """ts AS "timestamp", event_id AS "eventId", section_id AS "sectionId", price AS "averageTicketPrice",
  min_price AS "minSectionTicketPrice", section_listings AS "totalSectionListings",
  section_tickets AS "totalSectionTickets", listings AS "totalStadiumListings", tickets AS "totalStadiumTickets\""""

EVENT_COLUMNS = """utc AS event_date_utc, local AS event_date_local, home_id AS "Home_Team_Id",
  home_name AS "Home_Team_Name", away_id AS "Away_Team_Id\""""

CALENDAR_COLUMNS = 'weekday AS "DayofWeek", game_time AS "GameTime"'

TEAM_COLUMNS = """ts AS "timestamp", snapshot_date, id, utc AS event_date_utc, local AS event_date_local,
  home_id AS "Home_Team_Id", home_name AS "Home_Team_Name", away_id AS "Away_Team_Id", away_name AS "Away_Team_Name\""""

PERFORMANCE_COLUMNS = 'team, ts AS "timestamp", wins, score, team_day AS "Concatenated_perf"'

LISTING_COLUMNS = f"""{SECTION_COLUMNS}, {EVENT_COLUMNS}, {CALENDAR_COLUMNS}, home_day AS "Concatenated_joined",
  team, perf_ts AS perf_timestamp, wins, score, team_day AS "Concatenated_perf", days AS "Time_to_event\""""

CURVE_COLUMNS = """CAST(days AS FLOAT) AS days_difference, CAST(section_id AS INTEGER) AS "sectionId",
  CAST(price AS FLOAT) AS "averageTicketPrice\""""

CURVE = f'SELECT {CURVE_COLUMNS}, CAST(event_id AS INTEGER) AS "eventId" FROM dated'

LABEL_JOINS = " ".join(
    f"JOIN labels AS l{position} ON l{position}.position = {position} AND l{position}.label = {column}"
    for position, column in enumerate(
        ["home_id", "away_id", "CAST(section_id AS VARCHAR)", "weekday", "game_time"]
    )
)

INDEX_COLUMNS = ", ".join(
    f'l{position}.label_index AS "{name}_indexed"'
    for position, name in enumerate(["Home_Team_Id", "Away_Team_Id", "sectionId", "DayofWeek", "GameTime"])
)

SLOTS = "concat_ws(',', CAST(l0.label_index AS BIGINT), " + ", ".join(
    f"CAST(l{position}.label_index AS BIGINT) + from_{position}" for position in range(1, 5)
) + ") AS feature_slots"

STRUCTURED = f"SELECT {LISTING_COLUMNS}, {INDEX_COLUMNS}, {SLOTS} FROM listings {LABEL_JOINS} CROSS JOIN widths"


def _event_labels(position: int, column: str, condition: str) -> str:
    return (
        f"SELECT {position} AS position, {column} AS label, count(*) AS n FROM featured WHERE {condition} GROUP BY 2"
    )


def _event_ranks(*columns: str) -> str:
    """Label ranks of event columns, each counted where the earlier ones are not null."""
    parts = [
        _event_labels(position, column, " AND ".join(f"{name} IS NOT NULL" for name in columns[: position + 1]))
        for position, column in enumerate(columns)
    ]
    return (
        "event_labels AS (SELECT *, row_number() OVER (PARTITION BY position ORDER BY n DESC, label) - 1 AS place "
        f"FROM ({' UNION ALL '.join(parts)}) AS counted)"
    )


def _event_label_joins(*columns: str) -> str:
    return " ".join(
        f"JOIN event_labels AS e{position} ON e{position}.position = {position} AND e{position}.label = {column}"
        for position, column in enumerate(columns)
    )


def _loss(dataset: str, source: str, kept: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, count(*) AS rows_before, count(*) FILTER ({kept}) AS rows_after,
      CAST(count(*) - count(*) FILTER ({kept}) AS DOUBLE) / count(*) * 100 AS pct_dropped FROM {source}"""


INVENTORY_KEPT = "event_id % 97 <> 3 AND event_id % 89 <> 4 AND ts IS NOT NULL"
META_KEPT = "(id IS NULL OR (id % 97 <> 3 AND id % 89 <> 4)) AND ts IS NOT NULL"
PERFORMANCE_KEPT = "score >= 1000 AND wins <> 7 AND ts IS NOT NULL"

HOME_WIDTH = "(SELECT count(*) FROM event_labels WHERE position = 0)"
WEEKDAY_WIDTH = "(SELECT count(*) FROM event_labels WHERE position = 1)"

SPLIT = """SELECT ts AS "timestamp", section_id AS "sectionId", price AS "averageTicketPrice",
    event_id AS "eventId" FROM sections"""

def _later_events(unseen: str) -> tuple[str, str]:
    """Odd events with the labels of the even ones; a value without one takes the next index, or drops its row."""
    columns = {"Away_Team_Id": "away_id", "game_day": "game_day", "GameTime": "game_time"}
    values = list(columns.values())
    indexes, joins, starts = [], [], ["0"]
    for position, (name, value) in enumerate(columns.items()):
        size = f"(SELECT count(*) FROM early_labels WHERE position = {position})"
        index = f"k{position}.place" if unseen == "skip" else f"coalesce(k{position}.place, {size})"
        indexes.append((name, index))
        joins.append(f"{'' if unseen == 'skip' else 'LEFT '}JOIN early_labels AS k{position} "
                     f"ON k{position}.position = {position} AND k{position}.label = later.{value}")
        starts.append(f"{starts[-1]} + {size}" + ("" if unseen == "skip" else " + 1"))
    slots = ", ".join(f"CAST({index} + {start} AS VARCHAR)" for (_, index), start in zip(indexes, starts))
    named = ", ".join(f'later.{value} AS "{name}"' for name, value in columns.items())
    places = ", ".join(f'CAST({index} AS DOUBLE) AS "{name}_indexed"' for name, index in indexes)
    labels = " UNION ALL ".join(
        f"SELECT {position} AS position, {value} AS label, count(*) AS n FROM days WHERE id % 2 = 0 AND "
        f"{' AND '.join(f'{v} IS NOT NULL' for v in values[: position + 1])} GROUP BY 2"
        for position, value in enumerate(values)
    )
    return f"""SELECT id, {named}, {places}, concat_ws(',', {slots}) AS feature_slots
        FROM (SELECT * FROM days WHERE id % 2 <> 0) AS later {' '.join(joins)}""", f"""
days AS (SELECT *, substr(local, 1, 10) AS game_day FROM featured),
early_labels AS (
  SELECT *, row_number() OVER (PARTITION BY position ORDER BY n DESC, label) - 1 AS place FROM ({labels}) AS counted
)"""


def _numbers(report: str, dataset: str, measures: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{report}' AS report, '{dataset}' AS dataset, '{name}' AS measure, CAST({value} AS DOUBLE) AS value FROM {source}"
        for name, value in measures.items()
    )


def _loss_numbers(dataset: str, source: str, kept: str) -> str:
    after = f"count(*) FILTER ({kept})"
    measures = {"rows_before": "count(*)", "rows_after": after, "pct_dropped": f"CAST(count(*) - {after} AS DOUBLE) / count(*) * 100"}
    return _numbers("loss", dataset, measures, source)


# Members that are null where a whole record is written: of the record, its event, and the event's lists.
NULL_MEMBERS = """SELECT count(*) AS lines, CAST(sum(
    CASE WHEN ts IS NULL THEN 1 ELSE 0 END + CASE WHEN ok % 41 <> 0 AND ok % 37 = 0 THEN 1 ELSE 0 END
    + CASE WHEN has_event THEN
        CASE WHEN utc IS NULL THEN 2 ELSE 0 END + CASE WHEN ok % 13 = 0 THEN 1 ELSE 0 END
        + CASE WHEN ok % 31 <> 0 AND ok % 29 = 0 THEN 1 ELSE 0 END
        + CASE WHEN has_roles AND ok % 5 = 0 THEN 2 ELSE 0 END
      ELSE 0 END) AS BIGINT) AS null_members FROM flat"""

# Without roles: the first of a list is at home (the list starts with the away team in every third event); the second one's id,
# and the head of the title, are the visitor's. An empty list leaves the fallbacks; no list, nothing.
HOME_FIRST = """SELECT ts AS "timestamp", snapshot_date, id, utc AS event_date_utc, local AS event_date_local,
    CASE WHEN has_roles THEN CAST(CASE WHEN ok % 3 = 0 THEN a ELSE h END AS VARCHAR)
         WHEN has_event AND ok % 31 = 0 AND ok % 10 = 0 THEN CAST(h AS VARCHAR) END AS "Home_Team_Id",
    CASE WHEN has_roles THEN replace(CASE WHEN ok % 3 = 0 THEN a_name ELSE h_name END, ' ', '-')
         WHEN has_event AND ok % 31 = 0 AND ok % 10 = 0 THEN replace(h_name, ' ', '-') END AS "Home_Team_Name",
    CASE WHEN has_roles THEN CAST(CASE WHEN ok % 3 = 0 THEN h ELSE a END AS VARCHAR) END AS "Away_Team_Id",
    CASE WHEN has_roles OR (has_event AND ok % 31 = 0) THEN replace(a_name, ' ', '-') || '-Utd' END AS "Away_Team_Name"
    FROM timed"""

WRITTEN_DATES = """SELECT o_orderkey, strftime(wall, '%Y-%m-%d %H:%M:%S') AS wall_clock, CAST(isodow(wall) AS VARCHAR) AS weekday,
    CASE WHEN hour(wall) < 14 THEN 'd' WHEN hour(wall) < 18 THEN 'a' WHEN wall IS NOT NULL THEN 'n' END AS game_time,
    CAST(epoch_ms(wall) AS DOUBLE) / 1000 / 60 / 60 / 24 AS days
    FROM (SELECT o_orderkey, CASE o_orderkey % 8 WHEN 7 THEN NULL WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
        ELSE o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) END AS wall FROM orders) AS read"""

REPORTS = " UNION ALL ".join([
    _loss_numbers("inventory", "inv", INVENTORY_KEPT),
    _loss_numbers("meta", "flat", META_KEPT),
    _loss_numbers("performance", "perf", PERFORMANCE_KEPT),
    _numbers("nulls", "meta", {
        name: f"count(*) - count({column})"
        for name, column in {"Home_Team_Id": "home_id", "Home_Team_Name": "home_name", "Away_Team_Id": "away_id",
                             "Away_Team_Name": "away_name"}.items()
    }, "timed"),
    _numbers("coverage", "listings", {
        "total": "count(*)", "unmatched": "count(*) - count(team_day)", "pct_matched": "CAST(count(team_day) AS DOUBLE) / count(*) * 100",
    }, "listings"),
])

BODIES: dict[str, str] = {
    "clean_load": f"""SELECT ts AS "timestamp", event_id AS "eventId", listings AS "totalListings",
        tickets AS "totalTickets", CASE WHEN kind = 1 THEN 0 WHEN kind > 1 THEN 2 END AS sections,
        CASE WHEN kind > 1 THEN price_b END AS second_price FROM inv WHERE {INVENTORY_KEPT}""",
    "clean_load_narrow": f'SELECT event_id AS "eventId" FROM inv WHERE {INVENTORY_KEPT}',
    "load_loss_report": " UNION ALL ".join([
        _loss("inventory", "inv", INVENTORY_KEPT),
        _loss("meta", "flat", META_KEPT),
        _loss("performance", "perf", PERFORMANCE_KEPT),
    ]),
    "json_round_trip": """SELECT ts AS "timestamp", snapshot_date, id, utc AS event_date_utc, local AS event_date_local,
        original_name,
        CASE WHEN has_roles THEN CASE WHEN ok % 3 = 0 THEN a ELSE h END END AS first_id,
        CASE WHEN has_roles THEN CASE WHEN ok % 3 = 0 THEN a_name ELSE h_name END END AS first_name,
        CASE WHEN has_roles AND ok % 5 <> 0 THEN CASE WHEN ok % 3 = 0 THEN 'AWAY_TEAM' ELSE 'HOME_TEAM' END END AS first_role,
        CASE WHEN has_roles THEN CASE WHEN ok % 3 = 0 THEN h ELSE a END END AS second_id,
        CASE WHEN has_roles THEN CASE WHEN ok % 3 = 0 THEN h_name ELSE a_name END END AS second_name,
        CASE WHEN has_roles AND ok % 5 <> 0 THEN CASE WHEN ok % 3 = 0 THEN 'HOME_TEAM' ELSE 'AWAY_TEAM' END END AS second_role,
        CAST(CASE WHEN has_roles THEN 2 WHEN has_event AND ok % 31 = 0 THEN 0 END AS INTEGER) AS roles,
        CASE WHEN has_event THEN h END AS first_performer_id, CASE WHEN has_event THEN h_name END AS first_performer_name,
        CASE WHEN has_event AND ok % 10 <> 0 THEN a END AS second_performer_id,
        CASE WHEN has_event AND ok % 10 <> 0 THEN a_name END AS second_performer_name,
        CAST(CASE WHEN has_event THEN CASE WHEN ok % 10 = 0 THEN 1 ELSE 2 END END AS INTEGER) AS performers,
        grouping_id, CAST(CASE WHEN has_event AND ok % 13 <> 0 THEN 1 END AS INTEGER) AS groupings FROM flat""",
    "parquet_round_trip": CURVE,
    "csv_round_trip": CURVE,
    "reexport": f"SELECT {CURVE_COLUMNS} FROM grouped WHERE days IS NOT NULL",
    "reexport_report": """SELECT count(*) AS rows_before, count(days) AS rows_after,
        CAST(count(*) - count(days) AS DOUBLE) / count(*) * 100 AS pct_dropped FROM grouped""",
    "require_all_columns": f"""SELECT {TEAM_COLUMNS} FROM flat WHERE ts IS NOT NULL AND id IS NOT NULL
        AND utc IS NOT NULL AND local IS NOT NULL AND home_id IS NOT NULL AND home_name IS NOT NULL
        AND away_id IS NOT NULL AND away_name IS NOT NULL""",
    "null_audit": """SELECT count(*) - count(home_id) AS "Home_Team_Id", count(*) - count(home_name) AS "Home_Team_Name",
        count(*) - count(away_id) AS "Away_Team_Id", count(*) - count(away_name) AS "Away_Team_Name" FROM timed""",
    "explode_sections": f"SELECT {SECTION_COLUMNS} FROM sections",
    "first_event": 'SELECT ts AS "timestamp", id, utc AS event_date FROM timed',
    "first_grouping_id": 'SELECT ts AS "timestamp", grouping_id AS id, utc AS event_date FROM flat',
    "home_away_teams": f"SELECT {TEAM_COLUMNS} FROM timed",
    "consolidate_events": f"SELECT id, {EVENT_COLUMNS} FROM merged",
    "latest_event_date": "SELECT id, event_date FROM dates",
    "latest_event_date_by_grouping": "SELECT id, event_date FROM grouping_dates",
    "weekday_game_time": """SELECT ts AS "timestamp", id, CAST(isodow(starts) AS VARCHAR) AS "DayofWeek",
        CASE WHEN hour(starts) < 14 THEN 'd' WHEN hour(starts) < 18 THEN 'a' WHEN starts IS NOT NULL THEN 'n' END AS "GameTime"
        FROM (SELECT *, try_cast(substr(local, 1, 19) AS TIMESTAMP) AS starts FROM timed)""",
    "resolve_events": f"SELECT id, {EVENT_COLUMNS}, {CALENDAR_COLUMNS} FROM featured",
    "team_day_key": f"SELECT {PERFORMANCE_COLUMNS} FROM perf_keyed",
    "dedup_team_day": f"SELECT {PERFORMANCE_COLUMNS} FROM team_days",
    "prepare_performance": f"SELECT {PERFORMANCE_COLUMNS} FROM team_days WHERE ts IS NOT NULL",
    "join_event_inner": f"SELECT {SECTION_COLUMNS}, {EVENT_COLUMNS}, {CALENDAR_COLUMNS} FROM matched",
    "join_event_left": f"SELECT {SECTION_COLUMNS}, event_date FROM grouped",
    "join_team_day": f"""SELECT {SECTION_COLUMNS}, home_name AS "Home_Team_Name", home_day AS "Concatenated_joined",
        team, perf_ts AS perf_timestamp, wins, score, team_day AS "Concatenated_perf" FROM listings""",
    "join_all": f"SELECT {LISTING_COLUMNS} FROM listings",
    "join_coverage": """SELECT count(*) AS total, count(*) - count(team_day) AS unmatched,
        CAST(count(team_day) AS DOUBLE) / count(*) * 100 AS pct_matched FROM listings""",
    "time_to_event": """SELECT ts AS "timestamp", event_id AS "eventId", section_id AS "sectionId",
        event_date AS event_date_utc, days AS "Time_to_event" FROM dated""",
    "days_difference_float": """SELECT ts AS "timestamp", event_id AS "eventId", section_id AS "sectionId",
        CAST(days AS FLOAT) AS days_difference FROM dated""",
    "ordered_listings": f'SELECT {SECTION_COLUMNS}, event_date AS event_date_utc, days AS "Time_to_event" FROM dated',
    "price_curve_order": """SELECT event_id AS "eventId", section_id AS "sectionId", price AS "averageTicketPrice",
        CAST(days AS FLOAT) AS days_difference FROM dated""",
    "top_listings": """SELECT event_id AS "eventId", section_id AS "sectionId", days AS "Time_to_event",
        price AS "averageTicketPrice" FROM dated
        ORDER BY event_id DESC NULLS LAST, section_id DESC NULLS LAST, days DESC NULLS LAST, price DESC NULLS LAST
        LIMIT 20""",
    "label_frequencies": "SELECT position, label, n FROM labels",
    "label_ranks": "SELECT position, label, n, label_index FROM labels",
    "label_index": f"""SELECT ts AS "timestamp", event_id AS "eventId", home_id AS "Home_Team_Id",
        away_id AS "Away_Team_Id", section_id AS "sectionId", {CALENDAR_COLUMNS}, {INDEX_COLUMNS}
        FROM matched {LABEL_JOINS}""",
    "label_index_by_join": f"""SELECT game_time AS "GameTime", id, home_id AS "Home_Team_Id",
        CAST(e0.place AS DOUBLE) AS "GameTime_indexed", CAST(e1.place AS DOUBLE) AS id_indexed,
        CAST(e2.place AS DOUBLE) AS "Home_Team_Id_indexed"
        FROM featured {_event_label_joins("game_time", "CAST(id AS VARCHAR)", "home_id")}""",
    "one_hot_slots": f"""SELECT id, CAST(e0.place AS VARCHAR) AS home_slot, CAST(e1.place AS VARCHAR) AS weekday_slot,
        CAST(e2.place AS VARCHAR) AS game_time_slot,
        concat_ws(',', e0.place, e1.place + {HOME_WIDTH}, e2.place + {HOME_WIDTH} + {WEEKDAY_WIDTH}) AS feature_slots
        FROM featured {_event_label_joins("home_id", "weekday", "game_time")}""",
    "feature_slots": f"""SELECT id, weekday AS "DayofWeek", concat_ws(',', e0.place, e1.place + {HOME_WIDTH}) AS feature_slots
        FROM featured {_event_label_joins("CAST(id AS VARCHAR)", "weekday")}""",
    "dense_features": "SELECT id, weekday AS \"DayofWeek\", game_time AS \"GameTime\", " + ", ".join(
        [f'CAST(e0.place = {i} AS DOUBLE) AS "cat_feature[{i}]"' for i in range(7)]
        + [f'CAST(e1.place = {i} AS DOUBLE) AS "cat_feature[{i + 7}]"' for i in range(3)]
    ) + f" FROM featured {_event_label_joins('weekday', 'game_time')}",
    "distinct_events": 'SELECT DISTINCT event_id AS "eventId" FROM sections',
    "split_by_event": SPLIT,
    "split_by_event_parquet": SPLIT,
    "event_slice": f"{SPLIT} WHERE event_id = 42",
    "price_through_time": CURVE,
    "price_through_time_v1": f"SELECT {CURVE_COLUMNS} FROM grouped",
    "price_through_time_files": CURVE,
    "structure_all": STRUCTURED,
    "structure_all_files": STRUCTURED,
    "structure_all_split": STRUCTURED,
    "structure_all_fitted": STRUCTURED,
    "hot_keys": """SELECT 'event' AS kind, CAST(event_id AS VARCHAR) AS key FROM snapshots GROUP BY event_id
        HAVING count(*) > (SELECT share * count(*) FROM snapshots, hot_share GROUP BY share)
        UNION ALL SELECT 'team day', day FROM event_days GROUP BY day
        HAVING count(*) > (SELECT share * count(*) FROM event_days, hot_share GROUP BY share)""",
    "join_all_hot": f"SELECT {LISTING_COLUMNS} FROM listings",
    "discovered_performance": f'SELECT team, ts AS "timestamp", wins, score FROM perf WHERE {PERFORMANCE_KEPT}',
    "discovered_fields": """SELECT field, CASE WHEN field LIKE '%id' THEN 'bigint' ELSE 'string' END AS type
        FROM (SELECT unnest(['current_date', 'current_timestamp', 'events.eventDateLocal', 'events.eventDateUTC',
            'events.groupingsCollection.id', 'events.id', 'events.originalName', 'events.performers.id', 'events.performers.name',
            'events.performersCollection.id', 'events.performersCollection.name', 'events.performersCollection.role']) AS field)
        WHERE EXISTS (SELECT 1 FROM flat WHERE has_roles)""",
    "home_first_teams": HOME_FIRST,
    "json_null_members": f"""SELECT 'source' AS file, lines, null_members FROM ({NULL_MEMBERS})
        UNION ALL SELECT 'copy', lines, CAST(0 AS BIGINT) FROM ({NULL_MEMBERS})""",
    "written_dates": WRITTEN_DATES,
    "unread_dates": """SELECT local AS text, count(*) AS n FROM timed
        WHERE local IS NOT NULL AND try_cast(substr(local, 1, 19) AS TIMESTAMP) IS NULL GROUP BY local""",
    "structure_all_reports": REPORTS,
    "encode_later_events": _later_events("keep")[0],
    "encode_later_events_skip": _later_events("skip")[0],
    "structured_csv": f"""SELECT ts AS "timestamp", event_id AS "eventId", section_id AS "sectionId", home_name AS "Home_Team_Name",
        team_day AS "Concatenated_perf", days AS "Time_to_event",
        '(' || (all_labels - from_4) || ',[' || CAST(l4.label_index AS BIGINT) || '],[1.0])' AS "GameTime_indexed_encoded",
        '(' || all_labels || ',[' || {SLOTS.removesuffix(" AS feature_slots")} || '],[1.0,1.0,1.0,1.0,1.0])' AS cat_features
        FROM listings {LABEL_JOINS} CROSS JOIN widths""",
    "price_through_time_v1_files": f"SELECT {CURVE_COLUMNS} FROM grouped",
}

# Clauses that only some queries need.
EXTRA = {
    "hot_keys": f"""snapshots AS (SELECT ts, event_id FROM inv WHERE ts IS NOT NULL),
event_days AS (
  SELECT coalesce(home_name, 'None') || '#' || {_utc_day("snapshots.ts")} AS day FROM snapshots JOIN featured ON event_id = id
),
hot_share AS (SELECT 5.5 / count(*) AS share FROM snapshots)""",
    "encode_later_events": _later_events("keep")[1],
    "encode_later_events_skip": _later_events("skip")[1],
    "label_index_by_join": _event_ranks("game_time", "CAST(id AS VARCHAR)", "home_id"),
    "feature_slots": _event_ranks("CAST(id AS VARCHAR)", "weekday"),
    "one_hot_slots": _event_ranks("home_id", "weekday", "game_time"),
    "dense_features": _event_ranks("weekday", "game_time"),
}
# The shared clauses over the lines that survive cleaning.
FROM_FILES = {"structure_all_files", "structure_all_split", "structure_all_reports", "price_through_time_files"}
FILES_SHARED = (
    SHARED.replace("FROM inv WHERE kind > 1", f"FROM inv WHERE kind > 1 AND {INVENTORY_KEPT}")
    .replace("SELECT * FROM flat WHERE ts IS NOT NULL", f"SELECT * FROM flat WHERE {META_KEPT}")
    .replace("AS team_day FROM perf\n", f"AS team_day FROM perf WHERE {PERFORMANCE_KEPT}\n")
)


def _statement(name: str) -> str:
    shared = FILES_SHARED if name in FROM_FILES else SHARED
    clauses = f"{shared}, {EXTRA[name]}" if name in EXTRA else shared
    return f"WITH {clauses}\n{BODIES[name]}"


ORACLE_SQL: dict[str, str] = {name: _statement(name) for name in BODIES}
