"""Order tables recast as the three input collections.

Every adapter is a row-wise projection of a whole table, with nulls, empty lists and unreadable values placed
by key arithmetic; no adapter groups rows. The only joins are with ``nation``, a table of fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatgrid.schemas import CORRUPT, EVENTS, PERFORMERS, SECTION_STATS
from seatgrid.session import PACKED_TEXT

TEAMS = 25  # rows of the nation table
SHIFT_DAYS = 7305  # twenty years, so that every instant has the thirteen digits of a present-day one


# The columns the adapters use; declared, so that opening a table starts no job to look for them.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _shifted(date: str) -> str:
    return f"({date} + make_dt_interval({SHIFT_DAYS}))"


def _built(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def inventory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per line item, each with two sections, none, or a null list."""
    instant = f"unix_timestamp({_shifted('l_shipdate')}) * 1000 + l_linenumber * 3600000L + l_partkey % 1000"
    tickets = "CAST(l_quantity AS BIGINT)"
    def section(section_id: str, average: str, minimum: str, listings: int) -> str:
        return (
            f"struct({section_id} AS sectionId, {average} AS averageTicketPrice, {minimum} AS minTicketPrice, "
            f"{listings}L AS totalListings, {tickets} AS totalTickets)"
        )

    price = "l_extendedprice / l_quantity"
    first = section("CAST(l_linenumber AS BIGINT)", price, "l_extendedprice * (1 - l_discount) / l_quantity", 1)
    second = section("10 + l_suppkey % 10", "l_extendedprice * (1 + l_tax) / l_quantity", price, 2)
    return _built(
        table(spark, sf_dir, "lineitem"),
        current_timestamp=f"CASE WHEN (l_orderkey + l_linenumber) % 50 <> 0 THEN {instant} END",
        eventId="l_orderkey",
        totalListings="CAST(l_linenumber + 3 AS BIGINT)",
        totalTickets=f"{tickets} * 2",
        section_stats=f"""CASE WHEN l_partkey % 20 = 1 THEN CAST(array() AS {SECTION_STATS})
            WHEN l_partkey % 20 > 1 THEN array({first}, {second}) END""",
    )


def _nations(spark: SparkSession, sf_dir: str, key: str, name: str, blank: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        f"CAST(n_nationkey AS BIGINT) AS {key}", f"replace(n_name, '_', '{blank}') AS {name}"
    )


def meta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots per order, a day apart; some events change home team between them.

    One event in eleven has an id that no inventory has.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey AS ok", "o_custkey", f"{_shifted('o_orderdate')} AS day", "explode(array(0, 1)) AS k")
        .withColumn("home_id", F.expr(f"(o_custkey + CASE WHEN ok % 7 = 0 THEN k ELSE 0 END) % {TEAMS}"))
        .withColumn("away_id", F.expr(f"(home_id + 1 + ok % 24) % {TEAMS}"))
        .join(_nations(spark, sf_dir, "home_key", "home", " "), F.expr("home_id = home_key"))
        .join(_nations(spark, sf_dir, "away_key", "away", " "), F.expr("away_id = away_key"))
    )

    def text(extra_hours: int, offset: str) -> str:
        wall_clock = f"day + make_dt_interval(k, CAST(ok % 24 AS INT) + {extra_hours})"
        iso = f"concat(replace(CAST({wall_clock} AS STRING), ' ', 'T'), '{offset}')"
        return f"CASE WHEN ok % 47 = 0 THEN 'TBD' WHEN ok % 43 <> 0 THEN {iso} END"

    def performer(side: str) -> str:
        role = f"CASE WHEN ok % 5 <> 0 THEN '{side.upper()}_TEAM' END"
        return f"struct({side}_id AS id, {side} AS name, {role} AS role)"

    home, away = performer("home"), performer("away")
    own_id = "CASE WHEN ok % 11 = 0 THEN -ok ELSE ok END"
    event = f"""struct(
        {own_id} AS id, {text(5, "Z")} AS eventDateUTC, {text(0, "-0500")} AS eventDateLocal,
        concat(away, ' Utd at ', home) AS originalName,
        CASE WHEN ok % 31 = 0 THEN CAST(array() AS {PERFORMERS})
             WHEN ok % 29 = 0 THEN NULL
             WHEN ok % 3 = 0 THEN array({away}, {home})
             ELSE array({home}, {away}) END AS performersCollection,
        CASE WHEN ok % 10 = 0 THEN array(struct(home_id AS id, home AS name))
             ELSE array(struct(home_id AS id, home AS name), struct(away_id AS id, away AS name)) END AS performers,
        CASE WHEN ok % 13 <> 0 THEN array(struct({own_id} AS id)) END AS groupingsCollection)"""
    return _built(
        orders,
        current_timestamp="CASE WHEN ok % 53 <> 0 OR k = 0 THEN unix_timestamp(day) * 1000 + k * 86400000L END",
        current_date="substring(CAST(day AS STRING), 1, 10)",
        events=f"""CASE WHEN ok % 41 = 0 THEN CAST(array() AS {EVENTS})
            WHEN ok % 37 <> 0 THEN array({event}) END""",
    )


def performance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One performance record per line item, its team a nation; many per team and day."""
    names = _nations(spark, sf_dir, "team_key", "team_name", "-")
    instant = f"unix_timestamp({_shifted('l_shipdate')}) * 1000 + l_linenumber * 3600000L"
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(names, F.expr(f"l_suppkey % {TEAMS} = team_key")).selectExpr(
        "CASE WHEN l_suppkey % 40 <> 0 THEN team_name END AS team",
        f"CASE WHEN (l_orderkey + l_linenumber) % 50 <> 0 THEN {instant} END AS current_timestamp",
        "CAST(l_linenumber AS BIGINT) AS wins",
        "l_extendedprice AS score",
    )


def write_json_lines(
    rows: DataFrame, path: str, broken: Column, mistyped: Column, field: str = "current_timestamp"
) -> None:
    """Writes ``rows`` as packed JSON lines, cutting the last character off some and giving ``field`` a wrong type in others."""
    body = [name for name in rows.columns if name not in (field, CORRUPT)]
    good = F.to_json(F.struct(*rows.columns))
    bad_type = F.to_json(F.struct(F.lit("x").alias(field), *body))
    line = (
        F.when(broken, F.substring(good, F.lit(1), F.length(good) - 1))
        .when(mistyped, bad_type)
        .otherwise(good)
    )
    rows.select(line.alias("value")).write.options(**PACKED_TEXT).text(path)
