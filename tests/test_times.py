from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from seatgrid.functions.times import (
    days_difference,
    game_time,
    iso_weekday,
    parse_date,
    parse_iso,
    team_day_key,
    time_to_event,
    unread_dates,
)


def evaluate(spark, schema, rows, *columns):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [tuple(row)[1:] for row in df.select("i", *columns).orderBy("i").collect()]


def test_team_day_key(spark):
    rows = [
        ("Boston", 1510250000000), (None, 1510250000000), ("Boston", None), ("B C", 1483228800000),
        ("Old", 946684800000), ("Tiny", 5), ("Before", -86400001), ("Start", 0),
    ]
    got = evaluate(spark, "team string, ms bigint", rows, team_day_key("team", "ms"))

    def by_reading(team, ms):
        if ms is None:
            return None
        at = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=int(str(ms)[:10]))
        return f"{team}#{at.year}#{at.month}#{at.day}"

    assert got == [(by_reading(*row),) for row in rows]
    assert got[0] == ("Boston#2017#11#9",)


def test_weekday_and_game_time(spark):
    rows = [
        ("2017-11-09T19:30:00-0500",), ("2017-11-12T13:59:59-0800",), ("2017-11-13T14:00:00Z",),
        ("2017-11-13 17:00:00",), ("2017-11-13T18:00-0500",), ("2017-03-12T02:30:00-0500",), ("2017-11-13",),
        ("Nov 9",), ("",), (None,),
    ]
    got = evaluate(spark, "t string", rows, iso_weekday("t"), game_time("t"))
    assert got == [
        ("4", "n"), ("7", "d"), ("1", "a"), ("1", "a"), ("1", "n"), ("7", "d"), ("1", "d"),
        (None, None), (None, None), (None, None),
    ]


def test_time_to_event(spark):
    rows = [
        (1510250000000, "2017-11-10T00:30:00Z"),
        (1510250000123, "2017-11-10T00:30:00.900Z"),
        (1510350000000, "2017-11-10T00:30:00Z"),
        (1510250000000, None),
        (None, "2017-11-10T00:30:00Z"),
        (1510250000000, "TBD"),
    ]
    got = evaluate(spark, "ms bigint, utc string", rows, time_to_event("ms", "utc"), days_difference("ms", "utc"))
    assert got[0][0] == 23800000 / 1000 / 60 / 60 / 24
    assert got[1][0] == (1510273800000 - 1510250000123) / 1000 / 60 / 60 / 24
    assert got[2][0] < 0
    assert got[3:] == [(None, None)] * 3
    assert got[0][1] == pytest.approx(got[0][0], rel=1e-6) and got[0][1] != got[0][0]


def test_strict_parsing_names_the_text(spark):
    df = spark.createDataFrame([("soon",)], "t string")
    with pytest.raises(Exception, match="not an ISO-8601 date-time: soon"):
        df.select(parse_iso("t", strict=True)).collect()
    missing = spark.createDataFrame([(1, None)], "ms bigint, utc string")
    with pytest.raises(Exception, match="not an ISO-8601 date-time: null"):
        missing.select(time_to_event("ms", "utc", strict=True)).collect()


WRITTEN = {
    "May 3, 2017 7:05 PM": datetime(2017, 5, 3, 19, 5),
    "05/03/2017": datetime(2017, 5, 3),
    "Wed, 03 May 2017 19:05:30 +0000": datetime(2017, 5, 3, 19, 5, 30),
    "Wed, 3 May 2017 19:05:30 -0700 (PDT)": datetime(2017, 5, 3, 19, 5, 30),
    "wednesday, MAY 3rd 2017 at 7pm": datetime(2017, 5, 3, 19),
    "Wed May  3 19:05:00 2017": datetime(2017, 5, 3, 19, 5),
    "Wed May  3 19:05:00 UTC 2017": datetime(2017, 5, 3, 19, 5),
    "3 May 2017": datetime(2017, 5, 3),
    "3rd of May, 2017, 12:00 a.m. EST": datetime(2017, 5, 3),
    "3-May-2017 12:30 pm": datetime(2017, 5, 3, 12, 30),
    "Sept. 9, 2017 19:05Z": datetime(2017, 9, 9, 19, 5),
    "13/12/2017 23:59": datetime(2017, 12, 13, 23, 59),
    "12/13/2017 23:59": datetime(2017, 12, 13, 23, 59),
    "2017-13-01": datetime(2017, 1, 13),
    "2017/5/3 7:05:06.25 pm": datetime(2017, 5, 3, 19, 5, 6),
    "20170503": datetime(2017, 5, 3),
    "  2017-05-03T19:05:00Z": datetime(2017, 5, 3, 19, 5),
    "Mar 12, 2017 2:30 AM": datetime(2017, 3, 12, 2, 30),  # a time that clocks in New York skip
    "02/30/2017": None, "Mayo 3, 2017": None, "May 3": None, "May 3, 2017 25:00": None, "May 3, 2017 13 pm": None,
    "May 3, 2017 7:65 PM": None, "13/13/2017": None, "TBD": None, "": None, "5": None, "tomorrow at 7pm": None, "99999999": None,
}


def test_written_dates_keep_their_wall_clock(spark):
    got = evaluate(spark, "t string", [(t,) for t in WRITTEN], parse_date("t"), iso_weekday("t"), game_time("t"))
    for (text, at), (read, weekday, time) in zip(WRITTEN.items(), got):
        assert (text, read) == (text, at)
        assert weekday == (None if at is None else str(at.isoweekday()))
        assert time == (None if at is None else "d" if at.hour < 14 else "a" if at.hour < 18 else "n")


def test_iso_text_is_read_as_before(spark):
    rows = [("2017-11-09T19:30:00-0500",), ("2017-11-13T18:00-0500",), ("2017-11-13",), ("2017-11-10T00:30:00.900Z",), ("2017",)]
    got = evaluate(spark, "t string", rows, parse_date("t"), parse_iso("t"))
    assert all(a == b for a, b in got) and got[0][0] == datetime(2017, 11, 9, 19, 30)


def test_long_texts_without_a_date(spark):
    rows = [("1:" * 50_000,), ("may " * 50_000,), ("(" * 100_000 + "3",), (" " * 100_000 + "3",)]
    assert evaluate(spark, "t string", rows, parse_date("t")) == [(None,)] * 4


def test_unread_dates_are_named(spark):
    df = spark.createDataFrame([(t,) for t in (*WRITTEN, None, "TBD")], "t string")
    got = {row.text: row.n for row in unread_dates(df, "t").collect()}
    assert got == {t: 2 if t == "TBD" else 1 for t, at in WRITTEN.items() if at is None}
    with pytest.raises(Exception, match="date-time: Mayo 3, 2017, nor a written form"):
        df.filter("t LIKE 'Mayo%'").select(time_to_event(F.lit(0), "t", strict=True)).collect()
