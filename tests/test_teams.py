"""Team resolution: the edge rows, and random rows against the rules written in plain Python."""

from __future__ import annotations

import random

import pytest

from seatgrid.operators.events import consolidate_events, home_away_teams, resolve_events
from seatgrid.operators.quality import require_all_columns
from seatgrid.schemas import EVENTS, PERFORMERS

H, A = "HOME_TEAM", "AWAY_TEAM"
META = f"current_timestamp bigint, current_date string, events {EVENTS}"
NO_ROLE = META.replace(PERFORMERS, "array<struct<id:bigint,name:string>>")


def resolve(spark, cases, schema=META):
    """``cases`` are (collection, performers, original name); returns the four team fields of each."""
    rows = [
        (i, None, [(i, None, None, name, collection, performers, None)])
        for i, (collection, performers, name) in enumerate(cases)
    ]
    resolved = home_away_teams(spark.createDataFrame(rows, schema)).orderBy("timestamp").collect()
    return [
        (row.Home_Team_Name, row.Home_Team_Id, row.Away_Team_Name, row.Away_Team_Id) for row in resolved
    ]


ROLE_CASES = [
    ([(1, "New York", H), (2, "Boston", A)], None, None, ("New-York", "1", "Boston", "2")),
    ([(2, "Boston", A), (1, "New York", H)], [], "x", ("New-York", "1", "Boston", "2")),
    (None, [(9, "Solo")], "X at Y", (None, None, None, None)),
    ([], [(9, "Solo Act")], "X Y at Z", ("Solo-Act", "9", "X-Y", None)),
    ([(1, "A", None), (2, "B", None)], [(1, "A"), (2, "B")], "C D at E", (None, None, "C-D", "2")),
    ([(1, "A", None), (2, "B", None)], [(9, "S")], None, ("S", "9", None, None)),
    ([(1, None, H), (3, "C", H)], None, "C at D", (None, None, "C", "3")),
    ([(None, "A", H)], None, "C at D", ("A", None, "C", None)),
    ([None, (1, "A", H)], [(9, "S")], "C at D", (None, None, None, None)),
    ([(1, "A", H), None], None, "C at D", ("A", "1", None, None)),
    ([(1, "A", H)], None, "Team Atlantic attack at Z", ("A", "1", "Team-Atlantic", None)),
    ([(1, "A", None)], [None], "C at D", (None, None, "C", None)),
    ([(1, "A", None)], [(9, None)], "C", (None, None, "C", None)),
    ([(1, "A", None), None], None, "C at D", (None, None, None, None)),
]


def test_edge_rows(spark):
    got = resolve(spark, [case[:3] for case in ROLE_CASES])
    assert got == [case[3] for case in ROLE_CASES]


def test_collection_without_role_field(spark):
    cases = [
        ([(1, "A"), (2, "B")], None, "C at D"),
        ([], [(9, "S")], "C at D"),
        ([None, (2, "B")], None, "C at D"),
    ]
    assert resolve(spark, cases, NO_ROLE) == [
        ("A", "1", "C", "2"), ("S", "9", "C", None), (None, None, None, None),
    ]


def kind(collection, role):
    """What a collection shows of a role: ``no list``, ``broken`` (a gap before any match), ``none`` or the match itself."""
    if collection is None:
        return "no list", None
    places = [i for i, entry in enumerate(collection) if entry is not None and entry[2] == role]
    gaps = [i for i, entry in enumerate(collection) if entry is None]
    place = min(places, default=len(collection))
    if min(gaps, default=len(collection)) < place:
        return "broken", None
    return ("match", collection[place]) if places else ("none", None)


def named(name, team_id):
    """A team as it comes out; without a name there is no team."""
    return (None, None) if name is None else (name.replace(" ", "-"), None if team_id is None else str(team_id))


NOTHING = named(None, None)
# (what the collection shows of the role) -> the pair, where it does not depend on anything else.
SETTLED = {"no list": NOTHING, "broken": NOTHING}


def model(collection, performers, name):
    shows, entry = kind(collection, H)
    only = performers[0] if performers is not None and len(performers) == 1 else None
    home = SETTLED.get(shows) or {
        "match": lambda: named(entry[1], entry[0]),
        "none": lambda: NOTHING if only is None else named(only[1], only[0]),
    }[shows]()
    shows, entry = kind(collection, A)
    second = collection[1] if collection is not None and len(collection) > 1 else (None,)
    away = SETTLED.get(shows) or {
        "match": lambda: named(entry[1], entry[0]),
        "none": lambda: NOTHING if name is None or second is None else named(name.partition(" at")[0], second[0]),
    }[shows]()
    return *home, *away


def test_random_rows_follow_the_rules(spark):
    rng = random.Random(11)

    def entry(with_role):
        if rng.random() < 0.12:
            return None
        fields = (rng.choice([None, 1, 2, 30]), rng.choice([None, "A", "B C", "D E F", ""]))
        return fields + (rng.choice([H, A, A, H, None, "OTHER"]),) if with_role else fields

    def entries(with_role):
        if rng.random() < 0.1:
            return None
        return [entry(with_role) for _ in range(rng.choice([0, 1, 1, 2, 2, 3]))]

    names = [None, "", "C D at E", "Solo", "X attack at Y", " at Z"]
    cases = [(entries(True), entries(False), rng.choice(names)) for _ in range(4000)]
    assert resolve(spark, cases) == [model(*case) for case in cases]


def event(event_id, home, away, utc, local="2017-11-09T19:30:00-0500"):
    collection = [(home, f"T {home}", H), (away, f"T {away}", A)]
    return [(event_id, utc, local, None, collection, None, None)]


def test_consolidation_takes_each_maximum_by_itself(spark):
    rows = [
        (1, None, event(7, 9, 3, "2017-11-10T00:00:00Z")),
        (2, None, event(7, 10, 4, "2017-11-12T00:00:00Z")),
        (3, None, event(8, 1, None, "2017-11-12T00:00:00Z")),
        (4, None, []),
        (5, None, None),
    ]
    [row] = resolve_events(spark.createDataFrame(rows, META)).collect()
    assert (row.id, row.Home_Team_Id, row.Home_Team_Name, row.Away_Team_Id) == (7, "9", "T-9", "4")
    assert row.event_date_utc == "2017-11-12T00:00:00Z"
    assert (row.DayofWeek, row.GameTime) == ("4", "n")


def test_requirement_inside_the_aggregate_equals_dropping_before(spark):
    rng = random.Random(5)
    rows = [
        (i, None, event(rng.randrange(40), rng.choice([None, 1, 9, 10]), rng.choice([None, 2, 30]),
                        rng.choice([None, "2017-01-01T00:00:00Z", "2018-01-01T00:00:00Z"])))
        for i in range(300)
    ]
    resolved = home_away_teams(spark.createDataFrame(rows, META))
    ids = ["Away_Team_Id", "Home_Team_Id"]
    inside = consolidate_events(resolved, require=ids).orderBy("id").collect()
    assert inside == consolidate_events(resolved.na.drop(subset=ids)).orderBy("id").collect()
    assert len(inside) > 10


def test_strict_mode_raises_on_an_unreadable_date(spark):
    rows = [(1, None, event(7, 9, 3, "2017-11-10T00:00:00Z", local="Nov 9"))]
    meta = spark.createDataFrame(rows, META)
    assert resolve_events(meta).first().DayofWeek is None
    with pytest.raises(Exception, match="not an ISO-8601 date-time: Nov 9"):
        resolve_events(meta, strict=True).collect()


def test_conditions_do_not_work_out_the_team_rules_again(spark):
    """Filters on the resolved columns lie above the picks, whose lambdas stand in the plan as often as without any filter."""
    rows = spark.createDataFrame([], META)
    teams = home_away_teams(rows)
    counts = [
        frame._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction") for frame in (teams, require_all_columns(teams))
    ]
    assert counts[0] == counts[1] > 0
