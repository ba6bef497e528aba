"""Home and away team of an event, as column expressions.

Three steps, each meant for a projection of its own so that nothing is evaluated twice: the performers *found*
for a role, the *pick* (``struct<name, id>``, null where the rules find none or hit a broken entry), and the
output fields of a pick.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the input data.
HOME_ROLE = "HOME_TEAM"
AWAY_ROLE = "AWAY_TEAM"
VISITOR_MARK = " at"


def dashed(name: Column) -> Column:
    """Team names are spelled with dashes for blanks."""
    return F.replace(name, F.lit(" "), F.lit("-"))


def _team(entry: Column) -> Column:
    """The two fields the pick needs, so that both performer lists give one type; null stays null."""
    return F.when(entry.isNotNull(), F.struct(entry["name"].alias("name"), entry["id"].alias("id")))


def _in_role(performers: Column, role: str) -> Column:
    """Performers of a role. A null entry met on the way counts as found, and spoils the pick."""
    return F.filter(performers, lambda entry: entry.isNull() | (entry["role"] == role))


def home_found(collection: Column, has_role: bool = True) -> Column:
    """``has_role`` tells if the entries have a ``role`` field; without one the first entry is home."""
    return _in_role(collection, HOME_ROLE) if has_role else F.slice(collection, 1, 1)


def away_found(collection: Column, has_role: bool = True) -> Column:
    return _in_role(collection, AWAY_ROLE) if has_role else F.filter(collection, lambda entry: entry.isNull())


def home_pick(found: Column, performers: Column) -> Column:
    """The home performer, else the only entry of ``performers``."""
    return (
        F.when(found.isNull(), None)
        .when(F.array_size(found) > 0, _team(F.get(found, F.lit(0))))
        .when(F.array_size(performers) == 1, _team(F.get(performers, F.lit(0))))
    )


def away_pick(found: Column, collection: Column, original_name: Column) -> Column:
    """The away performer, else the text before `` at`` in the event name with the second entry's id."""
    second = F.get(collection, F.lit(1))
    visitor = F.substring_index(original_name, VISITOR_MARK, 1)
    return (
        F.when(found.isNull(), None)
        .when(F.array_size(found) > 0, _team(F.get(found, F.lit(0))))
        .when((F.array_size(collection) > 1) & second.isNull(), None)
        .otherwise(F.struct(visitor.alias("name"), second["id"].alias("id")))
    )


def team_name(pick: Column) -> Column:
    return dashed(pick["name"])


def team_id(pick: Column) -> Column:
    """Ids are text, and a pick without a name has no id either."""
    return F.when(pick["name"].isNotNull(), pick["id"].cast("string"))
