"""Joins of inventory with events and with team days.

The right side of each has one row per key, so a join never multiplies rows and one hot key can only be hot
on the left. Left rows are spread over ``salt`` sub-keys by a hash of their content, right rows go to all of them:
a hot key is cut up front, and, because the join key then differs from the key the right side was grouped by,
adaptive execution can cut it further. (With ``salt=1`` it cannot, where the right side is a live aggregate or
window on the join key: that side then has no shuffle of its own.) A right side that is small by its measured
size is broadcast all the same.

Where the hot keys are known (:func:`hot_keys` counts them), only their rows are spread, and the right side goes out once but
for the few rows of these keys. A list of them is made into a condition; a table of them (:func:`hot_key_table`), which may have any
number of rows, is joined to both sides to mark their rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatgrid.functions.times import team_day_key
from seatgrid.operators.performance import KEY as PERFORMANCE_KEY

JOINED_KEY = "Concatenated_joined"
SALT = 4
HOT_SHARE = 0.01


def _content_hash(df: DataFrame) -> Column:
    """Depends on the row alone, so a task that runs again sends each row to the same sub-key.

    A snapshot's time and a listing's section tell the rows of a key apart, and nothing else need be read for it; a frame
    without either is hashed by its plain columns.
    """
    telling = [name for name in ("timestamp", "sectionId") if name in df.columns]
    nested = (T.MapType, T.ArrayType, T.StructType, T.UserDefinedType)
    return F.xxhash64(*(telling or [field.name for field in df.schema if not isinstance(field.dataType, nested)]))


def hot_keys(
    df: DataFrame, key: str, share: float = HOT_SHARE, weight: Column | None = None, total: int | None = None
) -> list:
    """The values of ``key`` that hold more than ``share`` of all rows: fewer than 1 / ``share``, and no null, which joins nothing.

    Rows are counted by key before they are shuffled; a row may stand for ``weight`` rows. Best over a stored frame, of which only
    the key is read. The share is of ``total`` rows where ``df`` is but a part of them.
    """
    return sorted(row[0] for row in hot_key_table(df, key, share, weight, total).collect())


def hot_key_table(
    df: DataFrame, key: str, share: float = HOT_SHARE, weight: Column | None = None, total: int | None = None
) -> DataFrame:
    """:func:`hot_keys` as a table with the one column ``hot_key``, for shares so small that there may be very many."""
    if not 0 < share < 1:
        raise ValueError("the share of a hot key is between 0 and 1")
    rows = (F.lit(1) if weight is None else weight).cast("bigint")
    if total is None:
        total = df.agg(F.sum(rows)).first()[0] or 0
    counts = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("hot_key")).agg(F.sum(rows).alias("_rows"))
    return counts.filter(F.col("_rows") > share * total).select("hot_key")


def _marked(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``df`` with ``_hot``, whether ``key`` is one of the table ``hot``."""
    marks = hot.select(F.col("hot_key").alias("_hot_key"), F.lit(True).alias("_mark"))
    marked = df.join(marks, F.col(key) == F.col("_hot_key"), "left_outer")
    return marked.withColumn("_hot", F.coalesce("_mark", F.lit(False))).drop("_hot_key", "_mark")


def keyed_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str, salt: int = SALT,
    hot: Sequence | DataFrame | None = None,
) -> DataFrame:
    """Equi-join of ``left`` with one-row-per-key ``right``; ``how`` is ``inner`` or ``left_outer``.

    Rows of the keys ``hot``, a list or a table of distinct ones, are spread over ``salt`` sub-keys; without it, those of every key.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError(f"unsupported join type {how!r}")
    shared = sorted(set(left.columns) & set(right.columns))
    if shared:
        raise ValueError(f"columns on both sides of the join: {', '.join(shared)}")
    listed = hot is not None and not isinstance(hot, DataFrame)
    if salt <= 1 or (listed and not hot):
        return left.join(right, F.col(left_key) == F.col(right_key), how)
    sub_key = F.pmod(_content_hash(left), F.lit(salt)).cast("int")
    sub_keys = F.sequence(F.lit(0), F.lit(salt - 1))
    if listed:
        sub_key = F.when(F.col(left_key).isin(*hot), sub_key).otherwise(0)
        sub_keys = F.when(F.col(right_key).isin(*hot), sub_keys).otherwise(F.array(F.lit(0)))
    elif hot is not None:
        left, right = _marked(left, left_key, hot), _marked(right, right_key, hot)
        sub_key = F.when(F.col("_hot"), sub_key).otherwise(0)
        sub_keys = F.when(F.col("_hot"), sub_keys).otherwise(F.array(F.lit(0)))
    spread = left.withColumn("_left_salt", sub_key).drop("_hot")
    copies = right.withColumn("_right_salt", F.explode(sub_keys)).drop("_hot")
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_left_salt") == F.col("_right_salt"))
    return spread.join(copies, same, how).drop("_left_salt", "_right_salt")


def join_event_meta(
    inventory: DataFrame, events: DataFrame, how: str = "inner", salt: int = SALT,
    hot: Sequence | DataFrame | None = None,
) -> DataFrame:
    """Snapshots or section rows with their event's columns; ``left_outer`` keeps those without an event."""
    return keyed_join(inventory, events, "eventId", "id", how, salt, hot).drop("id")


def add_joined_key(joined: DataFrame) -> DataFrame:
    """The home team's key on the snapshot's UTC day."""
    return joined.withColumn(JOINED_KEY, team_day_key("Home_Team_Name", "timestamp"))


def prefixed(performance: DataFrame, prefix: str, keep: Sequence[str] = (PERFORMANCE_KEY,)) -> DataFrame:
    """Performance with ``prefix`` before its pass-through names, for data whose names collide."""
    return performance.withColumnsRenamed(
        {name: f"{prefix}{name}" for name in performance.columns if name not in keep}
    )


def join_team_day(keyed: DataFrame, performance: DataFrame, salt: int = SALT, hot: Sequence | DataFrame | None = None) -> DataFrame:
    """Left join with the performance of the home team that day; a null key has no partner."""
    return keyed_join(keyed, performance, JOINED_KEY, PERFORMANCE_KEY, "left_outer", salt, hot)


@dataclass(frozen=True)
class HotKeys:
    """Hot events and hot team days of an inventory, as lists or tables; None where they are not known and every key is spread."""

    events: Sequence | DataFrame | None = None
    team_days: Sequence | DataFrame | None = None


def join_all(
    inventory: DataFrame, events: DataFrame, performance: DataFrame, salt: int = SALT, hot: HotKeys = HotKeys()
) -> DataFrame:
    """Event join, team-day key, performance join."""
    keyed = add_joined_key(join_event_meta(inventory, events, salt=salt, hot=hot.events))
    return join_team_day(keyed, performance, salt, hot.team_days)
