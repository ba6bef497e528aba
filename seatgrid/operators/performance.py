"""Team performance: one row per team and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatgrid.functions.times import team_day_key

KEY = "Concatenated_perf"


def add_team_day(performance: DataFrame) -> DataFrame:
    return performance.withColumn(KEY, team_day_key("team", "current_timestamp"))


def dedup_team_day(keyed: DataFrame) -> DataFrame:
    """The latest row of each key, ties broken by the other columns; the null keys form one group.

    Spark limits the row number to 1 on each map task before the shuffle, so a hot key sends one row per
    task however many it has.
    """
    others = [
        F.col(field.name) for field in keyed.schema
        if field.name not in (KEY, "current_timestamp") and not isinstance(field.dataType, T.MapType)
    ]
    latest = Window.partitionBy(KEY).orderBy(F.col("current_timestamp").desc_nulls_last(), *others)
    return keyed.withColumn("_rank", F.row_number().over(latest)).filter(F.col("_rank") == 1).drop("_rank")


def prepare_performance(performance: DataFrame) -> DataFrame:
    return dedup_team_day(add_team_day(performance))
