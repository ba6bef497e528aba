"""Row cleaning and the reports on what it drops.

Every report is one aggregate, one row. It is taken over a frame by a function that returns it, or, as a :class:`Watched`
report, gathered in passing while the frame is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatgrid.schemas import CORRUPT


def _present(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Per column, that it holds a value; like ``na.drop``, a NaN counts as missing.

    Single conditions, unlike ``na.drop``, reach the file scan and either side of a join.
    """
    conditions = []
    for name in columns:
        conditions.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            conditions.append(~F.isnan(name))
    return conditions


def drop_corrupt(df: DataFrame) -> DataFrame:
    """Keep the lines that parsed, without the corrupt-line column."""
    if CORRUPT not in df.columns:
        return df
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``."""
    return reduce(DataFrame.filter, _present(df, columns), df)


def require_all_columns(df: DataFrame) -> DataFrame:
    """Drop rows with a null anywhere."""
    return require_columns(df, df.columns)


def _percent(part: Column, whole: Column) -> Column:
    """Null, not an error, for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


class Watched:
    """A report whose counts are observed while a frame is written, with no pass of their own.

    Put :meth:`over` a frame and write that, once; :meth:`report` then gives the report and waits for the write until then.
    The counts are exact also when tasks are run again, as long as nothing is shuffled between the frame and its write:
    Spark counts a task that writes once, one that shuffles as often as it runs.
    """

    def __init__(self, counts: Sequence[Column], names: Sequence[str], finish: Callable[[DataFrame], DataFrame]):
        self.observation, self.counts, self.names, self.finish = Observation(), list(counts), list(names), finish

    def over(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, *self.counts)

    def report(self, spark: SparkSession) -> DataFrame:
        seen = self.observation.get  # empty where the plan turned out to have no rows
        schema = ", ".join(f"`{name}` bigint" for name in self.names)
        return self.finish(spark.createDataFrame([tuple(seen.get(name) or 0 for name in self.names)], schema))


LOSS_COUNTS = ("rows_before", "rows_after")


def _loss_counts(df: DataFrame, required: Sequence[str]) -> list[Column]:
    kept = F.lit(True)
    if CORRUPT in df.columns:
        kept = F.col(CORRUPT).isNull()
    for condition in _present(df, required):
        kept = kept & condition
    return [F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_after")]


def _loss_row(counts: DataFrame, dataset: str) -> DataFrame:
    lost = F.col("rows_before") - F.col("rows_after")
    return counts.select(
        F.lit(dataset).alias("dataset"), "rows_before", "rows_after",
        _percent(lost, F.col("rows_before")).alias("pct_dropped"),
    )


def load_loss_report(df: DataFrame, dataset: str, required: Sequence[str] = ("current_timestamp",)) -> DataFrame:
    """Rows read, rows kept by :func:`drop_corrupt` and :func:`require_columns`, and the percentage lost."""
    return _loss_row(df.agg(*_loss_counts(df, required)), dataset)


def watched_loss(df: DataFrame, dataset: str, required: Sequence[str] = ("current_timestamp",)) -> Watched:
    """:func:`load_loss_report`, to be gathered while ``df`` is written."""
    return Watched(_loss_counts(df, required), LOSS_COUNTS, lambda counts: _loss_row(counts, dataset))


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each column."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])


def watched_audit(columns: Sequence[str], counted: Callable[[str], Column]) -> Watched:
    """:func:`null_audit` from rows that each stand for several: ``counted`` gives a column's nulls in one of them."""
    return Watched([F.sum(counted(name)).alias(name) for name in columns], columns, lambda counts: counts)


COVERAGE_COUNTS = ("total", "unmatched")


def _coverage_sums(key: str, rows: Column) -> list[Column]:
    return [F.sum(rows).alias("total"), F.sum(F.when(F.col(key).isNull(), rows)).alias("unmatched")]


def _coverage_row(sums: DataFrame) -> DataFrame:
    counts = sums.select(F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("unmatched", F.lit(0)).alias("unmatched"))
    matched = F.col("total") - F.col("unmatched")
    return counts.select("total", "unmatched", _percent(matched, F.col("total")).alias("pct_matched"))


def join_coverage(df: DataFrame, key: str = "Concatenated_perf", weight: Column | None = None) -> DataFrame:
    """Rows of a left join, rows without a partner, and the percentage with one.

    ``weight`` is the number of rows that one row of ``df`` stands for.
    """
    return _coverage_row(df.agg(*_coverage_sums(key, (F.lit(1) if weight is None else weight).cast("bigint"))))


def watched_coverage(key: str = "Concatenated_perf") -> Watched:
    """:func:`join_coverage`, to be gathered while the joined rows are written."""
    return Watched(_coverage_sums(key, F.lit(1).cast("bigint")), COVERAGE_COUNTS, _coverage_row)
