"""Whole jobs composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatgrid.functions.times import days_difference
from seatgrid.operators.encoding import DEFAULT_COLUMNS, FittedEncoder, encode_indexed, fit_encoder
from seatgrid.operators.events import latest_event_date, resolve_events, team_audit
from seatgrid.operators.joins import (
    HOT_SHARE,
    JOINED_KEY,
    SALT,
    HotKeys,
    add_joined_key,
    hot_key_table,
    hot_keys,
    join_all,
    join_event_meta,
    keyed_join,
)
from seatgrid.operators.ordering import order_listings, order_price_curve, range_snapshots, sort_ranges, with_time_to_event
from seatgrid.operators.performance import KEY as PERFORMANCE_KEY
from seatgrid.operators.performance import prepare_performance
from seatgrid.operators.quality import Watched, join_coverage, load_loss_report, require_all_columns, watched_coverage
from seatgrid.operators.sections import SECTION_COLUMNS, flatten_sections, keep_section_fields, snapshot_rows
from seatgrid.schemas import INVENTORY, META
from seatgrid.session import PACKED_TABLE, drop_scratch, freed_shuffles, scratch_path
from seatgrid.sources.collections import clean_load, read_json_collection, read_parquet_collection
from seatgrid.sources.discovery import discover_meta, discover_performance
from seatgrid.sources.sinks import split_by_event, write_csv, write_parquet_run


def price_through_time(inventory: DataFrame, meta: DataFrame, salt: int = SALT, ordered: bool = True) -> DataFrame:
    """Section prices by days to the event, for events with metadata, latest-dated first."""
    joined = join_event_meta(_priced_snapshots(inventory), latest_event_date(meta), salt=salt)
    curve = _price_curve(joined).withColumn("eventId", F.col("eventId").cast("int"))
    return order_price_curve(curve) if ordered else curve


def price_through_time_by_grouping(inventory: DataFrame, meta: DataFrame, salt: int = SALT) -> DataFrame:
    """The earlier form: events keyed by their first grouping, inventory without an event kept, no order."""
    dates = latest_event_date(meta, event_key="grouping")
    joined = join_event_meta(_priced_snapshots(inventory), dates, how="left_outer", salt=salt)
    return _price_curve(joined).drop("eventId")


PRICE_FIELDS = ["sectionId", "averageTicketPrice"]


def _priced_snapshots(inventory: DataFrame) -> DataFrame:
    return keep_section_fields(snapshot_rows(inventory), PRICE_FIELDS)


def _price_curve(joined: DataFrame) -> DataFrame:
    timed = joined.withColumn("days_difference", days_difference("timestamp", "event_date"))
    return flatten_sections(timed, carry=["days_difference"], fields=PRICE_FIELDS).select(
        "days_difference",
        F.col("sectionId").cast("int").alias("sectionId"),
        F.col("averageTicketPrice").cast("float").alias("averageTicketPrice"),
        "eventId",
    )


def _utc_day() -> Column:
    return F.floor(F.substring(F.col("timestamp").cast("string"), 1, 10).cast("bigint") / 86400)


def _by_event_and_day(snapshots: DataFrame, *keys: str) -> DataFrame:
    """Rows counted by event, UTC day and ``keys``, with their ``weight`` and one ``timestamp`` of the day."""
    # Any instant of a day gives the same team-day key, so the first stands for all.
    counts = snapshots.groupBy("eventId", *keys, _utc_day().alias("_day")).agg(
        F.count(F.lit(1)).alias("weight"), F.min("timestamp").alias("timestamp")
    )
    return counts.drop("_day")


def hot_listing_keys(
    inventory: DataFrame, events: DataFrame, share: float = HOT_SHARE, stage: str | None = None, tables: bool = False
) -> HotKeys:
    """The events and the team days that hold more than ``share`` of the snapshots, from counts per event and day.

    ``inventory`` is best a stored frame; the counts are kept under ``stage``. With ``tables`` the keys are kept there, too, and given
    as tables, for a share that very many keys may hold. Without it, days are counted only where a whole day, of which a team's is a
    part, holds that share.
    """
    stage = stage or scratch_path(inventory.sparkSession, "structure")
    snapshots, homes, weight = snapshot_rows(inventory), events.select("id", "Home_Team_Name"), F.col("weight")
    # One row per event (and day): no event is hot among the counts, so nothing is spread.
    if tables:
        counts = _staged(_by_event_and_day(snapshots), f"{stage}/event_days")
        keyed = add_joined_key(join_event_meta(counts, homes, salt=1))
        return HotKeys(
            _staged(hot_key_table(counts, "eventId", share, weight), f"{stage}/hot_events"),
            _staged(hot_key_table(keyed, JOINED_KEY, share, weight), f"{stage}/hot_team_days"),
        )
    counts = _staged(snapshots.groupBy("eventId").agg(F.count(F.lit(1)).alias("weight")), f"{stage}/event_counts")
    hot_events = hot_keys(counts, "eventId", share, weight)
    matched = join_event_meta(counts, homes, salt=1).agg(F.sum(weight)).first()[0] or 0
    days = hot_keys(snapshots.select(_utc_day().alias("_day")), "_day", share, total=matched)
    if not days:
        return HotKeys(hot_events, [])
    counted = _by_event_and_day(snapshots.filter(_utc_day().isin(*days)))
    keyed = add_joined_key(join_event_meta(counted, homes, salt=1))
    return HotKeys(hot_events, hot_keys(keyed, JOINED_KEY, share, weight, matched))


def join_listings(inventory: DataFrame, events: DataFrame, performance: DataFrame, strict: bool = False,
                  salt: int = SALT, hot: HotKeys = HotKeys()) -> DataFrame:
    """Section rows with event, performance and time features, from one-row-per-key events and performance.

    Both joins and all features work on snapshots; the sections are flattened out at the end.
    """
    return _flattened(*_joined_snapshots(inventory, events, performance, strict, salt, hot))


def _joined_snapshots(inventory: DataFrame, events: DataFrame, performance: DataFrame, strict: bool, salt: int,
                      hot: HotKeys) -> tuple[DataFrame, list[str]]:
    """Snapshots with all features, and the names of the columns they have got."""
    snapshots = snapshot_rows(inventory)
    joined = with_time_to_event(join_all(snapshots, events, performance, salt, hot), strict)
    reserved = set(SECTION_COLUMNS.values()) & set(joined.columns)
    if reserved:
        raise ValueError(f"columns named like section columns: {', '.join(sorted(reserved))}")
    return joined, [name for name in joined.columns if name not in snapshots.columns]


def _flattened(joined: DataFrame, features: Sequence[str]) -> DataFrame:
    return flatten_sections(joined, carry=features)


def listing_coverage(inventory: DataFrame, events: DataFrame, performance: DataFrame, salt: int = SALT) -> DataFrame:
    """:func:`join_coverage` of the listings, counted on snapshots by their number of sections."""
    joined = join_all(snapshot_rows(inventory), events, performance, salt)
    return join_coverage(joined, weight=F.coalesce(F.array_size("section_stats"), F.lit(0)))


def label_basis(
    inventory: DataFrame, events: DataFrame, performance: DataFrame | None = None, salt: int = SALT
) -> DataFrame:
    """Columns of the listings other than their times and prices, in fewer rows, each with its ``weight``.

    One row per event and section; with ``performance``, per event, section and team day, with its columns too. The
    counts are combined before the joins, so fitting labels never moves single listings.
    """
    if performance is None:
        counts = flatten_sections(snapshot_rows(inventory)).groupBy("eventId", "sectionId").agg(
            F.count(F.lit(1)).alias("weight")
        )
        # One row per event and section (and day): no event is hot among the counts, so the events go out once.
        return join_event_meta(counts, events, salt=1)
    # The team-day key needs the home team, so events come first.
    counts = _by_event_and_day(flatten_sections(snapshot_rows(inventory)), "sectionId")
    keyed = add_joined_key(join_event_meta(counts, events, salt=1))
    return keyed_join(keyed, performance, JOINED_KEY, PERFORMANCE_KEY, "left_outer", salt)


def fit_listing_encoder(
    inventory: DataFrame, events: DataFrame, performance: DataFrame, columns: Sequence[str] = tuple(DEFAULT_COLUMNS),
    strict: bool = False, salt: int = SALT, path: str | None = None, unseen: str = "skip",
) -> FittedEncoder:
    """An encoder of listing columns, fitted on counts per event and section where the columns allow it, kept under ``path``."""
    basis, weight = label_basis(inventory, events, salt=salt), F.col("weight")
    if not set(columns) <= set(basis.columns):
        basis = label_basis(inventory, events, performance, salt)
    if not set(columns) <= set(basis.columns):
        basis, weight = join_listings(inventory, events, performance, strict, salt), None  # times or prices of single listings
    return fit_encoder(basis, columns, weight, path, unseen)


def structure_prepared(
    inventory: DataFrame,
    events: DataFrame,
    performance: DataFrame,
    columns: Sequence[str] = tuple(DEFAULT_COLUMNS),
    include_dense: bool = False,
    ordered: bool = True,
    strict: bool = False,
    salt: int = SALT,
    vectors: bool = True,
    stage: str | None = None,
    encoder: FittedEncoder | None = None,
    coverage: Watched | None = None,
    hot: HotKeys = HotKeys(),
    spent: Sequence[str] = (),
) -> DataFrame:
    """:func:`structure_all` from resolved events and prepared performance, best from stored ones.

    An index is attached where its column is constant: to the events, to the team days, and only those of sections to the section
    rows. ``encoder`` (its columns then count) is one fitted before, by default one is fitted here. ``coverage`` watches the
    joined rows, those included whose labels leave them out of the table; they are dropped last, after the sort. ``hot`` names the
    keys whose rows the joins spread, by default all. ``spent`` are folders that nothing reads once the joined rows are stored, if
    they are; they and the indexed tables are deleted then.
    """
    stage = stage or scratch_path(inventory.sparkSession, "structure")
    if encoder is None:
        encoder = fit_listing_encoder(inventory, events, performance, columns, strict, salt, f"{stage}/encoder")
    columns = encoder.columns

    def indexed(side: DataFrame, name: str) -> DataFrame:
        own = [column for column in columns if column in side.columns]
        return _staged(encoder.attach(side, own, salt), f"{stage}/{name}_indexed") if own else side

    joined, features = _joined_snapshots(
        inventory, indexed(events, "events"), indexed(performance, "team_days"), strict, salt, hot
    )
    indexes = [f"{column}_indexed" for column in columns]
    rest = [column for column, index in zip(columns, indexes) if index not in features]
    # Where the hot events are listed, the sort shuffles snapshots; the indexes of sections then come without another shuffle.
    nested = ordered and hot.events is not None and not isinstance(hot.events, DataFrame) and encoder.few_labels(rest)
    if nested:
        # Stored, so that the joins run once and their shuffles are gone when the rows are laid out.
        joined = range_snapshots(_staged(joined.filter(F.size("section_stats") > 0), f"{stage}/joined"), hot.events)
        if spent:
            drop_scratch(inventory.sparkSession, *spent, f"{stage}/events_indexed", f"{stage}/team_days_indexed")
    listings = _flattened(joined, features)
    plain = [name for name in listings.columns if name not in indexes]
    rows = encoder.attach(listings, rest, salt, in_place=nested).select(*plain, *indexes)
    # The sort comes after the last join; encoding then adds columns row by row and keeps the order.
    if ordered:
        rows = sort_ranges(rows) if nested else order_listings(rows)
    if coverage is not None:
        rows = coverage.over(rows)
    return encode_indexed(encoder.settle(rows), columns, include_dense, vectors)


def structure_all(
    inventory: DataFrame, meta: DataFrame, performance: DataFrame, stage: str | None = None, **options
) -> DataFrame:
    """The full table: listings with team, calendar, performance and time features, one-hot encoded.

    Events and team days are computed once and kept under ``stage``, a shared folder, by default in the session's: both
    the fit of the labels and the listings read them. Fitting the labels runs jobs, and so do the joins where a listing order is asked
    for; the rest is one lazy plan.
    """
    stage = stage or scratch_path(inventory.sparkSession, "structure")
    events, team_days = stored_parts(meta, performance, options.get("strict", False), stage)
    if "hot" not in options:
        options["hot"] = hot_listing_keys(inventory, events, HOT_SHARE, stage)
    return structure_prepared(inventory, events, team_days, stage=stage, **options)


def stored_parts(meta: DataFrame, performance: DataFrame, strict: bool = False, stage: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Resolved events and prepared performance, worked out once and kept under ``stage``."""
    stage = stage or scratch_path(meta.sparkSession, "parts")
    events = _staged(resolve_events(meta, strict), f"{stage}/events")
    return events, _staged(prepare_performance(performance), f"{stage}/team_days")


@dataclass
class StructuredRun:
    path: str
    split_path: str | None
    loss_report: DataFrame
    null_audit: DataFrame
    join_coverage: DataFrame


def run_structure_all(
    spark: SparkSession,
    inventory_path: str,
    meta_path: str,
    performance_path: str,
    performance_schema: str | None,
    base: str,
    label: str,
    ts: datetime | None = None,
    split_path: str | None = None,
    split_format: str = "csv",
    split_buckets: int | None = None,
    stage: str | None = None,
    hot_share: float | None = HOT_SHARE,
    keep_lines: bool = True,
    **options,
) -> StructuredRun:
    """JSON collections to a Parquet run, then to one sub-folder per event, or ``split_buckets`` folders of events.

    Without a ``performance_schema`` the collections are read once more to find it, and to see whether performers have roles.

    The parsed collections, the events and the performance rows are kept as Parquet under ``stage``, so the
    JSON is parsed once, the fit and the write read columns, and the joins are planned by true file sizes. The reports are
    gathered while these tables and the run are written: lines lost, null teams, and the share of listings with a performance row.
    Events and team days with more than ``hot_share`` of the snapshots are spread over tasks in the joins; None spreads all.

    Without a ``stage`` of the caller's these tables are deleted as soon as nothing reads them any more. ``keep_lines=False`` gives
    the JSON collections to the job, which deletes each when it is parsed. The split takes its vectors from the run's indexes
    again, behind the shuffle, so that they are not shuffled.
    """
    with freed_shuffles(spark):
        return _run_structure_all(
            spark, inventory_path, meta_path, performance_path, performance_schema, base, label, ts, split_path, split_format,
            split_buckets, stage, hot_share, keep_lines, options,
        )


def _run_structure_all(
    spark: SparkSession, inventory_path: str, meta_path: str, performance_path: str, performance_schema: str | None, base: str,
    label: str, ts: datetime | None, split_path: str | None, split_format: str, split_buckets: int | None, stage: str | None,
    hot_share: float | None, keep_lines: bool, options: dict,
) -> StructuredRun:
    kept, stage = stage is not None, stage or scratch_path(spark, "structure")
    sources = {
        "inventory": (inventory_path, INVENTORY),
        "meta": (meta_path, META if performance_schema is not None else discover_meta(spark, meta_path)),
        "performance": (performance_path, performance_schema or discover_performance(spark, performance_path)),
    }
    reports = {}

    def load(name: str) -> DataFrame:
        path, schema = sources[name]
        rows, reports[name] = clean_load(spark, path, schema, name, stage=f"{stage}/{name}")
        if not keep_lines:
            drop_scratch(spark, path)
        return rows

    def spend(*names: str) -> list[str]:
        return [] if kept else [f"{stage}/{name}" for name in names]

    # The inventory is parsed last, when the others' parsed rows are gone.
    audit, coverage = team_audit(), watched_coverage()
    events = _staged(resolve_events(load("meta"), options.get("strict", False), audit), f"{stage}/events")
    drop_scratch(spark, *spend("meta"))
    performance = _staged(prepare_performance(load("performance")), f"{stage}/team_days")
    drop_scratch(spark, *spend("performance"))
    inventory = load("inventory")

    hot = HotKeys() if hot_share is None else hot_listing_keys(inventory, events, hot_share, stage)

    structured = structure_prepared(
        inventory, events, performance, stage=stage, coverage=coverage, hot=hot, spent=spend("inventory", "events", "team_days"), **options
    )
    path = write_parquet_run(structured, base, label, ts)
    if not kept:
        drop_scratch(spark, stage)
    if split_path is not None:
        written = read_parquet_collection(spark, path)
        columns = options["encoder"].columns if options.get("encoder") else options.get("columns", DEFAULT_COLUMNS)
        finish = None
        if columns:
            names = written.columns
            last = max(names.index(f"{column}_indexed") for column in columns)
            written = written.select(*[f"`{name}`" for name in names[: last + 1]])

            def finish(rows: DataFrame) -> DataFrame:
                return encode_indexed(rows, columns, options.get("include_dense", False), options.get("vectors", True))

        split_by_event(
            written, split_path, split_format, order_by=["sectionId", "Time_to_event"], buckets=split_buckets, finish=finish
        )
    loss = reduce(DataFrame.unionByName, [reports[name] for name in sources])
    return StructuredRun(path, split_path, loss, audit.report(spark), coverage.report(spark))


def run_price_through_time(
    spark: SparkSession,
    inventory_path: str,
    meta_path: str,
    base: str,
    label: str,
    ts: datetime | None = None,
    by_grouping: bool = False,
    salt: int = SALT,
    stage: str | None = None,
) -> str:
    """JSON collections to a Parquet run of the price curve; the earlier form takes its rows uncleaned."""
    if by_grouping:
        inventory = read_json_collection(spark, inventory_path, INVENTORY)
        meta = read_json_collection(spark, meta_path, META)
        curve = price_through_time_by_grouping(inventory, meta, salt)
    else:
        stage = stage or scratch_path(spark, "curve")
        inventory, _ = clean_load(spark, inventory_path, INVENTORY, "inventory", f"{stage}/inventory")
        meta, _ = clean_load(spark, meta_path, META, "meta", f"{stage}/meta")
        curve = price_through_time(inventory, meta, salt)
    return write_parquet_run(curve, base, label, ts)


def _staged(df: DataFrame, path: str) -> DataFrame:
    with freed_shuffles(df.sparkSession):
        df.write.options(**PACKED_TABLE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reexport(spark: SparkSession, source: str, target: str, header: bool = False) -> DataFrame:
    """Parquet to CSV without the rows that have a null; returns the loss report."""
    df = read_parquet_collection(spark, source)
    write_csv(require_all_columns(df), target, header)
    return load_loss_report(df, source.rstrip("/").rsplit("/", 1)[-1], required=df.columns)
