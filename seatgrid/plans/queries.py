"""Catalog of queries: every operator over whole order tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatgrid.functions.times import days_difference, game_time, iso_weekday, parse_date, time_to_event, unread_dates
from seatgrid.operators.encoding import (
    DEFAULT_COLUMNS,
    encode_categoricals,
    feature_slots,
    fit_encoder,
    index_labels,
    label_frequencies,
    load_encoder,
    rank_labels,
)
from seatgrid.operators.events import (
    TEAM_COLUMNS,
    consolidate_events,
    event_dates,
    first_event,
    home_away_teams,
    latest_event_date,
    resolve_events,
)
from seatgrid.operators.joins import HotKeys, add_joined_key, join_event_meta, join_team_day
from seatgrid.operators.ordering import add_time_to_event, distinct_events, order_price_curve, top_listings
from seatgrid.operators.performance import add_team_day, dedup_team_day, prepare_performance
from seatgrid.operators.quality import (
    load_loss_report,
    null_audit,
    require_all_columns,
    require_columns,
)
from seatgrid.operators.sections import explode_sections
from seatgrid.plans.jobs import (
    StructuredRun,
    fit_listing_encoder,
    hot_listing_keys,
    join_listings,
    label_basis,
    listing_coverage,
    price_through_time,
    price_through_time_by_grouping,
    reexport,
    run_price_through_time,
    run_structure_all,
    stored_parts,
    structure_all,
    structure_prepared,
)
from seatgrid.schemas import INVENTORY, META, performance_schema
from seatgrid.session import PACKED_TEXT, ensure_scratch, scratch_path
from seatgrid.sources.collections import clean_load, copy_json, read_json_collection, read_parquet_collection
from seatgrid.sources.discovery import discover_meta, discover_performance, discover_schema
from seatgrid.sources.sinks import BUCKET, event_slice, read_split, split_by_event, write_csv, write_parquet_run
from seatgrid.sources.tables import inventory_rows, meta_rows, performance_rows, table, write_json_lines

PERFORMANCE_EXTRA = "wins bigint, score double"
CURVE_SCHEMA = "days_difference float, sectionId int, averageTicketPrice float, eventId int"

Query = Callable[[SparkSession, str], DataFrame]


def _timed(df: DataFrame) -> DataFrame:
    return require_columns(df, ["current_timestamp"])


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(inventory_rows(spark, sf_dir))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(meta_rows(spark, sf_dir))


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(performance_rows(spark, sf_dir))


# --- loading and cleaning, through files -----------------------------------------------------------------


def _json_inventory(spark: SparkSession, sf_dir: str) -> str:
    """Inventory as JSON lines, some cut short, some with text for the time."""
    path = scratch_path(spark, "inventory-json")
    write_json_lines(
        inventory_rows(spark, sf_dir), path,
        broken=F.col("eventId") % 97 == 3, mistyped=F.col("eventId") % 89 == 4,
    )
    return path


def _json_meta(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "meta-json")
    first_id = F.get("events", F.lit(0))["id"]
    write_json_lines(
        meta_rows(spark, sf_dir), path, broken=first_id % 97 == 3, mistyped=first_id % 89 == 4
    )
    return path


def _json_performance(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "performance-json")
    write_json_lines(
        performance_rows(spark, sf_dir), path, broken=F.col("score") < 1000, mistyped=F.col("wins") == 7
    )
    return path


def q_clean_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = clean_load(spark, _json_inventory(spark, sf_dir), INVENTORY, "inventory")
    return cleaned.select(
        F.col("current_timestamp").alias("timestamp"), "eventId", "totalListings", "totalTickets",
        F.array_size("section_stats").alias("sections"),
        F.get("section_stats", F.lit(1))["averageTicketPrice"].alias("second_price"),
    )


def q_clean_load_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of rows that are dropped for another column's type."""
    path = scratch_path(spark, "inventory-json")
    write_json_lines(
        inventory_rows(spark, sf_dir), path,
        broken=F.col("eventId") % 97 == 3, mistyped=F.col("eventId") % 89 == 4, field="totalListings",
    )
    return clean_load(spark, path, INVENTORY, "inventory")[0].select("eventId")


def q_discovered_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under a schema found in the lines, one field of which has two types and some of which are cut short."""
    path = _json_performance(spark, sf_dir)
    rows, _ = clean_load(spark, path, discover_performance(spark, path), "performance")
    return rows.select("team", F.col("current_timestamp").alias("timestamp"), "wins", "score")


def q_discovered_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field at any depth of the metadata lines and its type, and how many fields and lines there are."""
    found = discover_schema(spark, _json_meta(spark, sf_dir))

    def fields(kind, path: str = ""):
        if isinstance(kind, T.ArrayType):
            yield from fields(kind.elementType, path)
        elif isinstance(kind, T.StructType):
            for field in kind:
                yield from fields(field.dataType, f"{path}.{field.name}" if path else field.name)
        else:
            yield path, kind.simpleString()

    rows = list(fields(found))
    return spark.createDataFrame(rows, "field string, type string")


def q_home_first_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams out of JSON lines in which no performer has a role: the first one is at home."""
    path = scratch_path(spark, "meta-json")
    events = F.transform("events", lambda e: e.withField("performersCollection", F.transform(e["performersCollection"], lambda p: p.dropFields("role"))))
    meta_rows(spark, sf_dir).withColumn("events", events).write.options(**PACKED_TEXT).json(path)
    cleaned, _ = clean_load(spark, path, discover_meta(spark, path), "meta")
    return home_away_teams(cleaned).withColumnRenamed("current_date", "snapshot_date")


def q_json_null_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many null members the lines of a collection hold, before and after a copy that leaves them out at every depth."""
    source, target = scratch_path(spark, "meta-json"), scratch_path(spark, "meta-copy")
    meta_rows(spark, sf_dir).write.options(ignoreNullFields="false", **PACKED_TEXT).json(source)
    copy_json(spark, source, target, packed=True)

    def nulls(path: str, name: str) -> DataFrame:
        members = F.size(F.regexp_extract_all("value", F.lit(r'":null[,}]'), F.lit(0)))
        return spark.read.text(path).agg(
            F.lit(name).alias("file"), F.count(F.lit(1)).alias("lines"), F.sum(members).cast("bigint").alias("null_members")
        )

    return nulls(source, "source").union(nulls(target, "copy"))


def q_load_loss_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = [
        ("inventory", _json_inventory(spark, sf_dir), INVENTORY),
        ("meta", _json_meta(spark, sf_dir), META),
        ("performance", _json_performance(spark, sf_dir), performance_schema(PERFORMANCE_EXTRA)),
    ]
    reports = [clean_load(spark, path, schema, name)[1] for name, path, schema in loads]
    return reduce(DataFrame.unionByName, reports)


def q_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_path(spark, "meta-json"), scratch_path(spark, "meta-copy")
    meta_rows(spark, sf_dir).write.options(**PACKED_TEXT).json(source)
    copy_json(spark, source, target, packed=True)
    copied = first_event(read_json_collection(spark, target, META))
    event = F.col("event")

    def entry(array: str, place: int) -> Column:
        return F.get(event[array], F.lit(place))

    return copied.select(
        "timestamp", F.col("current_date").alias("snapshot_date"), event["id"].alias("id"),
        event["eventDateUTC"].alias("event_date_utc"), event["eventDateLocal"].alias("event_date_local"),
        event["originalName"].alias("original_name"),
        *[
            entry("performersCollection", place)[field].alias(f"{name}_{field}")
            for place, name in enumerate(("first", "second")) for field in ("id", "name", "role")
        ],
        F.array_size(event["performersCollection"]).alias("roles"),
        *[
            entry("performers", place)[field].alias(f"{name}_performer_{field}")
            for place, name in enumerate(("first", "second")) for field in ("id", "name")
        ],
        F.array_size(event["performers"]).alias("performers"),
        entry("groupingsCollection", 0)["id"].alias("grouping_id"),
        F.array_size(event["groupingsCollection"]).alias("groupings"),
    )


def q_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = price_through_time(inventory(spark, sf_dir), meta(spark, sf_dir))
    path = write_parquet_run(curve, scratch_path(spark, "runs"), "sample")
    return read_parquet_collection(spark, path)


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = price_through_time(inventory(spark, sf_dir), meta(spark, sf_dir), ordered=False)
    path = scratch_path(spark, "curve-csv")
    write_csv(curve, path, packed=True)
    return spark.read.schema(CURVE_SCHEMA).csv(path)


def _curve_by_grouping(spark: SparkSession, sf_dir: str) -> str:
    curve = price_through_time_by_grouping(inventory_rows(spark, sf_dir), meta_rows(spark, sf_dir))
    return write_parquet_run(curve, scratch_path(spark, "runs"), "grouping")


def q_reexport(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "reexport-csv")
    reexport(spark, _curve_by_grouping(spark, sf_dir), target)
    return spark.read.schema(CURVE_SCHEMA.removesuffix(", eventId int")).csv(target)


def q_reexport_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reexport(spark, _curve_by_grouping(spark, sf_dir), scratch_path(spark, "reexport-csv"))
    return report.select("rows_before", "rows_after", "pct_dropped")


def q_require_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_all_columns(home_away_teams(meta_rows(spark, sf_dir))).withColumnRenamed(
        "current_date", "snapshot_date"
    )


def q_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_audit(home_away_teams(meta(spark, sf_dir)), TEAM_COLUMNS)


# --- inventory and metadata ------------------------------------------------------------------------------


def q_explode_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_sections(inventory(spark, sf_dir))


def q_first_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_dates(meta(spark, sf_dir))


def q_first_grouping_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_dates(meta_rows(spark, sf_dir), event_key="grouping")


def q_home_away_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return home_away_teams(meta(spark, sf_dir)).withColumnRenamed("current_date", "snapshot_date")


def q_consolidate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate_events(home_away_teams(meta(spark, sf_dir)), require=["Away_Team_Id", "Home_Team_Id"])


def q_latest_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_event_date(meta(spark, sf_dir))


def q_latest_event_date_by_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_event_date(meta_rows(spark, sf_dir), event_key="grouping")


def q_weekday_game_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = F.col("event_date_local")
    return home_away_teams(meta(spark, sf_dir)).select(
        "timestamp", "id", iso_weekday(local).alias("DayofWeek"), game_time(local).alias("GameTime")
    )


def q_resolve_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_events(meta(spark, sf_dir))


# --- performance and joins -------------------------------------------------------------------------------


def q_team_day_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_team_day(performance_rows(spark, sf_dir)).withColumnRenamed("current_timestamp", "timestamp")


def q_dedup_team_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_team_day(add_team_day(performance_rows(spark, sf_dir))).withColumnRenamed(
        "current_timestamp", "timestamp"
    )


def q_prepare_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_performance(performance(spark, sf_dir)).withColumnRenamed("current_timestamp", "timestamp")


def q_join_event_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_event_meta(explode_sections(inventory(spark, sf_dir)), resolve_events(meta(spark, sf_dir)))


def q_join_event_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = latest_event_date(meta_rows(spark, sf_dir), event_key="grouping")
    return join_event_meta(explode_sections(inventory_rows(spark, sf_dir)), dates, how="left_outer")


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_listings(
        inventory(spark, sf_dir), resolve_events(meta(spark, sf_dir)),
        prepare_performance(performance(spark, sf_dir)),
    ).withColumnRenamed("current_timestamp", "perf_timestamp")


def q_join_team_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_event_meta(
        explode_sections(inventory(spark, sf_dir)),
        resolve_events(meta(spark, sf_dir)).select("id", "Home_Team_Name"),
    )
    return join_team_day(
        add_joined_key(joined), prepare_performance(performance(spark, sf_dir))
    ).withColumnRenamed("current_timestamp", "perf_timestamp")


def q_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listings(spark, sf_dir)


def _hot(snapshots: DataFrame, events: DataFrame) -> HotKeys:
    """Those with more snapshots than most events have; orders have seven at most, so that very many are hot."""
    return hot_listing_keys(snapshots, events, 5.5 / snapshots.count(), tables=True)


def q_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and team days that hold more than a share of the snapshots."""
    found = _hot(inventory(spark, sf_dir), resolve_events(meta(spark, sf_dir)))
    key = F.col("hot_key").cast("string").alias("key")
    return found.events.select(F.lit("event").alias("kind"), key).unionByName(found.team_days.select(F.lit("team day").alias("kind"), key))


def q_join_all_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined listings with only the hot keys spread."""
    snapshots = inventory(spark, sf_dir)
    events, team_days = stored_parts(meta(spark, sf_dir), performance(spark, sf_dir))
    joined = join_listings(snapshots, events, team_days, hot=_hot(snapshots, events))
    return joined.withColumnRenamed("current_timestamp", "perf_timestamp")


def q_join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_coverage(
        inventory(spark, sf_dir), resolve_events(meta(spark, sf_dir)), prepare_performance(performance(spark, sf_dir))
    )


# --- time features and orders ----------------------------------------------------------------------------


def _dated_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = latest_event_date(meta(spark, sf_dir)).withColumnRenamed("event_date", "event_date_utc")
    return join_event_meta(explode_sections(inventory(spark, sf_dir)), dates)


def q_time_to_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated_sections(spark, sf_dir).select(
        "timestamp", "eventId", "sectionId", "event_date_utc",
        time_to_event("timestamp", "event_date_utc").alias("Time_to_event"),
    )


def q_days_difference_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated_sections(spark, sf_dir).select(
        "timestamp", "eventId", "sectionId",
        days_difference("timestamp", "event_date_utc").alias("days_difference"),
    )


def q_ordered_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_time_to_event(_dated_sections(spark, sf_dir))


def q_price_curve_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = _dated_sections(spark, sf_dir).select(
        "eventId", "sectionId", "averageTicketPrice",
        days_difference("timestamp", "event_date_utc").alias("days_difference"),
    )
    return order_price_curve(curve)


def q_top_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _dated_sections(spark, sf_dir).withColumn(
        "Time_to_event", time_to_event("timestamp", "event_date_utc")
    )
    return top_listings(timed.select("eventId", "sectionId", "Time_to_event", "averageTicketPrice"), 20)


def q_written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's date and an hour of it, written in eight ways and some not at all, and read back."""
    orders = table(spark, sf_dir, "orders").withColumn("at", F.expr("o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT), CAST(o_orderkey % 60 AS INT))"))
    forms = [
        F.date_format("at", "MMMM d, yyyy h:mm a"), F.date_format("at", "MM/dd/yyyy"),
        F.concat(F.date_format("at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0700 (PDT)")), F.date_format("at", "d MMM yyyy 'at' H:mm"),
        F.date_format("at", "EEE MMM d HH:mm:ss 'UTC' yyyy"), F.date_format("at", "yyyy/M/d h:mm:ssa"), F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("to be announced for 2017"),
    ]
    written = F.element_at(F.array(*forms), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    read = orders.select("o_orderkey", written.alias("written"))
    wall = parse_date("written")
    return read.select(
        "o_orderkey", F.date_format(wall, "yyyy-MM-dd HH:mm:ss").alias("wall_clock"), iso_weekday("written").alias("weekday"),
        game_time("written").alias("game_time"), time_to_event(F.lit(0), "written").alias("days"),
    )


def q_unread_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unread_dates(home_away_teams(meta(spark, sf_dir)), "event_date_local")


# --- encoding --------------------------------------------------------------------------------------------


def _featured_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_events(meta(spark, sf_dir))


def q_label_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    basis = label_basis(inventory(spark, sf_dir), _featured_events(spark, sf_dir))
    return label_frequencies(basis, DEFAULT_COLUMNS, F.col("weight"))


def q_label_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    basis = label_basis(inventory(spark, sf_dir), _featured_events(spark, sf_dir))
    return rank_labels(label_frequencies(basis, DEFAULT_COLUMNS, F.col("weight")))


def _indexed_names(columns: list[str]) -> list[str]:
    return [f"{name}_indexed" for name in columns]


def q_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, snapshots = _featured_events(spark, sf_dir), inventory(spark, sf_dir)
    listings = join_event_meta(explode_sections(snapshots), events)
    indexed = index_labels(listings, DEFAULT_COLUMNS, label_basis(snapshots, events), F.col("weight"))
    return indexed.select("timestamp", "eventId", *DEFAULT_COLUMNS, *_indexed_names(DEFAULT_COLUMNS))


def q_label_index_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with few labels and one with as many labels as rows."""
    events = _featured_events(spark, sf_dir)
    columns = ["GameTime", "id", "Home_Team_Id"]
    return index_labels(events, columns).select(*columns, *_indexed_names(columns))


def _slots(column: str) -> Column:
    """The places of a vector's ones, as comma-separated text, read off the vector."""
    places = F.transform(vector_to_array(F.col(column)), lambda value, i: F.when(value == 1, i.cast("string")))
    return F.array_join(places, ",")


def q_one_hot_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_categoricals(_featured_events(spark, sf_dir), ["Home_Team_Id", "DayofWeek", "GameTime"])
    return encoded.select(
        "id",
        _slots("Home_Team_Id_indexed_encoded").alias("home_slot"),
        _slots("DayofWeek_indexed_encoded").alias("weekday_slot"),
        _slots("GameTime_indexed_encoded").alias("game_time_slot"),
        _slots("cat_features").alias("feature_slots"),
    )


def q_feature_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot numbers for columns of which one has as many labels as there are events."""
    encoded = encode_categoricals(_featured_events(spark, sf_dir), ["id", "DayofWeek"], vectors=False)
    return encoded.select("id", "DayofWeek", F.array_join(F.col("feature_slots").cast("array<string>"), ",").alias("feature_slots"))


def q_dense_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_categoricals(_featured_events(spark, sf_dir), ["DayofWeek", "GameTime"], include_dense=True)
    dense = [name for name in encoded.columns if name.startswith("cat_feature[")]
    return encoded.select("id", "DayofWeek", "GameTime", *[f"`{name}`" for name in dense])


def _encoded_later_events(spark: SparkSession, sf_dir: str, unseen: str) -> DataFrame:
    """Events with an odd id, encoded by what was fitted on the even ones and kept; days and teams some of which are new."""
    events = _featured_events(spark, sf_dir).withColumn("game_day", F.substring("event_date_local", 1, 10))
    columns, path = ["Away_Team_Id", "game_day", "GameTime"], scratch_path(spark, "encoder")
    fit_encoder(events.filter("id % 2 = 0"), columns, path=path)
    encoder = load_encoder(spark, path, unseen)
    encoded = encoder.transform(events.filter("id % 2 <> 0"), vectors=False)
    slots = F.array_join(F.col("feature_slots").cast("array<string>"), ",").alias("feature_slots")
    return encoded.select("id", *columns, *_indexed_names(columns), slots)


def q_encode_later_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded_later_events(spark, sf_dir, "keep")


def q_encode_later_events_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded_later_events(spark, sf_dir, "skip")


# --- splitting -------------------------------------------------------------------------------------------


def q_distinct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_events(explode_sections(inventory(spark, sf_dir)))


SPLIT_SCHEMA = "timestamp bigint, sectionId bigint, averageTicketPrice double, eventId bigint"
BUCKETS = 64


def _split(spark: SparkSession, sf_dir: str, file_format: str, buckets: int | None = None) -> DataFrame:
    rows = explode_sections(inventory(spark, sf_dir)).select("timestamp", "sectionId", "averageTicketPrice", "eventId")
    path = scratch_path(spark, f"events-{file_format}")
    split_by_event(rows, path, file_format, order_by=["sectionId"], buckets=buckets)
    schema = SPLIT_SCHEMA if buckets is None else f"{SPLIT_SCHEMA}, {BUCKET} int"
    return read_split(spark, path, schema, file_format, every_event=buckets is None)


def q_split_by_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for every event."""
    return _split(spark, sf_dir, "csv")


def q_split_by_event_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, in a fixed number of folders."""
    return _split(spark, sf_dir, "parquet", BUCKETS).drop(BUCKET)


def q_event_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_slice(_split(spark, sf_dir, "parquet", BUCKETS), 42, buckets=BUCKETS).drop(BUCKET)


# --- whole jobs ------------------------------------------------------------------------------------------


def q_price_through_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_through_time(inventory(spark, sf_dir), meta(spark, sf_dir))


def q_price_through_time_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_through_time_by_grouping(inventory_rows(spark, sf_dir), meta_rows(spark, sf_dir))


def _flat(structured: DataFrame) -> DataFrame:
    """The table without its vectors, the assembled one given by its slots."""
    slots = feature_slots(structured, DEFAULT_COLUMNS)
    plain = [name for name, kind in structured.dtypes if kind != "vector"]
    joined = F.array_join(F.col("feature_slots").cast("array<string>"), ",").alias("feature_slots")
    return slots.select(*plain, joined).withColumnRenamed("current_timestamp", "perf_timestamp")


def q_structure_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(
        structure_all(inventory(spark, sf_dir), meta(spark, sf_dir), performance(spark, sf_dir))
    )


def q_structure_all_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table through an encoder that was fitted and kept before."""
    snapshots, path = inventory(spark, sf_dir), scratch_path(spark, "encoder")
    events, team_days = stored_parts(meta(spark, sf_dir), performance(spark, sf_dir))
    fit_listing_encoder(snapshots, events, team_days, path=path)
    hot = hot_listing_keys(snapshots, events)
    return _flat(structure_prepared(snapshots, events, team_days, encoder=load_encoder(spark, path), hot=hot))


def _structured_run(spark: SparkSession, sf_dir: str, **options) -> StructuredRun:
    return run_structure_all(
        spark, _json_inventory(spark, sf_dir), _json_meta(spark, sf_dir), _json_performance(spark, sf_dir),
        performance_schema(PERFORMANCE_EXTRA), base=scratch_path(spark, "runs"), label="structured", keep_lines=False, **options,
    )


def q_structure_all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job from JSON files with bad lines to its Parquet run."""
    return _flat(read_parquet_collection(spark, _structured_run(spark, sf_dir).path))


def q_structure_all_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job counted while it wrote: lines lost, null teams, listings with a performance row; one number a row."""
    run = _structured_run(spark, sf_dir)
    reports = [
        ("loss", F.col("dataset"), run.loss_report, ["rows_before", "rows_after", "pct_dropped"]),
        ("nulls", F.lit("meta"), run.null_audit, TEAM_COLUMNS),
        ("coverage", F.lit("listings"), run.join_coverage, ["total", "unmatched", "pct_matched"]),
    ]
    numbers = [
        frame.select(
            F.lit(report).alias("report"), dataset.alias("dataset"),
            F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), F.col(name).cast("double").alias("value")) for name in names])).alias("n"),
        ).select("report", "dataset", "n.measure", "n.value")
        for report, dataset, frame, names in reports
    ]
    return reduce(DataFrame.unionByName, numbers)


def q_structure_all_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job on to its split by event."""
    path = scratch_path(spark, "structured-split")
    run = _structured_run(spark, sf_dir, split_path=path, split_format="parquet", split_buckets=BUCKETS)
    return _flat(read_parquet_collection(spark, run.split_path).drop(BUCKET))


def q_structured_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structured table as CSV with a header, vectors as text."""
    table = structure_all(inventory(spark, sf_dir), meta(spark, sf_dir), performance(spark, sf_dir), ordered=False)
    path = scratch_path(spark, "structured-csv")
    write_csv(table, path, header=True, packed=True)
    return spark.read.option("header", True).csv(path).select(
        F.col("timestamp").cast("bigint"), F.col("eventId").cast("bigint"), F.col("sectionId").cast("bigint"),
        "Home_Team_Name", "Concatenated_perf", F.col("Time_to_event").cast("double"), "GameTime_indexed_encoded", "cat_features",
    )


def q_price_through_time_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_price_through_time(
        spark, _json_inventory(spark, sf_dir), _json_meta(spark, sf_dir), scratch_path(spark, "runs"), "curve"
    )
    return read_parquet_collection(spark, path)


def q_price_through_time_v1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier form from JSON files, with the rows that have no time."""
    sources = {"inventory": inventory_rows(spark, sf_dir), "meta": meta_rows(spark, sf_dir)}
    paths = {name: scratch_path(spark, f"{name}-json") for name in sources}
    for name, rows in sources.items():
        rows.write.options(**PACKED_TEXT).json(paths[name])
    path = run_price_through_time(
        spark, paths["inventory"], paths["meta"], scratch_path(spark, "runs"), "curve", by_grouping=True
    )
    return read_parquet_collection(spark, path)


def _with_scratch(query: Query) -> Query:
    """The catalog cannot choose its caller's session, so a local one without a shared folder is given one."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_scratch(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): _with_scratch(function) for name, function in list(globals().items()) if name.startswith("q_")
}
