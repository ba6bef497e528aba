"""Joins, the team-day choice, orders, and how they hold up under a hot key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from seatgrid.operators.events import latest_event_date
from seatgrid.operators.joins import add_joined_key, hot_key_table, hot_keys, join_all, join_event_meta, join_team_day, prefixed
from seatgrid.operators.ordering import order_listings, range_snapshots, sort_ranges, top_listings
from seatgrid.operators.performance import dedup_team_day, prepare_performance
from seatgrid.operators.sections import explode_sections, flatten_sections
from seatgrid.operators.encoding import label_frequencies
from seatgrid.operators.quality import join_coverage, require_columns
from seatgrid.plans import jobs
from seatgrid.plans.jobs import join_listings, price_through_time, structure_all
from seatgrid.plans.queries import QUERIES, inventory, meta, performance
from seatgrid.sources.tables import inventory_rows, meta_rows

SF_DIR = "/root/testdata/sf0.001"
DAY = 86_400_000


def rows(df):
    return sorted(map(str, df.collect()))


def hot_inventory(spark, count=6000):
    """A third of the snapshots belong to one event."""
    return spark.range(count).selectExpr(
        "id AS timestamp", "if(id % 3 = 0, 1, id) AS eventId", "array(named_struct('sectionId', id)) AS section_stats"
    )


def test_salted_joins_equal_plain_ones(spark):
    left = hot_inventory(spark)
    right = spark.range(3000).selectExpr("id", "concat('d', id) AS event_date")
    for how in ("inner", "left_outer"):
        plain = join_event_meta(left, right, how)
        assert rows(join_event_meta(left, right, how, salt=7)) == rows(plain)
        assert plain.columns == ["timestamp", "eventId", "section_stats", "event_date"]
    assert join_event_meta(left, right, "left_outer").count() == 6000


def test_hot_keys_are_counted(spark):
    left = hot_inventory(spark)
    assert hot_keys(left, "eventId") == [1]
    assert hot_keys(left, "eventId", 0.4) == []
    pairs = left.groupBy("eventId").agg(F.count(F.lit(1)).alias("w"))
    assert hot_keys(pairs, "eventId", weight=F.col("w")) == [1]
    assert hot_keys(left.limit(0), "eventId") == []
    nulls = left.withColumn("eventId", F.when(F.col("eventId") > 1, F.col("eventId")))
    assert hot_keys(nulls, "eventId") == []
    with pytest.raises(ValueError):
        hot_keys(left, "eventId", 0)


@pytest.mark.parametrize("hot", [[], [1], [1, 2, 5000]])
def test_only_hot_keys_are_copied(spark, hot):
    left = hot_inventory(spark)
    right = spark.range(3000).selectExpr("id", "concat('d', id) AS event_date")
    for how in ("inner", "left_outer"):
        joined = join_event_meta(left, right, how, salt=7, hot=hot)
        assert rows(joined) == rows(join_event_meta(left, right, how, salt=1))
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert ("explode" in plan) == bool(hot)
    copies = right.withColumn("n", F.explode(F.when(F.col("id").isin(*hot), F.sequence(F.lit(0), F.lit(6))).otherwise(F.array(F.lit(0))))) if hot else right
    assert copies.count() == 3000 + 6 * sum(1 for key in hot if key < 3000)


def test_hot_keys_may_be_a_table(spark):
    """Half of many keys are hot, and one of them is null on the right and none on the left; no list of them enters the plan."""
    left = spark.range(9000).selectExpr("id AS timestamp", "IF(id % 10 = 0, NULL, id % 4000) AS eventId")
    right = spark.range(5000).selectExpr("IF(id = 4999, NULL, id) AS id", "concat('d', id) AS event_date")
    hot = hot_key_table(left, "eventId", 2.5 / 9000)
    assert sorted(row[0] for row in hot.collect()) == hot_keys(left, "eventId", 2.5 / 9000) != []
    for how in ("inner", "left_outer"):
        joined = join_event_meta(left, right, how, salt=7, hot=hot)
        assert rows(joined) == rows(join_event_meta(left, right, how, salt=1))
        assert joined.columns == ["timestamp", "eventId", "event_date"]
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "explode" in plan and "INSET" not in plan and " IN (" not in plan


def test_hot_events_and_team_days_of_an_inventory(spark):
    """One event has a third of the snapshots; a team's day is hot through many events that are not."""
    day = 1_510_250_000_000
    snapshots = spark.range(6000).selectExpr(
        f"{day}L + IF(id % 3 = 1, 0, id) * {DAY}L AS current_timestamp", "IF(id % 3 = 0, 1, id) AS eventId",
        "1L AS totalListings", "1L AS totalTickets", "array(named_struct('sectionId', id)) AS section_stats",
    )
    events = spark.range(6000).selectExpr("id", "IF(id % 3 = 1, 'Home', concat('T', id)) AS Home_Team_Name")
    found = jobs.hot_listing_keys(snapshots, events)
    assert (found.events, found.team_days) == ([1], ["Home#2017#11#9"])
    nothing = jobs.hot_listing_keys(snapshots.limit(0), events)
    assert (nothing.events, nothing.team_days) == ([], [])
    tables = jobs.hot_listing_keys(snapshots, events, tables=True)
    assert ([row[0] for row in tables.events.collect()], [row[0] for row in tables.team_days.collect()]) == ([1], ["Home#2017#11#9"])


def test_counts_go_to_events_that_are_sent_out_once(spark):
    """Counts per event and section hold no hot event, and so the events are not copied for them."""
    basis = jobs.label_basis(inventory(spark, SF_DIR), QUERIES["resolve_events"](spark, SF_DIR))
    assert "_right_salt" not in basis._jdf.queryExecution().analyzed().toString()


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "40",
}


@pytest.fixture
def skew_settings(spark):
    """Thresholds fit for small data, no broadcasts."""
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def split_plan(df):
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [None, [1]])
@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_a_hot_event_is_split_over_tasks(spark, skew_settings, how, hot):
    """The right side is the aggregate that the jobs pass, live."""
    left = hot_inventory(spark, 90_000).repartition(16)
    meta_like = spark.range(90_000).selectExpr(
        "id AS current_timestamp", "array(named_struct('id', id, 'eventDateUTC', concat('d', id))) AS events"
    )
    joined = join_event_meta(left, latest_event_date(meta_like), how, hot=hot).select("timestamp", "event_date")
    assert len(set(joined.collect())) == 90_000
    assert split_plan(joined)


def test_a_hot_team_day_is_split_over_tasks(spark, skew_settings):
    """The right side is the window that the jobs pass, live."""
    left = spark.range(90_000).selectExpr(
        "id AS eventId", "if(id % 3 = 0, 'Home', concat('T', id)) AS Home_Team_Name", "1510250000000L + id AS timestamp"
    ).repartition(16)
    team_days = prepare_performance(
        spark.range(90_000).selectExpr("if(id = 0, 'Home', concat('T', id)) AS team", "1510250000000L AS current_timestamp", "id AS wins")
    )
    joined = join_team_day(add_joined_key(left), team_days).select("eventId", "wins")
    got = {row.eventId: row.wins for row in joined.collect()}
    assert got == {i: 0 if i % 3 == 0 else i for i in range(90_000)}
    assert split_plan(joined)


def test_only_one_row_per_task_and_key_is_shuffled(spark):
    plan = dedup_team_day(keyed(spark, [("k", 1, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def keyed(spark, entries):
    return spark.createDataFrame(entries, "Concatenated_perf string, current_timestamp bigint, wins int")


def test_latest_row_of_a_team_day(spark):
    df = keyed(spark, [
        ("a", 5, 1), ("a", 9, 7), ("a", 9, 3), ("a", None, 0), ("b", None, 4), (None, 1, 1), (None, 2, 2),
    ])
    got = {row.Concatenated_perf: (row.current_timestamp, row.wins) for row in dedup_team_day(df).collect()}
    assert got == {"a": (9, 3), "b": (None, 4), None: (2, 2)}


def test_columns_that_collide_are_named(spark):
    left = spark.createDataFrame([(1, "k")], "eventId bigint, Concatenated_joined string")
    right = spark.createDataFrame([("k", 4)], "Concatenated_perf string, eventId bigint")
    with pytest.raises(ValueError, match="both sides of the join: eventId"):
        join_team_day(left, right)
    joined = join_team_day(left, prefixed(right, "perf_"))
    assert joined.first().perf_eventId == 4


def test_left_join_keeps_the_row_count_and_nulls_stay_alone(spark):
    left = spark.createDataFrame([(1, "k"), (2, None), (3, "z")], "eventId bigint, Concatenated_joined string")
    right = spark.createDataFrame([("k", 4), (None, 5)], "Concatenated_perf string, wins int")
    for salt in (1, 4):
        got = {row.eventId: row.wins for row in join_team_day(left, right, salt).collect()}
        assert got == {1: 4, 2: None, 3: None}


def test_sections_may_be_flattened_before_or_after_the_joins(spark):
    snapshots = inventory(spark, SF_DIR)
    events = QUERIES["resolve_events"](spark, SF_DIR)
    prepared = prepare_performance(performance(spark, SF_DIR))
    early = join_all(explode_sections(snapshots), events, prepared)
    late = join_listings(snapshots, events, prepared).drop("Time_to_event")
    assert late.columns == early.columns
    assert rows(late) == rows(early)


def test_salted_job_equals_plain_job(spark):
    plain = price_through_time(inventory(spark, SF_DIR), meta(spark, SF_DIR))
    salted = price_through_time(inventory(spark, SF_DIR), meta(spark, SF_DIR), salt=5)
    assert rows(plain) == rows(salted)


def in_order(values):
    """Descending, nulls last, on each composite key."""
    keys = [tuple((v is None, 0 if v is None else -v) for v in value) for value in values]
    return keys == sorted(keys)


def test_listing_order(spark):
    df = spark.range(500).selectExpr(
        "id % 5 AS eventId", "id % 7 AS sectionId",
        "if(id % 11 = 0, NULL, cast((id * 37) % 101 AS double)) AS Time_to_event",
    )
    got = [tuple(row) for row in order_listings(df).collect()]
    assert in_order(got) and len(got) == 500
    assert [tuple(row) for row in top_listings(df, 9).collect()] == got[:9]


def test_price_curve_order(spark):
    got = QUERIES["price_through_time"](spark, SF_DIR).select("eventId", "days_difference").collect()
    assert in_order([tuple(row) for row in got])


def test_structured_table_order_and_invariants(spark):
    table = structure_all(inventory(spark, SF_DIR), meta(spark, SF_DIR), performance(spark, SF_DIR))
    got = table.select("eventId", "sectionId", "Time_to_event", "cat_features").collect()
    assert in_order([tuple(row)[:3] for row in got])
    assert all(sum(row.cat_features.toArray()) == 5 for row in got)
    widths = [table.schema[f"{name}_indexed"].metadata["ml_attr"]["num_vals"] for name in jobs.DEFAULT_COLUMNS]
    assert len(got[0].cat_features) == sum(widths)


@pytest.mark.parametrize("hot", [[], [1], [1, 2003]])
def test_snapshots_in_ranges_give_the_listing_order(spark, hot):
    """One event has half of the rows; times and section ids are null in places, section lists empty, null or with a null in them."""
    snapshots = spark.range(6000).selectExpr(
        "id AS timestamp", "IF(id % 2 = 0, 1, id) AS eventId", "1L AS totalStadiumListings", "1L AS totalStadiumTickets",
        """CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN filter(array(named_struct('sectionId', id, 'price', 0.5D)), s -> false)
            ELSE array(named_struct('sectionId', IF(id % 7 = 0, NULL, id % 40), 'price', id * 1D), named_struct('sectionId', id % 9, 'price', 0D),
                       IF(id % 17 = 0, NULL, named_struct('sectionId', id % 9, 'price', 2D))) END AS section_stats""",
        "IF(id % 5 = 0, NULL, cast(id * 7919 % 1000 AS double)) AS Time_to_event",
    )

    def flat(df):
        return flatten_sections(df, carry=["Time_to_event"], fields=["sectionId"])

    ranged = range_snapshots(snapshots, hot)
    got = [tuple(row) for row in sort_ranges(flat(ranged)).select("eventId", "sectionId", "Time_to_event", "timestamp").collect()]
    assert in_order([row[:3] for row in got])
    assert sorted(map(str, got)) == sorted(str(tuple(row)) for row in flat(snapshots).select("eventId", "sectionId", "Time_to_event", "timestamp").collect())
    sent = ranged.count()
    assert sent == 6000 if not hot else sent > 6000  # a snapshot goes out once, but for the hot events
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = ranged.filter("eventId = 1").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert places > 1 if hot else places == 1


def test_the_ordered_table_shuffles_snapshots_once(spark, tmp_path):
    """Every shuffle of the last plan carries nested sections, and the rows are those of the plan without order."""
    parts = inventory(spark, SF_DIR), meta(spark, SF_DIR), performance(spark, SF_DIR)
    ordered = structure_all(*parts, stage=str(tmp_path / "ordered")).drop("cat_features")
    plan = ordered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Sort [" in plan and "], true" not in plan
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")
    unordered = structure_all(*parts, stage=str(tmp_path / "unordered"), ordered=False).drop("cat_features")
    assert sorted(map(str, ordered.collect())) == sorted(map(str, unordered.collect()))


def test_team_days_are_counted_on_days_that_can_hold_hot_ones(spark, tmp_path):
    """Matched snapshots are a twentieth of all; a day that holds one in a hundred of those is looked at, the others are not."""
    day = 1_510_250_000_000
    snapshots = spark.range(20_000).selectExpr(
        f"{day}L + IF(id < 11, 0, id) * {DAY}L AS current_timestamp", "id AS eventId",
        "1L AS totalListings", "1L AS totalTickets", "array(named_struct('sectionId', id)) AS section_stats",
    )
    events = spark.range(1000).selectExpr("id", "'Home' AS Home_Team_Name")
    found = jobs.hot_listing_keys(snapshots, events, stage=str(tmp_path / "stage"))
    assert (found.events, found.team_days) == ([], ["Home#2017#11#9"])
    assert not (tmp_path / "stage" / "event_days").exists()
    assert jobs.hot_listing_keys(snapshots.filter("eventId > 5"), events) == jobs.HotKeys([], [])


def test_only_section_labels_are_joined_to_the_section_rows(spark, tmp_path):
    """The four event columns have their indexes before the events meet the inventory."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = structure_all(
            inventory(spark, SF_DIR), meta(spark, SF_DIR), performance(spark, SF_DIR), stage=str(tmp_path / "stage"), ordered=False
        )
        plan = table._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Join ") == 3  # events, team days, sections
    events = spark.read.parquet(str(tmp_path / "stage" / "events_indexed"))
    assert {"Home_Team_Id_indexed", "Away_Team_Id_indexed", "DayofWeek_indexed", "GameTime_indexed"} <= set(events.columns)


def test_events_and_team_days_are_counted_before_the_joins(spark):
    """Ranks of a performance column from the combined counts equal those from the listings."""
    snapshots, events = inventory(spark, SF_DIR), QUERIES["resolve_events"](spark, SF_DIR)
    team_days = prepare_performance(performance(spark, SF_DIR))
    columns = ["GameTime", "team", "sectionId"]
    basis = jobs.label_basis(snapshots, events, team_days)
    combined = label_frequencies(basis, columns, F.col("weight"))
    assert rows(combined) == rows(label_frequencies(join_listings(snapshots, events, team_days), columns))


def test_coverage_on_snapshots_equals_coverage_of_the_rows(spark):
    snapshots, events = inventory(spark, SF_DIR), QUERIES["resolve_events"](spark, SF_DIR)
    team_days = prepare_performance(performance(spark, SF_DIR))
    assert rows(jobs.listing_coverage(snapshots, events, team_days)) == rows(join_coverage(join_listings(snapshots, events, team_days)))


def test_encoding_other_columns_fits_on_the_joined_rows(spark):
    table = structure_all(
        inventory(spark, SF_DIR), meta(spark, SF_DIR), performance(spark, SF_DIR),
        columns=["GameTime", "team"], include_dense=True, ordered=False,
    )
    assert table.filter(F.col("team").isNull()).count() == 0
    assert "cat_feature[0]" in table.columns


@pytest.mark.parametrize("name", ["structure_all", "price_through_time", "resolve_events", "label_frequencies"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "ExistingRDD"):
        assert python_node not in plan
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_scans_read_only_what_a_query_needs(spark):
    plan = QUERIES["latest_event_date"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan
    plan = QUERIES["distinct_events"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_receiptdate" not in plan and plan.count("Exchange") == 1  # the one of distinct


def test_filters_and_nested_fields_reach_the_scan(spark, tmp_path):
    stored = {}
    for name, rows_of in (("inventory", inventory_rows), ("meta", meta_rows)):
        rows_of(spark, SF_DIR).write.parquet(str(tmp_path / name))
        stored[name] = require_columns(spark.read.parquet(str(tmp_path / name)), ["current_timestamp"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = price_through_time(stored["inventory"], stored["meta"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    [scan] = [line for line in plan.splitlines() if "FileScan" in line and "eventId" in line]
    assert "IsNotNull(current_timestamp)" in scan
    read = scan.split("ReadSchema")[1]
    assert "averageTicketPrice" in read and "minTicketPrice" not in read and "totalListings" not in read
