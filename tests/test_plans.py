"""The plans the operators are meant to have."""

import re

from pyspark.sql import functions as F

from eventloom import kv
from eventloom.operators import files, filters, nearest, paging
from eventloom.plans import driver_tables as dt
from eventloom.plans.log_table import LogTable
from eventloom.schema import AUTO, IDX, STREAM, TS, USER
from eventloom.sources.store import open_events, store_events
from tests.helpers import SF_SMALL, values


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path):
    path = str(tmp_path / "events")
    dt.one_stream(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_level_and_index_filters_reach_the_scan(spark, tmp_path):
    e = stored(spark, tmp_path)
    assert re.search(r"PushedFilters: \[.*In\(log_level, \[4,5,6\]\)", plan(filters.filter_events(e, [6, 5, 4])))
    page = plan(paging.page(e, 10, 20))
    assert "GreaterThanOrEqual(log_event_idx,10), LessThan(log_event_idx,20)" in page
    assert "EqualTo(log_event_idx,19)" in page


def test_predicates_read_only_their_field(spark, tmp_path):
    e = stored(spark, tmp_path)
    text = plan(filters.filter_events(e, predicate=kv("k") >= 50).select(IDX))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert AUTO not in schema and "user_kv:struct<" in schema


def test_counts_and_lookups_leave_key_values_unread(spark, tmp_path):
    e = stored(spark, tmp_path)
    for frame in (files.event_counts(e), files.file_infos(e), nearest.nearest_event(e, 5)):
        for schema in re.findall(r"ReadSchema: struct<(.*)>", plan(frame)):
            assert AUTO not in schema and USER not in schema


def test_no_sort_based_aggregates(spark, tmp_path):
    e = stored(spark, tmp_path)
    probes = e.select(STREAM, F.col(TS).alias("target_ts"))
    condition = filters.filter_condition([5], kv("k") >= 50)
    for frame in (
        nearest.nearest_event(e, 5),
        nearest.nearest_events(e, probes),
        filters.filtered_index_map(e, condition),
        filters.filter_summary(e, condition),
        files.file_infos(e),
    ):
        assert "SortAggregate" not in plan(frame)


def test_no_window_over_a_whole_stream_of_events(spark, tmp_path):
    """Windows group events by stream and chunk; only summaries are grouped by stream alone."""
    e = stored(spark, tmp_path)
    text = plan(filters.filtered_index_map(e, filters.filter_condition([5])))
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", text):
        assert "_chunk" in spec or "_span" in spec


def test_one_stream_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "stored")
    store_events(dt.four_streams(spark, SF_SMALL), path)
    stored_events = open_events(spark, path)
    one = LogTable(stored_events).only("s2").events
    scan = re.search(r"PartitionFilters: \[([^\]]*)\]", plan(one)).group(1)
    assert "stream_bucket" in scan
    back = one.select(dt.four_streams(spark, SF_SMALL).columns)
    assert values(back, IDX, TS) == values(dt.four_streams(spark, SF_SMALL).where("stream_id = 's2'"), IDX, TS)
    assert one.select(F.input_file_name()).distinct().count() == 1


def test_hot_probe_times_can_be_split(spark, tmp_path):
    """The join back to the probes is a shuffle join whose hot partition adaptive execution splits."""
    e = stored(spark, tmp_path)
    hot = spark.range(400_000, numPartitions=8).select(
        F.lit("all").alias(STREAM),
        F.when(F.col("id") % 3 == 0, 1704500000000).otherwise(F.col("id") + 1704067200000).alias("target_ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        answered = nearest.nearest_events(e, hot)
        assert answered.collect() and "skew=true" in plan(answered)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_cartesian_products(spark, tmp_path):
    e = stored(spark, tmp_path)
    probes = e.select(STREAM, F.col(TS).alias("target_ts"))
    for frame in (nearest.nearest_events(e, probes), files.attach_file(e.select(STREAM, IDX), files.file_infos(e))):
        text = plan(frame)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
