"""Streams opened by the type their catalog row admits them as."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators.paging import decode
from eventloom.plans.log_table import LogTable
from eventloom.schema import UNSTRUCTURED, KeyPath, ReaderOptions
from eventloom.sources.admission import StreamRefusedError, classify_streams, open_streams

OPTIONS = ReaderOptions(log_level=KeyPath(True, ("level",)), timestamp=KeyPath(True, ("ts",)))
ROWS = [
    ("s", 0, '{"level":"warn","ts":5}', '{"k":1}', " ERROR unused 1", 99),
    ("s", 1, None, "not json", None, None),
    ("u", 0, '{"level":"error","ts":6}', "{}", " ERROR disk 7 full", 70),
    ("u", 1, None, None, None, None),
    ("old", 0, "{}", "{}", " INFO x", 1),
    ("unlisted", 0, "{}", "{}", " INFO x", 1),
]
CATALOG = [("s", '{"VERSION":"1"}'), ("u", '{"VERSION":"0"}'), ("old", '{"VERSION":"7"}'), ("idle", '{"VERSION":"1"}')]


def opened(spark, path, rows=ROWS, catalog=CATALOG, **options):
    frame = spark.createDataFrame(rows, "name string, at bigint, auto string, user string, text string, ms bigint")
    streams = classify_streams(
        spark.createDataFrame(catalog, "stream_id string, meta string"),
        four_byte=F.lit(True),
        metadata_json=F.col("meta"),
        supported=["1"],
        backward_compatible=["0"],
    )
    return open_streams(
        frame,
        streams,
        OPTIONS,
        str(path),
        stream=F.col("name"),
        idx=F.col("at"),
        auto=F.col("auto"),
        user=F.col("user"),
        message=F.col("text"),
        timestamp=F.col("ms"),
        utc_offset_seconds=F.lit(-5400),
        **options,
    )


def shown(frame):
    return sorted(tuple(row) for row in frame.select("stream_id", "log_event_num", "log_level", "message", "timestamp", "utc_offset").collect())


def test_each_stream_as_its_type(spark, tmp_path):
    tables = opened(spark, tmp_path / "t")
    assert shown(decode(tables.structured)) == [
        ("s", 1, 4, '{"auto-generated":{"level":"warn","ts":5},"user-generated":{"k":1}}', 5, 0),
        ("s", 2, 0, "{}", 0, 0),
    ]
    assert shown(decode(tables.unstructured, UNSTRUCTURED).where("log_event_num = 1")) == [("u", 1, 5, " ERROR disk 7 full", 70, -90)]
    assert [tuple(r) for r in tables.refused.collect()] == [("old", "unsupported")]


def test_tables_are_log_tables(spark, tmp_path):
    structured, unstructured = LogTable.opened(opened(spark, tmp_path / "t"))
    assert [tuple(r) for r in structured.event_counts().collect()] == [("s", 2)]
    assert [tuple(r) for r in unstructured.event_counts().collect()] == [("u", 2)]
    assert unstructured.only("u").nearest(80).first()[1] == 0
    assert shown(unstructured.filter(levels=[5]).page(0, 1, use_filter=True))[0][3] == " ERROR disk 7 full"


def test_plan_reads_one_type(spark, tmp_path):
    plan = opened(spark, tmp_path / "t").structured._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "stream_type" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "meta" not in plan and "Join" not in plan


def test_refusals_and_empty(spark, tmp_path):
    with pytest.raises(StreamRefusedError, match="old"):
        opened(spark, tmp_path / "a", strict=True)
    with pytest.raises(ValueError, match="2 times"):
        opened(spark, tmp_path / "b", catalog=[*CATALOG, CATALOG[0]])
    tables = opened(spark, tmp_path / "c", rows=ROWS[:2])
    assert tables.structured.count() == 2 and tables.unstructured.count() == 0
    tables = opened(spark, tmp_path / "d", rows=[])
    assert tables.structured.count() == tables.unstructured.count() == tables.structured_zones.count() == 0
