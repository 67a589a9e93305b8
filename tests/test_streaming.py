from pyspark.sql import functions as F

from eventloom import kv
from eventloom.operators import filters, paging
from eventloom.plans import driver_tables as dt
from eventloom.schema import UNSTRUCTURED
from eventloom.sources.events import unstructured_events
from eventloom.streaming.normalise import append_to, normalise
from tests.helpers import SF_SMALL


def build(rows):
    return dt.build_structured(rows, F.lit("all"), F.col("event_id"))


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    table = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    source = str(tmp_path / "in")
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def drain():
        arriving = spark.readStream.schema(table.schema).parquet(source)
        events = normalise(arriving, build, [4, 5, 6], kv("k") >= 50)
        append_to(paging.decode(events), out, progress).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    def batch(rows):
        return sorted(tuple(r) for r in paging.decode(filters.filter_events(build(rows), [4, 5, 6], kv("k") >= 50)).collect())

    first, second = table.where("event_id < 600"), table.where("event_id >= 600")
    first.write.mode("append").parquet(source)
    assert drain() == batch(first)
    second.write.mode("append").parquet(source)
    assert drain() == batch(table)
    assert drain() == batch(table)


def test_unstructured_stream_equals_batch(spark, tmp_path):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")

    def lines(rows):
        return unstructured_events(
            rows,
            stream=F.lit("docs"),
            idx=F.col("doc_id"),
            message=F.col("text"),
            timestamp=F.lit(0),
            utc_offset_seconds=F.lit(-90),
        )

    table.repartition(3).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    events = normalise(arriving, lines, stream_type=UNSTRUCTURED)
    out = str(tmp_path / "out")
    append_to(paging.decode(events, UNSTRUCTURED), out, str(tmp_path / "progress")).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == sorted(tuple(r) for r in paging.decode(lines(table), UNSTRUCTURED).collect())
    assert {r[3] for r in got} == {r["text"] for r in table.collect()}


def test_streaming_query_over_both_layouts(spark, tmp_path):
    from eventloom.plans import checks

    whole = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    whole.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    want = sorted(map(tuple, checks.QUERIES["streaming_normalise"](spark, SF_SMALL).collect()))
    assert want and sorted(map(tuple, checks.QUERIES["streaming_normalise"](spark, str(tmp_path)).collect())) == want
