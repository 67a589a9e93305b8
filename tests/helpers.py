"""Small event tables for tests."""

from pyspark.sql import functions as F

from eventloom.schema import AUTO, FILE, IDX, LEVEL, OFFSET, STREAM, TS, USER

SF_SMALL = "/root/testdata/sf0.001"


def events(spark, rows):
    """rows of (stream, idx, ts, level[, user json[, offset[, file]]])"""
    full = [tuple(r) + ("{}", 0, "f0")[len(r) - 4 :] for r in rows]
    frame = spark.createDataFrame(
        full, f"{STREAM} string, {IDX} bigint, {TS} bigint, {LEVEL} tinyint, u string, {OFFSET} bigint, {FILE} string"
    )
    return frame.withColumns({AUTO: F.parse_json(F.lit("{}")), USER: F.try_parse_json("u")}).drop("u")


def values(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.select(*columns).collect())
