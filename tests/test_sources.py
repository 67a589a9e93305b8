import pytest
from pyspark.sql import functions as F

from eventloom import KeyPath, ReaderOptions, kv
from eventloom.operators import paging
from eventloom.schema import ARCHIVE_MAGIC, IDX, LEVEL, OFFSET, STREAM, TS, UNSTRUCTURED
from eventloom.sources import admission, blobs, tolerant
from eventloom.sources.events import read_structured_lines, structured_events, unstructured_events
from tests.helpers import SF_SMALL, values

OPTIONS = ReaderOptions(KeyPath(True, ("level",)), KeyPath(True, ("timestamp",)), KeyPath(True, ("utc_offset",)))


def test_namespaces_from_text_struct_map_and_variant(spark):
    rows = spark.createDataFrame([(0, "INFO", 5, '{"k":1}')], "i bigint, level string, timestamp bigint, props string")
    struct = F.struct("level", "timestamp", F.lit(-90).alias("utc_offset"))
    for user in (F.col("props"), F.parse_json("props"), F.create_map(F.lit("k"), F.lit(1))):
        e = structured_events(rows, OPTIONS, stream=F.lit("s"), idx=F.col("i"), auto=struct, user=user)
        row = e.withColumn("k", kv("k").eq(1)).first()
        assert (row[LEVEL], row[TS], row[OFFSET], row["k"]) == (3, 5, -1, True)
    bare = structured_events(rows, OPTIONS, stream=F.lit("s"), idx=F.col("i"))
    assert paging.decode(bare).first()["message"] == '{"auto-generated":{},"user-generated":{}}'


def test_rows_without_a_stream_or_position_are_refused(spark):
    rows = spark.createDataFrame([(None, 0), ("s", None)], "s string, i bigint")
    for column in ("s", "i"):
        e = structured_events(rows.where(F.col(column).isNull()), OPTIONS, stream=F.col("s"), idx=F.col("i"))
        with pytest.raises(Exception, match="is null"):
            e.collect()


def test_unstructured_events(spark):
    rows = spark.createDataFrame([(0, " ERROR at 5", 7, -90), (1, "x", 8, 5400)], "i bigint, m string, t bigint, o bigint")
    e = unstructured_events(
        rows, stream=F.lit("s"), idx=F.col("i"), message=F.col("m"), timestamp=F.col("t"), utc_offset_seconds=F.col("o")
    )
    got = paging.decode(e, UNSTRUCTURED).orderBy("log_event_num").collect()
    assert [tuple(r) for r in got] == [("s", 1, 5, " ERROR at 5", 7, -1), ("s", 2, 0, "x", 8, 90)]


def test_rendered_lines_read_back(spark, tmp_path):
    rows = spark.createDataFrame([(i, "warn" if i % 2 else "Error", i * 1000) for i in range(50)], "i bigint, level string, timestamp bigint")
    auto = F.struct("level", "timestamp", F.lit(3600).alias("utc_offset"))
    e = structured_events(rows, OPTIONS, stream=F.lit("s"), idx=F.col("i"), auto=auto)
    rendered = paging.page(e, 0, 50)
    (tmp_path / "in").mkdir()
    lines = [r["message"] for r in rendered.collect()]
    (tmp_path / "in" / "one.json").write_text("\n".join(lines + ['{"auto-gen']))
    back = read_structured_lines(spark, str(tmp_path / "in"), OPTIONS, str(tmp_path / "staged"))
    report = tolerant.load_report(back, F.col("auto_kv").isNull()).first()
    assert (report["n_events"], report["is_incomplete"], report["n_corrupt"]) == (50, True, 0)
    whole = tolerant.split_broken(back, F.col("auto_kv").isNull())
    assert values(paging.decode(whole), "log_event_num", LEVEL, "message", TS, OFFSET) == values(
        rendered, "log_event_num", LEVEL, "message", TS, OFFSET
    )


def records(spark, *streams):
    rows = [(s, i, t) for s, texts in streams for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"{STREAM} string, {IDX} bigint, record string")


def test_tolerant_load(spark):
    r = records(spark, ("whole", ["{}", "{}"]), ("cut", ["{}", '{"a"']), ("bad", ["{", "{}", "{"]), ("empty", [None, "{}"]))
    broken = tolerant.broken_json(F.col("record"))
    assert values(tolerant.load_report(r, broken), STREAM, "n_records", "n_events", "is_incomplete", "n_corrupt") == [
        ("bad", 3, 1, True, 1), ("cut", 2, 1, True, 0), ("empty", 2, 2, False, 0), ("whole", 2, 2, False, 0)]
    with pytest.raises(tolerant.CorruptStreamError, match="bad"):
        tolerant.split_broken(r, broken)
    fine = r.where(F.col(STREAM) != "bad")
    assert values(tolerant.split_broken(fine, broken), STREAM, IDX) == [("cut", 0), ("empty", 0), ("empty", 1), ("whole", 0), ("whole", 1)]
    assert tolerant.split_broken(r, broken, strict=False).where(F.col(STREAM) == "bad").count() == 1


def test_admission_order_of_checks(spark):
    rows = {
        "ok": (True, '{"V":"1.0","x":[1,{"y":null}]}', "structured"),
        "old": (True, '{"V":"0.1"}', "unstructured"),
        "new": (True, '{"V":"2.0"}', "unsupported"),
        "number": (True, '{"V":1}', "metadata_corrupted"),
        "absent": (True, '{"v":"1.0"}', "metadata_corrupted"),
        "null": (True, '{"V":null}', "metadata_corrupted"),
        "list": (True, '["V"]', "metadata_corrupted"),
        "broken": (True, '{"V":', "metadata_corrupted"),
        "missing": (True, None, "metadata_corrupted"),
        "wide": (False, '{"V":"1.0"}', "unsupported"),
        "wide_broken": (False, "{", "unsupported"),
    }
    frame = spark.createDataFrame([(k, v[0], v[1]) for k, v in rows.items()], f"{STREAM} string, f boolean, m string")
    got = admission.classify_streams(
        frame, four_byte=F.col("f"), metadata_json=F.col("m"), supported=["1.0"], backward_compatible=["0.1"], version_key="V"
    )
    assert {r[STREAM]: r["admission"] for r in got.collect()} == {k: v[2] for k, v in rows.items()}
    assert {r[STREAM]: r["stream_type"] for r in got.collect() if r["stream_type"]} == {"ok": "structured", "old": "unstructured"}
    named = spark.createDataFrame([(k, 1) for k in rows], f"{STREAM} string, n int")
    assert values(admission.admitted(named, got, "structured"), STREAM) == [("ok",)]
    assert values(admission.admitted(named, got, "unstructured"), STREAM) == [("old",)]
    with pytest.raises(admission.StreamRefusedError):
        admission.admitted(named, got, "structured", strict=True)
    fine = got.where(F.col(STREAM).isin("ok", "old"))
    assert admission.admitted(named, fine, "structured", strict=True).count() == 1
    entries = admission.metadata_entries(got.where(F.col(STREAM).isin("ok", "list")))
    assert values(entries, STREAM, "key", "value") == [("ok", "V", '"1.0"'), ("ok", "x", '[1,{"y":null}]')]


def test_archive_magic(spark):
    whole = ARCHIVE_MAGIC + b"\x00"
    cases = {whole[:n]: n >= 4 for n in range(6)} | {b"\x00\x01\x02\x03\x04\x05": False, bytes(123) + ARCHIVE_MAGIC: False}
    frame = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(cases)], "i int, content binary")
    assert [r[0] for r in frame.orderBy("i").select(blobs.is_archive(F.col("content"))).collect()] == list(cases.values())


def test_archive_files(spark, tmp_path):
    (tmp_path / "deep er").mkdir()
    contents = {"a.bin": ARCHIVE_MAGIC + bytes(5000), "b.bin": bytes(3), "deep er/c é.bin": ARCHIVE_MAGIC, "d.bin": b"", "e.bin": ARCHIVE_MAGIC[:3]}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    got = blobs.classify_files(spark, str(tmp_path)).collect()
    assert {r["path"].split("/")[-1]: (r["length"], r["is_archive"]) for r in got} == {
        n.split("/")[-1]: (len(c), c.startswith(ARCHIVE_MAGIC)) for n, c in contents.items() if c
    }


def test_blobs_are_not_read_whole(spark):
    plan = blobs.read_heads(blobs.list_files(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_listed_files_may_be_empty_or_opened_by_the_caller(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"\xfd\x2f\xc5\x30rest")
    (tmp_path / "b").write_bytes(b"")
    listed = spark.createDataFrame([(f"file:{tmp_path}/a", 8), (f"file:{tmp_path}/b", 0)], "path string, length bigint")
    want = [(True, 8), (False, 0)]
    assert [(r["is_archive"], r["length"]) for r in blobs.classify_listed(listed).orderBy("path").collect()] == want
    own = listed.withColumn("path", F.concat(F.lit("own-"), "path"))
    got = blobs.classify_listed(own, lambda name: open(name.removeprefix("own-file:"), "rb"))
    assert [(r["is_archive"], r["length"]) for r in got.orderBy("path").collect()] == want


def test_unstructured_nulls_become_zero(spark):
    from eventloom.functions.derive import with_unstructured_fields
    from eventloom.schema import LOGTYPE, OFFSET, TS

    rows = spark.createDataFrame([("x", None)], f"{LOGTYPE} string, t bigint")
    row = with_unstructured_fields(rows, F.col("t"), F.col("t")).first()
    assert (row[TS], row[OFFSET]) == (0, 0)
