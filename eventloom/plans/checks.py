"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.derive import ntz_to_millis
from eventloom.functions.kept import keep_keys
from eventloom.functions.levels import level_name
from eventloom.functions.predicates import kv
from eventloom.functions.text import repair_utf8
from eventloom.operators import diagnostics, files, filters, indexing, nearest, paging, templates
from eventloom.plans import driver_tables as dt
from eventloom.plans.log_table import LogTable
from eventloom.schema import (
    ARCHIVE_MAGIC,
    FILE,
    IDX,
    LEVEL,
    LOGTYPE,
    MESSAGE,
    OFFSET,
    STREAM,
    STRUCTURED,
    TS,
    UNSTRUCTURED,
    KeyPath,
    ReaderOptions,
)
from eventloom.session import fresh_dir
from eventloom.sources import admission, blobs, tolerant
from eventloom.sources.events import read_structured_lines, read_unstructured_lines, structured_events
from eventloom.sources.store import append_events, store_events
from eventloom.streaming.normalise import append_to, normalise
from eventloom.streaming.positions import append_positions, chronology_so_far, offset_changes_so_far

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return register


# SQL building blocks: the same views as in driver_tables.
_LEVEL_TEXT = """CASE event_type WHEN 'error' THEN 'Error' WHEN 'signup' THEN 'warn'
    WHEN 'purchase' THEN 'INFO' WHEN 'click' THEN 'debug' ELSE event_type END"""
_LEVEL_CODE = """CAST(CASE event_type WHEN 'error' THEN 5 WHEN 'signup' THEN 4
    WHEN 'purchase' THEN 3 WHEN 'click' THEN 2 ELSE 0 END AS TINYINT)"""
_MILLIS = "epoch_us(ts) // 1000"
_SECONDS = "((user_id % 5 - 2) * 5400 - 59)"
_ONE = f"""one AS (SELECT 'all' AS stream_id, event_id AS log_event_idx,
    'f' || CAST(event_id // 1000 AS VARCHAR) AS source_file, {_LEVEL_TEXT} AS level_text,
    {_LEVEL_CODE} AS log_level, {_MILLIS} AS timestamp, {_SECONDS} AS offset_seconds,
    {_SECONDS} // 60 AS utc_offset, CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events)"""
_FOUR = f"""four AS (SELECT 's' || CAST(user_id % 4 AS VARCHAR) AS stream_id,
    row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS log_event_idx,
    event_id, 'f' || CAST(event_id // 1000 AS VARCHAR) AS source_file,
    {_LEVEL_CODE} AS log_level, {_MILLIS} AS timestamp, {_SECONDS} // 60 AS utc_offset,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events)"""
_RENDERED = """'{"auto-generated":{"level":"' || level_text || '","timestamp":' || CAST(timestamp AS VARCHAR)
    || ',"utc_offset":' || CAST(offset_seconds AS VARCHAR) || '},"user-generated":{"k":'
    || CAST(k AS VARCHAR) || '}}'"""
_COLUMNS = "stream_id, log_event_idx, source_file, log_level, timestamp, utc_offset"
_DECODED = f"""SELECT stream_id, log_event_idx + 1 AS log_event_num, log_level,
    {_RENDERED} AS message, timestamp, utc_offset"""
_LINES = """lines AS (SELECT source AS stream_id, doc_id, line_number, line,
    row_number() OVER (PARTITION BY source ORDER BY doc_id, line_number) - 1 AS log_event_idx,
    regexp_replace(line, '[A-Za-z0-9_./-]*[0-9][A-Za-z0-9_./-]*', chr(17), 'g') AS logtype,
    regexp_extract_all(line, '[A-Za-z0-9_./-]*[0-9][A-Za-z0-9_./-]*') AS vars
    FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_number FROM documents))"""
_SEVEN_USER = """CASE event_id % 7 WHEN 0 THEN '{"k":' || k || '}' WHEN 1 THEN '{"k":"' || k || '"}'
    WHEN 2 THEN '{"k":null}' WHEN 3 THEN '{}' WHEN 4 THEN '{"k":{"a":' || k || '}}'
    WHEN 5 THEN '{"k":' || k || '.5}' ELSE '{"k":{"a":{"b":true}},"list":[1,2]}' END"""


def _flat(events: DataFrame) -> DataFrame:
    return events.select(STREAM, IDX, FILE, LEVEL, TS, OFFSET)


# --- load and derive -------------------------------------------------------------------------


@check(
    f"""WITH {_ONE} SELECT {_COLUMNS}, log_event_idx + 1 AS log_event_num,
    CASE log_level WHEN 0 THEN 'NONE' WHEN 2 THEN 'DEBUG' WHEN 3 THEN 'INFO' WHEN 4 THEN 'WARN'
        WHEN 5 THEN 'ERROR' END AS level_name FROM one"""
)
def structured_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dt.one_stream(spark, sf_dir)
    return _flat(events).withColumns(
        {"log_event_num": indexing.event_number(F.col(IDX)), "level_name": level_name(F.col(LEVEL))}
    )


@check(f"WITH {_FOUR} SELECT {_COLUMNS} FROM four")
def event_index_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(dt.four_streams(spark, sf_dir))


@check(
    """SELECT 's' || CAST(user_id % 4 AS VARCHAR) AS stream_id, event_id,
    row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS log_event_idx FROM events"""
)
def event_index_sparse_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order by epoch nanoseconds: values far apart, with event_id where two events share one."""
    rows = dt.table(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), F.col("user_id") % 4).alias(STREAM),
        "event_id",
        (ntz_to_millis(F.col("ts")) * 1_000_000 + F.date_format("ts", "SSSSSS").cast("bigint") % 1000 * 1000).alias("nanos"),
    )
    return indexing.index_by_rank(rows, ["nanos", "event_id"]).drop("nanos")


@check("SELECT event_id, event_id AS log_event_idx FROM events")
def event_index_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexing.index_by_parquet_position(dt.table(spark, sf_dir, "events")).select("event_id", IDX)


@check(f"WITH {_LINES} SELECT stream_id, doc_id, line_number, log_event_idx FROM lines")
def event_index_by_document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.document_lines(spark, sf_dir).select(
        STREAM, "doc_id", F.col("line_number").cast("bigint").alias("line_number"), IDX
    )


@check(
    f"""SELECT 'all' AS stream_id, event_id AS log_event_idx,
    'f' || CAST(event_id // 1000 AS VARCHAR) AS source_file,
    CAST(CASE event_type WHEN 'error' THEN 5 ELSE 0 END AS TINYINT) AS log_level,
    {_MILLIS} AS timestamp, {_SECONDS} // 60 AS utc_offset FROM events"""
)
def unstructured_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(dt.text_stream(spark, sf_dir))


@check(
    f"""WITH {_ONE} SELECT log_event_idx, k, level_text AS level, timestamp AS auto_timestamp,
    offset_seconds AS auto_utc_offset FROM one"""
)
def structured_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.one_stream(spark, sf_dir).select(
        IDX,
        F.expr("variant_get(user_kv, '$.k', 'bigint')").alias("k"),
        F.expr("variant_get(auto_kv, '$.level', 'string')").alias("level"),
        F.expr("variant_get(auto_kv, '$.timestamp', 'bigint')").alias("auto_timestamp"),
        F.expr("variant_get(auto_kv, '$.utc_offset', 'bigint')").alias("auto_utc_offset"),
    )


@check(f"WITH {_ONE} SELECT log_level, {_RENDERED} AS message, timestamp, utc_offset FROM one")
def structured_text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered to text files, read back as streams of lines and derived anew."""
    folder = fresh_dir(spark, "rendered")
    paging.decode(dt.one_stream(spark, sf_dir)).select("message").write.text(folder)
    events = read_structured_lines(spark, folder, dt.OPTIONS)
    return paging.decode(events).select(LEVEL, MESSAGE, TS, OFFSET)


@check(
    f"""SELECT 'f' || CAST(event_id // 1000 AS VARCHAR) AS stream_id, event_id % 1000 AS log_event_idx,
    CAST(CASE event_type WHEN 'error' THEN 5 ELSE 0 END AS TINYINT) AS log_level,
    ' ' || upper(event_type) || ' user=' || CAST(user_id AS VARCHAR) || ' props=' || props
        || repeat(chr(10) || '  at frame ' || CAST(event_id AS VARCHAR), CAST(event_id % 4 AS INTEGER)) AS message,
    {_MILLIS} AS timestamp, (user_id % 5 - 2) * 90 AS utc_offset FROM events"""
)
def unstructured_text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text files, a file per 1000 of them, up to four lines each, read back over many blocks and chunks."""
    folder, minutes = fresh_dir(spark, "text-logs"), (F.col("user_id") % 5 - 2) * 90
    local = (F.col("ts") + F.make_dt_interval(mins=minutes)).cast("string")
    shown = F.concat(F.substring(local, 1, 19), F.lit("."), F.rpad(F.substring(local, 21, 3), 3, "0"))
    offset = F.format_string("%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)
    frames = F.repeat(F.concat(F.lit("\n  at frame "), F.col("event_id")), (F.col("event_id") % 4).cast("int"))
    (
        dt.table(spark, sf_dir, "events")
        .select("event_id", dt.source_file().alias("part"), F.concat(shown, offset, dt.text_message(), frames).alias("value"))
        .repartition("part")
        .sortWithinPartitions("part", "event_id")
        .select("part", "value")
        .write.partitionBy("part")
        .text(folder)
    )
    # Files are cut into many blocks, but a task takes the blocks of many files: each task reports to the driver.
    last = dt.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), last // 64_000)
    cut = {
        "spark.sql.files.maxPartitionBytes": "65536",
        "spark.sql.files.maxPartitionNum": str(tasks),
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks),
    }
    before = {name: spark.conf.get(name, None) for name in cut}
    for name, value in cut.items():
        spark.conf.set(name, value)
    try:
        events = read_unstructured_lines(spark, folder, bits=8)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    stream = F.regexp_extract(STREAM, "part=([^/]+)", 1).alias(STREAM)
    return paging.decode(events, UNSTRUCTURED).select(
        stream, (F.col("log_event_num") - 1).alias(IDX), LEVEL, MESSAGE, TS, OFFSET
    )


@check(f"WITH {_FOUR} SELECT {_COLUMNS} FROM four")
def appended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four streams loaded in three batches, the second one tried twice: positions as if loaded at once."""
    rows, path = dt.table(spark, sf_dir, "events"), fresh_dir(spark, "appended")
    last = rows.agg(F.max("event_id")).first()[0] or 0
    third = F.col("event_id") * 3 / (last + 1)
    for batch in (0, 1, 1, 2):
        part = rows.where(F.floor(third) == batch).withColumn(STREAM, F.concat(F.lit("s"), F.col("user_id") % 4))
        events = dt.build_structured(indexing.index_by_order(part, "event_id"), F.col(STREAM), F.col(IDX))
        append_events(events, path, f"load-{batch}", bits=10)
    return _flat(LogTable.appended(spark, path).events)


def _cut_off_records(spark: SparkSession, sf_dir: str, in_the_middle: bool = True) -> DataFrame:
    """A stream per 1000 events; the last record of each cut off, some broken in the middle too."""
    e = F.col("event_id")
    broken = e % 1000 == 999
    if in_the_middle:
        broken = broken | ((e % 1000 == 500) & (F.expr("event_id div 1000") % 3 == 1))
    return dt.table(spark, sf_dir, "events").select(
        dt.source_file().alias(STREAM),
        (e % 1000).alias(IDX),
        F.when(broken, F.substring("props", 1, 4)).otherwise(F.col("props")).alias("record"),
    )


_RECORDS = """records AS (SELECT 'f' || CAST(event_id // 1000 AS VARCHAR) AS stream_id,
    event_id % 1000 AS log_event_idx, (event_id // 1000) % 3 AS third,
    CASE WHEN event_id % 1000 = 999 OR (event_id % 1000 = 500 AND (event_id // 1000) % 3 = 1)
        THEN substr(props, 1, 4) ELSE props END AS record FROM events)"""


@check(f"WITH {_RECORDS} SELECT stream_id, log_event_idx, record FROM records WHERE json_valid(record)")
def tolerant_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _cut_off_records(spark, sf_dir)
    return tolerant.split_broken(records, tolerant.broken_json(F.col("record")), strict=False)


@check(
    """SELECT 'f' || CAST(event_id // 1000 AS VARCHAR) AS stream_id, event_id % 1000 AS log_event_idx,
    props AS record FROM events WHERE event_id % 1000 <> 999"""
)
def tolerant_load_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All streams are whole but for their last record: strict accepts them."""
    records = _cut_off_records(spark, sf_dir, in_the_middle=False)
    return tolerant.split_broken(records, tolerant.broken_json(F.col("record")))


@check(
    f"""WITH {_RECORDS} SELECT stream_id, log_event_idx AS record_idx, record,
        row_number() OVER (PARTITION BY stream_id ORDER BY log_event_idx) - 1 AS log_event_idx
    FROM records WHERE json_valid(record)"""
)
def tolerant_load_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable records at positions without gaps, over many chunks of positions."""
    records = _cut_off_records(spark, sf_dir)
    return tolerant.load_tolerant(records, tolerant.broken_json(F.col("record")), bits=6)[0]


@check(
    f"""WITH {_RECORDS}, marked AS (SELECT *, max(log_event_idx) OVER (PARTITION BY stream_id) AS last_idx FROM records)
    SELECT stream_id, log_event_idx AS record_idx,
        CASE WHEN log_event_idx = last_idx THEN 'incomplete' ELSE 'corrupt' END AS problem
    FROM marked WHERE NOT json_valid(record)"""
)
def tolerant_load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _cut_off_records(spark, sf_dir)
    return tolerant.load_tolerant(records, tolerant.broken_json(F.col("record")))[1]


@check(
    f"""WITH {_RECORDS}, dense AS (SELECT stream_id,
        row_number() OVER (PARTITION BY stream_id ORDER BY log_event_idx) AS log_event_num,
        count(*) OVER (PARTITION BY stream_id) AS n FROM records WHERE json_valid(record))
    SELECT stream_id, log_event_num FROM dense WHERE n >= 998 AND log_event_num > 480 AND log_event_num <= 998"""
)
def page_after_tolerant_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page across the place of a broken record: as long as asked for, without a hole."""
    records = _cut_off_records(spark, sf_dir)
    loaded, _ = tolerant.load_tolerant(records, tolerant.broken_json(F.col("record")))
    events = structured_events(
        loaded, dt.OPTIONS, stream=F.col(STREAM), idx=F.col(IDX), auto=F.lit("{}"), user=F.col("record")
    )
    return paging.page(events, 480, 998).select(STREAM, "log_event_num")


@check(
    f"""WITH {_RECORDS}, marked AS (SELECT *, NOT json_valid(record) AS bad,
        max(log_event_idx) OVER (PARTITION BY stream_id) AS last_idx FROM records)
    SELECT stream_id, count(*) AS n_records, count(*) FILTER (WHERE NOT bad) AS n_events,
        bool_or(bad AND log_event_idx = last_idx) AS is_incomplete,
        count(*) FILTER (WHERE bad AND log_event_idx <> last_idx) AS n_corrupt
    FROM marked GROUP BY stream_id"""
)
def tolerant_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _cut_off_records(spark, sf_dir)
    return tolerant.load_report(records, tolerant.broken_json(F.col("record")))


def _stream_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream per user; the form of its metadata follows from the user's number."""
    user = F.col("user_id") % 8
    counted = dt.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    tail = F.concat(F.lit(',"n":'), F.col("n"), F.lit("}"))
    metadata = (
        F.when(user == 0, F.concat(F.lit('{"VERSION":"0.1.0"'), tail))
        .when(user == 1, F.concat(F.lit('{"VERSION":"v0.0.1"'), tail))
        .when(user == 2, F.concat(F.lit('{"VERSION":"9.9.9"'), tail))
        .when(user == 3, F.concat(F.lit('{"VERSION":1'), tail))
        .when(user == 4, F.concat(F.lit('{"version":"0.1.0"'), tail))
        .when(user == 5, "not json")
        .when(user == 7, F.concat(F.lit('{"VERSION":"0.1.0"'), tail))
    )
    return counted.select(
        F.concat(F.lit("u"), F.col("user_id")).alias(STREAM),
        (user != 7).alias("four_byte"),
        metadata.alias("metadata_json"),
    )


_CATALOG = """catalog AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS stream_id, user_id % 8 AS form,
    user_id % 8 <> 7 AS four_byte,
    CASE user_id % 8 WHEN 0 THEN '{"VERSION":"0.1.0"' || tail WHEN 1 THEN '{"VERSION":"v0.0.1"' || tail
        WHEN 2 THEN '{"VERSION":"9.9.9"' || tail WHEN 3 THEN '{"VERSION":1' || tail
        WHEN 4 THEN '{"version":"0.1.0"' || tail WHEN 5 THEN 'not json'
        WHEN 7 THEN '{"VERSION":"0.1.0"' || tail END AS metadata_json
    FROM (SELECT user_id, ',"n":' || CAST(count(*) AS VARCHAR) || '}' AS tail FROM events GROUP BY user_id))"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.classify_streams(
        _stream_catalog(spark, sf_dir),
        four_byte=F.col("four_byte"),
        metadata_json=F.col("metadata_json"),
        supported=["0.1.0", "0.1.1"],
        backward_compatible=["v0.0.1", "0.0.2"],
    )


@check(
    f"""WITH {_CATALOG}, v AS (SELECT *, CASE WHEN json_type(TRY_CAST(metadata_json AS JSON), '$.VERSION') = 'VARCHAR'
        THEN json_extract_string(TRY_CAST(metadata_json AS JSON), '$.VERSION') END AS version FROM catalog),
    a AS (SELECT *, CASE WHEN NOT four_byte THEN 'unsupported' WHEN version IS NULL THEN 'metadata_corrupted'
        WHEN version IN ('0.1.0', '0.1.1') THEN 'structured'
        WHEN version IN ('v0.0.1', '0.0.2') THEN 'unstructured' ELSE 'unsupported' END AS admission FROM v)
    SELECT stream_id, version, admission, CASE WHEN admission IN ('structured', 'unstructured')
        THEN admission END AS stream_type FROM a"""
)
def stream_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select(STREAM, "version", "admission", "stream_type")


@check(
    f"""WITH {_CATALOG}, m AS (SELECT stream_id, TRY_CAST(metadata_json AS JSON) AS j FROM catalog
        WHERE form NOT IN (5, 6)),
    k AS (SELECT stream_id, j, unnest(json_keys(j)) AS key FROM m)
    SELECT stream_id, key, CAST(json_extract(j, '$.' || key) AS VARCHAR) AS value FROM k"""
)
def stream_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.metadata_entries(_classified(spark, sf_dir))


@check(
    """SELECT 'u' || CAST(user_id AS VARCHAR) AS stream_id, event_id, 'structured' AS stream_type FROM events
        WHERE user_id % 8 = 0
    UNION ALL SELECT 'u' || CAST(user_id AS VARCHAR), event_id, 'unstructured' FROM events WHERE user_id % 8 = 1"""
)
def admitted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the streams that can be opened, by what they are opened as."""
    classified = _classified(spark, sf_dir)
    rows = dt.table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id")).alias(STREAM), "event_id"
    )
    opened = [
        admission.admitted(rows, classified, kind).withColumn("stream_type", F.lit(kind))
        for kind in (STRUCTURED, UNSTRUCTURED)
    ]
    return opened[0].unionByName(opened[1])


@check(
    f"""SELECT 'u' || CAST(user_id AS VARCHAR) AS stream_id,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS log_event_num,
        CASE WHEN user_id % 8 = 0 THEN {_LEVEL_CODE} ELSE CAST(CASE event_type WHEN 'error' THEN 5 ELSE 0 END AS TINYINT) END
            AS log_level,
        CASE WHEN user_id % 8 = 0 THEN {_RENDERED}
            ELSE ' ' || upper(event_type) || ' user=' || CAST(user_id AS VARCHAR) || ' props=' || props END AS message,
        timestamp, {_SECONDS} // 60 AS utc_offset
    FROM (SELECT *, {_LEVEL_TEXT} AS level_text, {_MILLIS} AS timestamp, {_SECONDS} AS offset_seconds,
        CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE user_id % 8 < 2)"""
)
def opened_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stream of the catalog opened as the type it is admitted as, and all its events rendered."""
    rows = dt.table(spark, sf_dir, "events").withColumn(STREAM, F.concat(F.lit("u"), F.col("user_id")))
    opened = admission.open_streams(
        indexing.index_by_order(rows, "event_id"),
        _classified(spark, sf_dir),
        dt.OPTIONS,
        fresh_dir(spark, "opened"),
        stream=F.col(STREAM),
        idx=F.col(IDX),
        auto=dt.auto_pairs(),
        user=F.col("props"),
        message=dt.text_message(),
        timestamp=ntz_to_millis(F.col("ts")),
        utc_offset_seconds=dt.offset_seconds(),
        source_file=dt.source_file(),
    )
    return paging.decode(opened.structured).unionByName(paging.decode(opened.unstructured, UNSTRUCTURED))


_MAGIC_CASE = "doc_id % 4"


@check(
    f"""SELECT doc_id, {_MAGIC_CASE} = 0 AS is_archive FROM documents"""
)
def magic_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents behind the magic bytes, behind another byte, cut to two bytes, and as they are."""
    form, body = F.col("doc_id") % 4, F.col("text").cast("binary")
    magic = F.lit(ARCHIVE_MAGIC)
    content = (
        F.when(form == 0, F.concat(magic, body))
        .when(form == 1, F.concat(F.lit(b"\x00"), magic, body))
        .when(form == 2, F.substring(magic, 1, 2))
        .otherwise(body)
    )
    docs = dt.table(spark, sf_dir, "documents").withColumn("content", content)
    return docs.select("doc_id", blobs.is_archive(F.col("content")).alias("is_archive"))


@check("SELECT doc_id // 20 AS doc_group, doc_id // 20 % 3 = 0 AS is_archive FROM documents GROUP BY ALL")
def magic_classify_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per 20 documents, every third one with the magic bytes first, recognised by its head."""
    group = F.expr("doc_id div 20")
    magic = F.when(group % 3 == 0, F.lit(ARCHIVE_MAGIC).cast("string")).otherwise("")
    folder = fresh_dir(spark, "blobs")
    (
        dt.table(spark, sf_dir, "documents")
        .select(F.concat(magic, F.col("text")).alias("value"), group.alias("doc_group"))
        .repartition("doc_group")
        .write.partitionBy("doc_group")
        .text(folder)
    )
    name = F.regexp_extract("path", "doc_group=([0-9]+)", 1)
    return blobs.classify_files(spark, folder).select(
        name.cast("bigint").alias("doc_group"), "is_archive"
    )


@check("SELECT doc_id, text || chr(65533) || source AS repaired FROM documents")
def utf8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.col("text").cast("binary"), F.lit(b"\xff"), F.col("source").cast("binary"))
    return dt.table(spark, sf_dir, "documents").select("doc_id", repair_utf8(raw).alias("repaired"))


# --- filters ---------------------------------------------------------------------------------


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE log_level IN (4, 5, 6)")
def level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(filters.filter_events(dt.one_stream(spark, sf_dir), levels=[6, 5, 4, 5]))


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE log_level = 0")
def level_filter_none_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(filters.filter_events(dt.one_stream(spark, sf_dir), levels=[0]))


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE false")
def level_filter_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(filters.filter_events(dt.one_stream(spark, sf_dir), levels=[]))


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one")
def level_filter_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(filters.filter_events(dt.one_stream(spark, sf_dir), levels=None))


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE k >= 50")
def kv_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(filters.filter_events(dt.one_stream(spark, sf_dir), predicate=kv("k") >= 50))


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE NOT (k >= 50)")
def kv_filter_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(filters.filter_events(dt.one_stream(spark, sf_dir), predicate=~(kv("k") >= 50)))


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE log_level IN (4, 5, 6) AND k >= 50")
def kv_and_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(
        filters.filter_events(dt.one_stream(spark, sf_dir), levels=[4, 5, 6], predicate=kv("k") >= 50)
    )


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE level_text ILIKE 'e%r' OR lower(level_text) = 'info'")
def kv_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = kv("level", auto=True).matches("e*r") | kv("level", auto=True).eq("info")
    return _flat(filters.filter_events(dt.one_stream(spark, sf_dir), predicate=wanted))


@check(
    f"""WITH u AS (SELECT event_id, event_id % 7 AS form, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT event_id AS log_event_idx, (form = 0 AND k >= 50) OR (form = 5 AND k + 0.5 >= 50) AS at_least_50,
        form = 1 AND CAST(k AS VARCHAR) LIKE '5%' AS text_5, form <> 3 AS has_k, form = 2 AS k_is_null,
        form = 6 AS nested_true, NOT ((form = 0 AND k >= 50) OR (form = 5 AND k + 0.5 >= 50)) AS below_50
    FROM u"""
)
def kv_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of predicate on events whose key is a number, text, empty, absent or nested."""
    return dt.irregular_events(spark, sf_dir).select(
        IDX,
        (kv("k") >= 50).alias("at_least_50"),
        kv("k").matches("5*").alias("text_5"),
        kv("k").exists().alias("has_k"),
        kv("k").eq(None).alias("k_is_null"),
        kv("k", "a", "b").eq(True).alias("nested_true"),
        (~(kv("k") >= 50)).alias("below_50"),
    )


@check(f"WITH {_ONE} SELECT {_COLUMNS} FROM one WHERE log_level IN (4, 5, 6) AND k >= 50")
def kv_filter_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key k stored as plain columns, so that the scan gets the predicate."""
    path = fresh_dir(spark, "kept-events")
    store_events(keep_keys(dt.one_stream(spark, sf_dir), [KeyPath(False, ("k",))]), path)
    log = LogTable.stored(spark, path)
    return _flat(log.filter(levels=[4, 5, 6], predicate=log.kv("k") >= 50).filtered_events())


@check(ORACLES["kv_predicates"])
def kv_predicates_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of predicate on keys stored as plain columns."""
    kept = [KeyPath(False, ("k",)), KeyPath(False, ("k", "a", "b"))]
    log = LogTable(keep_keys(dt.irregular_events(spark, sf_dir), kept))
    return log.events.select(
        IDX,
        (log.kv("k") >= 50).alias("at_least_50"),
        log.kv("k").matches("5*").alias("text_5"),
        log.kv("k").exists().alias("has_k"),
        log.kv("k").eq(None).alias("k_is_null"),
        log.kv("k", "a", "b").eq(True).alias("nested_true"),
        (~(log.kv("k") >= 50)).alias("below_50"),
    )


@check(
    f"""WITH {_FOUR}, s AS (SELECT stream_id, count(*) AS n_events,
        count(*) FILTER (WHERE log_level IN (4, 5, 6) AND k >= 50) AS n_matches FROM four GROUP BY stream_id)
    SELECT *, n_matches <> n_events AS is_active FROM s"""
)
def filter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = filters.filter_condition([4, 5, 6], kv("k") >= 50)
    return filters.filter_summary(dt.four_streams(spark, sf_dir), condition)


@check(
    f"""WITH {_FOUR} SELECT stream_id, count(*) AS n_events, count(*) AS n_matches, false AS is_active
    FROM four GROUP BY stream_id"""
)
def filter_summary_keeps_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = filters.filter_condition(range(7))
    return filters.filter_summary(dt.four_streams(spark, sf_dir), condition)


@check(
    """SELECT 'all' AS stream_id, count(*) AS n_events, count(*) AS n_matches, true AS is_active FROM events"""
)
def filter_summary_unstructured(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = filters.filter_condition(range(7), stream_type=UNSTRUCTURED)
    return filters.filter_summary(dt.text_stream(spark, sf_dir), condition, UNSTRUCTURED)


@check(
    f"""WITH {_FOUR} SELECT stream_id, log_event_idx,
        row_number() OVER (PARTITION BY stream_id ORDER BY log_event_idx) - 1 AS filtered_idx
    FROM four WHERE log_level IN (4, 5, 6) AND k >= 50"""
)
def filtered_index_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = filters.filter_condition([4, 5, 6], kv("k") >= 50)
    return filters.filtered_index_map(dt.four_streams(spark, sf_dir), condition)


# --- pages -----------------------------------------------------------------------------------


@check(f"WITH {_ONE} {_DECODED} FROM one")
def rendered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.decode(dt.one_stream(spark, sf_dir))


@check(f"WITH {_ONE} {_DECODED} FROM one WHERE log_event_idx >= 200 AND log_event_idx < 700")
def page_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(dt.one_stream(spark, sf_dir), 200, 700)


@check(f"WITH {_ONE} {_DECODED} FROM one WHERE false")
def page_beyond_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range that reaches past the last event has no page, not a shorter one."""
    return paging.page(dt.one_stream(spark, sf_dir), 0, 10**12)


@check(
    f"""WITH {_ONE}, hits AS (SELECT *, row_number() OVER (ORDER BY log_event_idx) - 1 AS filtered_idx
        FROM one WHERE log_level IN (4, 5, 6) AND k >= 50)
    {_DECODED} FROM hits WHERE filtered_idx >= 20 AND filtered_idx < 120"""
)
def page_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = filters.filter_condition([4, 5, 6], kv("k") >= 50)
    return paging.page_filtered(dt.one_stream(spark, sf_dir), condition, 20, 120)


@check(
    f"""WITH {_FOUR}, hits AS (SELECT *, count(*) OVER (PARTITION BY stream_id) AS n,
        row_number() OVER (PARTITION BY stream_id ORDER BY log_event_idx) - 1 AS filtered_idx
        FROM four WHERE k >= CASE stream_id WHEN 's1' THEN 95 ELSE 20 END)
    SELECT stream_id, log_event_idx + 1 AS log_event_num, log_level, timestamp, utc_offset
    FROM hits WHERE n >= 12 AND filtered_idx >= 2 AND filtered_idx < 12"""
)
def page_filtered_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of four streams that lie in different chunks of positions, from counts kept for the filter."""
    events = dt.four_streams(spark, sf_dir)
    condition = F.when(F.col(STREAM) == "s1", kv("k") >= 95).otherwise(kv("k") >= 20)
    counted = filters.match_offsets(events, condition, bits=4)
    page = paging.page_filtered(events, condition, 2, 12, bits=4, counted=counted)
    return page.select(STREAM, "log_event_num", LEVEL, TS, OFFSET)


@check(
    f"""WITH {_FOUR} SELECT stream_id, log_event_idx,
        row_number() OVER (PARTITION BY stream_id ORDER BY log_event_idx) - 1 AS filtered_idx
    FROM four WHERE log_level IN (4, 5, 6) AND k >= 50"""
)
def filtered_index_map_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered index map over many chunks of positions."""
    condition = filters.filter_condition([4, 5, 6], kv("k") >= 50)
    return filters.filtered_index_map(dt.four_streams(spark, sf_dir), condition, bits=6)


@check(ORACLES["filtered_index_map"])
def filtered_index_map_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered index map of two kept filters, combined as bitmaps."""
    log = LogTable(dt.four_streams(spark, sf_dir))
    return (log.filter(levels=[4, 5, 6]).keep() & log.filter(predicate=kv("k") >= 50).keep()).filtered_index_map()


@check(
    f"""WITH {_FOUR}, hits AS (SELECT *, count(*) OVER (PARTITION BY stream_id) AS n,
        row_number() OVER (PARTITION BY stream_id ORDER BY log_event_idx) - 1 AS filtered_idx
        FROM four WHERE log_level = 5 OR k < 10)
    SELECT stream_id, log_event_idx + 1 AS log_event_num, log_level, timestamp, utc_offset
    FROM hits WHERE n >= 40 AND filtered_idx >= 10 AND filtered_idx < 40"""
)
def page_filtered_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the events that match one of two kept filters."""
    log = LogTable(dt.four_streams(spark, sf_dir))
    found = log.filter(levels=[5]).keep() | log.filter(predicate=kv("k") < 10).keep()
    return found.page(10, 40, use_filter=True).select(STREAM, "log_event_num", LEVEL, TS, OFFSET)


@check(f"WITH {_ONE} {_DECODED} FROM one WHERE false")
def page_filtered_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter that keeps every event of a structured stream is not active: no filtered page."""
    return paging.page_filtered(dt.one_stream(spark, sf_dir), filters.filter_condition(range(7)), 0, 10)


@check(
    f"""WITH hits AS (SELECT event_id, ts, user_id, event_type, props,
        row_number() OVER (ORDER BY event_id) - 1 AS filtered_idx FROM events WHERE event_type = 'error')
    SELECT 'all' AS stream_id, event_id + 1 AS log_event_num, CAST(5 AS TINYINT) AS log_level,
        ' ' || upper(event_type) || ' user=' || CAST(user_id AS VARCHAR) || ' props=' || props AS message,
        {_MILLIS} AS timestamp, {_SECONDS} // 60 AS utc_offset
    FROM hits WHERE filtered_idx >= 10 AND filtered_idx < 110"""
)
def page_unstructured(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = filters.filter_condition([5], stream_type=UNSTRUCTURED)
    return paging.page_filtered(dt.text_stream(spark, sf_dir), condition, 10, 110, UNSTRUCTURED)


# --- nearest event ---------------------------------------------------------------------------

_MID_JANUARY = 1705320000000  # 2024-01-15 12:00 UTC


def _point_sql(target: int) -> str:
    return f"""WITH {_FOUR}, coarse AS (SELECT stream_id, log_event_idx, timestamp // 600000 * 600000 AS t FROM four)
    SELECT stream_id, coalesce(max(log_event_idx) FILTER (WHERE t <= {target}), min(log_event_idx))
        AS log_event_idx FROM coarse GROUP BY stream_id"""


@check(_point_sql(_MID_JANUARY))
def nearest_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_event(dt.four_streams(spark, sf_dir, dt.coarse_millis()), _MID_JANUARY)


@check(_point_sql(0))
def nearest_point_before_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_event(dt.four_streams(spark, sf_dir, dt.coarse_millis()), 0)


def _stored(spark: SparkSession, sf_dir: str, bits: int = 8) -> LogTable:
    """The four streams as a stored table, in small chunks, so that most chunks can't hold an answer."""
    path = fresh_dir(spark, "stored-events")
    store_events(dt.four_streams(spark, sf_dir, dt.coarse_millis()), path, bits=bits)
    return LogTable.stored(spark, path)


@check(_point_sql(_MID_JANUARY))
def nearest_point_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).nearest(_MID_JANUARY)


@check(_point_sql(0))
def nearest_point_stored_before_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).nearest(0)


@check(f"WITH {_FOUR} SELECT stream_id, count(*) AS n_events FROM four GROUP BY stream_id")
def event_counts_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).event_counts()


_PROBE_SQL = """probes AS (SELECT o_orderkey, 's' || CAST(o_custkey % 5 AS VARCHAR) AS stream_id,
    1704060000000 + (o_orderkey * 173000) % 2700000000 AS target_ts FROM orders)"""


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time per order, from before the first event to after the last; stream s4 does not exist."""
    return dt.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("s"), F.col("o_custkey") % 5).alias(STREAM),
        (F.lit(1704060000000) + (F.col("o_orderkey") * 173000) % 2700000000).alias("target_ts"),
    )


@check(
    f"""WITH {_FOUR}, {_PROBE_SQL}, e AS (SELECT stream_id, timestamp // 600000 * 600000 AS t,
        max(log_event_idx) AS idx FROM four GROUP BY 1, 2),
    firsts AS (SELECT stream_id, min(log_event_idx) AS idx FROM four GROUP BY 1)
    SELECT p.o_orderkey, p.stream_id, p.target_ts, coalesce(e.idx, firsts.idx) AS log_event_idx
    FROM probes p ASOF LEFT JOIN e ON p.stream_id = e.stream_id AND p.target_ts >= e.t
    LEFT JOIN firsts ON p.stream_id = firsts.stream_id"""
)
def nearest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dt.four_streams(spark, sf_dir, dt.coarse_millis())
    return nearest.nearest_events(events, _probes(spark, sf_dir))


# --- counts, files, checks -------------------------------------------------------------------


@check(f"WITH {_FOUR} SELECT stream_id, count(*) AS n_events FROM four GROUP BY stream_id")
def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.event_counts(dt.four_streams(spark, sf_dir))


@check("SELECT CAST(conv_id AS VARCHAR) AS stream_id, count(*) AS n_events FROM conversations GROUP BY conv_id")
def event_counts_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = dt.table(spark, sf_dir, "conversations")
    return files.event_counts(turns.withColumn(STREAM, F.col("conv_id").cast("string")))


_INFOS = f"""infos AS (SELECT stream_id, source_file AS file_name, min(log_event_idx) AS log_event_idx_start,
    max(log_event_idx) + 1 AS log_event_idx_end, count(*) AS log_event_count FROM four GROUP BY 1, 2)"""


@check(
    f"""WITH {_FOUR}, {_INFOS} SELECT *,
    log_event_idx_end - log_event_idx_start = log_event_count AS is_contiguous FROM infos"""
)
def file_infos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.file_infos(dt.four_streams(spark, sf_dir))


@check(f"WITH {_FOUR}, {_INFOS} SELECT stream_id, file_name, log_event_idx_start FROM infos")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.file_names(dt.four_streams(spark, sf_dir))


@check(f"WITH {_FOUR} SELECT stream_id, log_event_idx, source_file AS file_name FROM four")
def event_to_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dt.four_streams(spark, sf_dir)
    return files.attach_file(events.select(STREAM, IDX), files.file_infos(events))


_INTERLEAVED = f"""{_FOUR}, halves AS (SELECT stream_id, log_event_idx,
        'h' || CAST(log_event_idx // 700 % 2 AS VARCHAR) AS half FROM four),
    ranges AS (SELECT stream_id, half, min(log_event_idx) AS a, max(log_event_idx) + 1 AS z FROM halves GROUP BY ALL)
    SELECT e.stream_id, e.log_event_idx, arg_max(r.half, r.a) AS file_name
    FROM four e JOIN ranges r ON r.stream_id = e.stream_id AND e.log_event_idx >= r.a AND e.log_event_idx < r.z
    GROUP BY ALL"""


def _interleaved(spark: SparkSession, sf_dir: str, broadcast_ranges: int) -> DataFrame:
    """Two interleaved files per stream, so their ranges overlap, in chunks of 64 positions."""
    events = dt.four_streams(spark, sf_dir)
    events = events.withColumn(FILE, F.format_string("h%d", F.floor(F.col(IDX) / 700) % 2))
    return files.attach_file(events.select(STREAM, IDX), files.file_infos(events), 6, broadcast_ranges)


@check(f"WITH {_INTERLEAVED}")
def event_to_file_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interleaved(spark, sf_dir, 1_000_000)


@check(f"WITH {_INTERLEAVED}")
def event_to_file_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interleaved(spark, sf_dir, 0)


@check(
    f"""WITH {_FOUR}, steps AS (SELECT stream_id, log_event_idx, utc_offset,
        lag(utc_offset) OVER (PARTITION BY stream_id ORDER BY log_event_idx) AS previous_utc_offset FROM four)
    SELECT * FROM steps WHERE utc_offset <> previous_utc_offset"""
)
def offset_changes_small_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.offset_changes(dt.four_streams(spark, sf_dir), 6)


@check(
    f"""WITH {_FOUR}, steps AS (SELECT stream_id, log_event_idx, utc_offset,
        lag(utc_offset) OVER (PARTITION BY stream_id ORDER BY log_event_idx) AS previous_utc_offset FROM four)
    SELECT * FROM steps WHERE utc_offset <> previous_utc_offset"""
)
def offset_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.offset_changes(dt.four_streams(spark, sf_dir))


@check(
    f"""WITH {_FOUR}, shaken AS (SELECT stream_id, log_event_idx,
        CASE WHEN stream_id <> 's0' AND event_id % 97 = 0 THEN timestamp - 3600000 ELSE timestamp END AS t FROM four),
    steps AS (SELECT *, t < lag(t) OVER (PARTITION BY stream_id ORDER BY log_event_idx) AS back FROM shaken)
    SELECT stream_id, count(*) AS n_events, count(*) FILTER (WHERE back) AS n_inversions,
        min(log_event_idx) FILTER (WHERE back) AS first_bad_idx,
        count(*) FILTER (WHERE back) = 0 AS is_chronological
    FROM steps GROUP BY stream_id"""
)
def chronology_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th event set back an hour, except in stream s0."""
    shaken = F.when(
        (F.col(STREAM) != "s0") & (F.col("event_id") % 97 == 0), ntz_to_millis(F.col("ts")) - 3600000
    ).otherwise(ntz_to_millis(F.col("ts")))
    return diagnostics.chronology_check(dt.four_streams(spark, sf_dir, shaken))


@check(
    """SELECT 's' || CAST(n AS VARCHAR) AS stream_id, o AS option, 'auto' AS namespace, o AS key_path FROM
    (SELECT DISTINCT event_id % 4 AS n FROM events) CROSS JOIN (VALUES ('log_level'), ('timestamp'), ('utc_offset')) AS t(o)
    WHERE (n = 1 AND o = 'timestamp') OR (n = 2 AND o = 'log_level') OR (n = 3 AND o = 'utc_offset')"""
)
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times are text in s1, levels absent in s2, offsets empty in s3."""
    options = ReaderOptions(
        KeyPath(True, ("log_level",)), KeyPath(True, ("timestamp",)), KeyPath(True, ("utc_offset",))
    )
    e, group = F.col("event_id"), F.col("event_id") % 4
    auto = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            F.when(group != 2, '"log_level":"INFO"'),
            F.when(group == 1, F.concat(F.lit('"timestamp":"'), e, F.lit('"'))).otherwise(
                F.concat(F.lit('"timestamp":'), e)
            ),
            F.when(group == 3, '"utc_offset":null').otherwise('"utc_offset":3600'),
        ),
        F.lit("}"),
    )
    events = structured_events(
        dt.table(spark, sf_dir, "events"),
        options,
        stream=F.concat(F.lit("s"), group),
        idx=F.expr("event_id div 4"),
        auto=auto,
    )
    return diagnostics.missing_keys(events, options)


@check(
    """WITH counted AS (SELECT
        count(*) FILTER (WHERE event_id % 7 = 2) AS l_empty, count(*) FILTER (WHERE event_id % 7 = 4) AS l_type,
        count(*) FILTER (WHERE event_id % 7 = 5) AS l_name, count(*) FILTER (WHERE event_id % 5 = 1) AS t_empty,
        count(*) FILTER (WHERE event_id % 5 = 0) AS t_type, count(*) FILTER (WHERE event_id % 3 = 0) AS o_type FROM events)
    SELECT 'all' AS stream_id, o AS option, r AS reason, n AS n_events FROM (
        SELECT 'log_level' AS o, 'empty' AS r, l_empty AS n FROM counted
        UNION ALL SELECT 'log_level', 'wrong_type', l_type FROM counted
        UNION ALL SELECT 'log_level', 'unknown_name', l_name FROM counted
        UNION ALL SELECT 'timestamp', 'empty', t_empty FROM counted
        UNION ALL SELECT 'timestamp', 'wrong_type', t_type FROM counted
        UNION ALL SELECT 'utc_offset', 'wrong_type', o_type FROM counted) WHERE n > 0"""
)
def protocol_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.protocol_errors(dt.irregular_events(spark, sf_dir), dt.OPTIONS)


@check(
    """WITH forms AS (SELECT event_id % 7 AS s, event_id % 5 AS f, event_id % 3 AS t FROM events)
    SELECT 'auto' AS namespace, 'level' AS path, CASE s WHEN 2 THEN 'VOID' WHEN 4 THEN 'BIGINT' ELSE 'STRING' END AS type,
        count(*) AS n_events FROM forms WHERE s <> 3 GROUP BY 3
    UNION ALL SELECT 'auto', 'timestamp', CASE f WHEN 0 THEN 'STRING' WHEN 1 THEN 'VOID' ELSE 'BIGINT' END, count(*)
        FROM forms GROUP BY 3
    UNION ALL SELECT 'auto', 'utc_offset', CASE t WHEN 0 THEN 'DECIMAL' ELSE 'BIGINT' END, count(*) FROM forms GROUP BY 3
    UNION ALL SELECT 'user', 'k', CASE s WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' WHEN 2 THEN 'VOID' ELSE 'DECIMAL' END,
        count(*) FROM forms WHERE s IN (0, 1, 2, 5) GROUP BY 3
    UNION ALL SELECT 'user', 'k/a', 'BIGINT', count(*) FROM forms WHERE s = 4
    UNION ALL SELECT 'user', 'k/a/b', 'BOOLEAN', count(*) FROM forms WHERE s = 6
    UNION ALL SELECT 'user', 'list', 'ARRAY', count(*) FROM forms WHERE s = 6"""
)
def schema_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    census = diagnostics.schema_census(dt.irregular_events(spark, sf_dir))
    return census.withColumn("path", F.array_join("path", "/"))


# --- templates -------------------------------------------------------------------------------


@check(
    f"""WITH m AS (SELECT event_id, ' ' || upper(event_type) || ' user=' || CAST(user_id AS VARCHAR)
        || ' props=' || props AS message FROM events),
    t AS (SELECT event_id, regexp_replace(message, '[A-Za-z0-9_./-]*[0-9][A-Za-z0-9_./-]*', chr(17), 'g') AS logtype,
        array_to_string(regexp_extract_all(message, '[A-Za-z0-9_./-]*[0-9][A-Za-z0-9_./-]*'), chr(1)) AS vars FROM m)
    SELECT logtype, count(*) AS n_events, min(event_id) AS first_idx, count(DISTINCT vars) AS n_distinct_vars
    FROM t GROUP BY logtype"""
)
def logtype_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.logtype_census(dt.text_stream(spark, sf_dir), distinct_vars="exact")


@check(
    f"""WITH {_LINES} SELECT logtype, count(*) AS n_events, min(log_event_idx) AS first_idx
    FROM lines GROUP BY logtype"""
)
def logtype_census_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.logtype_census(dt.document_lines(spark, sf_dir))


@check(
    f"""WITH {_LINES} SELECT stream_id, log_event_idx, logtype, CAST(len(vars) AS BIGINT) AS n_vars,
        line AS message FROM lines"""
)
def message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message as put back together from its template and variables."""
    return templates.with_message(dt.document_lines(spark, sf_dir)).select(
        STREAM, IDX, LOGTYPE, F.size("vars").cast("bigint").alias("n_vars"), MESSAGE
    )


# --- streaming -------------------------------------------------------------------------------


@check(f"WITH {_ONE} {_DECODED} FROM one WHERE log_level IN (4, 5, 6) AND k >= 50")
def streaming_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` arriving as a stream: derived, filtered, rendered and appended to a table."""
    schema = dt.table(spark, sf_dir, "events").schema
    # As a pattern the path may be one file or a folder of part files.
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir}/events[.]parquet")
    events = normalise(
        arriving,
        lambda rows: dt.build_structured(rows, F.lit("all"), F.col("event_id")),
        levels=[4, 5, 6],
        predicate=kv("k") >= 50,
    )
    out = fresh_dir(spark, "normalised")
    append_to(paging.decode(events), f"{out}/table", f"{out}/progress").awaitTermination()
    return spark.read.parquet(f"{out}/table")


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """`events` with every 97th set back an hour outside s0, arriving in thirds; the query ends and starts again between them."""
    rows, out = dt.table(spark, sf_dir, "events"), fresh_dir(spark, "streamed")
    third = F.floor(F.col("event_id") * 3 / ((rows.agg(F.max("event_id")).first()[0] or 0) + 1))
    shaken = F.when(
        (F.col(STREAM) != "s0") & (F.col("event_id") % 97 == 0), ntz_to_millis(F.col("ts")) - 3600000
    ).otherwise(ntz_to_millis(F.col("ts")))
    for part in range(3):
        rows.where(third == part).write.mode("append").parquet(f"{out}/in")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{out}/in")
        append_positions(
            arriving.withColumn(STREAM, F.concat(F.lit("s"), F.col("user_id") % 4)),
            lambda numbered: dt.build_structured(numbered, F.col(STREAM), F.col(IDX), shaken),
            ["event_id"],
            f"{out}/table",
            f"{out}/progress",
            bits=10,
        ).awaitTermination()
    return f"{out}/table"


@check(
    f"""WITH {_FOUR} SELECT stream_id, log_event_idx, source_file, log_level, timestamp
        - CASE WHEN stream_id <> 's0' AND event_id % 97 = 0 THEN 3600000 ELSE 0 END AS timestamp, utc_offset FROM four"""
)
def streaming_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a stream in three micro-batches with restarts, at the positions of one batch load."""
    return _flat(LogTable.appended(spark, _streamed(spark, sf_dir)).events)


@check(ORACLES["offset_changes"])
def streaming_offset_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_changes_so_far(spark, _streamed(spark, sf_dir))


@check(ORACLES["chronology_check"])
def streaming_chronology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chronology_so_far(spark, _streamed(spark, sf_dir))
