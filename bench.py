"""Time the headline operations and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

`load` builds both event tables from raw rows and stores them in parquet, as a user does once; the other
operations read that table. Every result is computed in full (noop sink). Each operation runs twice:
"first_run" has the JVM and code generation cold, "queries" and "value" are the second runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from eventloom import kv
from eventloom.operators import diagnostics, files, filters, nearest, paging, templates
from eventloom.plans import driver_tables as dt
from eventloom.schema import IDX, STREAM
from eventloom.session import local_session
from eventloom.sources.store import open_events, store_events


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="eventloom-bench-")
    condition = filters.filter_condition([4, 5, 6], kv("k") >= 50)

    def load(run: int) -> None:
        store_events(dt.four_streams(spark, sf_dir), f"{scratch}/four-{run}")
        store_events(dt.text_stream(spark, sf_dir), f"{scratch}/text-{run}")

    def four():
        return open_events(spark, f"{scratch}/four-0")

    def text():
        return open_events(spark, f"{scratch}/text-0")

    def probes():
        return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
            F.concat(F.lit("s"), F.col("o_custkey") % 4).alias(STREAM),
            (F.lit(1704060000000) + (F.col("o_orderkey") * 173000) % 2700000000).alias("target_ts"),
        )

    operations = {
        "load": load,
        "event_counts": lambda _: consume(files.event_counts(four())),
        "level_filter": lambda _: consume(filters.filter_events(four(), [4, 5, 6])),
        "kv_and_level": lambda _: consume(four().where(condition)),
        "render_all": lambda _: consume(paging.decode(four())),
        "page": lambda _: consume(paging.page(four(), 5000, 5100)),
        "page_filtered": lambda _: consume(paging.page_filtered(four(), condition, 1000, 1100)),
        "filtered_index_map": lambda _: consume(filters.filtered_index_map(four(), condition)),
        "nearest_point": lambda _: consume(nearest.nearest_event(four(), 1705320000000)),
        "nearest_batch": lambda _: consume(nearest.nearest_events(four(), probes())),
        "file_infos": lambda _: consume(files.file_infos(four())),
        "event_to_file": lambda _: consume(
            files.attach_file(four().select(STREAM, IDX), files.file_infos(four()))
        ),
        "chronology_check": lambda _: consume(diagnostics.chronology_check(four())),
        "offset_changes": lambda _: consume(diagnostics.offset_changes(four())),
        "schema_census": lambda _: consume(diagnostics.schema_census(four())),
        "logtype_census": lambda _: consume(templates.logtype_census(text(), "exact")),
        "message_round_trip": lambda _: consume(templates.with_message(text())),
    }
    timings: list[dict[str, float]] = []
    for run in range(2):
        times = {}
        for name, operation in operations.items():
            started = time.perf_counter()
            operation(run)
            times[name] = round(time.perf_counter() - started, 3)
        timings.append(times)
    print(
        json.dumps(
            {
                "metric": "headline_operations_total",
                "value": round(sum(timings[1].values()), 3),
                "unit": "sec",
                "queries": timings[1],
                "first_run": timings[0],
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
