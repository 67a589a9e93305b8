import json
import random

import pytest
from pyspark.sql import functions as F

from eventloom import KeyPath, ReaderOptions
from eventloom.operators import diagnostics, templates
from eventloom.schema import AUTO, IDX, LOGTYPE, OFFSET, STREAM, USER, VARS
from tests.helpers import events, values


@pytest.mark.parametrize("bits", [0, 2, 18])
def test_steps_against_a_model(spark, bits):
    rng = random.Random(6)
    rows = []
    for stream, n in (("hot", 150), ("b", 20), ("one", 1)):
        rows += [(stream, i, i + rng.choice([0, 0, -30]), 0, "{}", rng.choice([0, 0, 60]),) for i in range(n)]
    e = events(spark, rows).repartition(4)
    by_stream = {}
    for r in rows:
        by_stream.setdefault(r[0], []).append(r)
    changes, backward = [], {}
    for stream, seen in by_stream.items():
        for prev, own in zip(seen, seen[1:]):
            if prev[5] != own[5]:
                changes.append((stream, own[1], own[5], prev[5]))
            if own[2] < prev[2]:
                backward.setdefault(stream, []).append(own[1])
    got = diagnostics.offset_changes(e, bits)
    assert values(got, STREAM, IDX, OFFSET, "previous_utc_offset") == sorted(changes)
    got = diagnostics.chronology_check(e, bits).collect()
    assert {r[STREAM]: (r["n_events"], r["n_inversions"], r["first_bad_idx"], r["is_chronological"]) for r in got} == {
        s: (len(seen), len(backward.get(s, [])), min(backward.get(s, [0])) if s in backward else None, s not in backward)
        for s, seen in by_stream.items()
    }


OPTIONS = ReaderOptions(KeyPath(False, ("l",)), KeyPath(False, ("m", "t")), None)


def kv_events(spark, rows):
    frame = spark.createDataFrame([(s, i, json.dumps(u)) for i, (s, u) in enumerate(rows)], f"{STREAM} string, {IDX} bigint, u string")
    return frame.withColumns({AUTO: F.parse_json(F.lit('{"host":"h1"}')), USER: F.parse_json("u")})


def test_missing_keys_per_stream(spark):
    rows = [("a", {"l": "INFO"}), ("a", {"m": {"t": 5}}), ("b", {"l": None, "m": {"t": "5"}}), ("b", {"l": 3}), ("c", {})]
    got = diagnostics.missing_keys(kv_events(spark, rows), OPTIONS)
    assert values(got, STREAM, "option", "namespace", "key_path") == [
        ("b", "log_level", "user", "l"), ("b", "timestamp", "user", "m/t"),
        ("c", "log_level", "user", "l"), ("c", "timestamp", "user", "m/t")]
    assert diagnostics.missing_keys(kv_events(spark, rows), ReaderOptions()).count() == 0


def test_protocol_errors(spark):
    rows = [("a", {"l": None}), ("a", {"l": 3}), ("a", {"l": "nope"}), ("a", {"l": "none"}), ("a", {"l": "warn"}), ("a", {}),
            ("a", {"m": {"t": None}}), ("b", {"m": {"t": "x"}}), ("b", {"m": {"t": 1.5}}), ("b", {"m": {"t": 1}})]
    got = diagnostics.protocol_errors(kv_events(spark, rows), OPTIONS)
    assert values(got, STREAM, "option", "reason", "n_events") == [
        ("a", "log_level", "empty", 1), ("a", "log_level", "unknown_name", 2), ("a", "log_level", "wrong_type", 1),
        ("a", "timestamp", "empty", 1), ("b", "timestamp", "wrong_type", 2)]
    assert diagnostics.protocol_errors(kv_events(spark, rows), ReaderOptions()).count() == 0


def leaves(value, path=()):
    if isinstance(value, dict) and (value or not path):
        return [leaf for k, v in value.items() for leaf in leaves(v, (*path, k))]
    kinds = {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", type(None): "VOID"}
    return [(path, kinds[type(value)])]


def test_schema_census_counts_every_leaf(spark):
    rng = random.Random(7)

    def value(depth):
        if depth and rng.random() < 0.6:
            return {k: value(depth - 1) for k in rng.sample(["a", "b.c", "d`<", "e>", "OBJECT<"], rng.randrange(4))}
        return rng.choice([1, "x", None, True, 2.5, [1, {"z": 1}], {}])

    rows = [("a", {"r": value(5)}) for _ in range(60)]
    model = {}
    for _, u in rows:
        for path, kind in leaves(u):
            model[("user", path, kind)] = model.get(("user", path, kind), 0) + 1
    model[("auto", ("host",), "STRING")] = 60
    got = diagnostics.schema_census(kv_events(spark, rows))
    assert {(r["namespace"], tuple(r["path"]), r["type"]): r["n_events"] for r in got.collect()} == model


def test_schema_census_of_empty_and_missing_namespaces(spark):
    e = kv_events(spark, [("a", {}), ("a", {"x": {}}), ("a", {"x": []})])
    e = e.withColumn(AUTO, F.when(F.col(IDX) == 0, F.col(AUTO)))
    got = diagnostics.schema_census(e).collect()
    assert sorted((r["namespace"], *r["path"], r["type"], r["n_events"]) for r in got) == [
        ("auto", "host", "STRING", 1), ("user", "x", "ARRAY", 1), ("user", "x", "OBJECT", 1)]
    assert diagnostics.schema_census(e.where("false")).count() == 0


def test_logtype_census(spark):
    texts = ["a 1", "a 2", "a 2", "b", "keep \x11 1"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"{IDX} bigint, message string")
    split = templates.with_template(frame)
    census = templates.logtype_census(split, "exact")
    assert values(census, LOGTYPE, "n_events", "first_idx", "n_distinct_vars") == [
        ("a \x11", 3, 0, 2), ("b", 1, 3, 1), ("keep \x11 1", 1, 4, 0)]
    assert values(templates.logtype_census(split, "approx"), "n_distinct_vars") == [(0,), (1,), (2,)]
    assert values(templates.logtype_census(split), "n_events") == [(1,), (1,), (3,)]
    with pytest.raises(ValueError):
        templates.logtype_census(split, "guess")
    assert sorted(r["message"] for r in templates.with_message(split.select(LOGTYPE, VARS)).collect()) == sorted(texts)
