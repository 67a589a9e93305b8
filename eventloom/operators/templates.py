"""Message templates: split messages, put them back together, count templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import render_unstructured, template_of, variables_of
from eventloom.schema import IDX, LOGTYPE, MESSAGE, VARS


def with_template(rows: DataFrame, message: Column | None = None) -> DataFrame:
    """Add logtype and vars for a message column."""
    message = F.col(MESSAGE) if message is None else message
    return rows.withColumns({LOGTYPE: template_of(message), VARS: variables_of(message)})


def with_message(rows: DataFrame) -> DataFrame:
    """Add the message rebuilt from logtype and vars."""
    return rows.withColumn(MESSAGE, render_unstructured(F.col(LOGTYPE), F.col(VARS)))


def logtype_census(events: DataFrame, distinct_vars: str | None = None) -> DataFrame:
    """(logtype, n_events, first_idx[, n_distinct_vars]) over all events.

    distinct_vars: None, 'approx' (a sketch per template, combined before the shuffle) or 'exact'
    (shuffles every distinct template and variable list).
    """
    measures = [F.count("*").alias("n_events"), F.min(IDX).alias("first_idx")]
    if distinct_vars == "approx":
        measures.append(F.approx_count_distinct(VARS).alias("n_distinct_vars"))
    elif distinct_vars == "exact":
        measures.append(F.count_distinct(VARS).alias("n_distinct_vars"))
    elif distinct_vars is not None:
        raise ValueError(f"distinct_vars: {distinct_vars!r}")
    return events.groupBy(LOGTYPE).agg(*measures)
