"""Quality rules: surface counts, then a hashed n-gram log-likelihood ratio (built-in functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.frames import bind, join_small, settle

BUCKETS = 10_000
MIN_WORDS = 50
BINS, BIN = 4_000, 0.002  # score histogram for the threshold: from -4 to 4 nats per n-gram
MIN_KEPT = 0.995  # share of the trusted labelled documents that the threshold must keep
_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that occurs at least twice in the text."""
    n = F.size(words)

    def covered(ordered: Column) -> Column:
        hash_at = lambda i: F.get(ordered, i)["h"]
        twice = F.filter(
            F.sequence(F.lit(0), n - 3),
            lambda j: F.coalesce(
                (hash_at(j) == hash_at(j + 1)) | F.when(j > 0, hash_at(j) == hash_at(j - 1)).otherwise(False),
                F.when(j > 0, hash_at(j) == hash_at(j - 1)).otherwise(False),
            ),
        )
        starts = F.transform(twice, lambda j: F.get(ordered, j)["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
        ),
    )
    return F.when(n >= 4, bind(F.sort_array(windows), covered)).otherwise(0)


def surface_counts(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, carried columns, words (array) and the base counts of every document; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", *carried, text.alias("text"), _words(text).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_words = F.size("words").cast("bigint")
    counted = split.select(
        "doc_id",
        *carried,
        "words",
        n_words.alias("n_words"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _features(words: Column) -> Column:
    """Hash buckets of all words and all pairs of neighbouring words."""
    bucket = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(words) - 2), lambda i: bucket(F.xxhash64(F.get(words, i), F.get(words, i + 1)))
    )
    single = F.transform(words, lambda w: bucket(F.xxhash64(w)))
    return F.when(F.size(words) >= 2, F.concat(single, pairs)).otherwise(single)


def fit_ratio(docs: DataFrame, labels: DataFrame) -> list[float]:
    """Log ratio, per bucket, of the trusted and the raw multinomial, both with one added per bucket.

    Raw counts cover every n-gram of every document, trusted ones those of documents labelled good
    (quality 1, not toxic). Only the BUCKETS counts come to the driver, whatever the size of the input.
    """
    trusted = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    trusted = settle(trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "trusted")
    flagged = join_small(
        docs.select("doc_id", "text"), trusted.withColumn("good", F.lit(1)), "doc_id", "left"
    )
    words = flagged.select("good", _words(F.coalesce("text", F.lit(""))).alias("words"))
    counts = (
        words.select("good", F.explode(_features(F.col("words"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("good").alias("good"))
        .collect()
    )
    raw, good = [1] * BUCKETS, [1] * BUCKETS
    for row in counts:
        raw[row["bucket"]] += row["raw"]
        good[row["bucket"]] += row["good"]
    all_raw, all_good = sum(raw), sum(good)
    return [math.log(g / all_good) - math.log(r / all_raw) for g, r in zip(good, raw)]


def score(words: Column, ratio: list[float]) -> Column:
    """Mean log ratio over a document's n-grams; 0 without words."""
    table = F.lit(ratio)
    return bind(
        _features(words),
        lambda f: F.when(
            F.size(f) > 0, F.aggregate(f, F.lit(0.0), lambda s, b: s + F.get(table, b)) / F.size(f)
        ).otherwise(0.0),
    )


def fit_threshold(scored: DataFrame, labels: DataFrame) -> float | None:
    """The score that separates good from bad labelled documents best and keeps nearly all good ones.

    From a histogram of a fixed number of bins over all labelled documents: among the bin edges that keep
    at least MIN_KEPT of the good ones, the one that rejects most bad ones, the lowest if several do.
    Without labels of both kinds there is none, and every document passes. A document labelled more than once
    counts with its lowest quality.
    """
    marks = settle(labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality")), "marks")
    bin_of = F.least(F.greatest(F.floor(F.col("score") / BIN) + BINS // 2, F.lit(0)), F.lit(BINS - 1))
    rows = (
        join_small(scored.where(~F.col("base_failed")).select("doc_id", "score"), marks, "doc_id", "inner")
        .groupBy(bin_of.alias("bin"))
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
        .orderBy("bin")
        .collect()
    )
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        return None
    best, most, lost, caught = None, 0, 0, 0
    for row in rows:  # an edge just above this bin
        lost, caught = lost + row["good"], caught + row["bad"]
        if lost > (1 - MIN_KEPT) * good:
            break
        if caught > most:
            best, most = (row["bin"] - BINS // 2 + 1) * BIN, caught
    return best


def quality(docs: DataFrame, labels: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Every document with its counts, score and verdict `kept`.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score,
    kept. Rows stay as they are, repeated ones too; a null or empty text fails the base rules. Extra
    columns of either table are ignored, but for those of docs that are to be carried along.
    """
    ratio = fit_ratio(docs, labels)
    scored = settle(
        surface_counts(docs, carried).withColumn("score", score(F.col("words"), ratio)).drop("words"), "quality"
    )
    threshold = fit_threshold(scored, labels)
    passes = F.lit(True) if threshold is None else F.col("score") >= threshold
    return scored.withColumn("kept", ~F.col("base_failed") & passes)
