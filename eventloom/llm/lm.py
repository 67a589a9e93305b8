"""A log-bilinear language model with noise-contrastive estimation, and its scores.

Classes: the most frequent tokens one by one, all others in GROUPS classes by the hash of their last
bytes; a rare token's probability is that of its class times its discounted share of the class, and what
the discount leaves is the class's share for unknown tokens. The context is the two classes before:
score(w | u, v) = Q[w] . (c1 * R[u] + c2 * R[v]) + b[w]. All tasks train on their own documents from the
same start, and their parameters are averaged in a tree.

As the score is a sum over the two context words, the normaliser of every context is one matrix product:
Z[u, v] = sum_w exp(A[u, w] + b[w]) exp(B[v, w]). Token log-probabilities are then table lookups.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.frames import settle
from eventloom.llm.words import buffer_of, lower_ascii, mix, slices, span_hashes, word_spans

HEAD = 1536  # tokens with a class of their own
GROUPS = 256  # classes of all other tokens
KNOWN = 300_000  # tokens whose counts are told to every task; counts of others are joined
DISCOUNT = 0.7
SIZE = 16  # of the vectors
BATCH, NOISE, NOISE_RATIO, RATE = 4096, 64, 16.0, 0.05
TASK_TOKENS = 4_000_000  # a training task gets about so many tokens
MIN_STEPS = 150
FAN_IN = 64
END = np.uint64(0x5EED0E0F5EED0E0F)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with END after each text, their groups, and each text's first token (n + 1 entries)."""
    data, offsets = buffer_of(column)
    data = lower_ascii(data)
    starts, ends, firsts = word_spans(data, offsets)
    tokens = span_hashes(data, starts, ends)
    groups = (span_hashes(data, np.maximum(starts, ends - 3), ends, 2) % np.uint64(GROUPS)).astype(np.int32)
    return np.insert(tokens, firsts[1:], END), np.insert(groups, firsts[1:], 0), firsts + np.arange(len(firsts))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def report() -> pa.RecordBatch:
        tokens, groups, counts = (np.concatenate(c) for c in zip(*held))
        held.clear()
        known, where, which = np.unique(tokens, return_index=True, return_inverse=True)
        totals = np.bincount(which, counts).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(groups[where]), pa.array(totals)], ["token", "grp", "n"])

    for batch in (piece for batch in batches for piece in slices(batch, "text")):
        tokens, groups, _ = _tokens(batch.column("text"))
        known, where, counts = np.unique(tokens, return_index=True, return_counts=True)
        held.append((known, groups[where], counts))
        if len(held) >= 16:
            yield report()
    if held:
        yield report()


@dataclass(frozen=True)
class Vocabulary:
    head: np.ndarray  # sorted token hashes; class = position
    bias: np.ndarray  # natural log of each class's share of the training tokens
    group_total: np.ndarray  # training tokens and different tokens of each group
    group_types: np.ndarray

    def classes(self, tokens: np.ndarray, groups: np.ndarray) -> np.ndarray:
        if not len(self.head):
            return groups.astype(np.int64)
        at = np.minimum(np.searchsorted(self.head, tokens), len(self.head) - 1)
        return np.where(self.head[at] == tokens, at, len(self.head) + groups)

    def begin(self) -> int:
        """The class that stands before a text's first token."""
        return int(self.classes(np.array([END]), np.zeros(1, np.int32))[0])

    def contexts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(class, class before, class before that) of all tokens; tokens, groups, first token of each text."""
        tokens, groups, firsts = _tokens(column)
        w = self.classes(tokens, groups)
        one, two = np.r_[self.begin(), w[:-1]], np.r_[self.begin(), self.begin(), w[:-2]][: len(w)]
        starts = firsts[:-1]
        one[starts] = two[starts] = self.begin()
        second = starts[np.diff(firsts) > 1] + 1
        two[second] = self.begin()
        return w, one, two, tokens, groups, firsts


def fit_vocabulary(counts: DataFrame) -> Vocabulary:
    """From the stored counts: HEAD tokens and GROUPS sums come to the driver, however many there are."""
    top = counts.orderBy(F.desc("n"), "token").limit(HEAD).collect()
    least = (top[-1]["n"], top[-1]["token"]) if top else (0, 0)
    rest = counts.where((F.col("n") < least[0]) | ((F.col("n") == least[0]) & (F.col("token") > least[1])))
    total, types = np.zeros(GROUPS), np.zeros(GROUPS)
    for row in rest.groupBy("grp").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        total[row["grp"]], types[row["grp"]] = row["n"], row["types"]
    head = np.array([r["token"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(head)
    mass = np.r_[np.array([r["n"] for r in top], float)[order], total] + 0.5
    return Vocabulary(head[order], np.log(mass / mass.sum()), total, types)


class Model:
    """Parameters as one float32 vector: R, Q (classes x SIZE), b, c1, c2."""

    def __init__(self, vocabulary: Vocabulary, values: np.ndarray | None = None) -> None:
        n = len(vocabulary.bias)
        if values is None:
            draw = np.random.default_rng(7).normal(0, 0.1, (2, n, SIZE))
            values = np.r_[draw.ravel(), vocabulary.bias, np.ones(2 * SIZE)].astype(np.float32)
        self.values, self.n = values, n
        shapes = [(n, SIZE), (n, SIZE), (n,), (SIZE,), (SIZE,)]
        self.r, self.q, self.b, self.c1, self.c2 = self._views(values, shapes)
        self.shapes = shapes

    @staticmethod
    def _views(values: np.ndarray, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        return [values[e - int(np.prod(s)) : e].reshape(s) for e, s in zip(ends, shapes)]

    def _scatter(self, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(rows, values[:, k], self.n) for k in range(values.shape[1])], axis=1)

    def train(self, examples: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], noise: np.ndarray) -> int:
        """Adagrad steps of noise-contrastive estimation over batches (w, u, v); returns the steps made."""
        random, steps = np.random.default_rng(11), 0
        log_noise = np.log(NOISE_RATIO * noise).astype(np.float32)
        cumulative = np.cumsum(noise)
        gradient, squares = np.zeros_like(self.values), np.full(len(self.values), 1e-6, np.float32)
        gr, gq, gb, g1, g2 = self._views(gradient, self.shapes)
        for w, u, v in examples:
            drawn = np.minimum(np.searchsorted(cumulative, random.random(NOISE) * cumulative[-1]), self.n - 1)
            ru, rv = self.r[u], self.r[v]
            context = ru * self.c1 + rv * self.c2
            qw, qn = self.q[w], self.q[drawn]
            good = np.einsum("ij,ij->i", context, qw) + self.b[w] - log_noise[w]
            bad = context @ qn.T + (self.b[drawn] - log_noise[drawn])
            up = 1 / (1 + np.exp(good))
            down = (-NOISE_RATIO / NOISE) / (1 + np.exp(-bad))
            back = up[:, None] * qw + down @ qn
            gq[:] = self._scatter(w, up[:, None] * context)
            np.add.at(gq, drawn, down.T @ context)
            gb[:] = np.bincount(w, up, self.n)
            np.add.at(gb, drawn, down.sum(axis=0))
            gr[:] = self._scatter(u, back * self.c1) + self._scatter(v, back * self.c2)
            g1[:], g2[:] = (back * ru).sum(axis=0), (back * rv).sum(axis=0)
            gradient /= len(w)
            squares += gradient * gradient
            self.values += RATE * gradient / np.sqrt(squares)
            steps += 1
        return steps

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A[u, w] with the bias, B[v, w] and log Z[u, v]; every context's probabilities sum to one."""
        a = (self.r * self.c1) @ self.q.T + self.b
        b = (self.r * self.c2) @ self.q.T
        top_a, top_b = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
        z = np.exp(a - top_a) @ np.exp(b - top_b).T
        return a, b, np.log(z) + top_a + top_b.T


def _train(vocabulary: Vocabulary):
    noise = np.exp(vocabulary.bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen, steps, kept = Model(vocabulary), 0, 0, []

        def examples() -> Iterator[tuple]:
            nonlocal seen
            for batch in (piece for batch in batches for piece in slices(batch, "text")):
                w, u, v, *_ = vocabulary.contexts(batch.column("text"))
                seen += len(w)
                if seen <= MIN_STEPS * BATCH:
                    kept.append((w, u, v))
                for at in range(0, len(w), BATCH):
                    yield w[at : at + BATCH], u[at : at + BATCH], v[at : at + BATCH]

        def again() -> Iterator[tuple]:
            for w, u, v in kept:
                for at in range(0, len(w), BATCH):
                    yield w[at : at + BATCH], u[at : at + BATCH], v[at : at + BATCH]

        steps = model.train(examples(), noise)
        while 0 < steps < MIN_STEPS:  # a task with few tokens goes over them again
            steps += model.train(again(), noise)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(seen)]), pa.array([model.values.tobytes()], pa.binary())],
                ["part", "weight", "params"],
            )

    return run


def _average(frame: pd.DataFrame) -> pd.DataFrame:
    weight, total = frame["weight"].to_numpy(), 0.0
    for w, params in zip(weight, frame["params"]):
        total = total + w * np.frombuffer(params, np.float32).astype(np.float64)
    mean = (total / weight.sum()).astype(np.float32)
    return pd.DataFrame({"part": [int(frame["part"].iloc[0]) // FAN_IN], "weight": [weight.sum()], "params": [mean.tobytes()]})


def train(docs: DataFrame, vocabulary: Vocabulary, n_tokens: int) -> Model:
    """One pass over all documents of docs; the parameters of the tasks are averaged FAN_IN by FAN_IN."""
    kind = "part bigint, weight double, params binary"
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-n_tokens // TASK_TOKENS))
    models = settle(docs.select("text").coalesce(tasks).mapInArrow(_train(vocabulary), kind), "models")
    while models.count() > 1:
        models = settle(models.groupBy(F.expr(f"part div {FAN_IN}")).applyInPandas(_average, kind), "models")
    found = models.first()
    return Model(vocabulary, np.frombuffer(found["params"], np.float32).copy() if found else None)


_SCORED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double,"
    " token bigint, grp int, times bigint"
)


class Scorer:
    """Sums over the tokens whose counts every task knows; the others are returned to be joined."""

    def __init__(self, vocabulary: Vocabulary, values: np.ndarray, known: np.ndarray, counts: np.ndarray, n: int, v: int) -> None:
        self.vocabulary, self.values, self.known, self.counts, self.n, self.v = vocabulary, values, known, counts, n, v

    @functools.cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return Model(self.vocabulary, self.values).tables()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "tables"}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        a, b, z = self.tables
        voc, head = self.vocabulary, len(self.vocabulary.head)
        for batch in (piece for batch in batches for piece in slices(batch, "text", 2 << 20)):
            w, u, v, tokens, groups, firsts = voc.contexts(batch.column("text"))
            n_docs = len(batch)
            doc = np.repeat(np.arange(n_docs), np.diff(firsts))
            value = (a[u, w] + b[v, w] - z[u, v]).astype(np.float64) / np.log(10)
            count, told = np.zeros(len(w)), np.zeros(len(w), bool)
            if len(self.known):
                at = np.minimum(np.searchsorted(self.known, tokens), len(self.known) - 1)
                told = self.known[at] == tokens
                count[told] = self.counts[at[told]]
            base = np.where(told, np.log10((count + 1) / (self.n + self.v + 1)), 0.0)
            share = told & (w >= head)
            value[share] += np.log10((count[share] - DISCOUNT) / (voc.group_total[groups[share]] + 1))
            sums = lambda x: np.bincount(doc, x, n_docs)  # noqa: B023, E731
            rows = row + np.arange(n_docs)
            row += n_docs
            none = lambda kind: pa.nulls(n_docs, kind)  # noqa: B023, E731
            names = [c.split()[0] for c in _SCORED.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows), batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(firsts)),
                    pa.array(sums(told).astype(np.int64)), pa.array(sums(base)), pa.array(sums(value)),
                    none(pa.int64()), none(pa.int32()), none(pa.int64()),
                ],
                names,
            )
            rest = np.flatnonzero(~told)
            if len(rest):
                order = rest[np.lexsort((tokens[rest], doc[rest]))]
                new = np.r_[True, (tokens[order][1:] != tokens[order][:-1]) | (doc[order][1:] != doc[order][:-1])]
                first = np.flatnonzero(new)
                some, size = order[first], len(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[doc[some]]), pa.nulls(size, pa.int64()), pa.nulls(size, pa.bool_()), pa.nulls(size, pa.int64()),
                        pa.nulls(size, pa.int64()), pa.nulls(size, pa.float64()), pa.nulls(size, pa.float64()),
                        pa.array(tokens[some].view(np.int64)), pa.array(groups[some]), pa.array(np.diff(np.r_[first, len(order)])),
                    ],
                    names,
                )


def score_documents(docs: DataFrame) -> DataFrame:
    """Every row of docs as doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Documents whose crc32(doc_id as text) mod 7 is 2 are held out: counts, classes and vectors come from
    all others. Scores are log10 probabilities of the whole text with its end token; a null text is its
    end token alone, a null doc_id is not held out. Repeated rows are learned from and scored each on
    their own. Without training text all counts are 0 and every class is equally likely.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), "text")
    training = docs.where(~F.col("held_out"))
    partial = training.select("text").mapInArrow(_count, "token bigint, grp int, n bigint")
    counts = settle(partial.groupBy("token").agg(F.min("grp").alias("grp"), F.sum("n").alias("n")), "token-counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    vocabulary = fit_vocabulary(counts)
    model = train(training, vocabulary, sums["n"])
    top = counts.orderBy(F.desc("n"), "token").limit(max(KNOWN, HEAD)).select("token", "n").toArrow()
    known = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(known)
    scorer = Scorer(vocabulary, model.values, known[order], top.column("n").to_numpy()[order], sums["n"], sums["v"])
    scored = settle(docs.mapInArrow(scorer, _SCORED), "token-scores")

    group = lambda values: F.get(F.lit([float(x) for x in values]), F.col("grp"))
    rest = scored.where("token is not null").select("row", "token", "grp", "times").join(counts.select("token", "n"), "token", "left")
    share = F.when(F.col("n").isNotNull(), F.col("n") - DISCOUNT).otherwise(DISCOUNT * group(vocabulary.group_types) + 1)
    added = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(sums["n"] + sums["v"] + 1)))).alias("more_base"),
        F.sum(F.col("times") * F.log10(share / (group(vocabulary.group_total) + 1))).alias("more_score"),
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return (
        scored.where("token is null")
        .join(added, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens", plus("n_known", "more_known"), F.lit(sums["n"]).cast("bigint").alias("train_tokens"),
            plus("base_score", "more_base"), plus("score", "more_score"),
        )
    )
