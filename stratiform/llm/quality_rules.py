"""Quality rules: base rules on words, then a calibrated hashed n-gram model.

Base rules: fewer than ``MIN_WORDS`` words, or more than half of the words in
repeated 3-word windows. The model is a logistic regression on relative
frequencies of hashed word 1- and 2-grams and character 3- to 5-grams (bytes
of UTF-8), ``BUCKETS`` buckets a family. A score is a mean of bucket weights
over a text's n-grams, so whole texts are scored in Arrow batches with one
gather a family. Scores become probabilities by Platt scaling on labelled rows
the weights have not seen, and are held against fixed thresholds.

Training reads at most ``MAX_ROWS`` labelled rows (the ones with the smallest
hash of their id), dealt into ``PARTS`` parts by hash. Each round every part
starts from the shared weights, runs AdaGrad over its rows, and the parts'
weights are averaged.

Defined results: a null or empty text has no words and fails the base rules;
rows without a label teach nothing; without labels of both classes the model
keeps what the base rules keep; repeated rows are judged alike; empty tables
stay empty; other columns pass through unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, drop_stored, stored
from .docstats import Stats
from .quality_trees import labelled_sample
from .textkit import Chunk, chunks, mix, window_hashes

MIN_WORDS = 50
BUCKETS = 1 << 16
FAMILIES = ("word1", "word2", "char3", "char4", "char5")
#: Labelled rows that training reads at most, and the parts they are dealt into.
MAX_ROWS, PARTS = 6000, 8
ROUNDS, EPOCHS, BATCH, STEP, DECAY = 3, 6, 32, 0.5, 1e-7
#: Relative frequencies are multiplied by this in training and scoring.
SCALE = 30.0
#: Probability of good quality from which a document is kept.
THRESHOLD = 0.5


def grams(chunk: Chunk, stats: Stats):
    """(first n-gram, one after the last, buckets) of each text, family by family."""
    words, data, n = stats.words, chunk.data, len(chunk.data)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    yield words.begin, words.end, (mix(stats.hashes) >> shift).astype(np.int32)
    pairs = (mix(window_hashes(stats.hashes, 2)) >> shift).astype(np.int32)
    yield words.begin, np.maximum(words.end - 1, words.begin), pairs
    packed = data.astype(np.uint64)
    for k in range(1, 5):
        packed = packed[:-1] | (data[k:].astype(np.uint64) << np.uint64(8 * k)) if len(packed) else packed
        if k >= 2:
            bucket = (packed * np.uint64(0x9E3779B97F4A7C15 + 2 * k) >> shift).astype(np.int32)
            yield chunk.begin, np.maximum(chunk.end - k, chunk.begin), bucket


@dataclass
class Model:
    weights: np.ndarray                 # families x buckets, float32
    bias: float = 0.0
    slope: float = 1.0                  # Platt scaling
    shift: float = 0.0
    trained: bool = True

    def logits(self, chunk: Chunk, stats: Stats) -> np.ndarray:
        out = np.full(len(chunk), self.bias)
        for w, (first, last, bucket) in zip(self.weights, grams(chunk, stats)):
            total = np.concatenate(([0.0], np.cumsum(w[bucket], dtype=np.float64)))
            out += SCALE * (total[np.minimum(last, len(bucket))] - total[np.minimum(first, len(bucket))]) / np.maximum(last - first, 1)
        return out

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -500, 500)))


def _rows_of(column: pa.Array):
    """Per text: (feature indices int32, values float32)."""
    for chunk in chunks(column):
        stats = Stats(chunk)
        families = list(grams(chunk, stats))
        for i in range(len(chunk)):
            index, value = [], []
            for f, (first, last, bucket) in enumerate(families):
                got, count = np.unique(bucket[first[i]:last[i]], return_counts=True)
                index.append(got + f * BUCKETS)
                value.append(SCALE * count / max(1, last[i] - first[i]))
            yield np.concatenate(index).astype("<i4"), np.concatenate(value).astype("<f4")


def _descend(weights: np.ndarray, bias: float, rows: list, seed: int) -> tuple[np.ndarray, float]:
    """AdaGrad over (label, indices, values) rows, in a fixed order."""
    w, b = weights.astype(np.float64), bias
    power, power_b = np.full(len(w), 1e-3), 1e-3
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            part = [rows[i] for i in order[lo:lo + BATCH]]
            y = np.array([r[0] for r in part], dtype=np.float64)
            size = np.array([len(r[1]) for r in part])
            index, value = np.concatenate([r[1] for r in part]), np.concatenate([r[2] for r in part])
            doc = np.repeat(np.arange(len(part)), size)
            z = b + np.bincount(doc, w[index] * value, minlength=len(part))
            slip = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / len(part)
            where, back = np.unique(index, return_inverse=True)
            grad = np.bincount(back, slip[doc] * value) + DECAY * w[where]
            power[where] += grad**2
            w[where] -= STEP * grad / np.sqrt(power[where])
            power_b += slip.sum()**2
            b -= STEP * slip.sum() / np.sqrt(power_b)
    return w, b


def _learner(shared, seed: int):
    """One part's round: from the shared weights over the part's rows."""
    def learn(table):
        table = table.sort_by([("doc_id", "ascending"), ("label", "ascending")])
        rows = [(y, *x) for y, x in zip(table["label"].to_pylist(), _rows_of(table["text"]))]
        w, b = _descend(*shared.value, rows, seed)
        return pa.table({"w": pa.array([w.astype("<f4").tobytes()], pa.binary()), "b": [b], "n": [len(rows)]})
    return learn


def platt(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make ``slope * logit + shift`` a calibrated logit."""
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    spread = logits.std() or 1.0
    x = np.stack([logits / spread, np.ones(len(y))], axis=1)
    c = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * c
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        c -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(c[0], 1e-6) / spread), float(c[1])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The calibrated model from labelled rows."""
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, max_rows)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "h"), F.lit(PARTS * 5)).cast("int"))
    # Only the sample's texts are stored and dealt out; n-grams are made where they are used.
    data = stored(rows, "quality-rules")
    # One part in five calibrates, the others train.
    fold = F.col("part") % 5 == 0
    flat, bias = np.zeros(len(FAMILIES) * BUCKETS), 0.0
    both = data.where(~fold).agg(F.min("label"), F.max("label")).first()
    if both[0] is None or both[0] == both[1]:
        return Model(np.zeros((len(FAMILIES), BUCKETS), np.float32), trained=False)
    schema = "w binary, b double, n bigint"
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast((flat.astype(np.float32), bias))
        got = data.where(~fold).withColumn("part", (F.col("part") / 5).cast("int")).groupBy("part") \
            .applyInArrow(_learner(shared, r), schema).collect()
        share = np.array([g["n"] for g in got]) / sum(g["n"] for g in got)
        flat = sum(s * np.frombuffer(g["w"], "<f4").astype(np.float64) for s, g in zip(share, got))
        bias = float(sum(s * g["b"] for s, g in zip(share, got)))
    model = Model(flat.reshape(len(FAMILIES), BUCKETS).astype(np.float32), bias)
    shared = spark.sparkContext.broadcast(model)

    def logit(batch: pa.RecordBatch) -> pa.RecordBatch:
        z = np.concatenate([shared.value.logits(c, Stats(c)) for c in chunks(batch.column("text"))])
        return pa.record_batch([pa.array(z), batch.column("label")], names=["z", "label"])
    held = arrow_map(data.where(fold), logit, "z double, label int").toArrow()
    model.slope, model.shift = platt(held["z"].to_numpy(), held["label"].to_numpy().astype(np.float64))
    drop_stored(data)
    return model


COLUMNS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, " \
          "base_failed boolean, kept boolean, probability double"


def verdicts(model: Model, column: pa.Array, threshold: float = THRESHOLD) -> dict[str, np.ndarray]:
    """The columns of ``COLUMNS`` for each text of a column."""
    out: dict[str, list] = {c.split()[0]: [] for c in COLUMNS.split(", ")}
    for chunk in chunks(column):
        s = Stats(chunk)
        failed = (s.n_words < MIN_WORDS) | (100 * s.n_repeat_words > 50 * s.n_words)
        p = model.probability(model.logits(chunk, s)) if model.trained else np.ones(len(chunk))
        for name, x in zip(out, (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, failed,
                                 ~failed & (p >= threshold), p)):
            out[name].append(x)
    return {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}


def judge(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key`` and ``COLUMNS`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = verdicts(shared.value, batch.column("text"), threshold)
        return pa.record_batch([batch.column("key"), *map(pa.array, got.values())], names=["key", *got])
    return arrow_map(slim, run, f"`{key}` {kind}, {COLUMNS}")


def keep_passing(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` that are kept, with the same columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def passing(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(verdicts(shared.value, batch.column("text"), threshold)["kept"]))
    return arrow_map(docs, passing, docs.schema)
