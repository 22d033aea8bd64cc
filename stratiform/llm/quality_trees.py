"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics (``docstats.FEATURES``) of labelled documents are cut into at most
``BINS`` bins by quantiles. Trees grow level by level on gradient histograms of
the logistic loss, one ``bincount`` a level for all features and nodes. The
trees are flattened into arrays (feature, threshold, children, value), and a
batch of documents walks all trees at once, one step a level.

Training uses at most ``MAX_ROWS`` labelled documents, the ones with the
smallest hash of their id; scoring covers every document and its whole text.

Defined results: null and empty texts have zero statistics and get a score like
any other; rows without a label or with a null id or label teach nothing; with
no label at all every score is 0.5, with one class only its share (kept off 0
and 1); repeated rows are scored alike; empty tables stay empty; other columns
pass through unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored
from .docstats import FEATURES, Stats
from .textkit import chunks

#: Labelled rows that training reads at most.
MAX_ROWS = 20_000
BINS, TREES, DEPTH, RATE, RIDGE, LEAST_WEIGHT = 64, 60, 4, 0.15, 1.0, 2.0
THRESHOLD = 0.3


@dataclass
class Forest:
    """Nodes of all trees in arrays; a leaf points to itself."""

    base: float
    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.root, (len(x), len(self.root)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def train(x: np.ndarray, y: np.ndarray, bins: int = BINS, trees: int = TREES, depth: int = DEPTH,
          rate: float = RATE, ridge: float = RIDGE, least: float = LEAST_WEIGHT) -> Forest:
    """Boosted trees on ``x`` (rows x features) for labels 0 / 1."""
    n, width = x.shape
    p = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(p / (1 - p)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for part, start in ((feature, 0), (threshold, np.inf), (value, 0.0)):
            part.append(start)
        left.append(len(left))
        right.append(len(right))
        return len(left) - 1

    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        raw = np.full(n, base)
        for _ in range(trees):
            q = 1 / (1 + np.exp(-raw))
            grad, hess = q - y, q * (1 - q)
            roots.append(node())
            at, live = np.full(n, roots[-1]), {roots[-1]}
            for level in range(depth + 1):
                grown = set()
                ids = sorted(live)
                slot = np.full(len(left), -1)
                slot[ids] = np.arange(len(ids))
                where = slot[at]
                rows = np.flatnonzero(where >= 0)
                cell = ((where[rows, None] * width + np.arange(width)) * bins + binned[rows]).ravel()
                shape = (len(ids), width, bins)
                g = np.bincount(cell, np.repeat(grad[rows], width), minlength=np.prod(shape)).reshape(shape)
                h = np.bincount(cell, np.repeat(hess[rows], width), minlength=np.prod(shape)).reshape(shape)
                gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
                gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl)**2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < least) | (ht - hl < least)] = 0
                for k, i in enumerate(ids):
                    value[i] = float(-rate * gt[k, 0, 0] / (ht[k, 0, 0] + ridge))
                    j, b = np.unravel_index(int(gain[k].argmax()), (width, bins))
                    if level < depth and gain[k, j, b] > 1e-9:
                        feature[i], threshold[i] = int(j), float(edges[j][b])
                        left[i], right[i] = node(), node()
                        grown |= {left[i], right[i]}
                if not grown:
                    break
                f, t, l, r = (np.array(v) for v in (feature, threshold, left, right))
                at = np.where(x[np.arange(n), f[at]] <= t[at], l[at], r[at])
                live = grown
            raw += np.array(value)[at]
    if not roots:
        roots.append(node())
    return Forest(base, *(np.array(v) for v in (roots, feature, threshold, left, right, value)), depth)


def statistics(column: pa.Array) -> np.ndarray:
    """Features of each text of a column."""
    parts = [Stats(chunk).features() for chunk in chunks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def remainder(key="doc_id"):
    """crc32 of the id as text, modulo 5: 0 marks held-out rows."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, keep=None) -> DataFrame:
    """Stored ``doc_id, text, label`` of at most ``max_rows`` labelled documents, the same
    whatever the partitions are; ``keep`` filters the label rows. Documents that share
    an id are told apart by their text; repeated rows count once."""
    rows = labels.select("doc_id", F.col("quality").cast("int").alias("label")).dropna()
    if keep is not None:
        rows = rows.where(keep)
    order = [F.xxhash64("doc_id"), "doc_id", "label"]
    rows = rows.distinct().orderBy(*order).limit(max_rows)
    hit = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(rows), "doc_id")
    hit = stored(hit.groupBy("doc_id", "label", "h").agg(F.first("text").alias("text")), "labelled")
    chosen = hit.select("doc_id", "label", "h").orderBy(*order, "h").limit(max_rows)
    return hit.join(F.broadcast(chosen), ["doc_id", "label", "h"]).select("doc_id", "text", "label", "h")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Forest:
    """Forest trained on labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, max_rows, remainder() != 0)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(batch.column("text"))
        return pa.record_batch([batch.column("doc_id"), batch.column("label"), batch.column("h"), pa.array(list(x), pa.list_(pa.float64()))],
                               names=["doc_id", "label", "h", "x"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    got = arrow_map(rows, measure, f"doc_id {kind}, label int, h bigint, x array<double>").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("h", "ascending")])
    x = np.array(got["x"].to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return train(x, got["label"].to_numpy().astype(np.float64)) if len(x) else train(x, np.zeros(0))


def score_column(spark, forest: Forest):
    """A Spark function text -> score."""
    model = spark.sparkContext.broadcast(forest)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.value.score(statistics(text)), pa.float64())
    return score


def keep_quality(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` that score at least ``threshold``, with the same columns."""
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def passing(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.value.score(statistics(batch.column("text"))) >= threshold))
    return arrow_map(docs, passing, docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    score = score_column(docs.sparkSession, fit(docs, labels))
    return (docs.select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
