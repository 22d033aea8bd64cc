"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of token packets (``PACKET`` ids, the last one shorter)
cut from its documents one after another. A round is worth one window: in it
each queue's deficit counter grows by its quantum, its target share of the
window; a queue sends every whole packet its counter covers and carries the
rest to the next round. A queue that runs dry leaves the others their quanta,
so they go on in the same proportions. Served packets are laid one after
another and cut at multiples of the window: every window has the target
proportions up to one packet a queue, and nothing is dropped.

The counter after r rounds is known without playing them through: with fixed
packets a queue has sent ``PACKET * floor(r * quantum / PACKET)`` ids and its
deficit is the remainder. So a partition needs only the queues' totals to
carry deficits over from the windows before its own, and all partitions lay
out their packets at the same time:

1. one pass writes each document's ids with its place in its source's part of
   the task;
2. sums a task and source, then prefix sums a queue, give each document its
   place in its queue;
3. a second pass places packets, cuts them at documents and windows, and emits
   the pieces. Ids are not shuffled unless the small table of sums is too
   large for Spark's own broadcast limit.

Sources with a target and the ``OWN_QUEUES`` largest have queues of their own; the
documents of all others share ``POOLED_QUEUES`` queues by hash, so the schedule that every
task holds has a fixed bound and still no document is left out.

The ids after the last full window go to windows of falling powers of two, so
no window is padded.

Defined results: a null or empty text is the closing id alone; a very long text
is tokenized whole by one task and cut freely; a null source is a source of its
own, apart from an empty name; repeated rows and ids are packed each on its own; an
empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, stored
from .tokens import VOCABULARY, encoder, ragged, tokenizer_path

WINDOW = 1024
PACKET = 128
CLOSING_ID = 0
OWN_QUEUES, POOLED_QUEUES = 3840, 256
#: Quanta are whole numbers of 1 / UNIT ids a round.
UNIT = 1 << 16
#: Cells of (round, queue) held at once while a batch is placed.
CELLS = 2_000_000


class Schedule:
    """Deficit round-robin over queues with the given totals and quanta."""

    def __init__(self, totals, quanta, window: int = WINDOW, packet: int = PACKET):
        self.total = np.asarray(totals, dtype=np.int64)
        self.quantum = np.asarray(quanta, dtype=np.int64)
        self.window, self.packet = window, packet
        n = int(self.total.sum())
        self.full = n // window
        # Windows after the full ones: the powers of two in the rest, largest first.
        rest, edge = n % window, [self.full * window]
        for bit in reversed(range(window.bit_length())):
            if rest >> bit & 1:
                edge.append(edge[-1] + (1 << bit))
        self.tail = np.array(edge, dtype=np.int64)

    def sent(self, rounds: np.ndarray) -> np.ndarray:
        """Ids each queue has sent after each of ``rounds`` (rounds x queues)."""
        deficit = np.minimum(rounds[:, None], self._last()[None, :]) * self.quantum[None, :]
        whole = deficit // (self.packet * UNIT) * self.packet
        return np.where(deficit >= self.total * UNIT, self.total, whole)

    def _last(self) -> np.ndarray:
        """Round in which each queue runs dry."""
        return -(-self.total * UNIT // self.quantum)

    def position(self, queue: np.ndarray, packet: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place in the laid-out stream of id ``at`` of a queue, which lies in ``packet``."""
        upto = np.minimum((packet + 1) * self.packet, self.total[queue])
        sending = -(-upto * UNIT // self.quantum[queue])
        rounds, which = np.unique(sending, return_inverse=True)
        out = np.empty(len(at), dtype=np.int64)
        order = np.argsort(which, kind="stable")
        step = max(1, CELLS // len(self.total))
        for lo in range(0, len(rounds), step):
            hi = min(len(rounds), lo + step)
            a, b = np.searchsorted(which[order], (lo, hi))
            mine = order[a:b]
            before = self.sent(rounds[lo:hi] - 1)
            now = self.sent(rounds[lo:hi]) - before
            ahead = before.sum(axis=1, keepdims=True) + np.cumsum(now, axis=1) - now - before
            out[mine] = ahead[which[mine] - lo, queue[mine]] + at[mine]
        return out

    def next_edge(self, position: np.ndarray) -> np.ndarray:
        """First window border after each place."""
        later = np.append(self.tail, self.tail[-1] + 1)[np.searchsorted(self.tail, position, side="right")]
        return np.where(position < self.tail[0], (position // self.window + 1) * self.window, later)

    def place(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and offset in it of each place."""
        which = np.maximum(np.searchsorted(self.tail, position, side="right") - 1, 0)
        in_full = position < self.tail[0]
        return (np.where(in_full, position // self.window, self.full + which),
                np.where(in_full, position % self.window, position - self.tail[which]))


def quanta(totals: list[int], names: list, targets: dict | None, window: int) -> list[int]:
    """Quantum of each queue: its target share, or its share of what the targets
    leave over in proportion to its ids (all of it without targets)."""
    targets = targets or {}
    left = max(0.0, 1.0 - sum(targets.values()))
    free = sum(t for t, n in zip(totals, names) if n not in targets) or 1
    share = [targets[n] if n in targets else left * t / free for t, n in zip(totals, names)]
    return [max(1, round(window * UNIT * x)) for x in share]


def tokenized(docs: DataFrame, key: str, text: str, source: str | None, vocabulary_path: str) -> DataFrame:
    """Stored ``key, src, task, at, n, ids``: ids closed by ``CLOSING_ID`` and each
    document's place among its task's ids of the source."""
    slim = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
        (F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("")) if source else F.lit("")).alias("src"),
        F.spark_partition_id().alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, used = encoder(vocabulary_path).encode_column, {}
        for batch in batches:
            ids = [np.append(x, np.uint32(CLOSING_ID)).astype("<u4") for x in encode(batch.column("text"))]
            at = []
            for src, x in zip(batch.column("src").to_pylist(), ids):
                at.append(used.get(src, 0))
                used[src] = at[-1] + len(x)
            small = all(int(x.max()) < 1 << 16 for x in ids)
            yield pa.record_batch(
                [batch.column("key"), batch.column("src"), batch.column("task"), pa.array(at, pa.int64()),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array([small] * len(ids)),
                 pa.array([x.astype("<u2" if small else "<u4").tobytes() for x in ids], pa.binary())],
                names=["key", "src", "task", "at", "n", "small", "ids"])
    kind = slim.schema["key"].dataType.simpleString()
    return stored(slim.mapInArrow(run, f"key {kind}, src string, task int, at bigint, n bigint, small boolean, ids binary"),
                  "packing-ids")


def schedule_of(ids: DataFrame, targets: dict | None, window: int, packet: int) -> tuple[Schedule, DataFrame]:
    """The schedule, and the queue and place in it of each (task, src)."""
    spark = ids.sparkSession
    sums = stored(ids.groupBy("src", "task").agg(F.sum("n").alias("n")), "packing-sums")
    wanted = ["" if t is None else f"={t}" for t in targets or {}]
    named = F.col("src").isin(wanted) if wanted else F.lit(False)
    largest = [r["src"] for r in sums.groupBy("src").agg(F.sum("n").alias("n"))
               .orderBy(named.desc(), F.desc("n"), "src").limit(max(OWN_QUEUES, len(wanted))).collect()]
    own = F.broadcast(spark.createDataFrame(list(enumerate(largest)), "own int, src string"))
    pooled = F.lit(len(largest)) + F.pmod(F.xxhash64("src"), F.lit(POOLED_QUEUES)).cast("int")
    placed = sums.join(own, "src", "left").withColumn("queue", F.coalesce("own", pooled)).drop("own")
    totals = {r["queue"]: r["n"] for r in placed.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    queues = sorted(totals)
    # A pool is named by a pair, which no source can be.
    names = [(largest[q][1:] if largest[q] else None) if q < len(largest) else ("pooled", q - len(largest)) for q in queues]
    sizes = [totals[q] for q in queues]
    schedule = Schedule(sizes, quanta(sizes, names, targets, window), window, packet)
    dense = F.broadcast(spark.createDataFrame(list(zip(queues, range(len(queues)))), "queue int, q int"))
    order = Window.partitionBy("queue").orderBy("task", "src")
    offsets = placed.withColumn("before", F.sum("n").over(order) - F.col("n")).join(dense, "queue")
    return schedule, stored(offsets.select("src", "task", "q", "before"), "packing-offsets")


_PIECES = ("start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str | None = "source",
         targets: dict | None = None, window: int = WINDOW, packet: int = PACKET,
         vocabulary_path: str | None = None) -> DataFrame:
    """Pieces of all documents: ``key``, first id and number of ids in the
    document, its ids, window, offset there, and the piece's ids (little-endian
    unsigned 32-bit).

    ``targets`` maps sources to shares of each window (sum at most 1); the
    others divide what is left. Without it every source gets its own share of
    all ids, and all queues end together."""
    bound_batches(docs.sparkSession)
    ids = tokenized(docs, key, text, source, vocabulary_path or tokenizer_path(VOCABULARY))
    spark = docs.sparkSession
    schedule, offsets = schedule_of(ids, targets, window, packet)
    plan = spark.sparkContext.broadcast(schedule)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _cut(plan.value, batch)

    rows = ids.join(offsets, ["src", "task"])
    rows = rows.select("key", (F.col("before") + F.col("at")).alias("at"), "q", "n", "small", "ids")
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(cut, f"`{key}` {kind}, {_PIECES}")


def _cut(plan: Schedule, batch: pa.RecordBatch) -> pa.RecordBatch:
    column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    at, queue, n = column("at"), column("q"), column("n")
    flat = np.concatenate([np.frombuffer(x, dtype="<u2" if small else "<u4").astype("<u4") for x, small in
                           zip(batch.column("ids").to_pylist(), batch.column("small").to_pylist())])
    head = np.cumsum(n) - n                                   # of each document in flat
    size = plan.packet
    first = at // size
    count = (at + n - 1) // size - first + 1
    doc = np.repeat(np.arange(len(n)), count)
    packet = ragged(first, count)
    a = np.maximum(at[doc], packet * size)
    b = np.minimum(at[doc] + n[doc], (packet + 1) * size)
    place = plan.position(queue[doc], packet, a)
    where, end = head[doc] + a - at[doc], place + b - a
    starts, places = [where], [place]
    while True:                                               # cut at window borders
        edge = plan.next_edge(place)
        over = edge < end
        if not over.any():
            break
        where, place, end = (where + edge - place)[over], edge[over], end[over]
        starts.append(where)
        places.append(place)
    starts, places = np.concatenate(starts), np.concatenate(places)
    order = np.argsort(starts)
    starts, places = starts[order], places[order]
    doc = np.searchsorted(head, starts, side="right") - 1
    sequence, offset = plan.place(places)
    border = np.append(starts, len(flat))
    ids = pa.Array.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer((border * 4).astype(np.int32)), pa.py_buffer(flat)]) if len(flat) < 1 << 29 else pa.array(
        [flat[x:y].tobytes() for x, y in zip(border, border[1:])], pa.binary())
    return pa.record_batch(
        [batch.column("key").take(pa.array(doc)), pa.array(starts - head[doc]), pa.array(np.diff(border)),
         pa.array(n[doc]), pa.array(sequence), pa.array(offset), ids],
        names=["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def piece_digest(docs: DataFrame, **how) -> DataFrame:
    """The contract's row for each piece."""
    return pack(docs, **how).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                    "doc_tokens", "sequence_id", "offset")
