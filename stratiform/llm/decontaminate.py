"""Benchmark decontamination with a broadcast hash set of test n-grams.

Benchmark texts are normalised (A-Z lowered, words of letters, digits and
non-ASCII characters) and cut into windows of 13 words; an item with fewer
words is one window. Spark cuts and hashes the windows and stores them.

1. A Bloom filter of all windows' hashes, at most 128 MB, is broadcast. Documents
   are scanned in Arrow batches: every run of the same number of words is hashed
   and looked up, and a join of the hashes found with the stored windows leaves
   the matched windows.
2. The matched windows are broadcast as a hash set and the documents scanned again;
   each find is verified word for word before its words count as hit. Then spans or
   whole documents can be removed. Beyond ``block_bytes`` the matched windows are
   dealt into blocks that are scanned one after another, the finds of earlier blocks
   travelling with the rows.

So the driver holds neither benchmark texts nor windows that no document has, and
any benchmark size gives the same result.

Defined results: a null or empty text has no words, no hits, and the digest of
an empty list; an item without words (or null) has no windows; repeated items
and documents are treated each on its own; a null item id is left out of the
listed ids but its words are hit; empty tables give an empty result or no
hits; a very long text is scanned whole by one task; other columns, whatever their
names, pass through unread.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, bound_batches, stored, utf8_bytes
from .textkit import LOWER, Chunk, Words, chunks, lookup, window_hashes

WINDOW = 13
#: Matched windows and their items per broadcast block.
BLOCK_BYTES = 8 << 20
#: The filter of all windows has at most 2^30 bits, 128 MB; its probes are slices of the hash.
MOST_LOG_BITS = 30
_SHIFTS = (0, 11, 23, 34)
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lowering.
WORD_BYTES = lookup(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def _words(chunk: Chunk) -> Words:
    return Words(chunk, WORD_BYTES, LOWER)


class WindowSet:
    """Windows by width: sorted hashes, a bit filter, and for each hash the windows (as
    joined words) with the items that hold them. ``rows`` are (hash, width, words, items)."""

    def __init__(self, rows: list[tuple[int, int, bytes, list]]):
        self.widths: dict[int, tuple] = {}
        found: dict[int, dict[int, dict[bytes, list]]] = {}
        for h, width, words, items in rows:
            found.setdefault(width, {}).setdefault(h & (1 << 64) - 1, {})[bytes(words)] = items
        for width, windows in found.items():
            keys = np.array(sorted(windows), dtype=np.uint64)
            bits = np.zeros(1 << 20, dtype=bool)
            bits[keys >> np.uint64(44)] = True
            self.widths[width] = (keys, bits, windows)

    @staticmethod
    def joined(words: Words, k: int, width: int) -> bytes:
        data = words.data
        return b" ".join(data[words.start[j]:words.stop[j]].tobytes() for j in range(k, k + width))

    def scan(self, words: Words):
        """(text index, first word, width, items) of every verified find."""
        if not self.widths or not len(words):
            return
        hashed = words.hashes()
        for width, (keys, bits, windows) in self.widths.items():
            got = window_hashes(hashed, width)
            at = np.flatnonzero(bits[got >> np.uint64(44)])
            at = at[words.doc[at] == words.doc[at + width - 1]]
            where = np.minimum(np.searchsorted(keys, got[at]), len(keys) - 1)
            for k in at[keys[where] == got[at]]:
                items = windows[int(got[k])].get(self.joined(words, k, width))
                if items:
                    yield int(words.doc[k]), int(k), width, items


def windows_of(benchmark: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Stored ``h, width, words, item``: every window of every item, cut where the items are."""
    def cut(batches):
        for batch in batches:
            names = batch.column("k").to_pylist()
            for chunk in chunks(batch.column("t")):
                words = _words(chunk)
                hashed, spans = words.hashes(), {}
                out = [], [], [], []
                for i in np.flatnonzero(words.count):
                    width = min(window, int(words.count[i]))
                    if width not in spans:
                        spans[width] = window_hashes(hashed, width).view(np.int64)
                    for k in range(words.begin[i], words.end[i] - width + 1):
                        for column, x in zip(out, (int(spans[width][k]), width, WindowSet.joined(words, k, width), names[chunk.lo + i])):
                            column.append(x)
                        if len(out[0]) == 20_000:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, _WINDOW_TYPES)], names=_WINDOW_NAMES)
                            out = [], [], [], []
                if out[0]:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(out, _WINDOW_TYPES)], names=_WINDOW_NAMES)
    slim = benchmark.select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{text}`").alias("t"))
    return stored(slim.mapInArrow(cut, "h bigint, width int, words binary, item string").distinct(), "decontaminate-windows")


_WINDOW_NAMES = ["h", "width", "words", "item"]
_WINDOW_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.string()]


def _probes(h: np.ndarray, log_bits: int):
    mask = np.uint64((1 << log_bits) - 1)
    return [(h >> np.uint64(s)) & mask for s in _SHIFTS]


def window_filter(windows: DataFrame) -> tuple[int, np.ndarray]:
    """A Bloom filter of the windows' hashes, about 16 bits each but never more than
    2^``MOST_LOG_BITS``: what is sent to the tasks has a bound that no benchmark exceeds."""
    n = windows.select("h").distinct().count()
    log_bits = min(MOST_LOG_BITS, max(10, int(n * 16).bit_length()))
    at = F.explode(F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(F.lit((1 << log_bits) - 1)) for s in _SHIFTS]))
    bits = (windows.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))).toArrow()
    out = np.zeros(1 << (log_bits - 6), dtype=np.uint64)
    out[bits["word"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return log_bits, out


def matched_windows(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    """Stored ``h, width, words, items`` of the windows whose hash occurs in some document."""
    spark = docs.sparkSession
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())      # at most the window's length
    told = spark.sparkContext.broadcast((widths, *window_filter(windows)))

    def seen(batches):
        widths, log_bits, bits = told.value
        for batch in batches:
            for chunk in chunks(batch.column("t")):
                words = _words(chunk)
                if not len(words):
                    continue
                hashed = words.hashes()
                for width in widths:
                    got = window_hashes(hashed, width)
                    at = np.flatnonzero(words.doc[:len(got)] == words.doc[width - 1:width - 1 + len(got)])
                    for probe in range(len(_SHIFTS)):
                        where = _probes(got[at], log_bits)[probe]
                        at = at[(bits[where >> np.uint64(6)] >> (where & np.uint64(63))) & np.uint64(1) == 1]
                    if len(at):
                        yield pa.record_batch([pa.array(np.unique(got[at]).view(np.int64))], names=["h"])
    found = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(seen, "h bigint").distinct()
    return stored(windows.join(found, "h", "left_semi").groupBy("h", "width", "words")
                  .agg(F.collect_set("item").alias("items")), "decontaminate-matched")


def _blocks(matched: DataFrame, block_bytes: int):
    """Matched windows in blocks of about ``block_bytes``."""
    size = F.octet_length("words") + F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x) + 8) + 64
    total = matched.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        yield [tuple(r) for r in matched.where(F.pmod(F.xxhash64("h"), F.lit(n)) == b).collect()]


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
              item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
              into: str = "_hits") -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``spans`` (byte
    ranges [from, to) of hit word runs in the text's UTF-8, merged) with the
    words each holds, and ``items``. A column of that name is replaced."""
    bound_batches(docs.sparkSession)
    docs = docs.drop(into)
    spark, kind = docs.sparkSession, "n_words:bigint,spans:array<struct<a:int,b:int,first:int,words:int>>,items:array<string>"
    out, first = docs.withColumn(into, F.lit(None).cast(f"struct<{kind}>")), True
    matched = matched_windows(docs, windows_of(benchmark, item_key, item_text, window), text)
    for rows in _blocks(matched, block_bytes):
        if not first:
            out = stored(out, "decontaminate")
            found.unpersist()
        found = spark.sparkContext.broadcast(WindowSet(rows))

        @F.arrow_udf(f"struct<{kind}>")
        def scan(column: pa.Array, before: pa.Array) -> pa.Array:
            return _scan(found.value, column, before)

        out, first = out.withColumn(into, scan(F.col(f"`{text}`"), F.col(into))), False
    return out


_SPAN = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("first", pa.int32()), ("words", pa.int32())])
_HITS = [pa.field("n_words", pa.int64()), pa.field("spans", pa.list_(_SPAN)), pa.field("items", pa.list_(pa.string()))]


def _scan(windows: WindowSet, column: pa.Array, before: pa.Array) -> pa.Array:
    old = before.to_pylist() if before.null_count < len(before) else [None] * len(column)
    n_words, spans, items = [], [], []
    for chunk in chunks(column):
        words = _words(chunk)
        mark = np.zeros(len(words) + 1, dtype=np.int64)
        names: dict[int, set] = {}
        for i in range(len(chunk)):
            if old[chunk.lo + i]:
                for s in old[chunk.lo + i]["spans"]:
                    mark[words.begin[i] + s["first"]] += 1
                    mark[words.begin[i] + s["first"] + s["words"]] -= 1
                names[i] = set(old[chunk.lo + i]["items"])
        for i, k, width, who in windows.scan(words):
            mark[k] += 1
            mark[k + width] -= 1
            names.setdefault(i, set()).update(x for x in who if x is not None)
        hit = np.cumsum(mark[:-1]) > 0
        for i in range(len(chunk)):
            a, b = int(words.begin[i]), int(words.end[i])
            got = []
            if i in names:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0]))))
                for p, q in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    got.append({"a": int(words.start[a + p] - chunk.begin[i]),
                                "b": int(words.stop[a + q - 1] - chunk.begin[i]), "first": p, "words": q - p})
            n_words.append(b - a)
            spans.append(got)
            items.append(sorted(names.get(i, ())))
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))],
        fields=_HITS)


def hit_words(hits="_hits"):
    return F.aggregate(F.col(f"{hits}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["words"])


def is_contaminated(hits="_hits", share: int = 20):
    """Hit at all, and at least one word in ``share`` of the document."""
    n = hit_words(hits)
    return (n > 0) & (n * share >= F.col(f"{hits}.n_words"))


def _free_name(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    name = "_hits"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` without the contaminated ones; the same columns."""
    name = _free_name(docs)
    found = find_hits(docs, benchmark, text, into=name, **how)
    return found.where(~is_contaminated(name)).select(*[f"`{c}`" for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with every hit run of words cut out of the text."""
    name = _free_name(docs)
    found = find_hits(docs, benchmark, text, into=name, **how)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        column, hits = batch.column(text).to_pylist(), batch.column(name).to_pylist()
        for i, h in enumerate(hits):
            if h["spans"]:
                raw, at, kept = column[i].encode(), 0, []
                for s in h["spans"]:
                    kept.append(raw[at:s["a"]])
                    at = s["b"]
                column[i] = b"".join([*kept, raw[at:]]).decode()
        where = batch.schema.get_field_index(text)
        return batch.set_column(where, batch.schema.field(where), pa.array(column, batch.schema.field(where).type)) \
            .drop_columns([name])
    return arrow_map(found, cut, docs.schema)


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    found = find_hits(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", F.col("_hits.n_words").alias("n_words"), hit_words().alias("n_hit"),
        F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_hits.items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> dict:
    """Plain check for small tables: doc_id -> the contract's other columns."""
    import re
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    tests = [(str(k), split(t)) for k, t in items]
    out = {}
    for key, text in docs:
        words, hit, who = split(text), set(), set()
        for name, ws in tests:
            width = min(window, len(ws))
            for a in range(len(ws) - width + 1 if width else 0):
                for b in range(len(words) - width + 1):
                    if words[b:b + width] == ws[a:a + width]:
                        hit |= set(range(b, b + width))
                        who.add(name)
        out[key] = (len(words), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(words))
    return out
