"""Near copies by exact Jaccard similarity of word 5-grams: a T-occurrence join.

Two texts link when their shingle sets overlap in at least
``T = ceil(s (|r| + |s|) / (1 + s))`` shingles, s = 0.75. Following DivideSkip,
a set's inverted lists are divided by one global order, rarer shingles first:
the short lists of its first ``|r| - ceil(s |r|) + 1`` shingles are merged, and
a candidate must occur there at least ``T - L`` times, L being the shingles
left out. The L long lists are not merged but probed: each candidate's sorted
shingles are searched for the query's by binary search, which gives the exact
overlap.

On a cluster:

1. Texts with one shingle set are one class (64-bit key of the set); all
   later steps work on classes. The shingles of one class in ``SAMPLE``, chosen by
   its key, are counted, whatever the layout of the rows is; the ``HOT`` most frequent
   come last in the order and have no merged lists (their number bounds what is
   broadcast).
2. Short lists are dealt by shingle over enough tasks that one holds
   ``POSTINGS`` entries on average and merged there; the pairs leave a task in
   counted batches of about ``PAIRS``, and Spark sums the counts of a pair.
3. Pairs that share none but hot shingles overlap in no more than the smaller
   number of hot shingles, so classes with fewer than T of them are out. The
   others first try the class of their hot lists with the largest hot share (a
   star, not all pairs); what that links needs no more pairs. Hot lists are
   then joined only between those left outside their list's largest component
   and the rest of the list.
4. Candidates' sets are computed again from the texts, joined to the pairs and
   probed. Links are contracted to components.

No step emits all pairs of a group of copies, and none drops a pair that could
link: sizes, counts and hot shares only rule out what cannot reach T.

Defined results: a null, empty or wordless text has no shingles, links with
nothing and is its own component (its own doc_id, null if that is null);
repeated rows are exact copies; a component's id is its smallest non-null
doc_id; empty tables stay empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, bound_batches, stored
from .components import components
from .textkit import LOWER, NON_SPACE, Words, chunks, window_hashes

WIDTH = 5
#: Similarity as a fraction: 100 * overlap >= 75 * union.
NUM, DEN = 75, 100
#: Hot shingles: in at least HOT_TIMES of the sampled classes, one in SAMPLE, and at most the HOT most
#: frequent. Lists of fifty classes are found all but surely; shorter ones have few pairs.
SAMPLE, HOT_TIMES, HOT = 8, 2, 1 << 20
#: Entries of short lists a task merges, and pairs it holds before it sends them on.
POSTINGS, PAIRS = 1_500_000, 2_000_000
#: Text whose shingles a worker holds at a time.
SLICE_BYTES = BATCH_BYTES
STARS = 4


def need(a, b):
    """T for set sizes (numpy arrays or Spark columns alike use the same fraction)."""
    return -(-(NUM * (a + b)) // (NUM + DEN))


def need_sql(a: str, b: str):
    return F.expr(f"({NUM} * ({a} + {b}) + {NUM + DEN - 1}) div {NUM + DEN}")


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text, at least a row each."""
    lo, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column("text")).fill_null(0).to_pylist()):
        if held and held + n > limit:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if batch.num_rows > lo:
        yield batch.slice(lo)


class Sets:
    """Shingle sets of the texts of one slice: sorted hashes, flat, with bounds."""

    def __init__(self, column: pa.Array):
        parts, size = [], []
        for chunk in chunks(column):
            words = Words(chunk, NON_SPACE, LOWER)
            hashed = words.hashes()
            wide = window_hashes(hashed, WIDTH)
            for a, b in zip(words.begin.tolist(), words.end.tolist()):
                if b - a >= WIDTH:
                    got = np.unique(wide[a:b - WIDTH + 1])
                else:
                    got = window_hashes(hashed[a:b], b - a) if b > a else wide[:0]
                parts.append(got)
                size.append(len(got))
        self.size = np.array(size, dtype=np.int64)
        self.end = np.cumsum(self.size)
        self.begin = self.end - self.size
        self.flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(size)), self.size)
        self.key = np.array([int.from_bytes(hashlib.blake2b(p.tobytes(), digest_size=8).digest(), "little", signed=True)
                             for p in parts], dtype=np.int64)
        self.first = np.zeros(len(size), dtype=bool)     # first text of its class in the batch
        self.first[np.unique(self.key, return_index=True)[1]] = True
        self.first &= self.size > 0


def _by_slice(docs: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield fn(part)
    return docs.mapInArrow(run, schema)


def scan_classes(docs: DataFrame) -> DataFrame:
    """Stored ``doc_id, cid, n`` of every row, and the shingles of sampled classes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = Sets(batch.column("text"))
        taken = sets.first & (sets.key % SAMPLE == 0)
        lists = [sets.flat[a:b].view(np.int64) if t else None for a, b, t in zip(sets.begin, sets.end, taken)]
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(sets.key, mask=sets.size == 0), pa.array(sets.size), pa.array(lists, pa.list_(pa.int64()))],
            names=["doc_id", "cid", "n", "token"])
    return stored(_by_slice(docs.select("doc_id", "text"), scan,
                            f"doc_id {kind}, cid bigint, n bigint, token array<bigint>"), "join-classes")


def hot_shingles(scanned: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent shingles, at most ``HOT``."""
    got = (scanned.where("token is not null").select("cid", "token").dropDuplicates(["cid"])
           .select(F.explode("token").alias("token")).groupBy("token").agg(F.count("*").alias("times"))
           .where(F.col("times") >= HOT_TIMES).orderBy(F.desc("times"), "token").limit(HOT).select("token").toArrow())
    return np.sort(got["token"].to_numpy().view(np.uint64))


def _prefixes(sets: Sets, hot: np.ndarray):
    """Hot mask, hot shingles per text, place of each shingle in its text's order, prefix length."""
    where = np.minimum(np.searchsorted(hot, sets.flat), max(len(hot) - 1, 0))
    is_hot = hot[where] == sets.flat if len(hot) else np.zeros(len(sets.flat), bool)
    upto = np.concatenate(([0], np.cumsum(is_hot)))
    n_hot = upto[sets.end] - upto[sets.begin]
    hot_before = upto[:-1] - upto[sets.begin][sets.doc]
    index = np.arange(len(sets.flat)) - sets.begin[sets.doc]
    place = np.where(is_hot, (sets.size - n_hot)[sets.doc] + hot_before, index - hot_before)
    prefix = sets.size - -(-NUM * sets.size // DEN) + 1
    return is_hot, n_hot, place, prefix


def short_lists(docs: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """Stored rows of two kinds. ``p`` >= 0: the (shingle, class, size) entries of a
    slice that fall to part p, packed. ``p`` null: a class with hot shingles, its sizes,
    and the hot shingles of its prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = Sets(batch.column("text"))
        is_hot, n_hot, place, prefix = _prefixes(sets, shared.value)
        used = sets.first[sets.doc] & (place < prefix[sets.doc])
        at = np.flatnonzero(used & ~is_hot)
        token, cid, size = sets.flat[at], sets.key[sets.doc[at]], sets.size[sets.doc[at]].astype(np.uint32)
        part = ((token >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        token, cid, size, part = token[order], cid[order], size[order], part[order]
        ids, first = np.unique(part, return_index=True)
        bound = np.append(first, len(part))
        packed = [[x[a:b].tobytes() for a, b in zip(bound, bound[1:])] for x in (token, cid, size)]
        # Classes that could reach T by hot shingles alone.
        rich = np.flatnonzero(sets.first & (DEN * n_hot >= NUM * sets.size))
        tail = [sets.flat[a:b][used[a:b] & is_hot[a:b]].view(np.int64) for a, b in zip(sets.begin[rich], sets.end[rich])]
        k, m = len(ids), len(rich)
        none = [None] * m
        return pa.record_batch([
            pa.array([*ids.tolist(), *none], pa.int32()),
            *[pa.array(x + none, pa.binary()) for x in packed],
            pa.array([None] * k + sets.key[rich].tolist(), pa.int64()), pa.array([None] * k + sets.size[rich].tolist(), pa.int64()),
            pa.array([None] * k + n_hot[rich].tolist(), pa.int64()), pa.array([None] * k + tail, pa.list_(pa.int64()))],
            names=["p", "tokens", "cids", "sizes", "cid", "n", "h", "hot"])
    return stored(_by_slice(
        docs.select("text"), pack, "p int, tokens binary, cids binary, sizes binary, cid bigint, n bigint, h bigint, hot array<bigint>"), "join-lists")


def _counted(r: list, s: list, c: list):
    """Distinct pairs with their summed counts."""
    r, s, c = np.concatenate(r), np.concatenate(s), np.concatenate(c)
    order = np.lexsort((s, r))
    r, s, c = r[order], s[order], c[order]
    new = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (s[1:] != s[:-1])))) if len(r) else np.zeros(0, np.int64)
    return r[new], s[new], np.add.reduceat(c, new) if len(new) else c[:0]


def merge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part -> counted pairs of each part's merged lists."""
    part, held = None, ([], [], [])
    for batch in batches:
        for p, *packed in zip(*(batch.column(c).to_pylist() for c in ("p", "tokens", "cids", "sizes"))):
            if p != part and part is not None:
                yield from merge_lists(*held)
                held = [], [], []
            part = p
            for column, raw in zip(held, packed):
                column.append(raw)
    if part is not None:
        yield from merge_lists(*held)


def merge_lists(tokens: list[bytes], cids: list[bytes], sizes: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Merge one part's inverted lists: how often each pair of classes meets whose
    sizes allow the similarity. Pairs leave as soon as ``PAIRS`` are held."""
    token = np.concatenate([np.frombuffer(x, np.uint64) for x in tokens])
    cid = np.concatenate([np.frombuffer(x, np.int64) for x in cids])
    size = np.concatenate([np.frombuffer(x, np.uint32) for x in sizes]).astype(np.int64)
    order = np.lexsort((cid, token))
    token, cid, size = token[order], cid[order], size[order]
    if len(token):
        fresh = np.concatenate(([True], (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])))
        token, cid, size = token[fresh], cid[fresh], size[fresh]
    same = token[1:] == token[:-1] if len(token) else np.zeros(0, bool)
    listed = np.zeros(len(token), bool)
    listed[1:] |= same
    listed[:-1] |= same
    token, cid, size = token[listed], cid[listed], size[listed]
    r, s, c, held = [], [], [], 0
    left, step = np.arange(len(token)), 1
    while True:                                    # entry i against entry i + step of the same list
        left = left[left + step < len(token)]
        left = left[token[left] == token[left + step]]
        if not len(left):
            break
        a, b = size[left], size[left + step]
        near = left[DEN * np.minimum(a, b) >= NUM * np.maximum(a, b)]
        r.append(cid[near])
        s.append(cid[near + step])
        c.append(np.ones(len(near), np.int64))
        held, step = held + len(near), step + 1
        if held > PAIRS:
            yield from _sent(r, s, c)
            r, s, c, held = [], [], [], 0
    if held:
        yield from _sent(r, s, c)


def _sent(r: list, s: list, c: list, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    r, s, c = _counted(r, s, c)
    for lo in range(0, len(r), rows):
        yield pa.record_batch([pa.array(x[lo:lo + rows]) for x in (r, s, c)], names=["r", "s", "c"])


def _bitmap(cids: DataFrame) -> np.ndarray:
    """Bits of a fixed 8 MB map set by class keys: what is not in it is not wanted."""
    bits = cids.select(F.pmod("cid", F.lit(1024)).cast("int").alias("part"),
                       F.pmod(F.shiftright("cid", 10), F.lit(65536)).cast("int").alias("bit")).distinct()

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            row = np.zeros(65536, dtype=bool)
            row[x.values.to_numpy()] = True
            out.append(np.packbits(row).tobytes())
        return pa.array(out, pa.binary())
    got = bits.groupBy("part").agg(F.collect_list("bit").alias("bits")).select("part", pack("bits").alias("b")).collect()
    out = np.zeros((1024, 65536), dtype=bool)
    for part, b in got:
        out[part] = np.unpackbits(np.frombuffer(b, np.uint8)).astype(bool)
    return np.packbits(out.reshape(-1))


def _in_bitmap(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the bit of each int64 key is set."""
    at = np.mod(key, 1024) * 65536 + np.mod(key >> 10, 65536)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _sets_of(docs: DataFrame, cids: DataFrame) -> DataFrame:
    """``cid, shingles`` (packed sorted hashes) of the wanted classes."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(cids))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = Sets(batch.column("text"))
        key = sets.key
        hit = np.flatnonzero(sets.first & _in_bitmap(wanted.value, key))
        return pa.record_batch([pa.array(key[hit]), pa.array([sets.flat[sets.begin[i]:sets.end[i]].tobytes() for i in hit], pa.binary())],
                               names=["cid", "shingles"])
    sets = _by_slice(docs.select("text"), run, "cid bigint, shingles binary")
    return sets.join(cids, "cid", "left_semi").dropDuplicates(["cid"])


def probe(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (``r``, ``s``) that link, by binary search of one set in the other."""
    pairs = stored(pairs, "join-candidates")
    if pairs.isEmpty():
        return pairs
    cids = stored(pairs.select(F.explode(F.array("r", "s")).alias("cid")).distinct(), "join-wanted")
    sets = stored(_sets_of(docs, cids), "join-sets")
    both = (pairs.join(sets.withColumnsRenamed({"cid": "r", "shingles": "x"}), "r")
            .join(sets.withColumnsRenamed({"cid": "s", "shingles": "y"}), "s").select("r", "s", "x", "y"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            overlap = int((y[at] == x).sum())
            keep.append(DEN * overlap >= NUM * (len(x) + len(y) - overlap))
        return batch.select(["r", "s"]).filter(pa.array(keep, pa.bool_()))
    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                yield run(batch.slice(lo, 500))
    return stored(both.mapInArrow(probed, "r bigint, s bigint"), "join-links")


def _short_candidates(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose merged short lists meet often enough."""
    counts = (lists.where("p is not null").select("p", "tokens", "cids", "sizes").repartition("p").sortWithinPartitions("p")
              .mapInArrow(merge_parts, "r bigint, s bigint, c bigint")
              .groupBy("r", "s").agg(F.sum("c").alias("c")))
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("hp").alias(f"hp_{x}"))
    pairs = counts.join(side("r"), "r").join(side("s"), "s")
    # Occurrences in the L lists that were not merged, and in hot lists of both prefixes.
    skipped = F.expr(f"({NUM} * greatest(n_r, n_s) + {DEN - 1}) div {DEN} - 1")
    fits = F.least("n_r", "n_s") * DEN >= F.greatest("n_r", "n_s") * NUM
    return pairs.where(fits & (F.col("c") + F.least("hp_r", "hp_s") >= need_sql("n_r", "n_s") - skipped)).select("r", "s")


def _star_candidates(rich: DataFrame) -> DataFrame:
    """Each class with hot shingles against the class of the same hot list that has
    the largest hot share, for a few lists."""
    lists = rich.select("cid", "n", "h", F.explode(F.slice("hot", 1, STARS)).alias("token"))
    centre = lists.groupBy("token").agg(
        F.max_by("cid", F.struct(F.col("h") / F.col("n"), "n", "cid")).alias("centre"), F.count("*").alias("m"))
    return (lists.join(centre.where("m > 1"), "token").where("cid <> centre")
            .select(F.least("cid", "centre").alias("r"), F.greatest("cid", "centre").alias("s")).distinct())


def _hot_candidates(rich: DataFrame, linked: DataFrame) -> DataFrame:
    """Pairs in hot lists that are in different components so far and have enough
    hot shingles for T."""
    labels = linked.select(F.col("node").alias("cid"), F.col("up"))
    lists = (rich.join(labels, "cid", "left").withColumn("comp", F.coalesce("up", "cid")).drop("up")
             # With h hot shingles T is in reach for partners of at most this size.
             .withColumn("cap", F.expr(f"{NUM + DEN} * h div {NUM} - n"))
             .select("cid", "n", "h", "comp", "cap", F.posexplode("hot").alias("at", "token")))
    lists = stored(lists, "join-hot")
    per = lists.groupBy("token", "comp").agg(F.count("*").alias("m"), F.min("n").alias("low"), F.max("cap").alias("high"))
    per = per.groupBy("token").agg(F.max_by("comp", F.struct("m", "comp")).alias("largest"), F.count("*").alias("comps"),
                                   F.min("low").alias("low"), F.max("high").alias("high"))
    per = per.where("comps > 1")
    # A pair meets in the first h - T + 1 hot shingles of both, and T is at least that
    # for the list's smallest set.
    open_ = lists.join(per, "token").where("cap >= low and n <= high").where(
        F.col("at") <= F.col("h") - need_sql("n", f"greatest(low, ({NUM} * n + {DEN - 1}) div {DEN})"))
    outside = open_.where("comp <> largest").selectExpr(
        "token", "cid as r", "n as n_r", "cap as cap_r", "comp as comp_r")
    inside = open_.selectExpr("token", "cid as s", "n as n_s", "cap as cap_s", "comp as comp_s")
    return (outside.join(inside, "token")
            .where(f"comp_r <> comp_s and n_s <= cap_r and n_r <= cap_s and {DEN} * least(n_r, n_s) >= {NUM} * greatest(n_r, n_s)")
            .select(F.least("r", "s").alias("r"), F.greatest("r", "s").alias("s")).distinct())


def link_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    scanned = scan_classes(docs)
    hot = hot_shingles(scanned)
    total = scanned.agg(F.sum("n")).first()[0] or 0
    default = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = short_lists(docs, hot, max(default, int(total * (1 - NUM / DEN)) // POSTINGS + 1))
    rich = stored(lists.where("p is null").select("cid", "n", "h", "hot").dropDuplicates(["cid"]), "join-rich")
    classes = stored(scanned.where("cid is not null").groupBy("cid").agg(F.first("n").alias("n"))
                     .join(rich.select("cid", F.size("hot").cast("long").alias("hp")), "cid", "left")
                     .fillna(0, ["hp"]), "join-sizes")
    links = probe(docs, _short_candidates(lists, classes).unionByName(_star_candidates(rich)).distinct())
    found = components(links.toDF("a", "b"))
    late = probe(docs, _hot_candidates(rich, found))
    if not late.isEmpty():
        found = components(links.unionByName(late).toDF("a", "b"))
    rows = scanned.select("doc_id", "cid", "n")
    group = F.coalesce("up", "cid")
    sizes = (rows.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("low"))
             .join(found.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", group))
    lowest = sizes.groupBy("comp").agg(F.min("low").alias("lowest"))
    named = sizes.join(lowest, "comp").select("cid", "lowest")
    return rows.join(named, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, same columns: the one with the smallest
    (doc_id, hash of the text). Of its rows with a null doc_id one stays as well, since no
    doc_id stands for it. Rows are told apart by doc_id and text, so of two unlike texts with one
    doc_id only that goes which is a copy. Rows with neither doc_id nor words all stay."""
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"),
                   F.xxhash64(F.lit(1), "text").alias("g"))
    found = stored(link_components(docs.select(key.alias("doc_id"), "text")), "join-kept")
    words = found.where("n_shingles > 0")
    spare = (words.where("doc_id.unnamed and not component_id.unnamed").groupBy("component_id")
             .agg(F.min("doc_id").alias("spare")))
    gone = stored(words.where("doc_id <> component_id").select("doc_id", "component_id").distinct()
                  .join(spare, "component_id", "left").where("spare is null or doc_id <> spare").select("doc_id"), "join-gone")
    twice = found.where("n_shingles > 0 or not doc_id.unnamed").groupBy("doc_id").count().where("count > 1").select("doc_id")
    # Only rows that a fixed bitmap of the keys to drop or repeated may mean are shuffled: repeats are
    # combined before that, and most of the others go; the texts that stay are read and passed on.
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(gone.unionByName(twice).select(F.xxhash64("doc_id").alias("cid"))))

    @F.arrow_udf("boolean")
    def perhaps(column: pa.Array) -> pa.Array:
        return pa.array(_in_bitmap(bits.value, column.to_numpy(zero_copy_only=False)))
    mark = "_perhaps"
    while mark in docs.columns:
        mark += "_"
    own = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    marked = docs.withColumn(mark, perhaps(F.xxhash64(key)) & ~own)
    columns = [f"`{c}`" for c in docs.columns]
    one = marked.where(F.col(mark)).groupBy(key.alias("doc_id")).agg(F.first(F.struct(*columns)).alias("row"))
    return marked.where(~F.col(mark)).select(*columns).unionByName(one.join(gone, "doc_id", "left_anti").select("row.*"))
