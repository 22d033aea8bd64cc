"""Prefix trie of conversations by a splitter skeleton.

Every distinct sequence of a conversation's first d turns is a node. Turns stand
as 16-byte digests of (role, text), so a conversation is the string of its
turns' digests and a prefix of turns is a prefix of that string.

1. Conversations are range-partitioned by (path, conv_id): a sample weighted by
   path length names the splitters, so a path that very many conversations share
   is cut by their ids.
2. A node has members in several shards only if a splitter lies between them,
   and then it is a prefix of that splitter's path. The trie of the splitters'
   paths, the skeleton, is broadcast (``SKELETON_BYTES`` at most, by thinning
   the splitters). Every shard is sorted, and one walk over it with a stack
   finishes all nodes that are not in the skeleton.
3. Of a skeleton node a shard sends one row: its members, the smallest of them,
   the finished nodes below and the ids that end there, as a piece of text.
   Pieces of a node meet sorted by shard, so the hash of all its ids is fed piece
   by piece; the sums over skeleton subtrees are taken in the skeleton itself.

Defined results: null roles and texts are empty; null turns come first; turns
with equal numbers follow each other in the order of their digests; repeated
rows are turns of their own; turns without a conv_id belong to no conversation
and are left out; an empty table has no nodes; other columns are ignored. Texts
are only hashed and their words counted, whatever their length. A conversation
is one row of 20 bytes a turn, which bounds it to some fifty million turns.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored

TOKEN = 16
SHARD_BYTES = 8 << 20
SAMPLES = 32
#: Path bytes of all splitters together.
SKELETON_BYTES = 16 << 20
GROUP = 20
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string")


def conversations_of(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: digests and word counts of each conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    one = F.struct(F.col("turn").alias("turn"), digest.alias("token"),
                   F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    return (turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["token"].alias("token"), x["words"].alias("words"))).alias("t")))


def rebuilt(convs: DataFrame, group: int = GROUP, most: int = 4) -> DataFrame:
    """Each conversation's first crc32 % ``most`` turns replaced by those of the one that leads its group."""
    lead = convs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("lead"), F.slice("t", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = F.slice("t", h + 1, F.greatest(F.size("t") - h, F.lit(0)))
    return (convs.join(lead, F.col("conv_id") - F.col("conv_id") % group == F.col("lead"), "left")
            .select("conv_id", F.concat(F.coalesce(F.slice("head", 1, h), F.slice("t", 1, 0)), own).alias("t")))


def paths_of(convs: DataFrame) -> DataFrame:
    """Stored ``conv_id, path, words``."""
    path = F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["token"])), ""))
    return stored(convs.select("conv_id", path.alias("path"), F.transform("t", lambda x: x["words"]).alias("words")), "trie-paths")


def sample_splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` keys (path, conv_id) that cut the path bytes evenly."""
    size = F.octet_length("path") + 64
    total = paths.agg(F.sum(size)).first()[0]
    if not total or shards < 2:
        return []
    rate = shards * SAMPLES / total
    draw = F.pmod(F.xxhash64("conv_id", F.lit(13)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < size * F.lit(rate)
    sample = stored(paths.where(draw).select("path", "conv_id", F.greatest(size * F.lit(rate), F.lit(1.0)).alias("w")), "trie-sample")
    held = sample.agg(F.sum(F.octet_length("path"))).first()[0] or 0
    if held > 4 * SKELETON_BYTES:          # very long paths: fewer of them, so that the driver's share is bounded
        thin = F.pmod(F.xxhash64("conv_id", F.lit(29)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.lit(4 * SKELETON_BYTES / held)
        sample = sample.where(thin)
    got = sample.toArrow()
    if not got.num_rows:
        return []
    heads, ids, w = got["path"].to_pylist(), got["conv_id"].to_pylist(), got["w"].to_numpy()
    order = sorted(range(len(ids)), key=lambda i: (heads[i], ids[i]))
    run = np.cumsum(w[order])
    at = np.searchsorted(run, run[-1] * np.arange(1, shards) / shards)
    cuts = sorted({(heads[order[min(i, len(order) - 1)]], ids[order[min(i, len(order) - 1)]]) for i in at.tolist()})
    while sum(len(p) for p, _ in cuts) > SKELETON_BYTES and len(cuts) > 1:
        cuts = cuts[1::2]
    return cuts


def common_tokens(a: bytes, b: bytes) -> int:
    """Number of leading tokens that two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TOKEN
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // TOKEN


class Skeleton:
    """Splitters in order, and a number for every prefix of their paths; 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.nodes: list[list[int]] = []          # of each splitter, by depth
        self.parent, self.depth = [-1], [0]
        for i, (path, _) in enumerate(splitters):
            same = common_tokens(splitters[i - 1][0], path) if i else 0
            nodes = self.nodes[-1][:same + 1] if i else [0]
            for d in range(len(nodes), len(path) // TOKEN + 1):
                self.parent.append(nodes[-1])
                self.depth.append(d)
                nodes.append(len(self.parent) - 1)
            self.nodes.append(nodes)

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.splitters, (path, conv))

    def near(self, shard: int) -> list[tuple[bytes, list[int]]]:
        """The splitters on both sides of a shard: its skeleton nodes are prefixes of theirs."""
        return [(self.splitters[i][0], self.nodes[i]) for i in (shard - 1, shard) if 0 <= i < len(self.splitters)]


class _Open:
    """A node that is still on the stack."""
    __slots__ = ("skeleton", "words", "low", "n", "children", "leaves", "saved", "ends", "below")

    def __init__(self, skeleton: int, words: int):
        self.skeleton, self.words = skeleton, words
        self.low, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] = []
        self.below: list[int] = []                # rows of finished children


def walk(rows: list[tuple[bytes, int, list[int]]], near: list[tuple[bytes, list[int]]]) -> tuple[list[list], list[tuple]]:
    """Finished nodes and skeleton parts of one shard's rows (path, conv_id, words).

    A finished node is [conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends text, skeleton parent]; its parent's id is null where that is a
    skeleton node. A part is (skeleton node, smallest member, members, finished children,
    their leaves, their saved tokens, ends text, words of the last turn)."""
    rows.sort(key=lambda r: (r[0], r[1]))
    done, parts, stack, before = [], [], [], b""

    def close():
        node = stack.pop()
        for i in node.below:
            done[i][2 if node.skeleton < 0 else 8] = node.low if node.skeleton < 0 else node.skeleton
        ends = ",".join(map(str, node.ends))
        up = stack[-1] if stack else None
        if node.skeleton >= 0:
            parts.append((node.skeleton, node.low, node.n, node.children, node.leaves, node.saved, ends, node.words))
        else:
            leaves, saved = node.leaves if node.children else 1, node.saved + (node.n - 1) * node.words
            up.below.append(len(done))
            up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
            done.append([node.low, len(stack), None, node.n, node.children, leaves, saved, ends, -1])
        if up is not None:
            up.n += node.n
            up.low = node.low if up.low is None else min(up.low, node.low)

    for path, conv, words in rows:
        same = common_tokens(before, path) if stack else -1
        while len(stack) > same + 1:
            close()
        if len(stack) <= len(path) // TOKEN:
            known = [0] if not near else max((nodes[:common_tokens(other, path) + 1] for other, nodes in near), key=len)
            for d in range(len(stack), len(path) // TOKEN + 1):
                stack.append(_Open(known[d] if d < len(known) else -1, words[d - 1] if d else 0))
        own = stack[-1]
        own.n += 1
        own.low = conv if own.low is None else min(own.low, conv)
        own.ends.append(conv)
        before = path
    while stack:
        close()
    return done, parts


_NUMBERS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_FOUND = f"{NODE}, skeleton int, words bigint, ends string, shard int"


def _shard_nodes(skeleton):
    def work(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        rows = list(zip(table["path"].to_pylist(), table["conv_id"].to_pylist(), table["words"].to_pylist()))
        done, parts = walk(rows, skeleton.value.near(shard))
        n = len(done)
        columns = {c: pa.array([r[i] for r in done] + [None] * len(parts), pa.int64()) for i, c in enumerate(_NUMBERS)}
        for c, i in (("conv_id", 1), ("n_convs", 2), ("n_children", 3), ("n_leaves", 4), ("saved_tokens", 5)):
            columns[c] = pa.array([r[_NUMBERS.index(c)] for r in done] + [p[i] for p in parts], pa.int64())
        hashed = [hashlib.sha256(r[7].encode()).hexdigest() if r[7] else EMPTY for r in done]
        return pa.table({**columns, "ends_sha256": pa.array(hashed + [None] * len(parts), pa.string()),
                         "skeleton": pa.array([r[8] for r in done] + [p[0] for p in parts], pa.int32()),
                         "words": pa.array([None] * n + [p[7] for p in parts], pa.int64()),
                         "ends": pa.array([None] * n + [p[6] for p in parts], pa.string()),
                         "shard": pa.array([shard] * (n + len(parts)), pa.int32())})
    return work


_PART = "skeleton int, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string"


def _reduce(batches):
    """Parts sorted by (skeleton node, shard) -> one row a node; a node's parts stream by."""
    schema = pa.schema([(x.split()[0], {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[x.split()[1]])
                        for x in _PART.split(", ")])
    node, sums, ends, any_end = None, None, None, False
    out = []

    def close():
        if node is not None:
            out.append(dict(zip(schema.names, [node, *sums, ends.hexdigest()])))
    for batch in batches:
        for r in batch.to_pylist():
            if r["skeleton"] != node:
                close()
                node, sums, ends, any_end = r["skeleton"], [r["conv_id"], 0, 0, 0, 0, r["words"]], hashlib.sha256(), False
            sums[0] = min(sums[0], r["conv_id"])
            for i, c in enumerate(("n_convs", "n_children", "n_leaves", "saved_tokens"), 1):
                sums[i] += r[c]
            if r["ends"]:
                ends.update(((("," if any_end else "") + r["ends"])).encode())
                any_end = True
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _fold(skeleton: Skeleton, parts: list[dict]) -> list[tuple]:
    """Number and row of each skeleton node from their summed parts, subtrees added up from below."""
    parts.sort(key=lambda p: -skeleton.depth[p["skeleton"]])
    at = {p["skeleton"]: p for p in parts}
    for p in parts:
        p["n_leaves"] = p["n_leaves"] if p["n_children"] else 1
        p["saved_tokens"] += (p["n_convs"] - 1) * p["words"]
        up = at.get(skeleton.parent[p["skeleton"]])
        if up is not None:
            up["n_children"], up["n_leaves"] = up["n_children"] + 1, up["n_leaves"] + p["n_leaves"]
            up["saved_tokens"] += p["saved_tokens"]
    return [(i, p["conv_id"], skeleton.depth[i], at[skeleton.parent[i]]["conv_id"] if i else None, p["n_convs"],
             p["n_children"], p["n_leaves"], p["saved_tokens"], p["ends_sha256"]) for i, p in at.items()]


def trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of stored ``conv_id, path, words`` rows."""
    spark = paths.sparkSession
    if shards is None:
        size = paths.agg(F.sum(F.octet_length("path") + 64)).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    skeleton = Skeleton(sample_splitters(paths, shards))
    told = spark.sparkContext.broadcast(skeleton)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = [told.value.shard(p, c) for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
        return batch.append_column("shard", pa.array(at, pa.int32()))
    dealt = arrow_map(paths, place, "conv_id bigint, path binary, words array<int>, shard int")
    found = stored(dealt.groupBy("shard").applyInArrow(_shard_nodes(told), _FOUND), "trie-nodes")
    parts = (found.where("ends_sha256 IS NULL")
             .select("skeleton", "shard", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "ends")
             .repartition("skeleton").sortWithinPartitions("skeleton", "shard").mapInArrow(_reduce, _PART))
    rows = _fold(skeleton, [r.asDict() for r in parts.collect()])         # a row a skeleton node
    top = spark.createDataFrame([r[1:] for r in rows], NODE)
    lows = F.broadcast(spark.createDataFrame([(r[0], r[1]) for r in rows], "skeleton int, low bigint"))
    names = top.columns
    rest = found.where("ends_sha256 IS NOT NULL").join(lows, "skeleton", "left") \
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "low"))
    return rest.select(*names).unionByName(top)


def node_digest(turns: DataFrame) -> DataFrame:
    """The contract's row for each node."""
    return trie(paths_of(rebuilt(conversations_of(turns))))


#: The same nodes from all prefixes, spelled out. CRC-32 is worked bit by bit.
ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({'tok': tok, 'w': w} ORDER BY turn NULLS FIRST, tok) AS t FROM
      (SELECT conv_id, turn, md5(length(role) || ':' || role || text) AS tok,
              len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM t) GROUP BY conv_id),
h AS (SELECT *, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
             lambda a, c: list_reduce(list_prepend(xor(a, c), list_transform(range(8), lambda i: i::UBIGINT)),
                  lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT) % 4 AS INTEGER) AS h FROM l),
r AS (SELECT h.conv_id, list_concat(coalesce(b.t[1:h.h], []), coalesce(h.t[h.h + 1:], [])) AS t
      FROM h LEFT JOIN h b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, len(t) AS n, d, array_to_string(list_transform(t[1:d], lambda x: x.tok), '') AS k,
             CASE WHEN d > 0 THEN t[d].w ELSE 0 END AS w
      FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
      FROM p GROUP BY k, d),
c AS (SELECT left(k, 32 * (d - 1)) AS up, count(*) AS c FROM n WHERE d > 0 GROUP BY up),
s AS (SELECT a.k, sum(CASE WHEN c.c IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((b.n_convs - 1) * b.w) AS saved_tokens
      FROM n a JOIN n b ON starts_with(b.k, a.k) LEFT JOIN c ON c.up = b.k GROUP BY a.k)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(c.c, 0) AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.k = n.k LEFT JOIN c ON c.up = n.k LEFT JOIN n u ON n.d > 0 AND u.k = left(n.k, 32 * (n.d - 1)) AND u.d = n.d - 1
"""
