"""WARC salvage, ns-bounds clustering and the conversation trie against brute force."""

import gzip
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from stratiform.llm import centroids, conversation_trie, warc
from stratiform.llm.common import table
from stratiform.session import scratch_path

PAGES = "page_id long, url string, html string, key string, digest int, row int, leader int, ask int, value int"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4, 5) for r in rows], PAGES).repartition(3)


# ---------------------------------------------------------------- WARC

def _odd_pages():
    copy, other = "<p>" + "cöpy " * 300 + "</p>", "x" * 1000
    quoted = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30
    return [(1, "http://a/", copy), (2, "http://b/", copy), (9, None, copy), (9, "http://again/", copy), (None, "u", copy),
            (None, "u", other), (None, None, other), (3, "http://x/\r\nWARC/1.1\r\n y", None), (4, "", ""), (5, "s", "short"),
            (6, "s", "short"), (7, "q", quoted), (8, "l", "lang ünd " * 200_000), (10, "n", "a\x00\r\n\r\nb" * 300),
            (11, "z", "\x1f\x08" * 800), (12, "e", "x" * 999), (13, "e", "x" * 999)]


def test_warc_round_trip(spark):
    df = _pages(spark, _odd_pages())
    got = sorted(map(str, warc.archive_digest(df).collect()))
    con = duckdb.connect()
    pages = df.toPandas().astype({"page_id": "Int64"})  # noqa: F841
    want = con.sql(warc.ORACLE).df()
    rows = [tuple(None if v is None or v != v else v for v in r) for r in want.astype(object).where(want.notna(), None).itertuples(index=False)]
    want = spark.createDataFrame([(None if a is None else int(a), int(b), c, d, None if e is None else int(e)) for a, b, c, d, e in rows],
                                 "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    assert got == sorted(map(str, want.collect()))
    empty = warc.archive_digest(df.where("false"))
    assert empty.count() == 0 and empty.columns == want.columns


def test_warc_archives_are_plain_gzip_members(spark):
    rows = _odd_pages()
    scan = warc.scan_archives(spark, warc.write_archives(_pages(spark, rows), archive_bytes=4000), payloads=True).collect()
    assert all(r["reason"] is None and r["member"] is not None for r in scan) and len(scan) == len(rows)
    held = sorted(bytes(r["payload"]) for r in scan if r["record_type"] == "response")
    copies = {h: max((i for i, _, x in rows if x == h and i is not None), default=None) for _, _, h in rows}
    want = sorted((h or "").encode() for i, _, h in rows if len((h or "").encode()) < 1000 or i == copies[h])
    assert held == want
    raw = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").load(warc.write_archives(_pages(spark, rows))).collect())
    inflated = gzip.decompress(raw)
    assert sum(f.reason is None for f in warc.read_archive(inflated)) == len(rows)
    assert [f.reason for f in warc.read_archive(inflated) if f.reason] == []


def _record(i, body=None, seed=0):
    body = body if body is not None else bytes(random.Random(f"{seed} {i}").randrange(256) for _ in range(200 + 37 * i % 500))
    return warc.record(i, f"http://h/{i}", body, hashlib.sha1(body).hexdigest()) + warc.END, body


def _ids(data):
    return [warc.key_of(f.headers["warc-record-id"]) for f in warc.read_archive(data) if f.reason is None]


def _whole(data):
    """Every byte lies in a record, a gap or between records as blanks; places ascend."""
    at = 0
    for f in warc.read_archive(data):
        if f.member is None:
            assert f.start >= at and not data[at:f.start].strip(b"\r\n\x00")
            at = f.stop
    return True


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_after_damage(packed):
    made = [_record(i) for i in range(12)]
    parts = [warc.member(r) if packed else r for r, _ in made]
    offsets = np.cumsum([0, *map(len, parts)]).tolist()
    clean = b"".join(parts)
    assert _ids(clean) == [str(i) for i in range(12)]
    for seed in range(60):
        rng = random.Random(seed)
        hit = rng.randrange(12)
        lo, hi = offsets[hit], offsets[hit + 1]
        kind = seed % 5
        if kind == 0:                                      # a byte of the payload
            at = rng.randrange(hi - 150, hi - 10)
            data = clean[:at] + bytes([clean[at] ^ 0x55]) + clean[at + 1:]
        elif kind == 1:                                    # bytes cut out
            at = rng.randrange(hi - 150, hi - 10)
            data = clean[:at] + clean[at + 5:]
        elif kind == 2:                                    # bytes put in
            at = rng.randrange(hi - 150, hi - 10)
            data = clean[:at] + bytes(rng.randrange(256) for _ in range(300)) + clean[at:]
        elif kind == 3:                                    # a lost header
            data = clean[:lo] + b"?" * 20 + clean[lo + 20:]
        else:                                              # the end is gone
            hit, data = 11, clean[:offsets[11] + (offsets[12] - offsets[11]) // 2]
        found = list(warc.read_archive(data))
        kept = _ids(data)
        assert kept == [str(i) for i in range(12) if i != hit], (seed, kind, kept)
        log = [f for f in found if f.reason]
        assert len(log) == 1 and lo - 4 <= log[0].start <= hi if kind != 4 else len(log) == 1
        if not packed:
            assert _whole(data)


def test_salvage_inside_one_member_and_junk_between():
    text = b"".join(_record(i)[0] for i in range(6))
    one = warc.member(text)
    broken = one[:len(one) * 2 // 3]
    kept = _ids(broken)
    assert kept and kept == [str(i) for i in range(len(kept))] and len(kept) < 6
    assert [f.reason for f in warc.read_archive(broken) if f.reason]
    tail = warc.member(_record(9)[0])
    assert _ids(broken + tail) == kept + ["9"]
    junk = b"not an archive\nWARC/9 is no version line\n\x1f\x8b\x08junk"
    data = junk + _record(1)[0] + junk + warc.member(_record(2)[0]) + junk
    assert _ids(data) == ["1", "2"]
    log = [(f.start, f.stop) for f in warc.read_archive(data) if f.reason]
    assert [data[a:b] for a, b in log] == [junk, junk, junk]
    inner = _record(3)[0].replace(b"Content-Length: ", b"Content-Length: 9", 1)        # the record's own length
    mixed = warc.member(_record(4)[0] + inner + _record(5)[0])
    assert _ids(mixed) == ["4", "5"]
    gap = [f for f in warc.read_archive(mixed) if f.reason]
    assert len(gap) == 1 and gap[0].member == 0 and gap[0].stop - gap[0].start == len(inner)
    assert list(warc.read_archive(b"")) == []


def test_salvage_over_spark(spark):
    good = [_record(i)[0] for i in range(4)]
    path = scratch_path(spark, "warc-test")
    hurt = good[1][:-300] + good[1][-290:]
    lines = [good[0][:-4], hurt[:-4], good[2][:-4]]
    df = spark.createDataFrame([(bytearray(b"\r\n\r\n".join(lines)),)], "value binary")
    df.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").text(path)
    scan = warc.scan_archives(spark, path)
    assert sorted(warc.key_of(r["record_id"]) for r in warc.records(scan).collect()) == ["0", "2"]
    gap = warc.gaps(scan).collect()
    assert len(gap) == 1 and gap[0]["start"] == len(good[0]) and gap[0]["stop"] == len(good[0]) + len(hurt)
    with pytest.raises(ValueError, match="archives of more than"):
        warc.scan_archives(spark, path, most=10)


# ---------------------------------------------------------------- clustering

def _brute_clusters(vecs, k, rounds):
    """Plain integer rounds; vecs: (id, components)."""
    rows = [(i, [max(-centroids.LIMIT, min(centroids.LIMIT, int(np.floor(64 * float(x))))) for x in v]) for i, v in vecs
            if v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:k]]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c)) for _, v in rows]
        if turn < rounds:
            for j in range(len(c)):
                own = [v for (_, v), (_, g) in zip(rows, near) if g == j]
                if own:
                    c[j] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(str((i, j, d)) for (i, _), (d, j) in zip(rows, near)), c


def test_clusters_match_plain_rounds(spark):
    rng = random.Random(3)
    hot = [0.5, 0.25, -1.0, 3.0]
    vecs = [(i, [rng.gauss(5 * (i % 6), 1) for _ in range(4)]) for i in range(600)] + [(i, hot) for i in range(600, 900)]
    vecs += [(7, hot), (7, hot), (None, [1.0] * 4), (None, None), (901, [1.0] * 3), (902, [1.0, None, 2.0, 3.0]), (903, []),
             (904, [float("nan")] * 4), (905, [float("inf"), 0.0, 0.0, 0.0]), (906, [1e30, -1e30, 0.0, 0.0]), (907, [-0.001] * 4)]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in vecs], "vec_id long, embedding array<double>, own int, v int, key int").repartition(5)
    for k, rounds in ((16, 3), (5, 12), (16, 40), (1, 2)):
        rows, c, work = centroids.cluster(df, k=k, rounds=rounds, dims=4)
        want, centers = _brute_clusters(vecs, k, rounds)
        assert sorted(str((r["key"], r["own"], r["near"])) for r in rows.collect()) == want, (k, rounds)
        assert c.tolist() == centers
        if rounds == 40:
            assert work[-1] < work[0] / 4          # settled centroids are not evaluated again
    few, c, _ = centroids.cluster(df.where("vec_id < 3"), k=16, dims=4)
    assert few.count() == 3 and len(c) == 3
    wide = df.withColumn("embedding", F.flatten(F.array_repeat("embedding", 16)))
    got = centroids.centroid_digest(wide)
    assert got.count() == len(_brute_clusters(vecs, 1, 0)[0])
    assert centroids.centroid_digest(wide.where("false")).count() == 0


def test_bound_uses_norm_of_total_displacement():
    there, back = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [60, 0]])
    h = centroids.History([there]).add(back).add(there)
    assert h.displacements()[0].tolist() == [0.0, 0.0] and h.displacements()[1][1] == pytest.approx(40)
    v, own = np.array([[1, 0]]), np.array([0])
    bound, seen = np.array([[1.0, 99.0]]), np.array([[0, 0]])
    assert centroids.assign(v, own, bound, seen, h)[2] == 1          # nothing but its own distance
    for _ in range(centroids.HISTORY + 3):
        h = h.add(there)
    assert len(h.sets) == centroids.HISTORY and h.now() == centroids.HISTORY + 5
    assert centroids.assign(v, own, bound, np.array([[0, 0]]), h)[2] == 2   # a bound older than the history


def test_assignments_exact_under_random_histories():
    rng = np.random.default_rng(5)
    v = rng.integers(-40, 40, (400, 3))
    c = rng.integers(-40, 40, (7, 3))
    h, own = centroids.History([c]), np.zeros(400, np.int64)
    bound, seen = np.zeros((400, 7)), np.full((400, 7), -1)
    for _ in range(50):
        own, near, _ = centroids.assign(v, own, bound, seen, h)
        d = ((v[:, None, :] - h.sets[-1][None]) ** 2).sum(axis=2)
        assert (own == d.argmin(axis=1)).all() and (near == d.min(axis=1)).all()
        h = h.add(h.sets[-1] + rng.integers(-2, 3, (7, 3)))


# ---------------------------------------------------------------- trie

def _brute_trie(rows):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    conv = {}
    for c, turn, role, text in rows:
        if c is not None:
            conv.setdefault(c, []).append((turn, role or "", text or ""))
    for c in conv:
        conv[c].sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()))
        conv[c] = [t[1:] for t in conv[c]]
    full = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = c - int(np.fmod(c, 20))
        full[c] = tuple(conv.get(lead, [])[:h] + own[h:])
    nodes = {}
    for c, path in full.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    kids, out = {}, []
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)

    def below(k):
        yield k
        for x in kids.get(k, []):
            yield from below(x)
    for k, members in nodes.items():
        sub = list(below(k))
        ends = ",".join(str(c) for c in sorted(members) if full[c] == k)
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(kids.get(k, [])),
                    sum(x not in kids for x in sub), sum((len(nodes[x]) - 1) * words(x[-1][1]) for x in sub if x),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def _trie(df, shards=None):
    paths = conversation_trie.paths_of(conversation_trie.rebuilt(conversation_trie.conversations_of(df)))
    return sorted(str(tuple(r)) for r in conversation_trie.trie(paths, shards).collect())


TURNS = "conv_id long, turn long, role string, text string, path int, t int, words int, shard int, skeleton int, lead int"


def test_trie_matches_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for c in range(-30, 260):
        if c % 7 == 3:
            continue
        path = [rng.choice("ab") for _ in range(rng.randrange(6))] if c % 3 else ["hot"] * 4        # a third are copies
        rows += [(c, i, rng.choice(["user"]), f"{x} says {'w ' * len(x)}") for i, x in enumerate(path)]
    rows += [(300, None, None, None), (300, 0, "user", None), (300, 0, "user", "tie"), (300, 0, "user", "tie"), (301, 5, "", "x"),
             (None, 1, "user", "nobody's"), (320, 0, "user", "long " * 200_000), (321, 0, "a", "bc"), (322, 0, "ab", "c")]
    rows += [(340, i, "user", f"t{i}") for i in range(400)] + [(341, i, "user", f"t{i}") for i in range(399)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], TURNS).repartition(4)
    want = _brute_trie(rows)
    for shards in (1, 2, 5, 40, 400):
        assert _trie(df, shards) == want, shards
    assert _trie(df.where("false")) == []
    assert _trie(df.where("conv_id = 301"), 7) == _brute_trie([(301, 5, "", "x")])


def test_trie_skeleton_stays_small(spark, monkeypatch):
    rows = [(c, i, "u", f"{(c >> i) % 2}") for c in range(64) for i in range(5)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], TURNS)
    monkeypatch.setattr(conversation_trie, "SKELETON_BYTES", 200)
    assert _trie(df, 40) == _brute_trie(rows)
    paths = conversation_trie.paths_of(conversation_trie.rebuilt(conversation_trie.conversations_of(df)))
    assert 0 < sum(len(p) for p, _ in conversation_trie.sample_splitters(paths, 40)) <= 200


def test_trie_on_the_given_table(spark):
    turns = table(spark, SMALL, "conversations")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(str(tuple(r)) for r in conversation_trie.node_digest(turns).collect()) == _brute_trie(rows)
