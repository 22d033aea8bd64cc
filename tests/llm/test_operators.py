"""The operators against brute force, with nulls, ties, long texts and empty tables."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import MEDIUM, SMALL
from stratiform.llm import (chat_repair, components, decontaminate, html_text, jaccard_join, license_scan, packing,
                            quality_rules, quality_trees, sharding, url_filter)
from stratiform.llm.common import table

LONG = " ".join(f"word{i % 997} and{i}" for i in range(40_000))
DOCS = "doc_id long, text string, source string, lang string, n_words string, key long, cid string, _hits int, x int, task int"


def _docs(spark, rows):
    """Rows (doc_id, text, source) among columns whose names the operators use themselves."""
    return spark.createDataFrame([(a, t, s, None, "n", 1, "c", None, 2, 3) for a, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    base = "Of the many words that a plain document holds most are told twice before the end of it comes near"
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", None), (4, LONG, "a"), (5, base, "a"), (5, base, "a"),
            (6, base.upper(), None), (None, base + " x", "b"), (7, "a b", "b"), (8, "A  b", "a"), (9, "Ünï cödé 日本", "b")]
    return _docs(spark, rows)


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def _jaccard_brute(rows):
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
            for w in (_words(t) for _, t in rows)]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                k = len(a & b)
                if 100 * k >= 75 * (len(a) + len(b) - k):
                    up[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    return sorted((str(rows[i][0]), len(sets[i]), str(low.get(root(i)) if sets[i] else rows[i][0])) for i in range(len(rows)))


def _jaccard(df):
    return sorted((str(a), n, str(c)) for a, n, c in jaccard_join.link_components(df).collect())


def test_url_trie(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.NET/en/a", "http://a.example.net/en", "http://x.net", "http://x.net/",
            "http://x.org/fr/?q", "http://xorg/fr/", "http://a.b.example.com/de/#t", "http://example.com?/de/", "http://a..net/x",
            "x://y.net://org/fr/", "http://net/", "http://h.example.net/EN/", "http://e.org/fr/" + "a/" * 5000]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(3, urls[4], "r")], "page_id long, url string, rule string")
    got = sorted(map(str, url_filter.judge_urls(df).collect()))
    con = duckdb.connect()
    pages = df.toPandas()  # noqa: F841
    want = con.sql(url_filter.ORACLE).df()
    want = sorted(str(r) for r in spark.createDataFrame(want.where(want.notna(), None), "page_id long, host string, path string, "
                                                        "rule string, verdict string").collect())
    assert got == want
    assert url_filter.judge_urls(df.where("false")).count() == 0
    trie = url_filter.Trie([("block", "a.com/x"), ("allow", "a.com/x/y/"), ("block", "a.com/x/y/z"), ("allow", "b.a.com")])
    assert trie.find("a.com", "/xylo")[0] == "a.com/x"
    assert trie.find("a.com", "/x/y/q")[1] == "allow"
    assert trie.find("a.com", "/x/y/zed/w")[0] == "a.com/x/y/z"
    assert trie.find("b.a.com", "/x")[0] == "b.a.com"
    assert trie.find("ba.com", "/x") is None
    with pytest.raises(ValueError):
        url_filter.Trie([("maybe", "a.com/")])


def test_registered_url_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{MEDIUM}/pages.parquet'")
    name = "op3_url_trie"
    want = sorted(map(str, con.sql(E.oracle_sql()[name]).fetchall()))
    assert sorted(str(tuple(r)) for r in E.queries()[name](spark, MEDIUM).collect()) == want


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 400])
def test_decontamination(spark, odd, block_bytes):
    r = random.Random(5)
    vocabulary = ["ab", "é1", "x", "日", "q9"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 20)))) for i in range(12)] + [(50, None), (51, "..."), (3, "x x")]
    rows = [(i, ", ".join(r.choice(vocabulary).upper() for _ in range(r.randint(0, 120)))) for i in range(60)]
    rows += [(100, items[0][1] + " tail"), (101, None), (102, LONG + " " + items[1][1]), (100, items[0][1] + " tail")]
    want = decontaminate.brute_force([x for x in rows if x[0] != 102], items)
    bench = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, n_words int")
    found = decontaminate.find_hits(_docs(spark, [(a, b, None) for a, b in rows]).select("doc_id", "text"), bench, block_bytes=block_bytes)
    got = {x.doc_id: (x.w, x.h, sorted(x.items)) for x in
           found.selectExpr("doc_id", "_hits.n_words w", "aggregate(_hits.spans, 0, (n, s) -> n + s.words) h", "_hits.items items").collect()}
    assert {k: v[:2] for k, v in got.items() if k != 102} == {k: v[:2] for k, v in want.items()}
    assert str(items[1][0]) in got[102][2] or not items[1][1].split()
    digest = {x.doc_id: tuple(x[1:]) for x in decontaminate.contamination_digest(
        _docs(spark, [(a, b, None) for a, b in rows if a != 102]), bench).collect()}
    assert digest == want
    kept = decontaminate.remove_documents(_docs(spark, [(a, b, None) for a, b in rows if a != 102]), bench, block_bytes=block_bytes)
    assert kept.columns == odd.columns
    assert {x.doc_id for x in kept.collect()} == {k for k, v in want.items() if not v[-1]}
    cut = decontaminate.remove_spans(spark.createDataFrame([(1, "Start. " + items[0][1].upper() + " end")], "doc_id long, text string"), bench)
    assert items[0][1].upper() not in cut.first().text and cut.first().text.startswith("Start.")
    assert decontaminate.remove_documents(odd, bench.where("false")).count() == odd.count()
    assert decontaminate.contamination_digest(odd.where("false"), bench).count() == 0


def test_registered_decontamination_matches_brute_force(spark):
    docs = [tuple(x) for x in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    items = [tuple(x) for x in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    got = {x[0]: tuple(x[1:]) for x in E.queries()["op7_decontaminate"](spark, SMALL).collect()}
    assert got == decontaminate.brute_force(docs, items)


def _check_shards(out, rows, shards, slack):
    assert len(out) == len(rows)
    by = {}
    for x in out:
        by.setdefault(x.shard, []).append(x)
    assert set(by) <= set(range(shards))
    for xs in by.values():
        assert sorted(x.slot for x in xs) == list(range(len(xs)))
    size = [sum(x.size for x in by.get(s, [])) for s in range(shards)]
    assert max(size) - min(size) <= 2 * slack, (max(size), min(size))


def test_sharding(spark, odd):
    rows = [(i, f"text {i} " * (i % 40), None) for i in range(3000)] + [(10_000 + i, "hot " * 30, None) for i in range(1500)] + [(None, None, None)] * 3
    out = sharding.shard_documents(_docs(spark, rows)).collect()
    _check_shards(out, rows, 40, max(len(t or "") + 16 for _, t, _ in rows))
    text = {a: t for a, t, _ in rows}
    for x in out:
        raw = (text[x.doc_id] or "").encode()
        assert (x["size"], x.text_crc32, x.law, x.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    assert sharding.shard_documents(odd.where("false")).count() == 0
    assert sharding.shard_documents(odd).count() == odd.count()


def test_registered_sharding(spark):
    out = E.queries()["op9_sampled_shards"](spark, MEDIUM).collect()
    rows = table(spark, MEDIUM, "documents").select("doc_id", F.octet_length("text").alias("n")).collect()
    _check_shards(out, rows, 40, max(x.n for x in rows) + 16)


def _ids():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda texts: [np.array([*x.ids, 0], dtype="<u4") for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def _check_pieces(out, rows, window=1024):
    """Whole documents in their pieces, whole windows; rows are (doc_id, text) with distinct ids."""
    by = {}
    for x in out:
        by.setdefault(x.doc_id, []).append(x)
    assert set(by) == {a for a, _ in rows}
    for (a, _), ids in zip(rows, _ids()([t for _, t in rows])):
        at = 0
        for x in sorted(by[a], key=lambda x: x.start):
            assert x.start == at and x.length > 0 and x.doc_tokens == len(ids)
            assert x.ids_crc32 == zlib.crc32(ids[at:at + x.length].tobytes())
            at += x.length
        assert at == len(ids)
    seq = {}
    for x in out:
        seq.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert sorted(seq) == list(range(len(seq)))
    for s, parts in seq.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == window or (at < window and at & (at - 1) == 0), (s, at)


def test_packing(spark, odd):
    rows = [(x.doc_id, x.text, x.source) for x in odd.collect()]
    distinct = [(i, t) for i, (_, t, _) in enumerate(rows)]
    out = packing.piece_digest(_docs(spark, [(i, t, s) for i, (_, t, s) in enumerate(rows)])).collect()
    _check_pieces(out, distinct)
    # Repeated and null ids are packed too.
    assert packing.piece_digest(odd).agg(F.sum("length")).first()[0] == sum(len(x) for x in _ids()([t for _, t, _ in rows]))
    assert packing.piece_digest(odd.where("false")).count() == 0


def test_packing_reaches_targets(spark):
    rows = [(i, " ".join(f"w{i} {j}" for j in range(5 + i % 90)), "big" if i % 3 else "small") for i in range(900)]
    df = _docs(spark, rows)
    for targets in (None, {"small": 0.5}, {"big": 0.25, "small": 0.75}):
        out = packing.pack(df, targets=targets).drop("ids").collect()
        source = {a: s for a, _, s in rows}
        total = {s: sum(x.length for x in out if source[x.doc_id] == s) for s in ("big", "small")}
        share = {"big": total["big"] / sum(total.values())} if targets is None else {"big": 1 - targets["small"]}
        share["small"] = 1 - share["big"]
        windows = {}
        for x in out:
            windows.setdefault(x.sequence_id, {"big": 0, "small": 0})[source[x.doc_id]] += x.length
        used = {"big": 0, "small": 0}
        for k in sorted(windows):
            if any(used[s] + 2 * 1024 > total[s] for s in used):
                break                                   # a queue runs dry
            for s in used:
                used[s] += windows[k][s]
                assert abs(used[s] - (k + 1) * 1024 * share[s]) <= 3 * packing.PACKET
        assert k > 20


def test_schedule_equals_a_played_round_robin():
    r = random.Random(6)
    for _ in range(20):
        total = [r.randint(1, 900) for _ in range(r.randint(1, 6))]
        q = packing.quanta(total, [str(i) for i in range(len(total))], {"0": 0.4} if r.random() < 0.5 else None, 64)
        plan = packing.Schedule(total, q, window=64, packet=16)
        left, deficit, at, want = list(total), [0] * len(total), 0, {}
        while any(left):
            for s in range(len(total)):
                deficit[s] += q[s]
                while left[s] and deficit[s] >= min(16, left[s]) * packing.UNIT:
                    n = min(16, left[s])
                    want[s, (total[s] - left[s]) // 16] = at
                    at, left[s], deficit[s] = at + n, left[s] - n, deficit[s] - n * packing.UNIT
        keys = sorted(want)
        queue, packet = (np.array([k[i] for k in keys]) for i in (0, 1))
        assert plan.position(queue, packet, packet * 16).tolist() == [want[k] for k in keys]


def test_registered_packing(spark):
    rows = [tuple(x) for x in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    _check_pieces(E.queries()["op1_mixture_packing"](spark, SMALL).collect(), rows)


def test_quality_rules(spark, odd):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    model = quality_rules.fit(docs, labels)
    out = {x.doc_id: x for x in quality_rules.judge(docs, model).collect()}
    quality = {x.doc_id: x.quality for x in labels.collect()}
    seen = [(quality[k], x.kept) for k, x in out.items() if k in quality and not x.base_failed]
    assert np.mean([bool(q) == kept for q, kept in seen]) > 0.98
    assert np.mean([kept for q, kept in seen if q]) > 0.99
    got = quality_rules.judge(odd, model).collect()
    assert len(got) == odd.count()
    for x in got:
        assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words) and not (x.kept and x.base_failed)
    assert quality_rules.keep_passing(odd, model).columns == odd.columns
    assert quality_rules.keep_passing(odd.where("false"), model).count() == 0
    blank = quality_rules.fit(docs, labels.where("false"))
    assert not blank.trained and all(x.kept != x.base_failed for x in quality_rules.judge(odd, blank).collect())
    nulls = labels.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert not quality_rules.fit(docs, nulls).trained


def test_quality_trees(spark, odd):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    out = quality_trees.score_documents(docs, labels).collect()
    quality = {x.doc_id: x.quality for x in labels.collect()}
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in out)
    held = [(quality[x.doc_id], x.score, x.predicted) for x in out if x.held_out and x.doc_id in quality]
    assert np.mean([q == p for q, _, p in held]) > 0.95
    good, bad = ([s for q, s, _ in held if q == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.98
    odd_out = quality_trees.score_documents(odd.withColumn("quality", F.lit(1)), labels).collect()
    assert len(odd_out) == odd.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in odd_out)
    assert {x.score for x in quality_trees.score_documents(odd, labels.where("false")).collect()} == {0.5}
    forest = quality_trees.fit(docs, labels)
    kept = quality_trees.keep_quality(odd, forest)
    assert kept.columns == odd.columns and kept.count() == int((forest.score(quality_trees.statistics(
        odd.select("text").toArrow()["text"].combine_chunks())) >= 0.3).sum())
    assert quality_trees.score_documents(odd.where("false"), labels).count() == 0


def test_forest_learns_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    f = quality_trees.train(x[:2000], y[:2000])
    assert np.mean((f.score(x[2000:]) > 0.5) == y[2000:]) > 0.95
    assert quality_trees.train(x, np.ones(3000)).score(x).min() > 0.9


def _near(seed, groups):
    r = random.Random(seed)
    rows = []
    for size, edits in groups:
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(30, 70))]
        for _ in range(size):
            words = list(base)
            for _ in range(r.randint(0, edits)):
                words[r.randrange(len(words))] = f"e{r.randint(0, 10**6)}"
            rows.append(" ".join(words))
    r.shuffle(rows)
    return [(i * 3 % 1009 if i % 50 else i, t) for i, t in enumerate(rows)]


def test_jaccard_join(spark, odd):
    odd_rows = [(x.doc_id, x.text) for x in odd.collect()]
    assert _jaccard(odd) == _jaccard_brute(odd_rows)
    rows = _near(8, [(1, 0)] * 60 + [(2, 3)] * 20 + [(6, 4)] * 8 + [(60, 4), (90, 2)])
    df = _docs(spark, [(a, t, None) for a, t in rows])
    want = _jaccard_brute(rows)
    assert _jaccard(df) == want
    assert jaccard_join.link_components(df.where("false")).count() == 0


def test_jaccard_join_without_and_with_hot_lists(spark, monkeypatch):
    rows = _near(9, [(1, 0)] * 20 + [(40, 5), (5, 2)])
    df = _docs(spark, [(a, t, None) for a, t in rows]).repartition(3)
    want = _jaccard_brute(rows)
    scanned = jaccard_join.scan_classes(df)
    assert len(jaccard_join.hot_shingles(scanned)) > 0
    assert _jaccard(df) == want
    monkeypatch.setattr(jaccard_join, "hot_shingles", lambda scanned: np.zeros(0, np.uint64))
    assert _jaccard(df) == want


def test_keep_one(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "q r s t u v"), (3, "q r s t u v"), (None, "a b c d e f"), (9, None), (8, "")]
    df = _docs(spark, [(a, t, None) for a, t in rows])
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == ["1", "3", "8", "9", "None"]


def test_components(spark):
    r = random.Random(10)
    edges = [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)] + [(r.randint(0, 300), r.randint(0, 300)) for _ in range(150)] + [(7, 500 + i) for i in range(200)]
    r.shuffle(edges)
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    got = {x.node: x.up for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up if root(x) != x}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_registered_join_matches_brute_force(spark):
    rows = [tuple(x) for x in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = sorted((str(a), n, str(c)) for a, n, c in E.queries()["op5_jaccard_join"](spark, SMALL).collect())
    assert got == _jaccard_brute(rows)


def test_licenses(spark, odd):
    mit = license_scan.TEMPLATES[5][1]
    noisy = re.sub("Software", "Program", mit).replace("free of charge, ", "")
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, f"some words\n{gpl}\nmore words of the text"), (2, gpl.upper() + " x " * 40 + gpl), (3, "lead " + noisy + " tail"),
            (4, "Released under. " + "the text " * 30 + "MIT License"), (5, "All rights reserved. Released under the MIT license"),
            (6, LONG + " " + mit), (7, None), (8, "license " * 50)]
    out = {x.doc_id: x for x in license_scan.license_digest(_docs(spark, [(a, t, None) for a, t in rows])).collect()}
    assert [out[i].license for i in range(1, 9)] == ["GPL-3.0", "GPL-3.0", "MIT", None, "MIT", "MIT", None, None]
    assert out[1].coverage == 1 and (out[1].first_word, out[1].last_word) == (2, 13)
    assert out[5].licenses == "MIT,proprietary" and 0.8 <= out[3].coverage < 1 and out[6].n_matched == len(out and mit.replace("and/or", "and or").split())
    assert license_scan.license_digest(odd).count() == odd.count()
    assert license_scan.license_digest(odd.where("false")).count() == 0


def test_patience_alignment_is_a_common_subsequence():
    r = random.Random(11)

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]
    for _ in range(300):
        a, b = ([r.randint(0, 12) for _ in range(r.randint(0, 30))] for _ in range(2))
        got = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p < q and s < t for (p, s), (q, t) in zip(got, got[1:]))
        assert len(got) <= lcs(a, b)
    for n in (1, 5, 40):
        b = [r.randint(0, 60) for _ in range(n)]
        assert len(license_scan.align([99] * 7 + b + [98] * 3, b)) == n
    assert license_scan.increasing([(0, 3), (1, 1), (2, 2), (3, 5), (4, 4)]) in ([(1, 1), (2, 2), (4, 4)], [(1, 1), (2, 2), (3, 5)])


def test_registered_licenses_find_every_notice(spark):
    out = {x.doc_id: x for x in E.queries()["op4_patience_licenses"](spark, MEDIUM).collect()}
    short = [(n, t) for n, t in license_scan.TEMPLATES[:5]]
    rows = table(spark, MEDIUM, "documents").select("doc_id", "text").collect()
    for doc, text in rows:
        planted = {n for n, t in short if t in (text or "")}
        assert planted <= set(out[doc].licenses.split(",")), doc
        if not planted:
            assert out[doc].coverage is None or out[doc].coverage < 1
    assert len(out) == len(rows)


def _chat_brute(roles, costs=chat_repair.COSTS):
    """Least (cost, repaired turns) over all legal repairs, by search over states."""
    best = {0: (0, 0)}
    legal = chat_repair.LEGAL
    for role in roles:
        for _ in range(2):
            for s, (c, n) in list(best.items()):
                for t in legal[s]:
                    best[t] = min(best.get(t, (10**9, 0)), (c + costs.insert, n + 1))
        new = {}
        for s, (c, n) in best.items():
            for t in legal[s]:
                d = 0 if t == role else costs.relabel if role else costs.name_unknown
                new[t] = min(new.get(t, (10**9, 0)), (c + d, n + 1))
            if s:
                d = 0 if s == role else costs.relabel if role else costs.name_unknown
                new[s] = min(new.get(s, (10**9, 0)), (c + d + costs.merge, n))
        best = new
    end = chat_repair.closing(costs)
    return min((c + end[s][0] // chat_repair.UNIT, n + end[s][0] % chat_repair.UNIT) for s, (c, n) in best.items())


@pytest.mark.parametrize("chunk", [2, 7, 4096])
def test_chat_repair(spark, monkeypatch, chunk):
    monkeypatch.setattr(chat_repair, "CHUNK", chunk)
    r = random.Random(12)
    names = ["user", "assistant", "system", "Human", "tool", None]
    code = {"user": 2, "Human": 2, "assistant": 3, "system": 1}
    convs = {k: [(r.choices(names, [5, 5, 1, 1, 1, 1])[0], f"t{k}.{i}" if r.random() < 0.9 else None) for i in range(r.randint(1, 25))] for k in range(30)}
    rows = [(k, i, role, text, 1) for k, c in convs.items() for i, (role, text) in enumerate(c)]
    rows += [(None, 0, "user", "n", 1), (None, None, "system", "s", 1), (777, 5, "user", "same", 1), (777, 5, "user", "same", 1)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int").repartition(4)
    out = {}
    for x in chat_repair.repair(df).collect():
        out.setdefault(x.conv_id, []).append(x)
    assert set(out) == set(convs) | {None, 777}
    c = chat_repair.COSTS
    price = {"keep": 0, "merge": c.merge, "insert": c.insert, "close": 0, "relabel": c.relabel, "relabel+merge": c.relabel + c.merge}
    for k, turns in convs.items():
        got = sorted(out[k], key=lambda x: (x.out_turn, x.piece))
        assert [x.turn for x in got if x.turn is not None] == list(range(len(turns)))
        paid = sum(price[x.action] + (c.name_unknown - c.relabel if "relabel" in x.action and turns[x.turn][0] not in code else 0) for x in got)
        n = len({x.out_turn for x in got}) - 1
        assert (paid, n) == _chat_brute([code.get(role, 0) for role, _ in turns])
        whole = "".join(x.rendered for x in got)
        parts = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", whole, re.S)
        assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in parts) == whole
        roles = [a for a, _ in parts]
        roles = roles[1:] if roles[0] == "system" else roles
        assert roles and roles == ["user", "assistant"] * (len(roles) // 2)
        for _, text in turns:
            assert (text or "") in whole
    assert chat_repair.repair(df.where("false")).count() == 0


def test_registered_chat_keeps_every_turn(spark):
    out = E.queries()["op6_chat_repair"](spark, MEDIUM)
    assert out.where("turn is not null").count() == table(spark, MEDIUM, "conversations").count()


@pytest.mark.parametrize("shard_bytes", [html_text.SHARD_BYTES, 400])
def test_html_extraction(spark, shard_bytes):
    menu = "Menu Home About Contact Shop Help Press Jobs Terms Privacy"
    rows = [(i, f"http://h{i % 2}.com/{i}", f"<div>{menu}</div><div>own{i} words{i} here{i}</div><p>{menu} bye</p>", "t") for i in range(12)]
    rows += [(20, "http://h0.com/a", f"<div>{menu}</div><article><p>{menu}<p>x&amp;y</article>", "t"), (21, None, None, "t"), (22, "http://h0.com/", "", "t"),
             (4, *rows[4][1:]), (None, "http://h1.com/q", "<p>" + LONG + "</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {x.page_id: x for x in html_text.page_digest(df).collect()} if shard_bytes == html_text.SHARD_BYTES else \
        {x.page_id: x for x in html_text.extract(df, shard_bytes=shard_bytes).collect()}
    assert len(got) == 16
    for i in range(12):
        assert got[i].text == f"own{i} words{i} here{i}"
    assert got[20].text == f"{menu}\nx&y" and got[21].text == got[22].text == "" and got[None].text == LONG
    assert html_text.extract(df, shard_bytes=shard_bytes).count() == len(rows)
    assert html_text.page_digest(df.where("false")).count() == 0


def test_registered_extraction(spark):
    import html
    rows = {x.page_id: x for x in table(spark, MEDIUM, "pages").collect()}
    out = E.queries()["op10_host_suffixes"](spark, MEDIUM).collect()
    assert len(out) == len(rows)
    for x in out:
        article = re.search(r"<article>(.*?)</article>", rows[x.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert x.text == "\n".join(b for b in blocks if b) and x.n_chars == len(x.text) and x.url == rows[x.page_id].url


@pytest.mark.parametrize("shard_bytes", [html_text.SHARD_BYTES, 3000])
def test_html_keeps_passages_that_few_pages_share(spark, shard_bytes):
    r = random.Random(31)

    def words(n):
        return " ".join("w%d" % r.randint(0, 10 ** 6) for _ in range(n))
    menu, quote, near = words(12), words(15), [words(30) for _ in range(3)]
    body = {i: [words(20), f"{words(5)} {quote} {words(5)}" if i < 8 else words(25), words(9)] for i in range(30)}
    body |= {100 + i: [*near, words(2)] for i in range(2)}
    rows = [(i, "http://one.com/%d" % i, f"<div>{menu}</div>" + "".join(f"<p>{b}</p>" for b in bs)) for i, bs in body.items()]
    rows += [(1000 + k, "http://one.com/c%d" % k, rows[29][2]) for k in range(40)]          # copies: one stream
    rows += [(2000 + i, "http://two.com/%d" % i, f"<p>{near[0]}</p><p>{i}</p>") for i in range(2)]
    got = {x.page_id: x.text for x in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"),
                                                        shard_bytes=shard_bytes).collect()}
    assert len(got) == len(rows)
    for i, bs in body.items():
        assert got[i] == "\n".join(bs)
    assert {got[1000 + k] for k in range(40)} == {"\n".join(body[29])}
    assert [got[2000 + i] for i in range(2)] == [f"{near[0]}\n{i}" for i in range(2)]


def test_licenses_after_a_template_word_at_the_text_ends(spark):
    lead, tail = "All dogs bark at " + "some cats and birds " * 8, " the seats by the door were " + "kept for guests " * 8 + "reserved"
    gpl = license_scan.TEMPLATES[1][1]
    rows = [(1, lead + "All rights reserved."), (2, "All rights reserved." + tail), (3, lead + "All rights reserved." + tail),
            (4, "This " + "text of words " * 8 + gpl)]
    out = {x.doc_id: x for x in license_scan.license_digest(_docs(spark, [(a, t, None) for a, t in rows])).collect()}
    n = len(lead.split())
    assert [(out[i].license, out[i].coverage, out[i].first_word) for i in range(1, 5)] == [
        ("proprietary", 1, n), ("proprietary", 1, 0), ("proprietary", 1, n), ("GPL-3.0", 1, 25)]


def test_keep_one_tells_rows_apart(spark):
    a, b, c = "a b c d e f g h", "q r s t u v w x", "k l m n o p i j"
    rows = [(1, a), (5, a), (5, b), (7, c), (7, b + " y"), (7, b + " y z"), (9, "z"), (9, "zz"), (9, "z")]
    rows += [(None, "n1 n2 n3 n4 n5 n6 n7")] * 3 + [(None, "n1 n2 n3 n4 n5 n6 n7"), (None, ""), (None, ""), (None, None)]
    df = _docs(spark, [(i, t, None) for i, t in rows])
    got = sorted((str(x.doc_id), x.text) for x in jaccard_join.keep_one(df).collect() if x.text)
    assert got == sorted([("1", a), ("5", b), ("7", c), ("9", "z"), ("9", "zz"), ("None", "n1 n2 n3 n4 n5 n6 n7")])
    assert jaccard_join.keep_one(df).count() == len(got) + 3


def test_packing_of_long_runs_and_named_targets(spark, monkeypatch):
    rows = [(1, " " * 1_000_000, "a"), (2, "see <|endoftext|> here", ""), (3, "\n" * 300_000 + "x", None)]
    out = packing.piece_digest(_docs(spark, rows)).collect()
    _check_pieces(out, [(a, t) for a, t, _ in rows])
    # Small sources with a target have queues of their own, whatever their names are.
    monkeypatch.setattr(packing, "OWN_QUEUES", 2)
    texts = [(i, f"w{i} " * 400, s) for i, s in enumerate(["big"] * 40 + ["large"] * 40 + ["pooled 0"] * 12 + [""] * 12 + [None] * 12)]
    got = packing.pack(_docs(spark, texts), targets={"pooled 0": 0.3, "": 0.2, None: 0.1}).collect()
    source = {i: s for i, _, s in texts}
    first = [x for x in got if x.sequence_id < 8]
    share = {s: sum(x.length for x in first if source[x.doc_id] == s) / 8192 for s in ("pooled 0", "", None)}
    assert abs(share["pooled 0"] - 0.3) < 0.05 and abs(share[""] - 0.2) < 0.05 and abs(share[None] - 0.1) < 0.05


def test_labelled_sample_is_bounded(spark):
    docs = _docs(spark, [(1, f"text {i % 700}", "a") for i in range(3000)] + [(i, "plain words", "b") for i in range(2, 60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] * 2 + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_trees.labelled_sample(docs, labels, 20).collect()
    assert len(rows) == 20
    assert sorted(rows) == sorted(quality_trees.labelled_sample(docs.repartition(7), labels.repartition(3), 20).collect())
    every = quality_trees.labelled_sample(docs, labels, 10_000).collect()
    assert len(every) == 700 + 58


def test_repeated_rows_are_spread_over_shards(spark):
    docs = _docs(spark, [(1, "same text", "a")] * 3000 + [(i, f"text {i}", "a") for i in range(2, 6000)])
    out = sharding.shard_documents(docs, 8).collect()
    sizes = [sum(x.size for x in out if x.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) < 200 and len({x.shard for x in out if x.doc_id == 1}) > 1
    stored_ranges = sharding.in_ranges(docs.select(F.xxhash64("text").alias("k")), np.zeros(0, np.int64))
    assert stored_ranges.count() == 8998


def test_chat_chunks_are_cut_by_bytes(spark, monkeypatch):
    turns = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i} " + "long " * 200) for i in range(60)] + [(1, 60, "user", "same")] * 40
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    want = "".join(x.rendered for x in sorted(chat_repair.repair(df).collect(), key=lambda x: (x.out_turn, x.piece)))
    monkeypatch.setattr(chat_repair, "CHUNK_BYTES", 3000)
    rows = chat_repair._sorted_rows(df)
    per = rows.groupBy("seg", "chunk").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()
    assert all(x.b <= 3000 or x.n == 1 for x in per) and rows.count() == 100
    got = "".join(x.rendered for x in sorted(chat_repair.repair(df).collect(), key=lambda x: (x.out_turn, x.piece)))
    assert got == want


def test_decontamination_with_a_full_filter(spark, monkeypatch):
    docs = [(x.doc_id, x.text) for x in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    items = [(str(x.item_id), x.text) for x in table(spark, SMALL, "benchmark").collect()]
    df, bench = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    want = sorted(map(tuple, decontaminate.contamination_digest(df, bench).collect()))
    matched = decontaminate.matched_windows(df, decontaminate.windows_of(bench, "item_id", "text", 13), "text").count()
    monkeypatch.setattr(decontaminate, "MOST_LOG_BITS", 10)        # nearly every window passes it
    assert sorted(map(tuple, decontaminate.contamination_digest(df, bench).collect())) == want
    assert decontaminate.matched_windows(df, decontaminate.windows_of(bench, "item_id", "text", 13), "text").count() == matched
    assert 0 < matched < len(items) * 200 and len(docs) == len(want)


def test_long_lists_leave_in_counted_batches(monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS", 500)
    r = np.random.default_rng(3)
    token = r.integers(0, 4, 400).astype(np.uint64)
    cid = r.integers(0, 150, 400).astype(np.int64)
    size = (40 + cid % 30).astype(np.uint32)
    halves = [[x[:200].tobytes(), x[200:].tobytes()] for x in (token, cid, size)]
    got = {}
    for batch in jaccard_join.merge_lists(*halves):
        for a, b, n in zip(*(c.to_pylist() for c in batch.columns)):
            got[a, b] = got.get((a, b), 0) + n
    want = {}
    for t in range(4):
        on = sorted(set(cid[token == t].tolist()))
        for i, a in enumerate(on):
            for b in on[i + 1:]:
                if 100 * min(40 + a % 30, 40 + b % 30) >= 75 * max(40 + a % 30, 40 + b % 30):
                    want[a, b] = want.get((a, b), 0) + 1
    assert got == want


def test_hot_shingles_do_not_depend_on_layout(spark):
    shared = "one two three four five six"
    df = _docs(spark, [(i, f"{shared} " + " ".join(f"u{i}x{j}" for j in range(12)), None) for i in range(300)])
    hot = [jaccard_join.hot_shingles(jaccard_join.scan_classes(d)).tolist() for d in (df.repartition(1), df.repartition(40))]
    assert hot[0] == hot[1] and len(hot[0]) >= 2
