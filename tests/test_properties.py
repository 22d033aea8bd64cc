"""Property checks: the lesion column expressions against a plain-Python
statement of the decoding rule, and streaming scoring against batch scoring."""

import random

from pyspark.sql import functions as F

from stratiform.functions import lesion as L


def _rule(codes):
    """Highest-site decoding stated directly: visit codes in order; a
    five-digit code starting with 11 always wins; another code wins when its
    first digit is strictly larger than the current site."""
    site = typ = sub = code = -1
    for v in codes:
        if v is None:
            continue
        t = str(v)
        if len(t) == 5 and t[:2] == "11":
            site, typ, sub, code = 11, int(t[2]), int(t[3]), int(t[4])
        elif len(t) == 5:
            if site < int(t[0]):
                site, typ, sub, code = int(t[0]), int(t[1]), int(t[2]), int(t[3:5])
        elif site < int(t[0]):
            p = t.ljust(4, "0")
            site, typ, sub, code = int(p[0]), int(p[1]), int(p[2]), int(p[3])
    return site, typ, sub, code


def test_max_site_matches_rule(spark):
    rng = random.Random(11)

    def draw():
        r = rng.random()
        if r < 0.1:
            return None
        if r < 0.2:
            return 0
        digits = rng.randint(1, 5)
        return rng.randint(10 ** (digits - 1), 10 ** digits - 1)

    rows = [(i, draw(), draw(), draw()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, lesion_1 long, lesion_2 long, lesion_3 long")
    got = {r["id"]: (r["lesion_site"], r["lesion_type"], r["lesion_subtype"], r["lesion_code"])
           for r in df.select("id", *L.expand(L.lesion_max_site())).collect()}
    for i, a, b, c in rows:
        assert got[i] == _rule([a, b, c]), (a, b, c)
    counts = {r["id"]: r["n"] for r in df.select("id", L.lesion_count().alias("n")).collect()}
    for i, a, b, c in rows:
        assert counts[i] == sum(1 for v in (a, b, c) if v is not None and v > 0)


def test_stream_scoring_equals_batch(spark):
    from stratiform.operators.models import Classifier
    from stratiform.operators.score import load_trained, save_trained, score
    from stratiform.plans.queries_models import CLASS_NAMES, _recipe
    from stratiform.session import scratch_path
    from stratiform.sources.tables import VEC_FEATURES, vec
    from stratiform.streaming.scoring import start_scoring_stream
    v = vec(spark, "/root/testdata/sf0.001")
    train, new = v.where(F.col("row_id") % 5 != 0), v.where(F.col("row_id") % 5 == 0).drop("label")
    rec = _recipe().fit(train)
    model = Classifier("naive_bayes", VEC_FEATURES, "label").fit(rec.transform(train))
    path = scratch_path(spark, "stream-model")
    save_trained(path, rec, model)
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-sink")
    new.write.parquet(src)
    q = start_scoring_stream(spark, path, src, new.schema, sink, class_names=CLASS_NAMES)
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).drop("batch")
                      .select("row_id", "prediction", "outcome").collect())
    r2, m2 = load_trained(spark, path)
    batch = sorted(tuple(r) for r in score(new, r2, m2, "row_id", CLASS_NAMES)
                   .select("row_id", "prediction", "outcome").collect())
    assert streamed == batch and len(batch) == new.count()
