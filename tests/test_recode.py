from stratiform.functions import vocab
from stratiform.operators import recode as R


def test_rule_chain_is_followed_once():
    m = vocab.collapse_rules(vocab.HARMONISE_RULES, "pain")
    assert m == {"None": "alert", "moderate": "mild_pain", "slight": "moderate"}
    assert vocab.collapse_rules(vocab.HARMONISE_RULES, "capillary_refill_time") == \
        {"None": "less_3_sec", "3": "less_3_sec"}


def test_harmonise_keeps_none_level_semantics(spark):
    df = spark.createDataFrame([("None",), (None,), ("slight",), ("moderate",), ("alert",)], "pain string")
    got = [r[0] for r in R.harmonise(df).collect()]
    assert got == ["alert", None, "moderate", "mild_pain", "alert"]


def test_harmonise_is_not_idempotent(spark):
    df = spark.createDataFrame([("slight",)], "pain string")
    once = R.harmonise(df)
    twice = R.harmonise(once)
    assert once.first()[0] == "moderate" and twice.first()[0] == "mild_pain"


def test_unseen_fallback_ties_to_smallest(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a")], "row_id int, h string")
    fitted = R.UnseenFallback("h").fit(train)
    assert fitted.params["most_frequent"] == "a"
    new = spark.createDataFrame([(5, "z"), (6, "b"), (7, None)], "row_id int, h string")
    got = {r["row_id"]: r["h"] for r in fitted.transform(new).collect()}
    assert got == {5: "a", 6: "b", 7: None}


def test_outcome_codes_round_trip(spark):
    df = spark.createDataFrame([("died",), ("euthanized",), ("lived",)], "outcome string")
    coded = R.encode_outcome(df, "outcome", "code")
    assert [r["code"] for r in coded.collect()] == [2, 1, 0]
    back = R.decode_outcome(coded, "code", "again")
    assert [r["again"] for r in back.collect()] == ["died", "euthanized", "lived"]


def test_distinct_rows_keeps_smallest_key_and_nulls_equal(spark):
    df = spark.createDataFrame([(3, None, "x"), (1, None, "x"), (2, 1.0, "x")],
                               "row_id int, a double, b string")
    got = sorted(tuple(r) for r in R.distinct_rows(df).collect())
    assert got == [(1, None, "x"), (2, 1.0, "x")]


def test_wide_stats_match_column_aggregates(spark):
    import math

    from pyspark.sql import functions as F

    from stratiform.operators.select import wide_stats
    df = spark.range(500).select(*[(F.rand(i) * (i + 1)).alias(f"c{i}") for i in range(30)])
    df = df.withColumn("c3", F.when(F.col("c3") > 2, F.col("c3")))  # a column with nulls
    st = wide_stats(df, df.columns)
    row = df.agg(*[F.avg(c).alias(f"m{c}") for c in df.columns],
                 *[F.stddev_pop(c).alias(f"s{c}") for c in df.columns]).first()
    for c in df.columns:
        assert math.isclose(st[c]["mean"], row[f"m{c}"], rel_tol=1e-9)
        assert math.isclose(st[c]["std"], row[f"s{c}"], rel_tol=1e-9)
