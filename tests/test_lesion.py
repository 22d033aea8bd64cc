"""Hand-made lesion codes (FIXTURES F0 edge codes)."""

import pytest
from pyspark.sql import functions as F

from stratiform.functions import lesion as L

CASES = [
    ((0, 0, 0), (0, 0, 0, 0)),
    ((9, 0, 0), (9, 0, 0, 0)),
    ((22, 0, 0), (2, 2, 0, 0)),
    ((400, 0, 0), (4, 0, 0, 0)),
    ((2124, 0, 0), (2, 1, 2, 4)),
    ((3111, 0, 0), (3, 1, 1, 1)),
    ((11124, 0, 0), (11, 1, 2, 4)),
    ((31110, 0, 0), (3, 1, 1, 10)),
    ((41110, 0, 0), (4, 1, 1, 10)),
    ((None, None, None), (-1, -1, -1, -1)),
    ((2209, 7111, 0), (7, 1, 1, 1)),
    ((2124, 2209, 0), (2, 1, 2, 4)),
    ((11124, 9000, 0), (11, 1, 2, 4)),
    ((2124, 11300, 11400), (11, 4, 0, 0)),
]


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(i, *c) for i, (c, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, lesion_1 long, lesion_2 long, lesion_3 long")
    out = df.select("id", *L.expand(L.lesion_max_site()), L.lesion_count().alias("n"))
    return {r["id"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_max_site(decoded, i):
    r = decoded[i]
    assert (r["lesion_site"], r["lesion_type"], r["lesion_subtype"], r["lesion_code"]) == CASES[i][1]


def test_count_ignores_null_and_zero(decoded):
    assert decoded[9]["n"] == 0
    assert decoded[0]["n"] == 0
    assert decoded[13]["n"] == 3


def test_first_policy(spark):
    df = spark.createDataFrame([(31110,), (11124,), (2124,), (22,), (0,), (None,), (12345,)],
                               "lesion_1 long")
    got = [tuple(r) for r in df.select(*L.expand(L.lesion_first())).collect()]
    assert got == [(3, 1, 1, 10), (11, 1, 2, 4), (2, 1, 2, 4), (2, 2, 0, 0), (0, 0, 0, 0),
                   (0, 0, 0, 0), (1, 2, 3, 10)]


def test_labels(spark):
    df = spark.createDataFrame([(2124, 0, 0), (None, None, None)], "lesion_1 long, lesion_2 long, lesion_3 long")
    lab = df.select(*L.expand(L.lesion_labels(L.lesion_max_site()), ["s", "t", "u", "c"])).collect()
    assert tuple(lab[0]) == ("sm intestine", "simple", "paralytic", "adynamic")
    assert tuple(lab[1]) == ("n/a", "n/a", "n/a", "n/a")
