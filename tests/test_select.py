"""Correlation filter against plain Python, with NaN and null, on both sides of the width switch."""

import math
import random

import numpy as np
import pytest

from stratiform.operators.select import WIDE, DropCorrelated, correlation_decisions


@pytest.mark.parametrize("p", [5, WIDE + 3])
def test_nan_counts_as_absent_at_every_width(spark, p):
    r = random.Random(7)
    rows = [[r.gauss(0, 1) for _ in range(p)] for _ in range(60)]
    for i, row in enumerate(rows):
        row[2] = row[0] + 0.1 * row[2]            # correlated with c0
        if i % 9 == 0:
            row[1] = math.nan
        if i % 7 == 0:
            row[2] = math.nan if i % 2 else None
        row[3] = math.nan                         # no value at all
    cols = [f"c{i}" for i in range(p)]
    df = spark.createDataFrame([tuple(x) for x in rows], ", ".join(f"{c} double" for c in cols))
    x = np.array([[math.nan if v is None else v for v in row] for row in rows])
    want = []
    for j, c in enumerate(cols):
        some = []
        for i in range(j):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if both.any():
                some.append(abs(np.corrcoef(x[both, i], x[both, j])[0, 1]))
        want.append((c, round(max(some), 4) if some else None, not some or max(some) <= 0.75))
    got = [(c, None if m is None else round(m, 4), keep) for c, m, keep in correlation_decisions(df, cols).collect()]
    assert got == want
    assert DropCorrelated(cols).fit(df).params["drop"] == [c for c, _, keep in want if not keep] == ["c2"]
