"""Column-expression building blocks (all JVM side, no UDFs)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_lookup(c, mapping: dict, default=None, keep_unmapped: bool = False) -> Column:
    """Exact-match lookup of ``c`` in a literal map.

    ``keep_unmapped`` returns the input for keys that are not in the map;
    otherwise unmapped keys (and null) give ``default``.
    """
    c = col_of(c)
    if not mapping:
        return c if keep_unmapped else F.lit(default)
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = F.when(c.isNull(), F.lit(None)).otherwise(m[c])
    if keep_unmapped:
        return F.coalesce(hit, c)
    if default is not None:
        return F.coalesce(hit, F.lit(default))
    return hit


def hash_u32(key, seed) -> Column:
    """Deterministic 32-bit hash of ``seed:key`` from md5 (same value in DuckDB:
    ``('0x' || substr(md5(seed || ':' || key), 1, 8))::BIGINT``)."""
    txt = F.concat(F.lit(f"{seed}:"), col_of(key).cast("string"))
    return F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("long")


def hash_u32_sql(key_sql: str, seed) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT"


# Inverse standard normal CDF, Acklam's rational approximation (published
# coefficients, relative error about 1.15e-9). One SQL text serves Spark and DuckDB.
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00]


def _horner(coefs, x):
    expr = f"{coefs[0]!r}"
    for c in coefs[1:]:
        expr = f"({expr} * {x} + {c!r})"
    return expr


def probit_sql(p: str) -> str:
    """SQL expression of Φ⁻¹(p) for 0 < p < 1 (null outside)."""
    lo = 0.02425
    q_lo = f"sqrt(-2.0 * ln({p}))"
    q_hi = f"sqrt(-2.0 * ln(1.0 - {p}))"
    tail_lo = f"({_horner(_C, q_lo)} / ({_horner(_D, q_lo)} * {q_lo} + 1.0))"
    tail_hi = f"(-({_horner(_C, q_hi)}) / ({_horner(_D, q_hi)} * {q_hi} + 1.0))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    central = f"({_horner(_A, r)} * {q} / ({_horner(_B, r)} * {r} + 1.0))"
    return (f"(CASE WHEN {p} <= 0.0 OR {p} >= 1.0 OR {p} IS NULL THEN NULL "
            f"WHEN {p} < {lo} THEN {tail_lo} "
            f"WHEN {p} > {1 - lo} THEN {tail_hi} "
            f"ELSE {central} END)")


def probit(c) -> Column:
    name = "__p"
    return F.expr(probit_sql(name).replace(name, f"({_sql_of(c)})"))


def _sql_of(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("probit() takes a column name")


def bucket_equal_width(c, lo: float, hi: float, n: int) -> Column:
    """1-based equal-width bin of ``c`` in [lo, hi]; ``hi`` goes to the last bin."""
    c = col_of(c)
    if hi == lo:
        return F.when(c.isNotNull(), F.lit(1))
    raw = F.floor((c - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(n))) + 1
    # greatest/least skip nulls, so guard explicitly
    return F.when(c.isNotNull(), F.least(F.greatest(raw, F.lit(1)), F.lit(n)).cast("int"))
