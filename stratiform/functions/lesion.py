"""Lesion code decoding as pure column expressions (L1-L4).

A lesion code is up to five digits: site (1 or 2 digits, 11 = all intestinal
sites), type, subtype and a code part (two digits when the code has five
digits and does not start with 11).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col_of, map_lookup
from . import vocab

LESION_COLUMNS = ["lesion_1", "lesion_2", "lesion_3"]
DECODED = ["lesion_site", "lesion_type", "lesion_subtype", "lesion_code"]


def lesion_count(cols=LESION_COLUMNS) -> Column:
    """Number of codes greater than zero; null counts as no lesion."""
    total = F.lit(0)
    for c in cols:
        total = total + (F.coalesce(col_of(c).cast("long"), F.lit(0)) > 0).cast("int")
    return total.cast("int")


def _code_text(c) -> Column:
    txt = col_of(c).cast("long").cast("string") if not isinstance(c, str) else \
        F.col(c).cast("long").cast("string")
    return F.when(txt == "", F.lit(None)).otherwise(txt)


def _digit(txt: Column, pos: int) -> Column:
    return F.substring(txt, pos, 1).try_cast("int")


def _step(state: Column, txt: Column) -> Column:
    site = state.getField("site")
    n = F.length(txt)
    len5 = n == 5
    starts11 = len5 & (F.substring(txt, 1, 2) == "11")
    padded = F.when(n < 4, F.rpad(txt, 4, "0")).otherwise(txt)
    first = _digit(txt, 1)
    site11 = F.struct(F.lit(11).alias("site"), _digit(txt, 3).alias("type"),
                      _digit(txt, 4).alias("subtype"), _digit(txt, 5).alias("code"))
    five = F.struct(first.alias("site"), _digit(txt, 2).alias("type"),
                    _digit(txt, 3).alias("subtype"),
                    F.substring(txt, 4, 2).try_cast("int").alias("code"))
    short = F.struct(_digit(padded, 1).alias("site"), _digit(padded, 2).alias("type"),
                     _digit(padded, 3).alias("subtype"), _digit(padded, 4).alias("code"))
    return (F.when(txt.isNull(), state)
            .when(starts11, site11)
            .when(len5 & (site < first), five)
            .when(~len5 & (site < first), short)
            .otherwise(state))


def lesion_max_site(cols=LESION_COLUMNS) -> Column:
    """Decode the code with the highest site among the given columns.

    Codes are visited in column order. A five-digit code starting with 11
    always wins (so a later one replaces an earlier one); any other code wins
    only with a strictly larger first digit, so ties keep the earlier code.
    A row without any code keeps -1 everywhere. Returns a struct
    (site, type, subtype, code).
    """
    state = F.struct(F.lit(-1).alias("site"), F.lit(-1).alias("type"),
                     F.lit(-1).alias("subtype"), F.lit(-1).alias("code"))
    # a fold over the codes keeps one copy of the step expression (nesting the
    # steps would grow the generated code exponentially)
    return F.aggregate(F.array(*[_code_text(c) for c in cols]), state, _step)


def lesion_first(c="lesion_1") -> Column:
    """Decode one code by integer arithmetic (the first-lesion policy).

    11000-11999: site 11 and three single digits; other codes of five or more
    digits: first three digits with code 10; one to four digits: right-padded
    to four digits; zero, negative or null: all zero.
    """
    x = F.coalesce(col_of(c).cast("long"), F.lit(0))
    is11 = (x >= 11000) & (x < 12000)
    y = F.when(x >= 10000, F.floor(x / 10)).when(x >= 1000, x) \
        .when(x >= 100, x * 10).when(x >= 10, x * 100).when(x >= 1, x * 1000) \
        .otherwise(F.lit(0)).cast("long")

    def dig(v, p):
        return (F.floor(v / p) % 10).cast("int")

    site = F.when(is11, F.lit(11)).otherwise(dig(y, 1000))
    typ = F.when(is11, dig(x, 100)).otherwise(dig(y, 100))
    sub = F.when(is11, dig(x, 10)).otherwise(dig(y, 10))
    code = F.when(is11, (x % 10).cast("int")) \
        .when(x >= 10000, F.lit(10)).otherwise((y % 10).cast("int"))
    return F.struct(site.alias("site"), typ.alias("type"), sub.alias("subtype"),
                    code.cast("int").alias("code"))


def lesion_labels(decoded: Column) -> Column:
    """Map decoded digits to text labels; -1 and unknown values give n/a."""
    miss = vocab.LESION_LABEL_MISSING
    return F.struct(
        map_lookup(decoded.getField("site"), vocab.LESION_SITE_LABELS, miss).alias("site"),
        map_lookup(decoded.getField("type"), vocab.LESION_TYPE_LABELS, miss).alias("type"),
        map_lookup(decoded.getField("subtype"), vocab.LESION_SUBTYPE_LABELS,
                   vocab.LESION_SUBTYPE_DEFAULT).alias("subtype"),
        map_lookup(decoded.getField("code"), vocab.LESION_CODE_LABELS, miss).alias("code"),
    )


def expand(struct_col: Column, names=DECODED) -> list[Column]:
    fields = ["site", "type", "subtype", "code"]
    return [struct_col.getField(f).alias(n) for f, n in zip(fields, names)]
