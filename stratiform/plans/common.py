"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import oracle_frames


def rounded(*cols, digits: int = 6):
    return [F.round(F.col(c), digits).alias(c) for c in cols]


def oracle(body: str, ctes: str = "") -> str:
    """DuckDB text: the shared frame CTEs, optional extra CTEs, then ``body``."""
    prefix = oracle_frames()
    if ctes:
        prefix += ", " + ctes
    return prefix + "\n" + body


# DuckDB forms of the harmonisation rules for the obs columns (P5)
PAIN_SQL = ("CASE pain WHEN 'None' THEN 'alert' WHEN 'moderate' THEN 'mild_pain' "
            "WHEN 'slight' THEN 'moderate' ELSE pain END")
CRT_SQL = ("CASE WHEN capillary_refill_time IN ('None', '3') THEN 'less_3_sec' "
           "ELSE capillary_refill_time END")
ABDOMEN_SQL = "CASE WHEN abdomen = 'None' THEN 'normal' ELSE abdomen END"

HARMONISED_OBS = ("harm AS (SELECT row_id, hospital_number, pulse, rectal_temp, "
                  "respiratory_rate, total_protein, const_col, "
                  f"{PAIN_SQL} AS pain, {CRT_SQL} AS capillary_refill_time, "
                  f"{ABDOMEN_SQL} AS abdomen, outcome FROM obs)")
