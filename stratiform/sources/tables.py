"""Readers for the driver tables and the derived test frames.

The derived frames are deterministic projections of the driver tables; the
same SQL text is run by Spark (over DataFrames) and by the DuckDB oracle (over
views), so both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- F1: mixed numeric / categorical frame with nulls, three outcome classes
OBS_SQL = """
SELECT event_id AS row_id,
  CAST(user_id AS STRING) AS hospital_number,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS pulse,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE 35.0e0 + (event_id * 37 % 60) / 10.0e0 END AS rectal_temp,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(8 + event_id * 7919 % 89 AS DOUBLE) END AS respiratory_rate,
  value * 0.8e0 + event_id % 7 AS total_protein,
  1.0e0 AS const_col,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'None'
       WHEN event_id % 4 = 0 THEN 'moderate' WHEN event_id % 4 = 1 THEN 'slight'
       WHEN event_id % 4 = 2 THEN 'alert' ELSE 'severe_pain' END AS pain,
  CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '3' WHEN event_id % 37 = 0 THEN 'None'
       WHEN event_id % 3 = 0 THEN 'more_3_sec' ELSE 'less_3_sec' END AS capillary_refill_time,
  event_type AS abdomen,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 100 < 49 THEN 'lived'
       WHEN event_id % 100 < 81 THEN 'died' ELSE 'euthanized' END AS outcome
FROM {events}
"""

# --- F2: lesion codes of every length
CODES_SQL = """
SELECT p_partkey AS row_id,
  CASE p_partkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 11000 + p_partkey * 13 % 1000
       WHEN 2 THEN (2 + p_partkey % 8) * 10000 + (p_partkey * 37 % 100) * 100 + 10
       WHEN 3 THEN 1000 + p_partkey * 13 % 9000 WHEN 4 THEN 1 + p_partkey % 99
       ELSE 100 + p_partkey * 7 % 900 END AS lesion_1,
  CASE WHEN p_partkey % 5 = 0 THEN 1000 + p_partkey * 11 % 9000 ELSE 0 END AS lesion_2,
  CASE WHEN p_partkey % 10 = 0 THEN 1000 + p_partkey * 17 % 9000 WHEN p_partkey % 7 = 0 THEN NULL ELSE 0 END AS lesion_3
FROM {part}
"""

# --- F3: all 64 coordinates of the embedding, three classes (list access differs by engine);
# classes 1 and 2 are shifted by 0.2 on x0 and x1
VEC_WIDTH = 64
_SHIFT = {0: " + CASE WHEN label IN (5, 6) THEN 0.2e0 ELSE 0.0e0 END", 1: " + CASE WHEN label > 6 THEN 0.2e0 ELSE 0.0e0 END"}
_VEC_SQL = "SELECT vec_id AS row_id,\n" + "".join(
    f"  CAST({{get}}(embedding, {i + 1}) AS DOUBLE){_SHIFT.get(i, '')} AS x{i},\n" for i in range(VEC_WIDTH)
) + """  CASE WHEN label < 5 THEN 0 WHEN label < 7 THEN 1 ELSE 2 END AS label
FROM {{embeddings}}
"""
VEC_SQL_SPARK = _VEC_SQL.format(get="element_at")
VEC_SQL_DUCKDB = _VEC_SQL.format(get="list_extract")
VEC_FEATURES = [f"x{i}" for i in range(VEC_WIDTH)]

# --- F4: labels, predictions and class probabilities
PRED_SQL = """
SELECT row_id, label,
  CASE WHEN row_id * 7919 % 10 < 7 THEN label ELSE (label + 1) % 3 END AS prediction,
  r0 / (r0 + r1 + r2) AS p0, r1 / (r0 + r1 + r2) AS p1, r2 / (r0 + r1 + r2) AS p2
FROM (SELECT row_id, label,
    1.0e0 + row_id * 7919 % 97 + CASE WHEN label = 0 THEN 60 ELSE 0 END AS r0,
    1.0e0 + row_id * 6007 % 97 + CASE WHEN label = 1 THEN 60 ELSE 0 END AS r1,
    1.0e0 + row_id * 4999 % 97 + CASE WHEN label = 2 THEN 60 ELSE 0 END AS r2
  FROM (SELECT event_id AS row_id,
          CASE WHEN event_id % 100 < 49 THEN 0 WHEN event_id % 100 < 81 THEN 2 ELSE 1 END AS label FROM {events}) e) s
"""

OBS_NUMERIC = ["pulse", "rectal_temp", "respiratory_rate", "total_protein", "const_col"]
OBS_CATEGORICAL = ["hospital_number", "pain", "capillary_refill_time", "abdomen"]


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OBS_SQL, events=read_table(spark, sf_dir, "events"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CODES_SQL, part=read_table(spark, sf_dir, "part"))


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VEC_SQL_SPARK, embeddings=read_table(spark, sf_dir, "embeddings"))


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PRED_SQL, events=read_table(spark, sf_dir, "events"))


def oracle_frames() -> str:
    """WITH-clause prefix defining obs, codes, vec and pred for DuckDB."""
    return ("WITH obs AS (" + OBS_SQL.format(events="events") + "), "
            "codes AS (" + CODES_SQL.format(part="part") + "), "
            "vec AS (" + VEC_SQL_DUCKDB.format(embeddings="embeddings") + "), "
            "pred AS (" + PRED_SQL.format(events="events") + ")")
