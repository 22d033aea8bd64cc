"""Slices 0-1: sources, recoding, keys, lesion codes, scalar functions."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ..functions import lesion as L
from ..functions import vocab
from ..operators import recode as R
from ..operators.base import Expressions
from ..operators.encode import Factor
from ..operators.profile import class_balance
from ..session import scratch_path
from ..sources import files
from ..sources.tables import codes, obs
from .common import CRT_SQL, HARMONISED_OBS, PAIN_SQL, ABDOMEN_SQL, oracle, rounded

OBS_COLS = ["row_id", "hospital_number", "pulse", "rectal_temp", "respiratory_rate",
            "total_protein", "const_col", "pain", "capillary_refill_time", "abdomen", "outcome"]
OBS_VALUE_COLS = OBS_COLS[1:]


def _second_source(o):
    """The keyless second source: copies of every 200th row, ordered by position."""
    return o.where(F.col("row_id") % 200 == 0).withColumnRenamed("row_id", "src_pos")


def union_new_ids(spark, sf):
    o = obs(spark, sf)
    return files.append_with_new_keys(o, _second_source(o), "row_id", "src_pos")


UNION_SQL = ("u AS (SELECT * FROM obs UNION ALL "
             "SELECT (SELECT max(row_id) FROM obs) + row_number() OVER (ORDER BY row_id) AS row_id, "
             + ", ".join(OBS_VALUE_COLS) + " FROM obs WHERE row_id % 200 = 0)")
DISTINCT_SQL = ("d AS (SELECT min(row_id) AS row_id, " + ", ".join(OBS_VALUE_COLS)
                + " FROM u GROUP BY " + ", ".join(OBS_VALUE_COLS) + ")")


def q_union_sources_with_new_ids(spark, sf):
    return union_new_ids(spark, sf)


def q_distinct_rows(spark, sf):
    return R.distinct_rows(union_new_ids(spark, sf), "row_id")


def _train_rows(df):
    return df.where(F.col("hospital_number").cast("long") < 140)


def q_class_balance_flagship(spark, sf):
    """Slice 0: union -> drop null label -> distinct -> harmonise -> unseen
    fallback -> outcome codes -> class balance."""
    u = union_new_ids(spark, sf).dropna(subset=["outcome"])
    d = R.distinct_rows(u, "row_id")
    h = R.harmonise(d)
    fallback = R.UnseenFallback("hospital_number").fit(_train_rows(h))
    j = fallback.transform(h)
    coded = R.encode_outcome(j, "outcome", "outcome_code")
    return class_balance(coded, "outcome", extra_keys=["outcome_code"],
                         extra_aggs=[F.count_distinct("hospital_number").alias("n_hospitals")])


FALLBACK_SQL = (
    "tr AS (SELECT * FROM j0 WHERE CAST(hospital_number AS BIGINT) < 140), "
    "mode AS (SELECT hospital_number AS m FROM tr GROUP BY hospital_number "
    "ORDER BY count(*) DESC, hospital_number ASC LIMIT 1), "
    "j AS (SELECT j0.* REPLACE (CASE WHEN hospital_number IN (SELECT hospital_number FROM tr) "
    "THEN hospital_number ELSE (SELECT m FROM mode) END AS hospital_number) FROM j0)")

SQL_FLAGSHIP = oracle(
    "SELECT outcome, CASE outcome WHEN 'died' THEN 2 WHEN 'euthanized' THEN 1 WHEN 'lived' THEN 0 END "
    "AS outcome_code, count(*) AS n, round(count(*) / (SELECT count(*) FROM j), 6) AS share, "
    "count(DISTINCT hospital_number) AS n_hospitals FROM j GROUP BY outcome",
    UNION_SQL + ", " + "d0 AS (SELECT * FROM u WHERE outcome IS NOT NULL), "
    + DISTINCT_SQL.replace("FROM u", "FROM d0") + ", "
    "j0 AS (SELECT row_id, hospital_number, " + PAIN_SQL + " AS pain, " + CRT_SQL
    + " AS capillary_refill_time, " + ABDOMEN_SQL + " AS abdomen, outcome FROM d), " + FALLBACK_SQL)


def q_harmonise_levels(spark, sf):
    return R.harmonise(obs(spark, sf)).select("row_id", "pain", "capillary_refill_time", "abdomen")


SQL_HARMONISE = oracle("SELECT row_id, pain, capillary_refill_time, abdomen FROM harm",
                       HARMONISED_OBS)


def q_encode_levels(spark, sf):
    h = R.harmonise(obs(spark, sf))
    return R.encode_levels(h, vocab.LEVEL_CODES, suffix="_code").select(
        "row_id", "pain_code", "capillary_refill_time_code", "abdomen_code")


SQL_ENCODE = oracle(
    "SELECT row_id, CASE pain WHEN 'alert' THEN 0 WHEN 'depressed' THEN 1 WHEN 'moderate' THEN 2 "
    "WHEN 'mild_pain' THEN 3 WHEN 'severe_pain' THEN 4 WHEN 'extreme_pain' THEN 5 END AS pain_code, "
    "CASE capillary_refill_time WHEN 'less_3_sec' THEN 0 WHEN 'more_3_sec' THEN 1 END "
    "AS capillary_refill_time_code, "
    "CASE abdomen WHEN 'normal' THEN 0 WHEN 'other' THEN 1 WHEN 'firm' THEN 2 "
    "WHEN 'distend_small' THEN 3 WHEN 'distend_large' THEN 4 END AS abdomen_code FROM harm",
    HARMONISED_OBS)


def q_outcome_codes(spark, sf):
    o = obs(spark, sf).select("row_id", "outcome")
    coded = R.encode_outcome(o, "outcome", "outcome_code")
    return R.decode_outcome(coded, "outcome_code", "outcome_back")


SQL_OUTCOME = oracle(
    "SELECT row_id, outcome, CASE outcome WHEN 'died' THEN 2 WHEN 'euthanized' THEN 1 "
    "WHEN 'lived' THEN 0 END AS outcome_code, outcome AS outcome_back FROM obs")


def q_mask_overwrite(spark, sf):
    o = obs(spark, sf)
    o = R.overwrite_where(o, "respiratory_rate", F.col("respiratory_rate") > 60, 60.0)
    o = R.overwrite_where(o, "capillary_refill_time", "capillary_refill_time = '3'", "less_3_sec")
    return o.select("row_id", "respiratory_rate", "capillary_refill_time")


SQL_MASK = oracle(
    "SELECT row_id, CASE WHEN respiratory_rate > 60 THEN 60.0 ELSE respiratory_rate END "
    "AS respiratory_rate, CASE WHEN capillary_refill_time = '3' THEN 'less_3_sec' "
    "ELSE capillary_refill_time END AS capillary_refill_time FROM obs")


def q_cast_columns(spark, sf):
    o = obs(spark, sf)
    return o.select("row_id",
                    F.col("hospital_number").try_cast("long").alias("hospital_number_long"),
                    F.col("respiratory_rate").cast("int").alias("respiratory_rate_int"),
                    F.col("row_id").cast("string").alias("row_key"),
                    F.col("pain").try_cast("int").alias("pain_as_int"))


SQL_CAST = oracle(
    "SELECT row_id, TRY_CAST(hospital_number AS BIGINT) AS hospital_number_long, "
    "CAST(respiratory_rate AS INTEGER) AS respiratory_rate_int, "
    "CAST(row_id AS VARCHAR) AS row_key, TRY_CAST(pain AS INTEGER) AS pain_as_int FROM obs")


def roles_of(df, label="outcome", key="row_id", drop=("const_col",)):
    """Roles from the schema (string -> categorical, numeric -> numeric)."""
    cat = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"
           and f.name not in (label, key) and f.name not in drop]
    num = [f.name for f in df.schema.fields if f.dataType.simpleString() in
           ("double", "float", "int", "bigint", "smallint") and f.name not in (label, key)
           and f.name not in drop]
    return cat, num


def q_role_columns(spark, sf):
    o = obs(spark, sf).drop("const_col")  # P1
    cat, num = roles_of(o)
    return o.select("row_id",
                    sum(F.col(c).isNull().cast("int") for c in num).alias("numeric_nulls"),
                    sum(F.col(c).isNull().cast("int") for c in cat).alias("categorical_nulls"),
                    F.lit(len(num)).alias("n_numeric"), F.lit(len(cat)).alias("n_categorical"))


SQL_ROLES = oracle(
    "SELECT row_id, CAST((pulse IS NULL)::INT + (rectal_temp IS NULL)::INT + "
    "(respiratory_rate IS NULL)::INT + (total_protein IS NULL)::INT AS INTEGER) AS numeric_nulls, "
    "CAST((hospital_number IS NULL)::INT + (pain IS NULL)::INT + "
    "(capillary_refill_time IS NULL)::INT + (abdomen IS NULL)::INT AS INTEGER) AS categorical_nulls, "
    "4 AS n_numeric, 4 AS n_categorical FROM obs")


def q_factor_levels(spark, sf):
    h = R.harmonise(obs(spark, sf))
    f = Factor(["pain", "outcome"], order={"outcome": vocab.OUTCOME_LEVELS}).fit(h)
    return f.transform(h).select("row_id", "pain", "pain_index", "outcome", "outcome_index")


SQL_FACTOR = oracle(
    "SELECT row_id, h.pain, lv.pain_index, outcome, CASE outcome WHEN 'died' THEN 0 "
    "WHEN 'euthanized' THEN 1 WHEN 'lived' THEN 2 END AS outcome_index "
    "FROM harm h LEFT JOIN lv ON h.pain = lv.pain",
    HARMONISED_OBS + ", lv AS (SELECT pain, CAST(row_number() OVER (ORDER BY pain) - 1 AS INTEGER) "
    "AS pain_index FROM (SELECT DISTINCT pain FROM harm WHERE pain IS NOT NULL))")


def q_outcome_last(spark, sf):
    return R.move_last(obs(spark, sf), "outcome")


SQL_OUTCOME_LAST = oracle("SELECT * EXCLUDE (outcome), outcome FROM obs")


def q_joined_features(spark, sf):
    o = obs(spark, sf)
    a = o.select("row_id", F.round(F.log1p("pulse"), 6).alias("pulse_log"))
    b = R.encode_levels(R.harmonise(o).select("row_id", "pain"), {"pain": vocab.LEVEL_CODES["pain"]},
                        suffix="_code").select("row_id", "pain_code")
    return a.join(b, "row_id")  # by key, never by position


SQL_JOINED = oracle(
    "SELECT a.row_id, round(ln(1 + a.pulse), 6) AS pulse_log, "
    "CASE b.pain WHEN 'alert' THEN 0 WHEN 'depressed' THEN 1 WHEN 'moderate' THEN 2 "
    "WHEN 'mild_pain' THEN 3 WHEN 'severe_pain' THEN 4 WHEN 'extreme_pain' THEN 5 END AS pain_code "
    "FROM obs a JOIN harm b ON a.row_id = b.row_id", HARMONISED_OBS)


def q_renamed_keyed(spark, sf):
    o = obs(spark, sf).select("row_id", "pulse", "rectal_temp")
    return R.rename_by_position(o, ["key", "pulse_bpm", "temp_c"])


SQL_RENAMED = oracle("SELECT row_id AS key, pulse AS pulse_bpm, rectal_temp AS temp_c FROM obs")


def q_unseen_level_fallback(spark, sf):
    o = obs(spark, sf)
    fitted = R.UnseenFallback("hospital_number").fit(_train_rows(o))
    return fitted.transform(o).select("row_id", "hospital_number")


SQL_UNSEEN = oracle("SELECT row_id, hospital_number FROM j",
                    "j0 AS (SELECT * FROM obs), " + FALLBACK_SQL)


def q_csv_round_trip(spark, sf):
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    o = obs(spark, sf)
    path = scratch_path(spark, "csv-round-trip")
    files.write_csv(o, path)
    schema = StructType([StructField(f.name, f.dataType if f.dataType in (DoubleType(), LongType())
                                     else StringType()) for f in o.schema.fields])
    return files.read_csv(spark, path, schema)


SQL_CSV = oracle("SELECT * FROM obs")


def q_lesion_count(spark, sf):
    return codes(spark, sf).select("row_id", L.lesion_count().alias("num_lesions"))


SQL_LESION_COUNT = oracle(
    "SELECT row_id, CAST((coalesce(lesion_1, 0) > 0)::INT + (coalesce(lesion_2, 0) > 0)::INT + "
    "(coalesce(lesion_3, 0) > 0)::INT AS INTEGER) AS num_lesions FROM codes")


def q_lesion_max_site(spark, sf):
    return codes(spark, sf).select("row_id", *L.expand(L.lesion_max_site()))


def _lesion_step_sql(prev: str, code: str, out: str) -> str:
    """One step of the max-site decode as DuckDB SQL (oracle side)."""
    t = f"CAST({code} AS VARCHAR)"
    d = lambda i: f"TRY_CAST(substr({t}, {i}, 1) AS INTEGER)"
    pad = f"(CASE WHEN length({t}) < 4 THEN rpad({t}, 4, '0') ELSE {t} END)"
    p = lambda i: f"TRY_CAST(substr({pad}, {i}, 1) AS INTEGER)"
    c11 = f"{code} IS NOT NULL AND length({t}) = 5 AND substr({t}, 1, 2) = '11'"
    c5 = f"{code} IS NOT NULL AND length({t}) = 5 AND {prev}.site < {d(1)}"
    cs = f"{code} IS NOT NULL AND length({t}) <> 5 AND {prev}.site < {d(1)}"

    def pick(v11, v5, vs, keep):
        return (f"CASE WHEN {c11} THEN {v11} WHEN {c5} THEN {v5} WHEN {cs} THEN {vs} "
                f"ELSE {keep} END")
    return (f"{out} AS (SELECT row_id, lesion_1, lesion_2, lesion_3, "
            f"{pick('11', d(1), p(1), prev + '.site')} AS site, "
            f"{pick(d(3), d(2), p(2), prev + '.type')} AS type, "
            f"{pick(d(4), d(3), p(3), prev + '.subtype')} AS subtype, "
            f"{pick(d(5), f'TRY_CAST(substr({t}, 4, 2) AS INTEGER)', p(4), prev + '.code')} AS code "
            f"FROM {prev})")


LESION_CTES = ("s0 AS (SELECT row_id, lesion_1, lesion_2, lesion_3, -1 AS site, -1 AS type, "
               "-1 AS subtype, -1 AS code FROM codes), "
               + _lesion_step_sql("s0", "lesion_1", "s1") + ", "
               + _lesion_step_sql("s1", "lesion_2", "s2") + ", "
               + _lesion_step_sql("s2", "lesion_3", "s3"))

SQL_LESION_MAX = oracle("SELECT row_id, site AS lesion_site, type AS lesion_type, "
                        "subtype AS lesion_subtype, code AS lesion_code FROM s3", LESION_CTES)


def q_lesion_first(spark, sf):
    return codes(spark, sf).select("row_id", *L.expand(L.lesion_first("lesion_1")))


SQL_LESION_FIRST = oracle(
    "SELECT row_id, "
    "CAST(CASE WHEN x >= 11000 AND x < 12000 THEN 11 ELSE (y // 1000) % 10 END AS INTEGER) AS lesion_site, "
    "CAST(CASE WHEN x >= 11000 AND x < 12000 THEN (x // 100) % 10 ELSE (y // 100) % 10 END AS INTEGER) "
    "AS lesion_type, "
    "CAST(CASE WHEN x >= 11000 AND x < 12000 THEN (x // 10) % 10 ELSE (y // 10) % 10 END AS INTEGER) "
    "AS lesion_subtype, "
    "CAST(CASE WHEN x >= 11000 AND x < 12000 THEN x % 10 WHEN x >= 10000 THEN 10 ELSE y % 10 END "
    "AS INTEGER) AS lesion_code FROM ("
    "SELECT row_id, x, CASE WHEN x >= 10000 THEN x // 10 WHEN x >= 1000 THEN x WHEN x >= 100 THEN x * 10 "
    "WHEN x >= 10 THEN x * 100 WHEN x >= 1 THEN x * 1000 ELSE 0 END AS y FROM "
    "(SELECT row_id, coalesce(lesion_1, 0) AS x FROM codes))")


def q_lesion_labels(spark, sf):
    decoded = L.lesion_max_site()
    return codes(spark, sf).select("row_id", *L.expand(
        L.lesion_labels(decoded), ["site_label", "type_label", "subtype_label", "code_label"]))


SQL_LESION_LABELS = oracle(
    "SELECT row_id, "
    "CASE site WHEN 11 THEN 'all intestinal sites' WHEN 1 THEN 'gastric' WHEN 2 THEN 'sm intestine' "
    "WHEN 3 THEN 'lg colon' WHEN 4 THEN 'lg colon and cecum' WHEN 5 THEN 'cecum' "
    "WHEN 6 THEN 'transverse colon' WHEN 7 THEN 'retum/descending colon' WHEN 8 THEN 'uterus' "
    "WHEN 9 THEN 'bladder' WHEN 0 THEN 'none' ELSE 'n/a' END AS site_label, "
    "CASE WHEN type = 1 THEN 'simple' WHEN type = 2 THEN 'strangulation' WHEN type = 3 THEN 'inflammation' "
    "WHEN type BETWEEN 0 AND 9 THEN 'other' ELSE 'n/a' END AS type_label, "
    "CASE subtype WHEN 1 THEN 'mechanical' WHEN 2 THEN 'paralytic' ELSE 'n/a' END AS subtype_label, "
    "CASE code WHEN 10 THEN 'displacement' WHEN 1 THEN 'obturation' WHEN 2 THEN 'intrinsic' "
    "WHEN 3 THEN 'extrinsic' WHEN 4 THEN 'adynamic' WHEN 5 THEN 'volvulus/torsion' "
    "WHEN 6 THEN 'intussuption' WHEN 7 THEN 'thromboembolic' WHEN 8 THEN 'hernia' "
    "WHEN 9 THEN 'lipoma/slenic incarceration' ELSE 'n/a' END AS code_label FROM s3", LESION_CTES)


def q_string_scalars(spark, sf):
    c = codes(spark, sf)
    t = F.col("lesion_1").cast("string")
    return c.select(
        "row_id", t.alias("code_text"), F.length(t).alias("code_len"),
        F.substring(t, 1, 2).alias("prefix2"),
        F.when(F.length(t) < 4, F.rpad(t, 4, "0")).otherwise(t).alias("padded"),
        F.substring(t, 4, 2).try_cast("int").alias("tail_int"),
        F.regexp_replace(t, "0+$", "").alias("trimmed_zeros"))


SQL_STRINGS = oracle(
    "SELECT row_id, t AS code_text, CAST(length(t) AS INTEGER) AS code_len, substr(t, 1, 2) AS prefix2, "
    "CASE WHEN length(t) < 4 THEN rpad(t, 4, '0') ELSE t END AS padded, "
    "TRY_CAST(substr(t, 4, 2) AS INTEGER) AS tail_int, "
    "regexp_replace(t, '0+$', '', 'g') AS trimmed_zeros "
    "FROM (SELECT row_id, CAST(lesion_1 AS VARCHAR) AS t FROM codes)")


def q_math_scalars(spark, sf):
    c = codes(spark, sf)
    return c.select(
        "row_id", F.expr("lesion_1 div 1000").alias("thousands"),
        (F.col("lesion_1") % 1000).alias("remainder"),
        F.pow(F.lit(10.0), F.length(F.col("lesion_1").cast("string")) - 1).alias("magnitude"),
        F.abs(F.col("lesion_1") - F.col("lesion_2")).alias("abs_diff"),
        F.round(F.log1p("lesion_1"), 6).alias("log1p_code"))


SQL_MATH = oracle(
    "SELECT row_id, lesion_1 // 1000 AS thousands, lesion_1 % 1000 AS remainder, "
    "pow(10.0, length(CAST(lesion_1 AS VARCHAR)) - 1) AS magnitude, "
    "abs(lesion_1 - lesion_2) AS abs_diff, round(ln(1 + lesion_1), 6) AS log1p_code FROM codes")


def q_function_step(spark, sf):
    o = obs(spark, sf)
    step = Expressions({"pulse_log": "round(ln(1 + pulse), 6)",
                        "temp_k": "round(rectal_temp + 273.15, 6)"}).fit(o)
    out = step.transform(o)
    sqlt = SQLTransformer(statement="SELECT row_id, pulse_log, temp_k, "
                                    "round(total_protein / 10.0, 6) AS protein_dg FROM __THIS__")
    return sqlt.transform(out)


SQL_FUNCTION = oracle(
    "SELECT row_id, round(ln(1 + pulse), 6) AS pulse_log, round(rectal_temp + 273.15, 6) AS temp_k, "
    "round(total_protein / 10.0, 6) AS protein_dg FROM obs")


def q_top_levels(spark, sf):
    from ..operators.profile import level_counts
    from pyspark.sql import Window
    h = R.harmonise(obs(spark, sf))
    counts = level_counts(h, ["hospital_number", "pain", "capillary_refill_time", "abdomen"]) \
        .where(F.col("level").isNotNull())
    w = Window.partitionBy("variable").orderBy(F.col("n").desc(), F.col("level").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 3)


SQL_TOP = oracle(
    "SELECT variable, level, n, rank FROM (SELECT variable, level, n, "
    "CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, level ASC) AS INTEGER) AS rank "
    "FROM (SELECT variable, level, count(*) AS n FROM ("
    "SELECT 'hospital_number' AS variable, hospital_number AS level FROM harm UNION ALL "
    "SELECT 'pain', pain FROM harm UNION ALL "
    "SELECT 'capillary_refill_time', capillary_refill_time FROM harm UNION ALL "
    "SELECT 'abdomen', abdomen FROM harm) WHERE level IS NOT NULL GROUP BY variable, level)) "
    "WHERE rank <= 3", HARMONISED_OBS)


def q_partitioned_rows(spark, sf):
    """Explicit hash partitioning by key before a per-key aggregate
    (the aggregate then reuses the partitioning: no second exchange)."""
    o = files.set_partitions(obs(spark, sf), 16, "hospital_number")
    return o.groupBy("hospital_number").agg(F.count(F.lit(1)).alias("n"),
                                            F.round(F.avg("total_protein"), 6).alias("mean_protein"))


SQL_PARTITIONED = oracle("SELECT hospital_number, count(*) AS n, round(avg(total_protein), 6) "
                         "AS mean_protein FROM obs GROUP BY hospital_number")


def q_preview_rows(spark, sf):
    """O1-O3: the first rows by key (a top-k report; planned as a
    per-partition top-k, not a global sort)."""
    return obs(spark, sf).orderBy("row_id").limit(10)


SQL_PREVIEW = oracle("SELECT * FROM obs ORDER BY row_id LIMIT 10")


QUERIES = {
    "partitioned_rows": (q_partitioned_rows, SQL_PARTITIONED),
    "preview_rows": (q_preview_rows, SQL_PREVIEW),
    "class_balance_flagship": (q_class_balance_flagship, SQL_FLAGSHIP),
    "harmonise_levels": (q_harmonise_levels, SQL_HARMONISE),
    "encode_levels": (q_encode_levels, SQL_ENCODE),
    "outcome_codes": (q_outcome_codes, SQL_OUTCOME),
    "mask_overwrite": (q_mask_overwrite, SQL_MASK),
    "cast_columns": (q_cast_columns, SQL_CAST),
    "role_columns": (q_role_columns, SQL_ROLES),
    "factor_levels": (q_factor_levels, SQL_FACTOR),
    "outcome_last": (q_outcome_last, SQL_OUTCOME_LAST),
    "joined_features": (q_joined_features, SQL_JOINED),
    "renamed_keyed": (q_renamed_keyed, SQL_RENAMED),
    "unseen_level_fallback": (q_unseen_level_fallback, SQL_UNSEEN),
    "csv_round_trip": (q_csv_round_trip, SQL_CSV),
    "union_sources_with_new_ids": (q_union_sources_with_new_ids, oracle("SELECT * FROM u", UNION_SQL)),
    "distinct_rows": (q_distinct_rows, oracle("SELECT * FROM d", UNION_SQL + ", " + DISTINCT_SQL)),
    "lesion_count": (q_lesion_count, SQL_LESION_COUNT),
    "lesion_max_site": (q_lesion_max_site, SQL_LESION_MAX),
    "lesion_first": (q_lesion_first, SQL_LESION_FIRST),
    "lesion_labels": (q_lesion_labels, SQL_LESION_LABELS),
    "string_scalars": (q_string_scalars, SQL_STRINGS),
    "math_scalars": (q_math_scalars, SQL_MATH),
    "function_step": (q_function_step, SQL_FUNCTION),
    "top_levels": (q_top_levels, SQL_TOP),
}
