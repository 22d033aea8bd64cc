"""Slice 2: profiles, statistics, imputers, encoders, selection, normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import recode as R
from ..operators.encode import Dummy, Factor, OneHot, SparseOneHot
from ..operators.impute import MeanImputer, MedianImputer, ModeImputer
from ..operators.normalize import Log1p, LogShift, OrderedQuantile, ZScore, ordered_quantile_scores
from ..operators.profile import (correlation_long, histogram, level_counts, numeric_summary,
                                 top_levels)
from ..operators.select import constant_columns, correlation_decisions
from ..sources.tables import obs, vec
from .common import HARMONISED_OBS, oracle, rounded

NUM4 = ["pulse", "rectal_temp", "respiratory_rate", "total_protein"]
NUM5 = NUM4 + ["const_col"]
SKEWED = [c for c in vocab.SKEWED_COLUMNS if c in NUM4]  # pulse, respiratory_rate, total_protein
CATS = ["pain", "capillary_refill_time", "abdomen"]


def _union_sql(template: str, cols: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


# ---- A1 / A15
def q_level_frequency(spark, sf):
    o = obs(spark, sf)
    freq = R.frequency_table(o, "hospital_number")
    mode = R.mode_of(o, "hospital_number")
    return freq.withColumn("is_mode", F.col("hospital_number") == F.lit(mode))


SQL_LEVEL_FREQ = oracle(
    "SELECT hospital_number, n, hospital_number = (SELECT hospital_number FROM f "
    "ORDER BY n DESC, hospital_number ASC LIMIT 1) AS is_mode FROM f",
    "f AS (SELECT hospital_number, count(*) AS n FROM obs WHERE hospital_number IS NOT NULL "
    "GROUP BY hospital_number)")


# ---- A3 numeric
def q_profile_numeric(spark, sf):
    s = numeric_summary(obs(spark, sf), NUM5)
    return s.select("column", *rounded("min", "q1", "median", "mean", "q3", "max"), "nulls")


SQL_PROFILE_NUM = oracle(_union_sql(
    "SELECT '{c}' AS \"column\", round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, "
    "round(quantile_cont({c}, 0.5), 6) AS median, round(avg({c}), 6) AS mean, "
    "round(quantile_cont({c}, 0.75), 6) AS q3, round(max({c}), 6) AS max, "
    "count(*) - count({c}) AS nulls FROM obs", NUM5))


# ---- A3 categorical
def q_profile_levels(spark, sf):
    return top_levels(obs(spark, sf), ["hospital_number"] + CATS + ["outcome"], k=6)


_LONG_OBS = ("lo AS (" + _union_sql("SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS level FROM obs",
                                     ["hospital_number"] + CATS + ["outcome"]) + "), "
             "lc AS (SELECT variable, level, count(*) AS n FROM lo GROUP BY variable, level), "
             "lr AS (SELECT variable, level, n, CAST(row_number() OVER (PARTITION BY variable "
             "ORDER BY n DESC, level ASC) AS INTEGER) AS rank FROM lc WHERE level IS NOT NULL)")
SQL_PROFILE_LEVELS = oracle(
    "SELECT variable, level, n, rank FROM lr WHERE rank <= 6 UNION ALL "
    "SELECT variable, '(Other)', sum(n)::BIGINT, 7 FROM lr WHERE rank > 6 GROUP BY variable UNION ALL "
    "SELECT variable, 'NA', n, 8 FROM lc WHERE level IS NULL", _LONG_OBS)


# ---- A4
def q_bar_counts(spark, sf):
    h = R.harmonise(obs(spark, sf))
    return level_counts(h, CATS + ["outcome"])


SQL_BAR = oracle(
    "SELECT variable, level, count(*) AS n FROM (" + _union_sql(
        "SELECT '{c}' AS variable, {c} AS level FROM harm", CATS + ["outcome"])
    + ") GROUP BY variable, level", HARMONISED_OBS)


# ---- A5
def q_histogram30(spark, sf):
    return histogram(obs(spark, sf), NUM4, bins=30)


SQL_HIST = oracle(
    "SELECT variable, bin, round(lo + (bin - 1) * ((hi - lo) / 30.0), 6) AS bin_lo, "
    "round(lo + bin * ((hi - lo) / 30.0), 6) AS bin_hi, count(*) AS n FROM ("
    + _union_sql(
        "SELECT '{c}' AS variable, CAST(least(greatest(floor(({c} - lo) / (hi - lo) * 30.0) + 1, 1), 30) "
        "AS INTEGER) AS bin, lo, hi FROM obs, (SELECT min({c}) AS lo, max({c}) AS hi FROM obs) "
        "WHERE {c} IS NOT NULL", NUM4)
    + ") GROUP BY variable, bin, lo, hi")


# ---- A6-A8
def q_corr_long(spark, sf):
    h = obs(spark, sf).withColumn("outcome_num", R.map_lookup(
        "outcome", {lv: i + 1 for i, lv in enumerate(vocab.OUTCOME_LEVELS)}).cast("double"))
    return correlation_long(h, NUM4 + ["outcome_num"], complete_rows=True)


_CORR_COLS = NUM4 + ["outcome_num"]
SQL_CORR = oracle(
    "SELECT a.v AS var1, b.v AS var2, "
    "CASE WHEN a.i = b.i THEN 1.0 ELSE round(c.r, 6) END AS r, "
    "CASE WHEN a.i = b.i THEN 1.0 ELSE round(abs(c.r), 6) END AS abs_r, a.i < b.i AS upper "
    "FROM names a, names b LEFT JOIN pairs c ON c.i = least(a.i, b.i) AND c.j = greatest(a.i, b.i)",
    "cc AS (SELECT pulse, rectal_temp, respiratory_rate, total_protein, "
    "CASE outcome WHEN 'died' THEN 1.0 WHEN 'euthanized' THEN 2.0 WHEN 'lived' THEN 3.0 END AS outcome_num "
    "FROM obs WHERE pulse IS NOT NULL AND rectal_temp IS NOT NULL AND respiratory_rate IS NOT NULL "
    "AND total_protein IS NOT NULL AND outcome IS NOT NULL), "
    "names AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(_CORR_COLS))
    + ") t(i, v)), pairs AS (" + " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, corr({a}, {b}) AS r FROM cc"
        for i, a in enumerate(_CORR_COLS) for j, b in enumerate(_CORR_COLS) if i < j) + ")")


# ---- A9, I3-I7
def q_impute_mean(spark, sf):
    o = obs(spark, sf)
    out = MeanImputer(NUM4).fit(o).transform(o)
    return out.select("row_id", *rounded(*NUM4))


SQL_IMPUTE_MEAN = oracle("SELECT row_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM obs)), 6) AS {c}" for c in NUM4) + " FROM obs")


def q_impute_median(spark, sf):
    h = R.encode_levels(R.harmonise(obs(spark, sf)),
                        {c: vocab.LEVEL_CODES[c] for c in ["pain", "capillary_refill_time"]},
                        suffix="_code")
    cols = NUM4 + ["pain_code", "capillary_refill_time_code"]
    h = h.withColumns({c: F.col(c).cast("double") for c in ["pain_code", "capillary_refill_time_code"]})
    out = MedianImputer(cols).fit(h).transform(h)
    return out.select("row_id", *rounded(*cols))


_CODES_CTE = (HARMONISED_OBS + ", hc AS (SELECT *, CAST(CASE pain WHEN 'alert' THEN 0 WHEN 'depressed' THEN 1 "
              "WHEN 'moderate' THEN 2 WHEN 'mild_pain' THEN 3 WHEN 'severe_pain' THEN 4 "
              "WHEN 'extreme_pain' THEN 5 END AS DOUBLE) AS pain_code, "
              "CAST(CASE capillary_refill_time WHEN 'less_3_sec' THEN 0 WHEN 'more_3_sec' THEN 1 END "
              "AS DOUBLE) AS capillary_refill_time_code FROM harm)")
SQL_IMPUTE_MEDIAN = oracle("SELECT row_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM hc)), 6) AS {c}"
    for c in NUM4 + ["pain_code", "capillary_refill_time_code"]) + " FROM hc", _CODES_CTE)


def q_impute_mean_codes(spark, sf):
    """Mean imputation of category codes (fractional codes result)."""
    h = R.encode_levels(R.harmonise(obs(spark, sf)),
                        {c: vocab.LEVEL_CODES[c] for c in ["pain", "capillary_refill_time"]},
                        suffix="_code")
    cols = ["pain_code", "capillary_refill_time_code"]
    h = h.withColumns({c: F.col(c).cast("double") for c in cols})
    return MeanImputer(cols).fit(h).transform(h).select("row_id", *rounded(*cols))


SQL_IMPUTE_MEAN_CODES = oracle("SELECT row_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM hc)), 6) AS {c}"
    for c in ["pain_code", "capillary_refill_time_code"]) + " FROM hc", _CODES_CTE)


def q_impute_mode(spark, sf):
    h = R.harmonise(obs(spark, sf))
    out = ModeImputer(CATS).fit(h).transform(h)
    return out.select("row_id", *CATS)


SQL_IMPUTE_MODE = oracle("SELECT row_id, " + ", ".join(
    f"coalesce({c}, (SELECT {c} FROM harm WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)) AS {c}" for c in CATS) + " FROM harm",
    HARMONISED_OBS)

# levels after harmonisation and mode imputation on the obs frame (oracle side)
_LEVELS = {"pain": ["alert", "mild_pain", "moderate", "severe_pain"],
           "capillary_refill_time": ["less_3_sec", "more_3_sec"],
           "abdomen": ["click", "error", "purchase", "signup", "view"]}
_FILLED = ("filled AS (SELECT row_id, " + ", ".join(
    f"coalesce({c}, (SELECT {c} FROM harm WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)) AS {c}" for c in CATS) + " FROM harm)")


def _indicator_query(spark, sf, step_cls):
    h = R.harmonise(obs(spark, sf))
    filled = ModeImputer(CATS).fit(h).transform(h).select("row_id", *CATS)
    return step_cls(CATS).fit(filled).transform(filled)


def q_one_hot(spark, sf):
    return _indicator_query(spark, sf, OneHot)


def q_dummy(spark, sf):
    return _indicator_query(spark, sf, Dummy)


def _indicator_sql(drop_first: bool) -> str:
    cols = []
    for c, lv in _LEVELS.items():
        for level in (lv[1:] if drop_first else lv):
            cols.append(f"CAST(coalesce({c} = '{level}', false) AS INTEGER) AS {c}_{level}")
    return oracle("SELECT row_id, " + ", ".join(cols) + " FROM filled",
                  HARMONISED_OBS + ", " + _FILLED)


# ---- X1, X2
def q_drop_constant(spark, sf):
    o = obs(spark, sf)
    rows = constant_columns(o, NUM5)
    return spark.createDataFrame([(c, bool(k), not k) for c, k in rows],
                                 "column string, is_constant boolean, keep boolean")


SQL_DROP_CONST = oracle(_union_sql(
    "SELECT '{c}' AS \"column\", (min({c}) IS NULL OR min({c}) = max({c})) AS is_constant, "
    "NOT (min({c}) IS NULL OR min({c}) = max({c})) AS keep FROM obs", NUM5))


def q_drop_correlated(spark, sf):
    return correlation_decisions(obs(spark, sf), NUM4, threshold=0.75)


def _drop_corr_sql():
    parts = []
    for j, c in enumerate(NUM4):
        if j == 0:
            parts.append(f"SELECT '{c}' AS \"column\", CAST(NULL AS DOUBLE) AS max_abs_r_earlier, "
                         "true AS keep")
            continue
        m = "greatest(" + ", ".join(f"abs(corr({a}, {c}))" for a in NUM4[:j]) + ")" if j > 1 \
            else f"abs(corr({NUM4[0]}, {c}))"
        parts.append(f"SELECT '{c}', round({m}, 6), NOT ({m} > 0.75) FROM obs")
    return oracle(" UNION ALL ".join(parts))


def q_drop_correlated_greedy(spark, sf):
    """X2, greedy keep-first rule: each column not yet dropped drops every
    later column correlated with it above the threshold."""
    from ..operators.select import correlated_to_drop, correlation_matrix
    o = obs(spark, sf)
    dropped = correlated_to_drop(NUM4, correlation_matrix(o, NUM4), 0.8, rule="greedy")
    return spark.createDataFrame([(c, c not in dropped) for c in NUM4], "column string, keep boolean")


def _greedy_sql(threshold=0.8):
    a, b, c, d = NUM4

    def hi(x, y):
        return f"(abs(corr({x}, {y})) > {threshold})"
    keep_b = f"NOT {hi(a, b)}"
    keep_c = f"NOT ({hi(a, c)} OR (({keep_b}) AND {hi(b, c)}))"
    keep_d = (f"NOT ({hi(a, d)} OR (({keep_b}) AND {hi(b, d)}) OR "
              f"(({keep_c}) AND {hi(c, d)}))")
    return oracle(f"SELECT '{a}' AS \"column\", true AS keep UNION ALL " + " UNION ALL ".join(
        f"SELECT '{col}', {cond} FROM obs" for col, cond in [(b, keep_b), (c, keep_c), (d, keep_d)]))


# ---- N1, N2, N4, N3
def q_log_shift(spark, sf):
    o = obs(spark, sf)
    return LogShift(SKEWED).fit(o).transform(o).select("row_id", *rounded(*SKEWED))


SQL_LOG_SHIFT = oracle("SELECT row_id, " + ", ".join(
    f"round(ln({c} + (SELECT abs(min({c})) + 1 FROM obs)), 6) AS {c}" for c in SKEWED) + " FROM obs")


def q_log1p(spark, sf):
    o = obs(spark, sf)
    return Log1p(SKEWED).fit(o).transform(o).select("row_id", *rounded(*SKEWED))


SQL_LOG1P = oracle("SELECT row_id, " + ", ".join(
    f"round(CASE WHEN {c} > -1 THEN ln(1 + {c}) END, 6) AS {c}" for c in SKEWED) + " FROM obs")


def q_zscore(spark, sf):
    o = obs(spark, sf)
    return ZScore(NUM5).fit(o).transform(o).select("row_id", *rounded(*NUM5))


SQL_ZSCORE = oracle("SELECT row_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM obs)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "
    f"ELSE stddev_pop({c}) END FROM obs), 6) AS {c}" for c in NUM5) + " FROM obs")


def q_ordered_quantile(spark, sf):
    o = obs(spark, sf).select("row_id", "pulse", "rectal_temp")
    o = ordered_quantile_scores(o, "pulse", "pulse_orq")
    o = ordered_quantile_scores(o, "rectal_temp", "rectal_temp_orq")
    return o.select("row_id", *rounded("pulse_orq", "rectal_temp_orq"))


def _orq_sql():
    from ..functions.columns import probit_sql
    ctes = []
    sel = []
    for c in ["pulse", "rectal_temp"]:
        ctes.append(f"r_{c} AS (SELECT row_id, (rank() OVER (ORDER BY {c}) + "
                    f"count(*) OVER (PARTITION BY {c}) - 1 + rank() OVER (ORDER BY {c})) / 2.0 AS rk, "
                    f"count(*) OVER () AS n FROM obs WHERE {c} IS NOT NULL)")
        ctes.append(f"z_{c} AS (SELECT row_id, {probit_sql('((rk - 0.5) / n)')} AS z FROM r_{c})")
        sel.append(f"round(z_{c}.z, 6) AS {c}_orq")
    return oracle("SELECT obs.row_id, " + ", ".join(sel) + " FROM obs "
                  "LEFT JOIN z_pulse ON obs.row_id = z_pulse.row_id "
                  "LEFT JOIN z_rectal_temp ON obs.row_id = z_rectal_temp.row_id", ", ".join(ctes))


# ---- X2 beyond the plain-aggregate width, with nulls: pairwise-complete like every width
WIDE_COLS = [f"w{i}" for i in range(32)]


def _wide_select(get_null) -> str:
    cols = [f"CASE WHEN row_id * {i + 3} % {7 + i % 5} = 0 THEN NULL ELSE "
            + (f"x0 * 0.9e0 + x{i} * 0.1e0" if i in (9, 20, 31) else f"x{i}") + f" END AS w{i}" for i in range(32)]
    return "SELECT row_id, " + ", ".join(cols) + " FROM " + get_null


def q_drop_correlated_wide(spark, sf):
    wide = spark.sql(_wide_select("{vec}"), vec=vec(spark, sf))
    return correlation_decisions(wide, WIDE_COLS, threshold=0.75)


def _drop_wide_sql():
    parts = [f"SELECT '{WIDE_COLS[0]}' AS \"column\", CAST(NULL AS DOUBLE) AS max_abs_r_earlier, true AS keep"]
    for j in range(1, 32):
        m = "greatest(" + ", ".join(f"abs(corr(w{i}, w{j}))" for i in range(j)) + ")"
        parts.append(f"SELECT 'w{j}', round({m}, 6), NOT coalesce({m} > 0.75, false) FROM wide")
    return oracle(" UNION ALL ".join(parts), "wide AS (" + _wide_select("vec") + ")")


# ---- P9, E1 with very many levels: none is cut off
_MANY = "SELECT row_id, CASE WHEN row_id % 11 = 0 THEN NULL ELSE concat('L', CAST(row_id * 7919 % 3001 AS STRING)) END AS level FROM "


def q_factor_many_levels(spark, sf):
    df = spark.sql(_MANY + "{obs}", obs=obs(spark, sf))
    return Factor(["level"]).fit(df).transform(df).select("row_id", "level", "level_index")


SQL_FACTOR_MANY = oracle(
    "SELECT many.row_id, many.level, CAST(c.code AS INTEGER) AS level_index FROM many LEFT JOIN "
    "(SELECT level, row_number() OVER (ORDER BY level) - 1 AS code FROM (SELECT DISTINCT level FROM many WHERE level IS NOT NULL)) c "
    "ON many.level = c.level", "many AS (" + _MANY + "obs)")


def q_one_hot_many_levels(spark, sf):
    """E1 as a sparse vector, fitted on three rows of four: slot of each row's level, -1 for none."""
    from pyspark.ml.functions import vector_to_array
    df = spark.sql(_MANY + "{obs}", obs=obs(spark, sf))
    fitted = SparseOneHot(["level"], drop_input=False).fit(df.where("row_id % 4 <> 0"))
    slots = vector_to_array("level_vec")
    return fitted.transform(df).select("row_id", (F.array_position(slots, F.lit(1.0)) - 1).cast("int").alias("slot"),
                                       F.size(slots).alias("width"))


SQL_ONE_HOT_MANY = oracle(
    "SELECT many.row_id, CAST(coalesce(c.code, -1) AS INTEGER) AS slot, CAST((SELECT count(*) FROM codes_) AS INTEGER) AS width "
    "FROM many LEFT JOIN codes_ c ON many.level = c.level",
    "many AS (" + _MANY + "obs), codes_ AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS code FROM "
    "(SELECT DISTINCT level FROM many WHERE level IS NOT NULL AND row_id % 4 <> 0))")


# ---- N3 fitted on one part and replayed on all rows
ORQ = ["pulse", "rectal_temp"]


def q_ordered_quantile_replay(spark, sf):
    o = obs(spark, sf).select("row_id", *ORQ)
    fitted = OrderedQuantile(ORQ).fit(o.where("row_id % 3 <> 0"))
    return fitted.transform(o).select("row_id", *rounded(*ORQ))


def _orq_replay_sql():
    from ..functions.columns import probit_sql
    ctes, sel, joins = [], [], ""
    for c in ORQ:
        ctes.append(f"t_{c} AS (SELECT {c} AS x, count(*) AS k FROM obs WHERE {c} IS NOT NULL AND row_id % 3 <> 0 GROUP BY {c}), "
                    f"u_{c} AS (SELECT x, (2 * sum(k) OVER (ORDER BY x) - k + 1) / 2.0 AS rk, sum(k) OVER () AS n FROM t_{c}), "
                    f"p_{c} AS (SELECT x, {probit_sql('((rk - 0.5) / n)')} AS z FROM u_{c}), "
                    f"v_{c} AS (SELECT v, (SELECT max(x) FROM p_{c} WHERE x <= v) AS lo, (SELECT min(x) FROM p_{c} WHERE x >= v) AS hi "
                    f"FROM (SELECT DISTINCT {c} AS v FROM obs WHERE {c} IS NOT NULL)), "
                    f"s_{c} AS (SELECT v, CASE WHEN lo IS NULL THEN b.z WHEN hi IS NULL OR lo = hi THEN a.z "
                    f"ELSE a.z + (b.z - a.z) * (v - lo) / (hi - lo) END AS z FROM v_{c} LEFT JOIN p_{c} a ON a.x = lo LEFT JOIN p_{c} b ON b.x = hi)")
        sel.append(f"round(s_{c}.z, 6) AS {c}")
        joins += f" LEFT JOIN s_{c} ON obs.{c} = s_{c}.v"
    return oracle("SELECT obs.row_id, " + ", ".join(sel) + " FROM obs" + joins, ", ".join(ctes))


QUERIES = {
    "drop_correlated_wide": (q_drop_correlated_wide, _drop_wide_sql()),
    "factor_many_levels": (q_factor_many_levels, SQL_FACTOR_MANY),
    "one_hot_many_levels": (q_one_hot_many_levels, SQL_ONE_HOT_MANY),
    "ordered_quantile_replay": (q_ordered_quantile_replay, _orq_replay_sql()),
    "level_frequency": (q_level_frequency, SQL_LEVEL_FREQ),
    "profile_numeric": (q_profile_numeric, SQL_PROFILE_NUM),
    "profile_levels": (q_profile_levels, SQL_PROFILE_LEVELS),
    "bar_counts": (q_bar_counts, SQL_BAR),
    "histogram30": (q_histogram30, SQL_HIST),
    "corr_long": (q_corr_long, SQL_CORR),
    "impute_mean": (q_impute_mean, SQL_IMPUTE_MEAN),
    "impute_median": (q_impute_median, SQL_IMPUTE_MEDIAN),
    "impute_mode": (q_impute_mode, SQL_IMPUTE_MODE),
    "impute_mean_codes": (q_impute_mean_codes, SQL_IMPUTE_MEAN_CODES),
    "one_hot": (q_one_hot, _indicator_sql(False)),
    "dummy": (q_dummy, _indicator_sql(True)),
    "drop_constant": (q_drop_constant, SQL_DROP_CONST),
    "drop_correlated": (q_drop_correlated, _drop_corr_sql()),
    "drop_correlated_greedy": (q_drop_correlated_greedy, _greedy_sql()),
    "log_shift": (q_log_shift, SQL_LOG_SHIFT),
    "log1p": (q_log1p, SQL_LOG1P),
    "zscore": (q_zscore, SQL_ZSCORE),
    "ordered_quantile": (q_ordered_quantile, _orq_sql()),
}
