"""End to end on a hand-made clinical frame (FIXTURES F0): CSV source with
NA nulls and 'None' levels -> clinical recipe fitted on the training rows ->
model -> saved state -> scoring of new ids -> (id, outcome) CSV."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from stratiform.operators.models import Classifier
from stratiform.operators.recode import decode_outcome
from stratiform.operators.score import load_trained, save_trained, score
from stratiform.plans.training import clinical_recipe, roles
from stratiform.session import scratch_path
from stratiform.sources.files import read_csv, write_csv

LEVELS = {
    "surgery": ["no", "yes"], "age": ["adult", "young"],
    "temp_of_extremities": ["cold", "cool", "normal", "warm", "None"],
    "peripheral_pulse": ["absent", "reduced", "normal", "increased", "None"],
    "mucous_membrane": ["normal_pink", "bright_pink", "pale_pink", "pale_cyanotic", "bright_red",
                        "dark_cyanotic", "None"],
    "capillary_refill_time": ["less_3_sec", "more_3_sec", "3", "None"],
    "pain": ["alert", "depressed", "moderate", "mild_pain", "severe_pain", "extreme_pain", "slight", "None"],
    "peristalsis": ["hypermotile", "normal", "hypomotile", "absent", "distend_small", "None"],
    "abdominal_distention": ["none", "slight", "moderate", "severe", "None"],
    "nasogastric_tube": ["none", "slight", "significant", "None"],
    "nasogastric_reflux": ["none", "less_1_liter", "more_1_liter", "slight", "None"],
    "rectal_exam_feces": ["absent", "decreased", "normal", "increased", "serosanguious", "None"],
    "abdomen": ["normal", "other", "firm", "distend_small", "distend_large", "None"],
    "abdomo_appearance": ["clear", "cloudy", "serosanguious", "None"],
    "surgical_lesion": ["no", "yes"], "cp_data": ["no", "yes"],
}
NUMERIC = {"rectal_temp": (35.4, 40.8), "pulse": (30, 184), "respiratory_rate": (8, 96),
           "nasogastric_reflux_ph": (1.0, 7.5), "packed_cell_volume": (23, 75),
           "total_protein": (3.3, 89), "abdomo_protein": (0.1, 10.1)}
CODES = [0, 9, 22, 400, 2124, 3111, 11124, 31110, 41110, 2209, 7111, 11300, 11400, 9000]


def _frame(n=400, seed=5):
    rng = np.random.RandomState(seed)
    outcome = rng.choice(["died", "euthanized", "lived"], size=n, p=[0.32, 0.19, 0.49])
    shift = {"died": 1.0, "euthanized": 0.5, "lived": 0.0}
    rows = []
    for i in range(n):
        r = {"id": i, "hospital_number": str(500000 + rng.randint(0, 60))}
        for c, lv in LEVELS.items():
            r[c] = None if rng.uniform() < 0.04 and c not in ("surgery", "age", "surgical_lesion", "cp_data") \
                else lv[rng.randint(len(lv))]
        for c, (lo, hi) in NUMERIC.items():
            v = lo + (hi - lo) * min(1.0, rng.beta(2, 5) + 0.3 * shift[outcome[i]])
            r[c] = None if rng.uniform() < 0.06 else round(float(v), 1)
        r["lesion_1"], r["lesion_2"], r["lesion_3"] = (int(rng.choice(CODES)), int(rng.choice([0, 0, 2209, 7111])), 0)
        r["outcome"] = outcome[i] if rng.uniform() > 0.02 else None
        rows.append(r)
    return rows


SCHEMA = StructType(
    [StructField("id", LongType()), StructField("hospital_number", StringType())]
    + [StructField(c, StringType()) for c in LEVELS]
    + [StructField(c, DoubleType()) for c in NUMERIC]
    + [StructField(c, LongType()) for c in ("lesion_1", "lesion_2", "lesion_3")]
    + [StructField("outcome", StringType())])


@pytest.fixture(scope="module")
def clinical(spark):
    df = spark.createDataFrame(_frame(), SCHEMA)
    path = scratch_path(spark, "clinical-csv")
    write_csv(df, path)
    return read_csv(spark, path, SCHEMA)


def test_csv_keeps_none_level_and_na_null(clinical):
    pain = {r["pain"] for r in clinical.select("pain").distinct().collect()}
    assert "None" in pain and None in pain


def test_recipe_model_and_scoring(spark, clinical):
    labelled = clinical.where(F.col("outcome").isNotNull())
    train = labelled.where(F.col("id") < 300).drop("cp_data")
    new = clinical.where(F.col("id") >= 300).drop("cp_data", "outcome")
    num, cat = roles(train, key="id")
    fitted = clinical_recipe(num, cat, key="id").fit(train)
    prepared = fitted.training_output
    feats = [c for c in prepared.columns if c not in ("id", "outcome")]
    # no nulls left, and the outcome is coded and last
    assert prepared.columns[-1] == "outcome"
    nulls = prepared.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in feats]).first()
    assert all(v == 0 for v in nulls)
    model = Classifier("logistic", feats, "outcome", {"regParam": 0.05}).fit(prepared)
    path = scratch_path(spark, "clinical-model")
    save_trained(path, fitted, model)
    recipe2, model2 = load_trained(spark, path)
    scored = score(new, recipe2, model2, key="id", keep_probabilities=False)
    out = decode_outcome(scored, "prediction", "outcome").select("id", "outcome")
    rows = out.collect()
    assert len(rows) == 100 and {r["id"] for r in rows} == set(range(300, 400))
    assert {r["outcome"] for r in rows} <= {"died", "euthanized", "lived"}
    sink = scratch_path(spark, "clinical-out")
    write_csv(out, sink)
    back = spark.read.option("header", True).csv(sink)
    assert back.columns == ["id", "outcome"] and back.count() == 100


def test_imputers_are_idempotent(spark, clinical):
    from stratiform.operators.impute import KNNImputer, ModeImputer
    num = list(NUMERIC)
    df = clinical.select("id", *num, "pain")
    knn = KNNImputer(num, k=5, key="id").fit(df)
    once = knn.transform(df)
    twice = knn.transform(once)
    a = sorted(tuple(r) for r in once.collect())
    b = sorted(tuple(r) for r in twice.collect())
    assert a == b
    mode = ModeImputer(["pain"]).fit(df)
    assert mode.transform(df).where(F.col("pain").isNull()).count() == 0


def test_entry_points_train_classify_explore(spark, clinical):
    from stratiform.plans.entrypoints import classify_csv, explore, train_and_save
    train = clinical.where(F.col("id") < 300)
    new = clinical.where(F.col("id") >= 300).drop("outcome")
    model_dir = scratch_path(spark, "ep-model")
    res = train_and_save(train, model_dir, key="id", folds=2,
                         candidates=[("logistic", "logistic", {"regParam": 0.05}),
                                     ("naive_bayes", "naive_bayes", {})], parallelism=2)
    assert res["best"][0] in ("logistic", "naive_bayes")
    assert 0.0 <= res["held_out"]["f1"] <= 1.0
    src = scratch_path(spark, "ep-new")
    write_csv(new, src)
    schema = StructType([f for f in SCHEMA.fields if f.name != "outcome"])
    out = classify_csv(spark, model_dir, src, schema, scratch_path(spark, "ep-out"), key="id")
    assert out.count() == 100
    prof = explore(clinical, key="id")
    assert prof["numeric_summary"].count() == len(NUMERIC) + 3  # + the three lesion code columns
    assert prof["correlations"].where("var1 = var2").count() == len(NUMERIC) + 4
