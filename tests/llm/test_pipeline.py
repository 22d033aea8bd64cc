"""The pipeline's stages, each against a plain version on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import MEDIUM, SMALL
from stratiform.llm import decontaminate, quality_rules, quality_trees
from stratiform.llm.common import stored, table
from test_operators import _check_pieces, _jaccard_brute


@pytest.fixture(scope="module")
def stages(spark):
    """Name -> (input, output) of every stage on the small tables with planted copies."""
    docs = table(spark, SMALL, "documents")
    item = table(spark, SMALL, "benchmark").orderBy("item_id").first().text
    long_item = " ".join([item] * 3)
    copies = docs.where("doc_id < 12").withColumn("doc_id", F.col("doc_id") + 900_000)
    tainted = docs.where("doc_id = 0").withColumns({"doc_id": F.lit(950_000).cast("long"), "text": F.concat(F.substring("text", 1, 400), F.lit("\n" + long_item))})
    docs = stored(docs.unionByName(copies).unionByName(tainted), "pipeline-test")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stored(stage(spark, docs, SMALL), f"test-{name}")
        out[name] = (docs, got)
        docs = got
    return out


def test_stage_names_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "jaccard_join", "decontamination", "packing"]
    columns = table(spark, SMALL, "documents").schema
    for name, (_, out) in list(stages.items())[:-1]:
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in columns], name


def test_classifier_and_rules_keep_what_they_score(spark, stages):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    before, after = stages["quality_classifier"]
    score = quality_trees.score_column(spark, quality_trees.fit(docs, labels))
    assert sorted(before.where(score("text") >= quality_trees.THRESHOLD).collect()) == sorted(after.collect())
    before, after = stages["quality_rules"]
    kept = quality_rules.judge(before, quality_rules.fit(docs, labels)).where("kept").select("doc_id")
    assert sorted(before.join(kept, "doc_id", "left_semi").select(before.columns).collect()) == sorted(after.collect())


def test_quality_stages_leave_good_documents(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    kept = corpus_pipeline.quality_rule_filter(spark, corpus_pipeline.quality_classifier(spark, docs, MEDIUM), MEDIUM)
    both = docs.join(labels, "doc_id").where("size(split(trim(text), '\\\\s+')) >= 50").select("doc_id", "quality")
    left = {x.doc_id for x in kept.select("doc_id").collect()}
    good = [x.doc_id in left for x in both.where("quality = 1").collect()]
    bad = [x.doc_id in left for x in both.where("quality = 0").collect()]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_one_of_each_group_stays(stages):
    before, after = stages["jaccard_join"]
    found = _jaccard_brute([(x.doc_id, x.text) for x in before.collect()])
    assert sorted(str(x.doc_id) for x in after.collect()) == sorted(d for d, _, c in found if d == c)
    assert not [x for x in after.collect() if 900_000 <= x.doc_id < 950_000]


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(x) for x in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    want = decontaminate.brute_force([(x.doc_id, x.text) for x in before.collect()], items)
    assert {x.doc_id for x in after.collect()} == {k for k, v in want.items() if not v[-1]}
    ids = {x.doc_id for x in before.collect()}
    assert 950_000 not in {x.doc_id for x in after.collect()} or 950_000 not in ids


def test_the_rest_is_packed_whole(stages):
    before, after = stages["packing"]
    _check_pieces(after.collect(), [(x.doc_id, x.text) for x in before.collect()])


def test_run_on_an_empty_table(spark):
    empty = table(spark, SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
