import corpus_pipeline
from pyspark.sql import functions as F
from riskloom.llm import quality
from tests.llm import common
from tests.llm.test_operators import check_packing

FOLDER = "/root/testdata/sf0.01"


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, FOLDER).cache()
    assert clean.columns == docs.columns
    gone = docs.join(clean, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 1").count() >= 0.6 * docs.join(labels, "doc_id").where("toxic = 1").count() and gone.where("toxic = 0").count() <= 0.03 * labels.where("toxic = 0").count()
    good = stages["quality_rules"](spark, clean, FOLDER).cache()
    kept = {r.doc_id for r in good.collect()}
    for r in clean.collect():
        view = quality.View(r.text.encode())
        assert (r.doc_id in kept) == (not any(rule.rejects(view) for rule in quality.RULES))
    rows = [(r.doc_id, r.text) for r in good.collect()]
    single = stages["simhash_near_dedup"](spark, good, FOLDER).cache()
    root, least = common.classes([common.simhash(t) for _, t in rows]), {}
    for r, (i, _) in zip(root, rows):
        least[r] = min(least.get(r, i), i)
    assert {r.doc_id for r in single.collect()} == set(least.values())
    masked = stages["secret_scan"](spark, single, FOLDER).cache()
    assert masked.columns == docs.columns and masked.count() == single.count()
    for r in masked.join(single.select("doc_id", F.col("text").alias("old")), "doc_id").collect():
        assert not common.base_spans(r.text) and r.n_chars == len(r.text) and (r.text == r.old or "[SECRET]" in r.text)
    check_packing({r.doc_id: r.text for r in masked.collect()}, stages["packing"](spark, masked, FOLDER).collect())


def test_stages_take_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(4, 1, 1), (6, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (common.odd(spark), common.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            out.collect()
            assert name == "packing" or out.columns == corpus_pipeline.COLUMNS


def test_copies_are_told_apart_by_row_not_by_id(spark):
    text = lambda k: " ".join(f"w{k}x{i * k % 97}" for i in range(60))
    rows = [(None, text(2)), (None, text(3)), (7, text(5)), (7, text(11)), (8, text(11)), (None, text(11)), (9, text(13)), (9, text(13)), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", None if n % 2 else "s", n) for n, (i, t) in enumerate(rows)], common.DDL)
    left = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, FOLDER).select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in left if r.text), key=repr) == sorted([(None, text(2)), (None, text(3)), (7, text(5)), (7, text(11)), (9, text(13))], key=repr)
    assert [r.text for r in left if not r.text] in ([None], [""])
