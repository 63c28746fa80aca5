import corpus_pipeline
from corpus import empty_documents, prose
from pyspark.sql import functions as F

from faultline.llm import packing, shared

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "packing"]


def test_run_packs_what_the_stages_keep(spark):
    docs = shared.table(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared.stored(stage(spark, kept, SF), name)
        assert out.columns == docs.columns
        assert out.join(kept.select("doc_id"), "doc_id", "left_anti").count() == 0
        kept = out
    assert 0.8 * docs.count() < kept.count() < docs.count()
    assert kept.groupBy("text").count().where("count > 1 and length(text) > 500").count() == 0
    got = corpus_pipeline.run(spark, SF)
    want = packing.pieces(kept)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert got.select(columns).exceptAll(want.select(columns)).count() == 0 == want.select(columns).exceptAll(got.select(columns)).count()
    over = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert over.where("n > 1024 or n != end").count() == 0


def test_stages_take_empty_tables(spark):
    docs = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_copies_and_leaks_go(spark):
    docs = shared.table(spark, SF, "documents")
    item = shared.table(spark, SF, "benchmark").where("item_id = 0").first().text
    text = docs.where("length(text) between 1500 and 2500 and lang = 'en'").first().text
    words = text.split(" ")
    near = " ".join([*words[:40], "changed", *words[41:]])
    extra = spark.createDataFrame([(90_001, text), (90_002, near.replace("\n", " ")), (90_003, prose(1, 30) + " " + item.replace("\n", " "))],
                                  "doc_id long, text string")
    now = docs.unionByName(extra, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = shared.stored(stage(spark, now, SF), name)
    assert now.where("doc_id in (90001, 90003)").count() == 0
