from corpus import SF, odd_documents
from pyspark.sql import functions as F

from faultline.llm import language_id, shared

SF_001 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = language_id.query(spark, SF_001)
    truth = shared.table(spark, SF_001, "documents").select("doc_id", "lang")
    n, right, kept = got.where("held_out").join(truth, "doc_id").agg(
        F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("accepted").cast("int"))).first()
    assert n > 100 and right / n > 0.97 and kept / n > 0.98
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    assert got.count() == truth.count()


def test_counts_equal_brute_force():
    texts = ["", None, "Ab, ab! Éa", "123 ###", "x" * 300, "日本 語", "a\nb  c"]
    rows = {i + k: c for i, j, counts in language_id.term_counts(texts) for k, c in enumerate(counts)}
    for k, t in enumerate(texts):
        letters = "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
        # each word gives a pair per letter and one more, and a triple per letter
        assert rows[k].sum() == sum(2 * len(w) + 1 for w in letters)


def test_odd_rows_and_rejection(spark):
    shared.prepare(spark)
    train = shared.table(spark, SF_001, "documents")
    model = language_id.fit(train)
    docs = odd_documents(spark, [(30, "Это совсем другой язык, которого не было."), (31, "the of and to in that is"),
                                 (32, "日本語のテキスト")])
    got = {r.doc_id: r for r in language_id.classify(docs.where("doc_id is not null"), model).collect()}
    for i in (1, 2, 3, 10):
        assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
    assert not got[30].accepted and not got[32].accepted and got[30].lang_pred in model.langs
    assert got[31].accepted and got[31].lang_pred == "en"
    assert got[31].source == "s" and got[31].th == "x"


def test_stage_keeps_clean_documents_and_columns(spark):
    docs = shared.table(spark, SF_001, "documents").withColumns({"score": F.lit("own"), "accepted": F.lit(None).cast("int")})
    out = language_id.stage(spark, docs.union(docs.where("doc_id = 7").withColumn("text", F.lit("1234"))), None)
    assert out.columns == docs.columns
    assert out.where("score != 'own' or accepted is not null or text = '1234'").count() == 0
    assert out.count() >= 0.99 * docs.count()


def test_nothing_to_learn_from(spark):
    shared.prepare(spark)
    docs = odd_documents(spark)
    model = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.accepted) for r in language_id.classify(docs, model).collect()} == {("und", False)}
    assert language_id.classify(docs.limit(0), language_id.fit(docs.limit(0))).collect() == []
