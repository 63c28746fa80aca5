from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from corpus import SF, empty_documents, groups, odd_documents, prose, shingles

from faultline.llm import jaccard_join, shared, text


def brute(rows):
    sets = {i: set(shingles(t)) for i, t in rows}
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    edges = []
    for i, s in sets.items():
        common = Counter(j for g in s for j in where[g] if j < i)
        edges += [(i, j) for j, n in common.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    parts = groups(sets, edges)
    return {i: (len(s), parts[i]) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_equals_brute_force(spark):
    docs = shared.table(spark, SF, "documents")
    assert result(jaccard_join.query(spark, SF)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_chain_of_near_copies_and_threshold(spark):
    """Every text differs from the one before by a few words: one component,
    though its ends share little; sets at exactly 0.8 link, below don't."""
    w = prose(1, 100).split()
    rows, now = [], list(w)
    for i in range(12):
        rows.append((100 + i, " ".join(now)))
        now[8 * i % 100] = f"new{i}"
    rows += [(200, "a b c d e f g h"), (201, "a b c d e f g h i"), (202, "q r s t u"), (203, "Q R  S\tT\nU"),
             (204, "q r s t"), (205, "q r s t"), (206, "")]
    rows += [(300, prose(3, 13)), (301, " ".join(prose(3, 13).split()[:12] + ["else"]))]
    shared.prepare(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard_join.link(df)) == brute(rows)


def test_odd_rows(spark):
    shared.prepare(spark)
    docs = odd_documents(spark)
    got = jaccard_join.link(docs).collect()
    assert len(got) == docs.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[4] == [(1, 4)]
    assert by[5] == [(56, 5)] * 2
    assert sorted(by[6]) == [(2, 6), (146, 6)]
    assert sorted(by[None], key=str) == [(0, None), (56, None)]


def test_stage_keeps_one_of_each_group(spark):
    shared.prepare(spark)
    near = prose(5, 60).split()
    near[30] = "changed"
    docs = odd_documents(spark, [(20, prose(5, 60)), (21, " ".join(near)), (22, prose(22, 60))])
    out = jaccard_join.stage(spark, docs, None)
    assert out.columns == docs.columns
    ids = sorted(r.doc_id for r in out.where("doc_id is not null").collect())
    # 56 shingles of which 5 differ: 51 / 61 is above 0.8
    assert ids == [1, 2, 3, 4, 5, 6, 6, 9, 10, 22]


def test_stage_keeps_unrelated_texts_under_one_id(spark):
    """Three texts without a near copy under id 7, beside one under id 8: all stay, once each."""
    shared.prepare(spark)
    texts = [prose(60 + i, 80) for i in range(4)]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[2]), (8, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard_join.stage(spark, df, None).collect()) == sorted(rows)
    # copies and near copies of them, under any id, go
    more = df.union(spark.createDataFrame([(7, texts[0]), (9, texts[1]), (7, changed(texts[3], 30)), (7, ""), (7, "")], df.schema))
    assert sorted(tuple(r) for r in jaccard_join.stage(spark, more, None).collect()) == sorted(
        [(7, texts[0]), (7, texts[1]), (7, texts[2]), (7, changed(texts[3], 30)), (7, ""), (7, "")])


def test_empty_table(spark):
    assert jaccard_join.link(empty_documents(spark)).collect() == []


def test_shingle_sets_are_distinct_and_whole():
    texts = ["", None, "one", "a b c d e a b c d e a b c d e f", prose(4, 5000)]
    got = list(text.shingle_sets(pa.array(texts, pa.string())))
    assert [len(s) for s in got] == [len(set(shingles(t))) for t in texts]
    assert all((np.diff(s.astype(object)) > 0).all() for s in got)


def changed(t, *at):
    return " ".join(f"new{i}" if i in at else w for i, w in enumerate(t.split()))


def test_rows_without_id_or_with_a_repeated_one(spark):
    """Texts without id link, alone and as steps of a chain, and clean ones all
    stay; of a repeated id the text that is no near copy stays."""
    shared.prepare(spark)
    a, b, c, d = (prose(40 + i, 100) for i in range(4))
    rows = [(1, a), (None, changed(a, 20, 21)), (2, changed(a, 20, 21, 60, 61)), (None, b), (None, b), (None, changed(b, 50)),
            (None, c), (None, prose(50, 60)), (None, None), (None, ""), (None, ""), (3, d), (7, changed(d, 40)), (7, prose(51, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.link(df).collect()), key=str)
    assert got == sorted([(1, 1), (None, 1), (2, 1), *[(None, None)] * 8, (3, 3), (7, 3), (7, 7)], key=str)
    out = [(r.doc_id, r.text) for r in jaccard_join.stage(spark, df, None).collect()]
    assert sorted(x for x in out if x[0]) == [(1, a), (3, d), (7, prose(51, 30))]
    nameless = [t for i, t in out if i is None]
    assert len(nameless) == 6 and {c, prose(50, 60)} < set(nameless) and (b in nameless) + (changed(b, 50) in nameless) == 1
    assert sorted(t or "" for t in nameless)[:3] == ["", "", ""]
