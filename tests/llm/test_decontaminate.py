from collections import Counter

from corpus import SF, odd_documents, prose, words

from faultline.llm import decontaminate, shared


def brute(docs, items, least=0.8):
    """Items that some window of as many words resembles, by text."""
    out = []
    counts = []
    for i, t in items:
        w = [x for x in words(t)]
        k = min(5, len(w))
        if k:
            counts.append((i, len(w), k, Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1))))
    for d, t in docs:
        w, found = words(t), set()
        for i, m, k, own in counts:
            sh = [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]
            if not any(g in own for g in sh):
                continue
            for s in range(-m, len(w)):
                a, b = max(s, 0), min(s + m, len(w)) - k + 1
                win = Counter(sh[a:max(b, a)])
                low = sum(min(c, own[g]) for g, c in win.items())
                if low and low / (sum(win.values()) + sum(own.values()) - low) >= least:
                    found.add(i)
                    break
        out.append((d, sorted(found)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, list(r.item_ids)) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = lambda n, a: [(r[a], r.text) for r in shared.table(spark, SF, n).collect()]
    got = decontaminate.query(spark, SF)
    assert result(got) == brute(rows("documents", "doc_id"), rows("benchmark", "item_id"))


def test_edits_short_items_and_odd_rows(spark):
    shared.prepare(spark)
    item = prose(70, 50)
    w = item.split()
    items = [(1, item), (2, item.upper()), (3, "just three words"), (4, None), (5, "  "), (6, prose(71, 30)), (6, prose(72, 30))]
    rows = [(30, prose(30, 40) + " " + item + " " + prose(31, 40)), (31, "\n".join([prose(32, 9), item])),
            (32, " ".join(w[:25] + ["changed"] + w[26:])), (33, " ".join(w[:25] + ["put", "in"] + w[25:])),
            (34, " ".join(w[:20] + w[22:])), (35, " ".join(w[:30])), (36, "so just THREE words here"), (37, "just three"),
            (38, " ".join(w[4:])), (39, prose(71, 30) + " " + prose(72, 30)), (40, " ".join([*w, *w]))]
    docs = odd_documents(spark, rows)
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, th string, n int")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items)
    assert result(decontaminate.flag(docs, bench)) == want
    assert dict(want)[30] == [1, 2] and dict(want)[35] == [] and dict(want)[36] == [3]
    assert result(decontaminate.flag(docs, bench.limit(0))) == sorted(((d, []) for d, _ in want), key=str)
    assert decontaminate.flag(docs.limit(0), bench).collect() == []


def test_stage_drops_leaks_only(spark, tmp_path):
    shared.prepare(spark)
    spark.createDataFrame([(1, prose(70, 50))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_documents(spark, [(30, prose(30, 40) + " " + prose(70, 50))])
    out = decontaminate.stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(out.collect(), key=str) == sorted(docs.where("doc_id is null or doc_id != 30").collect(), key=str)


def test_main_path_runs_no_python(spark):
    plan = decontaminate.query(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_items_in_another_order(spark):
    """Halves swapped, sentences rotated, and repeats, inside other text and at its ends."""
    shared.prepare(spark)
    items = [(1, prose(80, 60)), (2, prose(81, 90)), (3, prose(82, 12) + " " + prose(82, 12) + " " + prose(83, 40))]
    one, two, three = (t.split() for _, t in items)
    swap = lambda w, *at: " ".join(" ".join(w[i:j]) for i, j in at)
    rows = [(1, f"{prose(90, 50)} {swap(one, (30, 60), (0, 30))} {prose(91, 50)}"), (2, swap(one, (30, 60), (0, 30))),
            (3, f"{prose(92, 50)} {swap(two, (60, 90), (0, 30), (30, 60))}"),
            (4, f"{swap(one, (45, 60), (30, 45), (15, 30), (0, 15))} {prose(93, 30)}"),
            (5, f"{prose(94, 20)} {swap(three, (24, 64), (0, 24))} {prose(94, 20)}"),
            (6, f"{swap(three, (24, 64), (0, 12))} {prose(95, 12)}"), (7, f"{swap(one, (30, 60))} {prose(96, 9)} {swap(one, (0, 30))}"),
            (8, " ".join([prose(82, 12)] * 9)), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(decontaminate.flag(docs, spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(rows, items)
    assert dict(got)[1] == [1] and dict(got)[2] == [1] and dict(got)[3] == [2] and dict(got)[5] == [3]
