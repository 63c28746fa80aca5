import numpy as np
from corpus import SF, empty_documents, odd_documents, prose, words

from faultline.llm import line_dedup, shared


def brute(rows, least=50):
    """Lines to delete: those in a run of enough words that occurs earlier."""
    lines = {i: [w for w in (tuple(words(x)) for x in (t or "").split("\n")) if w] for i, t in rows}
    first, runs = {}, []
    for i in sorted(lines):
        own = lines[i]
        for s in range(len(own)):
            n = 0
            for e in range(s, len(own)):
                n += len(own[e])
                if n >= least:
                    key = tuple(own[s:e + 1])
                    runs.append((i, s, e + 1, first.setdefault(key, (i, s, e + 1))))
    gone = {i: set() for i in lines}
    for i, s, e, f in runs:
        if f[0] != i or s >= f[2]:
            gone[i].update(range(s, e))
    return gone


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in shared.table(spark, SF, "documents").collect()]
    gone = brute(rows)
    got = {r.doc_id: r for r in line_dedup.query(spark, SF).collect()}
    assert {i: r.lines_removed for i, r in got.items()} == {i: len(g) for i, g in gone.items()}
    texts = dict(rows)
    assert all(got[i].text == texts[i] for i in gone if not gone[i])


def test_runs_within_and_across_documents(spark):
    a, b, c, d = (prose(s, 30) for s in range(4))
    rows = [(1, "\n".join([a, b, c])), (2, "\n".join([d, a, "", b.upper(), d])), (3, "\n".join([b, d])),
            (4, "\n".join([c, d, c, d, c, d])), (5, "\n".join(["x y z"] * 60)), (6, a), (7, a + "\n" + c),
            (8, "\n".join([a, b, c, "tail of it"])), (9, "\n".join([prose(9, 49), "end"])),
            (10, "\n".join([prose(9, 49), "end", "more"]))]
    shared.prepare(spark)
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.lines_removed for i, r in got.items()} == {i: len(g) for i, g in brute(rows).items()}
    assert got[2].text == "\n".join([d, d])  # the blank line in the run goes too
    assert got[6].text == a and got[6].lines_removed == 0  # 30 words are too few
    assert got[8].text == "tail of it" and not got[8].emptied


def test_odd_rows_and_stage(spark):
    shared.prepare(spark)
    docs = odd_documents(spark, [(20, prose(5, 60)), (21, prose(21, 20) + "\n" + prose(5, 60))])
    out = line_dedup.stage(spark, docs, None)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert (20, prose(5, 60)) not in got  # a whole repeat is nothing that is left
    assert (21, prose(21, 20)) in got
    assert got.count((5, prose(5, 60))) == 2  # rows that repeat id and text are one document
    assert (1, None) in got and (2, "") in got and (3, " \n\t ") in got and (None, None) in got
    assert out.where("doc_id = 21").first().n_chars == len(prose(21, 20))
    assert len(got) == docs.count() - 1


def test_empty_table(spark):
    assert line_dedup.dedup(empty_documents(spark)).collect() == []


def test_selected_minima_are_few_and_found_in_both_copies():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 30, 4000).astype(np.int32)
    h = rng.integers(0, 2**63, 4000).astype(np.uint64)
    h[1500:1800], sizes[1500:1800] = h[100:400], sizes[100:400]
    start, end = line_dedup.window_spans(sizes, 50)
    at = line_dedup.minima(h, start, end)
    assert all(s <= p < e and h[p] == h[s:e].min() for s, e, p in zip(start, end, at))
    chosen = set(at.tolist())
    assert len(chosen) < len(start) / 2
    inside = [(s, e, p) for s, e, p in zip(start, end, at) if 100 <= s and e <= 400]
    assert inside and all(p + 1400 in chosen for _, _, p in inside)
    ties = line_dedup.minima(np.zeros(5, np.uint64), np.array([0, 1]), np.array([3, 5]))
    assert ties.tolist() == [2, 4]


def test_very_long_texts(spark):
    """One line 100,000 times, and a text of a million words in one line."""
    shared.prepare(spark)
    long = " ".join([prose(1, 1000)] * 1000)
    rows = [(1, "\n".join(["all the same"] * 100_000)), (2, long), (3, long), (4, prose(4, 30) + "\n" + long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup(docs).collect()}
    assert got[1].lines_removed == 100_000 - 17 and not got[1].emptied  # 17 lines are the first 50 words
    assert got[2].text == long and got[3].emptied and got[4].text == prose(4, 30)
