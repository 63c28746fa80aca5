from corpus import odd_documents, prose

from faultline.llm import licenses, shared

NOTICES = {
    "apache": "Licensed under the Apache License, Version 2.0.", "mit": "released under the mit license",
    "gpl": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "lgpl": "Licensed under the GNU Lesser General Public License, version 2.1.", "bsd": "Redistribution and use in source and "
    "binary forms, with or without modification, are permitted provided that conditions are met.",
    "unknown": "All rights reserved.",
}


def test_families_unknown_and_odd_rows(spark):
    shared.prepare(spark)
    rows = [(100 + i, prose(i, 40) + "\n" + t + "\n" + prose(50 + i, 30)) for i, t in enumerate(NOTICES.values())]
    rows += [(200 + i, "\n".join(prose(200 + 5 * i + k, 25) for k in range(5))) for i in range(80)]
    rows += [(300, NOTICES["mit"]), (300, NOTICES["mit"]), (301, "the license of this work is not the license")]
    docs = odd_documents(spark, rows)
    model = licenses.Classifier(spark, docs.where("text is not null"))
    got = licenses.scan(docs, model)
    assert got.columns == ["doc_id", "line", "family", "probability", "similarity", "confirmed"]
    found = sorted((r.doc_id, r.line, r.family) for r in got.where("doc_id != 301").collect())
    assert found == sorted([(100 + i, 1, k) for i, k in enumerate(NOTICES)] + [(300, 0, "mit")] * 2)
    assert all(r.confirmed and r.similarity >= 0.6 for r in got.where("family != 'unknown'").collect())
    assert got.where("probability is null or probability < 0 or probability > 1").count() == 0
    assert licenses.scan(docs.limit(0), model).collect() == []
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_finds_the_license_lines(spark):
    """Ordinary paragraphs of the corpus stay out."""
    sf = "/root/testdata/sf0.01"
    lines = {}
    for r in shared.table(spark, sf, "documents").collect():
        for k, t in enumerate((r.text or "").split("\n")):
            for family, notice in NOTICES.items():
                if t.strip() == notice:
                    lines[(r.doc_id, k)] = family
    got = {(r.doc_id, r.line): r.family for r in licenses.query(spark, sf).collect()}
    assert {k: got.get(k) for k in lines} == lines
    assert len(set(got) - set(lines)) <= 0.5 * len(got)


def wrapped(t, width, mark=""):
    """A paragraph in lines of at most ``width`` characters, behind a comment mark."""
    lines = [""]
    for w in t.split():
        if len(lines[-1]) + len(w) >= width:
            lines.append("")
        lines[-1] += " " * bool(lines[-1]) + w
    return "\n".join(mark + x for x in lines)


# wordings and paragraphs that are no templates as they stand
OTHER = {
    "bsd": "Redistributions of source code must retain the copyright notice above, this list of conditions and the following "
           "disclaimer of warranty.",
    "gpl": "This program is distributed in the hope that it may be useful, but WITHOUT ANY WARRANTY; without even the implied "
           "warranty of MERCHANTABILITY. See the GNU General Public License for details.",
    "apache": "This project is Apache-2.0 licensed and open to all.",
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.",
    "epl": "All materials are made available under the terms of the Eclipse Public License 2.0.",
    "mit": "The software is provided as is, without warranty of any kind, express or implied, including the warranties of "
           "merchantability, fitness for a particular purpose and noninfringement.",
}


def test_wrapped_notices_other_wordings_and_left_out_templates(spark):
    shared.prepare(spark)
    clean = [(i, "\n".join(prose(5 * i + k, 25) for k in range(5))) for i in range(80)]
    rows, want = list(clean), {}
    for k, (family, v) in enumerate(licenses.TEMPLATES.items()):
        longest = max(v, key=len)
        rows.append((1000 + k, prose(k, 30) + "\n\n" + wrapped(longest, 50, " * ") + "\n\n" + prose(k + 50, 30)))
        want[1000 + k] = [(2, 1 + len(wrapped(longest, 50).split("\n")), family)]
    rows += [(2000 + k, wrapped(t, 60, "# ")) for k, t in enumerate(OTHER.values())]
    rows.append((3000, "Released under the MIT License.\nLicensed under CC BY 4.0.\n\nSPDX-License-Identifier:\nMPL-2.0"))
    want[3000] = [(0, 0, "mit"), (1, 1, "cc-by"), (3, 4, "mpl")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in licenses.spans(docs, licenses.Classifier(spark, docs)).collect():
        got.setdefault(r.doc_id, []).append((r.line, r.last_line, r.family))
    assert {i: sorted(got.get(i, [])) for i in want} == want
    others = {f: got.get(2000 + k, []) for k, f in enumerate(OTHER)}
    assert all(any(x[2] == f for x in v) for f, v in others.items()), others
    assert not any(i in got for i, _ in clean)

    # every third template left out of training: still found as a license, and rarely taken for another
    # family; most share too few words with the others to be named, and are unknown
    kept = {f: [t for i, t in enumerate(v) if i % 3 != 2] for f, v in licenses.TEMPLATES.items()}
    left = [(5000 + i, f, t) for i, (f, t) in enumerate((f, t) for f, v in licenses.TEMPLATES.items()
                                                       for j, t in enumerate(v) if j % 3 == 2)]
    out = spark.createDataFrame([(i, t) for i, _, t in left], "doc_id long, text string")
    found = {}
    for r in licenses.scan(out, licenses.Classifier(spark, docs.where("doc_id < 1000"), kept)).collect():
        found.setdefault(r.doc_id, set()).add(r.family)
    right = sum(f in found.get(i, ()) for i, f, _ in left)
    wrong = sum(bool(found.get(i, set()) - {f, "unknown"}) for i, f, _ in left)
    print("left out", len(left), "found", len(found), "right", right, "another family", wrong)
    assert len(found) >= 0.8 * len(left) and right >= 0.2 * len(left) and wrong <= 0.2 * len(left)


def test_very_long_text(spark):
    shared.prepare(spark)
    long = "\n".join([prose(3, 500)] * 600) + "\n" + NOTICES["mit"]
    docs = spark.createDataFrame([(1, long), (2, prose(1, 40)), (3, " ".join([prose(9, 500)] * 600))], "doc_id long, text string")
    got = licenses.scan(docs, licenses.Classifier(spark, docs))
    assert [(r.doc_id, r.line, r.family) for r in got.collect()] == [(1, 600, "mit")]
