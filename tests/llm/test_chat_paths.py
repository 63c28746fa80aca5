import hashlib

from corpus import SF

from faultline.llm import chat_paths, shared

NODES = "conv_id long, node long, parent long, role string, text string, score double"


def read_back(df):
    """(conv_id, path) -> (turns, loss text) parsed from the output in plain Python."""
    def plain(s, codes):
        for a, b in reversed(codes):
            s = s.replace(b, a)
        return s

    out = {}
    for r in df.collect():
        turns = []
        for t in r.formatted.split(chat_paths.END)[:-1]:
            assert t.startswith(chat_paths.HEAD)
            role, _, text = t[len(chat_paths.HEAD):].partition(chat_paths.MIDDLE)
            turns.append((plain(role, chat_paths.ROLE_CODES), plain(text, chat_paths.TEXT_CODES)))
        lost = "".join(plain(r.formatted[s.start:s.start + s.length], chat_paths.TEXT_CODES) for s in r.loss)
        out[(r.conv_id, r.path)] = (turns, lost)
    return out


def brute(rows, branches=1):
    out = {}
    nodes = {(c, n): (p, r or "", t or "", s or 0.0) for c, n, p, r, t, s in rows}
    parents = {(c, v[0]) for (c, n), v in nodes.items()}
    trees = {}
    for (c, n) in nodes:
        if (c, n) in parents:
            continue
        path, at = [], (c, n)
        while at in nodes and at not in path:
            path.append(at)
            at = (c, nodes[at][0])
        if at not in path:
            trees.setdefault(path[-1], []).append((-sum(nodes[x][3] for x in path), -len(path), n, path[::-1]))
    for leaves in trees.values():
        for _, _, n, path in sorted(leaves)[:branches]:
            turns = [nodes[x][1:3] for x in path]
            out[(path[0][0], n)] = (turns, "".join(t for r, t in turns if r == "assistant"))
    return out


def test_trees_branches_and_controls(spark):
    shared.prepare(spark)
    rows = []
    for c in (1, 2, None):
        for n in range(1, 60):
            rows.append((c, n, n // 2 or None, ["user", "assistant"][n % 2], f"{c} {n} </turn>\n### a: \\", float(n * 37 % 11)))
    rows += [(3, 1, 99, "user", "orphan", 1.0), (3, 2, 1, None, None, None), (4, 1, 2, "user", "cycle", 1.0), (4, 2, 1, "user", "x", 1.0),
             (4, 3, 2, "user", "below the cycle", 5.0), (4, 5, 5, "user", "self", 5.0), (5, 1, None, "a: b\n###", "\\e \\\\h \\l # < : é 🙂", 0.0),
             (6, 1, None, "user", "", 0.0), (6, 2, 1, "assistant", "", 0.0), (6, 3, 1, "assistant", "tie", 0.0)]
    rows += [(7, n, n - 1 if n else None, "assistant", f"t{n}", 0.0) for n in range(70)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], NODES + ", c long, path string")
    for branches in (1, 3):
        want = brute(rows, branches)
        got = read_back(chat_paths.formatted(df, branches))
        assert got == want
    assert (6, 2) in brute(rows) and (4, 3) not in want
    assert chat_paths.formatted(df.limit(0)).collect() == []


def test_repeated_rows(spark):
    shared.prepare(spark)
    rows = [(1, 1, None, "user", "b", 0.0), (1, 1, None, "user", "a", 0.0), (1, 1, None, "user", "a", 0.0), (1, 2, 1, "assistant", "c", 0.0)]
    got = read_back(chat_paths.formatted(spark.createDataFrame(rows, NODES)))
    assert got == {(1, 2): ([("user", "a"), ("assistant", "c")], "c")}


def test_query_reads_back_the_turns(spark):
    got = {r.conv_id: r for r in chat_paths.query(spark, SF).collect()}
    want = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for r in shared.table(spark, SF, "conversations").orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        lost = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert (got[c].n_turns, got[c].loss_chars) == (len(turns), len(lost))
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(lost.encode()).hexdigest()


def test_query_and_sql_agree_on_ties(spark, monkeypatch):
    """Several different texts on one turn and role, nulls and repeated rows, in many conversations."""
    import duckdb

    rows = [(c, t, ["user", "assistant", None][(c + (t or 0)) % 3], [f"z{c * k % 7}", None, f"é{k}", f"a{c}", ""][(c + k) % 5])
            for c in range(12) for t in (0, 1, 1, 2, None) for k in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(shared, "table", lambda *a: df)
    shared.prepare(spark)
    conversations = df.toArrow()  # noqa: F841
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = sorted(duckdb.sql(f"SELECT {', '.join(names)} FROM ({chat_paths.ORACLE})").fetchall())
    assert sorted(tuple(r) for r in chat_paths.query(spark, SF).select(names).collect()) == want and len(want) == 13


def test_turns_with_ties_and_nulls(spark):
    shared.prepare(spark)
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (1, None, "system", "s"), (None, 0, None, "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {k[0]: v for k, v in read_back(chat_paths.formatted(chat_paths.chains(df))).items()}
    assert got == {1: ([("system", "s"), ("user", ""), ("assistant", "x"), ("assistant", "x")], "xx"), None: ([("", "t")], "")}
    plan = chat_paths.formatted(chat_paths.chains(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
