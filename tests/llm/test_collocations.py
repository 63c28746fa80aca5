import random
import re
from collections import Counter

import pytest
from corpus import empty_documents, lower, odd_documents

from faultline.llm import collocations as co


def brute(rows, top):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = {}, Counter()
    for lang, t in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= co.LEAST}
        rows = []
        for p, a in cand.items():
            longer = [b for q, b in cand.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])]
            if any(100 * b >= 50 * a for b in longer):
                continue
            s, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), " ".join(p), a, c[p[:k]], c[p[k:]], n[lang], s))
        out += [(lang, i + 1, *r[3:]) for i, r in enumerate(sorted(rows)[:top])]
    return sorted(out)


def text_of(rng, words, n):
    """Words with random pieces; some habitually follow each other."""
    out = []
    while len(out) < n:
        w = rng.choice(words)
        out.append(w)
        if w.endswith("a"):
            out += [w + "x", w + "y"][:rng.choice([0, 1, 2, 2])]
        if rng.random() < 0.1:
            out.append(rng.choice([".", ",", " ;", "\n", "\t", "! ?"]))
    return " ".join(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("top", [1, 7, 40, 100_000])
def test_equals_brute_force_at_every_reach(spark, top, monkeypatch):
    """Few phrases wanted (settled at once) to all of them (several rounds)."""
    monkeypatch.setattr(co, "WIDER", 2)
    rng = random.Random(11)
    vocabulary = [a + b + c for a in "bdgklm" for b in "aeéi" for c in ("", "na", "Ro")]
    rows = [(lang, text_of(rng, vocabulary[:size], 300)) for lang, size in
            (("en", 72), ("en", 30), ("fr", 20), (None, 12), ("und", 12)) for _ in range(8)]
    rows += [rows[0]] * 20 + [("de", "too few words to count"), ("fr", None), ("fr", "")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    want = brute(rows, top)
    assert rows_of(co.mine(df, top)) == want and len(want) >= min(top, 4)


def test_rounds_go_on_while_survivors_are_missing(spark, monkeypatch):
    """All best pairs are dropped by the triples around them, so the first threshold is too high."""
    rounds = []
    whole = co.thresholds
    monkeypatch.setattr(co, "thresholds", lambda pairs, reach, langs: rounds.append(reach) or whole(pairs, reach, langs))
    rows = [("en", ". ".join(f"the p{i} q{i}" for i in range(90)))] * 12 + [("en", ". ".join(f"m{i} m{i % 7}" for i in range(60)))] * 10
    assert rows_of(co.mine(spark.createDataFrame(rows, "lang string, text string"), 40)) == brute(rows, 40)
    assert len(rounds) > 1


def test_odd_rows(spark):
    for df in (odd_documents(spark, [(20, "la la la la la la la la la la la la la la")]), empty_documents(spark)):
        rows = [(r.lang, r.text) for r in df.collect()]
        assert rows_of(co.mine(df)) == brute(rows, co.TOP)


def test_long_texts_words_and_parts(spark, monkeypatch):
    """One text of many parts' size, a word of a megabyte, and parts of a few bytes."""
    rng = random.Random(3)
    rows = [("en", text_of(rng, [f"w{i}a" for i in range(200)], 50_000)), ("en", ("z" * 1_000_000 + " tail. ") * 11)]
    monkeypatch.setattr(co, "PART_BYTES", 1 << 12)
    assert rows_of(co.mine(spark.createDataFrame(rows, "lang string, text string"), 300)) == brute(rows, 300)


def test_products_beyond_64_bits(spark):
    """Counts whose products pass 64 bits keep their exact floor."""
    counts = [(9_999_999_999_999, 10_000_000_000_001, 10_000_000_000_000), (10**15 - 1, 10**15, 10**15 + 3), (10, 10, 10)]
    df = spark.createDataFrame(counts, "a long, l long, r long")
    assert [r.s for r in df.select(co.score("a", "l", "r").alias("s")).collect()] == [
        1_000_000 * a * a // (left * right) for a, left, right in counts]
