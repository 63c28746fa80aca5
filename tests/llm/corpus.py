"""Small inputs and brute-force versions shared by the tests of the operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return WORD.findall(lower(t))


def shingles(t, k=5):
    w = words(t)
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])


def prose(seed, n):
    """n made-up words."""
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("".join("bdfglmnprst"[(x >> (4 * i)) % 11] + "aeiou"[(x >> (3 * i + 1)) % 5] for i in range(2 + x % 3)))
    return " ".join(out)


def odd_documents(spark, rows=()):
    """Nulls, empty and blank texts, repeated rows, a repeated id, and columns
    whose names operators use themselves."""
    base = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, prose(5, 60)), (5, prose(5, 60)),
            (6, prose(6, 80) + "\n" + prose(7, 70)), (6, "another text under the same id"), (None, prose(8, 60)),
            (None, None), (9, prose(9, 60).upper()), (10, "!!! 123 ### ;;;")]
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", "z", 1.0, True) for i, t in [*base, *rows]],
                                 "doc_id long, text string, lang string, source string, n_chars long, th string, "
                                 "_id string, cls string, score double, accepted boolean")


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def groups(nodes, edges):
    """The smallest node reachable from each."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
