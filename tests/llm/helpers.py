"""Small tables and plain versions that the operators are held against."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))])
SYLLABLES = "the and ing tion er on an re st nd ha ea ti es or".split()


def prose(r: random.Random, n: int) -> str:
    words = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(n)]
    lines = [" ".join(words[i : i + 14]).capitalize() + "." for i in range(0, n, 14)]
    return "\n".join(lines)


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with exact and near copies, empty, null and odd texts, a null source and a repeated row."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, prose(r, r.choice((8, 40, 120, 300))), r.choice(("en", "de")), f"s{r.randint(0, 3)}", 0))
    for i in range(n, n + 20):
        words = rows[r.randrange(10)][1].split(" ")
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = "zzz"
        rows.append((i, " ".join(words), "en", "s9", 0))
    rows += [(n + 20, "", "en", "s1", 0), (n + 21, None, None, None, None), (n + 22, " \n\t ", "en", None, 0), (n + 23, "one two three", "en", "s1", 0), (n + 24, "One  two\nthree", "en", "s1", 0), (n + 25, "word " * 3000, "en", "s2", 0), (0, rows[0][1], rows[0][2], rows[0][3], 0)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x[:4], len(x[1]) if x[1] else 0) for x in rows], DOCS)


def shingle_set(text, k=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(nodes, alike):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    order = sorted(up)
    for i, a in enumerate(order):
        for b in order[:i]:
            if alike(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def jaccard(a, b):
    return 100 * len(a & b) >= 75 * len(a | b) if a and b else False
