"""The prefix trie and the vector codes against plain versions and SQL."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sugarloom.llm import prefix_trie, vector_codes

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain_trie(rows):
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members: dict[tuple, list] = {}
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    children: dict[tuple, int] = {}
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k in members:
        if k:
            children[k[:-1]] = children.get(k[:-1], 0) + 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    digest = lambda k: hashlib.sha256(",".join(map(str, sorted(c for c in members[k] if len(whole[c]) == len(k)))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children.get(k, 0), leaves[k], saved[k], digest(k)) for k, m in members.items())


def conversations(seed, n=150):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        copy = r.random() < 0.3
        for t in range(r.randint(1, 9)):
            rows.append((c, t, "user" if t % 2 else "assistant", f"turn {t if copy else r.randint(0, 2)} é"))
    rows += [(100_000 + i, t, None, "same") for i in range(40) for t in range(12)]  # a hot chain
    rows += [(7, 3, "user", "tie"), (7, 3, "assistant", "tie"), (7, None, None, None), (7, None, "user", "first"), (None, 1, "user", "nobody's"), (-250, 0, "user", "below zero"), (-201, 1, "user", "x"), (300_001, 5, "user", "alone")]
    rows += [(9, 4, "user", "repeated")] * 30
    return rows


def trie_rows(df):
    return sorted(tuple(x) for x in prefix_trie.trie(df).collect())


@pytest.mark.parametrize("seed", [1])
def test_trie_is_the_plain_one(spark, seed):
    rows = conversations(seed)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("clash")).withColumn("node", F.lit(None).cast("string")).repartition(3)
    assert trie_rows(df) == plain_trie(rows)


def test_trie_of_little(spark):
    assert trie_rows(spark.createDataFrame([], TURNS)) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "a", "b")], TURNS)) == []
    for rows in ([(3, 0, None, None), (301, 0, "user", "a"), *((c, 0, "user", "a") for c in range(40, 60))],):
        assert trie_rows(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


def test_trie_over_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 5)
    monkeypatch.setattr(prefix_trie, "CHUNK", 12)
    rows = conversations(3, 60) + [(100, t, "user", f"{t}") for t in range(90)] + [(120, t, "user", f"{t}") for t in range(70)] + [(500, 1, "user", "again")] * 40
    assert trie_rows(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)


def test_contraction_of_odd_trees(spark):
    """A forest of a chain, a star, a random tree, a broom and two interleaved chains."""
    r = random.Random(6)
    shapes = [lambda i: i - 1, lambda i: 0, lambda i: r.randrange(i), lambda i: i - 1 if i < 60 else 59, lambda i: i - 2 if i > 1 else None]
    up: dict[int, int | None] = {}
    for k, shape in enumerate(shapes):
        for i in range(120):
            p = shape(i) if i else None
            up[1000 * k + i] = None if p is None else 1000 * k + p
    depth: dict[int, int] = {}
    for i, p in up.items():
        depth[i] = 0 if p is None else depth[p] + 1
    weight = {i: r.randint(-5, 9) for i in up}
    total = dict(weight)
    for i in sorted(up, reverse=True):
        if up[i] is not None:
            total[up[i]] += total[i]
    tree = spark.createDataFrame([(i, up[i], depth[i], weight[i]) for i in up], "node long, up long, depth long, w long")
    assert {x.node: x.w for x in prefix_trie.subtree_sums(tree, ["w"]).collect()} == total


def test_joined_digests_over_tasks(spark):
    rows = [(k, v) for k, n in (("a", 500), ("b", 1), ("c", 40)) for v in range(-3, n - 3)]
    got = {x.k: x.sha256 for x in prefix_trie.joined_digests(spark.createDataFrame(rows, "k string, v long").repartition(5), ["k"], "v").collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, range(-3, n - 3))).encode()).hexdigest() for k, n in (("a", 500), ("b", 1), ("c", 40))}


def agrees(spark, rows, schema, view, run, sql):
    df = spark.createDataFrame(rows, schema)
    con = duckdb.connect()
    con.register(view, df.toArrow())
    rel = con.sql(sql)
    want = [dict(zip(rel.columns, x, strict=True)) for x in rel.fetchall()]
    got = [x.asDict() for x in run(df.repartition(3)).collect()]
    order = lambda rows: sorted(repr(sorted(x.items())) for x in rows)
    assert order(got) == order(want)


def test_trie_agrees_with_its_sql(spark):
    agrees(spark, [x for x in conversations(5) if x[0] is None or x[0] >= 0], TURNS, "conversations", prefix_trie.trie, prefix_trie.OP11_SQL)


# -- vector codes ---------------------------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((i is None, i or 0, v) for i, v, _ in kept if v and len(v) % parts == 0)
    if not order:
        return []
    dim = len(order[0][2])
    kept = [x for x in kept if len(x[1]) == dim]
    first, seen = [], set()
    for none, i, v in order:
        if (none, i) not in seen and len(v) == dim:
            seen.add((none, i))
            first.append(v)
    first = first[:entries]
    w = dim // parts
    cut = lambda v: [v[p * w : p * w + w] for p in range(parts)]
    books = [[cut(v)[p] for v in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own: dict[int, list] = {}
            for _, v, _ in kept:
                own.setdefault(near(cut(v)[p], books[p])[1], []).append(cut(v)[p])
            for e, xs in own.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = []
    for i, v, lab in kept:
        found = [near(cut(v)[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    labels: dict = {}
    for _, lab, _, e in out:
        labels[lab] = labels.get(lab, 0) + e
    return [(*x, labels[x[1]], digest) for x in out]


def vectors(seed, n=140, dim=32):
    r = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in r.normal(0, 0.3, dim)], int(r.integers(0, 4)) if i % 7 else None) for i in range(n)]
    rows += [(n + i, rows[5][1], 1) for i in range(80)]  # a hot vector
    rows += [(2, rows[9][1], 3), (2, rows[3][1], 3), (2, rows[3][1], 3), (None, rows[4][1], None), (None, rows[5][1], 0)]
    rows += [(-3, None, 1), (-2, [None] * dim, 1), (-4, [math.nan] + [0.0] * (dim - 1), 1), (-5, [math.inf] + [0.0] * (dim - 1), 1), (500, [0.5] * 7, 1), (501, [], 2), (502, [-0.001] * dim, 2)]
    return rows


@pytest.mark.parametrize(("seed", "n"), [(1, 140), (2, 20)])
def test_codes_are_the_plain_ones(spark, seed, n):
    rows = vectors(seed, n)
    df = spark.createDataFrame(rows, VECTORS).withColumn("row", F.lit("clash")).withColumn("code", F.lit(1)).repartition(3)
    key = lambda x: repr(x)
    assert sorted((tuple(x) for x in vector_codes.compress(df).collect()), key=key) == sorted(plain_codes(rows), key=key)


def test_codes_of_other_shapes_and_salts(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "SALT_ROWS", 10)
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 0)
    rows = vectors(4, 60, 12)
    got = vector_codes.compress(spark.createDataFrame(rows, VECTORS), parts=4, entries=8, rounds=4).collect()
    assert sorted((repr(tuple(x)) for x in got)) == sorted(map(repr, plain_codes(rows, 4, 8, 4)))


def test_codes_of_nothing(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1), (2, [1.0] * 5, None)]):
        assert vector_codes.compress(spark.createDataFrame(rows, VECTORS)).collect() == []


def test_far_components_count_as_the_limit(spark):
    got = vector_codes.compress(spark.createDataFrame([(1, [3.0e38] * 16, 1), (2, [-3.0e38] * 16, 1)], VECTORS)).collect()
    assert {x.vec_id: x.error for x in got} == {1: 0, 2: 0}


def test_codes_agree_with_their_sql(spark):
    rows = [x for x in vectors(6) if x[0] != 2]
    agrees(spark, rows, VECTORS, "embeddings", lambda df: vector_codes.compress(df).drop("label"), vector_codes.OP12_SQL)
