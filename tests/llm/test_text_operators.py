from __future__ import annotations

import collections
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sugarloom.llm import decontaminate as dec
from sugarloom.llm import elias_fano as ef
from sugarloom.llm import lm_scoring as lm
from sugarloom.llm import mixing, ngram_join, paragraph_dedup, pii, quality, setjoin
from sugarloom.llm.common import ngram_hashes, words_of
from sugarloom.llm.components import connected_components
from tests.llm.helpers import components, corpus, frame, jaccard, prose, shingle_set


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


def test_hashes_tell_windows_apart_over_blocks():
    words = words_of("a b c d e f g " * 12_000)
    h = ngram_hashes(words, 5)
    assert len(h) == len(words) - 4 and len(set(h.tolist())) == 7
    assert ngram_hashes([b"x"], 5)[0] == ngram_hashes([b"x"], 1)[0]
    assert len(ngram_hashes([], 5)) == 0


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {frozenset(e) for e in edges if e[0] != e[1]}
    want = components({x for p in pairs for x in p}, lambda a, b: frozenset((a, b)) in pairs)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("n", "top"), [(1, 1), (1, 9), (7, 7), (900, 1000), (2000, 2**61)])
def test_elias_fano(n, top):
    r = np.random.default_rng(n)
    v = np.unique(r.integers(0, top, n, dtype=np.uint64))
    e = ef.EliasFano(ef.build(v))
    assert (e.access(np.arange(len(v))) == v).all()
    q = np.concatenate([v, v + np.uint64(1), r.integers(0, top + 2, 300, dtype=np.uint64)])
    place, equal = e.successor(q)
    assert (place == np.searchsorted(v, q)).all() and (equal == np.isin(q, v)).all()


def test_elias_fano_empty_and_repeated():
    e = ef.EliasFano(ef.build(np.empty(0, np.uint64)))
    assert e.successor(np.array([3], np.uint64))[1].tolist() == [False]
    v = np.sort(np.random.default_rng(1).integers(0, 50, 400, dtype=np.uint64))
    assert (ef.EliasFano(ef.build(v)).access(np.arange(400)) == v).all()


def test_lm_scoring(docs, rows):
    got = collections.defaultdict(list)
    for x in lm.score_texts(docs).collect():
        got[x["doc_id"]].append(x)
    tokens = lambda t: [*(t or "").encode().lower().split(), b"</s> "]
    counts, kinds, sums = [collections.Counter() for _ in range(4)], collections.Counter(), collections.Counter()
    for i, text, *_ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            w = tokens(text)
            for k in (1, 2, 3):
                for j in range(len(w) - k + 1):
                    counts[k][tuple(w[j : j + k])] += 1
    for k in (2, 3):
        for g, c in counts[k].items():
            kinds[g[:-1]] += 1
            sums[g[:-1]] += c
    n, v = sum(counts[1].values()), len(counts[1])

    def log10(w, i):
        p = (counts[1][(w[i],)] + 1) / (n + v + 1)
        for k in (2, 3):
            if i - k + 1 < 0:
                break
            c = tuple(w[i - k + 1 : i])
            if kinds[c]:
                p *= 0.75 * kinds[c] / sums[c]
            if g := counts[k][(*c, w[i])]:
                p += (g - 0.75) / sums[c]
        return math.log10(p)

    assert sum(map(len, got.values())) == len(rows)
    for i, text, *_ in rows:
        w, x = tokens(text), got[i][0]
        assert (x["n_tokens"], x["n_known"], x["train_tokens"]) == (len(w), sum(counts[1][(t,)] > 0 for t in w), n)
        assert x["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert x["base_score"] == pytest.approx(sum(math.log10((counts[1][(t,)] + 1) / (n + 1 * (v + 1))) for t in w))
        assert x["score"] == pytest.approx(sum(log10(w, j) for j in range(len(w))), abs=1e-3 * len(w))


def test_lm_segments_of_any_size_score_alike(spark, docs, rows):
    """Cut into many segments, with words of several segments' tokens, and with rows that have no id or other columns."""
    odd = docs.unionByName(frame(spark, [(None, rows[3][1], "en", "s", 0), (None, None, None, None, None)])).withColumnRenamed("lang", "held").withColumnRenamed("source", "words")
    score = lambda segment: sorted(((x["doc_id"] or -1, x["n_tokens"], x["n_known"], round(x["score"], 9)) for x in lm.score_texts(odd, segment=segment).collect()))
    assert score(300) == score(1 << 22) and len(score(1 << 22)) == len(rows) + 2


def test_lm_scoring_without_rows(docs):
    assert lm.score_texts(docs.limit(0)).count() == 0


def test_lm_levels_of_many_segments_hold_few_handles(docs, monkeypatch):
    """400 segments with 40 handles to spare, all kept where a map holds none, and 16 kept."""
    resource = pytest.importorskip("resource")
    manifests, _, _ = lm.train(docs, parts=1, held_out=9)
    row = manifests[0][0]
    rows = [{**row, "lo": row["lo"] + (i << 33), "hi": row["hi"] + (i << 33), "first": row["first"] + i * row["n"]} for i in range(400)]
    one = lm.Segment(row)
    name = "values" if one.values is not None else "counts"
    values = np.asarray(getattr(one, name))
    before, used = resource.getrlimit(resource.RLIMIT_NOFILE), len(os.listdir("/proc/self/fd"))
    resource.setrlimit(resource.RLIMIT_NOFILE, (used + 40, before[1]))
    try:
        for mapped in (lm.MAPPED if lm._UNTRACKED else 16, 16):
            monkeypatch.setattr(lm, "MAPPED", mapped)
            level = lm.Level(rows)
            places = np.arange(0, 400 * row["n"], max(1, row["n"] // 3))
            assert (level.value(places, name) == values[places % row["n"]]).all()
            assert len(level.mapped) == min(mapped, 400)
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, before)


def test_weights_of_spans_stay_as_they_are():
    r = random.Random(2)
    model = pii.SemiCRF({("phone", "bias"): 0.4, ("O", "atom"): 0.1})
    for _ in range(2000):
        text = "".join(r.choice("0123456789 +-()@.ab") for _ in range(40))
        pii.all_spans(text, model, pii.base_spans(text))
    assert len(model.w) == 2


def test_ids_of_text(docs, rows):
    """Ids that are no numbers give the same groups and passages as numbers that sort alike."""
    named = docs.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(), F.format_string("a%06d", "doc_id")))
    plain = {(f"a{x.doc_id:06d}", x.n_shingles, f"a{x.component_id:06d}") for x in ngram_join.near_duplicates(docs).collect()}
    assert {(x.doc_id, x.n_shingles, x.component_id) for x in ngram_join.near_duplicates(named).collect()} == plain
    first = {(f"a{x.doc_id:06d}", x.text) for x in ngram_join.first_of_components(docs).collect()}
    assert {(x.doc_id, x.text) for x in ngram_join.first_of_components(named).collect()} == first
    spans = lambda df, name: {(name(x.doc_id), x.start, x.end, x.removed) for x in paragraph_dedup.repeated_passages(df).collect()}
    assert spans(named, str) == spans(docs, lambda i: f"a{i:06d}") != set()


def test_lm_probabilities_sum_to_one(docs):
    manifests, total, _ = lm.train(docs, parts=1, held_out=9)
    trie = lm.Trie(manifests, total)
    raw = np.sort(trie.words.segments and np.concatenate([s.keys.access(np.arange(s.n)) + np.uint64(s.lo << 32) for s in trie.words.segments]))
    context = ngram_hashes(words_of("word word"), 1)
    hashes = np.concatenate([np.concatenate([context, [w]]) for w in raw]).astype(np.uint64)
    p, _, _ = trie.log10(trie.word_ids(hashes), np.arange(0, len(hashes), 3))
    unknown = 1 / (total + len(raw) + 1)
    assert (10 ** p[2::3]).sum() == pytest.approx(1, abs=0.01 + unknown)


def test_near_duplicates(docs, rows):
    sets = {i: shingle_set(t) for i, t, *_ in rows}
    want = components(sets, lambda a, b: jaccard(sets[a], sets[b]))
    got = ngram_join.near_duplicates(docs.withColumn("members", docs.lang)).collect()
    assert len(got) == len(rows)
    assert {(x["doc_id"], x["component_id"], x["n_shingles"]) for x in got} == {(i, want[i], len(sets[i])) for i in sets}
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_id_and_equal_ids(spark):
    """Near-alike rows without an id link; unlike texts of one id all stay, and so do clean rows without an id."""
    r = random.Random(21)
    fresh = lambda: [f"w{r.randrange(10**9)}" for _ in range(80)]
    a, b, c, d = fresh(), fresh(), fresh(), fresh()
    near = lambda w: " ".join([*w[:-1], "other"])
    a0, b0, c0, d0 = (" ".join(x) for x in (a, b, c, d))
    rows = [(None, a0), (None, near(a)), (7, b0), (7, c0), (3, near(b)), (None, d0), (None, near(c)), (8, ""), (None, None)]
    df = frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    got = collections.Counter((x["doc_id"], x["component_id"]) for x in ngram_join.near_duplicates(df).collect())
    assert got == {(None, None): 4, (7, 3): 1, (7, 7): 1, (3, 3): 1, (None, 7): 1, (8, 8): 1}
    kept = {(x["doc_id"], x["text"]) for x in ngram_join.first_of_components(df).collect()}
    assert kept == {(None, min(a0, near(a))), (3, near(b)), (7, c0), (None, d0), (8, ""), (None, None)}


def test_large_groups_are_linked_across_blocks(spark):
    """A group of several blocks whose head is alike to few of its members."""
    r = random.Random(8)
    head = list(range(40))
    sets = {0: head}
    for i in range(1, 31):  # two families that share too little with the head
        family = [1000 * (i % 2 + 1) + j for j in range(40)]
        sets[i] = sorted([head[0], *r.sample(family, 37)])
    rows = [(i, setjoin.pack(np.array(sorted(s), np.uint64) << np.uint64(16))) for i, s in sets.items()]
    groups = spark.createDataFrame([(0, i, 38) for i in range(1, 31)], "head long, member long, n int")
    links = setjoin.group_links(groups, spark.createDataFrame(rows, "member long, members binary"), block=4)
    got = {x["node"]: x["component"] for x in connected_components(links).collect()}
    want = components(sets, lambda a, b: jaccard(frozenset(sets[a]), frozenset(sets[b])))
    assert {i: got.get(i, i) for i in sets} == want
    assert len(set(want.values())) == 3


def test_trie_finds_what_pairs_find():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 50))).astype(np.uint64) for _ in range(120)]
    sets += [np.sort(r.permutation(s)[: max(1, len(s) - 2)]) for s in sets[:40]]
    linked = setjoin.links_within(sets, 75, 100)
    up = components(range(len(sets)), lambda a, b: (a, b) in linked or (b, a) in linked)
    want = components(range(len(sets)), lambda a, b: jaccard(frozenset(sets[a].tolist()), frozenset(sets[b].tolist())))
    assert up == want


def shared_windows(rows, n=50):
    """Plain version: of each (doc_id, text) the starts of n-word windows that another document has."""
    docs = {(i, t): (t or "").encode().lower().split() for i, t, *_ in rows}
    holders = collections.defaultdict(set)
    for d, w in docs.items():
        for at in range(len(w) - n + 1):
            holders[tuple(w[at : at + n])].add(d)
    return {d: [at for at in range(len(w) - n + 1) if len(holders[tuple(w[at : at + n])]) > 1] for d, w in docs.items()}


def test_paragraphs_of_plain_texts():
    texts = ["one two  three\nfour é six seven", "", None, " \n x", "a " * 40]
    w = paragraph_dedup.Words(texts)
    for i, t in enumerate(texts):
        own = np.flatnonzero(w.text == i)
        assert [t[a:b] for a, b in zip(w.start[own], w.end[own], strict=True)] == (t or "").split()
        assert [w.words[x].decode() for x in own] == (t or "").lower().split()
    r = random.Random(5)
    words = [f"w{r.randrange(10**6)}" for _ in range(3000)]
    # a piece depends on the words around it only
    cut = lambda ws: {tuple(ws[a:b]) for a, b in (lambda c: zip(c, [*c[1:], len(ws)]))(paragraph_dedup.Words([" ".join(ws)]).pieces(6).tolist())}  # noqa: E731, B905
    whole, part = cut(words), cut(words[1000:2000])
    assert len(part - whole) <= 3 and all(len(x) > 6 for x in list(part & whole)) and 50 < len(part) < 110


def test_repeated_passages(spark, docs, rows):
    got = collections.defaultdict(list)
    for x in paragraph_dedup.repeated_passages(docs).collect():
        text = next(t for i, t, *_ in rows if i == x["doc_id"])
        assert len(text[x["start"] : x["end"]].split()) == x["n_words"] >= 50
        got[x["doc_id"]].append(x)
    want = {i for (i, t), v in shared_windows(rows).items() if v}
    assert want <= set(got)
    # anything else is a line alike to another
    lines = [(i, shingle_set(line)) for i, t, *_ in rows for line in (t or "").split("\n") if len(line.split()) >= 50]
    assert set(got) - want <= {i for i, s in lines for j, z in lines if i != j and jaccard(s, z)}
    assert paragraph_dedup.repeated_passages(docs.limit(0)).count() == 0


def test_passages_inside_longer_lines(spark):
    """Passages of 51 to 90 words within longer lines, across lines and in short lines; short lines that repeat are none."""
    r = random.Random(12)
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    rows, planted = [], {}
    common = ["All rights of this line are reserved by its owners here.", "Read more about it in the notes below, or write to us today."]
    for i in range(60):
        passage = fresh(r.randint(51, 90))
        for copy in range(2):
            words = fresh(r.randint(5, 80)) + passage + fresh(r.randint(5, 80))
            if copy and i % 3 == 1:  # broken into short lines
                text = "\n".join(" ".join(words[x : x + 5]) for x in range(0, len(words), 5))
            elif copy and i % 3 == 2:
                text = " ".join(words).upper().replace(passage[20].upper(), passage[20].upper() + "\n\n ")
            else:
                text = " ".join(words)
            planted[len(rows)] = " ".join(passage)
            rows.append((len(rows), text, "en", "s", 0))
    for _ in range(40):
        rows.append((len(rows), "\n".join([common[0], " ".join(fresh(30)), common[1], " ".join(fresh(45)), common[0]]), "en", "s", 0))
    rows.append((None, " ".join(fresh(60)), "en", "s", 0))
    own = " ".join(fresh(70))  # repeats in its own document only, whose row is there twice
    rows += [(500, own + "\n" + own, "en", "s", 0)] * 2
    out = paragraph_dedup.repeated_passages(frame(spark, rows).withColumn("cluster", F.lit("x"))).collect()
    found = collections.defaultdict(list)
    for x in out:
        found[x["doc_id"]].append(" ".join(rows[x["doc_id"]][1][x["start"] : x["end"]].lower().split()))
        assert x["removed"] == (x["doc_id"] % 2 == 1)
    assert set(found) <= set(planted) and len(found) >= 0.95 * len(planted)
    # to the word, but where the whole lines are alike
    odd = {i: v for i, v in found.items() if v != [planted[i]]}
    assert all(len(v) == 1 and planted[i] in v[0] for i, v in odd.items()), [(i, len(planted[i].split()), [(len(x.split()), planted[i].find(x)) for x in v]) for i, v in odd.items()]
    assert len(odd) < 30
    nulls = [(None, own, "en", "s", 0), (None, own + " x", "en", "s", 0), (None, None, None, None, None), (1, "", "en", "s", 0)]
    assert sorted(x["removed"] for x in paragraph_dedup.repeated_passages(frame(spark, nulls)).collect()) == [False, True]


def test_bands_miss_few():
    bands, rows = paragraph_dedup.tune_bands(0.75)
    assert (1 - 0.75**rows) ** bands <= 0.002 < (1 - 0.75**rows) ** (bands - 1)


def edits(p: bytes, t: bytes) -> int:
    before = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        now = [i]
        for j, x in enumerate(t, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != x)))
        before = now
    return min(before)


def test_bit_parallel_distance():
    r = random.Random(3)
    for _ in range(200):
        p, t = bytes(r.choices(b"abc", k=r.randint(1, 70))), bytes(r.choices(b"abc", k=r.randint(0, 90)))
        d, a, b = dec.best_match(p, t)
        assert d == edits(p, t) == edits(p, t[a:b])


def test_decontamination(spark, docs, rows):
    r = random.Random(6)
    items = [(1, rows[2][1][10:150]), (2, "Some item that stands nowhere in the corpus, being of other words."), (3, None), (4, ""), (5, "zzz"), (1, rows[2][1][10:150])]
    text = list(rows[3][1][:160])
    for _ in range(5):
        text[r.randrange(len(text))] = "#"
    items.append((6, "".join(text)))
    got = {(x["doc_id"], x["item_id"], x["distance"]) for x in dec.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for i, t, *_ in rows:
        raw = dec.normalised(t)
        for k, item in items:
            p = dec.normalised(item)
            if len(p) >= 13 and (d := edits(p, raw)) <= dec.errors_allowed(len(p), 0.08):
                want.add((i, k, d))
            if 0 < len(p) < 13 and p in raw.split():
                want.add((i, k, 0))
    assert got == want and {k for _, k, _ in want} >= {1, 6}
    assert dec.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    left = [x["doc_id"] for x in dec.clean(docs, spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert sorted(left) == sorted(i for i, *_ in rows if i not in {x[0] for x in want})


def test_short_items_keep_their_budget_and_ties_take_the_first_place(spark):
    match = lambda item, text: dec.ItemIndex([(1, item)], 0.08).matches(text)
    assert [x[1:3] for x in match("thirteen byte", "a thirXeen byte b")] == [(1, 1)]
    assert match("thirteen byte", "a thirXXen byte b") == []
    assert match("cat", "the cat.") == [(1, 0, 0, 4, 7)] and match("cat", "concatenate") == []
    # the same distance at two places: the first
    assert match("some twenty-odd bytes, one", "some twenty-odd byteX, one x some twenty-odd bytesX one")[0][3] == 0
    r = random.Random(4)
    for _ in range(300):
        item = "".join(r.choices("abcd ", k=r.randint(13, 40))).strip()
        text = "".join(r.choices("abcd ", k=60)) + item[:7] + "x" + item[8:] + "".join(r.choices("abcd ", k=60))
        p, raw = dec.normalised(item), dec.normalised(text)
        best = edits(p, raw)
        allowed = dec.errors_allowed(len(p), 0.08)
        assert [x[1] for x in match(item, text)] == ([best] if best <= allowed and allowed else [x[1] for x in match(item, text)])


def test_cleaning_judges_each_row(spark):
    bad = "Which of these rivers is the longest one of them all?"
    docs = spark.createDataFrame([(1, "text with " + bad, 7), (1, "another text of that id", 7), (None, bad, 8), (None, "clean", 9), (2, None, 7), (2, "", 7), (2, "", 7)], "doc_id long, text string, distance int")
    items = spark.createDataFrame([(None, bad), (3, None)], "item_id long, text string")
    left = sorted((x["doc_id"] or 0, x["text"] or "", x["distance"]) for x in dec.clean(docs, items).collect())
    assert left == [(0, "clean", 9), (1, "another text of that id", 7), (2, "", 7), (2, "", 7), (2, "", 7)]
    assert [(x["doc_id"], x["item_id"]) for x in dec.contaminated(docs, items).orderBy(F.col("doc_id").asc_nulls_last()).collect()] == [(1, None), (None, None)]
    assert dec.clean(docs.limit(0), items).count() == 0


PII_TEXTS = [
    (1, "Write to ann.lee@mail.example.com or bob@x and c@d.e, now."),
    (2, "Hosts 10.0.0.1, 300.1.1.1, 1.2.3.4.5.6.7.8 and 256.1.2.3"),
    (3, "Card 4111 1111 1111 1111 or 4111-1111-1111-1112 or 4012888888881881."),
    (4, "Call +1 (017) 555-7713 or +12 or +123456789012345678 (+44 20 7946 0958)"),
    (5, None),
    (6, ""),
    (7, "nothing here at all 12 34"),
    (8, "é +49 30 1234567, @ @@ a@@b.c x@y..z 1..2.3.4"),
    (1, "ann.lee@mail.example.com"),
]


def plain_spans(t):
    import re

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0]), x[2]))


def test_pii(spark, rows):
    docs = spark.createDataFrame([(*x, "kept") for x in PII_TEXTS], "doc_id long, text string, spans string")
    out = pii.find_pii(docs).collect()
    assert len(out) == len(PII_TEXTS)
    for x in out:
        spans = plain_spans(x["text"] or "")
        assert x["base_spans"] == pii.spelled(spans)
        assert set(x["base_spans"].split(",")) <= set(x["spans"].split(",")) or not spans
        assert (x["n_email"], x["n_ip"], x["n_card"], x["n_phone"]) == tuple(sum(k == s[0] for s in spans) for k in pii.KINDS)
        assert (x["redacted"] is None) == (x["text"] is None)
    assert pii.find_pii(docs.limit(0)).count() == 0
    r = random.Random(2)
    for _ in range(300):
        t = "".join(r.choices("ab@..+-123 ()", k=60))
        assert pii.base_spans(t) == plain_spans(t), t


def test_added_spans_stay_clear_of_nested_base_spans():
    class Whole:
        w = {"x": 1.0}

        def decode(self, text, atoms):
            return ([("phone", atoms[0][0], atoms[-1][1])] if atoms else []), 0.0

    text = "x 1.2.3.4@host.example.com 5551234567 y"
    base = pii.base_spans(text)
    assert {k for k, *_ in base} == {"email", "ip"}
    added = [s for s in pii.all_spans(text, Whole(), base) if s not in base]
    assert all(e <= a or b <= s for _, a, b in added for _, s, e in base)


def test_semi_markov_model_finds_other_spellings():
    r = random.Random(1)
    texts = []
    for _ in range(150):
        d = [str(r.randrange(10)) for _ in range(10)]
        texts += [f"and call +1 ({''.join(d[:3])}) {''.join(d[3:6])}-{''.join(d[6:])} for it", f"mail the.{d[0]}{d[1]}@mail{d[2]}.example.com in", f"at {r.randrange(256)}.{r.randrange(256)}.{d[0]}.{d[1]} it"]
    model = pii.train(texts)
    held = "so (415) 555-0199 or bob.smith (at) mail (dot) example (dot) org, not 2024-05-11 10:22"
    found = [(k, held[a:b]) for k, a, b in pii.all_spans(held, model, pii.base_spans(held))]
    assert ("phone", "(415) 555-0199") in found and ("email", "bob.smith (at) mail (dot) example (dot) org") in found and len(found) == 2


def test_semi_markov_likelihood_is_normalised():
    """The forward sum is the sum over all segmentations, on a short stretch."""
    model = pii.SemiCRF({("phone", "bias"): 0.4, ("O", "atom"): -0.2, ("after", "segment"): 0.1, ("card", "n9"): 0.7})
    text = "12-345-6789 1"
    atoms = pii.atoms_of(text, 0, len(text))
    segments = model._segments(text, atoms)

    def total(at, touching):
        if at == len(atoms):
            return 1.0
        s = math.exp(model._score("O", None) + (model.w["after", "segment"] if touching else 0)) * total(at + 1, False)
        if not touching:
            for j in range(at + 1, len(atoms) + 1):
                for i, f in segments[j - 1]:
                    if i == at and f is not None:
                        s += sum(math.exp(model._score(k, f)) for k in pii.KINDS) * total(j, True)
        return s

    assert model._logsum(text, atoms, segments)[3] == pytest.approx(math.log(total(0, False)))
    f, b, _, z = model._logsum(text, atoms, segments)
    assert np.logaddexp(f[0, 0] + b[0, 0], -np.inf) == pytest.approx(z)


def plain_quality(t):
    import re

    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, c in collections.Counter(windows).items() if c > 1}
    cover = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 5)}
    lines, dup, seen = t.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_quality(spark, docs, rows):
    odd = [(900, "a | b # c\nsame line\nsame line\n\n\nsame line ", "en", "x", 0), (901, "éà ü x " * 9, "xx", "x", 0), (902, "SHOUT!! ***### " * 60, "en", "x", 0)]
    out = quality.quality(frame(spark, rows + odd).withColumnRenamed("n_chars", "kept")).collect()
    assert len(out) == len(rows) + 3
    for x in out:
        want = plain_quality(x["text"])
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == want, x["text"]
        assert x["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (x["kept"] and x["base_failed"])
    assert not next(x for x in out if x["doc_id"] == 902)["kept"]
    good = [x for x in out if x["doc_id"] < 60 and x["n_words"] >= 200]
    assert good and all(x["kept"] for x in good)
    assert quality.quality(docs.limit(0)).count() == 0


def plain_kept(rows, most_class=0.28, most_word=0.44):
    """Plain version of the divergence: shares of characters and words by text, their means by language, and distances."""
    words = lambda t: (t or "").encode().split()
    bare = lambda w: w.lower().strip(b".,;:!?'\"()")

    def kinds(t):
        out = collections.Counter()
        for ch in t or "":
            b = ch.encode()[0]
            out["x" if b >= 192 else "a" if "a" <= ch <= "z" else "A" if "A" <= ch <= "Z" else "0" if ch in "0123456789" else " " if ch in " \t" else "n" if ch in "\n\x0b\x0c\r" else "." if ch in ".,;:" else "!" if ch in "!?'\"()-" else "#"] += 1
        return out

    by_class, by_word, texts_ = [collections.defaultdict(collections.Counter) for _ in range(2)] + [collections.Counter()]
    for _, t, lang, *_ in rows:
        if w := words(t):
            texts_[lang] += 1
            for k, n in kinds(t).items():
                by_class[lang][k] += n * 1_000_000 // sum(kinds(t).values())
            for x, n in collections.Counter(w).items():
                by_word[lang][bare(x)] += n * 1_000_000 // len(w)
    common = {lang: [w for w, _ in sorted(((w, n) for w, n in c.items() if w), key=lambda x: (-x[1], x[0]))[:64]] for lang, c in by_word.items()}

    def apart(p, q):
        out = 0.0
        p, q = ({k: v / sum(x.values()) for k, v in x.items()} for x in (p, q))
        for k in {*p, *q}:
            a, b = p.get(k, 0), q.get(k, 0)
            out += sum(v / 2 * math.log2(2 * v / (a + b)) for v in (a, b) if v)
        return math.sqrt(max(0, out))

    out = []
    for _, t, lang, *_ in rows:
        n, repeats = len(words(t)), plain_quality(t)[4]
        if n < 10 or 100 * repeats > 20 * n:
            out.append(False)
            continue
        own = collections.Counter(bare(w) if bare(w) in common[lang] else None for w in words(t))
        whole = collections.Counter({w: by_word[lang][w] for w in common[lang]})
        whole[None] = max(0, texts_[lang] * 1_000_000 - sum(whole.values()))
        out.append(not (n >= 40 and apart(kinds(t), by_class[lang]) > most_class or n >= 100 and apart(own, whole) > most_word))
    return out


def test_quality_keeps_what_the_plain_version_keeps(spark, rows):
    odd = [(900, "SHOUT!! ***### " * 30 + prose(random.Random(1), 200), "en", "x", 0), (901, "12345 6789 " + " ".join(str(i) for i in range(200)), "de", "x", 0), (902, " ".join(f"Xq{i}" for i in range(150)), None, "x", 0), (903, prose(random.Random(2), 150).upper(), "en", "x", 0)]
    every = rows + odd
    kept = collections.defaultdict(set)
    for x in quality.quality(frame(spark, every)).collect():
        kept[x["doc_id"], x["text"]].add(x["kept"])
    want = plain_kept(every)
    assert all(kept[i, t] == {w} for (i, t, *_), w in zip(every, want, strict=True)) and not want[-1] and sum(want) > 20


def test_divergence():
    p = np.array([1.0, 0, 3])
    assert quality.distance(p, p * 7) == 0 and quality.distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1
    assert quality.distance(np.zeros(3), p) == 0


def test_mixing(docs, rows):
    out = mixing.mix(docs).collect()
    again = mixing.mix(docs.orderBy("text")).collect()
    key = lambda x: tuple("" if v is None else str(v) for v in x)
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == len(rows)
    sizes = collections.Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped: set = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and left * weight[s] / free > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    target = {s: 3 * sizes[s] if s in capped else left * weight[s] / free for s in order}
    for s in order:
        own = [x for x in out if x["source"] == s]
        assert all(x["target"] == pytest.approx(target[s]) and x["source_size"] == sizes[s] and x["taken"] <= 3 * x["size"] for x in own)
        assert sum(x["taken"] for x in own) == math.floor(own[0]["target"])
    assert mixing.mix(docs.limit(0)).count() == 0
