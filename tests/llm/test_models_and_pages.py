from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sugarloom.llm import html_blocks as hb
from sugarloom.llm import toxicity as tox
from sugarloom.llm import url_filter as uf
from tests.llm.helpers import SYLLABLES, corpus, frame, prose


def test_factorization_machine_learns_pairs():
    """Two terms that mean something only together, which no linear model can tell."""
    r = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(1500):
        a, b = r.random(2) < 0.5
        noise = r.integers(10, 400, 12)
        rows.append(np.unique(np.concatenate([noise, [1] * int(a), [2] * int(b)])).astype(np.int64))
        labels.append(float(a and b))
    y = np.array(labels)
    fm = tox.FactorizationMachine.fit(rows, y)
    at = lambda *t: fm.raw(np.array(sorted(fm._at[x] for x in t), np.int64))
    pair = at(1, 2) - at(1) - at(2) + fm.bias
    assert pair > 0.2 and at(1, 2) > 0 > max(at(1), at(2))


def test_factorization_machine_learns_pairs_of_neutral_terms():
    """Each of two terms is as common in both labels; only whether they come together tells."""
    r = np.random.default_rng(4)
    rows, labels = [], []
    for k in range(2000):
        a, b = k % 2, k // 2 % 2
        noise = r.integers(10, 400, 12)
        rows.append(np.unique(np.concatenate([noise, [1] * a, [2] * b])).astype(np.int64))
        labels.append(float(a == b))
    fm = tox.FactorizationMachine.fit(rows[:1600], np.array(labels[:1600]))
    right = [(fm.raw(np.array([fm._at[x] for x in i if x in fm._at], np.int64)) > 0) == bool(y) for i, y in zip(rows[1600:], labels[1600:], strict=True)]
    assert np.mean(right) > 0.95


def test_rare_telling_word_keeps_its_weight_in_a_large_sample():
    """A word that only ten of two thousand toxic rows hold and no clean one, beside common telling ones."""
    r = np.random.default_rng(6)
    rows, labels = [], []
    for k in range(4000):
        told = [5] if k % 2 and k // 2 % 200 == 0 else [1 + k // 2 % 3] if k % 2 else []
        rows.append(np.unique(np.concatenate([r.integers(10, 2000, 12), told])).astype(np.int64))
        labels.append(float(k % 2))
    fm = tox.FactorizationMachine.fit(rows, np.array(labels))
    assert 5 in fm._at and fm.raw(np.array([fm._at[5]])) > fm.bias + 0.2


def test_pair_term_equals_the_double_sum():
    r = np.random.default_rng(2)
    fm = tox.FactorizationMachine(0.3, np.arange(6), r.random(6), r.random((6, 3)))
    p = np.array([0, 2, 5])
    pairs = sum(fm.v[i] @ fm.v[j] for i in p for j in p if i < j)
    assert fm.raw(p) == pytest.approx(0.3 + fm.w[p].sum() + pairs)


def test_toxicity(spark):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        text = prose(r, r.choice((20, 60, 200)))
        bad = r.random() < 0.15
        if bad:
            words = text.split(" ")
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(("idiotic", "idiot", "scum,")))
            text = " ".join(words)
        rows.append((i, text, "en", "s", 0))
        labels.append((i, int(r.random() < 0.8), int(bad)))
    docs = frame(spark, rows + [(2000, None, "en", "s", 0), (2001, "", None, None, 0), (5, rows[5][1], "en", "s", 0)])
    marks = spark.createDataFrame([*labels, labels[0], (3000, 1, None)], "doc_id long, quality int, toxic int")
    out = tox.score_toxicity(docs, marks).collect()
    truth = {i: t for i, _, t in labels}
    held = [x for x in out if x["held_out"] and x["doc_id"] in truth]
    hits = collections.Counter((truth[x["doc_id"]], x["predicted"]) for x in held)
    assert hits[1, 1] >= 0.95 * (hits[1, 1] + hits[1, 0]) and hits[0, 1] <= 0.01 * (hits[0, 0] + hits[0, 1])
    assert len(out) == 903 and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.7) for x in out)
    assert all(not x["predicted"] for x in out if x["doc_id"] in (2000, 2001))
    assert tox.score_toxicity(docs.limit(0), marks).count() == 0
    assert {x["score"] for x in tox.score_toxicity(docs, marks.limit(0)).collect()} == {0.5}


def plain_verdicts(pages, edges):
    """page_id to (host, path, rule, verdict), by walking over all aliases."""

    def parts(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut], rest[cut:]
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]

    def rule(u):
        host, path = parts(u)
        fit = [(len(h + p), h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, None)

    near = collections.defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for page, url in pages:
        seen, left = {url}, [url]
        while left:
            for x in near[left.pop()] - seen:
                seen.add(x)
                left.append(x)
        said = {rule(x)[1] for x in seen if x in {u for _, u in pages}}
        own = rule(url)
        out[page] = (*parts(url), own[0], own[1] or ("allow" if "allow" in said or "block" not in said else "block"))
    return out


def test_urls(spark):
    pages = [
        (1, "http://A.example.com/en/1", ""),
        (2, "https://www.example.com/en/x?y#z", None),
        (3, "http://x.net/es/1", '<html><head><link rel="canonical" href="http://free.org/copy"></head>'),
        (4, "http://free.org/copy", "<p>canonical</p>"),
        (5, "http://other.org/p", '<meta http-equiv="refresh" content="0; url=http://free.org/copy">'),
        (6, "http://ok.com/a", '<link href="/b" rel=canonical>'),
        (7, "http://z.org/1", '<link rel="canonical" href="http://x.net/fr/2">'),
        (8, "http://x.net/fr/2", '<link rel="canonical" href="http://ok.com/b">'),
        (9, "http://ok.com/b", ""),
        (10, None, None),
        (11, "no scheme here", ""),
        (12, "http://host", ""),
        (13, "http://net/es/", ""),
        (14, "http://com", ""),
        (15, "http://a.com?x=/en/", ""),
        (16, "http://alone.org/q", ""),
    ]
    edges = [(pages[2][1], pages[3][1]), (pages[4][1], pages[3][1]), (pages[5][1], pages[8][1]), (pages[6][1], pages[7][1]), (pages[7][1], pages[8][1])]
    out = uf.judge_urls(spark.createDataFrame([*pages, pages[3]], "page_id long, url string, html string")).collect()
    want = plain_verdicts([p[:2] for p in pages], edges)
    assert len(out) == 17
    for x in out:
        assert (x["host"], x["path"], x["rule"], x["verdict"]) == want[x["page_id"]], x
    verdicts = {x["page_id"]: (x["verdict"], x["propagated"]) for x in out}
    assert verdicts[4] == verdicts[5] == ("block", True) and verdicts[7] == ("allow", False) and verdicts[8] == ("block", False)
    extra = spark.createDataFrame([("http://alone.org/q", "http://x.net/es/1")], "source string, target string")
    assert {x["page_id"]: x["verdict"] for x in uf.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), redirects=extra).collect()}[16] == "block"
    assert uf.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_links_as_pages_spell_them(spark):
    """References, dot segments, lists of rel words, quotes, attribute orders; what is no link is none."""
    base = "http://c.org/d/e/page?q=1"
    cases = [
        ('<link rel="canonical" href="http://example.com/en/z?p=1&amp;q=2">', ["http://example.com/en/z?p=1&q=2"]),
        ("<link rel='foo  CANONICAL' href='../../q'>", ["http://c.org/d/e/../../q"]),
        ('<LINK HREF=/a/./b REL=canonical>', ["http://c.org/a/./b"]),
        ('<link data-href="no" rel="canonical" href="&#x68;ttp://x.org/&#252;&lt;&quot;&#38;lt;">', ['http://x.org/ü<"&lt;']),
        ('<link rel="canonical-not" href="/a"><link rel="icon" href="/b"><link href="/canonical">', []),
        ('<link rel="canonical" href="?x=2"><link rel="canonical" href="#top"><link rel="canonical" href="mailto:a@b"><link rel=canonical href="">', ["http://c.org/d/e/page?x=2"]),
        ("<meta http-equiv=\"refresh\" content=\"0; URL='//y.org/1'\">", ["http://y.org/1"]),
        ('<meta content="5;url=f&amp;g" http-equiv=Refresh>', ["http://c.org/d/e/f&g"]),
        ('<meta name="refresh" content="0; url=/z">canonical', []),
    ]
    rows = spark.createDataFrame([(i, base, h) for i, (h, _) in enumerate(cases)], "i long, url string, html string")
    got = {x.i: x.links for x in rows.select("i", uf.link_targets(F.col("url"), F.col("html")).alias("links")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    keys = {"http://a.b/c/../d": "a.b/d", "http://a.b/../x/": "a.b/x", "http://a.b/c/./d/..": "a.b/c", "http://a.b/.x/..y": "a.b/.x/..y", "http://a.b": "a.b"}
    found = spark.createDataFrame([(k,) for k in keys], "url string").select("url", uf.alias_key(F.col("url")).alias("key"))
    assert {x.url: x.key for x in found.collect()} == keys
    pages = [(1, "http://c.org/one", cases[0][0]), (2, "http://c.org/d/e/two", "<link rel='foo canonical' href='../../q'>"), (3, "http://c.org/q", '<link rel="canonical" href="http://x.net/fr/../es/1">'), (4, "http://x.net/es/1", ""), (5, "http://example.com/en/z?p=1&q=2", "")]
    out = {x.page_id: x.verdict for x in uf.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block"}


def page(r, i, articles=True):
    main = "article" if articles else "section"
    body = "".join(f"<p>{prose(r, r.randint(3, 40))}" + ("</p>" if r.random() < 0.8 else "") for _ in range(r.randint(1, 6)))
    links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in SYLLABLES[:5])
    return (
        i,
        f"http://h.org/{i}",
        f'<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var x="</p>";</script></head><body><nav><ul>{links}</ul></nav><!-- x > y --><div class="ad">{prose(r, 9)}</div><{main}><h1>{prose(r, 5)} &amp; more</h1>{body}</{main}><footer>&copy; h.org {prose(r, 4)}</footer></body></html>',
    )


def test_pages(spark):
    r = random.Random(4)
    rows = [page(r, i) for i in range(60)]
    odd = [(100, None, None), (101, "u", ""), (102, "u", "<p"), rows[0]]
    out = hb.extract(spark.createDataFrame(rows + odd, "page_id long, url string, html string")).collect()
    assert len(out) == 64
    for x in out:
        html = dict((p, h) for p, _, h in rows).get(x["page_id"])
        want = [b.text for b in hb.blocks_of(html) if "article" in b.path] if html else []
        assert x["text"] == "\n\n".join(want) and x["n_chars"] == len(x["text"])
    assert hb.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_blocks():
    html = '<div class="a b">x&nbsp;&lt;y<br>z<p>one<p>two <b>bold</b></div><script>no</script>tail<!-- never closed'
    got = [(b.path, b.text) for b in hb.blocks_of(html)]
    assert got == [(("div", "@a", "@b"), "x <y z"), (("div", "@a", "@b", "p"), "one"), (("div", "@a", "@b", "p"), "two bold"), ((), "tail")]


def test_held_elements_take_only_their_own_content():
    texts = lambda html: [b.text for b in hb.blocks_of(html)]
    assert texts('<p>a<svg class="i"/>article text</p><p>b') == ["aarticle text", "b"]
    assert texts("<p>a</p><iframe src='x'><p>b</p><object data=y><p>c</p><svg><g>d</g></svg><p>e") == ["a", "b", "c", "e"]
    assert texts("<p>a</p><svg><p>b</p><svg>c</svg><p>d") == ["a", "b", "d"]
    assert texts("<object>a<object>b</object>c</object><p>d<SVG><svg/>e</SVG >f") == ["df"]
    assert texts("<p>a<template/>b<noscript>c</noscript>d") == ["abd"]


def test_all_names_of_a_path_are_features():
    deep = hb._features(hb.blocks_of(f'<article class="{" ".join("abcdefghijklmno")}"><p>x'))[0][0]
    assert set(hb._ids(["article"], hb.PATHS)) <= set(deep)


def test_forward_pass_equals_a_plain_one():
    """One block after another, gate by gate, in both directions, for pages of different length in one batch."""
    import math

    m = hb.Labeller(3)
    pages = [hb._features(hb.blocks_of(x)) for x in ("<body><nav>Home</nav><article><p>One text.</p><p>Two, three.</p></article><footer>End</footer>", "<p class=x>Alone")]
    got = m.probabilities(*m.inputs(pages))
    sig = lambda v: 1 / (1 + math.exp(-v))
    size = hb.HIDDEN
    for i, (paths, words, shape) in enumerate(pages):
        x = [[4 * sum(m.p["path"][k][d] for k in p) / len(p) for d in range(hb.DIM)] + [sum(m.p["word"][k][d] for k in w) / len(w) for d in range(hb.DIM)] + list(s) for p, w, s in zip(paths, words, shape, strict=True)]
        states = {}
        for way in "fb":
            h, c, states[way] = [0.0] * size, [0.0] * size, [None] * len(x)
            for t in range(len(x)) if way == "f" else reversed(range(len(x))):
                z = [sum(a * m.p[way + "x"][j][n] for j, a in enumerate(x[t])) + sum(a * m.p[way + "h"][j][n] for j, a in enumerate(h)) + m.p[way + "b"][n] for n in range(4 * size)]
                c = [sig(z[size + n]) * c[n] + sig(z[n]) * math.tanh(z[3 * size + n]) for n in range(size)]
                h = [sig(z[2 * size + n]) * math.tanh(c[n]) for n in range(size)]
                states[way][t] = h
        for t in range(len(x)):
            want = sig(sum(a * b for a, b in zip([*states["f"][t], *states["b"][t]], m.p["out"], strict=True)) + m.p["bias"][0])
            assert abs(got[t, i] - want) < 1e-4


def test_gradients_are_the_slopes_of_the_loss():
    r = random.Random(5)
    pages = [hb._features(hb.blocks_of(page(r, i)[2])) for i in range(3)]
    labels = [np.array([k % 2 for k in range(len(p[0]))], np.float32) for p in pages]
    model = hb.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, g = model.gradients(pages, labels)
    for name in model.p:
        flat = np.argsort(-np.abs(g[name]).ravel())[:2]
        for at in flat:
            i, step = np.unravel_index(at, g[name].shape), 1e-3
            kept = model.p[name][i]
            model.p[name][i] = kept + step
            up, _ = model.gradients(pages, labels)
            model.p[name][i] = kept - step
            down, _ = model.gradients(pages, labels)
            model.p[name][i] = kept
            assert (up - down) / (2 * step) == pytest.approx(float(g[name][i]), rel=0.05, abs=2e-5), name


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp
    from sugarloom.llm import decontaminate, mixing, ngram_join, pii, quality

    rows = corpus(seed=5, n=40)
    r = random.Random(9)
    item = prose(r, 30)
    rows += [(500, prose(r, 400) + "\n" + item, "en", "s1", 0), (501, prose(r, 400) + "\nmail ann.lee@mail.example.com", "en", "s1", 0)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, steps = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        docs = spark.createDataFrame(out.collect(), out.schema)
        steps.append(docs.collect())
    ids = [sorted(x["doc_id"] for x in s) for s in steps]
    start = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [x["doc_id"] for x in quality.quality(start).where("kept").collect()]
    assert ids[0] == sorted(kept)
    first = [x for x in rows if x[0] in set(kept)]
    groups = {x["doc_id"]: x["component_id"] for x in ngram_join.near_duplicates(frame(spark, first)).collect()}
    assert ids[1] == sorted(i for i, c in groups.items() if i == c)
    assert 500 in ids[1] and ids[2] == [i for i in ids[1] if i != 500]
    assert ids[3] == ids[2] == ids[4]
    text = next(x["text"] for x in steps[3] if x["doc_id"] == 501)
    assert "<EMAIL>" in text and "@" not in text
    assert len(cp.STAGES) == 5 and decontaminate and mixing and pii
    assert sorted(map(tuple, cp.run(spark, str(tmp_path)).collect()), key=str) == sorted(map(tuple, steps[4]), key=str)


def test_pipeline_against_plain_versions(spark, tmp_path):
    """Each stage on what the one before kept: verdicts, components, edit distances and budgets by brute force."""
    import corpus_pipeline as cp
    from sugarloom.llm import decontaminate as dec
    from tests.llm.helpers import components, jaccard, shingle_set
    from tests.llm.test_text_operators import edits, plain_kept, plain_spans

    r = random.Random(19)
    item = prose(r, 25)
    wrong = list(item)
    wrong[7] = "#"
    rows = corpus(seed=7, n=30)
    rows += [(None, prose(r, 90), "en", "s1", 0), (3, prose(r, 80), "en", "s1", 0), (700, prose(r, 60) + "\n" + "".join(wrong), "en", None, 0), (701, prose(r, 60) + " 10.0.0.1 x@y.org", "en", "s1", 0), (None, None, None, None, None)]
    spark.createDataFrame([(1, item), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    for number, (_, stage) in enumerate(cp.STAGES):
        before = [tuple(x) for x in docs.collect()]
        out = stage(spark, docs.withColumn("kept", docs.doc_id), str(tmp_path))
        got = [tuple(x) for x in out.collect()]
        if number == 0:
            want = [x for x, kept in zip(before, plain_kept(before), strict=True) if kept]
        elif number == 1:
            sets = [shingle_set(x[1]) for x in before]
            of = components(range(len(before)), lambda a, b: jaccard(sets[a], sets[b]))
            groups = collections.defaultdict(list)
            for i, root in of.items():
                groups[root].append(before[i])
            want = [min(v, key=key) for v in groups.values()]
        elif number == 2:
            p = dec.normalised(item)
            want = [x for x in before if edits(p, dec.normalised(x[1])) > dec.errors_allowed(len(p), 0.08)]
            assert 700 in {x[0] for x in before} - {x[0] for x in want}
        elif number == 3:
            assert sorted(x[0] or -1 for x in got) == sorted(x[0] or -1 for x in before)
            text = {x[0]: x[1] for x in got}
            for x in before:
                assert not plain_spans(x[1] or "") or all(x[1][a:b] not in text[x[0]] for _, a, b in plain_spans(x[1]))
            want = got
        else:
            taken = collections.Counter()
            for x in got:
                taken[x[1]] += x[5]
            assert len(got) == len(before) and all(taken[x[1]] == int(x[4]) and x[5] <= 3 * x[2] for x in got)
            break
        assert sorted(map(key, got)) == sorted(map(key, want)) and out.columns == list(cp.COLUMNS)
        docs = spark.createDataFrame(out.collect(), out.schema)
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_columns_that_clash_are_not_read(spark):
    docs = spark.createDataFrame([(1, "an idiot text of words", 7, "x"), (None, None, 8, None)], "doc_id long, text string, score int, held_out string")
    marks = spark.createDataFrame([(1, 1, 9), (None, None, 9)], "doc_id long, toxic int, text int")
    assert {x["doc_id"] for x in tox.score_toxicity(docs, marks).collect()} == {1, None}
    pages = spark.createDataFrame([(1, "http://a.net/es/1", "<p>One text that is long enough.</p>", "x", 1), (None, None, None, None, None)], "page_id long, url string, html string, verdict string, n_chars int")
    assert {(x["page_id"], x["verdict"]) for x in uf.judge_urls(pages).collect()} == {(1, "block"), (None, "allow")}
    assert uf.judge_urls(pages.limit(0)).count() == 0
    assert {(x["page_id"], x["url"]) for x in hb.extract(pages).collect()} == {(1, "http://a.net/es/1"), (None, None)}
