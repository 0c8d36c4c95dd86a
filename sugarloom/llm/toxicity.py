"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum of w_i + sum over pairs of <v_i, v_j>), over the distinct terms of a text. The
linear part is learned by FTRL-proximal, whose L1 bound leaves only terms with evidence at a weight.
Factor vectors learn what pairs add beyond their parts: those of all terms of a few rows, or of the terms
at a weight only (as in DiFacto), whichever does better on rows kept apart.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import py_part, sliced, split_part, table, texts

TERMS = 1 << 20
PREFIXES = (4, 5, 6)
#: Fits that are compared: standard errors below which a weight is 0, whether all terms get factors, and the factors' L2.
FITS = ((4.0, False, 1e-3), (3.0, False, 1e-3), (2.0, False, 1e-3), (4.0, True, 1e-2), (4.0, True, 5e-2), (3.0, True, 5e-2))
EDGES = ".,;:!?'\"()[]{}|*#%$&-_<>"


def term_ids(word: str) -> tuple[int, ...]:
    """Hashed terms of a lower-cased word: itself and its longer prefixes, so that inflected forms meet."""
    w = word.strip(EDGES)
    if not w:
        return ()
    raw = w.encode("utf-8", "surrogatepass")
    return (zlib.crc32(b"w" + raw) % TERMS, *(zlib.crc32(b"p%d" % k + w[:k].encode("utf-8", "surrogatepass")) % TERMS for k in PREFIXES if len(w) >= k))


def distinct_terms(text: str | None) -> np.ndarray:
    ids: set[int] = set()
    for w in set((text or "").lower().split()):
        ids.update(term_ids(w))
    return np.array(sorted(ids), np.int64)


class FactorizationMachine:
    """bias, and of each term with a weight its weight and factors."""

    def __init__(self, bias: float = 0.0, terms: np.ndarray | None = None, w: np.ndarray | None = None, v: np.ndarray | None = None):
        self.bias, self.terms = bias, np.empty(0, np.int64) if terms is None else terms
        self.w = np.empty(0) if w is None else w
        self.v = np.empty((0, 1)) if v is None else v
        self._words: dict[str, tuple[int, ...]] = {}
        self._at = {int(t): i for i, t in enumerate(self.terms)}

    def raw(self, places: np.ndarray) -> float:
        if not len(places):
            return self.bias
        v = self.v[places]
        s = v.sum(0)
        return float(self.bias + self.w[places].sum() + 0.5 * (s @ s - (v * v).sum()))

    def places(self, text: str | None) -> np.ndarray:
        """Indices of the text's known terms; what a word gives is remembered, up to a bound."""
        if len(self._words) > 500_000:
            self._words.clear()
        found: set[int] = set()
        for w in set((text or "").lower().split()):
            at = self._words.get(w)
            if at is None:
                at = self._words[w] = tuple(i for i in map(self._at.get, term_ids(w)) if i is not None)
            if at:
                found.update(at)
        return np.array(sorted(found), np.int64)

    def score(self, text: str | None) -> float:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.places(text)), -35, 35)))

    @classmethod
    def fit(cls, rows: list[np.ndarray], labels: np.ndarray, factors: int = 8, l1: float = 1.0, l2: float = 0.1, alpha: float = 0.1, epochs: int = 5, least: int = 3, balance: float = 4.0, seed: int = 1) -> FactorizationMachine:
        """FTRL-proximal for the linear part, then AdaGrad on bias, weights and factors.

        Every term of `least` rows takes part, whatever its own share of toxic rows, so that a pair can tell
        what neither of its terms does. What noise the many terms of a long text bring is held down by the L1
        bound, which grows with a term's standard error, and by L2 on the factors; how far is chosen by
        comparing fits: each of FITS learns from three rows in four, and the one with the least log loss
        on the rest is learned again from all. A row of the rarer label counts as many times as that
        label is rarer, up to `balance`.
        """
        r = np.random.default_rng(seed)
        df = np.zeros(TERMS, np.int64)
        for i in rows:
            df[i] += 1
        terms = np.flatnonzero(df >= least)
        at = np.full(TERMS, -1)
        at[terms] = np.arange(len(terms))
        rows = [at[i][at[i] >= 0] for i in rows]
        ones = max(1.0, float(labels.sum()))
        zeros = max(1.0, len(labels) - ones)
        weight = np.where(labels > 0, np.clip(zeros / ones, 1, balance), np.clip(ones / zeros, 1, balance))
        if not len(terms):
            return cls(float(np.log(((labels * weight).sum() + 0.5) / (((1 - labels) * weight).sum() + 0.5))))
        test = np.zeros(len(rows), bool)
        for label in (0, 1):  # one row in four of each label
            test[r.permutation(np.flatnonzero(labels == label))[::4]] = True
        linear: dict[float, tuple] = {}
        losses = []
        for strict, all_terms, decay in FITS:
            own = np.flatnonzero(~test)
            if strict not in linear:
                linear[strict] = _linear(rows, labels, weight, own, len(terms), strict, l1, l2, alpha, epochs, seed)
            model = _pairs(cls, rows, labels, weight, own, linear[strict], all_terms, decay, factors, epochs, seed)
            raw = np.array([model.raw(model.own(rows[k])) for k in np.flatnonzero(test)])
            losses.append(float((weight[test] * np.logaddexp(0, np.where(labels[test] > 0, -raw, raw))).sum()))
        strict, all_terms, decay = FITS[int(np.argmin(losses))]
        every = np.arange(len(rows))
        model = _pairs(cls, rows, labels, weight, every, _linear(rows, labels, weight, every, len(terms), strict, l1, l2, alpha, epochs, seed), all_terms, decay, factors, epochs, seed)
        return cls(model.bias, terms[model.terms], model.w, model.v)

    def own(self, ids: np.ndarray) -> np.ndarray:
        """Places of those of the ascending ids that are terms of the model."""
        p = np.searchsorted(self.terms, ids)
        p[p == len(self.terms)] = 0
        return p[self.terms[p] == ids] if len(self.terms) else p[:0]


def _linear(rows, labels, weight, use, n_terms, strict, l1, l2, alpha, epochs, seed) -> tuple[float, np.ndarray]:
    """Bias and weights by FTRL-proximal over the rows `use`. A weight stays 0 while its gradients' sum is within l1
    or `strict` of its standard errors; passes over the same rows are no new evidence."""
    r = np.random.default_rng(seed)
    z, n, z0, n0 = np.zeros(n_terms), np.zeros(n_terms), 0.0, 0.0

    def weights(zi, ni, passes):
        size = np.abs(zi)
        return np.where((size <= l1) | (size <= strict * np.sqrt(ni * passes)), 0.0, -np.sign(zi) * (size - l1) / ((1 + np.sqrt(ni)) / alpha + l2))

    for e in range(epochs):
        for k in r.permutation(use):
            i = rows[k]
            zi, ni = z[i], n[i]
            w, b = weights(zi, ni, e + 1), -z0 / ((1 + np.sqrt(n0)) / alpha)
            g = 1 / (1 + np.exp(-np.clip(b + w.sum(), -35, 35))) - labels[k]
            g *= weight[k]
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[i] = ni + g * g
            z0 += g - (np.sqrt(n0 + g * g) - np.sqrt(n0)) / alpha * b
            n0 += g * g
    return float(-z0 / ((1 + np.sqrt(n0)) / alpha)), weights(z, n, epochs)


def _pairs(cls, rows, labels, weight, use, linear, all_terms, decay, factors, epochs, seed) -> FactorizationMachine:
    """AdaGrad from the linear part on, over its terms of a weight or over all terms. With all terms those without a
    weight have factors only, steps begin small, so that only factors of pairs that go on telling something grow,
    and a long row moves its score no further than a short one."""
    r = np.random.default_rng(seed)
    bias, w = linear
    kept = np.arange(len(w)) if all_terms else np.flatnonzero(w)
    at = np.full(len(w), -1)
    at[kept] = np.arange(len(kept))
    model = cls(bias, kept, w[kept].copy(), r.standard_normal((len(kept), factors)) * 0.01)
    short = {k: at[rows[k]][at[rows[k]] >= 0] for k in use}
    sw, sv, sb, rate = np.full(len(kept), 1e-6), np.full((len(kept), factors), 1.0 if all_terms else 1e-6), 1e-6, 0.05
    for _ in range(epochs):
        for k in r.permutation(use):
            p = short[k]
            g = 1 / (1 + np.exp(-np.clip(model.raw(p), -35, 35))) - labels[k]
            g *= weight[k]
            sb += g * g
            model.bias -= rate * g / np.sqrt(sb)
            if len(p):
                v = model.v[p]
                slope = v.sum(0) - v
                gw, gv = g + 1e-4 * model.w[p], g * slope + decay * v
                sw[p] += gw * gw
                sv[p] += gv * gv
                told = w[kept[p]] != 0
                model.w[p] -= told * rate * gw / np.sqrt(sw[p])
                far = 1 + rate * float((slope * slope).sum()) if all_terms else 1.0
                model.v[p] -= rate * gv / np.sqrt(sv[p]) / far
    return model


def training_rows(docs: DataFrame, labels: DataFrame, most: int, held_out: int, parts: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Terms and labels of up to `most` labelled documents outside the held-out part, at most half of
    them toxic: those with the lowest hash of their id. The bound is on documents; each is read whole."""
    known = labels.where(F.col("toxic").isNotNull() & (split_part("doc_id", parts) != held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = known.withColumn("h", F.xxhash64(F.lit("toxic"), "doc_id"))
    picked = [order.where(F.col("toxic") == y).orderBy("h").limit(n).select("doc_id", "toxic") for y, n in ((1, most // 2), (0, most - most // 2))]
    ids = picked[0].union(picked[1])

    def terms(batches):
        for text, toxic in texts(batches, "text", "toxic"):
            yield pa.RecordBatch.from_pydict({"toxic": pa.array([int(toxic)], pa.int32()), "terms": pa.array([distinct_terms(text).tolist()], pa.list_(pa.int64()))})

    # at most `most` ids, so the small side of the join is bounded
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").mapInArrow(terms, "toxic int, terms array<long>")
    got = sorted(((r["toxic"], tuple(r["terms"])) for r in found.toLocalIterator()), key=lambda x: (x[0], x[1]))
    return [np.array(t, np.int64) for _, t in got], np.array([y for y, _ in got], float)


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = 4000, parts: int = 3, held_out: int = 1, model: FactorizationMachine | None = None) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, held_out, score, predicted, n_terms).

    Labels are learned only from rows whose crc32(doc_id as text) mod `parts` isn't `held_out`, from at
    most `most` of them; a document's copies in `labels` count once, 1 if one of them is. Null and empty
    texts have no terms and get the score of the bias; repeated rows are scored each; without labels
    every score is one half. A null doc_id stays null and is in the part that the empty text's crc32 gives; null labels
    teach nothing; other columns, whatever their names, are not read. n_terms is the number of the model's
    terms in the text, which is read whole.
    """
    spark = docs.sparkSession
    if model is None:
        rows, y = training_rows(docs, labels, most, held_out, parts)
        model = FactorizationMachine.fit(rows, y) if rows else FactorizationMachine()
    figures = (model.bias, model.terms, model.w, model.v)

    def run(batches):
        fm = FactorizationMachine(*figures)
        for batch in sliced(batches):
            ids, scores, counts = batch.column("doc_id"), [], []
            for text in batch.column("text").to_pylist():
                at = fm.places(text)
                counts.append(len(at))
                scores.append(1 / (1 + np.exp(-np.clip(fm.raw(at), -35, 35))))
            out = [py_part(i, parts) == held_out for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(out, pa.bool_()), pa.array(scores, pa.float64()), pa.array([int(s >= 0.7) for s in scores], pa.int32()), pa.array(counts, pa.int64())], names=["doc_id", "held_out", "score", "predicted", "n_terms"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_terms long")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
