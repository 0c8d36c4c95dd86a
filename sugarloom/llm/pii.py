"""Personal data by a semi-Markov conditional random field.

Fixed patterns find the plain cases. The model looks at the stretches of text around digits and signs
that could hold more: it scores whole segments (their shape, digits, checks, what stands before and
after), and bounded-length dynamic programming chooses boundaries and types together. It is trained here
on such stretches: those that the patterns label, in their own and in other spellings.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import lowest_hashes, sliced, table

KINDS = ("email", "ip", "card", "phone")
_RANK = {k: i for i, k in enumerate(KINDS)}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind.

    Each search is linear in the text: a local part is the run before its @, and an address's first
    part can't begin inside a run of digits, as it would end where the run does all the same.
    """
    out: list[tuple[str, int, int]] = []
    if not text:
        return out
    end, at = 0, text.find("@")
    while at >= 0:
        if at >= end:
            start = at
            while start > end and LOCAL.match(text[start - 1]):
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                end = m.end()
                out.append(("email", start, end))
        at = text.find("@", at + 1)
    if DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split("."))]
        out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 14 <= len(d := only_digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(only_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], _RANK[x[0]], x[2]))


def spelled(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# -- stretches and their atoms --------------------------------------------------------------------

#: Where a segment could be: at least seven signs of a number, or words around an @ or its spelling.
NUMBERS = re.compile(r"[+(]?[0-9](?:[0-9]|[\x20().:/+-](?=[\x20().:/+-]?[0-9(+]))*[0-9]")
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:\x20?@\x20?|\x20?[(\[]at[)\]]\x20?|\x20at\x20(?=[A-Za-z0-9-]{1,63}\x20dot\x20))[A-Za-z0-9-]{1,63}(?:(?:\x20?\.\x20?|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63})*")
ATOM = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
MOST_ATOMS = 25
LABELS = ("O", *KINDS)


def stretches(text: str) -> list[tuple[int, int]]:
    found = [(m.start(), m.end()) for m in NUMBERS.finditer(text) if sum("0" <= c <= "9" for c in m[0]) >= 7] if DIGIT.search(text) else []
    if "@" in text or "(at" in text or "[at" in text or " at " in text and " dot " in text:
        found += [(m.start(), m.end()) for m in ADDRESS.finditer(text)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def atoms_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in ATOM.finditer(text, start, end)]


def shape(s: str) -> str:
    """Groups of digits and letters by length, all other signs as they are."""
    out = []
    for m in ATOM.finditer(s):
        c = m[0][0]
        out.append(f"d{min(len(m[0]), 9)}" if "0" <= c <= "9" else "w" if c.isalpha() and c.isascii() else c)
    return "".join(out)


def segment_features(text: str, a: int, b: int) -> list[str]:
    """Features of the whole span text[a:b] and of the signs beside it."""
    s = text[a:b]
    digits = only_digits(s)
    n = len(digits)
    letters = any(c.isalpha() for c in s)
    before, after = text[max(0, a - 1) : a], text[b : b + 1]
    edge = lambda c: "none" if not c else "digit" if c.isdigit() else "word" if c.isalpha() else c if c in "+-.@/:(" else "other"
    groups = re.findall(r"[0-9]+", s)
    out = [
        "bias",
        f"n{n}",
        f"sep{'+'.join(sorted({c for c in s if not c.isalnum()}))[:12]}",
        f"before {edge(before)}",
        f"after {edge(after)}",
        f"ends {edge(s[0])} {edge(s[-1])}",
    ]
    if not letters:
        out.append("shape " + shape(s))
        if 14 <= n <= 19:
            out.append(f"luhn {luhn(digits)}")
            out.append(f"plain {all(c in ' -' or c.isdigit() for c in s)} luhn {luhn(digits)}")
        if 10 <= n <= 15:
            out.append(f"phone-length plus {s[0] == '+'} grouped {len(groups) >= 3}")
        if len(groups) == 4 and s.count(".") == 3:
            out.append(f"octets {all(len(g) < 4 and int(g) < 256 for g in groups)}")
    sign = "@" if "@" in s else "at" if re.search(r"[\s(\[]at[\s)\]]", s) else ""
    if sign:
        host = re.split(r"@|[\s(\[]at[\s)\]]", s, maxsplit=1)[1].strip()
        dotted = bool(re.search(r"[A-Za-z0-9](?:\x20?\.\x20?|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z]{2,}$", host))
        out += [f"sign {sign}", f"host {dotted}", f"sign {sign} host {dotted} after {edge(after)}"]
    return out


class SemiCRF:
    """Log-linear over (label, feature) of segments and label pairs; weights are a plain dictionary."""

    def __init__(self, weights: dict[tuple, float] | None = None):
        self.w = dict(weights or {})  # read with get(): features of texts must not gather here

    def _segments(self, text: str, atoms: list[tuple[int, int]]) -> list[list[tuple[int, list[str] | None]]]:
        """Of each end: its segments as (begin, features); outside is one atom long and has none."""
        out = []
        for j in range(1, len(atoms) + 1):
            own: list[tuple[int, list[str] | None]] = [(j - 1, None)]
            for i in range(j - 1, max(-1, j - 1 - MOST_ATOMS), -1):
                s, e = atoms[i][0], atoms[j - 1][1]
                if text[s] not in " )-.:/" and text[e - 1] not in " (-.:/+" and e - s >= 7:
                    own.append((i, segment_features(text, s, e)))
            out.append(own)
        return out

    def _score(self, label: str, features: list[str] | None, length: int = 1) -> float:
        if features is None:
            return self.w.get(("O", "atom"), 0.0)
        return sum(self.w.get((label, f), 0.0) for f in features)

    def decode(self, text: str, atoms: list[tuple[int, int]], segments=None) -> tuple[list[tuple[str, int, int]], float]:
        """The best segmentation: spans of the kinds, by Viterbi over (end, last label is outside)."""
        segments = segments or self._segments(text, atoms)
        n, turn = len(atoms), self.w.get(("after", "segment"), 0.0)
        best, back = [[0.0, -math.inf]] + [[-math.inf, -math.inf] for _ in range(n)], [[None, None] for _ in range(n + 1)]
        for j in range(1, n + 1):
            for i, f in segments[j - 1]:
                was = 0 if best[i][0] >= best[i][1] + turn else 1
                if f is None:
                    options = [("O", self._score("O", None))]
                else:
                    options = [max(((k, self._score(k, f)) for k in KINDS), key=lambda x: x[1])]
                for k, s in options:
                    to = 0 if k == "O" else 1
                    # a segment may not touch the one before it
                    value, came = (best[i][was] + (turn if was else 0.0) + s, was) if to == 0 else (best[i][0] + s, 0)
                    if value > best[j][to]:
                        best[j][to], back[j][to] = value, (i, k, came)
        at, now, spans = n, 0 if best[n][0] >= best[n][1] else 1, []
        while at:
            i, k, came = back[at][now]
            if k != "O":
                spans.append((k, atoms[i][0], atoms[at - 1][1]))
            at, now = i, came
        return spans[::-1], max(best[n])

    def _logsum(self, text: str, atoms, segments):
        """Forward and backward log sums over (end, 0 outside / 1 segment)."""
        n = len(atoms)
        f, b = np.full((n + 1, 2), -np.inf), np.full((n + 1, 2), -np.inf)
        f[0, 0] = 0.0
        scored = [[(i, None if x is None else [self._score(k, x) for k in KINDS]) for i, x in own] for own in segments]
        out, turn = self._score("O", None), self.w.get(("after", "segment"), 0.0)
        for j in range(1, n + 1):
            for i, s in scored[j - 1]:
                if s is None:
                    f[j, 0] = np.logaddexp(f[j, 0], np.logaddexp(f[i, 0], f[i, 1] + turn) + out)
                else:
                    f[j, 1] = np.logaddexp(f[j, 1], f[i, 0] + np.logaddexp.reduce(s))
        b[n] = 0.0
        for j in range(n, 0, -1):
            for i, s in scored[j - 1]:
                if s is None:
                    b[i, 0] = np.logaddexp(b[i, 0], b[j, 0] + out)
                    b[i, 1] = np.logaddexp(b[i, 1], b[j, 0] + out + turn)
                else:
                    b[i, 0] = np.logaddexp(b[i, 0], b[j, 1] + np.logaddexp.reduce(s))
        return f, b, scored, np.logaddexp(f[n, 0], f[n, 1])

    def fit(self, examples: list[tuple[str, int, int, list[tuple[str, int, int]]]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> list[float]:
        """Gradient ascent on the conditional log-likelihood (AdaGrad); the mean of each epoch."""
        r, squares, means = np.random.default_rng(seed), defaultdict(float), []
        ready = []
        for text, a, b, gold in examples:
            atoms = atoms_of(text, a, b)
            starts, ends = {x: i for i, (x, _) in enumerate(atoms)}, {y: i + 1 for i, (_, y) in enumerate(atoms)}
            segments = self._segments(text, atoms)
            marks = [(k, starts.get(s), ends.get(e)) for k, s, e in gold]
            if all(x is not None and y is not None and any(i == x and f is not None for i, f in segments[y - 1]) for _, x, y in marks):
                ready.append((text, atoms, segments, marks))
        for _ in range(epochs):
            total = []
            for at in r.permutation(len(ready)):
                text, atoms, segments, marks = ready[at]
                f, b, scored, z = self._logsum(text, atoms, segments)
                g: dict[tuple, float] = defaultdict(float)
                gold_score, held = 0.0, {(x, y): k for k, x, y in marks}
                inside = sum(y - x for _, x, y in marks)
                g["O", "atom"] += len(atoms) - inside
                turns = sum(1 for _, _, y in marks if y < len(atoms))
                g["after", "segment"] += turns
                out, turn = self.w.get(("O", "atom"), 0.0), self.w.get(("after", "segment"), 0.0)
                gold_score += (len(atoms) - inside) * out + turns * turn
                for j, own in enumerate(segments, 1):
                    for (i, x), (_, s) in zip(own, scored[j - 1], strict=True):
                        if x is None:
                            p0 = math.exp(min(0.0, f[i, 0] + out + b[j, 0] - z))
                            p1 = math.exp(min(0.0, f[i, 1] + turn + out + b[j, 0] - z))
                            g["O", "atom"] -= p0 + p1
                            g["after", "segment"] -= p1
                            continue
                        right = held.get((i, j))
                        for k, v in zip(KINDS, s, strict=True):
                            p = math.exp(min(0.0, f[i, 0] + v + b[j, 1] - z))
                            step = (k == right) - p
                            if right == k:
                                gold_score += v
                            if abs(step) > 1e-4:
                                for feature in x:
                                    g[k, feature] += step
                for key, v in g.items():
                    v -= decay * self.w.get(key, 0.0)
                    squares[key] += v * v
                    self.w[key] = self.w.get(key, 0.0) + rate * v / (1e-6 + math.sqrt(squares[key]))
                total.append(gold_score - z)
            means.append(float(np.mean(total)) if total else 0.0)
        return means


# -- training -------------------------------------------------------------------------------------


def respelled(kind: str, s: str, r: np.random.Generator) -> list[tuple[str | None, str]]:
    """Other spellings of a labelled span, and near misses that are none: (kind or None, text)."""
    d = only_digits(s)
    if kind == "phone" and len(d) >= 10:
        a, b, c = d[-10:-7], d[-7:-4], d[-4:]
        return [("phone", x) for x in (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"00{d[:-10]} {a} {b} {c}", f"({a}) {b} {c}")] + [
            (None, f"{a}{b}"),
            (None, f"20{a[:2]}-{b[:2]}-{c[:2]}"),
            (None, f"{a}{b}{c}{a}{b}{c}"),
            (None, f"20{a[:2]}-{b[:2]}-{c[:2]} {d[-2:]}:{b[1:]}"),
            (None, f"{b[:2]}.{c[:2]}.20{a[:2]} {c[2:]}:{a[1:]}:{b[1:]}"),
            (None, f"{a},{b},{c}.{a[:2]}"),
            (None, d[-10:]),
        ]
    if kind == "card":
        wrong = d[:-1] + str((int(d[-1]) + int(r.integers(1, 9))) % 10)
        grouped = " . ".join(d[i : i + 4] for i in range(0, len(d), 4))
        return [("card", ".".join(d[i : i + 4] for i in range(0, len(d), 4))), (None, wrong), (None, d[:12]), (None, d + d[:8]), (None, " ".join(wrong[i : i + 4] for i in range(0, len(d), 4))), (None, grouped)]
    if kind == "ip":
        p = s.split(".")
        return [(None, f"{int(p[0]) + 256}.{p[1]}.{p[2]}.{p[3]}"), (None, f"{p[0]}.{p[1]}.{p[2]}"), (None, f"{p[0]}.{p[1]}.{p[2]}.{p[3]}.{p[0]}.{p[1]}")]
    name, _, host = s.partition("@")
    name = name.rsplit(".", 1)[0] if name.endswith(".") else name
    dots = host.split(".")
    return [("email", f"{name} at {' dot '.join(dots)}"), ("email", f"{name} (at) {' (dot) '.join(dots)}"), ("email", f"{name}[at]{'[dot]'.join(dots)}"), ("email", f"{name} @ {host}"), (None, f"{name}@{dots[0]}"), (None, f"{name} at {dots[0]}")]


def examples_of(texts: list[str], most: int = 1500, longest: int = 200, seed: int = 9) -> list[tuple[str, int, int, list[tuple[str, int, int]]]]:
    """(text, start, end, spans) of up to `most` stretches of at most `longest` characters: as found, and respelled in the
    same surroundings."""
    r, out = np.random.default_rng(seed), []
    for text in texts:
        spans = base_spans(text)
        for a, b in stretches(text):
            if b - a > longest:
                continue
            own = [x for x in spans if a <= x[1] and x[2] <= b]
            left, right = text[max(0, a - 12) : a], text[b : b + 12]
            piece = left + text[a:b] + right
            move = len(left) - a
            out.append((piece, len(left), len(left) + b - a, [(k, s + move, e + move) for k, s, e in own]))
            if len(own) == 1:
                kind, s, e = own[0]
                options = respelled(kind, text[s:e], r)
                for i in r.permutation(len(options))[:4]:
                    k, new = options[i]
                    piece = f"{left} {new} {right}"
                    for x, y in stretches(piece):
                        if x <= len(left) + 1 < y and base_spans(piece[x:y]) == []:
                            ends = len(left) + 1 + len(new)
                            out.append((piece, x, y, [(k, len(left) + 1, ends)] if k and y >= ends else []))
        if len(out) >= most:
            break
    return out[:most]


def train(texts: list[str], most: int = 1500, longest: int = 200) -> SemiCRF:
    """A model of up to `most` stretches of at most `longest` characters."""
    model = SemiCRF()
    model.fit(examples_of(texts, most, longest))
    model.w = {k: round(v, 4) for k, v in model.w.items() if abs(v) > 1e-3}
    return SemiCRF(model.w)


def sample_texts(docs: DataFrame, most: int, longest: int = 50_000) -> list[str]:
    """Up to `most` texts of under `longest` characters that hold an @ or seven signs of a number, those with the lowest
    hash: what comes to the driver is bounded."""
    kept = docs.where(F.col("text").rlike(r"@|[0-9]([\x20().+-]?[0-9]){6}") & (F.length("text") < longest))
    return sorted(r["text"] for r in lowest_hashes(kept.select("text"), most, "text").limit(most).collect())


# -- operator -------------------------------------------------------------------------------------


def all_spans(text: str | None, model: SemiCRF, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans and those that the model adds beside them."""
    out = list(base)
    if text:
        ordered, at, near = sorted((s, e) for _, s, e in base), 0, []
        for a, b in stretches(text):
            # stretches and spans go forward together: near are the spans that reach into this stretch
            near = [x for x in near if x[1] > a]
            while at < len(ordered) and ordered[at][0] < b:
                if ordered[at][1] > a:
                    near.append(ordered[at])
                at += 1
            if any(s <= a and b <= e for s, e in near):
                continue
            # what the fixed patterns leave free, of which spans may lie in one another
            free = a
            for x, y in [*near, (b, b)]:
                if x - free >= 7:
                    out += model.decode(text, atoms_of(text, free, x))[0]
                free = max(free, y)
    return sorted(out, key=lambda x: (x[1], _RANK[x[0]], x[2]))


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    if not text or not spans:
        return text
    parts, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(parts) + text[at:]


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string, redacted string"


def find_pii(docs: DataFrame, model: SemiCRF | None = None, train_texts: int = 600, train_examples: int = 1500, train_chars: int = 50_000, redact: bool = True) -> DataFrame:
    """All columns of docs(text, ...) plus those of FOUND; counts are of the fixed patterns' spans.

    Spans are kind:start:end in code points, by start, then kind, comma-joined. A null text has none and
    stays null when redacted; an empty table gives no rows; columns named as in FOUND give way. Without a
    model one is fitted on a bounded sample: up to `train_examples` stretches of up to `train_texts` texts of
    under `train_chars` characters; with none that hold a number, it adds no spans. A segment of the model spans
    at most MOST_ATOMS atoms, as bounded-entity decoding has it; texts are read whole.
    """
    spark = docs.sparkSession
    names = [x.split()[0] for x in FOUND.split(", ")]
    docs = docs.drop(*names)
    weights = (model or train(sample_texts(docs, train_texts, train_chars), train_examples)).w

    def run(batches):
        crf = SemiCRF(weights)
        for batch in sliced(batches):
            cols: list[list] = [[] for _ in names]
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                spans = all_spans(text, crf, base) if crf.w else base
                row = (*(sum(k == x for x, _, _ in base) for k in KINDS), spelled(base), spelled(spans), redacted(text, spans) if redact else None)
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            kinds = (*(pa.int64(),) * 4, *(pa.string(),) * 3)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, {FOUND}")


def op7_pii(spark, sf_dir: str) -> DataFrame:
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), redact=False)
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
