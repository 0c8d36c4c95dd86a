"""Main-text extraction: a bidirectional LSTM labels the blocks of a page.

A page becomes the sequence of its leaf blocks. Each block is a vector: learned vectors of its hashed tag
path and of its hashed words, and a few shape figures. A numpy BiLSTM reads the whole sequence both ways,
so that every block is judged in the light of the page. It is trained here, on a bounded sample of pages
whose semantic tags give labels, with copies of those pages in which containers are renamed and notices,
forms and comments are put in, so that it doesn't lean on one template.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import lowest_hashes, sliced, table

#: The elements that end a block of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: A new block ends an open one of these.
CLOSED_BY_NEXT = {"p": BLOCK_TAGS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
VOID = frozenset("hr".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|iframe|object|noscript|template)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>"
    r"|<(?P<raw>script|style|noscript|template)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<held>svg|iframe|object)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/a-zA-Z!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
#: What an end tag of a held element can close; comments and raw text hold none.
HELD = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template)\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<held>svg|iframe|object)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?P<empty>(?<=/))?>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_PART = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: float):
        self.path, self.text, self.linked = path, text, linked


def held_ends(page: str) -> dict[int, int]:
    """Where each svg, iframe or object that has its own end tag begins, and where that tag ends."""
    out: dict[int, int] = {}
    begun: dict[str, list[int]] = {}
    for m in HELD.finditer(page):
        if m["held"] and m["empty"] is None:
            stack = begun.setdefault(m["held"].lower(), [])
            if not m["end"]:
                stack.append(m.start())
            elif stack:
                out[stack.pop()] = m.end()
    return out


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks in page order, with white space made one space and character references decoded.

    What stands in svg, iframe and object falls out; without an end tag of its own only the tag does. A tag
    that closes itself is empty.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked = inside = 0

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append(Block(tuple(x for _, names in stack for x in names), text, min(1.0, linked / len(text))))
        held, linked = [], 0

    def text(piece: str) -> None:
        nonlocal linked
        held.append(piece)
        if inside:
            linked += len(piece)

    at = 0
    page = page or ""
    ends: dict[int, int] | None = None
    while m := TOKEN.search(page, at):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m["held"]:
            ends = held_ends(page) if ends is None else ends
            at = ends.get(m.start(), at)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            inside = 0 if m["end"] else 1
        elif tag in ("br", "wbr", "img"):
            held.append(" ")
        elif tag in BLOCK_TAGS:
            flush()
            if m["end"]:
                if any(x[0] == tag for x in stack):
                    while stack.pop()[0] != tag:
                        pass
                inside = 0
                continue
            while stack and tag in CLOSED_BY_NEXT.get(stack[-1][0], ()):
                stack.pop()
            if tag not in VOID and not m["attrs"].endswith("/"):
                names = [tag]
                for kind, a, b, c in ATTRIBUTE.findall(m["attrs"]) if m["attrs"] else ():
                    names += ["@" + x for x in NAME_PART.findall((a or b or c).lower())]
                stack.append((tag, tuple(names)))
    if at < len(page):
        text(page[at:])
    flush()
    return out


# -- vectors --------------------------------------------------------------------------------------

PATHS, WORDS, DIM, SHAPE, HIDDEN = 1 << 10, 1 << 12, 12, 6, 16
INPUT = 2 * DIM + SHAPE


def _ids(parts: Iterable[str], size: int) -> np.ndarray:
    return np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) % size for x in parts], np.int64)


def _features(page: list[Block]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of each block: path ids, word ids, shape."""
    paths, words, shape = [], [], np.zeros((len(page), SHAPE), np.float32)
    known: dict = {}
    for i, b in enumerate(page):
        if b.path not in known:
            known[b.path] = _ids([*b.path, "/".join(b.path[-2:])], PATHS)
        split = b.text.split()
        paths.append(known[b.path])
        words.append(_ids(split, WORDS))
        n = len(split)
        marks = sum(map(b.text.count, ".,;:!?"))
        shape[i] = (np.log1p(n) / 5, b.linked, marks / n, (i + 1) / len(page), 1 / (1 + i), b.text[-1] in ".!?")
    return paths, words, shape


def _means(ids: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    if not ids:
        return np.zeros((0, vectors.shape[1]), np.float32)
    sizes = np.array([len(x) for x in ids])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return np.add.reduceat(vectors[np.concatenate(ids)], starts, axis=0) / sizes[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Parameters and passes of the BiLSTM; sequences are padded at the end and masked."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        g = lambda *shape, s=0.1: (r.standard_normal(shape) * s).astype(np.float32)
        self.p = {"path": g(PATHS, DIM), "word": g(WORDS, DIM), "out": g(2 * HIDDEN, s=0.3), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p[d + "x"], self.p[d + "h"], self.p[d + "b"] = g(INPUT, 4 * HIDDEN, s=0.2), g(HIDDEN, 4 * HIDDEN, s=0.2), np.zeros(4 * HIDDEN, np.float32)
            self.p[d + "b"][HIDDEN : 2 * HIDDEN] = 1

    def inputs(self, pages: list) -> tuple[np.ndarray, np.ndarray]:
        """(time, page, INPUT) and the mask (time, page)."""
        steps = max(len(f[0]) for f in pages)
        x = np.zeros((steps, len(pages), INPUT), np.float32)
        mask = np.zeros((steps, len(pages)), np.float32)
        for i, (paths, words, shape) in enumerate(pages):
            n = len(paths)
            x[:n, i] = np.hstack([_means(paths, self.p["path"]) * 4, _means(words, self.p["word"]), shape])
            mask[:n, i] = 1
        return x, mask

    def _one_way(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        wx, wh, b = self.p[d + "x"], self.p[d + "h"], self.p[d + "b"]
        pre = x @ wx + b
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c, out, tape = h.copy(), np.zeros((*x.shape[:2], HIDDEN), np.float32), []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = pre[t] + h @ wh
            gates, new = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            c_next = f * c + i * new
            s = np.tanh(c_next)
            m = mask[t][:, None]
            if keep:
                tape.append((t, h, c, i, f, o, new, s, m))
            c, h = m * c_next + (1 - m) * c, m * (o * s) + (1 - m) * h
            out[t] = h
        return out, tape

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._one_way(x, mask, d, False)[0] for d in "fb"], axis=2)
        return _sigmoid(both @ self.p["out"] + self.p["bias"])

    def gradients(self, pages: list, labels: list[np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
        x, mask = self.inputs(pages)
        ways = {d: self._one_way(x, mask, d, True) for d in "fb"}
        both = np.concatenate([ways[d][0] for d in "fb"], axis=2)
        p = _sigmoid(both @ self.p["out"] + self.p["bias"])
        y = np.zeros_like(p)
        for i, one in enumerate(labels):
            y[: len(one), i] = one
        n = mask.sum()
        delta = (p - y) * mask / n
        loss = -float((mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / n)
        g = {"out": np.einsum("tp,tph->h", delta, both), "bias": delta.sum(keepdims=True).reshape(1), "path": np.zeros_like(self.p["path"]), "word": np.zeros_like(self.p["word"])}
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            up = delta[:, :, None] * self.p["out"][k * HIDDEN : (k + 1) * HIDDEN]
            wh, wx = self.p[d + "h"], self.p[d + "x"]
            gz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc, gh = dh.copy(), np.zeros_like(wh)
            for t, h, c, i, f, o, new, s, m in reversed(ways[d][1]):
                dh = dh + up[t]
                live = dh * m
                dct = dc * m + live * o * (1 - s * s)
                dz = np.hstack([dct * new * i * (1 - i), dct * c * f * (1 - f), live * s * o * (1 - o), dct * i * (1 - new * new)])
                gz[t] = dz
                gh += h.T @ dz
                dh, dc = dh * (1 - m) + dz @ wh.T, dc * (1 - m) + dct * f
            g[d + "h"], g[d + "b"] = gh, gz.sum((0, 1))
            g[d + "x"] = np.einsum("tpi,tpz->iz", x, gz)
            dx += gz @ wx.T
        for i, (paths, words, _) in enumerate(pages):
            for name, ids, part, scale in (("path", paths, slice(0, DIM), 4), ("word", words, slice(DIM, 2 * DIM), 1)):
                sizes = np.array([len(v) for v in ids])
                np.add.at(g[name], np.concatenate(ids), np.repeat(scale * dx[: len(ids), i, part] / sizes[:, None], sizes, axis=0))
        return loss, g

    def fit(self, pages: list, labels: list[np.ndarray], epochs: int, rate: float = 0.01, seed: int = 3, batch: int = 24) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        r, first, second, step, losses = np.random.default_rng(seed), {}, {}, 0, []
        for _ in range(epochs):
            order, total = r.permutation(len(pages)), []
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                loss, g = self.gradients([pages[i] for i in own], [labels[i] for i in own])
                total.append(loss)
                step += 1
                for k, v in g.items():
                    v = np.clip(v, -1, 1)
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * v
                    second[k] = 0.99 * second.get(k, 0) + 0.01 * v * v
                    self.p[k] = (self.p[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            losses.append(float(np.mean(total)))
        return losses


# -- training -------------------------------------------------------------------------------------

#: Where main text and everything else stand in pages, by element and class names.
MAIN = (("article",), ("main",), ("div", "@content"), ("div", "@post", "@body"), ("section", "@article"), ("div", "@entry", "@content"), ("main", "@main"))
ASIDE = {
    "menu": (("nav",), ("ul", "@menu"), ("header",), ("div", "@nav", "@bar"), ("div", "@breadcrumb")),
    "end": (("footer",), ("div", "@footer"), ("section", "@footer")),
    "more": (("aside",), ("div", "@ad"), ("div", "@advert"), ("div", "@sidebar"), ("div", "@cookie", "@notice"), ("form",), ("div", "@newsletter"), ("div", "@related"), ("div", "@banner"), ("div", "@share")),
    "said": (("section", "@comments"), ("div", "@comment", "@list"), ("ol", "@comments"), ("div", "@comment")),
}
ADVERTS = frozenset("@ad @ads @advert @advertisement @sidebar @promo @comment @comments @notice @cookie @banner @share @related @newsletter @menu @nav @footer".split())


def weak_labels(page: list[Block], guess: bool = False) -> np.ndarray | None:
    """1 for blocks of an article (or, without one, of main). If the page has neither: None, or with `guess`
    1 for what stands in no menu, header, footer, form, advert or the like and isn't mostly links."""
    for inside in ("article", "main"):
        if any(inside in b.path for b in page):
            return np.array([inside in b.path and not ({"nav", "aside", "footer", "form", "header"} | ADVERTS) & set(b.path[b.path.index(inside) :]) for b in page], np.float32)
    if not guess:
        return None
    apart = {"head", "nav", "aside", "footer", "form", "header"} | ADVERTS
    return np.array([not apart & set(b.path) and b.linked < 0.5 for b in page], np.float32)


def varied(page: list[Block], labels: np.ndarray, others: list[str], r: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page in another template: other containers, and notices, forms and comments put in."""
    pick = lambda options: options[r.integers(len(options))]
    main, menu, end, more = pick(MAIN), pick(ASIDE["menu"]), pick(ASIDE["end"]), pick(ASIDE["more"])
    wrap = pick([(), ("div", "@page"), ("div", "@wrapper", "div"), ("div", "@container")])
    out, marks = [], []
    for b, y in zip(page, labels, strict=True):
        path = list(b.path)
        if "head" in path:
            new = path
        elif y:
            new = ["html", "body", *wrap, *main, *(x for x in path[-1:] if x not in MAIN[0])]
        else:
            kind = menu if "nav" in path else end if "footer" in path else more
            new = ["html", "body", *wrap, *kind, *(("ul", "li") if path[-1:] == ["li"] else pick([(), ("p",), ("div",), ("h1",), ("h2",), ("span",)]))]
        out.append(Block(tuple(new), b.text, b.linked))
        marks.append(float(y))
    places = [i for i, y in enumerate(marks) if y]
    if places and others:
        for kind in ("more", "said", "more"):
            if r.random() < 0.6:
                inner = r.random() < 0.5
                at = int(places[-1]) + 1 if kind == "said" else int(pick(places)) if inner else int(places[0])
                path = ("html", "body", *wrap, *(main if inner else ()), *pick(ASIDE[kind]), "p")
                for _ in range(int(r.integers(1, 4))):
                    out.insert(at, Block(path, pick(others), float(r.random() < 0.2)))
                    marks.insert(at, 0.0)
                places = [i for i, y in enumerate(marks) if y]
    return out, np.array(marks, np.float32)


def train(samples: list[str], epochs: int = 6, seed: int = 11, most_blocks: int = 400, most_texts: int = 5000) -> Labeller:
    """A labeller from pages; of each, once as it is and twice varied, its first most_blocks blocks each time. What is
    put into other pages comes from most_texts blocks."""
    r = np.random.default_rng(seed)
    found = [b for b in map(blocks_of, samples) if b]
    parsed = [(b, y) for b, y in ((b, weak_labels(b)) for b in found) if y is not None] or [(b, weak_labels(b, True)) for b in found]
    model = Labeller()
    if not parsed:
        return model
    others = [b.text for page, y in parsed for b, one in zip(page, y, strict=True) if one][:most_texts]
    pages = [(b[:most_blocks], y[:most_blocks]) for page in parsed for b, y in (page, varied(*page, others, r), varied(*page, others, r))]
    model.fit([_features(b) for b, _ in pages], [y for _, y in pages], epochs)
    return model


def sample_pages(pages: DataFrame, most: int, longest: int = 200_000) -> list[str]:
    """Up to `most` pages of 200 to `longest` characters, those with the lowest hash of their id: what comes to the driver
    is bounded."""
    whole = pages.where(F.length("html").between(200, longest)).select("page_id", "html")
    return sorted(r["html"] for r in lowest_hashes(whole, most, "page_id").limit(most).collect())


def extract(pages: DataFrame, model: Labeller | None = None, train_pages: int = 240, train_blocks: int = 400, train_chars: int = 200_000, least: float = 0.5) -> DataFrame:
    """pages(page_id, url, html, ...) to (page_id, url, text, n_chars, n_blocks, n_main).

    A null or empty html, or one without text, gives an empty text; nothing is cut. Blocks stay in page
    order, repeated rows and blocks too; null ids and urls stay null; other columns, whatever their names, are
    not read. Every page is labelled whole. Without a model one is fitted on a bounded sample: up to
    `train_pages` pages of at most `train_chars` characters, of each the first `train_blocks` blocks; if none of
    them has an article or main element, its labels are guesses from the other elements.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast((model or train(sample_pages(pages, train_pages, train_chars), most_blocks=train_blocks)).p)

    def run(batches):
        labeller = Labeller()
        labeller.p = shared.value
        for batch in sliced(batches):
            parsed = [blocks_of(x) for x in batch.column("html").to_pylist()]
            chosen: list[list[str]] = [[] for _ in parsed]
            order = sorted((i for i, x in enumerate(parsed) if x), key=lambda i: len(parsed[i]))
            while order:
                take = max(1, min(128, 60_000 // len(parsed[order[-1]])))
                own, order = order[-take:], order[:-take]
                p = labeller.probabilities(*labeller.inputs([_features(parsed[i]) for i in own]))
                for k, i in enumerate(own):
                    chosen[i] = [b.text for b, x in zip(parsed[i], p[:, k], strict=False) if x >= least]
            out = ["\n\n".join(x) for x in chosen]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64()), pa.array([len(x) for x in parsed], pa.int64()), pa.array([len(x) for x in chosen], pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_main"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_blocks long, n_main long")


def op10_html_blocks(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
