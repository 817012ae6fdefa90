"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its leaf blocks. Each block has a vector of its tag path and one of its hashed words.
A bidirectional LSTM reads the whole sequence and labels every block, so that what surrounds a block counts as well.
The labeller is trained on a bounded sample of pages, half of them with furniture of other sites put in, on the labels
that plain markup gives; pages to be labelled are read whole, whatever their size.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, SAMPLE_CHARS = 400, 40_000
PATH_DIM, WORD_DIM, HIDDEN = 48, 24, 16
# Pages that are read at once, and padded blocks that are labelled at once (one page at least).
PAGES_AT_ONCE, BLOCKS_AT_ONCE = 256, 1 << 16

# A quote opens a value only behind "=".
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z0-9]+")
# Content of these is no text of the page.
SILENT = frozenset("script style noscript template head title svg math iframe object textarea select".split())
# Of these, those in which nothing is markup but their own end tag.
RAW_ENDS = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I | re.A) for t in "script style noscript title iframe textarea".split()}
OBJECT_END = re.compile(r"</object(?=[\s/>]|\Z)", re.I | re.A)
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
# What stands in a list to select from, or is silent itself.
LISTED = SILENT | {"option", "optgroup", "hr", "param", "embed"}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# A start tag that ends an open element of the same kind.
ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
# Names in tags, classes, ids and roles that mark what is not the article, and what is.
AWAY = frozenset("nav header footer aside form menu ad ads advert advertisement banner sidebar notice cookie consent comment comments reply breadcrumb breadcrumbs share social related promo newsletter login search button navigation complementary contentinfo".split())
INSIDE = frozenset("article main".split())
# Tags that are furniture whatever they hold.
APART = frozenset("nav aside footer".split())


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int
    inside: bool
    away: bool


@dataclass(eq=False)
class _Open:
    tag: str
    names: frozenset[str] = field(default_factory=frozenset)
    # Holds the article, or is it: names of furniture say nothing of what stands in it.
    wraps: bool = False

    @property
    def away(self) -> frozenset[str]:
        return frozenset() if self.wraps or self.tag in ("html", "body") else self.names & AWAY


def _mark_wrappers(found: list[tuple[list[_Open], str, int]]) -> None:
    """Choose the article among the elements named so, by the text that is in no other of them, and mark what holds it.

    One that is furniture by its own names or stands in some by tag is chosen only where no other is; one that is named
    so by class or id alone, and as furniture as well (main-menu), never.
    """
    chars: dict[_Open, list] = {}
    for stack, text, _ in found:
        at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].names & INSIDE and (stack[i].tag in INSIDE or not stack[i].names & AWAY) and stack[i].tag not in ("html", "body")), None)
        if at is not None:
            clean = not stack[at].names & AWAY and not any(o.tag in APART for o in stack[:at])
            chars.setdefault(stack[at], [clean, 0, stack[: at + 1]])[1] += len(text)
    if chars:
        for o in max(chars.values(), key=lambda c: c[:2])[2]:
            o.wraps = o.tag not in APART


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: runs of text between the borders of block elements, references decoded."""
    stack, found, held, linked, at, silent, closed, links = [], [], [], 0, 0, None, True, 0

    def close() -> None:
        nonlocal held, linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            found.append((stack.copy(), text, min(linked, len(text))))
        held, linked = [], 0

    while m := TOKEN.search(page, at):
        if silent is None and m.start() > at:
            part = page[at : m.start()]
            held.append(part)
            linked += len(part) if links else 0
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if silent and tag not in INLINE and tag not in LISTED and not closed:
            silent = None  # left open: what cannot stand in it ends it
        if silent is not None:
            if m[1] and tag == silent:
                silent = None
            elif not m[1] and tag in ("script", "style") and not m[3].endswith("/") and (end := RAW_ENDS[tag].search(page, at)):
                at = end.start()
            continue
        if m[1]:
            if tag in INLINE:
                links -= tag == "a" and links > 0
            elif any(o.tag == tag for o in stack):
                close()
                while stack and stack.pop().tag != tag:
                    pass
            continue
        if tag in RAW_ENDS:
            end = RAW_ENDS[tag].search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag in SILENT:
            if tag != "head" and not (tag in ("svg", "math") and m[3].endswith("/")):
                silent, closed = tag, tag != "select" and (tag != "object" or OBJECT_END.search(page, at) is not None)
            continue
        if tag == "br":
            held.append(" ")
        if tag in VOID:
            continue
        if tag in INLINE:
            links += tag == "a"
            continue
        close()
        links = 0
        ends = ENDS.get(tag, {"p"} if tag in ("div", "article", "section", "ul", "ol", "table", "footer", "aside", "nav", "h1", "h2", "h3", "h4", "h5", "h6", "form", "header", "main") else ())
        while stack and stack[-1].tag in ends:
            stack.pop()
        values = " ".join(next(filter(None, x), "") for x in NAMES.findall(m[3])) if "=" in m[3] else ""
        stack.append(_Open(tag, frozenset([tag, *PART.findall(values.lower())])))
    if silent is None and at < len(page):
        held.append(page[at:])
    close()
    _mark_wrappers(found)
    out = []
    for around, text, in_links in found:
        path = tuple(n for o in around for n in sorted(o.names - AWAY | o.away))
        out.append(Block(path, text, in_links, any(o.names & INSIDE for o in around), any(o.away for o in around) and not _header_of_article(around)))
    return out


def _header_of_article(stack: list[_Open]) -> bool:
    """A header element inside the article holds its title."""
    away = [o for o in stack if o.away]
    inside = next((i for i, o in enumerate(stack) if o.names & INSIDE), None)
    return inside is not None and all(o.tag == "header" and stack.index(o) > inside and not (o.names - {"header"}) & AWAY for o in away)


def _bag(words: list[str], size: int, into: np.ndarray) -> None:
    if words:
        into += np.bincount([zlib.crc32(w.encode()) % size for w in words], minlength=size) / len(words) ** 0.5


def vectors(page: list[Block]) -> np.ndarray:
    """A row per block: its tag path, its hashed words, and a few measures."""
    out = np.zeros((len(page), PATH_DIM + WORD_DIM + 6), dtype=np.float32)
    for i, b in enumerate(page):
        # Names that mark furniture or article have places of their own; all other names share the rest.
        away, inside = AWAY & set(b.path), INSIDE & set(b.path)
        _bag([n for n in b.path if n not in away], PATH_DIM, out[i, :PATH_DIM])
        words = b.text.split()
        _bag(words, WORD_DIM, out[i, PATH_DIM : PATH_DIM + WORD_DIM])
        out[i, -6:] = (len(away) > 0, len(inside) > 0, np.log1p(len(words)) / 5, b.linked / (len(b.text) + 1), sum(map(b.text.count, ".,!?")) / (len(words) + 1), i / len(page))
    return out


class Labeller:
    """Bidirectional LSTM over block vectors; all weights are numpy arrays in `w`."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w

    @classmethod
    def fresh(cls, inputs: int, seed: int = 3) -> Labeller:
        r = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w[f"x{side}"] = r.normal(0, inputs**-0.5, (inputs, 4 * HIDDEN))
            w[f"h{side}"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            w[f"c{side}"] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
        w["out"] = r.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN)
        w["bias"] = np.zeros(1)
        return cls(w)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, learn: bool):
        """States of one direction for pages x blocks x inputs; padded steps keep the state. To learn, all gates are kept."""
        n, steps = x.shape[:2]
        gates = x @ self.w[f"x{side}"] + self.w[f"c{side}"]
        h, c, kept = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), []
        out = np.zeros((n, steps, HIDDEN))
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            a = gates[:, t] + h @ self.w[f"h{side}"]
            s = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(a[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new = f * c + i * g
            th = np.tanh(new)
            if learn:
                kept.append((t, h, c, i, f, o, g, th, m))
            c, h = np.where(m, new, c), np.where(m, o * th, h)
            out[:, t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray, learn: bool = True):
        f, kept_f = self._run(x, mask, "f", learn)
        b, kept_b = self._run(x, mask, "b", learn)
        both = np.concatenate((f, b), axis=2)
        return 1 / (1 + np.exp(-(both @ self.w["out"] + self.w["bias"]))), both, kept_f, kept_b

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, both, kept_f, kept_b = self.forward(x, mask)
        d = np.where(mask, p - y, 0) / max(1, mask.sum())
        grads = {"out": np.einsum("nt,nth->h", d, both), "bias": np.array([d.sum()])}
        spread = d[:, :, None] * self.w["out"]
        for side, kept, part in (("f", kept_f, spread[:, :, :HIDDEN]), ("b", kept_b, spread[:, :, HIDDEN:])):
            gx, gh, gc = (np.zeros_like(self.w[k + side]) for k in "xhc")
            dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            for t, h, c, i, f, o, g, th, m in reversed(kept):
                dh = dh + part[:, t]
                live_h, live_c = np.where(m, dh, 0), np.where(m, dc, 0)
                dnew = live_c + live_h * o * (1 - th * th)
                da = np.concatenate((dnew * g * i * (1 - i), dnew * c * f * (1 - f), live_h * th * o * (1 - o), dnew * i * (1 - g * g)), axis=1)
                gx += x[:, t].T @ da
                gh += h.T @ da
                gc += da.sum(axis=0)
                dh = np.where(m, da @ self.w[f"h{side}"].T, dh)
                dc = np.where(m, dnew * f, dc)
            grads |= {f"x{side}": gx, f"h{side}": gh, f"c{side}": gc}
        return grads

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of being main text for each block of each page, pages of like length together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            longest = len(pages[order[start]])
            some = max(1, min(PAGES_AT_ONCE, BLOCKS_AT_ONCE // (2 * longest + 8)))
            group = [i for i in order[start : start + some] if len(pages[i]) <= 2 * longest + 8]
            x, mask = padded([pages[i] for i in group])
            p = self.forward(x, mask, learn=False)[0]
            for row, i in enumerate(group):
                out[i] = p[row, : len(pages[i])]
            start += len(group)
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((len(pages), steps, pages[0].shape[1]), dtype=np.float32)
    mask = np.zeros((len(pages), steps), dtype=bool)
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, True
    return x, mask


def furnished(page: str, seed: int) -> str:
    """The page with furniture of other sites around and in its article, made of the page's own words."""
    r = np.random.default_rng(seed)
    words = re.findall(r"[^\W\d_]{2,}", page)[:400] or ["text"]
    some = lambda n: " ".join(r.choice(words, n))
    shapes = (
        lambda: f"<header><h2>{some(3)}</h2><p>{some(8)}.</p></header>",
        lambda: f'<aside class="sidebar"><h3>{some(2)}</h3><p>{some(30)}.</p><p>{some(12)}.</p></aside>',
        lambda: f'<div class="cookie-notice"><p>{some(20)}.</p></div>',
        lambda: f"<form><label>{some(2)}</label><p>{some(6)}</p></form>",
        lambda: f'<section id="comments" class="comments"><div class="comment"><p>{some(25)}.</p></div><div class="comment"><p>{some(15)}!</p></div></section>',
        lambda: f'<div class="related-posts"><ul><li><a href="#">{some(5)}</a></li><li><a href="#">{some(6)}</a></li></ul></div>',
        lambda: f'<div class="advert">{some(10)}</div>',
    )
    for shape in (shapes[i] for i in r.permutation(len(shapes))[:3]):
        mark = r.choice(["<article>", "</article>", "</h1>"]) if "<article>" in page and "</article>" in page else None
        if mark == "</article>" or (mark == "</h1>" and mark in page):
            page = page.replace(mark, mark + shape(), 1)
        elif mark:
            page = page.replace(mark, shape() + mark, 1)
    # Around all of it, names that sound like furniture and are none.
    name = r.choice(["single no-sidebar", "has-header", "search-results", "with-comments nav-open"])
    if "<body>" in page and r.random() < 0.5:
        page = page.replace("<body>", f'<body class="{name}">', 1)
    elif "<article>" in page and "</article>" in page:
        page = page.replace("<article>", f'<div class="{name}"><article>', 1).replace("</article>", "</article></div>", 1)
    return page


def trained(pages: list[str], seed: int = 3, turns: int = 12, batch: int = 32) -> Labeller:
    """A labeller of the given pages, by Adam on the labels that their markup gives: inside an article, not furniture."""
    data = []
    for i, page in enumerate(pages):
        for text in (page, furnished(page, i)):
            found = blocks(text)
            if found:
                anywhere = any(b.inside for b in found)
                data.append((vectors(found), np.array([(b.inside or not anywhere) and not b.away for b in found], dtype=float)))
    model = Labeller.fresh(PATH_DIM + WORD_DIM + 6, seed)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    r, step = np.random.default_rng(seed), 0
    data.sort(key=lambda d: len(d[0]))
    starts = np.arange(0, len(data), batch)
    for _ in range(turns):
        for start in r.permutation(starts):
            part = data[start : start + batch]
            x, mask = padded([d[0] for d in part])
            y = np.zeros(mask.shape)
            y[mask] = np.concatenate([d[1] for d in part])
            step += 1
            for k, g in model.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.w[k] = model.w[k] - 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fitted(pages: DataFrame, column: str = "html", page_id: str = "page_id") -> Labeller:
    """Trained on SAMPLE pages of at most SAMPLE_CHARS code points, the first by hashes of id and page; none leave it untrained.

    Pages are chosen by their hashes alone, so that only those chosen reach the driver. Of repeated rows one is used.
    """
    fit = pages.filter(F.col(column).isNotNull() & (F.length(column) <= SAMPLE_CHARS))
    marked = fit.select(F.col(column).alias("html"), F.xxhash64(F.col(page_id)).alias("mark"), F.xxhash64(F.col(column)).alias("content"))
    marks = marked.select("mark", "content").orderBy("mark", "content").limit(SAMPLE).collect()
    wanted = F.struct("mark", "content").isin([F.struct(F.lit(r["mark"]), F.lit(r["content"])) for r in marks])
    rows = marked.filter(F.col("mark").isin([r["mark"] for r in marks]) & wanted).dropDuplicates(["mark", "content"]).collect() if marks else []
    return trained([r["html"] for r in sorted(rows, key=lambda r: (r["mark"], r["content"]))])


def extracted(pages: DataFrame, labeller: Labeller, column: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, text, blocks, kept) for every row: the main text, blocks of the page and those kept.

    Blocks are joined by an empty line; no page text is dropped but by the labeller. A null or empty page has an empty
    text. Repeated rows are read each on its own, other columns are not used, pages are read whole.
    """
    weights = labeller.w

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller(weights)
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(start, PAGES_AT_ONCE)
                read = [blocks(p or "") for p in part.column(2).to_pylist()]
                kept = [s >= 0.5 for s in model.scores([vectors(p) for p in read])]
                texts = ["\n\n".join(b.text for b, k in zip(p, ks, strict=True) if k) for p, ks in zip(read, kept, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(p) for p in read], pa.int32()), pa.array([int(k.sum()) for k in kept], pa.int32())],
                    ["page_id", "url", "text", "blocks", "kept"],
                )

    chosen = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(column).cast("string").alias("html"))
    return chosen.mapInArrow(extract, "page_id long, url string, text string, blocks int, kept int")
