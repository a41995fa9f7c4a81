"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A leaf block is the text between two borders of block-level elements. Its features are the
tags, classes and ids of its ancestors and the look of its text. The field labels the blocks
of a page as main text or not, each with regard to its neighbours; Viterbi finds the best
labels. It is trained in numpy on labelled pages, by default those of ``labelled_pages``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_value, drop_clashing

by_value(__name__)

OUTPUT = ("text", "n_chars")
EPOCHS = 120
RATE = 0.3
DECAY = 2e-3
#: Labelled pages that are fitted on, at most.
SAMPLE = 2000

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe ins-block legend li main menu nav noframes noscript object "
    "ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes, if that is the innermost open element.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
#: What stands in a tag after its name: quotes open a string only right after ``=``, elsewhere they are characters.
ATTRIBUTES = r"""(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)?|=)*+"""
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|template)\b{ATTRIBUTES}(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>{ATTRIBUTES})(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("text", "stack", "linked")

    def __init__(self, text: str, stack: tuple, linked: int) -> None:
        self.text, self.stack, self.linked = text, stack, linked


def leaf_blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in page order, without those that have no text.

    Comments, scripts, styles and templates are markup; broken markup at the end is dropped.
    Character references are decoded and white space becomes one space.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    held: list[str] = []
    linked = links = 0
    at = 0

    def end() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, tuple(stack), linked))
            held.clear()
        linked = 0

    for m in MARKUP.finditer(page):
        if m.start() > at:
            piece = html.unescape(page[at : m.start()])
            held.append(piece)
            linked += len(piece) if links else 0
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
        if tag == "a":
            links = 0 if m["close"] else 1
        if tag not in BLOCK_TAGS:
            continue
        end()
        links = 0
        if m["close"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif tag not in VOID_TAGS:
            if stack and stack[-1][0] == "p":
                stack.pop()
            while stack and stack[-1][0] in CLOSES.get(tag, ()):
                stack.pop()
            names = " ".join(a or b or c for a, b, c in NAMED.findall(m["rest"])) if m["rest"] else ""
            stack.append((tag, names.lower()))
    if at < len(page):
        held.append(html.unescape(page[at:]))
    end()
    return out


def ancestor_features(stack: tuple) -> list[str]:
    out = {f"in {tag}" for tag, _ in stack}
    for depth, (tag, names) in enumerate(reversed(stack)):
        if depth < 2:
            out.add(f"up{depth} {tag}")
        out |= {f"name {w}" for w in WORDS.findall(names)}
    return sorted(out)


def text_features(block: Block) -> list[str]:
    size = len(block.text)
    out = ["any", f"size {min(size.bit_length(), 9)}", f"linked {4 * min(block.linked, size) // size}"]
    if block.text[-1] in ".!?…。":
        out.append("sentence")
    if block.text[0] in "©®":
        out.append("rights")
    return out


class Model:
    """Weights of features for both labels and of label pairs; label 1 is main text."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, 2))
        self.moves = np.zeros((2, 2))
        self.edges = np.zeros((2, 2))  # first and last block

    def fit(self, pages: Sequence[list[Block]], labels: Sequence[list[int]]) -> Model:
        """Maximise the likelihood of the labels by gradient steps over all pages at once."""
        kept = [i for i, p in enumerate(pages) if p]
        pages, labels = [pages[i] for i in kept], [labels[i] for i in kept]
        if not pages:
            return self
        longest = max(map(len, pages))
        gold = np.zeros((len(pages), longest, 2))
        there = np.zeros((len(pages), longest), dtype=bool)
        rows, columns = [], []
        for i, (page, marks) in enumerate(zip(pages, labels, strict=True)):
            there[i, : len(page)] = True
            for t, (block, mark) in enumerate(zip(page, marks, strict=True)):
                gold[i, t, mark] = 1
                for name in (*ancestor_features(block.stack), *text_features(block)):
                    rows.append(i * longest + t)
                    columns.append(self.index.setdefault(name, len(self.index)))
        rows, columns = np.array(rows), np.array(columns)
        last = there.sum(axis=1) - 1
        n = len(pages)
        self.weights = np.zeros((len(self.index), 2))
        gold_moves = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
        gold_edges = np.stack([gold[:, 0].sum(axis=0), gold[np.arange(n), last].sum(axis=0)])
        squares = [np.full_like(w, 1e-8) for w in (self.weights, self.moves, self.edges)]
        for _ in range(EPOCHS):
            scores = np.stack([np.bincount(rows, self.weights[columns, k], n * longest) for k in (0, 1)], axis=1).reshape(n, longest, 2)
            scores[:, 0] += self.edges[0]
            scores[np.arange(n), last] += self.edges[1]
            forward, backward = np.zeros_like(scores), np.zeros_like(scores)
            forward[:, 0] = scores[:, 0]
            for t in range(1, longest):
                step = np.logaddexp.reduce(forward[:, t - 1, :, None] + self.moves, axis=1) + scores[:, t]
                forward[:, t] = np.where(there[:, t, None], step, forward[:, t - 1])
            for t in range(longest - 2, -1, -1):
                step = np.logaddexp.reduce(self.moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
                backward[:, t] = np.where(there[:, t + 1, None], step, 0)
            total = np.logaddexp.reduce(forward[np.arange(n), last], axis=1)
            seen = np.exp(forward + backward - total[:, None, None]) * there[:, :, None]
            pairs = np.exp(
                forward[:, :-1, :, None] + self.moves + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]
            ) * there[:, 1:, None, None]
            error = (seen - gold).reshape(-1, 2)
            slopes = [
                np.stack([np.bincount(columns, error[rows, k], len(self.index)) for k in (0, 1)], axis=1) + DECAY * n * self.weights,
                pairs.sum(axis=(0, 1)) - gold_moves + DECAY * n * self.moves,
                np.stack([seen[:, 0].sum(axis=0), seen[np.arange(n), last].sum(axis=0)]) - gold_edges,
            ]
            for weight, slope, square in zip((self.weights, self.moves, self.edges), slopes, squares, strict=True):
                square += slope**2
                weight -= RATE * slope / np.sqrt(square)
        return self

    def _sum(self, names: Sequence[str]) -> tuple[float, float]:
        found = [self.index[x] for x in names if x in self.index]
        return tuple(self.weights[found].sum(axis=0)) if found else (0.0, 0.0)

    def label(self, page: list[Block], known: dict[object, tuple[float, float]]) -> list[int]:
        """The most likely labels, by Viterbi. ``known`` remembers sums of weights."""
        if not page:
            return []
        moves, edges = self.moves.tolist(), self.edges.tolist()
        best, back = (edges[0][0], edges[0][1]), []
        for t, block in enumerate(page):
            if len(known) > 100_000:
                known.clear()
            above, inside = known.get(block.stack), tuple(text_features(block))
            if above is None:
                above = known[block.stack] = self._sum(ancestor_features(block.stack))
            own = known.get(inside)
            if own is None:
                own = known[inside] = self._sum(inside)
            if t:
                came = tuple(int(best[1] + moves[1][k] > best[0] + moves[0][k]) for k in (0, 1))
                back.append(came)
                best = tuple(best[came[k]] + moves[came[k]][k] for k in (0, 1))
            best = tuple(best[k] + above[k] + own[k] for k in (0, 1))
        label = int(best[1] + edges[1][1] > best[0] + edges[1][0])
        out = [label]
        for came in reversed(back):
            label = came[label]
            out.append(label)
        return out[::-1]


# --- labelled pages -------------------------------------------------------------------------


def labelled_pages(n: int = 400, seed: int = 11) -> list[tuple[str, list[str]]]:
    """(html, main texts): pages put together by rule from the usual parts of web sites.

    Every text has a word of its own, so that texts tell blocks apart.
    """
    rng = np.random.default_rng(seed)
    syllables = "ta ri no se lo ka mi du ver sch eau ción the and of ing le que der".split()
    count = 0

    def pick(*options):
        return options[int(rng.integers(len(options)))]

    def text(low: int, high: int, stop: str = ".") -> str:
        nonlocal count
        count += 1
        words = ["".join(rng.choice(syllables, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(low, high)))]
        return " ".join([*words, f"w{count}"]).capitalize() + stop

    def items(k: int, stop: str = "") -> str:
        return "".join(f'<li><a href="/{i}">{text(0, 3, stop)}</a></li>' for i in range(k))

    def paragraphs(k: int) -> str:
        return "".join(f"<p>{text(3, 40)}</p>" for _ in range(k))

    def menu() -> str:
        body = f"<ul>{items(int(rng.integers(2, 7)))}</ul>"
        return pick(
            f"<nav>{body}</nav>", f'<div class="menu">{body}</div>', f'<div id="navbar" class="nav">{body}</div>',
            f'<div role="navigation">{body}</div>', f'<div class="breadcrumbs"><a href="/">{text(1, 2, "")}</a> &gt; {text(1, 2, "")}</div>',
        )

    def header() -> str:
        inner = pick(f"<h1>{text(1, 4, '')}</h1>", f"<p>{text(2, 8)}</p>", f"<div>{text(1, 4, '')}</div>", "")
        return pick(f"<header>{inner}{menu()}</header>", f'<div class="header">{inner}{menu()}</div>', f'<div id="masthead">{inner}</div>{menu()}', menu())

    def notice() -> str:
        words = text(4, 25)
        return pick(
            f'<div class="cookie-notice"><p>{words}</p><button>{text(0, 2, "")}</button></div>', f'<div class="notice" role="alert">{words}</div>',
            f'<div class="banner"><p>{words}</p></div>', f'<div id="cookie-consent" class="consent">{words}</div>', f'<dialog class="popup modal"><p>{words}</p></dialog>',
            f'<div class="newsletter subscribe"><p>{words}</p></div>', f'<div class="alert warning">{words}</div>',
        )

    def advert() -> str:
        words = text(2, 30)
        return pick(
            f'<div class="ad">{words}</div>', f'<div class="advert"><p>{words}</p></div>', f'<div class="ads advertisement">{words}</div>',
            f'<aside class="sponsored"><p>{words}</p></aside>', f'<section class="promo"><p>{words}</p></section>', f'<div id="ad-top" class="banner-ad">{words}</div>',
        )

    def form() -> str:
        return pick(
            f'<form action="/s"><label>{text(1, 4, "")}</label><input name="q"><button>{text(0, 2, "")}</button></form>',
            f'<form class="search"><p>{text(2, 12)}</p><select><option>{text(0, 2, "")}</option><option>{text(0, 2, "")}</option></select></form>',
            f'<form id="signup"><fieldset><legend>{text(1, 3, "")}</legend><p>{text(3, 20)}</p><textarea>{text(1, 5)}</textarea></fieldset></form>',
        )

    def sidebar() -> str:
        body = pick(f"<h3>{text(1, 4, '')}</h3><ul>{items(4)}</ul>", paragraphs(2), f"<h2>{text(1, 4, '')}</h2>{paragraphs(1)}")
        return pick(f"<aside>{body}</aside>", f'<div class="sidebar">{body}</div>', f'<div id="sidebar" class="widget">{body}</div>', f'<section class="related"><h3>{text(1, 3, "")}</h3><ul>{items(3)}</ul></section>')

    def comments() -> str:
        many = range(int(rng.integers(1, 5)))
        return pick(
            f'<section id="comments"><h2>{text(0, 2, "")}</h2>' + "".join(f'<div class="comment"><p>{text(2, 30)}</p></div>' for _ in many) + "</section>",
            '<div class="comments">' + "".join(f"<article class=\"comment\"><p>{text(2, 30)}</p></article>" for _ in many) + "</div>",
            '<ol class="commentlist">' + "".join(f"<li><p>{text(2, 30)}</p></li>" for _ in many) + "</ol>",
            '<div class="reader-comments discussion">' + paragraphs(2) + "</div>",
        )

    def footer() -> str:
        words = f"&copy; {text(1, 3, '')} &middot; {text(2, 20)}"
        return pick(f"<footer>{words}</footer>", f"<footer><p>{words}</p>{menu()}</footer>", f'<div class="footer"><p>{words}</p></div>', f'<div id="copyright">{words}</div>')

    def article(main: list[str]) -> str:
        def keep(low: int, high: int, stop: str = ".") -> str:
            main.append(text(low, high, stop))
            return main[-1]

        parts = [f"<h1>{keep(2, 10, '')}</h1>"] if rng.random() < 0.85 else []
        for _ in range(int(rng.integers(1, 9))):
            parts.append(
                pick(
                    lambda: f"<p>{keep(0, 60)}</p>", lambda: f"<p>{keep(3, 60)}</p>", lambda: f"<p>{keep(3, 60)}", lambda: f"<p><b>{keep(3, 60)}<br>",
                    lambda: f"<p>{keep(0, 3)}</p>", lambda: f"<p>{keep(0, 4, '')}</p>", lambda: f"<h2>{keep(1, 6, '')}</h2><p>{keep(3, 40)}</p>",
                    lambda: f"<ul><li>{keep(1, 12, '')}</li><li>{keep(1, 12, '')}</li></ul>", lambda: f"<blockquote>{keep(4, 30)}</blockquote>",
                    lambda: f"<blockquote><p>{keep(4, 30)}</p></blockquote>", lambda: f"<pre>{keep(2, 20, '')}</pre>",
                    lambda: f"<table><tr><th>{keep(0, 2, '')}</th><td>{keep(0, 3, '')}</td></tr></table>", lambda: f"<div>{keep(4, 40)}</div>",
                    lambda: f'<p><a href="/x">{keep(1, 6, "")}</a></p>', lambda: f"<ol><li>{keep(1, 20)}</li></ol>",
                )()
            )
            if rng.random() < 0.12:
                parts.append(pick(advert, notice, form, sidebar)())
        return "".join(parts)

    out = []
    for _ in range(n):
        main: list[str] = []
        top = "".join(f() for f, chance in ((header, 0.85), (notice, 0.35), (advert, 0.45), (form, 0.2), (sidebar, 0.2)) if rng.random() < chance)
        body = article(main)
        body = pick(
            f"<article>{body}</article>", f"<article>{body}</article>", f"<main><article>{body}</article></main>", f"<main>{body}</main>", f'<div class="content">{body}</div>',
            f'<div id="content" class="post"><div class="entry-content">{body}</div></div>', f'<section class="article-body">{body}</section>', body,
        )
        tail = "".join(f() for f, chance in ((comments, 0.4), (sidebar, 0.35), (advert, 0.3), (form, 0.25), (notice, 0.2), (footer, 0.85)) if rng.random() < chance)
        title = main[0] if main and rng.random() < 0.7 else text(2, 8, "")
        page = f"<!DOCTYPE html><html><head><title>{title} t</title><style>p{{}}</style><script>var a='<p>';</script></head><body>{top}{body}{tail}" + pick("</body></html>", "</body></html>", "")
        out.append((page, main))
    return out


def train(labelled: DataFrame, html: str = "html", main: str = "main", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` pages of a table with the html and the array of main texts."""
    rows = labelled.filter(F.col(html).isNotNull()).orderBy(F.xxhash64(html), html).limit(sample).collect()
    pages = [leaf_blocks(r[html]) for r in rows]
    marks = [[int(b.text in set(r[main] or ())) for b in page] for r, page in zip(rows, pages, strict=True)]
    return Model().fit(pages, marks)


def main_text(page: str | None, model: Model, known: dict) -> str:
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, mark in zip(blocks, model.label(blocks, known), strict=True) if mark)


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` with the main ``text`` and its length ``n_chars`` in code points.

    Whole pages are parsed, where they are read; nothing is shuffled. Null, empty and text-free
    pages have an empty text. Blocks are in page order and joined by two line feeds; none is
    capped. Input columns named like an added one are replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # size of the labelled pages' features

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict = {}
        for batch in batches:
            yield pd.Series([main_text(p, shared.value, known) for p in batch], dtype=object)

    content: Column = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = drop_clashing(pages.withColumn("__op_html", content), *OUTPUT)
    return rows.withColumn("text", texts("__op_html")).drop("__op_html").withColumn("n_chars", F.char_length("text").cast("long"))
