"""Main text of web pages: boosted trees over DOM elements, decoded so that ancestors and descendants agree."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.llm.dom import FEATURES, Page, features, parse
from vellumark.llm.learning import fit_in_one_task, logistic

FIT_PAGES = 400  # at most so many pages are made into training pages
VARIANTS = 3  # training pages made of each
TREES = 60
TREE_DEPTH = 4
BINS = 32
RATE = 0.25
MARKED = r"<(article|main)\b[^>]*>\s*(?!\s|</\1>)(.*?)</\1>"  # an article or main element that is not empty
SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

# Training pages. No page comes with the truth, so the teacher is what a page itself marks as <article> or <main>.
# Its paragraphs are put into other page skeletons among what else pages carry, with and without telling tags and
# words, so that the trees learn more than the one tag. Only paragraphs of the main text have data-main. If no page
# marks one, the paragraphs are made too, of the pages' words.

_WRAPPERS = (
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="main-content">', "</div>"),
    ('<div class="post-body">', "</div>"), ('<section class="entry">', "</section>"), ("<div>", "</div>"),
    ('<main><article class="post">', "</article></main>"), ('<div class="wrap"><div class="story-text">', "</div></div>"),
    ("<table><tr><td>", "</td></tr></table>"),
)


class _Maker:
    def __init__(self, words: list[str], seed: int):
        self.words, self.draw = words or ["x"], random.Random(seed)

    def some(self, low: int, high: int) -> str:
        return " ".join(self.draw.choice(self.words) for _ in range(self.draw.randint(low, high)))

    def links(self, n: int, tag: str = "li") -> str:
        made = "".join(f'<{tag}><a href="/{k}">{self.some(1, 3)}</a></{tag}>' for k in range(n))
        return f"<ul>{made}</ul>" if tag == "li" else made

    def pick(self, *forms):
        return self.draw.choice(forms)

    def navigation(self) -> str:
        n = self.draw.randint(2, 9)
        return self.pick(
            f"<nav>{self.links(n)}</nav>", f'<div class="menu">{self.links(n)}</div>', f'<div id="nav">{self.links(n, "span")}</div>',
            f'<ul class="breadcrumb"><li><a href="/">{self.some(1, 1)}</a></li></ul>',
        )

    def header(self) -> str:
        return self.pick(
            f"<header><h1>{self.some(1, 4)}</h1><p>{self.some(3, 9)}</p></header>", f"<header>{self.navigation()}</header>",
            f'<div class="header"><a href="/">{self.some(1, 3)}</a></div>', f'<div id="masthead"><h2>{self.some(1, 3)}</h2></div>', "",
        )

    def footer(self) -> str:
        return self.pick(
            f"<footer>&copy; {self.some(4, 20)}</footer>", f'<div class="footer"><p>{self.some(4, 20)}</p></div>',
            f'<div id="footer">{self.links(3)}<p>&copy; {self.some(2, 9)}</p></div>',
            f"<footer><p>{self.some(5, 30)}</p><p>{self.some(2, 9)}</p></footer>",
        )

    def sidebar(self) -> str:
        return self.pick(
            f"<aside><h3>{self.some(1, 3)}</h3>{self.links(4)}</aside>", f"<aside><p>{self.some(8, 40)}</p></aside>",
            f'<div class="sidebar"><h3>{self.some(1, 3)}</h3><p>{self.some(8, 40)}</p></div>', f'<div id="side">{self.links(5)}</div>', "",
        )

    def advert(self) -> str:
        return self.pick(
            f'<div class="ad">{self.some(3, 20)}</div>', f'<div class="ad-banner"><p>{self.some(5, 25)}</p></div>',
            f'<aside class="promo"><p>{self.some(4, 20)}</p></aside>', f'<div class="sponsored"><a href="/x">{self.some(3, 9)}</a></div>',
            f'<section class="related"><h3>{self.some(1, 3)}</h3>{self.links(4)}</section>', f'<div class="share">{self.links(3, "span")}</div>',
            f'<div class="newsletter"><p>{self.some(5, 15)}</p><form><input name="e"><button>{self.some(1, 1)}</button></form></div>',
        )

    def notice(self) -> str:
        return self.pick(
            f'<div class="cookie-notice"><p>{self.some(6, 30)}</p><button>{self.some(1, 1)}</button></div>',
            f'<div role="alert">{self.some(5, 20)}</div>', f'<div class="notice">{self.some(5, 25)}</div>',
            f'<div id="consent"><p>{self.some(8, 30)}</p></div>', f'<p class="notice">{self.some(4, 20)}</p>', "", "",
        )

    def form(self) -> str:
        return self.pick(
            f'<form action="/s"><label>{self.some(1, 2)}</label><input name="q"><button>{self.some(1, 1)}</button></form>',
            f"<form><p>{self.some(3, 12)}</p><input><button>{self.some(1, 2)}</button></form>", "", "",
        )

    def comments(self) -> str:
        said = "".join(
            self.pick(
                f"<p>{self.some(4, 60)}</p>", f'<div class="comment"><b>{self.some(1, 2)}</b><p>{self.some(4, 60)}</p></div>',
                f"<li><p>{self.some(4, 40)}</p></li>", f"<article><h4>{self.some(1, 2)}</h4><p>{self.some(4, 40)}</p></article>",
            )
            for _ in range(self.draw.randint(1, 6))
        )
        return self.pick(
            f'<section class="comments"><h2>{self.some(1, 2)}</h2>{said}</section>', f'<div id="comments">{said}</div>',
            f'<ol class="comment-list">{said}</ol>', f'<div id="disqus_thread">{said}</div>', f'<section id="discussion">{said}</section>', "", "",
        )

    def page(self, paragraphs: list[str]) -> str:
        chance = self.draw.random
        main = [re.sub(r"^\s*<(\w+)", r'<\1 data-main="1"', p) if p.lstrip().startswith("<") else f'<p data-main="1">{p}' for p in paragraphs]
        if chance() < 0.4 and len(main) > 1:
            main.insert(self.draw.randint(1, len(main) - 1), self.pick(self.advert, self.notice, self.sidebar)())
        if chance() < 0.35:
            main.append(self.pick(self.comments, self.form, self.advert, self.footer)())
        before = [self.header(), self.navigation(), self.notice(), self.advert(), self.sidebar() if chance() < 0.4 else ""]
        after = [self.comments(), self.sidebar(), self.form(), self.advert() if chance() < 0.4 else ""]
        self.draw.shuffle(before)
        self.draw.shuffle(after)
        begin, end = self.pick(*_WRAPPERS)
        body = "".join([*before, begin, *main, end, *after, self.footer()])
        if chance() < 0.3:
            body = f'<div class="{self.pick("page", "wrapper", "container", "site")}">{body}</div>'
        return f"<html><head><title>{self.some(2, 6)}</title></head><body>{body}</body></html>"


def training_rows(sources: list[str | None], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Features of the elements of made pages, and whether main text stands in them."""
    found = [m.group(2) for s in sources if (m := re.search(MARKED, s or "", re.S | re.I))]
    words = [w for f in (found or sources)[:200] for w in re.sub(r"<[^>]*>|&\w*;?", " ", f or "").split()[:60]]
    maker = _Maker(words, seed)
    if not found:
        found = [f"<h1>{maker.some(1, 6)}</h1>" + "".join(f"<p>{maker.some(8, 60)}</p>" for _ in range(2 + i % 6)) for i in range(len(sources))]
    rows, truth = [np.zeros((0, FEATURES))], [np.zeros(0, bool)]
    for body in found:
        paragraphs = [p for p in re.split(r"(?=<(?:p|h[1-6]|ul|ol|blockquote|pre|table|div)\b)", body) if p.strip()]
        for _ in range(VARIANTS if paragraphs else 0):
            page = parse(maker.page(paragraphs))
            inside = np.zeros(len(page.elements), bool)
            for element, _, _, text in page.texts:
                inside[element] |= page.elements[element].main and bool(text.strip())
            for i in range(len(page.elements) - 1, 0, -1):
                inside[page.elements[i].parent] |= inside[i]
            rows.append(features(page))
            truth.append(inside)
    return np.concatenate(rows), np.concatenate(truth)


# Gradient-boosted trees on histograms of the logistic loss.


def grow_trees(rows: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
    """TREES complete trees of TREE_DEPTH levels: feature and border of every inner node, value of every leaf."""
    inner, leaves = (1 << TREE_DEPTH) - 1, 1 << TREE_DEPTH
    out = {
        "feature": np.zeros((TREES, inner), np.int64), "border": np.full((TREES, inner), np.inf), "leaf": np.zeros((TREES, leaves)),
        "base": np.array([np.log((truth.sum() + 1) / ((~truth).sum() + 1))]),
    }
    if not len(rows) or truth.all() or not truth.any():
        return out
    borders = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(FEATURES)]
    binned = np.stack([np.searchsorted(b, rows[:, f], "left") for f, b in enumerate(borders)], axis=1)
    margin = np.full(len(rows), out["base"][0])
    cells = np.arange(FEATURES) * BINS
    for t in range(TREES):
        p = logistic(margin)
        slope, curve = p - truth, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        for level in range(TREE_DEPTH):
            count = 1 << level
            where = ((node * FEATURES * BINS)[:, None] + cells + binned).ravel()
            g, h = (
                np.bincount(where, np.repeat(v, FEATURES), count * FEATURES * BINS).reshape(count, FEATURES, BINS).cumsum(axis=2)
                for v in (slope, curve)
            )
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
            gain[(h < 2) | (all_h - h < 2)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            feature, cut = best // BINS, best % BINS
            useful = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            for k in range(count):
                f, c = int(feature[k]), int(cut[k])
                if useful[k] and c < len(borders[f]):
                    out["feature"][t, count - 1 + k], out["border"][t, count - 1 + k] = f, borders[f][c]
            at = count - 1 + node
            node = 2 * node + (rows[np.arange(len(rows)), out["feature"][t, at]] > out["border"][t, at])
        g, h = np.bincount(node, slope, leaves), np.bincount(node, curve, leaves)
        out["leaf"][t] = -RATE * g / (h + 1)
        margin += out["leaf"][t][node]
    return out


def margins(model: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Log odds that main text stands in an element."""
    total = np.full(len(rows), model["base"][0])
    at_row = np.arange(len(rows))
    for feature, border, leaf in zip(model["feature"], model["border"], model["leaf"], strict=True):
        node = np.zeros(len(rows), np.int64)
        for level in range(TREE_DEPTH):
            at = (1 << level) - 1 + node
            node = 2 * node + (rows[at_row, feature[at]] > border[at])
        total += leaf[node]
    return total


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """The elements to keep: the set of largest total log odds in which every kept element's parent is kept.

    So no element can be main text inside one that is not. Elements without
    text of their own weigh little, and the outermost one is always kept.
    """
    own = np.zeros(len(page.elements))
    for element, _, _, text in page.texts:
        own[element] += len(text.strip())
    weight = odds * (0.1 + np.log1p(own))
    best = weight.copy()
    for i in range(len(best) - 1, 0, -1):
        if best[i] > 0:
            best[page.elements[i].parent] += best[i]
    kept = np.zeros(len(best), bool)
    kept[0] = True
    for i in range(1, len(best)):
        kept[i] = kept[page.elements[i].parent] and best[i] > 0
    return kept


def main_text(page: Page, kept: np.ndarray) -> str:
    """Blocks of the kept elements in page order, white space made single, two line breaks between."""
    blocks: list[list] = []
    for element, block, _, text in page.texts:
        if kept[element]:
            if not blocks or blocks[-1][0] != (element, block):
                blocks.append([(element, block), []])
            blocks[-1][1].append(text)
    made = (" ".join("".join(parts).split()) for _, parts in blocks)
    return "\n\n".join(b for b in made if b)


def train(pages: DataFrame, limit: int = FIT_PAGES) -> dict[str, np.ndarray]:
    """Trees from at most `limit` pages: those that mark their main text, and others only if there are fewer."""
    marks = F.col("html").rlike("(?isU)" + MARKED)
    known = pages.where(F.col("html").isNotNull()).select("page_id", "html", marks.alias("_marks"))
    chosen = known.orderBy(F.desc("_marks"), F.xxhash64("page_id"), "page_id").select("html").limit(limit)

    def fit(table: pa.Table) -> dict[str, np.ndarray]:
        return grow_trees(*training_rows(sorted(table.column("html").to_pylist())))

    return fit_in_one_task(chosen, fit)


def extract(pages: DataFrame, model: dict[str, np.ndarray] | None = None, limit: int = FIT_PAGES) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page.

    A null or empty html, and a page of which nothing counts as main text, give
    the empty text. Repeated rows stay; other columns are not read.
    """
    model = model or train(pages, limit)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # TREES trees of fixed depth

    def run(frames):
        for frame in frames:
            texts = []
            for at in range(0, len(frame), 200):
                parsed = [parse(h or "") for h in frame["html"].iloc[at : at + 200]]
                rows = [features(p) for p in parsed]
                odds = np.split(margins(shared.value, np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                texts += [main_text(p, decode(p, o)) for p, o in zip(parsed, odds, strict=True)]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInPandas(run, SCHEMA)
