"""Main text of web pages: boosted trees over the nodes of the page, decoded along its hierarchy.

Every block element is judged by features of its subtree (text, density, links), its
attribute tokens, its depth and its siblings. The labels of a page are then chosen
together: what stands below a dropped element is dropped, and of all labellings that
respect this the most probable one is taken, by one pass up and one pass down the tree.

The pages carry no labels. The trees learn from ``LEARNING`` pages (a documented bound)
that are composed here from the words of a sample of the given pages: article containers
of many kinds between menus, headers, footers, sidebars, notices, adverts, forms, related
links and reader comments. Extraction reads every page whole.

NULL and empty pages have the empty text; broken markup is read as far as it goes (open
elements are closed, unknown ones stand inside their line, unfinished tags are dropped); repeated
rows, NULL ids and extra columns need no care; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodework.llm.dom import Page
from lodework.llm.trees import Boosted

LEARNING = 400
SAMPLE = 64
#: Characters of a sampled page that words for the learning pages are taken from.
SAMPLE_CHARS = 65_536

# Fixed values for the learning pages: (tag, class) of containers of main text and of the rest.
_MAIN = (("article", ""), ("main", ""), ("div", "content"), ("div", "article body"), ("div", "post entry"), ("section", "story text"),
         ("div", "main content"), ("article", "post"))
_REST = (("nav", ""), ("nav", "menu"), ("div", "navigation menu"), ("ul", "breadcrumb"), ("header", ""), ("div", "header top"),
         ("footer", ""), ("div", "footer bottom"), ("aside", ""), ("aside", "sidebar"), ("div", "sidebar widget"),
         ("div", "cookie notice consent"), ("div", "banner notice"), ("div", "ad"), ("div", "ads advert sponsored"),
         ("div", "promo advertisement"), ("form", ""), ("form", "search newsletter subscribe"), ("div", "related links"),
         ("div", "share social"))
_COMMENTS = (("section", "comments"), ("div", "comment list reader"), ("ol", "commentlist comments"))


class _Composer:
    """Makes a labelled page: ``data-keep`` marks the container of the main text."""

    def __init__(self, words: list[str], seed: int):
        self.words, self.r = words, random.Random(seed)

    def text(self, least: int, most: int) -> str:
        return " ".join(self.r.choices(self.words, k=self.r.randint(least, most)))

    def element(self, kind: tuple[str, str], inside: str, mark: str = "") -> str:
        tag, tokens = kind
        return f'<{tag}{f" class={chr(34)}{tokens}{chr(34)}" if tokens else ""}{mark}>{inside}</{tag}>'

    def links(self) -> str:
        items = [f'<a href="#">{self.text(1, 3)}</a>' for _ in range(self.r.randint(2, 9))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.r.random() < 0.6 else " ".join(items)

    def other(self, kind: tuple[str, str]) -> str:
        if kind[0] == "form":
            return self.element(kind, f"<label>{self.text(1, 4)}</label><input><button>{self.text(1, 2)}</button>")
        some = self.r.random()
        inside = self.links() if some < 0.45 else self.text(4, 40) if some < 0.8 else f"<p>{self.text(5, 60)}</p>{self.links()}"
        return self.element(kind, inside)

    def comments(self) -> str:
        body = "".join(self.element(("div", "comment"), f"<p>{self.text(3, 50)}</p>") for _ in range(self.r.randint(1, 6)))
        return self.element(self.r.choice(_COMMENTS), f"<h3>{self.text(1, 3)}</h3>{body}")

    def page(self) -> str:
        r = self.r
        parts = [f"<h1>{self.text(2, 12)}</h1>"] * (r.random() < 0.8)
        for _ in range(r.choice((1, 2, 4, 8, 15))):
            some = r.random()
            parts.append(f"<h2>{self.text(1, 6)}</h2>" if some < 0.1 else f"<ul><li>{self.text(3, 20)}</li><li>{self.text(3, 20)}</li></ul>"
                         if some < 0.18 else f"<blockquote><p>{self.text(5, 40)}</p></blockquote>" if some < 0.23
                         else f"<p>{self.text(1, 120)}</p>")
        if r.random() < 0.3:
            parts.insert(r.randint(1, len(parts)), self.other(r.choice(_REST[11:])))
        if r.random() < 0.2:
            parts.append(self.comments())
        main = self.element(r.choice(_MAIN), "".join(parts), ' data-keep="1"')
        if r.random() < 0.25:
            main = self.element(("div", r.choice(("", "wrapper", "page", "container"))), main)
        before = [self.other(k) for k in r.sample(_REST, r.randint(0, 4))]
        after = [self.other(k) for k in r.sample(_REST, r.randint(0, 4))] + [self.comments()] * (r.random() < 0.3)
        return f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"


_DROPPED = {(t, tuple(c.split())) for t, c in _REST + _COMMENTS}


def _labels(page: Page) -> np.ndarray:
    """1 for elements around and inside the marked container, but for what never is main text; else 0."""
    keep = np.zeros(len(page.tag), np.int8)
    for i, marked in enumerate(page.kept):
        above = page.parent[i]
        if marked:
            keep[i], up = 1, above
            while up >= 0:
                keep[up], up = 1, page.parent[up]
        elif above >= 0 and keep[above] == 1 and page.kept[i] is False and _inside(page, i):
            keep[i] = (page.tag[i], page.tokens[i]) not in _DROPPED
    return keep


def _inside(page: Page, i: int) -> bool:
    while i >= 0:
        if page.kept[i]:
            return True
        i = page.parent[i]
    return False


class Model:
    """Scores of tags and tokens, and the trees over the features of a node."""

    def __init__(self, pages: list[Page]):
        labels = [_labels(p) for p in pages]
        seen: dict = defaultdict(lambda: [0, 0])
        for page, keep in zip(pages, labels):
            for tag, tokens, k in zip(page.tag, page.tokens, keep.tolist()):
                for name in {"<" + tag, *tokens}:
                    seen[name][k] += 1
        self.scores = {name: float(np.log((k + 1) / (d + 1))) for name, (d, k) in seen.items()}
        x = np.concatenate([self.features(p) for p in pages])
        self.trees = Boosted().fit(x, np.concatenate(labels).astype(float))

    def features(self, page: Page) -> np.ndarray:
        n, parent, get = len(page.tag), page.parent, self.scores.get
        chars, links, words = page.chars[:], page.link_chars[:], page.words[:]
        elements, depth_below, children, paragraphs = [1] * n, [0] * n, [0] * n, [t == "p" for t in page.tag]
        paragraphs = [int(x) for x in paragraphs]
        place, sibling_chars = [0] * n, [0] * n
        for i in range(1, n):
            place[i], children[parent[i]] = children[parent[i]], children[parent[i]] + 1
        for i in range(n - 1, 0, -1):
            up = parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            words[up] += words[i]
            elements[up] += elements[i]
            paragraphs[up] += paragraphs[i]
            depth_below[up] = max(depth_below[up], depth_below[i] + 1)
            sibling_chars[up] = max(sibling_chars[up], chars[i])
        total = max(chars[0], 1)
        rows = []
        token_low, token_high = [0.0] * n, [0.0] * n  # along the path from the root
        for i in range(n):
            up = max(parent[i], 0)
            own = [get(t, 0.0) for t in page.tokens[i]] or [0.0]
            tag = get("<" + page.tag[i], 0.0)
            token_low[i], token_high[i] = min(token_low[up], tag, *own), max(token_high[up], *own)
            rows.append((tag, min(own), max(own), sum(own), get("<" + page.tag[up], 0.0), token_low[i], token_high[i], page.depth[i],
                         np.log1p(chars[i]), chars[i] / elements[i], links[i] / max(chars[i], 1), chars[i] / total, words[i] / elements[i],
                         paragraphs[i], elements[i], depth_below[i], children[i], place[i], children[up],
                         chars[i] / max(sibling_chars[up], 1), links[up] / max(chars[up], 1)))
        return np.array(rows, np.float32)


def decode(page: Page, score: np.ndarray) -> list[bool]:
    """The most probable labels in which everything below a dropped element is dropped."""
    keep, drop = -np.logaddexp(0, -score), -np.logaddexp(0, score)
    all_dropped, best = drop.tolist(), keep.tolist()
    for i in range(len(score) - 1, 0, -1):  # children come behind their parents
        all_dropped[page.parent[i]] += all_dropped[i]
        best[page.parent[i]] += max(best[i], all_dropped[i])
    kept = [True] * len(score)
    for i in range(1, len(score)):
        kept[i] = kept[page.parent[i]] and best[i] >= all_dropped[i]
    return kept


def main_text(page: Page, score: np.ndarray) -> str:
    kept = decode(page, score)
    return "\n".join(text for node, text in page.blocks if kept[node])


def fit(pages: DataFrame, learning: int = LEARNING, sample: int = SAMPLE) -> Model:
    """Learn from pages composed of the words of the ``sample`` pages with the least hashes of their id."""
    rows = pages.filter(F.col("html").isNotNull()).select(F.xxhash64("page_id").alias("_h"), "html")
    # The hashes are drawn first, so that no task sends the driver pages that are not drawn.
    drawn = [row["_h"] for row in rows.select("_h").orderBy("_h").limit(sample).collect()]
    chosen = rows.filter(F.col("_h") <= (drawn[-1] if drawn else 0)).orderBy("_h", "html").limit(sample).select(
        F.substring("html", 1, SAMPLE_CHARS).alias("html"))
    words: list[str] = []
    for row in chosen.collect():
        for _, text in Page(row["html"]).blocks:
            words += text.split()
    words = words or ["text"]
    return Model([Page(_Composer(words, seed).page()) for seed in range(learning)])


def text_of(html: Column, model: Model) -> Column:
    """Main text of an html column, never NULL."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                parsed = [Page(h or "") for h in batch.slice(start, 256).to_pylist()]
                rows = [model.features(p) for p in parsed]
                scores = np.split(model.trees.score(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                yield pa.array([main_text(p, s) for p, s in zip(parsed, scores)], pa.string())

    return F.arrow_udf(run, "string")(html)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per page row: ``page_id, url, text, n_chars``."""
    found = pages.select("page_id", "url", text_of(F.col("html"), model or fit(pages)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
