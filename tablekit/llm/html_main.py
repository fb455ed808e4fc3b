"""Main text of web pages by wrapper induction: constant nodes of a layout's pages are template, varying ones content."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm import dom
from tablekit.session import materialize

#: A node is template if its text is the same on more than this share of the layout's pages that have it, and on at least
#: so many of them, or on two that have different articles.
LEAST_PAGES, LEAST_SHARE = 4, 0.5

_UNSEEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", re.I | re.S)
_OUTER = re.compile(r"""<(/?)(body|div|section|article|main|header|footer|table)\b((?:"[^"]*"|'[^']*'|[^'">])*+)>""", re.I)
_CLASS = re.compile(r"""(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NUMBER = re.compile(r"\d+")
#: Levels of outer elements that tell one layout from another.
_LEVELS = 3


def outline(html: str) -> str:
    """The kinds and classes of a page's outer elements, but for furniture; pages of one layout share them."""
    labels, depth = set(), 0
    for slash, tag, attrs in _OUTER.findall(_UNSEEN.sub("", html)):
        if slash:
            depth = max(depth - 1, 0)
            continue
        depth += 1
        if depth <= _LEVELS:
            kind = _CLASS.search(attrs)
            node = dom.Node(tag.lower(), {"class": kind[1] or kind[2] or kind[3]} if kind else {})
            if not dom.furniture(node, True):
                labels.add(_NUMBER.sub("0", node.label))
    return " ".join(sorted(labels))


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [outline(x or "") for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "outline"])


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


@lru_cache(maxsize=64)
def _reference(html: str) -> dom.Node:
    return dom.parse(html)


@lru_cache(maxsize=64)
def _reference_texts(html: str) -> dict[int, str]:
    """Own texts of the reference's nodes that have one."""
    return {n.index: t for n in dom.walk(_reference(html)) if (t := n.text())}


def _differs(page: dom.Node, same: set[int]) -> bool:
    """Is at least half of the text of the page's article, by length, not the ``same`` as the reference's?"""
    total = alike = 0
    for node in dom.walk(dom.container(page)):
        size = len(node.text())
        total += size
        alike += size if node.index in same else 0
    return total > 0 and 2 * alike <= total


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, layout, node, same, pages, others): how many pages had the reference's node, how many its text, and how
    many of these another article; per batch."""
    for batch in batches:
        same: Counter = Counter()
        pages: Counter = Counter()
        others: Counter = Counter()
        for name, layout, html, model in zip(*[batch.column(c).to_pylist() for c in ("host", "layout", "html", "model")], strict=True):
            texts = _reference_texts(model or "")
            page = dom.parse(html or "")
            agreed = {}
            for ours, theirs in dom.match(page, _reference(model or "")):
                text = texts.get(theirs.index)
                if text:
                    pages[name, layout, theirs.index] += 1
                    if ours.text() == text:
                        agreed[ours.index] = (name, layout, theirs.index)
            same.update(agreed.values())
            if agreed and html != model and _differs(page, set(agreed)):
                others.update(agreed.values())
        keys = list(pages)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([k[i] for k in keys], pa.string()) for i in (0, 1)], pa.array([k[2] for k in keys], pa.int32()),
             *[pa.array([x[k] for k in keys], pa.int64()) for x in (same, pages, others)]],
            names=["host", "layout", "node", "same", "pages", "others"])


def main_text(html: str, model: str, constant: list[int]) -> str:
    """The article of a page, given its layout's reference page and the reference's constant nodes."""
    page = dom.parse(html)
    held = dom.container(page)
    fixed = set(constant)
    template = {a.index for a, b in dom.match(page, _reference(model)) if b.index in fixed and a.text() == b.text()} if fixed else set()
    # a page whose every block is constant is a copy of the reference, not a template without content
    return " ".join(dom.blocks(held, template) or dom.blocks(held, frozenset()))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html or "", model or "", nodes or []) for html, model, nodes in zip(
            *[batch.column(c).to_pylist() for c in ("html", "model", "nodes")], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                                         names=["id", "url", "text"])


def extract_main(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of each page: its article, blocks joined by one space, empty if there is none.

    Pages of a host with the same outline are a layout; the page with the smallest id among them that has any html is its
    reference. A page with an outline of its own goes with the host's most frequent layout. Every page is aligned with the
    reference by simple tree matching, and the pages on which a node's own text is the reference's are counted; counts,
    not pages, meet by host and layout, so these may hold any share of the pages. Nodes that are constant on most pages are
    template, if on two pages with different articles or on several. What is left of the element that holds the article,
    without navigation, forms, adverts, comments and the like (named by tag, class, id or role), is the text. Pages
    without a url make up one host; a null html is empty. Rows with the same id are pages of their own.
    """
    own = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"),
                       host(pages[url_col]).alias("host"))
    kinds = {c: own.schema[c].dataType.simpleString() for c in ("id", "url")}
    own = materialize(own.mapInArrow(_outlines, f"id {kinds['id']}, url {kinds['url']}, html string, host string, outline string"),
                      "html-outlines")
    has_html = F.trim(F.coalesce("html", F.lit(""))) != ""
    place = F.when(has_html, F.struct(F.col("id").isNull().alias("no_id"), "id", "html"))
    layouts = own.groupBy("host", "outline").agg(F.count(place).alias("size"), F.min_by("html", place).alias("model"))
    layouts = materialize(layouts, "html-layouts")
    # a single page cannot show what is constant, the most frequent layout of its host may
    main = layouts.groupBy("host").agg(F.max_by("outline", F.struct("size", "outline")).alias("main"))
    names = layouts.select("host", "outline", "size").join(main, "host").select(
        F.col("host").alias("of"), F.col("outline").alias("out"), F.when(F.col("size") > 1, F.col("outline")).otherwise(F.col("main")).alias("layout"))
    models = layouts.select(F.col("host").alias("of"), F.col("outline").alias("layout"), "model")
    models = materialize(names.join(models, ["of", "layout"]), "html-models")
    here = (F.col("host") == F.col("of")) & (F.col("outline") == F.col("out"))
    counted = own.join(models, here).select("host", "layout", "html", "model")
    votes = counted.mapInArrow(_votes, "host string, layout string, node int, same bigint, pages bigint, others bigint")
    constant = (votes.groupBy("host", "layout", "node").agg(*[F.sum(c).alias(c) for c in ("same", "pages", "others")])
                .where(((F.col("same") >= LEAST_PAGES) | (F.col("others") > 0)) & (F.col("same") > LEAST_SHARE * F.col("pages")))
                .groupBy(F.col("host").alias("at"), F.col("layout").alias("lay"))
                .agg(F.sort_array(F.collect_list("node")).alias("nodes")))
    known = materialize(models.join(constant, (F.col("of") == F.col("at")) & (F.col("layout") == F.col("lay")), "left")
                        .select("of", "out", "model", "nodes"), "html-hosts")
    return (own.join(known, here).select("id", "url", "html", "model", "nodes")
            .mapInArrow(_extract, f"id {kinds['id']}, url {kinds['url']}, text string"))
