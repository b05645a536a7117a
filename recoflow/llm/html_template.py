"""HTML extraction by template deduction: tokens with one occurrence vector over a host's pages form the template."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from recoflow.llm.common import cut

LEAST_SUPPORT, LEAST_CLASS, BROADCAST_BYTES = 0.5, 2, 8 << 20
# Different pages that a layout's tokens stand on at least: two alone may be copies of one text.
LAYOUT_PAGES = 3
TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|<[!?][^>]*(?:>|$)", re.S)
NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")
# Elements by their meaning in HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "title"}
VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "param", "track"}
INLINE = {"a", "b", "i", "em", "strong", "span", "u", "s", "small", "sub", "sup", "code", "mark", "font", "abbr", "q", "cite", "time",
          "label", "del", "ins", "kbd", "var", "samp", "big", "tt", "bdi", "bdo", "data", "dfn"}
ENDS_ITSELF = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
ENDS_PARAGRAPH = {"p", "div", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "table", "section", "article", "aside", "footer", "header",
                  "nav", "form", "blockquote", "pre", "hr", "main", "dl", "figure"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head"}
ASIDE_NAME = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|popup|modal|nav\w*|menu|sidebar|breadcrumbs?|"
                        r"comments?|replies|disqus|share|social|related|newsletter|subscribe|footer|header|pagination|pager|widget)(?:$|[\s_-])", re.I)
MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:main|articlebody|article|post-content|entry-content|content|story|post)(?:$|[\s_-])", re.I)


def nodes(source: str) -> Iterator[tuple[str, str, tuple, bool]]:
    """Tokens of a page in order: (kind, value, path of open blocks, block begins). Kinds: tag, text.

    A path holds (element, names) of the open block elements; inline elements belong to their block.
    """
    path: list[tuple[str, str]] = []
    at, fresh = 0, True
    skip: str | None = None
    size = len(source)
    while at <= size:
        m = TAG.search(source, at)
        text = source[at:m.start() if m else size]
        if text and skip is None:
            yield "text", text, tuple(path), fresh
            fresh = False
        if not m:
            return
        at = m.end() if m.end() > m.start() else m.start() + 1
        name = (m[2] or "").lower()
        if not name:
            continue
        if not m[1] and name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            yield "tag", name, (*path, (name, "")), True
            at = close.end() if close else size
            fresh = True
            if not close:
                return
            continue
        if name in INLINE:
            continue
        fresh = True
        if name in VOID:
            continue
        if m[1]:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == name:
                    del path[i:]
                    break
            continue
        if name in ENDS_PARAGRAPH and path and path[-1][0] == "p":
            path.pop()
        if name in ENDS_ITSELF and path and path[-1][0] == name:
            path.pop()
        path.append((name, " ".join(sorted(a or b or c for a, b, c in NAMES.findall(m[3])))))
        yield "tag", name, tuple(path), True


def token_key(kind: str, value: str, path: tuple) -> int:
    """A 64-bit hash of the token; odd for texts, even for tags."""
    return (xxhash.xxh3_64_intdigest(repr((kind, path, value))) >> 1 << 1 | (kind == "text")) - (1 << 63)


def occurrence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page and distinct token: the token, how often, and the token that the path nests it in."""
    for part in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
        rows, keys, counts, outer = [], [], [], []
        for r, source in enumerate(part.column(1).to_pylist()):
            seen: dict[int, list[int]] = {}
            for kind, value, path, _ in nodes(source or ""):
                if kind == "text":
                    value = SPACE.sub(" ", value).strip()
                    if not value:
                        continue
                key = token_key(kind, value, path)
                above = path[:-1] if kind == "tag" else path
                seen.setdefault(key, [0, token_key("tag", above[-1][0], above) if above else 0])[0] += 1
            rows += [r] * len(seen)
            keys += seen
            counts += [c for c, _ in seen.values()]
            outer += [o for _, o in seen.values()]
        of = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(2).take(of), part.column(3).take(of),
                                          pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(outer, pa.int64())],
                                         names=["host", "page", "copy", "token", "times", "outer"])


def templates(pages: DataFrame, least_support: float = LEAST_SUPPORT, least_class: int = LEAST_CLASS,
              layout_pages: int = LAYOUT_PAGES) -> DataFrame:
    """``host``, ``template``, ``fixed``: the tokens of the valid equivalence classes of each host's pages.

    A token's occurrence vector over the host's pages enters as two sums of hashes of (page, times), so equal sums
    mean equal vectors and the vectors need no shuffle; sums are taken per task first. A class is valid if it has
    ``least_class`` tokens or more, its tokens occur often enough, and it nests: a token stays only if the token around it
    is in a valid class, too. Often enough is ``least_support`` of the host's pages and two at least, or, for a layout that fewer
    of them have, ``layout_pages`` pages and (texts) ``least_support`` of the pages that have the element around the text.
    ``fixed`` are the texts among them on three different pages or more: rows with the same html are copies of one page. They
    need not nest, as their key holds their path and elements that repeat in a page (paragraphs) are in no class.
    """
    rows = pages.select("host", "html", "page", F.xxhash64("html").bitwiseAND(F.lit((1 << 18) - 1)).alias("copy")).mapInArrow(
        occurrence_rows, "host string, page long, copy long, token long, times long, outer long")
    way = lambda seed: F.sum(F.xxhash64("page", "times", F.lit(seed)).cast("decimal(20,0)"))
    copy = F.col("copy")
    vectors = rows.groupBy("host", "token").agg(
        F.count("*").alias("pages"), way(1).alias("a"), way(2).alias("b"), F.min("outer").alias("outer"),
        F.min(copy).alias("low"), F.max(copy).alias("high"), F.sum(copy).alias("once"), F.sum(copy * copy).alias("twice"))
    # The sum of (copy - low)(copy - high) over the pages is 0 only if every page is one of these two.
    others = F.col("twice") - (F.col("low") + F.col("high")) * F.col("once") + F.col("low") * F.col("high") * F.col("pages")
    again = cut(vectors.where(F.col("pages") > 1).select("host", "token", "pages", "a", "b", "outer", (others != 0).alias("three")))
    size = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    around = again.where(F.col("token") % 2 == 0).select("host", F.col("token").alias("outer"), F.col("pages").alias("outer_pages"))
    is_tag = F.col("token") % 2 == 0
    layout = F.col("three") & (F.col("pages") >= layout_pages) & (is_tag | (F.col("pages") >= F.col("outer_pages") * least_support))
    frequent = again.join(size, "host").join(around, ["host", "outer"], "left").where(
        (F.col("pages") >= F.col("host_pages") * least_support) | F.coalesce(layout, F.lit(False)))
    classes = (frequent.groupBy("host", "a", "b").agg(F.collect_list(F.struct("token", "outer", "three")).alias("tokens"))
               .where(F.size("tokens") >= least_class))
    valid = classes.select("host", F.explode("tokens").alias("t")).groupBy("host").agg(
        F.collect_set("t.token").alias("all"), F.collect_list("t").alias("tokens"))
    is_fixed = lambda t: t["three"] & (t["token"] % 2 != 0)
    nested = F.filter("tokens", lambda t: (t["outer"] == 0) | F.array_contains("all", t["outer"]) | is_fixed(t))
    fixed = F.filter("tokens", is_fixed)
    return valid.select("host", F.transform(nested, lambda t: t["token"]).alias("template"), F.transform(fixed, lambda t: t["token"]).alias("fixed"))


def is_aside(path: tuple) -> bool:
    return any(name in ASIDE or (names and name not in ("body", "html") and ASIDE_NAME.search(names)) for name, names in path)


def main_text(source: str | None, template: set[int], fixed: set[int] | frozenset[int] = frozenset()) -> str:
    """Text of the slots that the template leaves in the page's main region.

    The main region is the outermost template element that is an article or is named as main content, or else the
    same without a template, or else the whole page. Template text is no slot: ``fixed`` text nowhere, other template text
    (seen on two different pages only) outside an article. Slots in elements named as an aside are left out by their names.
    """
    found = list(nodes(source or ""))
    def root_of(path: tuple, known: bool) -> int:
        for depth in range(1, len(path) + 1):
            name, names = path[depth - 1]
            if (name in ("article", "main") or (names and MAIN_NAME.search(names))) and not is_aside(path[:depth]):
                if not known or token_key("tag", name, path[:depth]) in template:
                    return depth
        return 0
    paths = {path for kind, _, path, _ in found if kind == "text"}
    roots = {path: root_of(path, True) for path in paths}
    if not any(roots.values()):
        roots = {path: root_of(path, False) for path in paths}
    inside = any(roots.values())
    blocks: list[str] = []
    held: list[str] = []
    for kind, value, path, fresh in found:
        if kind == "tag":
            continue
        if fresh and held:
            blocks.append("".join(held))
            held = []
        if inside and not roots[path] or is_aside(path) or path and path[-1][0] in RAW:
            continue
        known = fixed if inside else template
        if known and token_key("text", SPACE.sub(" ", value).strip(), path) in known:
            continue
        held.append(value)
    blocks.append("".join(held))
    texts = (SPACE.sub(" ", entities.unescape(block)).strip() for block in blocks)
    return " ".join(t for t in texts if t)


def extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, tuple[set[int], set[int]]] = {}
        texts = []
        for i, (source, host) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            if host not in known:
                known[host] = set(batch.column(3)[i].as_py() or ()), set(batch.column(4)[i].as_py() or ())
            texts.append(main_text(source, *known[host]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["rest", "text", "n_chars"])


def extract(pages: DataFrame, least_support: float = LEAST_SUPPORT, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rest`` (all columns of ``pages`` but ``html``), ``text``, ``n_chars`` for each row of ``pages`` (``page_id``, ``url``, ``html``).

    Templates are joined by host: as a broadcast while their measured size is below ``broadcast_bytes``, else by a
    shuffled join whose hot hosts AQE splits. Pages without a host (a null or odd url) share one template. Null or empty
    html: empty text. Rows that repeat a ``page_id`` are extracted each. A page cut off inside a tag loses that tag only.
    """
    host = F.coalesce(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    keyed = pages.select(F.lower(host).alias("host"), "html", F.xxhash64("page_id", "url", "html").alias("page"))
    found = cut(templates(keyed, least_support).withColumn("template", F.array_sort("template")))
    size = found.agg(F.sum(F.size("template") * 8 + F.size("fixed") * 8 + 64)).first()[0] or 0
    side = F.broadcast(found) if size <= broadcast_bytes else found
    rest = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != "html"]).alias("rest")
    rows = pages.select(rest, "html", F.lower(host).alias("host")).join(side, "host", "left").select("rest", "html", "host", "template", "fixed")
    return rows.mapInArrow(extract_rows, rows.select("rest").schema.add("text", "string").add("n_chars", "long"))
