"""Main text of web pages by equivalence-class template deduction.

A page is a row of tokens: tags with the path of open elements they stand in,
and whole text nodes with theirs.  Over the pages of one host, tokens that
occur equally often on every page (equal occurrence vectors) form a class;
vectors are compared by fingerprints that add up over pages, so no host is
gathered in one place.  A class is valid if its tokens nest: all stand in tokens
of the class itself or of one other class.  Valid classes that most pages hold
are the host's template.  Text nodes of a valid class that holds elements too
come with these, on each page the same; they, nodes that are constant by
themselves, and containers that are mostly links are not article text, inside
an article too.  The host's main slot is the element, once on each page that
holds it, whose share of the host's varying text exceeds its share of the
constant and linked text by most: a menu or a notice around the article costs, a
part of the article left out costs as well.  What varies within it is the text.

Markup refines this: elements that state another purpose (menus, sidebars,
adverts, forms, comments and so on) are left out, and an article element (or
else a main part) that the slot lies in or holds sets its bounds.  It decides
alone on pages without the slot: hosts of fewer than ``LEAST_PAGES`` pages or of
copies, layouts that few of a host's pages share or whose elements no tag, class
or id tells apart.  With ``markup=False``
the template works alone.
"""

from __future__ import annotations

import html as html_lib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import slices, stored

#: Share of a host's pages that hold a token of the template.
SUPPORT = 0.5
#: Share from which a text node is constant by itself, and the pages that a
#: host (or a class that drops text) must have for that.
CONSTANT = 0.9
LEAST_PAGES = 3
LINK_SHARE = 0.6
#: Template tokens of all hosts that are broadcast at most (16 bytes each).
BROADCAST_TOKENS = 1_000_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe|title|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)([^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)>"
    r"|</?[a-zA-Z][^<>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_WHITE = re.compile(r"\s+")
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^a-z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
# Elements that never hold article text, wherever they stand.
_ASIDE = frozenset("head nav footer aside form button select menu dialog audio video canvas map".split())
# Words in class, id or role that state another purpose than article text.
_PURPOSE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer header masthead topbar cookie cookies consent notice notices alert gdpr popup modal "
    "overlay comment comments commentlist reply replies respond discussion disqus share sharing social related recommended newsletter "
    "subscribe subscription signup login search pagination pager widget skip copyright toolbar form complementary contentinfo "
    "disclaimer legal notification topnav subnav sitenav adbox adslot".split())
# Within an article these name its own head; states of a page say nothing of an element.
_HEADS = frozenset(("header", "masthead"))
_STATES = ("has-", "with-", "no-", "without-", "is-", "show-", "hide-")
# What a page states to be its text: the article more surely than the main part.
_ARTICLE_LEVEL = {"articlebody": 2, "article": 2, "main": 1}


def _label(name: str, attributes: str, in_article: int) -> tuple[str, bool, int]:
    """(label in paths, whether it states another purpose, whether it is an
    article: 2, the main part: 1, or neither: 0)."""
    words: list[str] = []
    for found in _NAMED.findall(attributes) if "=" in attributes else ():
        words += "".join(found).lower().split()
    parts = {p for w in words if not w.startswith(_STATES) for p in _PARTS.split(w) if p}
    label = name + "".join("." + re.sub(r"\d+", "#", w) for w in words)
    article = max([_ARTICLE_LEVEL.get(w, 0) for w in (name, *words)])
    if in_article or name == "header":
        parts -= _HEADS
    other = name in _ASIDE or (name == "header" and not in_article)
    other = other or (name not in ("html", "body", "main") and bool(parts & _PURPOSE))
    return label, other, 0 if other else article


class Node:
    """A text node: path, text, block, whether in a link, how surely in an
    article, whether in something of other purpose, containers."""

    __slots__ = ("path", "text", "block", "link", "article", "out", "containers")

    def __init__(self, path, text, block, link, article, out, containers):
        self.path, self.text, self.block, self.link = path, text, block, link
        self.article, self.out, self.containers = article, out, containers


def _key(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts))


def parse(html: str, markup: bool = True) -> tuple[dict[int, int], list[Node]]:
    """(count of each tag token, text nodes) of a page, in one pass; without
    ``markup`` no element states a purpose or an article."""
    counts: dict[int, int] = {}
    nodes: list[Node] = []
    # Open elements: (name, path, containers, in a link, in an article, out).
    stack: list[tuple[str, str, tuple[int, ...], bool, int, bool]] = [("", "", (), False, 0, False)]
    block, at = 0, 0

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            _, path, containers, link, article, out = stack[-1]
            nodes.append(Node(path, html_lib.unescape(piece) if "&" in piece else piece, block, link, article, out, containers))
        elif piece and nodes and nodes[-1].block == block:
            nodes[-1].text += " "

    for m in _TAG.finditer(html):
        text(html[at:m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            continue
        name = name.lower()
        if name in _BLOCK:
            block += 1
        if m.group(2):
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == name), 0)
            # Inline end tags never close a block around them.
            if depth and (name in _BLOCK or name == "head" or not any(s[0] in _BLOCK for s in stack[depth + 1:])):
                del stack[depth:]
            continue
        if name in _VOID:
            continue
        attributes = m.group(4) or ""
        if name == "body" or (name in _BLOCK and stack[-1][0] == "head"):
            while len(stack) > 1 and any(s[0] == "head" for s in stack):
                stack.pop()
        if name in _BLOCK:  # a block ends an open paragraph, a list item the one before
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] == "p" or (stack[d][0] == name and name in ("li", "option", "dt", "dd", "tr", "td", "th")):
                    del stack[d:]
                    break
                if stack[d][0] in _BLOCK:
                    break
        _, path, containers, link, in_article, out = stack[-1]
        # A page's header is no article text; an article's own holds its title.
        label, other, article = _label(name, attributes, in_article)
        if not markup:
            other, article = False, 0
        out = out or other
        if name in _BLOCK:
            path = f"{path}/{label}"
            token = _key("tag", path)
            counts[token] = counts.get(token, 0) + 1
            containers = (*containers, token)
        stack.append((name, path, containers, link or name == "a", max(in_article, article), out))
        if len(stack) > 512:
            del stack[256:-1]  # runaway nesting of broken pages keeps its outer and last elements
    text(html[at:])
    return counts, nodes


def _text_token(node: Node) -> int:
    return _key("text", node.path, _WHITE.sub(" ", node.text).strip())


def main_text(html: str | None, dropped: frozenset[int] = frozenset(), slot: int | None = None, markup: bool = True) -> str:
    """The text of a page; ``dropped``: template tokens that hold no article
    text; ``slot``: the token of the host's main slot."""
    if not html:
        return ""
    _, nodes = parse(html, markup)
    nodes = [n for n in nodes if not n.out]
    level = max((n.article for n in nodes), default=0)
    within = [n for n in nodes if slot in n.containers]
    if within and (level == 0 or max(n.article for n in within) < level):
        nodes = within
    else:  # no slot on this page, or its article's bounds are the slot's
        nodes = [n for n in nodes if n.article == level]
    chosen = [n for n in nodes if not dropped.intersection(n.containers) and _text_token(n) not in dropped]
    blocks: list[list[str]] = []
    last = None
    for n in chosen:
        if n.block != last:
            blocks.append([])
            last = n.block
        blocks[-1].append(n.text)
    lines = (_WHITE.sub(" ", "".join(b)).strip() for b in blocks)
    return "\n".join(line for line in lines if line)


def _host(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1), F.lit("")))


_STATS = "host string, token long, kind int, parent long, pages long, low long, high long, chars long, links long, times long, depth int"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def token_statistics(pages: DataFrame, markup: bool = True) -> DataFrame:
    """Per host and token: the tag token it stands in (0: none), pages that hold
    it, the fingerprint of its occurrence vector (two sums), its characters
    in all and in links, its occurrences and how many elements it stands in.

    Sums are made per batch first, then by Spark.  Token 0 stands for the page.
    """
    rows = pages.select("page_id", _host("url").alias("host"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total: dict[tuple[str, int, int, int], list[int]] = {}

            def add(host: str, token: int, kind: int, parent: int, print_: int, chars: int, links: int, times: int,
                    depth: int, total=total) -> None:
                t = total.setdefault((host, token, kind, parent), [0, 0, 0, 0, 0, 0, 0])
                t[0] += 1
                t[1] += print_ & 0x7FFFFFFF
                t[2] += print_ >> 33
                t[3] += chars
                t[4] += links
                t[5] += times
                t[6] = max(t[6], depth)

            for page_id, host, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "host", "html")), strict=True):
                counts, nodes = parse(html or "", markup)
                # Repeated rows count as one more page with the same vector.
                page = xxhash.xxh3_64_intdigest(f"{page_id}\x00{len(html or '')}")
                chars: dict[int, list[int]] = {}
                texts: dict[int, int] = {}
                plain: dict[int, int] = {}
                inside: dict[int, int] = {}
                depths: dict[int, int] = {}
                for n in nodes:
                    size = len(n.text)
                    for outer, inner in zip(n.containers, n.containers[1:], strict=False):
                        inside[inner] = outer
                    for depth, c in enumerate(n.containers):
                        of = chars.setdefault(c, [0, 0])
                        of[0] += size
                        of[1] += size * n.link
                        depths[c] = depth
                    if not n.out:
                        token = _text_token(n)
                        texts[token] = texts.get(token, 0) + 1
                        plain[token] = plain.get(token, 0) + size * (not n.link)
                        inside[token] = n.containers[-1] if n.containers else 0
                add(host, 0, 0, 0, 0, sum(len(n.text) for n in nodes), sum(len(n.text) * n.link for n in nodes), 1, 0)
                for token, n in counts.items():
                    print_ = xxhash.xxh3_64_intdigest(struct.pack("<QQ", page, n))
                    add(host, token, 1, inside.get(token, 0), print_, *chars.get(token, (0, 0)), n, depths.get(token, 0))
                for token, n in texts.items():
                    add(host, token, 2, inside[token], xxhash.xxh3_64_intdigest(struct.pack("<QQ", page, n)), plain[token], 0, n, 0)
            keys, values = list(total), np.array(list(total.values()), np.int64).reshape(-1, 7)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([_signed(k[1]) for k in keys], pa.int64()),
                 pa.array([k[2] for k in keys], pa.int32()), pa.array([_signed(k[3]) for k in keys], pa.int64()), *(pa.array(values[:, j]) for j in range(6)),
                 pa.array(values[:, 6].astype(np.int32))],
                ["host", "token", "kind", "parent", "pages", "low", "high", "chars", "links", "times", "depth"])

    # An element without text is not known to stand in anything on that page.
    sums = [F.max_by("parent", F.when(F.col("parent") != 0, 1).otherwise(0)).alias("parent")]
    sums += [F.sum(c).alias(c) for c in ("pages", "low", "high", "chars", "links", "times")] + [F.max("depth").alias("depth")]
    return rows.mapInArrow(run, _STATS).groupBy("host", "token", "kind").agg(*sums)


def deduce_templates(pages: DataFrame, markup: bool = True) -> DataFrame:
    """Template tokens: host, token, kind, class (fingerprint of its vector),
    class_size, outer (the class that it stands in; null: none), valid, pages,
    host_pages, dropped (holds no article text), and what the main slot is found
    from: parent, depth, chars, links, whether an element is a slot."""
    stats = stored(pages.sparkSession, token_statistics(pages, markup), "page-tokens")
    hosts = stats.where("kind = 0").select(
        "host", F.col("pages").alias("host_pages"), F.col("chars").alias("host_chars"), F.col("links").alias("host_links"))
    # Pages that all hold the same text nodes are copies: they tell no template.
    alike = stats.where("kind = 2").groupBy("host").agg(F.min("pages").alias("least"))
    hosts = hosts.join(alike, "host", "left").select("host", "host_pages", "host_chars", "host_links", F.coalesce(F.col("least") == F.col("host_pages"), F.lit(False)).alias("copies"))
    tokens = stats.where("kind <> 0 and pages >= 2").join(hosts, "host").where(F.col("pages") >= SUPPORT * F.col("host_pages"))
    tokens = tokens.withColumn("class", F.xxhash64("pages", "low", "high"))
    around = tokens.where("kind = 1").select("host", F.col("token").alias("parent"), F.col("class").alias("around"))
    tokens = tokens.join(around, ["host", "parent"], "left")
    # The class around a class, where a token of it stands in another one; tokens
    # at the top of the page stand in none, and elements without text do not tell.
    tells = (F.col("kind") == 2) | (F.col("chars") > 0)
    outside = F.when(tells & ~F.col("around").eqNullSafe(F.col("class")), F.coalesce(F.col("around"), F.lit(0)))
    same = tokens.groupBy("host", "class").agg(
        F.count(F.lit(1)).alias("class_size"), F.max((F.col("kind") == 1).cast("int")).alias("tags"),
        (F.min(outside).eqNullSafe(F.max(outside))).alias("valid"), F.max(outside).alias("outer"))
    tokens = tokens.join(same, ["host", "class"])
    often = (F.col("pages") >= CONSTANT * F.col("host_pages")) & (F.col("host_pages") >= LEAST_PAGES)
    with_tags = F.col("valid") & (F.col("tags") == 1) & (F.col("pages") >= LEAST_PAGES)
    linked = (F.col("kind") == 1) & (F.col("class_size") >= 2) & (F.col("links") > LINK_SHARE * F.col("chars")) & (F.col("chars") > 0)
    once = (F.col("kind") == 1) & F.col("valid") & (F.col("times") == F.col("pages")) & (F.col("host_pages") >= LEAST_PAGES)
    return tokens.select(
        "host", "token", "kind", "class", "class_size", F.nullif("outer", F.lit(0)).alias("outer"), "valid", "pages", "host_pages",
        (~F.col("copies") & once).alias("slot"), "parent", "depth", "chars", "links", "host_chars", "host_links",
        (~F.col("copies") & (((F.col("kind") == 2) & (often | with_tags)) | linked)).alias("dropped"))


def main_slots(template: DataFrame) -> DataFrame:
    """One row per host: its dropped tokens and the token of its main slot (null:
    none).  A host's tokens are those that half of its pages hold, so they are at
    most twice those of a page, whatever its pages."""

    def choose(tokens: pd.DataFrame) -> pd.DataFrame:
        parent = {r.token: r.parent for r in tokens.itertuples() if r.kind == 1}
        rest = {r.token: r.links for r in tokens.itertuples() if r.kind == 1}  # constant or linked characters
        whole = int(tokens["host_links"].iloc[0])
        for r in tokens[(tokens["kind"] == 2) & tokens["dropped"]].itertuples():
            whole += r.chars
            at, seen = r.parent, set()
            while at in parent and at not in seen:
                seen.add(at)
                rest[at] += r.chars
                at = parent[at]
        varying = int(tokens["host_chars"].iloc[0]) - whole
        best = max(((r.chars - rest[r.token]) / max(varying, 1) - rest[r.token] / max(whole, 1), r.depth, r.token)
                   for r in tokens.itertuples() if r.kind == 1 and r.slot) if tokens["slot"].any() else (0, 0, 0)
        out = pd.DataFrame({"host": [tokens["host"].iloc[0]], "dropped": [sorted(tokens["token"][tokens["dropped"]])]})
        return out.assign(slot=pd.array([best[2] if best[0] > 0 else None], dtype="Int64"))

    columns = ("host", "token", "kind", "parent", "depth", "chars", "links", "slot", "dropped", "host_chars", "host_links")
    needed = template.where("dropped or kind = 1").select(*columns)
    return needed.groupBy("host").applyInPandas(choose, "host string, dropped array<long>, slot long")


def extract(pages: DataFrame, markup: bool = True) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points); without
    ``markup`` by the deduced template alone.

    Null or empty html, and a page of nothing but its host's template, give an
    empty text; a host whose pages are copies of one another keeps theirs; pages without a host form a group
    of their own; repeated rows and null ids stay; an empty table gives an
    empty result; other columns are not read.
    """
    spark = pages.sparkSession
    template = stored(spark, deduce_templates(pages, markup), "page-templates")
    by_host = main_slots(template)
    if template.where("dropped").count() <= BROADCAST_TOKENS:
        by_host = F.broadcast(by_host)
    rows = pages.select("page_id", "url", "html", _host("url").alias("host")).join(by_host, "host", "left")
    rows = rows.select("page_id", "url", "html", "dropped", "slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets: dict[tuple[int, ...], frozenset[int]] = {}
            texts = []
            for html, dropped, slot in zip(*(batch.column(c).to_pylist() for c in ("html", "dropped", "slot")), strict=True):
                key = tuple(dropped or ())
                if key not in sets:
                    sets[key] = frozenset(t % (1 << 64) for t in key)
                texts.append(main_text(html, sets[key], None if slot is None else slot % (1 << 64), markup))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
