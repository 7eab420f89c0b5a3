"""HTML extraction by removal of site templates.

Every page is parsed into elements, and every subtree gets a digest of its tags and texts
(attributes do not count, so links and ids may differ). Spark counts, per host, the different
pages that hold a subtree; pages whose whole body is equal count once. A subtree that recurs on
many pages of its host is a template of the site and is deleted. What a site repeats too seldom to
be counted is told by its element, role or class: menus, headers, footers, sidebars, notices,
adverts, forms and reader comments. Prose inside an ``<article>`` (``<main>``, ``articleBody``)
is never taken for a template, however often it recurs; there only parts that are mostly links are.

The first pass stores digests only. The second joins each page with the templates it holds and
parses it again, so a page's source is shuffled once and nothing else of it is kept.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.llm.common import steps, stored

#: different pages of a host that must hold a subtree, and their share of the host's different pages
MIN_PAGES, MIN_SHARE = 5, 0.01
#: inside the article only subtrees with at least this share of linked text may be templates
LINKED = 0.5
#: parts into which the pages of a frequent subtree are dealt
SALTS = 8

# fixed values: elements of HTML and what they mean for the text
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
HEAD = set("title meta link script style base noscript template".split())
NO_TEXT = set("head script style textarea noscript iframe template object svg canvas math button select option datalist audio video map dialog nav aside footer form menu".split())
BLOCK = set(
    "html body head address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol p pre section summary table caption tbody thead tfoot tr td th ul search".split()
)
CLOSES_P = BLOCK - set("html body head tbody thead tfoot tr td th caption legend".split())
SCOPES = set("table td th caption button object marquee".split())
#: an element that opens closes an open one of these, up to the nearest of the elements named second
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
ROLES = set("navigation banner contentinfo complementary search form menu menubar toolbar alert alertdialog dialog".split())
MARKS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored sponsors promo promotion promotions banner banners "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription signup "
    "share sharing social sidebar sidebars widget widgets related recommended recommendations nav navbar navigation menu menus breadcrumb breadcrumbs "
    "pagination pager footer masthead topbar toolbar comments comment commentlist respond disqus search login skip".split()
)
#: class names that begin so say something else: a state, or a label of the post
OTHER = set("has no not with without is tag category post type format status".split())
TABLE = set("table caption tbody thead tfoot tr td th".split())

#: a whole tag, with quoted values that may hold >; or the start of a comment or of anything else
_TAG = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|(!--)|([!?/]|[a-zA-Z]))""")
#: the same where a quote never closes: a tag ends at its first >
_PLAIN_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|(!--)|([!?/]|[a-zA-Z]))")
_TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]*)))?""")
_STYLE_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


@dataclass
class Page:
    """Elements in opening order (0 is the page), and runs of text (element, block, text)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    digest: list[int] = field(default_factory=lambda: [0])
    told: list[bool] = field(default_factory=lambda: [False])
    kind: list[int] = field(default_factory=lambda: [0])
    holds: list[bool] = field(default_factory=lambda: [False])
    length: list[int] = field(default_factory=lambda: [0])
    linked: list[int] = field(default_factory=lambda: [0])
    runs: list[tuple[int, int, str]] = field(default_factory=list)


ARTICLE, MAIN, BODY = 3, 2, 1


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(source):
        out.setdefault(name.lower(), a or b or c)
    return out


@lru_cache(8192)
def _told_kind(tag: str, inside: str) -> tuple[bool, int]:
    """Whether the element is boilerplate, and its kind; ``inside`` is the source of its attributes."""
    attrs = _attributes(inside) if inside else {}
    return _boilerplate(tag, attrs), _kind(tag, attrs)


def _kind(tag: str, attrs: dict[str, str]) -> int:
    """ARTICLE, MAIN or BODY (an article body by its markup) for an element that holds the main text."""
    if tag == "article":
        return ARTICLE
    if tag == "main" or attrs.get("role") == "main":
        return MAIN
    return BODY if "articlebody" in attrs.get("itemprop", "").lower().split() else 0


def _boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    """True when element, role, class or id say that the text is not the article's."""
    if tag in NO_TEXT:
        return True
    if not attrs or tag in ("html", "body", "main") or attrs.get("role") == "main":
        return False
    if "hidden" in attrs or attrs.get("role", "").lower() in ROLES or _STYLE_HIDDEN.search(attrs.get("style", "")):
        return True
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        parts = re.split("[-_]+", name)
        if parts[0] not in OTHER and not MARKS.isdisjoint(parts):
            return True
    return False


def parse(source: str) -> Page:
    """One pass over the source; every list stays in proportion to it, whatever the nesting."""
    page = Page()
    stack = [0]  # open elements
    parts: list[list[str]] = [[]]  # of each open element: its texts and the digests of its children
    opened: dict[str, int] = defaultdict(int)  # open elements by tag
    scopes: list[dict[str, int]] = [defaultdict(int)]  # the same within the innermost table cell or the like
    links = block = 0
    at, size = 0, len(source)

    def close() -> None:
        nonlocal links, block
        node, own = stack.pop(), parts.pop()
        tag, up = page.tag[node], page.parent[node]
        page.digest[node] = xxhash.xxh64_intdigest(f"{tag}\0" + "\1".join(own)) - (1 << 63)
        page.length[up] += page.length[node]
        page.linked[up] += page.linked[node]
        if own:
            parts[-1].append(f"\2{page.digest[node]}")
        if tag in SCOPES:
            scopes.pop()
        scopes[-1][tag] -= 1
        opened[tag] -= 1
        links -= tag == "a"
        block += tag in BLOCK

    def close_to(tags: set[str], stop: set[str]) -> None:
        """Close the nearest open element of ``tags``, unless one of ``stop`` is nearer."""
        if not any(opened[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[i]]
            if tag in tags:
                while len(stack) > i:
                    close()
                return
            if tag in stop:
                return

    def add_text(text: str) -> None:
        plain = references.unescape(text) if "&" in text else text
        words = " ".join(plain.split())
        page.runs.append((stack[-1], block, plain))
        if words:
            parts[-1].append(words)
            page.length[stack[-1]] += len(words)
            if links:
                page.linked[stack[-1]] += len(words)

    search = _TAG.search
    while at < size:
        found = search(source, at)
        if found is None:
            add_text(source[at:])
            break
        start = found.start()
        if start > at:
            add_text(source[at:start])
        ending, tag, inside, comment, other = found.groups()
        if tag is None:
            if comment:
                stop = source.find("-->", found.end() - 2)
                at = size if stop < 0 else stop + 3
            elif other in "!?/":
                stop = source.find(">", found.end())
                at = size if stop < 0 else stop + 1
            elif search == _PLAIN_TAG.search:
                # the page ends within a tag
                break
            else:
                at, search = start, _PLAIN_TAG.search
            continue
        at, tag = found.end(), tag.lower()
        if ending:
            # only the end of a part of a table reaches out of a cell
            if opened[tag] if tag in TABLE or tag in SCOPES else scopes[-1][tag]:
                while page.tag[stack[-1]] != tag:
                    close()
                close()
            elif tag == "p":
                block += 1
            continue
        if tag == "br":
            add_text("\n")
            continue
        if tag in VOID:
            block += tag in BLOCK
            continue
        if tag in CLOSES_P and scopes[-1]["p"]:
            close_to({"p"}, SCOPES)
        if tag in CLOSES:
            close_to(*CLOSES[tag])
        if tag not in HEAD and opened["head"]:
            close_to({"head"}, set())
        node = len(page.tag)
        told, kind = _told_kind(tag, inside if inside and _TELLING.search(inside) else "")
        # an article that is marked as something else, or stands in another, is not the main text
        if told or (kind == ARTICLE and opened["article"]):
            kind = 0
        page.parent.append(stack[-1])
        page.tag.append(tag)
        page.digest.append(0)
        page.told.append(told)
        page.kind.append(kind)
        page.holds.append(False)
        page.length.append(0)
        page.linked.append(0)
        if kind:
            up = node
            while up >= 0 and not page.holds[up]:
                page.holds[up] = True
                up = page.parent[up]
        if inside.endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        stack.append(node)
        parts.append([])
        scopes[-1][tag] += 1
        opened[tag] += 1
        if tag in SCOPES:
            scopes.append(defaultdict(int))
        links += tag == "a"
        block += tag in BLOCK
        if tag in RAW:
            ending = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            if ending is None:
                break
            stop = source.find(">", ending.end())
            at = size if stop < 0 else stop + 1
            close()
    while len(stack) > 1:
        close()
    page.digest[0] = xxhash.xxh64_intdigest("\1".join(parts[0])) - (1 << 63)
    return page


def _places(page: Page) -> tuple[list[bool], list[bool]]:
    """For every element: whether its markup drops it, and whether it is inside the main text.

    The main text is the articles', else what ``<main>`` holds, else an article body; without any,
    nothing is inside and the page counts as a whole. What stands in an element that is told to be
    something else is no main text, unless all of it does.
    """
    n = len(page.tag)
    some = any(page.kind)
    for strict in (True, False):
        dropped = [False] * n
        for i in range(1, n):
            spared = page.holds[i] and (page.tag[i] == "form" or (not strict and page.tag[i] not in NO_TEXT))
            dropped[i] = dropped[page.parent[i]] or (page.told[i] and not spared)
        wanted = max((kind for kind, gone in zip(page.kind, dropped, strict=True) if not gone), default=0)
        if wanted or not some:
            break
    inside = [False] * n
    for i in range(1, n):
        inside[i] = inside[page.parent[i]] or (wanted > 0 and page.kind[i] == wanted)
        # the header of the page; that of an article has its heading
        dropped[i] = dropped[i] or dropped[page.parent[i]] or (wanted == 0 and page.tag[i] == "header")
    return dropped, inside


def subtrees(page: Page) -> set[int]:
    """Digests of the subtrees that may be templates: blocks with text, in the main text only mostly linked ones."""
    inside = _places(page)[1]
    return {
        page.digest[i]
        for i in range(1, len(page.tag))
        if page.tag[i] in BLOCK
        and page.length[i]
        and not page.holds[i]
        and page.tag[i] not in ("html", "body", "head")
        and (not inside[i] or page.linked[i] >= LINKED * page.length[i])
    }


def main_text(page: Page, templates: set[int]) -> tuple[str, int, int]:
    """(text, blocks, deleted subtrees): blocks of the main text outside templates and boilerplate, one a line."""
    dropped, inside = _places(page)
    whole = not any(inside)
    deleted = 0
    gone = [False] * len(page.tag)
    for i in range(1, len(page.tag)):
        up = page.parent[i]
        hit = page.digest[i] in templates and page.tag[i] in BLOCK and not page.holds[i] and page.length[i] > 0
        hit = hit and (not inside[i] or page.linked[i] >= LINKED * page.length[i])
        deleted += hit and not gone[up]
        gone[i] = gone[up] or hit
    blocks: list[str] = []
    held, number = [], -1
    for node, block, text in [*page.runs, (0, -2, "")]:
        if block != number:
            line = " ".join("".join(held).split())
            if line:
                blocks.append(line)
            held, number = [], block
        if not gone[node] and not dropped[node] and (whole or inside[node]):
            held.append(text)
    return "\n".join(blocks), len(blocks), deleted


def host_of(url: Column) -> Column:
    """Host of an url, lower-cased; null without one."""
    host = F.regexp_extract(url, r"^.*?://([^/?#]*)", 1)
    return F.when(host != "", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, rows in steps(pc.binary_length(batch.column(2)).fill_null(0).to_numpy()):
            part = batch.slice(at, rows)
            pages = [parse(source) for source in part.column(2).to_pylist()]
            bodies = pa.array([p.digest[0] for p in pages], pa.int64())
            found = pa.array([sorted(subtrees(p)) for p in pages], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), bodies, found], names=["key", "host", "body", "subtrees"])


def page_subtrees(pages: DataFrame, key: Column, url: str, html: str) -> DataFrame:
    """(key, host, body, subtrees) of every page with a host: digests of the whole and of its subtrees."""
    rows = pages.select(key.alias("key"), host_of(F.col(url)).alias("host"), F.coalesce(html, F.lit("")).alias("html"))
    return rows.where("host IS NOT NULL").mapInArrow(_digests, "key BINARY, host STRING, body BIGINT, subtrees ARRAY<BIGINT>")


def site_templates(found: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, subtree, pages) of the subtrees that recur on ``min_pages`` different pages and ``min_share`` of the host's.

    Equal pages count once, so copies of a page do not make its text a template.
    """
    bodies = found.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("_bodies"))
    held = found.select("host", "body", F.explode("subtrees").alias("subtree")).distinct()
    pages = held.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    return pages.join(bodies, "host").where(F.col("pages") >= min_share * F.col("_bodies")).select("host", "subtree", "pages")


def extract(
    pages: DataFrame, keep: list[str], url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """``keep`` columns of every row and text, n_chars, n_blocks, n_templates (subtrees deleted as templates).

    Character references are decoded, white space inside a block becomes one space, blocks stand
    one a line in page order. Null and empty sources give an empty text. A page without a host (null
    or relative url) has no templates; its markup alone tells what goes. Equal rows give equal
    rows; a page that ends within a tag ends there. Columns of ``keep`` may have any names but
    those four.
    """
    key = F.unhex(F.md5(F.to_binary(F.concat_ws("\n", F.coalesce(F.col(url), F.lit("\0")), F.coalesce(F.col(html), F.lit(""))), F.lit("utf-8"))))
    found = stored(page_subtrees(pages, key, url, html), "sitetemplates")
    templates = stored(site_templates(found, min_pages, min_share), "sitetemplates")
    # the pages of a frequent template are dealt into parts, so none of them meets it in one task
    salted = found.select("key", "host", F.pmod(F.xxhash64("key"), F.lit(SALTS)).alias("salt"), F.explode("subtrees").alias("subtree"))
    dealt = templates.select("host", "subtree", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt"))
    held = salted.join(dealt, ["host", "subtree", "salt"]).groupBy("key").agg(F.collect_set("subtree").alias("_templates"))

    rows = pages.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.coalesce(html, F.lit("")).alias("_html"), key.alias("_key"))
    joined = rows.join(held.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")
    fields = [f"`{name}` {pages.schema[name].dataType.simpleString()}" for name in keep]
    names = [*keep, "text", "n_chars", "n_blocks", "n_templates"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(keep)
        for batch in batches:
            for at, count in steps(pc.binary_length(batch.column(n)).to_numpy()):
                part = batch.slice(at, count)
                sources, sets = part.column(n).to_pylist(), part.column(n + 1).to_pylist()
                made = [main_text(parse(s), set(t or ())) for s, t in zip(sources, sets, strict=True)]
                texts = pa.array([m[0] for m in made], pa.string())
                numbers = [pa.array(v, pa.int64()) for v in ([len(m[0]) for m in made], [m[1] for m in made], [m[2] for m in made])]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(n)], texts, *numbers], names=names)

    return joined.mapInArrow(run, ", ".join([*fields, "text STRING", "n_chars BIGINT", "n_blocks BIGINT", "n_templates BIGINT"]))
