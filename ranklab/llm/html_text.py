"""Main text of web pages, with each site's template removed.

Every element is hashed with all that is in it. Spark counts, per host, on how many
different pages each hash occurs, and a subtree that recurs on many of a host's pages is
template: it is deleted. Pages with the same article count once, or an often copied one
would be its own template. Inside an article that holds for containers (div, section, ul, ...)
that are a small part of it: share bars, notices, boxes. Paragraphs and headings of an article are
never deleted for being frequent: lines that many articles share are text.

Elements that say what they are (nav, footer, class="ad", ...) are deleted on any page, but
their names never delete the page's html, body, main or article, nor what holds most of its
text; a section of comments goes whatever it holds. What is left of the article is the text;
of the main element, where its own paragraphs are more than its articles'; of the body, where a page has neither.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ranklab.llm.common import map_batches
from ranklab.llm.url_filter import host_of
from ranklab.session import BROADCAST_BYTES, broadcast_if, keep

SHARE = 0.3        # of a host's different pages ...
LEAST_PAGES = 5    # ... and so many at least, on which a subtree recurs: a host of fewer pages has no template
SMALL_PART = 0.3   # of an article's characters, that a template inside it has at most
MOST = 0.5         # of a page's characters, from which on names do not delete an element

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/a-z][^>]*+(?:>|\Z)", re.I | re.S)
# A name with its value, or a stray quoted string, which is no name.
_ATTRIBUTE = re.compile(r"\"[^\"]*+\"|'[^']*+'|([^\s/>=\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+)))?")

# HTML's elements without an end, those that stand in a line, those whose start ends an open one of the same list.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr img math".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
# What holds no article text up to its own end. Without one its extent is unknown, and nothing is left out for it.
EMBEDDED = frozenset("noscript template textarea title iframe svg select object annotation annotation-xml".split())
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("textarea", "title")}
# Other grammars, the places in them that hold HTML, and the elements that end an open one.
FOREIGN = frozenset("svg math select".split())
WITHIN = FOREIGN | {"foreignobject", "annotation-xml"}
BREAKOUT = frozenset("address article aside blockquote body center dd details dialog div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header img li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
# What is no article text, by element, role, and class names and ids. A name of several parts counts where
# each part is on one of the two lists, and one at least on the first.
DROPPED = frozenset("nav footer aside form button menu dialog head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
COMMENTS = frozenset("comment comments commentlist replies reply disqus respond".split())
NAMES = COMMENTS | frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs topbar footer sidebar cookie cookies consent gdpr notice "
                             "notices banner alert ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
                             "newsletter subscribe subscription signup login share sharing social related recommended "
                             "popup modal overlay toolbar pagination pager".split())
NEUTRAL = frozenset("site page post article top bottom left right upper lower main primary secondary global box bar list item items block "
                    "section area region widget wrapper container inner outer slot unit link links button buttons icon icons form text title".split())
PLAIN = frozenset("html body p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre tr td th tbody thead tfoot caption figcaption article main".split())
WHOLE = frozenset("html body main article #page".split())
MAIN = ("article", "main")


class Element:
    __slots__ = ("tag", "attributes", "kids", "hash", "has_main", "n_text")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.kids = tag, attributes, []
        self.hash, self.has_main, self.n_text = b"", False, 0

    def close(self) -> None:
        """All kids are closed: hash the subtree."""
        digest = blake2b(self.tag.encode(), digest_size=8)
        for k in self.kids:
            if isinstance(k, str):
                flat = " ".join(k.split())
                self.n_text += len(flat)
                digest.update(b"\x01" + flat.encode("utf-8", "replace"))
            else:
                self.has_main |= k.has_main or k.tag in MAIN or k.tag == "h1"
                self.n_text += k.n_text
                digest.update(b"\x02" + k.hash)
        self.hash = digest.digest()

    def dropped(self, within_main: bool, total: int, last: bool = False) -> bool:
        """Whether the element says that it is no article text. `total`: the page's characters.

        A form around an article, or `last` anything around one, is a wrapper.
        """
        if self.tag in DROPPED and not (self.has_main and (last or self.tag == "form") or last and self.tag == "form"):
            return True
        if self.tag == "header" and not within_main and not self.has_main:
            return True
        if not self.attributes or self.tag in ("html", "body", "main"):
            return False
        for name, *values in _ATTRIBUTE.findall(self.attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "hidden" or name == "role" and value in ROLES:
                return not self.has_main
            if name in ("class", "id"):
                said = [w for w in value.split() if names(w)]
                if any(not COMMENTS.isdisjoint(_parts(w)) for w in said):
                    return True
                if not self.has_main and self.tag not in WHOLE and self.n_text <= MOST * total and (
                        said or not within_main and "header" in value.split()):
                    return True
        return False


def _parts(name: str) -> list[str]:
    return [p for p in re.split(r"[^a-z0-9]+", name) if p]


def names(name: str) -> bool:
    """Whether a class name or id says that something is no article text."""
    parts = _parts(name)
    return not NAMES.isdisjoint(parts) and all(p in NAMES or p in NEUTRAL or p.isdigit() for p in parts)


def parse(page: str) -> Element:
    """The page's tree. Unclosed elements end with what holds them; stray ends are ignored; no depth is too deep."""
    root = Element("#page")
    stack, at = [root], 0
    opened, within, endless = Counter(), [], set()      # open elements by tag, places of those in WITHIN, RAW tags that do not end any more

    def end(upto: int) -> None:
        while len(stack) > upto:
            opened[stack[-1].tag] -= 1
            stack.pop().close()
        while within and within[-1] >= upto:
            within.pop()

    while m := _TOKEN.search(page, at):
        if m.start() > at:
            stack[-1].kids.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if opened[tag]:
                n = len(stack) - 1
                while stack[n].tag != tag:
                    n -= 1
                end(n + 1)
                if tag in EMBEDDED:
                    stack[n].kids.clear()
                end(n)
            continue
        if within and tag in BREAKOUT and stack[within[-1]].tag in FOREIGN:
            end(within[-1])
        if stack[-1].tag == "head" and tag in BREAKOUT:
            end(len(stack) - 1)
        foreign = within and stack[within[-1]].tag in FOREIGN
        if tag in ENDS or tag not in INLINE and tag not in VOID and tag not in EMBEDDED and not foreign:
            if any(opened[t] for t in ENDS.get(tag, ("p",))):
                for n in range(len(stack) - 1, 0, -1):
                    t = stack[n].tag
                    if t == "p" and tag not in ENDS or t in ENDS.get(tag, ()):
                        end(n)
                        break
                    if t not in INLINE:
                        break
        made = Element(tag, m[4])
        stack[-1].kids.append(made)
        if tag in VOID or m[4].endswith("/") and (tag not in INLINE or tag == "math") and tag != "p":
            made.close()
            continue
        opened[tag] += 1
        if tag in WITHIN:
            within.append(len(stack))
        stack.append(made)
        if tag in RAW and tag not in endless:
            if found := RAW[tag].search(page, at):
                at = found.start()
            else:
                endless.add(tag)
    if at < len(page):
        stack[-1].kids.append(html.unescape(page[at:]))
    end(0)
    return root


def subtrees(root: Element) -> set[bytes]:
    """Hashes of the elements with text that can be template: outside articles all blocks, inside them containers that are a small part."""
    out: set[bytes] = set()
    todo: list[tuple[Element, Element | None]] = [(root, None)]
    while todo:
        node, article = todo.pop()
        for k in node.kids:
            if not isinstance(k, str) and k.n_text:
                inside = k if article is None and k.tag in MAIN else article
                if not k.has_main and k.tag not in MAIN and k.tag not in INLINE and _removable(k, article):
                    out.add(k.hash)
                todo.append((k, inside))
    return out


def _removable(node: Element, article: Element | None) -> bool:
    if article is None:
        return node.tag not in ("html", "body")
    return node.tag not in PLAIN and node.n_text <= SMALL_PART * article.n_text


def identity(root: Element) -> bytes:
    """What makes a page different from others: its first article, or all of it."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in MAIN:
            return node.hash
        todo += [k for k in reversed(node.kids) if not isinstance(k, str) and (k.has_main or k.tag in MAIN)]
    return root.hash


def text_of(root: Element, template: frozenset[bytes] = frozenset()) -> str:
    """The article's blocks joined by one blank; of a page without an article, the body's.

    Where that leaves nothing, elements that are dropped otherwise are read if they hold an article, and forms.
    """
    return _text_of(root, template, False) or _text_of(root, template, True)


def _text_of(root: Element, template: frozenset[bytes], last: bool) -> str:
    def left(node: Element, article: Element | None) -> bool:
        return not node.dropped(article is not None, root.n_text, last and article is None) and (
            node.has_main or node.hash not in template or not _removable(node, article))

    def found(wanted: str) -> list[Element]:
        """The outermost elements with that tag."""
        out, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag == wanted:
                out.append(node)
            else:
                todo += [k for k in reversed(node.kids) if not isinstance(k, str) and (k.has_main or k.tag == wanted) and left(k, None)]
        return out

    def own(main: Element) -> int:
        """Characters of the paragraphs of a main element that are in no article."""
        n, todo = 0, [main]
        while todo:
            for k in todo.pop().kids:
                if not isinstance(k, str) and k.tag != "article" and left(k, main):
                    if k.tag == "p" and not k.has_main:
                        n += k.n_text
                    else:
                        todo.append(k)
        return n

    articles, mains = found("article"), found("main")
    if mains and (not articles or sum(map(own, mains)) > sum(a.n_text for a in articles)):
        articles = mains
    blocks: list[list[str]] = [[]]
    todo = [(r, True, r if articles else None) for r in reversed(articles or [root])]
    while todo:
        node, opened, article = todo.pop()
        if isinstance(node, str):
            blocks[-1].append(node)
            continue
        block = node.tag not in INLINE
        if not opened:
            blocks.append([])
            continue
        if block:
            blocks.append([])
            todo.append((node, False, article))
        todo += [(k, True, article) for k in reversed(node.kids) if isinstance(k, str) or left(k, article)]
    return " ".join(t for b in blocks if (t := " ".join("".join(b).split())))


def site_templates(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(host, template): the hashes that recur on a host's pages. A host has at most (subtrees of a page) / share of them.

    `least` is a threshold of the method: what recurs on fewer different pages is text.
    """
    def work(batch: pa.RecordBatch) -> dict:
        trees = [parse(x or "") for x in batch.column(1).to_pylist()]
        return {"host": batch.column(0), "page": [identity(t) for t in trees], "found": [sorted(subtrees(t)) for t in trees]}

    own = pages.select(host_of(pages["url"]).alias("host"), pages["html"].alias("html"))
    # a row for each different page of a host, then for each of its subtrees
    different = map_batches(own, work, "host string, page binary, found array<binary>").groupBy("host", "page").agg(
        F.max("found").alias("found"))
    counts = keep(different.select("host", F.explode(F.concat(F.array(F.lit(b"")), "found")).alias("hash"))
                  .groupBy("host", "hash").agg(F.count("*").alias("n")))
    sizes = counts.where("hash = x''").select("host", F.col("n").alias("pages"))
    often = counts.where((F.col("hash") != F.lit(b"")) & (F.col("n") >= least)).join(sizes, "host").where(
        F.col("n") >= F.col("pages") * share)
    return often.groupBy("host").agg(F.collect_list("hash").alias("template"))


def extract(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Null and empty html give an empty text; a null url, or one without a host, belongs to the
    host ''. Repeated rows are extracted each and count once for the template; an empty table
    gives no rows; other columns are not read. Pages of any length and depth are read whole.
    """
    template = keep(site_templates(pages, share, least))
    size = template.agg(F.coalesce(F.sum(F.length("host") + 24 * F.size("template") + 64), F.lit(0)).alias("n")).first()["n"]
    own = pages.select(pages["page_id"].alias("page_id"), pages["url"].alias("url"), pages["html"].alias("html"),
                       host_of(pages["url"]).alias("host"))
    joined = own.join(broadcast_if(template, size, BROADCAST_BYTES // 4), "host", "left").select("page_id", "url", "html", "template")
    schema = T.StructType([joined.schema["page_id"], joined.schema["url"]]).add("text", "string").add("n_chars", "long")

    def work(batch: pa.RecordBatch) -> dict:
        texts = [text_of(parse(page or ""), frozenset(template or ()))
                 for page, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(joined, work, schema)
