"""Main text of web pages with a site style tree.

Pages of one host are merged into a tree whose nodes are paths of block
elements (tag, class, id; digits folded). A node's presentation importance is
the entropy of the child sequences it shows, base the host's ``m`` pages; its
content importance is 1 minus the mean entropy of its texts over the host's
pages (a text on n of m pages: log n / log m). Pages of a host with the same
article count once. A branch weighs its own presentation by 1 - GAMMA and the
content below it by GAMMA; branches under LOW that stand on at least MIN_PAGES
such pages are removed from every page, but never below a page's own <article>
or <main>. Where a path has no class or id at all, menus, stories and notices
share a node, so there the leaves of the tree are its content nodes, one per
(path, text): one whose importance, 1 - log n / log m, is under LOW_TEXT
stands on nearly all pages of the host and goes likewise. The tree lives in aggregates by
(host, path); no host is ever in one task.

Before that a page loses what HTML itself marks as no article: scripts,
styles, navigation, footers, forms, asides, hidden parts and elements whose
class or id names such a part by its first or last word. Names cut no prose
element within an article, and no branch with more text of its own (the tree
has no say against it) than the page has besides, unless it stands outside an
article or main that the page has. With an <article> or <main>
only its blocks count: the article if it holds half of main's text (without a
main: of the page's), else main (the page). A page that the tree alone would
empty keeps what the marks left, so a host of copies is not wiped out.

Rows: null or empty html gives an empty text; a null url is the host of
nulls; repeated pages give a row each; broken nesting and open tags are
mended as browsers do for paragraphs and list items; a head ends where
its content does; unknown declarations are comments; very long pages are
read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_arrow, stage_table

GAMMA, LOW, MIN_PAGES = 0.9, 0.3, 8
LOW_TEXT = 0.1
CUTS_TO_BROADCAST = 1_000_000  # keys of 8 bytes

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time "
             "tt u var br wbr img ruby rt rp".split())
NOISE_TAGS = set("script style noscript template head nav footer aside form button select option textarea fieldset iframe object embed svg "
                 "canvas audio video dialog menu input".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners nav navbar "
                  "navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside footer footnav header masthead topbar cookie cookies "
                  "consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup signin login register social "
                  "share sharing shares related recommended recommendations comment comments commentlist disqus reply replies respond discussion search "
                  "pagination pager widget widgets toolbar skip form hidden".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = set("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Within an article these are prose, whatever their class or id.
PROSE = INLINE | set("h1 h2 h3 h4 h5 h6 p blockquote pre li dt dd td th tr caption figcaption".split())
#: Names that start so say what an element is not, or how it is shown.
DENIALS = set("has no not non with without hide hides overflow".split())
KEEP = {"html", "body", "article", "main"}
#: A tag that opens closes these first, up to the nearest of their holders.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "article", "main", "body", "section", "div", "select"}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Marked sections that the parser reads.
_SECTION = re.compile(r"<!\[(?:temp|cdata|ignore|include|rcdata|if|else|endif)(?![-.\w])", re.I)
#: Character numbers with more digits than int() takes.
_DIGITS = re.compile(r"&#([0-9]{1000,});?")


def _number(m: re.Match) -> str:
    digits = m[1].lstrip("0") or "0"
    return f"&#{digits};" if len(digits) < 8 else "\ufffd"


def _noise(tag: str, attrs: dict, inside: bool) -> bool:
    if tag in NOISE_TAGS:
        return True
    if tag in KEEP:
        return False
    if tag == "header" and not inside:
        return True
    if attrs.get("role", "").lower() in NOISE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        return True
    return False


def _named(tag: str, attrs: dict, inside: bool) -> bool:
    """Whether a class or the id names a part that is no article."""
    if tag in KEEP or (inside and tag in PROSE):
        return False
    names = attrs.get("class", "").split()
    if not (inside and tag == "section"):
        names += attrs.get("id", "").split()
    for name in names:
        words = [w.lower() for w in _NAME.findall(name)]
        if words and words[0] not in DENIALS and any(w in NOISE_NAMES and not (inside and w == "header") for w in (words[0], words[-1])):
            return True
    return False


class Page(HTMLParser):
    """Blocks of one page: (path, text, in article, in main, path of the
    outermost element around it that is cut by name and whether that one is in
    an article or main), and the child sequence
    of every element."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.stack = [["", "", False, False, False, [], ()]]  # tag, path, noise, in article, in main, children, cut by name
        self.blocks: list[tuple[str, str, bool, bool, tuple]] = []
        self.styles: list[tuple[str, str]] = []
        self.text: list[str] = []
        self.feed(_DIGITS.sub(_number, html))
        self.close()
        self._flush()
        while len(self.stack) > 1:
            self._pop()

    def parse_marked_section(self, i, report=1):
        # the parser gives up on sections it does not know; browsers read a comment up to the next '>'
        end = super().parse_marked_section(i, report) if _SECTION.match(self.rawdata, i) else -1
        return end if end >= 0 else self.parse_bogus_comment(i, report)

    def _flush(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            self.text.clear()
            if words:
                _, path, _, article, main, _, named = self.stack[-1]
                self.blocks.append((path, words, article, main, named))

    def _pop(self) -> None:
        top = self.stack.pop()
        if not top[2] and not top[6]:
            self.styles.append((top[1], " ".join(top[5])))

    def _close(self, tags: set[str], holders: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                self._flush()
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in holders:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "body" or self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self._close({"head"}, set())
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
            elif not self.stack[-1][2] and attrs:
                attrs, inside = {k: v or "" for k, v in attrs}, self.stack[-1][3] or self.stack[-1][4]
                if _noise(tag, attrs, inside) or _named(tag, attrs, inside):  # an inline element that is marked as no article
                    self.stack.append([tag, self.stack[-1][1], True, False, False, [], ()])
            return
        attrs = {k: v or "" for k, v in attrs}
        if tag not in VOID or tag == "hr":
            self._close({"p"}, HOLDERS)
        if tag in CLOSES:
            self._close(CLOSES[tag], HOLDERS - {"div", "section"})
        if not self.stack[-1][2]:
            self._flush()
        if tag in VOID:
            return
        _, path, noise, article, main, children, named = self.stack[-1]
        if noise:
            self.stack.append([tag, path, True, False, False, children, ()])
            return
        name = re.sub(r"\d+", "0", ".".join([tag, *sorted(attrs.get("class", "").split()), attrs.get("id", "")]))
        noise = _noise(tag, attrs, article or main)
        if not named and not noise and _named(tag, attrs, article or main):
            named = (f"{path}/{name}", article or main)
        if not noise and not named and (not children or children[-1] != name):
            children.append(name)
        self.stack.append([tag, f"{path}/{name}", noise, article or tag == "article", main or tag == "main" or attrs.get("role") == "main", [], named])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in INLINE and self.stack[-1][0] != tag:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self._flush()
                while len(self.stack) > i:
                    self._pop()
                return

    def handle_data(self, data):
        if self.stack[-1][0] == "head" and data.strip():
            self._close({"head"}, set())
        if not self.stack[-1][2]:
            self.text.append(data)

    def marked(self, low=lambda path: False) -> list[tuple[str, str, bool, bool, tuple]]:
        """The blocks that HTML's marks leave; text under a ``low`` path has
        no weight in the choices."""
        size = lambda blocks: sum(len(b[1]) for b in blocks if not low(b[0]))

        def scope(blocks):
            article, main = [b for b in blocks if b[2]], [b for b in blocks if b[3]]
            if not article:
                return main or blocks
            if 2 * size(b for b in article if b[3] or not main) >= size(main or blocks):
                return article
            if main and size(article) > size(main):  # articles beside a main with less text
                return [b for b in blocks if b[2] or b[3]]
            return main or blocks

        left = scope(plain := [b for b in self.blocks if not b[4]])
        marks = any(b[2] or b[3] for b in plain)
        named: dict[tuple, int] = {}
        for b in self.blocks:
            if b[4] and (b[4][1] or not marks):
                named[b[4]] = named.get(b[4], 0) + size([b])
        if named and max(named.values()) > (most := size(left)):
            left = scope([b for b in self.blocks if not b[4] or named.get(b[4], 0) > most])
        return left

    def article(self) -> list[tuple[str, str]]:
        """(path, text) of the blocks that HTML's marks leave."""
        return [b[:2] for b in self.marked()]


def _key(text: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _up(path: str) -> list[str]:
    parts = path.split("/")
    return ["/".join(parts[:i]) for i in range(2, len(parts) + 1)]


def _bare(path: str) -> bool:
    """No element of the path has a class or an id."""
    return all(name.endswith(".") and name.count(".") == 1 for name in path.split("/")[1:])


def _leaf(path: int, text: int) -> int:
    """Key of a content node; wraps as 64-bit arithmetic does."""
    return (((path * 31 + text) + (1 << 63)) & ((1 << 64) - 1)) - (1 << 63)


def style_tree(pages: DataFrame) -> DataFrame:
    """``pages`` (host, html) to what to remove: host, cut (key of a path or
    of a content node)."""

    def nodes(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            keys: dict[str, int] = {}
            ups: dict[str, str] = {}
            key = lambda s: keys[s] if s in keys else keys.setdefault(s, _key(s))  # noqa: B023, E731
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = Page(html.as_py() or "")
                same = _key("\n".join(t for _, t in page.article()))
                rows = {(b[0], 3 if _bare(b[0]) else 1, _key(b[1])) for b in page.blocks} | {(p, 2, key(s)) for p, s in page.styles if p}
                rows |= {(p, 0, 0) for p, _, _ in rows} | {("", 0, 0)}  # the empty path is the host's
                for p, kind, value in rows:
                    if p not in ups:
                        ups[p] = ",".join(str(key(x)) for x in _up(p))
                    for o, x in zip(out, (host, key(p), ups[p], kind, _leaf(key(p), value) if kind == 3 else value, same), strict=True):
                        o.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                                             ["host", "path", "up", "kind", "value", "same"])

    seen = map_arrow(pages.select("host", "html"), nodes, "host string, path long, up string, kind int, value long, same long")
    seen = stage_table(seen.groupBy("host", "path", "up", "kind", "value").agg(F.count_distinct("same").alias("n")), "style-seen")
    of = lambda kind, x: F.when(F.col("kind") % 2 == kind if kind == 1 else F.col("kind") == kind, x)  # noqa: E731  texts: kinds 1 and 3
    n, ln = F.col("n"), F.log(F.col("n").cast("double"))
    node = stage_table(seen.groupBy("host", "path", "up").agg(
        F.max(of(0, n)).alias("m"), F.avg(of(1, ln)).alias("text_ln"), F.count(of(1, n)).alias("texts"),
        F.sum(of(2, n)).alias("shown"), F.sum(of(2, n * ln)).alias("shown_ln")), "style-nodes")
    node = node.where("up != ''").join(node.where("up = ''").select("host", F.col("m").alias("pages")), "host")
    base = F.log(F.col("pages").cast("double"))
    alone = F.col("pages") < 2
    node = stage_table(node.select(
        "host", "path", "up", "m", "texts", base.alias("base"),
        F.when(alone, 1.0).otherwise((F.log(F.col("shown").cast("double")) - F.col("shown_ln") / F.col("shown")) / base).alias("presentation"),
        F.when(alone, 1.0).otherwise(1 - F.col("text_ln") / base).alias("content")), "style-tree")
    below = (node.where("texts > 0").select("host", F.explode(F.split("up", ",")).alias("path"), "texts", "content")
             .groupBy("host", F.col("path").cast("long").alias("path")).agg((F.sum(F.col("texts") * F.col("content")) / F.sum("texts")).alias("below")))
    both = node.join(below, ["host", "path"])
    worth = (1 - GAMMA) * F.coalesce("presentation", F.lit(0.0)) + GAMMA * F.col("below")
    paths = both.where((worth < LOW) & (F.col("m") >= MIN_PAGES)).select("host", F.col("path").alias("cut"))
    host = node.groupBy("host").agg(F.max("base").alias("base"))
    leaves = seen.where((F.col("kind") == 3) & (F.col("n") >= MIN_PAGES)).join(host, "host")
    return paths.union(leaves.where(1 - ln / F.col("base") < LOW_TEXT).select("host", F.col("value").alias("cut")))


def main_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_chars."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))
    pages = df.select(F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), F.col(html).alias("html"))
    cut = stage_table(style_tree(pages).groupBy("host").agg(F.collect_list("cut").alias("cut")), "removed-branches")
    side = F.broadcast(cut) if cut.agg(F.coalesce(F.sum(F.size("cut") + 8), F.lit(0))).first()[0] <= CUTS_TO_BROADCAST else cut
    pages = pages.join(side, "host", "left").select("key", "url", "html", "cut")

    def texts(batches):
        for batch in batches:
            out, cuts = [], {}
            for html_, cut_ in zip(batch.column(2), batch.column(3), strict=True):
                page = Page(html_.as_py() or "")
                drop = set(cut_.as_py() or ())
                if drop:
                    key_of = lambda x: cuts[x] if x in cuts else cuts.setdefault(x, _key(x))  # noqa: B023, E731
                    lost = {p: any(key_of(x) in drop for x in _up(p)) for p in {b[0] for b in page.blocks}}
                    blocks = page.marked(lost.__getitem__)
                    blocks = [b for b in blocks if ((b[2] or b[3]) and not b[4])
                              or not lost[b[0]] and _leaf(key_of(b[0]), _key(b[1])) not in drop] or blocks
                else:
                    blocks = page.marked()
                out.append("\n".join(b[1] for b in blocks))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                                             ["key", "url", "text", "n_chars"])

    kind = {c: df.schema[c].dataType.simpleString() for c in (key, url)}
    out = map_arrow(pages, texts, f"key {kind[key]}, url {kind[url]}, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
