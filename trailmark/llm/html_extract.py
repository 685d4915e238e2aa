"""Main text of web pages by equivalence-class template deduction.

A page's tokens are the paths of its elements (names and classes from the root down; elements without
class or id are told apart by whether headings and paragraphs are below them, and by their order among their like) and its whole
texts with their paths. Tokens that occur equally often on the same pages of a host share an occurrence
vector and form an equivalence class; the vectors are compared by a sum of hashes of (page, count), which
is aggregated before any shuffle. Copies of a page count as one page. A class with an element path in it, on SUPPORT pages or more,
belongs to the host's template: its texts are fixed text, its paths are the skeleton, nested as paths are, and what varies
below a path is that path's slot. The article's slot is the deepest path of the skeleton that holds SHARE of the host's
text outside links; of nested ones that do, one that marks an article comes first. From a page that has the slot all text in it is taken but
the template's fixed texts, and headings that vary just before it. What an article never has (forms, menus, comments: lists of
element names and class words) is left out inside the slot, and from the text that chooses it. A page of a templated host
without the slot is searched for its own: from the root on the one element that holds SHARE of what varies. Only hosts
of fewer than SUPPORT different pages have no template; there article elements and the lists decide.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trailmark.llm.runtime import cut, pieces, split

SUPPORT, SHARE = 3, 0.7
#: Templates of up to so many slots and texts in all (16 bytes each, a host's name included) are broadcast; of larger ones each page gets what it has of its host's.
BROADCAST = 2_000_000
#: What of a page's source isn't read: scripts, styles, comments and tags.
UNREAD = r"(?is)<(script|style)\b.*?(?:</\1|\z)|<!--.*?(?:-->|\z)|<[^>]*>?"

# Element names of the HTML standard, and words of classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
FURNITURE = frozenset("head nav footer aside form script style noscript template iframe textarea title button select option datalist dialog menu svg math canvas audio video object embed map xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertisements adsense advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies
    disqus discussion footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination paywall popup promo promos promoted
    promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored sponsors subscribe subscription teaser toolbar topbar widget widgets""".split()
)
#: Words that often only tell how a page is laid out: they don't take off an element that one of LAYS_OUT names too, nor an article inside.
LAYOUT = frozenset("banner breadcrumb breadcrumbs footer header menu nav navbar navigation share sharing sidebar social toolbar topbar widget widgets".split())
LAYS_OUT = frozenset("article has layout main no story with without".split())
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "p": frozenset(["p"])
}
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Open elements that an element closes, if nothing of SCOPE is in between.
GONE = {n: CLOSES.get(n, frozenset()) | (frozenset(["p"]) if n in ENDS_P else frozenset()) for n in {*CLOSES, *ENDS_P}}
SCOPE = frozenset("html body table td th ul ol dl article main section div aside nav form blockquote button object".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRS = re.compile(r"(?>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>")
_ATTR = re.compile(r"\b(class|id|role|hidden|style|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


HEADINGS = {"h1": 1, "h2": 1, "h3": 1, "p": 2}
#: Elements that may be slots: those that hold blocks and are none themselves.
HOLDS = frozenset("html body main article section div td table tbody tr center blockquote ul ol li dl dd figure details span".split())
ARTICLE, HARD, SOFT = 1, 2, 4


class Page:
    """A page's elements, parents before their children (0 is the page itself), and the blocks of its visible text in order.

    Of each element: name, up (its parent), flags of its own, off (whether lists take it off, its parents' state included), linked,
    within (an article), path and plain (its path without order). A block is (text, element, link characters). Time is linear in the source.
    """

    def __init__(self, source: str):
        self.name, self.up, self.flags, self.words = [""], [0], [0], [""]
        self.off, self.soft, self.linked, self.within = [False], [False], [False], [False]
        self.blocks: list[tuple[str, int, int]] = []
        self.stack = [0]
        # Where in the stack elements of a name are, and those that stop a search for one to close.
        self.open: dict[str, list[int]] = {}
        self.scopes, self.solid, self.walls = [0], [0], [0]
        self.parts: list[str] = []
        self.n_linked = 0
        self._read(source)
        self._end_block()
        self._name_paths()

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.blocks.append((text, self.stack[-1], min(self.n_linked, len(text))))
            self.parts, self.n_linked = [], 0

    def _read(self, s: str) -> None:
        at, n, quoted = 0, len(s), True
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._text(s[at:])
                return
            if lt > at:
                self._text(s[at:lt])
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            nxt = s[lt + 1 : lt + 2]
            if nxt in ("!", "?"):
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            closing = nxt == "/"
            m = _NAME.match(s, lt + 1 + closing)
            if not m:
                if closing:
                    end = s.find(">", lt)
                    at = n if end < 0 else end + 1
                else:
                    self._text("<")
                    at = lt + 1
                continue
            name = m.group().lower()
            a = _ATTRS.match(s, m.end()) if quoted else None
            if a:
                end = a.end()
            else:  # a quote that never ends: from here on quotes mean nothing
                quoted = False
                gt = s.find(">", m.end())
                if gt < 0:
                    return
                end = gt + 1
            attrs = s[m.end() : end - 1]
            at = end
            if closing:
                self._close(name)
                continue
            self._open(name, attrs)
            if name in RAW and not attrs.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(s, at)
                if not stop:
                    return
                gt = s.find(">", stop.end())
                self._close(name)
                at = n if gt < 0 else gt + 1

    def _text(self, t: str) -> None:
        self.parts.append(t)
        if self.linked[self.stack[-1]]:
            self.n_linked += len(t)

    def _pop(self, i: int) -> None:
        gone = self.stack[i:]
        if any(self.name[e] not in INLINE or self.flags[e] & (HARD | SOFT) for e in gone):
            self._end_block()
        for e in gone:
            self.open[self.name[e]].pop()
        for at in (self.scopes, self.solid, self.walls):
            while at and at[-1] >= i:
                at.pop()
        del self.stack[i:]

    def _close(self, name: str) -> None:
        at = self.open.get(name)
        if at:
            stop = self.solid if name in INLINE else self.walls if name in ("p", "li", "div", "span") else None
            if stop is None or not stop or at[-1] >= stop[-1]:
                self._pop(at[-1])
            return
        if name == "p":
            self._end_block()

    def _open(self, name: str, attrs: str) -> None:
        if name in GONE:
            top = max((at[-1] for at in map(self.open.get, GONE[name]) if at), default=-1)
            if top >= 0 and top >= (self.scopes[-1] if self.scopes else 0):
                self._pop(top)
        if name not in INLINE:
            self._end_block()
        if name in VOID:
            return
        above = self.stack[-1]
        inside = self.within[above]
        own = _own if len(attrs) < 1000 else _own.__wrapped__
        flags, words = own(name, "" if attrs.isspace() else attrs, inside)
        off, is_soft = _state(flags, self.off[above], self.soft[above])
        if name in INLINE and flags & (HARD | SOFT):
            self._end_block()
        at, e = len(self.stack), len(self.name)
        self.stack.append(e)
        self.open.setdefault(name, []).append(at)
        for kind, held in ((name in SCOPE, self.scopes), (name not in INLINE, self.solid), (name in ("article", "main", "body", "td"), self.walls)):
            if kind:
                held.append(at)
        self.name.append(name)
        self.up.append(above)
        self.flags.append(flags)
        self.words.append(words)
        self.off.append(off)
        self.soft.append(is_soft)
        self.linked.append(self.linked[above] or name == "a")
        self.within.append(inside or bool(flags & ARTICLE and not off))

    def _name_paths(self) -> None:
        n = len(self.name)
        below = [0] * n
        for e in range(n - 1, 0, -1):
            below[self.up[e]] |= below[e] | HEADINGS.get(self.name[e], 0)
        self.path, self.plain, self.depth = [0] * n, [0] * n, [0] * n
        nth: Counter = Counter()
        for e in range(1, n):
            above, name, words = self.up[e], self.name[e], self.words[e]
            if name in INLINE:
                self.path[e], self.plain[e], self.depth[e] = self.path[above], self.plain[above], self.depth[above]
                continue
            sign = f"{name} {words}" if words or name not in HOLDS else f"{name}+{below[e]}"
            if not self.flags[e] & ARTICLE:
                nth[above, sign] += 1
                sign = f"{sign} {nth[above, sign]}"
            self.path[e] = xxhash.xxh64_intdigest(f"{self.path[above]}/{sign}") >> 1
            self.plain[e] = xxhash.xxh64_intdigest(f"{self.plain[above]} {name} {words}") >> 1
            self.depth[e] = self.depth[above] + 1

    def masses(self, blocks: list[tuple[str, int, int]]) -> list[int]:
        """Of each element the characters of blocks below it that are neither in links nor taken off by lists."""
        out = [0] * len(self.name)
        for text, e, linked in blocks:
            if not self.off[e]:
                out[e] += len(text) - linked
        for e in range(len(out) - 1, 0, -1):
            out[self.up[e]] += out[e]
        return out

    def varying(self, fixed: frozenset[int]) -> list[tuple[str, int, int]]:
        return [b for b in self.blocks if token(b[0], self.plain[b[1]]) not in fixed] if fixed else self.blocks

    def text(self, slots: list[int], fixed: frozenset[int]) -> str:
        """The article: what stands in the first of slots that the page has, without the fixed texts. Where a slot holds fixed texts only, these stay."""
        if slots or fixed:
            have = set(self.path)
            slot = next((x for x in slots if x in have), None)
            if slot is not None:
                got = self._inside({e for e in range(1, len(self.path)) if self.path[e] == slot and self.name[e] not in INLINE}, fixed)
                if got:
                    return got
            if not any(self.within):
                got = self._inside({self._own_slot(fixed)}, fixed)
                if got:
                    return got
        on = [b for b in self.blocks if not self.off[b[1]]]
        marked = [b for b in on if self.within[b[1]]]
        left = [b for b in marked or on if token(b[0], self.plain[b[1]]) not in fixed]
        return " ".join(b[0] for b in left or marked)

    def _inside(self, chosen: set[int], fixed: frozenset[int]) -> str:
        n = len(self.name)
        inside, off, soft = [False] * n, [False] * n, [False] * n
        inside[0] = 0 in chosen
        for e in range(1, n):
            above = self.up[e]
            if e in chosen:
                inside[e] = True
            elif inside[above]:
                inside[e] = True
                off[e], soft[e] = _state(self.flags[e], off[above], soft[above])
        varying = self.varying(fixed)
        first = min(chosen)
        beside = {self.up[first]} if first and not self.flags[first] & ARTICLE else set()
        left = [b[0] for b in varying if (inside[b[1]] and not off[b[1]]) or (b[1] < first and not self.off[b[1]] and self.name[b[1]] in ("h1", "h2") and self.up[b[1]] in beside)]
        return " ".join(left or [b[0] for b in self.blocks if inside[b[1]] and not off[b[1]]])

    def _own_slot(self, fixed: frozenset[int]) -> int:
        """From the root on the one element that may be a slot and holds SHARE of what varies."""
        mass = self.masses(self.varying(fixed))
        most: dict[int, int] = {}
        for e in range(1, len(self.name)):
            if self.name[e] in HOLDS and (self.up[e] not in most or mass[e] > mass[most[self.up[e]]]):
                most[self.up[e]] = e
        at = 0
        while at in most and mass[most[at]] and mass[most[at]] >= SHARE * mass[at]:
            at = most[at]
        return at


@lru_cache(4096)
def _own(name: str, attrs: str, inside: bool) -> tuple[int, str]:
    """An element's own flags and its words of class and id; inside tells whether an article is around it."""
    found: dict[str, str] = {}
    for k, a, b, c in _ATTR.findall(attrs):
        found.setdefault(k.lower(), a or b or c)
    named = {w.lower() for w in _WORD.findall(found.get("class", "") + " " + found.get("id", ""))}
    article = name in ("article", "main") or found.get("role") in ("main", "article") or found.get("itemprop") == "articleBody"
    hard, soft = "hidden" in found or "display:none" in found.get("style", "").replace(" ", ""), False
    if article:
        hard = hard or name == "article" and bool(named & {"comment", "comments", "reply", "replies", "related", "teaser", "promo", "ad", "sponsored"})
    elif name not in ("html", "body"):
        hard = hard or name in FURNITURE or found.get("role") in ROLES or bool(named & (WORDS - LAYOUT)) or (name == "header" and not inside)
        soft = bool(named & (LAYOUT - {"header"} if inside else LAYOUT)) and not named & LAYS_OUT
    return article * ARTICLE | hard * HARD | soft * SOFT, " ".join(sorted(named))


def _state(flags: int, off: bool, soft: bool) -> tuple[bool, bool]:
    """(off, off by layout words alone) of an element by its own flags and its parent's state."""
    now = bool(flags & (HARD | SOFT)) or (off and not (flags & ARTICLE and soft))
    return now, now and not flags & HARD and (soft or not off)


def token(text: str, path: int) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{text}") >> 1


def host_of(url: str) -> Column:
    """The host in a URL, lower-cased, without user and port; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def distinct(pages: DataFrame) -> DataFrame:
    """pages (host, html) -> (page, host, html): of the pages of a host that read the same, one; page is a hash of host and html.

    Tags, scripts, styles and white space don't count; what each page reads is hashed once. Only pages that have copies are shuffled
    with their html, after one of a kind is left in each task.
    """
    said = F.regexp_replace(F.regexp_replace("html", UNREAD, " "), r"\s+", " ")
    hashed = pages.where("html is not null").select("host", "html", F.xxhash64("host", "html").alias("page"))
    keys = cut(hashed.select("page", F.xxhash64("host", said).alias("said")))
    copied = cut(keys.groupBy("said").agg(F.count("*").alias("n"), F.min("page").alias("first")).where("n > 1").select("said", "first"))
    again = cut(keys.join(copied, "said").select("page", "first").distinct())
    some, alone = split(hashed, "page", again, "page")
    left = some.join(again, "page", "left").where("first is null or page = first")
    return alone.select("page", "host", "html").unionByName(left.groupBy("page", "host").agg(F.min("html").alias("html")))


TOKENS = "host string, token long, n int, page long, off boolean, article boolean, holds boolean, depth int, mass long"


def templates(pages: DataFrame) -> DataFrame:
    """pages (page, host, html) -> (host, token, nth): the template of each host, a row a token; nth is null for a fixed text, and a slot's place among those to be tried.

    The table of distinct tokens with their sums is all that is shuffled. No host's template is gathered in one row or task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "html"):
            cols: list[list] = [[] for _ in range(9)]
            for page, host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                p = Page(source or "")
                seen: dict[int, list] = {}
                for e, m in enumerate(p.masses(p.blocks)):
                    if e and p.name[e] not in INLINE:
                        own = seen.setdefault(p.path[e], [0, p.off[e], bool(p.flags[e] & ARTICLE and not p.off[e]), p.name[e] in HOLDS, p.depth[e], 0])
                        own[0] += 1
                        own[5] += m
                for path, (n, off, article, holds, depth, m) in seen.items():
                    for c, v in zip(cols, (host, path, n, page, off, article, holds, depth, m)):
                        c.append(v)
                for t, n in Counter(token(x[0], p.plain[x[1]]) for x in p.blocks).items():
                    for c, v in zip(cols, (host, t, n, page, False, False, False, -1, 0)):
                        c.append(v)
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["host", "token", "n", "page", "off", "article", "holds", "depth", "mass"])

    rows = pages.select("page", "host", "html").mapInArrow(run, TOKENS)
    vector = F.xxhash64("page", "n")
    sums = [F.sum(vector.bitwiseAND(F.lit((1 << 32) - 1))).alias("lo"), F.sum(F.shiftrightunsigned(vector, 32)).alias("hi"), F.count("*").alias("pages")]
    tokens = rows.groupBy("host", "token").agg(*sums, *[F.max(c).alias(c) for c in ("off", "article", "holds", "depth")], F.sum("mass").alias("mass"))
    tokens = cut(tokens.where(F.col("pages") >= SUPPORT))
    classes = tokens.groupBy("host", "lo", "hi").agg(F.count("*").alias("size"), F.max("depth").alias("deepest")).where("size > 1 and deepest >= 0")
    valid = tokens.join(classes.select("host", "lo", "hi"), ["host", "lo", "hi"], "left_semi")
    fixed = valid.where("depth < 0").select("host", "token", F.lit(None).cast("int").alias("nth"))
    whole = valid.where("depth >= 0").groupBy("host").agg(F.max("mass").alias("whole"))
    share = F.when(F.col("article"), 1 - SHARE).otherwise(SHARE)
    fits = valid.where("holds and mass > 0").join(whole, "host").where(F.col("mass") >= share * F.col("whole"))
    # Slots that fit are nested, or mark articles: as many as a page is deep.
    order = Window.partitionBy("host").orderBy(F.desc("article"), F.desc("depth"), F.desc("mass"), "token")
    return fixed.union(fits.select("host", "token", F.row_number().over(order).alias("nth")))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", broadcast: int = BROADCAST) -> DataFrame:
    """pages' page_id and url with text, the main text, and n_chars, its code points; a row per row.

    Null html: empty. Rows without url are taken as pages of one unnamed host. Repeated rows and pages of one id
    come out each; for templates, pages of a host that read the same count once. Character
    references are decoded, white space in a block becomes one space, blocks are joined by one space.
    """
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"), F.col(source).alias("html"))
    known = cut(templates(distinct(base)))
    held = known.agg(F.sum(F.length("host") + 16)).first()[0] or 0
    gather = [F.array_sort(F.collect_list(F.when(F.col("nth").isNotNull(), F.struct("nth", "token")))).alias("slots"), F.collect_list(F.when(F.col("nth").isNull(), F.col("token"))).alias("fixed")]
    if held <= 16 * broadcast:
        joined = base.join(F.broadcast(known.groupBy("host").agg(*gather)), "host", "left")
    else:
        # What each page has of its host's template: as much as the page has tokens.
        def run_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in pieces(batches, "html"):
                cols: list[list] = [[] for _ in range(4)]
                for k1, k2, host, h in zip(*(c.to_pylist() for c in b.columns)):
                    p = Page(h)
                    for t in {*p.path[1:], *(token(x[0], p.plain[x[1]]) for x in p.blocks)}:
                        for c, v in zip(cols, (k1, k2, host, t)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64()))], names=["k1", "k2", "host", "token"])

        keys = [F.xxhash64("host", "html").alias("k1"), F.xxhash64(F.lit(1), "host", "html").alias("k2")]
        base = base.withColumns({"k1": keys[0], "k2": keys[1]})
        own = base.where("html is not null").select("k1", "k2", "host", "html").mapInArrow(run_tokens, "k1 long, k2 long, host string, token long").distinct()
        joined = base.join(own.join(known, ["host", "token"]).groupBy("k1", "k2").agg(*gather), ["k1", "k2"], "left")
    joined = joined.select("page_id", "url", F.transform("slots", lambda x: x["token"]).alias("slots"), "fixed", "html")
    kind = dict(base.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "html"):
            got = [Page(h or "").text(s or [], frozenset(f or ())) for s, f, h in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
