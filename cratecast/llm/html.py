"""Main text of web pages by site template removal.

Every element subtree of a page is hashed. Spark counts on how many different
pages of a host each subtree occurs, and subtrees that recur across many of the
host's pages are deleted, with what markup itself names as no article (menus,
forms, scripts and so on). Pages that are copies of each other count once.

Where a page marks its article (article, main), text outside it is no main text
(but see ``FAIR``), and inside it only container elements can be deleted as templates: a paragraph
that many articles quote stays. No subtree with half of a page's main text or
more is ever deleted as a template, and by a word of its class or id only if a
marked article lies outside it (see ``Page._judge``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_workers, land

MIN_PAGES, SHARE = 5, 0.3
#: Different pages that make a template of anything but a paragraph, however large the host.
MANY = 50
#: Article elements (no main, no articleBody) with text, but less than one part in so many of what is outside them, are
#: teasers: what is left of the page without its templates is the main text.
FAIR = 20

_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)""", re.S)
#: A name with or without a value; quoted values are consumed, so that words in them are no attributes.
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
_UNSHOWN = re.compile(r"display\s*:\s*none")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_DROPPED = frozenset("head script style noscript template iframe noembed noframes xmp textarea title nav footer aside form button select option datalist fieldset input object applet svg math canvas audio video map dialog menu".split())
_CONTAINERS = frozenset("div section details center span".split())
_PARAGRAPHS = frozenset("p li dt dd blockquote pre h1 h2 h3 h4 h5 h6 tr td th caption figcaption address".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Words of class, id or role that name something other than the article.
_NAMED = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert newsletter subscribe subscription popup modal overlay"
    " sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar masthead topbar footer comment comments commentlist disqus reply replies respond discussion share sharing social related"
    " recommended recommendations widget login signup search skip copyright complementary contentinfo".split()
)
#: Of these, the words of what holds articles of others or of readers: an article in it is not the page's own.
_OTHERS = _NAMED - frozenset("share sharing social banner notice notices alert popup modal overlay newsletter subscribe subscription login signup search skip".split())
_HEADERS = frozenset(["header"])
#: A class name goes on with what the element has or lacks, not with what it is: with-sidebar, has-comments.
_ABOUT = frozenset("with without has no".split())


def named(value: str) -> Iterator[str]:
    """The words of a class, id or role, of each name those before the first of ``_ABOUT``."""
    for name in value.split():
        for word in re.split(r"[^a-z0-9]+", name):
            if word in _ABOUT:
                break
            yield word


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\s]*)", url) if isinstance(url, str) else None
    return re.sub(r":\d*$", "", m[1].rpartition("@")[2]).lower() if m else ""


class Page:
    """One parsed page: nodes, and in ``runs`` the pieces of text with their node."""

    def __init__(self, source: str):
        self.tag, self.parent, self.off, self.main, self.begin, self.end = ["html"], [-1], [False], [False], [0], [0]
        # deleted whatever it holds; its words of _NAMED; head of a site or article; marked by more than its tag
        self.hard, self.words, self.head, self.body = [False], [frozenset()], [False], [False]
        self.tokens: list[str] = []
        self.runs: list[tuple[int, str]] = []
        self._parse(source)
        self.end[0] = len(self.tokens)
        self._judge()

    def _open(self, name: str, attrs: str, top: int) -> int:
        hard = self.hard[top] or name in _DROPPED
        main, head, body = name in ("article", "main"), name == "header", name == "main"
        words: set[str] = set()
        if attrs and not hard:
            unshown = False
            for m in _ATTR.finditer(attrs):
                key, value = (m[1] or "").lower(), (m[2] or m[3] or m[4] or "").lower()
                if key in ("class", "id", "role"):
                    words.update(named(value))
                body = body or (key == "role" and value == "main") or (key == "itemprop" and value == "articlebody")
                main = main or body
                unshown = unshown or key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and bool(_UNSHOWN.search(value)))
            if name in ("html", "body", "main"):
                words.clear()
            else:
                head = head or bool(words & _HEADERS) and name != "article"
            hard = hard or unshown and not main and name not in ("html", "body")
        self.tag.append(name)
        self.parent.append(top)
        self.off.append(hard)
        self.main.append(main and not hard)
        self.hard.append(hard)
        self.words.append(frozenset(words & _NAMED))
        self.head.append(head)
        self.body.append(body)
        self.begin.append(len(self.tokens))
        self.end.append(-1)
        return len(self.tag) - 1

    def _judge(self) -> None:
        """What is deleted by its name, now that all the text is known.

        A name deletes no main element or articleBody and nothing around one, no
        article that is neither named nor held by one of ``_OTHERS`` and nothing
        around it, and no subtree with half of the text or more, unless a marked
        article with text lies outside it."""
        n, marks = len(self.tag), self.main
        free, others = [False] * n, [False] * n
        for i in range(1, n):
            others[i] = others[self.parent[i]] or bool(self.words[i] & _OTHERS)
        for i in range(n):
            if marks[i] and (self.body[i] or not others[i]):
                j = i
                while j >= 0 and not free[j]:
                    free[j] = True
                    j = self.parent[j]
        size, last = [0] * n, list(range(n))
        for node, text in self.runs:
            if not self.hard[node]:
                size[node] += len(text.strip())
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
            last[self.parent[i]] = max(last[self.parent[i]], last[i])
        by_word = [bool(self.words[i]) or self.head[i] and self.tag[i] != "header" for i in range(n)]

        def settle() -> None:
            self.off, self.main = [False] * n, [False] * n
            for i in range(1, n):
                off = self.hard[i] or self.off[self.parent[i]] or bool(self.words[i]) and not free[i]
                if self.head[i] and not off and not (by_word[i] and free[i]):  # the head of the site; an article's own head stays
                    up = self.parent[i]
                    while up > 0 and not self.main[up]:
                        up = self.parent[up]
                    off = up <= 0
                self.off[i], self.main[i] = off, marks[i] and not off

        settle()
        large = [i for i in range(1, n) if by_word[i] and not free[i] and not self.hard[i] and 2 * size[i] >= max(size[0], 1)]
        if large:
            # marked nodes with text must all lie around it
            marked = [i for i in range(n) if self.main[i] and size[i]]
            outer, end = max(marked, default=0), min((last[m] for m in marked), default=n)
            for i in large:
                free[i] = outer < i <= end
            settle()

    def _parse(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        names = ["html"]

        def close(depth: int) -> None:
            while len(stack) > depth:
                self.end[stack.pop()] = len(self.tokens)
                names.pop()

        def said(piece: str) -> None:
            if piece:
                self.tokens.append(" ".join(piece.split()))
                self.runs.append((stack[-1], html.unescape(piece) if "&" in piece else piece))

        while at < n:
            m = _TOKEN.search(source, at)
            if not m:
                said(source[at:])
                break
            said(source[at : m.start()])
            at, name = m.end(), (m[2] or "").lower()
            if not name:
                if m[0].startswith("<!") or m[0].startswith("<?") or m[0].endswith(">"):
                    continue
                break  # an unfinished tag at the end
            block = name not in _INLINE
            if block:
                self.runs.append((stack[-1], " "))
            if m[1]:
                if name in names[1:]:
                    close(len(names) - 1 - names[::-1].index(name))
                self.tokens.append(f"</{name}>")
                continue
            self.tokens.append(f"<{name}>")
            if name in _VOID:
                continue
            if name in ("html", "body"):
                if name == "body":
                    close(1)
                    stack.append(self._open(name, m[3], stack[-1]))
                    names.append(name)
                continue
            if block and "p" in names:
                depth = len(names) - 1 - names[::-1].index("p")
                if not set(names[depth + 1 :]) - _INLINE:
                    close(depth)
            if name in _CLOSED_BY:
                for depth in range(len(names) - 1, 0, -1):
                    if names[depth] in _CLOSED_BY[name]:
                        close(depth)
                        break
                    if names[depth] in _STOPS[name]:
                        break
            node = self._open(name, m[3] or "", stack[-1])
            if name in _RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                self.tokens.append(source[at : end.start() if end else n])
                self.end[node] = len(self.tokens)
                at = end.end() if end else n
                continue
            if not (m[3] or "").endswith("/") or name not in ("svg", "path", "use"):
                stack.append(node)
                names.append(name)
        close(1)
        self.end[0] = len(self.tokens)

    def read(self) -> tuple[list[tuple[list[int], str]], list[int]]:
        """([(hashes of the deletable subtrees around it, text)] of the main text, hashes of all deletable subtrees).

        Hashes of paragraphs are even, others odd. ``teasers`` is set if the text outside the page's articles is
        given, too, for the choice of ``FAIR``; ``own`` says of each text whether it is of a marked article."""
        n = len(self.tag)
        inside = [False] * n
        for i in range(n):
            inside[i] = self.main[i] or (i > 0 and inside[self.parent[i]])
        marked = any(self.main)
        around = [False] * n  # the marked article's own ancestors
        for i in range(n):
            if self.main[i]:
                j = i
                while j >= 0 and not around[j]:
                    around[j] = True
                    j = self.parent[j]
        size, total = [0] * n, 0
        kept = []
        self.teasers, self.own = False, []
        if marked and not any(m and b for m, b in zip(self.main, self.body)):
            said = [0, 0]
            for node, text in self.runs:
                if not self.off[node]:
                    said[inside[node]] += len(text.strip())
            self.teasers = 0 < FAIR * said[True] < said[False]
        for node, text in self.runs:
            if not self.off[node] and (inside[node] or not marked or self.teasers):
                kept.append((node, text))
                words = len(text.strip())
                total += words
                while words and node >= 0:
                    size[node] += words
                    node = self.parent[node]
        digest: dict[int, int] = {}
        for i in range(1, n):
            if around[i] or self.tag[i] in ("body", "head"):
                continue
            # beside teasers a block of any size may turn out a template: the articles are left then
            if 2 * size[i] >= max(total, 1) and not (self.teasers and not inside[i]):
                continue
            if inside[i] and marked and self.tag[i] not in _CONTAINERS and not self.off[i]:
                continue
            if self.off[self.parent[i]]:  # its root is deleted already
                continue
            body = "".join(self.tokens[self.begin[i] : self.end[i]])
            if body and (self.tag[i] not in _INLINE or self.tag[i] in _CONTAINERS):
                h = xxhash.xxh3_64_intdigest(f"{self.tag[i]}>{body}".encode("utf-8", "surrogatepass")) - (1 << 63)
                digest[i] = h & ~1 if self.tag[i] in _PARAGRAPHS else h | 1
        paths: dict[int, tuple[int, ...]] = {-1: ()}
        out: list[tuple[list[int], list[str]]] = []
        last: tuple[tuple[int, ...], bool] | None = None
        for node, text in kept:
            if node not in paths:
                todo = []
                while node not in paths:
                    todo.append(node)
                    node = self.parent[node]
                for x in reversed(todo):
                    paths[x] = paths[node] + ((digest[x],) if x in digest else ())
                    node = x
            if (paths[node], inside[node]) != last:
                last = paths[node], inside[node]
                out.append((list(last[0]), []))
                self.own.append(last[1])
            out[-1][1].append(text)
        return [(p, "".join(t)) for p, t in out], sorted(set(digest.values()))


def extracted(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE, many: int = MANY) -> DataFrame:
    """page_id, url, text, n_chars, n_templates of every page.

    text: blocks in page order joined by one space, white space inside one
    space, character references decoded; "" for a null or empty html or a page
    without main text. A subtree is a template if it occurs on at least
    ``min_pages`` different pages of its host and on ``share`` of them; other
    than paragraphs, list items, headings and the like, ``many`` different pages
    are enough on any host. Text outside article elements counts only beside
    teasers (``FAIR``; once templates are gone). A null url has the host "". Repeated rows stay and count as one page. Unclosed and
    misnested tags close as in a browser; an unfinished tag at the end is no
    text. No rows: no rows.
    """
    python_workers(pages.sparkSession, 1000)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url, source in zip(b["url"], b["html"]):
                page = Page(source if isinstance(source, str) else "")
                segments, subtrees = page.read()
                sig = xxhash.xxh3_64_intdigest("\x00".join(t for _, t in segments).encode("utf-8", "surrogatepass")) - (1 << 63)
                rows.append((host_of(url), sig, subtrees, [{"path": p, "text": t, "main": m} for (p, t), m in zip(segments, page.own)], page.teasers))
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "host": [r[0] for r in rows], "sig": [r[1] for r in rows], "subtrees": [r[2] for r in rows], "parts": [r[3] for r in rows], "teasers": [r[4] for r in rows]})

    schema = "page_id long, url string, host string, sig long, subtrees array<long>, parts array<struct<path: array<long>, text: string, main: boolean>>, teasers boolean"
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInPandas(parse, schema)
    rows = land(rows.withColumn("_row", F.monotonically_increasing_id()), "html_pages")
    seen = rows.select("host", "sig", F.explode("subtrees").alias("h")).distinct().groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    of = rows.select("host", "sig").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    enough = (F.col("n") >= share * F.col("pages")) | (F.col("n") >= many) & (F.col("h").bitwiseAND(F.lit(1)) == 1)
    often = seen.where(F.col("n") >= min_pages).join(of, "host").where(enough).select("host", "h")
    often = land(often, "html_templates")
    inner = F.array_distinct(F.flatten(F.transform("parts", lambda x: x["path"])))
    hit = rows.select("_row", "host", F.explode(inner).alias("h")).join(often, ["host", "h"]).groupBy("_row").agg(F.collect_set("h").alias("gone"))
    rows = rows.drop("subtrees").join(land(hit, "html_hits"), "_row", "left")
    gone = F.coalesce("gone", F.array().cast("array<long>"))
    kept = F.filter("parts", lambda x: ~F.arrays_overlap(x["path"], gone))
    # main text of a page of teasers: all that is left, unless the articles are a fair part of that
    own, other = F.filter(kept, lambda x: x["main"]), F.filter(kept, lambda x: ~x["main"])
    said = lambda parts: F.aggregate(parts, F.lit(0), lambda n, x: n + F.length(F.trim(x["text"])))
    kept = F.when(F.col("teasers") & (F.lit(FAIR) * said(own) >= said(other)), own).otherwise(kept)
    text = F.array_join(F.transform(kept, lambda x: x["text"]), "")
    text = F.trim(F.regexp_replace(text, r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", " "))
    return rows.select("page_id", "url", text.alias("text"), F.size(gone).alias("n_templates")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_templates")
