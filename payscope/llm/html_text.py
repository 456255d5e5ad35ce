"""HTML extraction by composite text density.

A tolerant tokenizer builds the DOM. What the contract names as no article text (menus, forms, adverts, ...) is cut out,
unless the article itself is inside; each node gets its link-adjusted characters per tag, and the subtree with the
greatest sum of child densities is taken, together with what reaches the least density on its path to the body.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/a-zA-Z][^>]*+(?:>|\Z)", re.S)
ATTR = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)")
#: Element kinds of HTML and MathML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mspace mstyle mfenced semantics".split()) | (VOID - {"br", "hr"})  # fmt: skip
#: Elements without article text: what the contract lists, and what a browser doesn't show as text.
DROPPED = RAW | frozenset("head nav footer aside form button dialog menu object canvas audio video annotation annotation-xml".split())
#: Words that mark what isn't article text, where a whole token of class, id or role consists of them and of PLACES.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside footer masthead topbar cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup login comment comments disqus respond reply replies share sharing social related recommended "
    "complementary contentinfo search alert alertdialog dialog form paywall skip toolbar pager pagination widget widgets "
    "commentlist copyright adsbygoogle".split())  # fmt: skip
#: Words that say where a block is or what holds it: `site-footer`, `left_sidebar`, `comment-list`; not `has-sidebar`, `notice-period`.
PLACES = frozenset(
    "site page main top bottom left right upper lower primary secondary global mobile desktop container wrapper wrap box inner outer area section block "
    "list item items link links bar button buttons icon icons post posts article articles story stories content body text title panel column col slot unit "
    "row group module component region zone sticky fixed floating header head reader user google facebook twitter fb js id the this tools tool count "
    "policy message info law accept settings trail teaser billboard leaderboard skyscraper".split())  # fmt: skip
#: Words of a header that is the article's own.
OWN = frozenset("article articles post posts story stories content body text".split())
READERS = frozenset("comment comments disqus respond reply replies".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements out of which an implied end doesn't reach.
SCOPE = frozenset("html body table ul ol dl article section main aside nav div blockquote form".split())
#: Marks of a node: by its element, by its attributes, by attributes that speak of readers' comments.
BY_TAG, BY_NAME, BY_READERS = 1, 2, 3
#: Without an article element, a marked block that holds more text than all that isn't marked, with at most this share
#: of it in links and at least so many paragraphs, is the article all the same.
MAX_LINK_SHARE = 0.3
MIN_PARAGRAPHS = 3


class Page:
    """Nodes in page order: a node's subtree is the run of numbers from it to last[node]. All steps are linear in the page."""

    def __init__(self, source: str):
        self.tags, self.parents, self.last, self.marks = ["#root"], [-1], [0], [0]
        self.pieces: list[tuple[int, str | None]] = []  # (owner, text), or (owner, None) where a block begins or ends
        self.stack: list[int] = [0]
        self.depths: dict[str, list[int]] = {}  # where in the stack elements of each kind are open
        self.scopes = [0]
        self._read(source)
        self.own = [0] * len(self.tags)
        for owner, text in self.pieces:
            if text:
                self.own[owner] += len("".join(text.split()))
        self.bad = self._judged()

    def _open(self, tag: str, attrs: str) -> int:
        node = len(self.tags)
        mark, tag = self._mark(tag, attrs)
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.last.append(node)
        self.marks.append(mark)
        if tag not in INLINE:
            self.pieces.append((node, None))
        return node

    def _mark(self, tag: str, attrs: str) -> tuple[int, str]:
        """The mark of an element, and its kind: a role can make any element an article or the main one."""
        inside = bool(self.depths.get("article") or self.depths.get("main"))
        if tag in DROPPED or tag == "header" and not inside or attrs and HIDDEN.search(attrs):
            return BY_TAG, tag
        mark = 0
        for m in ATTR.finditer(attrs) if attrs else ():
            name = m[1].lower()
            if name in ("class", "id", "role"):
                tokens = _tokens(m)
                if name == "role" and tag in ("div", "section") and tokens in ([{"main"}], [{"article"}]):
                    tag = next(iter(tokens[0]))
                for words in tokens:
                    if words & BOILERPLATE and words <= BOILERPLATE | PLACES or not inside and name != "role" and "header" in words and words <= PLACES - OWN:
                        mark = max(mark, BY_READERS if words & READERS else BY_NAME)
            elif name == "style" and re.search(r"display\s*:\s*none", m[0], re.I):
                return BY_TAG, tag
        if tag in ("html", "body", "main") or tag == "article" and mark != BY_READERS:
            mark = 0
        return mark, tag

    def _close(self, depth: int) -> None:
        end, stack = len(self.tags) - 1, self.stack
        while len(stack) > depth:
            node = stack.pop()
            tag = self.tags[node]
            self.last[node] = end
            if node and tag not in INLINE:
                self.pieces.append((node, None))
            if node:
                self.depths[self.names.pop()].pop()
            if self.scopes and self.scopes[-1] == len(stack):
                self.scopes.pop()

    def _read(self, source: str) -> None:
        stack, at = self.stack, 0
        self.names: list[str] = []  # as written, of the open elements above the root
        while at < len(source):
            m = TOKEN.search(source, at)
            if not m:
                self.pieces.append((stack[-1], source[at:]))
                break
            if m.start() > at:
                self.pieces.append((stack[-1], source[at : m.start()]))
            at = m.end()
            if m["tag"] is None:
                continue
            tag, attrs = m["tag"].lower(), m["attrs"] or ""
            if m["close"]:
                if open_ := self.depths.get(tag):
                    self._close(open_[-1])
                continue
            shut = CLOSES.get(tag, {"p"} if tag not in INLINE and tag not in VOID else ())
            # the outermost of these above the nearest scope, with all that is open in it
            reach = [open_[k] for name in shut if (open_ := self.depths.get(name)) and (k := bisect.bisect_right(open_, self.scopes[-1])) < len(open_)]
            if reach:
                self._close(min(reach))
            node = self._open(tag, attrs)
            if tag in VOID or attrs.endswith("/") and tag in ("svg", "path"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if tag in SCOPE:
                self.scopes.append(len(stack))
            self.depths.setdefault(tag, []).append(len(stack))
            self.names.append(tag)
            stack.append(node)
        self._close(0)

    def _judged(self) -> list[bool]:
        """Which nodes are cut out. A mark by name is void where the article itself is inside."""
        n = len(self.tags)
        under = [0] * n  # the strongest mark on the way to the root
        chars, links, paragraphs, linked = [0] * n, [0] * n, [0] * n, [False] * n
        dropped = [False] * n
        for i in range(1, n):
            p = self.parents[i]
            under[i] = max(under[p], self.marks[i] if self.marks[i] != BY_TAG else 0)
            dropped[i] = dropped[p] or self.marks[i] == BY_TAG
            linked[i] = linked[p] or self.tags[i] == "a"
        for i in range(n - 1, -1, -1):
            if dropped[i]:
                continue
            chars[i] += self.own[i]
            links[i] += self.own[i] * linked[i]
            if i:
                p = self.parents[i]
                chars[p] += chars[i]
                links[p] += links[i]
                paragraphs[p] += paragraphs[i] + (self.tags[i] == "p")
        void: set[int] = set()
        articles = [i for i in range(1, n) if self.tags[i] in ("article", "main") and not dropped[i] and chars[i] and under[i] != BY_READERS]
        if articles:
            if not any(under[i] == 0 for i in articles):
                at = max(articles, key=lambda i: (chars[i], -i))
                while at > 0:
                    void.add(at)
                    at = self.parents[at]
        else:
            free = sum(self.own[i] for i in range(n) if not dropped[i] and not under[i])
            named = [i for i in range(1, n) if self.marks[i] == BY_NAME and not dropped[i] and not under[self.parents[i]]]
            best = max(named, key=lambda i: (chars[i], -i), default=0)
            if best and chars[best] > free and links[best] <= MAX_LINK_SHARE * chars[best] and paragraphs[best] >= MIN_PARAGRAPHS:
                void.add(best)
        bad = [False] * n
        for i in range(1, n):
            bad[i] = bad[self.parents[i]] or self.marks[i] == BY_TAG or self.marks[i] > BY_TAG and i not in void
        return bad

    def densities(self) -> tuple[list[float], list[float], list[int]]:
        """Density and sum of child densities of each node, and its characters. Where no text is linked, all are 0 and the body stays whole."""
        n = len(self.tags)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        linked = [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parents[i]] or self.tags[i] in ("a", "button", "select")
        for i in range(n - 1, -1, -1):
            if self.bad[i]:
                continue
            chars[i] += self.own[i]
            link_chars[i] += self.own[i] * linked[i]
            if i:
                p = self.parents[i]
                chars[p] += chars[i]
                link_chars[p] += link_chars[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + linked[i]
        share = link_chars[0] / max(1, chars[0])
        density, total = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            c, lc = chars[i], link_chars[i]
            if c and not self.bad[i]:
                t = max(1, tags[i])
                base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
                value = math.log(max(1.0, c / max(1, lc) * t / max(1, link_tags[i]))) / max(math.log(base), 1.0) if base > 1 else 0.0
                density[i] = c / t * value
            if i:
                total[self.parents[i]] += density[i]
        return density, total, chars

    def content(self) -> str:
        density, total, chars = self.densities()
        if not chars[0]:
            return ""
        n, tags, parents = len(self.tags), self.tags, self.parents
        body = next((i for i, t in enumerate(tags) if t == "body"), 0)
        body = body if chars[body] == chars[0] else 0
        # the node of the greatest sum in each subtree, and what a node stands for: its article, else the outermost main element, else itself
        best, holder, article, main = list(range(n)), list(range(n)), [-1] * n, [-1] * n
        rank = lambda i: (total[i], chars[i], -i)
        for i in range(n - 1, 0, -1):
            if rank(best[i]) > rank(best[parents[i]]):
                best[parents[i]] = best[i]
        for i in range(1, n):
            p = parents[i]
            article[i] = i if tags[i] == "article" else article[p]
            main[i] = main[p] if main[p] >= 0 else i if tags[i] == "main" else -1
            holder[i] = article[i] if article[i] >= 0 else main[i] if main[i] >= 0 else i
        # the least density on the way from the best node to the body is what other parts have to reach
        threshold, at = density[body], best[body]
        while at >= 0 and at != body:
            threshold = min(threshold, density[at]) if density[at] > 0 else threshold
            at = parents[at]
        roots = {holder[best[body]]}
        roots |= {holder[best[i]] for i in range(body + 1, self.last[body] + 1) if chars[i] and not self.bad[i] and density[i] >= threshold}
        keep = [False] * n
        for i in range(n):
            keep[i] = not self.bad[i] and (i in roots or parents[i] >= 0 and keep[parents[i]])
        return self._render(keep)

    def _render(self, keep: list[bool]) -> str:
        blocks, block = [], []
        for owner, text in [*self.pieces, (0, None)]:
            if text is None:
                if block and (words := html.unescape("".join(block)).split()):
                    blocks.append(" ".join(words))
                block = []
            elif keep[owner]:
                block.append(text)
        return " ".join(blocks)


def _tokens(m: re.Match) -> list[set[str]]:
    """The words of each token of an attribute's value: `siteFooter` and `site-footer` are {site, footer}; digits and single letters are no words."""
    value = m[2] or m[3] or m[4] or ""
    split = (re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) for token in value.split())
    return [words for token in split if (words := {w for w in token if len(w) > 1})]


def main_text(source: str | None) -> str:
    return Page(source).content() if source else ""


SCHEMA = "page_id bigint, url string, text string, n_chars bigint"
ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars (code points).

    Null and empty pages, and pages without article text, give an empty text. Of subtrees with equal sums the one with
    more characters is taken, then the first. Repeated rows give repeated results, empty tables none; other columns, of
    whatever name, aren't read. Pages are read whole, in time linear in their length, malformed ones too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=ARROW)

    return pages.select(F.col(f"`{page_id}`").cast("bigint"), F.col(f"`{url}`").cast("string"), F.col(f"`{source}`").cast("string")).mapInArrow(run, SCHEMA)


digest = extract
