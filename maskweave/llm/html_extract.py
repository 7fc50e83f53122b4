"""Main text of web pages by consensus paths of their hosts.

1. Every page is parsed once: its containers collect the text of their
   paragraphs, less the text of links, and the best one names a generalised
   path (tags with classes, digits as ``N``).
2. Hosts vote in Spark: the path that most pages of a host name wins, ties
   go to the larger text, then to the path that sorts first.
3. Every page is parsed again with the path of its host.  A page without a
   container at that path uses the container that is best in itself.

The text of a container leaves out menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, markup and reader comments.  Names decide as
little as they can: none drops an inline element, a whole name such as
"notice" drops a paragraph, no name but those of comments and the like a
heading, and a box whose name only mentions such a word ("related-work") goes
by its links and text (``Mark.prose``).  A form or an element that is only
named so is kept where it wraps the page's main or nearly all of its text
(``Page._wrapper``).  Character
references are decoded, white space in a block becomes one space, blocks are
trimmed and joined by two line feeds.  Nothing else is dropped, whole pages
are read.  A null page or one without text gives an empty string; a null URL
belongs to the host ''.  Repeated rows give equal rows; other columns are
ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import attach_group

# Element names of the HTML standard by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset("script style textarea title xmp iframe noembed noframes noscript head template nav header "
                    "footer aside form button select datalist svg canvas object audio video dialog menu math "
                    "map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr "
                   "output progress q rp rt ruby s samp script small span strike strong style sub sup template time "
                   "tt u var wbr img input br noscript svg math select button td th".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary "
                     "table ul".split())
CONTAINERS = frozenset("body div section article main td center blockquote dd figure fieldset details".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
               "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
          "th": ("tr", "table"), "option": ("select",)}
# Words in class, id or role that name what is not the article.
NOT_TEXT = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo sidebar "
                     "aside menu nav navbar navigation breadcrumb breadcrumbs header masthead footer notice notices "
                     "cookie cookies consent gdpr alert popup modal overlay comment comments reply replies disqus "
                     "respond share sharing social related recommended recommendations newsletter subscribe signup "
                     "login form widget widgets toolbar pager pagination skip hidden complementary contentinfo "
                     "search dialog".split())

# Words that tell the place or kind of a box and not what it is about: they
# are passed over at the end of a name, as in "sidebar-left" and "related-posts".
LAYOUT = frozenset("area articles bar block body bottom box buttons card cell col column container content entries field "
                   "group holder icons image inner item items left link links list main message module news outer "
                   "pages panel posts primary region right row secondary section slot stories text top unit videos "
                   "wrap wrapper zone".split())
# Elements of running text: dropped by a whole name only, as in class="notice".
TEXT_LEVEL = frozenset("p blockquote pre li dt dd td th tr figcaption caption address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Names below which other texts than the article are long.
OTHERS = frozenset("comment comments reply replies disqus respond related recommended recommendations cookie cookies "
                   "consent gdpr hidden".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|([^<]+|<)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Za-z]+")
# The part of a class that tells a state of the whole, as in "has-sidebar" and
# "page-with-sidebar".
_STATE = re.compile(r"(?:^|(?<=[-_]))(?:has|no|with|without|not|is)-.*")


def _head(words: list[str]) -> str | None:
    """The last word of a name that is not one of LAYOUT."""
    return next((w for w in reversed(words) if w not in LAYOUT), None)


class Mark:
    """An element dropped by its name: where it begins, the marked element
    around it, if it is a form or the word only describes its name (``weak``),
    also where words of LAYOUT are passed over (``aside``), if it is of OTHERS,
    and what it holds outside of marked elements in it: ``size`` characters,
    ``text`` less those of links twice."""

    __slots__ = ("at", "outer", "weak", "aside", "others", "text", "size", "main", "article")

    def __init__(self, at, outer, weak, aside, others):
        self.at, self.outer, self.weak, self.aside, self.others = at, outer, weak, aside, others
        self.text, self.size, self.main, self.article = 0, 0, False, False

    def prose(self) -> bool:
        """Running text below a name that is about something else, as in
        "related-work" and "ad-free"."""
        return self.aside and self.size > 0 and self.text >= (1 if self.others else 0.6) * self.size


class Page:
    """One parsed page.  ``containers`` lists [path, score, blocks] in page
    order, best(path) picks text."""

    def __init__(self, source: str):
        spared: set[int] = set()
        while True:
            self.root = ["", 0.0, [], None, False, 0.0, 0]
            self.containers = [self.root]
            self.whole = Mark(0, None, False, False, False)  # what is kept
            marks = self._parse(source, spared)
            more = [m for m in marks if m.outer is None and m.prose()]
            if not more:
                more = [m for m in [self._wrapper(marks)] if m is not None]
            if not more:
                break
            for mark in more:
                while mark is not None:
                    spared.add(mark.at)
                    mark = mark.outer

    def _wrapper(self, marks):
        """The marked element with the most text that is no part of the page
        but wraps it: it holds the only main, or the only article and more text
        than is kept, or, named weakly, three times the text that is kept."""
        kept = self.whole
        found = [m for m in marks if (m.main and not kept.main) or not m.others and (
            m.article and not (kept.main or kept.article) and m.text > kept.text
            or m.weak and m.text > 3 * max(kept.text, 0))]
        return max(found, key=lambda m: (m.main, m.text), default=None)

    def _parse(self, source: str, spared: set[int]) -> list[Mark]:
        # stack entry: tag, container, dropped, in a link
        marks: list[Mark] = []
        stack = [("", self.root, False, False)]
        words: list[str] = []     # of the open block
        linked = 0                # characters of it that are in links

        def flush():
            nonlocal linked
            text = " ".join("".join(words).split()) if words else ""
            if text:
                box = stack[-1][1]
                weight = max(len(text) - 2 * linked, -len(text))
                box[2].append(text)
                box[1] += weight
                if box[3] is not None:
                    box[3][1] += weight / 2
                while box is not None:
                    box[5] += weight
                    box = box[3]
            words.clear()
            linked = 0

        raw, at, n = None, 0, len(source)
        while at < n:
            if raw is not None:  # the content of script and the like is not markup
                end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(source, at)
                at, raw = (end.start() if end else n), None
                continue
            m = _TOKEN.match(source, at)
            begin, at = at, m.end()
            text = m[7]
            if text is not None:
                holder = stack[-1][2] or self.whole
                if holder is not True:
                    holder.size += len(text.strip())
                    holder.text += -len(text.strip()) if stack[-1][3] else len(text.strip())
                if not stack[-1][2]:
                    text = html.unescape(text) if "&" in text else text
                    words.append(text)
                    if stack[-1][3]:
                        linked += len(text.strip())
                continue
            name = m[2] or m[5]
            if name is None:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._close(stack, name, flush)
                continue
            if name == "br":
                if not stack[-1][2]:
                    words.append(" ")
                continue
            if name not in INLINE:
                flush()
                if name in CLOSES_P:
                    self._pop_to(stack, ("p",), CONTAINERS | {"li", "td", "th", "table"}, flush)
            if name in SAME_CLOSES:
                self._pop_to(stack, SAME_CLOSES[name], SCOPES[name], flush)
                if name in ("td", "th") and not stack[-1][2]:
                    words.append(" ")
            if name in VOID:
                continue
            attrs = m[3] if m[2] else m[6]
            own, dropped = "", stack[-1][2]
            if name in DROPPED and name != "form":
                dropped = True
            if dropped is not True:
                got = {}
                for a in _ATTR.finditer(attrs or ""):
                    got.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
                own = got.get("class", "")
                if name in ("main", "article"):
                    setattr(dropped or self.whole, name, True)
                if name not in ("html", "body", "main", "article"):
                    named = f"{own} {got.get('id', '')} {got.get('role', '')}".lower().split()
                    parts = [_WORD.findall(_STATE.sub("", x)) for x in named]
                    if name == "form":
                        parts = [[w for w in x if w != "form"] for x in parts]
                    if name in INLINE and name not in ("td", "th"):
                        parts = []  # within a block nothing goes by its name
                    elif name in TEXT_LEVEL or name in HEADINGS:
                        parts = [x for x in parts if len(x) == 1]
                    if name in HEADINGS:
                        parts = [x for x in parts if x[0] in OTHERS]
                    words_in = {w for x in parts for w in x}
                    if "hidden" in got:
                        dropped = True
                    elif begin not in spared and (name == "form" or not NOT_TEXT.isdisjoint(words_in)):
                        weak = not any(x and x[-1] in NOT_TEXT for x in parts)
                        aside = name != "form" and not any(_head(x) in NOT_TEXT for x in parts)
                        dropped = Mark(begin, dropped or None, weak, aside, not OTHERS.isdisjoint(words_in))
                        marks.append(dropped)
            if dropped and not stack[-1][2] and name not in INLINE:
                flush()
            box = stack[-1][1]
            if name in CONTAINERS and not dropped:
                step = ".".join([name, *sorted(set(re.sub(r"\d+", "N", own).lower().split()))])
                box = [f"{box[0]}/{step}", 0.0, [], box, False, 0.0, 0]
                self.containers.append(box)
                # a container's place among the blocks of the one around it
                box[3][2].append(box)
            if name in HEADINGS and not dropped:
                around = box
                while around is not None:
                    around[6], around = around[6] + 1, around[3]
            if name == "h1" and not dropped:
                around = box
                while around is not None and not around[4]:
                    around[4], around = True, around[3]
            if name in RAW:
                raw = re.escape(name)
            stack.append((name, box, dropped, stack[-1][3] or name == "a"))
        flush()
        return marks

    @staticmethod
    def _pop_to(stack, names, scope, flush) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                flush()
                del stack[k:]
                return
            if stack[k][0] in scope:
                return

    @staticmethod
    def _close(stack, name, flush) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == name:
                if any(e[0] not in INLINE for e in stack[k:]):
                    flush()
                del stack[k:]
                return
            if name in INLINE and stack[k][0] in CONTAINERS:
                return

    def best(self):
        """The container with the highest score; article and main count
        double, the first of equals wins.  One without the title gives way to
        the next around it that has an h1, below body, so that the parts of an
        article stay together.  On a page without an h1 it gives way, below
        body, to a container around it that adds text: a tenth of its own, or
        any with a heading."""
        def tag(box):
            return box[0].rpartition("/")[2].split(".")[0]

        def score(box):
            return box[1] * (2 if tag(box) in ("article", "main") and box[1] > 0 else 1)

        top = max(self.containers, key=score)
        if self.root[4]:
            whole = top
            while whole is not None and not whole[4]:
                whole = whole[3]
            return top if whole is None or tag(whole) in ("", "body") else whole
        around = top
        while tag(around) not in ("", "body", "article", "main"):
            more = around[5] - top[5]
            if more > 0 and (more >= 0.1 * top[5] or around[6] > top[6]):
                top = around
            around = around[3]
        return top

    def text(self, path: str | None) -> str:
        """The text at ``path``, or of the best container if there is none."""
        boxes = [b for b in self.containers if b[0] == path] if path is not None else []
        blocks: list[str] = []
        for box in boxes or [self.best()]:
            self._gather(box, blocks)
        return "\n\n".join(blocks)

    @staticmethod
    def _gather(box, out: list[str]) -> None:
        todo = [iter(box[2])]
        while todo:
            for x in todo[-1]:
                if isinstance(x, str):
                    out.append(x)
                else:
                    todo.append(iter(x[2]))
                    break
            else:
                todo.pop()


def _score(batches):
    for b in batches:
        hosts, paths, sizes = [], [], []
        for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if source:
                box = Page(source).best()
                hosts.append(host), paths.append(box[0]), sizes.append(float(box[1]))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                          pa.array(sizes, pa.float64())], ["host", "path", "size"])


def _extract(batches):
    for b in batches:
        out = [Page(source).text(path) if source else ""
               for source, path in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())],
                                         ["page_id", "url", "text"])


def host(url):
    """Lower-case host of a URL without user and port, '' if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
                      F.lit(""))


def consensus(pages: DataFrame) -> DataFrame:
    """(host, path, pages): the winning path and number of pages of each host."""
    votes = (pages.select(host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
             .mapInArrow(_score, "host string, path string, size double")
             .groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.round("size")).alias("size")))
    return (votes.groupBy("host")
            .agg(F.min(F.struct(-F.col("n"), -F.col("size"), "path")).alias("top"), F.sum("n").alias("pages"))
            .select("host", F.col("top.path").alias("path"), "pages"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    from maskweave.session import materialize

    winners = materialize(consensus(pages), "host-paths")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host(F.col("url")).alias("host"))
    return (attach_group(rows, winners, "host", "pages").select("page_id", "url", "html", "path")
            .mapInArrow(_extract, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
