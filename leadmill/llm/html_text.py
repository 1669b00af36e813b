"""Main text of web pages by line-block distribution.

Markup is stripped first: every block element starts a line, and a line knows whether it
lies inside the article's own element, or inside an element that holds something else
(menus, headers, footers, sidebars, notices, adverts, forms, comments, hidden parts).
Lengths of text are then summed over sliding windows of lines, where lines that hold
something else count nothing. Where the sum surges above a bar of ``SURGE`` characters the
main text begins, where it dives to zero it ends. The lines between say where the main text
is, and what they are in is kept but for what holds something else. On pages with
``article`` or ``main`` elements only lines in these have a length, windows end with them,
and the outermost ones with a surge are kept; if none has, all of them. On others lines
made of links count nothing, the containers (``div`` and the like) around the lines found
are kept, and so are headings right before. If no sum is above the bar, the container with
most running text is taken.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import mapped

WIDTH = 3
SURGE = 86
LINKED = 0.5
# Element names and words in class, id and role that say what a part holds.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol option p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = (
    "script style noscript template textarea svg annotation annotation-xml iframe object "
    "canvas title"
)
OTHER_TAGS = frozenset(
    "head nav footer aside form button select menu dialog audio video map".split()
)
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted "
    "banner cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup paywall sidebar rail widget widgets menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager toolbar topbar masthead footer "
    "copyright share sharing social related recommended recommendations trending popular "
    "comment comments respond reply replies disqus login search skip contentinfo "
    "complementary alertdialog dialog hidden".split()
)
OUTSIDE_WORDS = frozenset(["header", "side", "alert", "top"])
# What other articles are said to be, on them or around them.
KIND_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted "
    "related recommended recommendations trending popular comment comments respond reply "
    "replies disqus".split()
)
# Names that only tell which parts a page has, as has-sidebar or comments-open.
_MODIFIERS = frozenset(["has", "no", "with", "without"])
_STATES = frozenset(["open", "closed", "enabled", "disabled"])
# Ids of sections and headings inside the article are anchors, but for these.
_PARTS = frozenset("comment comments respond replies disqus newsletter sidebar".split())
_ANCHORED = frozenset("section h1 h2 h3 h4 h5 h6".split())
#: How surely an element holds something else: by a word for a place on the page, by a
#: word for another kind of article, or by its element or being hidden.
PLACE, KIND, SURE = 1, 2, 3
# Elements that hold the lines of one part of a page.
CONTAINERS = frozenset("article center div fieldset main section td th".split())
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_TAG_SIGN = re.compile("[>\"']")
_RAW_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split()}
_ATTRIBUTE = re.compile(
    r"([A-Za-z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HEADING = re.compile("h[1-6]$")
# What ends an open paragraph, and which open element a new one of its kind ends.
_SIBLINGS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}


class Place:
    """A container on a page; that of the page itself is None."""

    __slots__ = ("above",)

    def __init__(self, above: Place | None):
        self.above = above


@dataclass
class Line:
    own: bool  # in the article's element
    other: int  # in an element that holds something else: 0, PLACE, KIND or SURE
    heading: bool
    frame: int = 0  # the article's element, if words on or around it speak against it
    form: int = 0  # the outermost form around it, unless an article's element is inside
    place: Place | None = None
    article: int = 0  # the outermost article's element around it
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _said(name: str, value: str, tag: str, inside: bool) -> int:
    """What class, id or role say about an element: 0, PLACE or KIND."""
    most = 0
    for part in value.split():
        words = [word.lower() for word in _WORD.findall(part)]
        if not words:
            continue
        if len(words) > 1 and (words[0] in _MODIFIERS or words[-1] in _STATES):
            continue
        if inside and name == "id" and tag in _ANCHORED and not _PARTS.issuperset(words):
            continue
        if not KIND_WORDS.isdisjoint(words):
            most = KIND
        elif not OTHER_WORDS.isdisjoint(words) or (
            not inside and not OUTSIDE_WORDS.isdisjoint(words)
        ):
            most = max(most, PLACE)
    return most


def _role(tag: str, rest: str, inside: bool) -> tuple[bool, int]:
    """Whether an element is the article's own, and how it holds something else."""
    own = tag in ("article", "main")
    sure = (tag in OTHER_TAGS and tag != "form") or (tag == "header" and not inside)
    other = 0
    if rest.strip(" /"):
        for name, value in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role"):
                other = max(other, _said(name, value, tag, inside))
                own |= name == "role" and value.lower() in ("main", "article")
                # What is hidden by name is so, whatever it holds.
                sure |= name == "class" and "hidden" in value.lower().split()
            elif name == "itemprop":
                own |= value == "articleBody"
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                sure = True
            elif name == "style":
                flat = value.replace(" ", "").lower()
                sure |= "display:none" in flat or "visibility:hidden" in flat
    if inside and tag not in BLOCKS:
        other = 0  # a name on words of a paragraph does not take them out of it
    if tag in ("html", "body"):
        return own, 0  # classes of the whole page say nothing about a part
    return own, SURE if sure else other


class Tokens:
    """The markup of a page from left to right, in time that grows with its length.

    A tag ends at the first ``>`` outside of quotes. Where each search for it would end is
    noted from the end of the page backwards, so tags that never close cost no more.
    """

    def __init__(self, page: str):
        self.page = page
        self.signs = [match.start() for match in _TAG_SIGN.finditer(page)]
        self.ends = [-1] * (len(self.signs) + 1)
        later = {'"': -1, "'": -1}
        for n in range(len(self.signs) - 1, -1, -1):
            sign = page[self.signs[n]]
            if sign == ">":
                self.ends[n] = self.signs[n]
            else:
                partner, later[sign] = later[sign], n
                if partner >= 0:
                    self.ends[n] = self.ends[partner + 1]
        self.last = page.rfind(">")
        self.last_data = page.rfind("]]>")

    def _end(self, at: int) -> int:
        """Where the tag ends whose attributes begin here; -1 if it never does."""
        return self.ends[bisect_left(self.signs, at)]

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """The next markup: where it starts and stops, its kind, and two texts.

        The kinds: ``tag`` and ``close`` with a name and attributes, ``data`` with a text,
        ``skip``. Other signs ``<`` are text.
        """
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), "skip", "", ""
            if page.startswith("<![CDATA[", at) and at + 9 <= self.last_data:
                end = page.find("]]>", at + 9)
                return at, end + 3, "data", page[at + 9 : end], ""
            if page.startswith(("<!", "<?"), at):
                if at < self.last:
                    return at, page.find(">", at) + 1, "skip", "", ""
            elif match := _TAG.match(page, at):
                end = self._end(match.end())
                if end >= 0:
                    kind = "close" if match[1] else "tag"
                    return at, end + 1, kind, match[2].lower(), page[match.end() : end]
            at += 1
        return None


def lines_of(page: str) -> list[Line]:
    """The lines of a page in order."""
    lines = [Line(False, 0, False)]
    stack: list[tuple[str, tuple[bool, int, int, int, Place | None, int]]] = []
    at = frames = forms = articles = 0
    levels = {0: 0}
    opened: dict[str, int] = {}  # how many elements of a name are open

    def state() -> tuple[bool, int, int, int, Place | None, int]:
        return stack[-1][1] if stack else (False, 0, 0, 0, None, 0)

    def line() -> None:
        own, other, frame, form, place, article = state()
        heading = any(_HEADING.match(tag) for tag, _ in stack[-3:])
        lines.append(Line(own, other, heading, frame, form, place, article))

    def add(text: str) -> None:
        if text:
            plain = html.unescape(text)
            lines[-1].parts.append(plain)
            if "a" in opened:
                lines[-1].linked += len(plain.strip())

    def close(names: set[str], until: frozenset[str] = frozenset()) -> bool:
        if opened.keys().isdisjoint(names):
            return False
        for place in range(len(stack) - 1, -1, -1):
            if stack[place][0] in names:
                for name, _ in stack[place:]:
                    if opened[name] == 1:
                        del opened[name]
                    else:
                        opened[name] -= 1
                del stack[place:]
                return True
            if stack[place][0] in until:
                return False
        return False

    scopes = frozenset("article aside body div footer form header main nav ol section table td th ul dl".split())
    tokens = Tokens(page)
    while at < len(page):
        token = tokens.next(at)
        if token is None:
            add(page[at:])
            break
        add(page[at : token[0]])
        _, at, kind, tag, rest = token
        if kind == "data":
            add(html.escape(tag, quote=False))
            continue
        if kind == "skip":
            continue
        if kind == "close":
            if tag in BLOCKS or tag in OTHER_TAGS:
                if tag != "br" and close({tag}):
                    line()
                elif tag in BLOCKS:
                    line()
            else:
                before = state()
                close({tag}, BLOCKS)
                if state() != before:
                    line()
            continue
        if tag in _RAW_ENDS:
            end = _RAW_ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            close({"p"}, scopes)
            if tag == "body":
                close({"head"})
            if tag in _SIBLINGS:
                close(_SIBLINGS[tag], frozenset(["ul", "ol", "dl", "table", "select"]))
        if tag in VOID:
            if tag in BLOCKS:
                line()
            continue
        before = state()
        own, other, frame, form, place, article = before
        mine, foreign = _role(tag, rest, own)
        other = max(other, foreign)
        if mine and PLACE <= other <= KIND:
            # Words on an article or around it do not decide alone: see _settle.
            frames += 1
            frame, levels[frames], other = frames, max(other, levels[frame]), 0
        if mine and not own:
            form = 0
            articles += 1
            article = articles
        if tag == "form" and not form:
            forms += 1
            form = forms
        if tag in CONTAINERS:
            place = Place(place)
        opened[tag] = opened.get(tag, 0) + 1
        stack.append((tag, (own or mine, other, frame, form, place, article)))
        if tag in BLOCKS or state() != before:
            line()
    _settle(lines, levels)
    return lines


def _settle(lines: list[Line], levels: dict[int, int]) -> None:
    """Decides on forms, and on articles with words on or around them that speak against.

    A form around more running text than the rest of the page is that of the whole page and
    says nothing, nor does one around an article. An article under a word for a place is other
    unless it is longer than each article without; one under a word for another kind of
    article also if there is any without. On pages without such articles both have to be
    longer than the running text around them.
    """
    plain: list[tuple[Line, int, int]] = []
    for each in lines:
        if each.other < PLACE:
            size = len(each.text())
            if size:
                plain.append((each, size, 0 if each.linked > LINKED * size else size))
    inside: dict[int, int] = {}
    running: set[int] = set()
    for each, _, size in plain:
        inside[each.form] = inside.get(each.form, 0) + size
        if size >= SURGE:
            running.add(each.form)
    total = sum(inside.values())
    clear = {
        form
        for form in inside
        if form and form in running and 2 * inside[form] > total
    }
    for each in lines:
        if each.form and each.form not in clear:
            each.other = SURE
    if len(levels) == 1:
        return
    sizes: dict[int, int] = {}
    open_size = 0
    for each, size, run in plain:
        if each.other < PLACE:
            if each.own:
                sizes[each.frame] = sizes.get(each.frame, 0) + size
            else:
                open_size += run
    free = sizes.get(0, 0)
    bar = free or open_size
    dropped = {
        frame: level
        for frame, level in levels.items()
        if level and (sizes.get(frame, 0) <= bar or (level == KIND and free))
    }
    for each in lines:
        if each.frame in dropped:
            each.other = max(each.other, dropped[each.frame])


def main_text(page: str | None, width: int = WIDTH, surge: int = SURGE) -> str:
    """The blocks of the main text, joined by blank lines; empty if there are none."""
    if not page:
        return ""
    held = [(line, text) for line in lines_of(page) if (text := line.text())]
    framed = any(line.own and not line.other for line, _ in held)

    def length(line: Line, text: str) -> int:
        if line.other or (framed and not line.own):
            return 0
        if not framed and line.linked > LINKED * len(text):
            return 0
        return len(text)

    sizes = [length(line, text) for line, text in held]
    if framed:
        members: dict[int, list[int]] = {}
        for size, (line, _) in zip(sizes, held, strict=True):
            members.setdefault(line.article, []).append(size)
        # Windows end with the article's element.
        chosen = {at for at, own in members.items() if _surges(own, width, surge)}
        kept = {
            n
            for n, (line, _) in enumerate(held)
            if sizes[n] and (not chosen or line.article in chosen)
        }
    else:
        kept = _extended(held, sizes, _surges(sizes, width, surge), surge)
    return "\n\n".join(held[n][1] for n in sorted(kept))


def _surges(sizes: list[int], width: int, bar: int) -> set[int]:
    """Lines with a length between a surge of the window's sum and its dive to zero."""
    found: set[int] = set()
    at = 0
    while at < len(sizes):
        if not sizes[at] or sum(sizes[at : at + width]) <= bar:
            at += 1
            continue
        end = at
        while end < len(sizes) and sum(sizes[end : end + width]):
            end += 1
        found.update(n for n in range(at, end) if sizes[n])
        at = end + 1
    return found


def _extended(
    held: list[tuple[Line, str]], sizes: list[int], found: set[int], surge: int
) -> set[int]:
    """The lines found, those of their containers, and headings right before them.

    Without any, those of the container with most running text; a single word is none.
    Containers inside are taken too if they are not mostly links. Of lines outside all
    containers, links at the edges stay out.
    """
    members: dict[Place | None, list[int]] = {}
    for n, (line, _) in enumerate(held):
        if not line.other:
            members.setdefault(line.place, []).append(n)
    if found:
        # Short lines that are just next to the main text say nothing on where it is.
        chosen = {held[n][0].place for n in found if 2 * sizes[n] > surge}
        chosen = chosen or {held[n][0].place for n in found}
    else:

        def running(place: Place | None) -> int:
            return sum(
                sizes[n]
                for n in members[place]
                if not held[n][0].heading and " " in held[n][1]
            )

        best = max(members, key=running, default=None)
        if best not in members or not running(best):
            return set()
        chosen = {best}
    # A container of one line is a paragraph; what it is in is meant.
    chosen = {
        place.above
        if place and len(members[place]) == 1 and place.above
        else place
        for place in chosen
    }
    known: dict[Place | None, bool] = {None: None in chosen}

    def taken(place: Place | None) -> bool:
        path = []
        while place not in known:
            path.append(place)
            place = place.above
        for inner in reversed(path):
            own = members.get(inner, [])
            links = sum(not sizes[n] for n in own)
            above = inner.above is not None and known[inner.above]
            known[inner] = inner in chosen or (above and 2 * links <= len(own))
        return known[path[0]] if path else known[place]

    kept = set(found)
    for place, own in members.items():
        if taken(place):
            text = [n for n in own if sizes[n]]
            if place is not None:
                kept.update(own)
            elif text:
                kept.update(n for n in own if text[0] <= n <= text[-1])
    for n in sorted(kept, reverse=True):
        while n and held[n - 1][0].heading and sizes[n - 1]:
            n -= 1
            kept.add(n)
    return kept


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``<id>, <url>, text, n_chars`` of every row.

    Null and empty pages, and pages without main text, give an empty text. ``n_chars``
    counts code points. Repeated rows all stay; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["id", "url", "text", "n_chars"],
            )

    kinds = [pages.schema[name].dataType.simpleString() for name in (id_column, url_column)]
    return (
        pages.select(
            F.col(id_column).alias("id"),
            F.col(url_column).alias("url"),
            F.col(html_column).alias("html"),
        )
        .transform(mapped, run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
        .withColumnsRenamed({"id": id_column, "url": url_column})
    )
