"""Main text of web pages by the distribution of text over line blocks.

A page becomes a list of lines: markup is stripped, and every block element (and no
inline one) begins a new line. Lines of elements that by their name are never article text
(menus, headers, footers, side bars, forms, scripts, styles) count as empty. A window slides
over the lines, and the text lengths in it are summed. Where the sum surges above a threshold
taken from the page's own distribution, text begins; where it dives to nothing, text ends. The
text is kept from surge to dive. A mark of the article (``article``, ``main``) is believed if its
element holds the densest window and half of the text: then any text inside it is a surge,
its lines weigh more, and lines after it need a surge of their own. Other marks (of a
title, a meta line, a teaser) change nothing.

Names (class, id, role) of boilerplate are weighed by what they hold. A whole name of ``MARKS``
empties its block, and so does a compound of which the first or the last word tells of comments,
unless the page has no other text. Other compounds that begin or end with a word of ``EDGES``
(``cookie-banner``, ``site-footer``) do so unless they hold more than ``MOST_SHARE`` of the page's
text (``with-sidebar`` around an article). Names in ``AMBIGUOUS``, and outside an article compounds
with them, leave long lines to the windows. Ids count on containers only, as many are made from
headings; names of headings don't count but whole classes.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import map_steps, pick
from shopgrain.llm.registry import register, table

WINDOW = 3
#: A surge is a window sum of this share of the page's densest window, at most SURGE_MOST characters.
SURGE_SHARE = 0.1
SURGE_MOST = 60
#: Weight of the characters inside the believed mark; surges count in the same weight.
MARKED = 4
#: Share of a page's text above which a compound name isn't believed to mark boilerplate.
MOST_SHARE = 2 / 3
#: Characters from which a line of a doubtful block outside an article is prose.
PROSE = 80
#: Share of a line's characters inside links from which it is a menu line.
LINK_SHARE = 0.6

# Element names.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search
    section select summary table tbody td tfoot th thead tr ul""".split()
)
#: Elements whose text is never the article's.
BOILERPLATE = frozenset("nav footer aside form button select option menu dialog head object audio video canvas search input".split())
#: Words of class, id or role attributes that mark the same.
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation
    menu menubar breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar comment comments reply replies
    respond disqus discussion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe
    subscription signup login form search share sharing social related recommended recommendations trending widget
    pagination pager copyright legal disclaimer skip complementary contentinfo alert alertdialog dialog""".split()
)
#: Names that mark boilerplate or a part of the article; density decides.
AMBIGUOUS = frozenset("header widget skip discussion search legal copyright disclaimer form share sharing social menu alert aside".split())
#: Words that tell of readers' comments, at the begin or the end of a compound too.
COMMENTS = frozenset("comment comments disqus".split())
#: Words that mark boilerplate at the begin or the end of a compound class.
EDGES = MARKS - AMBIGUOUS - {"reply", "replies", "respond", "overlay", "complementary", "contentinfo", "dialog", "alertdialog"}
#: Words that ids made from headings often hold.
IN_HEADINGS = frozenset("related recommended recommendations trending notice notices subscription".split())
#: First words of compounds that tell what a layout has.
LAYOUT = frozenset("with has no without".split())
ARTICLE_MARKS = frozenset(("article", "main", "content", "post", "story", "entry"))
#: End tags that may be left out: an open element that a start tag closes.
CLOSED_BY = {
    "p": BLOCKS - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "figcaption", "summary"},
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "option": frozenset(("option", "optgroup")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "td": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "th": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "head": frozenset(("body",)),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINERS = frozenset("div section ul ol dl table details".split())
SCOPES = frozenset("article aside body div section table td th ul ol dl nav main form footer header blockquote".split())

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)""",
    re.DOTALL,
)
#: For a start tag, the open elements that it closes.
CLOSES = {name: [x for x, by in CLOSED_BY.items() if name in by] for by in CLOSED_BY.values() for name in by}
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORD = re.compile(r"[a-z]+")


NONE, DOUBTFUL, COMPOUND, WHOLE, HIDDEN = range(5)


def _name_weight(token: str, attribute: str, name: str, within: bool) -> int:
    """What one class, id or role says of an element: the weight of a mark of boilerplate."""
    whole = token.lower()
    if attribute == "role":
        return WHOLE if whole in MARKS else NONE
    if attribute == "id" and name not in CONTAINERS:
        return NONE
    if whole in MARKS - AMBIGUOUS and not (attribute == "id" and name == "section" and whole in IN_HEADINGS):
        return WHOLE
    if whole in AMBIGUOUS:
        return NONE if attribute == "id" and (within or name == "section") else DOUBTFUL if within else COMPOUND
    found = WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
    if len(found) < 2 or name in HEADINGS or name not in BLOCKS or found[0] in LAYOUT:
        return NONE
    ends = {found[0], found[-1]}
    if ends & COMMENTS:
        return WHOLE
    if ends & (EDGES - IN_HEADINGS if attribute == "id" else EDGES):
        return COMPOUND
    return DOUBTFUL if ends & AMBIGUOUS and not within and attribute == "class" else NONE


def _marked(attributes: str, name: str, within: bool) -> tuple[int, bool]:
    """The weight of the names of an element ``within`` a marked article or not, and whether
    they mark an article."""
    if not attributes or attributes.isspace():
        return NONE, False
    weight, good, plain = NONE, False, False
    for attribute, a, b, c in ATTRIBUTE.findall(attributes):
        attribute, value = attribute.lower(), a or b or c
        if attribute in ("class", "id", "role"):
            for token in value.split():
                weight = max(weight, _name_weight(token, attribute, name, within))
                plain |= attribute != "id" and token.lower() in ARTICLE_MARKS
            good |= not ARTICLE_MARKS.isdisjoint(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
        elif attribute == "hidden" or (attribute == "aria-hidden" and value.lower() == "true"):
            weight = HIDDEN
        elif attribute == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            weight = HIDDEN
    if plain and weight <= COMPOUND:
        weight = NONE
    return weight, good and weight < COMPOUND


class _Lines:
    """The lines of a page: their text, their characters in links, the number of the outermost
    mark of an article they lie in (0: none; negative: in doubt), whether they are in doubt, and
    the innermost name of boilerplate around them. Boilerplate leaves an empty line."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.linked: list[int] = []
        self.mark: list[int] = []
        self.doubt: list[bool] = []
        self.named: list[int] = []
        #: Names of boilerplate: the name around, and whether it is a whole one. The first is none.
        self.around, self.whole = [0], [False]
        self._open: list[str] = []
        self._links = 0
        self._skipped = False

    def add(self, piece: str, skip: bool, link: bool) -> None:
        if skip:
            self._skipped = True
            return
        self._open.append(piece)
        if link:
            self._links += len(piece)

    def end(self, mark: int, doubt: bool, named: int) -> None:
        text = " ".join(entities.unescape("".join(self._open)).split())
        if text or self._skipped:
            self.text.append(text)
            self.linked.append(self._links)
            self.mark.append(-mark if doubt else mark)
            self.doubt.append(doubt)
            self.named.append(named)
        self._open, self._links, self._skipped = [], 0, False

    def drop_named(self) -> None:
        """Empty the lines under names that are believed to mark boilerplate."""
        held = np.bincount(self.named, weights=[len(x) for x in self.text], minlength=len(self.around))
        for number in range(len(held) - 1, 0, -1):
            held[self.around[number]] += held[number]
        dropped = [False]
        for number in range(1, len(held)):
            most = held[0] - 1 if self.whole[number] else MOST_SHARE * held[0]
            dropped.append(dropped[self.around[number]] or held[number] <= most)
        for i, number in enumerate(self.named):
            if dropped[number]:
                self.text[i], self.linked[i] = "", 0


def page_lines(page: str) -> _Lines:
    """Strip the markup of a page. Tags that don't match are closed as a browser would."""
    lines = _Lines()
    stack: list[tuple[str, bool, bool, bool, int]] = []  # name, boilerplate, article, doubtful, named before
    places: dict[str, list[int]] = {}  # where elements of a name are open
    scopes: list[int] = []
    bad = article = doubt = links = marks = named = 0
    at, end = 0, len(page)

    def close(depth: int) -> None:
        nonlocal bad, article, doubt, links, named
        while len(stack) > depth:
            name, was_bad, was_article, was_doubtful, named = stack.pop()
            places[name].pop()
            if name in SCOPES:
                scopes.pop()
            bad -= was_bad
            article -= was_article
            doubt -= was_doubtful
            links -= name == "a"

    def end_line() -> None:
        lines.end(marks if article else 0, doubt > 0, named)

    while at < end:
        found = TOKEN.search(page, at)
        if found is None:
            lines.add(page[at:], bad > 0, links > 0)
            break
        if found.start() > at:
            lines.add(page[at : found.start()], bad > 0, links > 0)
        at = found.end()
        if found.group(2) is None:
            if found.group().startswith("<![CDATA["):
                lines.add(entities.escape(found.group()[9:].removesuffix("]]>")), bad > 0, links > 0)
            continue
        name = found.group(2).lower()
        if name == "br":
            lines.add(" ", bad > 0, False)
        elif name in BLOCKS:
            end_line()
        if found.group(1):
            if places.get(name):
                depth = places[name][-1]
                if name in SCOPES or not scopes or scopes[-1] < depth:
                    close(depth)
            continue
        while stack and name in CLOSED_BY.get(stack[-1][0], ()):
            close(len(stack) - 1)
        if name in BLOCKS:
            depth = max((places[x][-1] for x in CLOSES.get(name, ()) if places.get(x)), default=-1)
            if depth >= 0 and (not scopes or scopes[-1] <= depth):
                close(depth)
        if name in RAW:
            stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        if name in VOID or found.group(3).endswith("/") and name not in BLOCKS:
            continue
        weight, good = _marked(found.group(3), name, article > 0)
        if name in ("html", "body", "article", "main"):
            weight = weight if weight == HIDDEN and name in ("article", "main") else NONE
        # A header or a heading inside the article belongs to it.
        boilerplate = name in BOILERPLATE or name == "header" and article == 0
        boilerplate |= weight == HIDDEN or name not in BLOCKS and weight >= WHOLE
        good = (good and name in BLOCKS or name in ("article", "main")) and not boilerplate and bad == 0
        doubtful = weight == DOUBTFUL and name in BLOCKS
        places.setdefault(name, []).append(len(stack))
        if name in SCOPES:
            scopes.append(len(stack))
        stack.append((name, boilerplate, good, doubtful, named))
        if weight in (COMPOUND, WHOLE) and name in BLOCKS:
            lines.around.append(named)
            lines.whole.append(weight == WHOLE)
            named = len(lines.around) - 1
        bad += boilerplate
        marks += good and article == 0
        article += good
        doubt += doubtful
        links += name == "a"
    end_line()
    return lines


def _sums(useful: np.ndarray) -> np.ndarray:
    """The text in the window that begins at each line."""
    count = len(useful)
    padded = np.concatenate([[0], np.cumsum(useful)])
    return padded[np.minimum(np.arange(count) + WINDOW, count)] - padded[:count]


def _believed(useful: np.ndarray, mark: np.ndarray) -> int:
    """The mark with most of the densest window and half of all text; 0 without one."""
    densest = int(_sums(useful).argmax())
    window = slice(densest, densest + WINDOW)
    found = int(mark[window][useful[window].argmax()])
    held = useful * (mark == found)
    whole = 2 * held[window].sum() > useful[window].sum() and 2 * held.sum() >= useful.sum()
    return found if whole else 0


def main_text(page: str | None) -> str:
    """The article of a page; empty for null, for an empty page and for one without text."""
    if not page:
        return ""
    lines = page_lines(page)
    if not lines.text:
        return ""
    lines.drop_named()
    lengths = np.array([len(x) for x in lines.text], dtype=np.int64)
    mark = np.array(lines.mark, dtype=np.int64)
    useful = np.where(np.array(lines.linked) > LINK_SHARE * lengths, 0, lengths)
    useful[np.array(lines.doubt) & (mark == 0) & (lengths < PROSE)] = 0
    if not useful.any():
        useful = np.where(mark != 0, lengths, 0)
    if not useful.any():
        return ""
    believed = _believed(useful, np.abs(mark))
    inside = (mark == believed) & (believed > 0)
    useful = np.where(inside, MARKED * lengths, useful)
    sums = _sums(useful)
    surge = min(SURGE_MOST * (MARKED if believed else 1), SURGE_SHARE * sums.max())
    surge = np.where((mark == -believed) & (believed > 0), surge / MARKED, surge)  # in doubt: no weight
    kept: list[str] = []
    count = len(useful)
    i = 0
    while i < count:
        if useful[i] and (inside[i] or sums[i] >= surge[i]):
            while True:  # up to the dive (a whole window without text) or the end of the mark
                if useful[i]:
                    kept.append(lines.text[i])
                i += 1
                if i == count or not sums[i] or inside[i - 1] and not inside[i]:
                    break
        else:
            i += 1
    return "\n".join(kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null page, an empty one and one without article text have an empty text; repeated
    rows give repeated rows; an empty table gives none; extra columns are not read."""

    def work(step) -> dict:
        texts = [main_text(page) for page in step.column("html").to_pylist()]
        return {
            "page_id": step.column("page_id"),
            "url": step.column("url"),
            "text": texts,
            "n_chars": [len(x) for x in texts],
        }

    pages = pick(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    return map_steps(pages, work, "page_id long, url string, text string, n_chars long")


@register("op2_html_text")
def op2_html_text(spark, folder):
    return extract_text(table(spark, folder, "pages"))
