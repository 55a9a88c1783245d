"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.units import slices

#: Lines per window.
WINDOW = 3
#: Characters outside links that a window needs to start a text; twice as many outside the main part.
SURGE = 86

#: Elements whose content is never text.
SKIPPED = frozenset(
    "script style noscript template svg math canvas object iframe audio video map head title "
    "textarea select option button label input datalist".split()
)
#: Of these, the ones that end by themselves where no end tag follows.
MAY_STAY_OPEN = frozenset("head label option select button".split())
#: The ones that reach to the end of the page where no end tag follows.
RAW = frozenset("script style textarea title iframe".split())
#: Elements that frame a page.
FRAME = frozenset("nav header footer aside form menu dialog search".split())
#: Words of class, id or role that name such parts.
FRAME_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice alert popup modal overlay nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget widgets header masthead topbar footer comment "
    "comments disqus reply replies respond share sharing social related recommended newsletter "
    "subscribe subscription signup login search pagination pager toolbar complementary contentinfo "
    "form skip".split()
)
#: Words that may stand beside them in a name made of several words.
PART_WORDS = frozenset(
    "area bar block box btn button container group inner item items link links list outer panel "
    "row section slot top bottom left right unit wrap wrapper".split()
)
#: Words that say whose part it is, or how it is shown.
OWNER_WORDS = frozenset(
    "site page main primary secondary global mobile desktop sticky fixed floating this label".split()
)
TEXT_WORDS = frozenset(
    "user users reader readers post posts article articles entry entries story stories news blog "
    "privacy".split()
)
#: Beside "author", words that make it a part about the author.
AUTHOR_WORDS = frozenset("bio about box".split())
#: Of the frame words, the ones whose parts may hold the site's name as a heading.
TITLE_WORDS = frozenset("header masthead topbar banner nav navbar navigation menu".split())
#: The ones that may also say how the part with the text is laid out ("page sidebar").
LAYOUT_WORDS = TITLE_WORDS | frozenset("sidebar aside widget widgets toolbar overlay".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose beginning and end leave an empty line.
PARTS = MAIN | FRAME | frozenset("div section table ul ol dl blockquote figure".split())
#: Elements inside a line; all others end it.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that end another skipped element which the page never closes.
BLOCKS = PARTS | HEADINGS | {"p", "pre"}
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr keygen frame".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)|</?\Z",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_SIZE = re.compile(r"\d+x\d+", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Line:
    """A block's text: its pieces, how many characters are in links, and its main part (0: none)."""

    __slots__ = ("links", "main", "pieces", "text")

    def __init__(self, main: int):
        self.pieces, self.links, self.main, self.text = [], 0, main, ""

    def close(self) -> None:
        self.text = " ".join(unescape("".join(self.pieces)).split())


def strip_markup(page: str, by_layout: bool = True) -> tuple[list[Line | None], dict[int, str]]:
    """Lines of the page in order, None where a part begins or ends; the element of each main part.

    Main parts are the outermost `article` and `main` elements, numbered from 1.

    Skipped and framing elements give no lines. A framing element that the page never closes ends
    where its parent does, or where a main part starts; a skipped one that swallows no markup, also
    where a block starts. A part that frames by its class, id or role only (see `_frames` for
    `by_layout`) ceases to at a first-level heading, unless it may be the page's head.
    """
    lines: list[Line | None] = []
    stack: list[tuple[str, str]] = []  # open elements, and how each frames
    depth: Counter[str] = Counter()
    unclosed: set[str] = set()
    framed = swallowing = in_main = in_link = 0
    parts: dict[int, str] = {}
    line = Line(0)
    at = 0

    def break_line(gap: bool = False) -> None:
        nonlocal line
        if line.pieces:
            line.close()
            if line.text:
                lines.append(line)
        if gap and not framed:
            lines.append(None)
        line = Line(len(parts) if in_main else 0)

    def pop() -> str:
        nonlocal framed, swallowing, in_main, in_link
        name, frames = stack.pop()
        depth[name] -= 1
        framed -= bool(frames)
        swallowing -= frames == "unclosed"
        in_main -= name in MAIN
        in_link -= name == "a"
        return name

    def add(text: str) -> None:
        if text and not framed:
            line.pieces.append(text)
            line.links += len(text) if in_link else 0

    size = len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        add(page[at : token.start()])
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if token[1]:
            if depth[name]:
                while True:
                    own = pop()
                    if own not in INLINE:
                        break_line(own in PARTS)
                    if own == name:
                        break
            elif name not in INLINE:
                break_line()
            continue
        closed = token[3].endswith("/") or name in VOID
        if name in SKIPPED and not closed:
            close = rf"</{re.escape(name)}\b[^>]*(?:>|\Z)"
            end = None if name in unclosed else re.compile(close, re.IGNORECASE).search(page, at)
            if end is None and name not in RAW:
                unclosed.add(name)
                if name in MAY_STAY_OPEN:
                    continue
            else:
                at = end.end() if end else size
                break_line()
                continue
        if name in BLOCKS:
            while swallowing:
                pop()
        if name in MAIN and not _frames(name, token[3], in_main, by_layout):
            while framed:
                pop()
            if not in_main:
                parts[len(parts) + 1] = name
        if name == "h1" and framed and all(kind in ("", "name") for _, kind in stack):
            stack = [(own, "") for own, _ in stack]
            framed = 0
        if name not in INLINE:
            break_line(name in PARTS and not closed)
        if closed:
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            while stack and (stack[-1][0] == name or stack[-1][0] in INLINE and _has(stack, name)):
                pop()
        frames = _frames(name, token[3], in_main, by_layout)
        if name in SKIPPED and name not in MAY_STAY_OPEN:
            frames = "unclosed"
        if frames:
            break_line()
        stack.append((name, frames))
        depth[name] += 1
        framed += bool(frames)
        swallowing += frames == "unclosed"
        in_main += name in MAIN
        in_link += name == "a"
        line.main = len(parts) if in_main else 0
    break_line()
    return lines, parts


def _has(stack: list[tuple[str, str]], name: str) -> bool:
    """Whether `name` is open below inline elements only."""
    for own, _ in reversed(stack):
        if own == name:
            return True
        if own not in INLINE:
            return False
    return False


def frame_words(name: str) -> set[str]:
    """The frame words of a class, id or role that names a frame as a whole; else none.

    All its words have to be frame words, or to say what part it is, whose, or how it is shown;
    numbers and sizes say nothing. So `site-footer`, `comment-1` and `ad-728x90` name frames, and
    `comments-open`, `with-sidebar` and `related-work` do not. A header or banner of a text
    (`post-header`) belongs to that text.
    """
    words = {w.lower() for w in _WORDS.findall(_SIZE.sub(" ", name))}
    found = words & FRAME_WORDS
    rest = words - FRAME_WORDS - PART_WORDS - OWNER_WORDS
    if "author" in rest and words & AUTHOR_WORDS and rest - AUTHOR_WORDS <= {"author"}:
        return {"author"}
    if not rest <= TEXT_WORDS or rest and found <= {"header", "masthead", "banner"}:
        return set()
    return found


def _frames(name: str, attributes: str, in_main: int, by_layout: bool = True) -> str:
    """How an element frames the page: "kind", "hidden", "title", "name", or not at all.

    A header inside the main part belongs to it. Headings, elements inside a line and main parts do
    not frame by the name in a class, id or role. Unless `by_layout`, a name of layout words frames
    only where the element has no other name.
    """
    if name in ("html", "body"):
        return ""
    if name in FRAME:
        return "" if in_main and name == "header" else "kind"
    if not attributes.strip():
        return ""
    given: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        given.setdefault(key.lower(), value.strip("\"'"))
    hidden = given.get("aria-hidden", "").strip().lower() == "true"
    if "hidden" in given or hidden or _NONE.search(given.get("style", "")):
        return "hidden"
    if name in MAIN or name in HEADINGS or name in INLINE:
        return ""
    names = [v for key in ("class", "id", "role") for v in unescape(given.get(key, "")).split()]
    each = [frame_words(value) for value in names]
    found = set().union(*each)
    if not by_layout and not all(each):
        found -= LAYOUT_WORDS
    if in_main:
        found -= {"header", "masthead"}
    return ("title" if found & TITLE_WORDS else "name") if found else ""


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """The text between the surge and dive points of the distribution of line lengths.

    A line's weight is its length outside links; where a part begins or ends stands an empty line, so
    an advert between two paragraphs is bridged and a change of several parts is not. The sum over a
    sliding window of lines is the distribution. It surges where a window that starts with text
    reaches `surge`, and dives where a window is empty; what lies between is kept. Windows end where a
    main part begins or ends. A page on which nothing surges gives its heaviest stretch between two
    gaps.

    A line in a main part weighs its whole length and a bonus of `surge`. Where a page has a `main` or
    a single `article`, text outside has to reach twice `surge`. Of several articles (teaser cards,
    say) those that hold less text than the heaviest text that surges outside get no bonus.

    Where nothing surges, the part with the text may have a layout word among its names: the page is
    read once more without regard to these. What is named a notice, advert, comment or footer, and
    what has no other name than a sidebar's, say, stays out even so.
    """
    text, surged = _surging(*strip_markup(page), window, surge)
    if not surged:
        whole, surged = _surging(*strip_markup(page, by_layout=False), window, surge)
        text = whole if surged else text
    return text


def _surging(
    lines: list[Line | None], parts: dict[int, str], window: int, surge: int
) -> tuple[str, bool]:
    """The text that is kept of these lines, and whether anything surged."""
    held: Counter[int] = Counter()
    runs: list[tuple[int, list[Line | None]]] = []
    for line in lines:
        part = line.main if line else runs[-1][0] if runs else 0
        if not runs or runs[-1][0] != part:
            runs.append((part, []))
        runs[-1][1].append(line)
        held[part] += _outside_links(line)
    marked = len(parts) == 1 or "main" in parts.values()
    least = 2 * surge if marked else surge
    found = [None if part else _dealt(run, window, least, 0) for part, run in runs]
    rival = 0
    if not marked:
        rival = max((weight for f in found if f for weight, _, surged in f if surged), default=0)
    for k, (part, run) in enumerate(runs):
        if part:
            found[k] = _dealt(run, window, surge, surge if held[part] >= rival else 0)
    stretches = [stretch for f in found for stretch in f]
    kept = [line for _, own, surged in stretches if surged for line in own]
    if kept or not stretches:
        return " ".join(line.text for line in kept), bool(kept)
    return " ".join(line.text for line in max(stretches, key=lambda s: s[0])[1]), False


def _outside_links(line: Line | None) -> int:
    return max(0, len(line.text) - line.links) if line else 0


def _dealt(
    lines: list[Line | None], window: int, least: int, bonus: int
) -> list[tuple[int, list[Line], bool]]:
    """Stretches between dives: (weight, lines, whether they surged, then from the surge on)."""
    weights = [
        (len(line.text) + bonus if bonus else _outside_links(line)) if line else 0 for line in lines
    ]
    sums, running = [0] * len(weights), 0
    for k in range(len(weights) - 1, -1, -1):
        running += weights[k] - (weights[k + window] if k + window < len(weights) else 0)
        sums[k] = running
    stretches: list[tuple[int, list[Line], bool]] = []
    inside, current, weight = False, [], 0
    for k, line in enumerate(lines):
        if sums[k] == 0:
            if current:
                stretches.append((weight, current, inside))
            inside, current, weight = False, [], 0
            continue
        if not inside and weights[k] > 0 and sums[k] >= least:
            inside, current, weight = True, [], 0
        if line is not None:
            current.append(line)
            weight += weights[k]
    if current:
        stretches.append((weight, current, inside))
    return stretches


def extract_text(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """(id, kept columns, text, n_chars) of every page, from its whole html.

    Null and empty pages have an empty text. Null and repeated ids give rows as they are; columns not
    named are dropped. Pages are neither joined nor shuffled; a worker holds a few pages at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text=len(names)):
                texts = [main_text(page) for page in rows.column(len(names)).to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], pa.array(texts, pa.string()), sizes],
                    [*names, "text", "n_chars"],
                )

    names = [id_col, *keep]
    kinds = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names]
    html = F.coalesce(F.col(html_col), F.lit("")).alias("html")
    return pages.select(*names, html).mapInArrow(
        run, ", ".join([*kinds, "text string", "n_chars long"])
    )
