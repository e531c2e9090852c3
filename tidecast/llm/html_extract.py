"""Main text of web pages by two-pass block rules.

Pass 1 decides blocks by their container, link density, length and stop-word
density: text inside menus, headers, footers, sidebars, notices, adverts,
forms and comments is bad, long blocks with many stop words are good, blocks
with many links are bad. Pass 2 gives blocks left open (short, or of middling
stop-word density) the label of their nearest decided neighbours. An article
or main element is a prior: inside it more blocks are left open and its edge
counts as good, outside it nothing but the text speaks for a block. The name
of a container, or a form, is a hint: one that holds the page's main text is
judged by its text, and main and article end a hint. Text in a language
without a stop list is judged by length and links alone.

Pages are independent: no shuffle; memory is bounded by one Arrow batch.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_arrow

#: Frequent function words of the languages served.
STOP_LANGUAGES = frozenset("en de fr es".split())
STOP_WORDS = frozenset(
    "the of and to in a is that it for on with as are was be by this or from at an not but have had he she they his her "
    "which you we were been has their its will would can if there all who what when so no "
    "der die das und in zu den von mit ist des im für auf ein eine nicht dem sich auch als an es er sie wir aus bei wird "
    "sind war nach wie einer um am noch haben hat oder über zum zur durch "
    "le la les de des du et en un une que qui dans pour sur pas par au aux est avec ce il elle se ne plus son sa ses nous "
    "vous ils sont ou mais comme cette été leur être "
    "el los las y del se que en un una por con no para su al lo como más o pero sus le ha me si sin sobre este ya entre "
    "cuando todo esta ser son fue hay era muy".split())
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.30, 0.32
MAX_LINK_DENSITY = 0.2
MAX_ARTICLE_LINK_DENSITY = 0.8

#: Elements whose content is never text of the page.
_SKIPPED = frozenset("script style noscript template iframe object svg math canvas audio video title select textarea button".split())
#: Elements nested deeper stay siblings of the deepest, as in browsers.
MAX_DEPTH = 512
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"'<]*")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BAD_TAGS = frozenset("nav footer aside menu dialog".split())
_FORM_TAGS = frozenset("form fieldset".split())
_ATTRIBUTE = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert[^\W_]*+|banner|sponsor[^\W_]*+|promo[^\W_]*+|sidebars?|widgets?|menus?|nav|navbar|navigation|breadcrumbs?|footer|"
    r"cookies?|consent|notices?|gdpr|popup|modal|newsletter|subscri[^\W_]*+|share|sharing|social|related|comments?|disqus|respond|replies|reply|"
    r"login|signup|search|pagination|pager|toolbar|skip|masthead|contentinfo|complementary|site-header|page-header|form)(?:$|[\s_-])", re.I)
#: Names that tell of a state rather than a container; names of wrappers.
_STATE_NAME = re.compile(r"(?:has|no|not|non|with|without)[_-]", re.I)
_WRAP_NAME = re.compile(r"(?:^|[_-])(?:wrap[^\W_]*+|container|content|main|layout|page|body|site|outer|inner|columns?|grid|row)(?:$|[_-])", re.I)
#: Least characters of prose in a wrapper, and in a container whose whole name is that of boilerplate.
WRAPPER, NAMED = LONG, 5 * LONG
_BLANKS = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")
_LATIN = re.compile(r"[A-Za-zÀ-ɏḀ-ỿ]+")
_HTML = re.compile(r"<html\b", re.I)
_LANGUAGE = re.compile(r"\blang\s*=\s*[\"']?([a-z]+)", re.I)


@dataclass
class Block:
    """Text between block boundaries. ``place``: bad (inside a boilerplate
    container), article (inside an article) or open. ``named``: the containers
    around it whose name, or form, hints at boilerplate."""

    text: str
    link_chars: int
    place: str
    heading: bool
    named: tuple[int, ...] = ()
    label: str = ""


def _hint(name: str, rest: str) -> str | None:
    """What an element's name and attributes say: named (a name of
    boilerplate), wrapper (a form, or such a name as part of a wrapper's) or
    nothing."""
    words = [w for v in _ATTRIBUTE.findall(rest) for w in v.strip("\"'").split()] if rest else []
    words = [w for w in words if _BAD_NAME.search(w) and not _STATE_NAME.match(w)]
    if any(not _WRAP_NAME.search(w) for w in words):
        return "named"
    return "wrapper" if words or name in _FORM_TAGS else None


def _settle(found: list[Block], kinds: list[str], parents: list[tuple[int, ...]]) -> None:
    """Blocks of a hinted container are bad, unless the container holds the
    page's main text: a wrapper with more prose than there is beside it, or a
    named container when there is none beside it and no article. Prose beside a
    container has no name but those around the container; sums by the innermost
    name make that linear in the blocks."""
    own, inside, by_name = [0] * len(kinds), [0] * len(kinds), {None: 0}
    for b in found:
        if b.place == "bad" or len(b.text) < SHORT or b.link_chars > MAX_LINK_DENSITY * len(b.text):
            continue
        inmost = next((c for c in reversed(b.named) if kinds[c] == "named"), None)
        by_name[inmost] = by_name.get(inmost, 0) + len(b.text)
        for c in b.named:
            own[c] += len(b.text)
            if inmost is None or inmost < c:
                inside[c] += len(b.text)
    has_article = any(b.place == "article" and not b.named for b in found)
    kept = set()
    for c, kind in enumerate(kinds):
        if own[c] < (WRAPPER if kind == "wrapper" else NAMED):
            continue
        beside = by_name[None] + sum(by_name.get(k, 0) for k in parents[c]) - inside[c]
        if own[c] > beside if kind == "wrapper" else not beside and not has_article:
            kept.add(c)
    for b in found:
        if not kept.issuperset(b.named):
            b.place = "bad"


def _tag_end(page: str, at: int, last: dict[str, int]) -> tuple[int, int]:
    """Where the attributes that start at ``at`` end, and the tag. A quote opens
    a value after an equals sign, if it is closed somewhere; a tag without a >
    ends before the next < or with the page."""
    i = at
    while True:
        i = _PLAIN.match(page, i).end()
        c = page[i:i + 1]
        if c == ">":
            return i, i + 1
        if c in ("", "<"):
            return i, i
        i += 1
        if i <= last[c] and page[max(at, i - 9):i - 1].rstrip().endswith("="):
            i = page.index(c, i) + 1


def _tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, is an end tag, attributes) of all markup, in one pass
    that never looks at a character twice; the name is empty for what is no
    element of the page (comments, scripts with their content)."""
    last = {c: page.rfind(c) for c in "\"'>"}
    at = page.find("<")
    while at >= 0:
        end, token = at + 1, None
        if m := _NAME.match(page, at):
            name = m.group(2).lower()
            stop, end = _tag_end(page, m.end(), last)
            token = ("" if name in _SKIPPED else name, bool(m.group(1)), page[m.end():stop])
            if name in _SKIPPED and not m.group(1) and not token[2].endswith("/"):
                close = re.compile(rf"</{name}\s*+>", re.I).search(page, end)
                end = close.end() if close else len(page)
        elif page.startswith("<!--", at) or page.startswith("<![CDATA[", at):
            mark, skip = ("-->", 4) if page[at + 2] == "-" else ("]]>", 9)
            close = page.find(mark, at + skip)
            end, token = close + 3 if close >= 0 else len(page), ("", False, "")
        elif page[at + 1:at + 2] in ("!", "?", "/") and at < last[">"]:
            end, token = page.index(">", at) + 1, ("", False, "")
        if token:
            yield at, end, *token
        at = page.find("<", end)


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order; character references are decoded,
    white space is one space."""
    out: list[Block] = []
    stack: list[tuple[str, str, tuple[int, ...]]] = []  # open elements, the place they give, the hinted containers around
    kinds: list[str] = []
    parents: list[tuple[int, ...]] = []
    text: list[str] = []
    links, breaks = 0, 0

    def flush() -> None:
        nonlocal links, text, breaks
        if text:
            joined = _BLANKS.sub(" ", htmllib.unescape("".join(text))).strip()
            if joined:
                _, place, named = stack[-1] if stack else ("", "open", ())
                out.append(Block(joined, links, place, any(opened[f"h{i}"] for i in range(1, 7)), named))
        text, links, breaks = [], 0, 0

    def pop(k: int) -> None:
        for x in stack[k:]:
            opened[x[0]] -= 1
        del stack[k:]

    at, opened = 0, Counter()
    for start, end, name, closing, rest in _tokens(page):
        if start > at:
            piece = page[at:start]
            text.append(piece)
            if any(x[0] == "a" for x in stack[-3:]):
                links += len(piece.strip())
            if breaks and not piece.isspace():
                breaks = 0
        at = end
        if not name:
            continue
        if name == "br":
            text.append(" ")
            breaks += 1
            if breaks == 2:
                flush()
            continue
        inline = name in _INLINE
        if not inline:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[k][0] == name:
                    pop(k)
                    break
                if inline and stack[k][0] not in _INLINE:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if name in _VOID or name == "head":  # a head without end tag ends where text begins
            continue
        if not inline:  # open inline elements, paragraphs and items end here
            closes = ("li",) if name == "li" else ("p",)
            k, first = len(stack), None
            while opened[closes[0]] and k and (stack[k - 1][0] in _INLINE or stack[k - 1][0] in closes):
                k -= 1
                first = k if stack[k][0] in closes else first
            if first is not None:
                pop(first)
        _, place, named = stack[-1] if stack else ("", "open", ())
        if name == "main":
            place, named = "article", ()
        elif place != "bad":
            hint = _hint(name, rest) if name not in ("html", "body") else None
            if name in _BAD_TAGS or (name == "header" and place != "article"):
                place = "bad"
            elif name == "article":
                if not named or hint is None:  # a comment is often an article too
                    place, named = "article", () if hint is None else named
            elif hint:
                parents.append(named)
                named += (len(kinds),)
                kinds.append(hint)
        if not rest.endswith("/") and len(stack) < MAX_DEPTH:
            stack.append((name, place, named))
            opened[name] += 1
    if at < len(page):
        text.append(page[at:])
    flush()
    if kinds:
        _settle(out, kinds, parents)
    return out


def _stop_shares(found: list[Block], language: str | None) -> list[float | None]:
    """Share of stop words in each block of SHORT characters at least; None
    for a block without that test, since its language has no stop list: a block
    in another script, and all blocks of a page whose text holds too few stop
    words and that is not declared to be in a language with a list."""
    shares: list[float | None] = [None] * len(found)
    stops = total = 0
    for i, b in enumerate(found):
        if b.place == "bad" or len(b.text) < SHORT:
            continue
        words = _WORD.findall(b.text.lower())
        if 2 * sum(map(len, _LATIN.findall(b.text))) < sum(map(len, words)):
            continue
        stop = sum(w in STOP_WORDS for w in words)
        shares[i] = stop / max(1, len(words))
        if b.link_chars <= MAX_LINK_DENSITY * len(b.text):
            stops, total = stops + stop, total + len(words)
    listed = stops >= STOP_LOW * total or (language or "").lower() in STOP_LANGUAGES
    return shares if listed else [None] * len(found)


def _first_pass(b: Block, stop: float | None) -> str:
    """good, bad, near (reads like prose, but has links or is not long) or
    short (says little by itself)."""
    if b.place == "bad":
        return "bad"
    article = b.place == "article"
    density = b.link_chars / len(b.text)
    if "©" in b.text and not article:
        return "bad"
    if density > (MAX_ARTICLE_LINK_DENSITY if article else MAX_LINK_DENSITY) and not (article and b.heading):
        return "bad"
    if len(b.text) < SHORT:
        return "bad" if density and not article else "short"
    if stop is None:
        stop = STOP_HIGH  # length and links alone decide
    if density > MAX_LINK_DENSITY:  # in an article: prose with many links, or a list of them
        return "near" if stop >= STOP_LOW or b.heading else "bad"
    if stop >= STOP_HIGH:
        return "good" if len(b.text) >= LONG else "near"
    return "near" if stop >= STOP_LOW else "short" if article else "bad"


def _inherited(found: list[Block], first: list[str], order: range) -> list[tuple[str, int]]:
    """For each block the nearest decided label before it in ``order`` and its
    distance. Inside an article, boilerplate containers are passed over and
    the article's edge counts as good; outside, an article's blocks and the
    page's edge count as bad."""
    out: list[tuple[str, int]] = [("bad", 0)] * len(found)
    inside, outside = ("good", order[0] - order.step), ("bad", order[0] - order.step)
    was = None
    for i in order:
        place = found[i].place
        if place == "article":
            if was == "open" or was is None:
                inside = ("good", i - order.step)
            label, at = inside
            if first[i] in ("good", "bad"):
                inside = (first[i], i)
            outside = ("bad", i)
        else:
            label, at = outside
            if first[i] in ("good", "bad"):
                outside = (first[i], i)
        if place != "bad":
            was = place
        out[i] = (label, abs(i - at))
    return out


def classify(found: list[Block], language: str | None = None) -> list[Block]:
    """Label every block good or bad by its text; being inside an article
    speaks for a block that its text leaves open, being outside against it.
    An open block whose nearest decided neighbours differ takes the label of
    the closer one; at equal distance a block of middling density is good, a
    short one only inside an article. A page's edge and an article next to it
    count as bad, an article's edge seen from inside as good; a heading looks
    only at what follows. ``language`` is the one that the page declares."""
    if not found:
        return found
    first = [_first_pass(b, stop) for b, stop in zip(found, _stop_shares(found, language))]
    before = _inherited(found, first, range(len(found)))
    after = _inherited(found, first, range(len(found) - 1, -1, -1))
    decided = any(k in ("good", "bad") for k in first)
    for b, k, (left, far), (right, near) in zip(found, first, before, after):
        if k in ("good", "bad"):
            b.label = k
        elif left == right or b.heading:
            b.label = right
        elif far != near:
            b.label = left if far < near else right
        else:
            b.label = "good" if k == "near" or b.place == "article" else "bad"
        if not decided and k == "near":
            b.label = "good"  # nothing to inherit from: keep what reads like prose
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = _HTML.search(page)
    declared = root and _LANGUAGE.search(page[root.end():_tag_end(page, root.end(), {c: page.rfind(c) for c in "\"'"})[0]])
    return "\n".join(b.text for b in classify(blocks(page), declared and declared.group(1)) if b.label == "good")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row (repeated
    rows and null ids too). Null and empty pages, and pages without main text,
    have an empty text. Other columns are ignored; no rows give no rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [main_text(t) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                          ["page_id", "url", "text", "n_chars"])

    return map_arrow(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), run,
                     "page_id bigint, url string, text string, n_chars bigint")
