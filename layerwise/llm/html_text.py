"""Main text of web pages, by block rules in two passes.

A page is cut into blocks at block-level tags. The first pass classifies each block by its
length, its link density, its share of stop words and the elements it stands in; short blocks
without a clear sign stay undecided. In the second pass an undecided block takes the label of
its nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_size, with_columns

GOOD, BAD, OPEN = 1, -1, 0
#: Words of a block from which its stop-word share is telling.
LONG = 8
LINK_SHARE = 0.5
STOP_SHARE = 0.15
#: Few links; a long block with no more is text, in whatever language, unless one word is most of it.
FEW_LINKS = 0.2
SAME_SHARE = 0.5

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his in is it its not of on or she
    that the their they this to was were which will with you
    als an auch auf aus bei das dem den der des die du ein eine einem einen einer er es für hat
    ich im in ist mit nach nicht noch sich sie sind so und von war wie wird zu zum zur
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou
    par pas pour qu que qui sa se ses son sont sur un une vous
    al como con de del el ella en era es esta este fue ha hay la las lo los más no o para pero
    por que se ser sin sobre su sus un una y ya
    """.split()
)

_SKIPPED = frozenset("script style noscript template svg math iframe object head select textarea button canvas audio video".split())
_BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
_BLOCKS = frozenset(
    """
    address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table
    tbody td tfoot th thead title tr ul
    """.split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element that a new one of these closes.
_CLOSES = {
    "p": _BLOCKS - {"body", "html"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option"}),
}
_HINTS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adsbygoogle|advert\w*|banner|breadcrumbs?|captcha|comments?|comment-?list|consent|cookies?|copyright|disqus"
    r"|disclaimer|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notices|pager|pagination"
    r"|popup|popups?|promos?|promoted|recommend\w*|related|replies|reply|respond|rss|search|share|sharing|sidebar|sidenav|signup|skip"
    r"|social|sponsors?|sponsored|subscribe|subscription|tags|teasers?|toolbar|topbar|widgets?)(?=$|[\s_-])",
    re.I,
)
#: What a page has or lacks, not what an element is.
_LAYOUT = re.compile(r"\b(?:has|with|without|no)[-_][\w-]+", re.I)
#: What an article element of its own may be besides the page's article.
_REPLY = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply|ads?|advert\w*|promo|teasers?|related)(?=$|[\s_-])", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
#: Words; scripts without spaces between words count by character.
_LETTERS = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]|[^\W\d_]+")
_SENTENCE_END = re.compile(r"[.!?…。！？।؟۔]['\"»”’)\]]*$")
#: The wording of a notice, not the mere word or sign in a sentence.
_NOTICE = re.compile(r"^©|(?:©|\(c\)|\bcopyright)\s*(?:©|\(c\)|(?:19|20)\d\d|by\b)|\ball rights reserved\b", re.I)
_COPYRIGHT = re.compile(r"©|\bcopyright\b", re.I)
_HEADING = re.compile("h[1-6]")
_PRINCIPAL = re.compile(r"""<(main|article|h1)(?=[\s/>])((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.I)
#: Where an element without an end is taken to end: a block tag, but not within a string of a script.
_BLOCK_TAG = re.compile(rf"(?<![\"'`\\])</?(?:{'|'.join(sorted(_BLOCKS))})(?=[\s/>])", re.I)


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters within links
    tag: str = ""
    boilerplate: bool = False
    article: bool = False  # or main
    own: bool = False  # in an article element
    text: str = ""


def _attributes(source: str) -> dict[str, str]:
    if "=" not in source and "hidden" not in source.lower():
        return {}
    found = {m[1].lower(): next(g for g in (m[2], m[3], m[4], "") if g is not None) for m in _ATTRIBUTE.finditer(source)}
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", source, re.I):
        found["hidden"] = ""
    return found


def _is_boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """What the tag itself or an attribute that hides it or gives its role tells."""
    if tag in _BOILERPLATE:
        return not (tag == "header" and in_article)
    if not attributes or tag in ("html", "body", "main"):
        return False
    if attributes.get("role", "").lower() in _ROLES or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    return False


def _is_named_boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    """What class names and the id tell: the weakest evidence, which no holder of the page's
    principal element minds."""
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if named == " " or tag in ("html", "body", "main"):
        return False
    named = _LAYOUT.sub("", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", named))
    return bool((_REPLY if tag == "article" else _HINTS).search(named))


def _principal(page: str) -> int:
    """Where the element begins that the page is about: its main, else its first article that is not
    named a reply, else its first article or heading of the first rank; -1 without any of them."""
    first: dict[str, int] = {}
    for match in _PRINCIPAL.finditer(page):
        tag = match[1].lower()
        if tag == "article" and _is_named_boilerplate(tag, _attributes(match[2])):
            tag = "reply"
        first.setdefault(tag, match.start())
    return next((first[tag] for tag in ("main", "article", "reply", "h1") if tag in first), -1)


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order. Broken markup is read on: an end tag closes the nearest open
    element of its name, if there is one; what is open at the end is closed there. A skipped
    element without an end ends at the next block tag."""
    out: list[Block] = []
    # tag, in boilerplate, in article or main, in article
    stack: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
    ends: dict[str, dict[int, int]] = {}
    endless: set[str] = set()
    opened: Counter = Counter()  # elements on the stack, by tag
    current = Block()
    principal: int | None = None
    links = 0
    at = 0

    def close(depth: int) -> None:
        nonlocal links
        for tag, *_ in stack[depth:]:
            opened[tag] -= 1
            links -= tag == "a"
        del stack[depth:]

    def flush(tag: str) -> None:
        nonlocal current
        text = " ".join(html.unescape("".join(current.parts)).split())
        if text:
            current.text = text
            out.append(current)
        _, boilerplate, article, inner = stack[-1]
        current = Block(tag=tag, boilerplate=boilerplate, article=article, own=inner)

    def add(text: str) -> None:
        if text:
            current.parts.append(text)
            if links:
                current.linked += len(text)

    def holds_principal(tag: str, start: int, at: int) -> bool:
        """Whether the element from ``start``, whose start tag ends at ``at``, is or holds what the
        page is about."""
        nonlocal principal
        if principal is None:
            principal = _principal(page)
        if principal < start:
            return False
        if tag not in ends:
            ends[tag] = _ends(page, tag)
        return principal < ends[tag].get(at, len(page))

    def beyond(tag: str, at: int) -> int:
        """The place after a skipped element whose start tag ends at ``at``."""
        if tag in _RAW_END:
            end = None if tag in endless else _RAW_END[tag].search(page, at)
            if end:
                return end.end()
            endless.add(tag)  # from here on
        else:
            if tag not in ends:
                ends[tag] = _ends(page, tag)
            if at in ends[tag]:
                return ends[tag][at]
            if tag == "head":
                return at
        block = _BLOCK_TAG.search(page, at)
        return block.start() if block else len(page)

    while True:
        match = _TOKEN.search(page, at)
        if not match:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        if not match[2]:
            if match[0].startswith("<![CDATA["):
                add(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        tag = match[2].lower()
        if match[1]:
            if opened[tag] > 0:
                depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)
                block = any(s[0] in _BLOCKS for s in stack[depth:])
                close(depth)
                if block:
                    flush(stack[-1][0])
            elif tag == "p":
                flush("")
            continue
        if tag in _SKIPPED:
            if tag in _RAW_END or not match[3].rstrip().endswith("/"):
                at = beyond(tag, at)
            if tag in ("select", "textarea", "iframe", "video", "audio"):
                add(" ")
            continue
        if tag == "title":
            at = beyond(tag, at)
            continue
        if tag in ("br", "wbr", "img", "hr") or tag in _VOID:
            if tag == "hr":
                flush(stack[-1][0])
            elif tag != "wbr":
                add(" ")
            continue
        if tag == "body" or tag == "html":
            flush("")
            continue
        while depth := _closed_by(tag, stack):
            close(depth)  # and what was left open inside of it
        _, boilerplate, article, inner = stack[-1]
        attributes = _attributes(match[3])
        own = _is_boilerplate(tag, attributes, article)
        if not own and attributes and _is_named_boilerplate(tag, attributes):
            own = not holds_principal(tag, match.start(), at)
        if tag == "main":
            boilerplate = False
        # Other elements tell nothing; unclosed ones in any number are not to be looked through.
        tells = tag in _BLOCKS or tag == "a" or own or boilerplate
        if tells and not match[3].rstrip().endswith("/"):
            stack.append((tag, boilerplate or own, article or tag in ("article", "main"), inner or tag == "article"))
            opened[tag] += 1
            links += tag == "a"
        if tag in _BLOCKS:
            flush(tag)
        elif own:
            current.boilerplate = current.boilerplate or not current.parts
    flush("")
    return out


def _closed_by(tag: str, stack: list[tuple[str, bool, bool, bool]]) -> int:
    """Depth of the open element that a new one ends, not beyond a block that holds it; or 0."""
    for depth in range(len(stack) - 1, 0, -1):
        name = stack[depth][0]
        if name in _CLOSES:
            if tag in _CLOSES[name]:
                return depth
        elif name in _BLOCKS:
            return 0
    return 0


def _ends(page: str, tag: str) -> dict[int, int]:
    """For each element of this name that has an end: where its start tag ends, and its end tag."""
    found: dict[int, int] = {}
    opened: list[int] = []
    for match in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", page, re.I):
        if match[1]:
            if opened:
                found[opened.pop()] = match.end()
        elif not match[0].endswith("/>"):
            opened.append(match.end())
    return found


def first_pass(block: Block) -> int:
    if block.boilerplate:
        return BAD
    if block.own:  # an article's own blocks are its text, links or not
        return GOOD
    text = block.text
    words = _LETTERS.findall(text.lower())
    heading = bool(_HEADING.fullmatch(block.tag))
    share = min(1.0, block.linked / len(text))
    if share > LINK_SHARE and (not block.article or len(words) < LONG):
        return OPEN if heading else BAD
    if block.article:  # what main holds is its text, unless links or short
        return GOOD if len(words) >= LONG else OPEN
    if len(words) < 3 * LONG and _NOTICE.search(text):
        return BAD
    if len(words) < LONG:
        return BAD if _COPYRIGHT.search(text) and not heading else OPEN
    if sum(w in STOP_WORDS for w in words) / len(words) >= STOP_SHARE:
        return GOOD
    if Counter(words).most_common(1)[0][1] > SAME_SHARE * len(words):
        return OPEN if len(words) < 3 * LONG else BAD
    # Stop words tell of four languages only; text of others is told by its length or a sentence's end.
    prose = share <= FEW_LINKS and (len(words) >= 3 * LONG or _SENTENCE_END.search(text))
    return GOOD if prose else OPEN


def second_pass(found: list[Block], labels: list[int]) -> list[int]:
    """Undecided blocks inherit from their nearest decided neighbours. The edges of a page count
    as bad; those of an article, for its own blocks, as good. At equal distance a heading goes
    with what follows, another block with what precedes it."""
    inside = [b.article and not b.boilerplate for b in found]

    def neighbours(order: range) -> list[tuple[int, int]]:
        out = [(BAD, len(found))] * len(found)
        label, place, previous = BAD, -order.step * len(found), None
        for i in order:
            if inside[i] and (previous is None or not inside[previous]):
                label, place = GOOD, i - order.step
            out[i] = (label, abs(i - place))
            if labels[i] != OPEN:
                label, place = labels[i], i
            previous = i
        return out

    before = neighbours(range(len(found)))
    after = neighbours(range(len(found) - 1, -1, -1))
    decided = list(labels)
    for i, label in enumerate(labels):
        if label == OPEN:
            (left, back), (right, ahead) = before[i], after[i]
            heading = bool(_HEADING.fullmatch(found[i].tag))
            decided[i] = right if ahead < back or (ahead == back and heading) else left
    return decided


def main_text(page: str | None) -> str:
    """The blocks labelled good, white space made single, joined by two line ends."""
    found = blocks(page or "")
    labels = second_pass(found, [first_pass(b) for b in found])
    return "\n\n".join(b.text for b, label in zip(found, labels) if label == GOOD)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points), of the whole page.

    Null and empty pages, and pages without a good block, have an empty text. Repeated rows are
    read each; columns named ``text`` and ``n_chars`` are replaced, others kept.
    """

    def many(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for run in by_size(batch) for p in run], dtype=object)

    many.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    text: Column = F.pandas_udf(many, "string")(pages[html_column])
    found = with_columns(pages, {"text": text})
    return with_columns(found, {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")})
