"""Main-text extraction from html by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass decides blocks on their own: those inside
navigation, headers, footers, sidebars, notices, adverts, forms or comments are boilerplate, unless an article
or the main element begins inside a wrapper so marked, or a form is round the page; of the others,
blocks with many linked words are boilerplate, and long enough blocks with a fair share of stop words, or
with few links inside an article, are content.  Short or unclear blocks stay open; the second pass gives
them the label of their nearest decided neighbour.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)/?>"
    r"|(?P<text>[^<]+|<(?![a-zA-Z/]))|</(?![a-zA-Z])[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")

#: Html elements by their part in a page.
SKIPPED = frozenset("script style noscript template svg math head title iframe object canvas select textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section
summary table tbody td tfoot th thead tr ul""".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog button fieldset".split())
MAIN = frozenset("article main".split())
#: Words in class, id and role attributes that name boilerplate.
BOILERPLATE_NAMES = frozenset("""ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment
comments complementary contentinfo cookie cookies consent disqus footer header login masthead menu nav navbar navigation
newsletter notice notices pager pagination popup promo promoted related replies respond search share sharing sidebar
signup social sponsor sponsored subscribe toolbar widget widgets""".split())
#: Marks that an article or main element inside does not lift.
LASTING = frozenset("nav footer aside menu dialog".split())
LASTING_NAMES = frozenset("""ad ads advert advertisement adverts advertising comment comments contentinfo disqus footer
menu nav navbar navigation promoted related replies respond sponsor sponsored""".split())
#: Words that make a name a state of a wrapper, as in no-sidebar or header-fixed.
STATES = frozenset("no not with without has have is hide hidden show enabled disabled fixed sticky".split())
#: Frequent words of a few languages.
STOP_WORDS = frozenset("""the of and to in is that it for was on are as with be by at this from or an not you he have
der die das und ist von zu den mit ein eine nicht auf im sich des dem für als auch
de la que el en y los las un una por con no se del es su al lo para
le les et des est une du dans qui pas sur par au ce il plus ne avec pour""".split())


@dataclass(frozen=True)
class BlockOptions:
    #: Share of linked characters above which a block is boilerplate.
    max_link_density: float = 0.4
    #: Words from which a block can decide for itself, and its share of stop words for content.
    min_words: int = 8
    min_stop_density: float = 0.12


@dataclass
class Block:
    text: str
    linked: int
    boilerplate: bool
    main: bool
    label: bool | None = None
    #: Number of the form or so named wrapper round the block, and whether it marks the block; 0 for none.
    form: int = 0
    formed: bool = False


def _boilerplate_names(attrs: str) -> tuple[set[str], set[str]]:
    """Words of ``BOILERPLATE_NAMES`` that begin or end a class, id or role, and those that stand inside one; none
    from the name of a state."""
    found, inside = set(), set()
    for m in _ATTR.finditer(attrs):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            words = _NAME.findall(name)
            if words and STATES.isdisjoint(words):
                found |= BOILERPLATE_NAMES.intersection((words[0], words[-1]))
                inside |= BOILERPLATE_NAMES.intersection(words[1:-1])
    return found, inside


def _mark_forms(found: list[Block]) -> list[Block]:
    """Blocks in a form, or in a wrapper with such a word inside its name, are boilerplate, unless it is round the page:
    it has half of the text or more that is not boilerplate otherwise."""
    size: Counter[int] = Counter()
    for b in found:
        size[b.form] += 0 if b.boilerplate else len(b.text)
    for b in found:
        b.boilerplate |= b.formed and 2 * size[b.form] < size.total()
    return found


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order, white space made one space."""
    out: list[Block] = []
    text: list[str] = []
    linked = 0
    # tag, skipped, boilerplate, main, lasting boilerplate, form, marked by it: inherited
    stack: list[tuple[str, bool, bool, bool, bool, int, bool]] = []
    none = ("", False, False, False, False, 0, False)
    open_tags: Counter[str] = Counter()
    forms = 0
    skip_until = ""
    state = none
    anchors = 0

    def flush():
        nonlocal linked
        body = " ".join(entities.unescape("".join(text)).split())
        if body:
            out.append(Block(body, linked, state[2], state[3], None, state[5], state[6]))
        text.clear()
        linked = 0

    pos, n = 0, len(page)
    while pos < n:
        if skip_until:  # raw text up to the closing tag
            m = re.compile(rf"</{skip_until}\b[^>]*>", re.I).search(page, pos)
            pos, skip_until = (m.end() if m else n), ""
            continue
        m = _TOKEN.match(page, pos)
        if m is None:  # a tag with an open quote ends at the next bracket, or with the page
            pos = page.find(">", pos) + 1 or n
            continue
        pos = m.end()
        if m["text"] is not None:
            if not state[1]:
                text.append(m["text"])
                linked += len(m["text"].strip()) if anchors else 0
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            anchors = 0
        elif tag == "a":
            anchors = 0 if m["close"] else 1
        if m["close"]:
            if open_tags[tag]:
                while True:
                    last = stack.pop()[0]
                    open_tags[last] -= 1
                    if last == tag:
                        break
                state = stack[-1] if stack else none
            continue
        if tag in ("script", "style", "noscript", "template", "textarea", "title", "iframe"):
            if not m[0].endswith("/>"):
                skip_until = tag
            continue
        if tag in VOID:
            continue
        if tag in BLOCK or tag in SKIPPED or tag == "span" or tag in BOILERPLATE:
            if tag == "p" or tag == "li":  # these end where the next begins
                while stack and stack[-1][0] == tag == "p":
                    stack.pop()
                    open_tags["p"] -= 1
                state = stack[-1] if stack else none
            names, inside = (set(), set()) if tag in ("html", "body", *MAIN) else _boilerplate_names(m["attrs"])
            bad = tag in BOILERPLATE and tag != "form" and not (tag == "header" and state[3]) or bool(names)
            lasting = state[4] or tag in LASTING or not LASTING_NAMES.isdisjoint(names)
            lifted = tag in MAIN and not lasting
            sized = tag == "form" or bool(inside)
            outer = sized and not state[6]
            forms += outer
            state = (tag, state[1] or tag in SKIPPED, (state[2] or bad) and not lifted, state[3] or tag in MAIN, lasting,
                     forms if outer else state[5], (state[6] or sized) and not lifted)
            stack.append(state)
            open_tags[tag] += 1
    flush()
    return _mark_forms(out)


def classify(found: list[Block], o: BlockOptions) -> list[Block]:
    """Label every block: first pass by its own measures, second by the nearest decided neighbour (ties: the
    one before; none: content)."""
    for b in found:
        words = b.text.split()
        density = b.linked / max(len(b.text), 1)
        stops = sum(w.lower().strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
        if b.boilerplate or density > o.max_link_density:
            b.label = False
        elif len(words) >= o.min_words and (stops >= o.min_stop_density or b.main):
            b.label = True
    # Outright boilerplate says nothing about an article's own short blocks.
    near: list[tuple[float, bool] | None] = [None] * len(found)
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last: tuple[int, bool] | None = None
        for i in order:
            b = found[i]
            if b.label is not None:
                if not (b.boilerplate and not b.label):
                    last = (i, b.label)
            elif last and (near[i] is None or abs(i - last[0]) < near[i][0]):
                near[i] = (abs(i - last[0]), last[1])
    for b, n in zip(found, near):
        if b.label is None:
            b.label = n[1] if n else True
    return found


def main_text(page: str | None, options: BlockOptions = BlockOptions()) -> str:
    return "\n".join(b.text for b in classify(blocks(page or ""), options) if b.label)


def extract_text(html: Column, options: BlockOptions = BlockOptions()) -> Column:
    @F.arrow_udf(T.StringType())
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in column:
            yield pa.array([main_text(x.as_py(), options) for x in array], pa.string())

    return run(html)


def extract_pages(pages: DataFrame, html_col: str = "html", options: BlockOptions = BlockOptions()) -> DataFrame:
    """``pages`` with ``text``, the main text (blocks joined by a line break), and ``n_chars``, its code points.

    Null and empty html, and pages of boilerplate only, have an empty text.  Rows are kept as they are,
    repeated ones too; extra columns pass through; columns named ``text`` and ``n_chars`` are replaced.
    """
    out = pages.withColumn("text", extract_text(F.col(html_col), options))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
