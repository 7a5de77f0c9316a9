"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. Pass 1 looks at each block
alone: what stands in a boilerplate element, or is mostly link text, is bad; a
long block with enough stop words of the page's language is good; what is long
and has few of them is bad, unless it stands in an article; the rest, short
blocks above all, is undecided. A page in none of the known languages is judged
by length and link density alone. Pass 2 gives an undecided block the label of
the nearest decided block, of its own container first.

Boilerplate is told by the element, by names of its class, id or role (each
name as a whole: `site-footer` and `comment-list` are hints, `no-sidebar` and
`page-with-footer` are not), or by a heading over reader comments. A named
container that holds most of the page's own text, with no article elsewhere, is
the page itself and no boilerplate, whatever its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of a block's characters in links from which it is bad.
LINK_DENSITY = 0.34
#: Characters from which a block is judged by its stop words.
LONG = 70
#: A letter of a script that writes no spaces counts as so many characters.
DENSE_LETTER = 3
#: Share of stop words of any one language below which a page's language is unknown.
KNOWN = 0.08
#: Share of stop words from which a long block is good, and below which it is bad.
STOP_HIGH, STOP_LOW = 0.15, 0.05

# Common function words of the languages that pages come in.
STOP_WORDS = {
    "en": "a about after all also an and any are as at be been but by can could do for from had has have he her his "
          "how i if in into is it its me more my no not of on or our out she so some than that the their them then "
          "there they this to up was we were what when which who will with would you your",
    "de": "aber als am an auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer "
          "er es für hat ich ihr im in ist ja kann mit nach nicht noch nur oder sich sie sind so über um und uns von "
          "vor war was wenn wie wir wird zu zum zur",
    "fr": "au aux avec ce ces dans de des du elle en est et être eux il ils je la le les leur lui ma mais me même mes "
          "moi mon ne nos notre nous on ou où par pas plus pour qu que qui sa sans se ses si son sont sur ta te tu un "
          "une vos votre vous",
    "es": "a al algo como con de del desde donde el ella en entre era es esta este fue ha hasta la las le lo los más "
          "me mi muy no nos o para pero por porque que se ser si sin sobre son su sus también te tiene un una uno y ya",
    "it": "a al alla anche che chi ci come con da dal dei del della di e è ed era gli ha i il in io la le lo ma mi nel "
          "non o per più quando questo se si sono su un una",
    "pt": "a ao as com como da das de do dos e é ela ele em entre era essa foi há isso já mais mas na não nas no nos "
          "o os ou para pela por que se sem ser seu sua também um uma",
    "nl": "aan als bij dat de der die dit door een en er het hij ik in is je maar met naar niet nog of om ook op over "
          "te tot uit van voor was wat we wel wij zijn zo",
}
_LANGS = list(STOP_WORDS)
_STOP: dict[str, int] = {}
for _i, _words in enumerate(STOP_WORDS.values()):
    for _w in _words.split():
        _STOP[_w] = _STOP.get(_w, 0) | 1 << _i

_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre "
                   "section select summary table tbody td textarea tfoot th thead tr ul".split())
#: Elements whose content is one group of blocks.
_CONTAINER = frozenset("article aside body details dialog div dl fieldset footer form header main menu nav ol section "
                       "table ul select textarea button".split())
_BOILERPLATE = frozenset("aside button dialog fieldset footer form menu nav select textarea".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words of class, id and role that mark boilerplate, at the end of a name or alone; the first ones always.
_NEVER_MAIN = frozenset("comment comments disqus respond".split())
_HINTS = _NEVER_MAIN | frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs complementary consent contentinfo cookie "
    "cookies copyright footer header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promotion related search share sharing sidebar social sponsor sponsored subscribe toolbar widget "
    "widgets".split())
#: Words that may follow a hint in a name, and words that turn its meaning.
_PARTS = frozenset("area bar block body bottom box button buttons container content form group inner item items left link links list "
                   "outer panel right section slot thread title top unit wrap wrapper".split())
_TURNED = frozenset("has no non not off with without".split())
#: Headings over reader comments.
_COMMENTS = re.compile(r"(?:\d+\s+)?(?:reader |readers' |user )?(?:comments?|responses?|replies|kommentare?|commentaires?|comentarios?|commenti|"
                       r"reacties|comentários)(?:\s*\(?\d+\)?)?:?|(?:leave|post|write) a (?:comment|reply)", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|title)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^<>]*)>"
    r"|<[!?/][^<>]*(?:>|\Z)",
    re.S | re.I)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:\A|\s)hidden(?:\s|=|\Z)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u3040-\u30ff\u3400-\u9fff\U00020000-\U0002fa1f]")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¿¡·©"


@dataclass
class _Block:
    text: str
    link: int  # characters in links
    container: int
    bad: bool  # in a boilerplate element
    main: bool  # in an article
    named: int = 0  # the outermost container (its number) that is boilerplate by its name only
    label: bool | None = None
    words: list[int] = field(default_factory=list)  # stop-word languages, a bit each


@dataclass
class _Open:
    tag: str
    number: int
    bad: bool
    main: bool
    named: int = 0


def _hint(name: str) -> str | None:
    """The hint in one name of a class, id or role."""
    parts = [p for p in map(str.lower, _PART.findall(name)) if not p.isdigit()]
    if not parts or not _TURNED.isdisjoint(parts):
        return None
    while len(parts) > 1 and parts[-1] in _PARTS:
        parts.pop()
    return parts[-1] if parts[-1] in _HINTS else None


def _hints(attrs: str) -> list[str]:
    found = (_hint(name) for m in _NAMED.finditer(attrs) for name in m[1].strip("\"'").split())
    return [h for h in found if h]


def blocks_of(html: str) -> list[_Block]:
    """The page's blocks of text, in page order."""
    blocks: list[_Block] = []
    stack = [_Open("", 0, False, False)]
    opened: dict[str, int] = {}  # containers open, by tag
    numbers, pieces, links, in_link = 1, [], 0, 0
    own_bad = False  # the block's own element is boilerplate by its name
    heading = 0  # level of the heading the block is in
    comments: tuple[int, int] | None = None  # level of a heading over comments, and the container it stands in

    def close() -> None:
        nonlocal pieces, links, comments
        text = " ".join("".join(pieces).split())
        if text:
            top = stack[-1]
            if heading:
                if comments and heading <= comments[0]:
                    comments = None
                if _COMMENTS.fullmatch(text):
                    comments = (heading, top.number)
            blocks.append(_Block(text, links, top.number, top.bad or own_bad or comments is not None, top.main, top.named))
        pieces, links = [], 0

    def add(raw: str) -> None:
        nonlocal links
        if raw:
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                links += len(" ".join(text.split()))

    at = 0
    head = 0  # depth of <head>
    for m in _TOKEN.finditer(html):
        if not head:
            add(html[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m["raw"]:
                pieces.append(" ")
            continue
        ends, attrs = bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if tag == "head":
            head = 0 if ends else 1
        elif tag == "body" or tag in _CONTAINER or tag == "p":
            head = 0  # a page may leave its head open
        if tag == "a":
            in_link = 0 if ends else 1
        elif tag == "br":
            pieces.append(" ")
        if tag in _BLOCK:
            close()
            in_link = 0
            heading = int(tag[1]) if not ends and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else 0
            own_bad = not ends and tag not in _CONTAINER and bool(_HIDDEN.search(attrs) or _hints(attrs))
        if tag not in _CONTAINER or tag in _VOID:
            continue
        if ends:
            if opened.get(tag):
                while stack[-1].tag != tag:
                    opened[stack.pop().tag] -= 1
                closed = stack.pop()
                opened[tag] -= 1
                if comments and comments[1] >= closed.number:
                    comments = None
        else:
            top = stack[-1]
            main = top.main or tag in _MAIN
            bad, named = top.bad or tag in _BOILERPLATE or (tag == "header" and not top.main), top.named
            if tag not in _MAIN and tag != "body":
                found = _hints(attrs)
                if _HIDDEN.search(attrs) or not _NEVER_MAIN.isdisjoint(found):
                    bad = True
                elif found:
                    named = named or numbers
            stack.append(_Open(tag, numbers, bad, main, named))
            opened[tag] = opened.get(tag, 0) + 1
            numbers += 1
    if not head:
        add(html[at:])
    close()
    _by_name(blocks)
    return blocks


def _by_name(blocks: list[_Block]) -> None:
    """Containers with a boilerplate name are bad, but for one that holds most
    of what is not bad anyway and not in links, if no article stands outside."""
    own = {i: len(b.text) - min(b.link, len(b.text)) for i, b in enumerate(blocks) if not b.bad}
    total, held, main = sum(own.values()), {}, False
    for i, n in own.items():
        held[blocks[i].named] = held.get(blocks[i].named, 0) + n
        main = main or (blocks[i].main and not blocks[i].named)
    for b in blocks:
        b.bad = b.bad or bool(b.named and (main or 2 * held.get(b.named, 0) <= total))


def _length(text: str) -> int:
    """Characters, those of a script without spaces counted for the words they stand for."""
    return len(text) if text.isascii() else len(text) + (DENSE_LETTER - 1) * len(_DENSE.findall(text))


def _decide(blocks: list[_Block]) -> None:
    """Pass 1: label what can be told from the block alone."""
    for b in blocks:
        b.words = [_STOP.get(w.strip(_EDGE).lower(), 0) for w in b.text.split()]
    spoken = [b for b in blocks if not b.bad and b.link <= LINK_DENSITY * len(b.text)]
    hits = [sum(w >> i & 1 for b in spoken for w in b.words) for i in range(len(_LANGS))]
    lang = max(range(len(_LANGS)), key=hits.__getitem__)
    known = hits[lang] >= KNOWN * sum(len(b.words) for b in spoken)
    for b in blocks:
        density = sum(w >> lang & 1 for w in b.words) / len(b.words)
        if b.bad or b.link > LINK_DENSITY * len(b.text) or ("©" in b.text and not b.main):
            b.label = False
        elif _length(b.text) >= LONG and (density >= STOP_HIGH or not known):
            b.label = True
        elif len(b.text) >= LONG and density < STOP_LOW and not b.main:
            b.label = False


def _inherit(blocks: list[_Block]) -> None:
    """Pass 2: undecided blocks take the label of the nearest decided one, of
    their own container first; at equal distance good wins. Without a decided
    block in it, an article is good; without one on the page, everything is."""
    def nearest(own: list[int]) -> dict[int, bool]:
        found: dict[int, tuple[int, bool]] = {}
        for step in (own, own[::-1]):
            seen: tuple[int, bool] | None = None  # distance, label
            for i in step:
                if blocks[i].label is not None:
                    seen = (0, blocks[i].label)
                elif seen:
                    seen = (seen[0] + 1, seen[1])
                    if i not in found or (seen[0], not seen[1]) < (found[i][0], not found[i][1]):
                        found[i] = seen
        return {i: label for i, (_, label) in found.items()}

    groups: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        groups.setdefault(b.container, []).append(i)
    labels = nearest(list(range(len(blocks))))
    for i, b in enumerate(blocks):
        if b.main:
            labels[i] = True
    for own in groups.values():
        labels.update(nearest(own))
    for i, b in enumerate(blocks):
        if b.label is None:
            b.label = labels.get(i, True)


def main_text(html: str | None) -> str:
    blocks = blocks_of(html or "")
    if blocks:
        _decide(blocks)
        _inherit(blocks)
    return " ".join(b.text for b in blocks if b.label)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null html, and a page without text: empty. Null ids and urls stay null; repeated rows give repeated
    results; an empty table gives no rows; other columns are not read. The
    work is one pass over each page, linear in its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
