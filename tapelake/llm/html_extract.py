"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags.  Pass one decides a block by its link density, length and stop-word
density; prose of comments, adverts, notices and the like reads as an article's does, so there the element that holds
it decides.  Blocks that stay ambiguous, most of them short, inherit in pass two the label of the nearest decided
neighbours, where a neighbour in another section of the page counts as further off.  An ``article`` or ``main``
element decides nothing by itself; it tips the scales where the neighbours disagree.

Reading a page takes time in proportion to its length, whatever its markup.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import map_batches

# Elements that end a block, that are dropped whole, that never hold main text, that have no end tag.
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
DROPPED = frozenset("script style noscript template svg math iframe object embed canvas audio video textarea head title".split())
OUTSIDE = frozenset("nav footer aside form menu button select dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HOLDERS = frozenset("article aside body center details dialog div dl fieldset figure footer form header html main menu nav ol section table tbody td tr ul button select li blockquote".split())
INSIDE = frozenset("article main".split())
#: Words in a class or id that mark what is not the article.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|alert|popup|modal|overlay|comment\w*|disqus|repl(?:y|ies)|respond|reactions?|"
    r"nav\w*|menu\w*|breadcrumb\w*|sidebar\w*|side|widget\w*|footer\w*|header|masthead|topbar|toolbar|related\w*|recommend\w*|share\w*|sharing|social\w*|subscribe|newsletter|signup|login|"
    r"search|pagination|pager|copyright|legal|disclaimer|tags|meta|byline|skip)(?:$|[\s_-])",
    re.I,
)
#: Frequent function words of the languages at hand.
STOPWORDS = frozenset(
    # English
    "a about after all also an and any are as at be because been but by can could do for from had has have he her his how i if in into is it its just more most my no not of on one only or other our out over she so "
    "some such than that the their them then there these they this to up was we were what when which who will with would you your "
    # German
    "aber alle als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer eines er es für haben hat ich ihr im in ist ja kann mit nach nicht noch nur oder sein sich sie sind so "
    "über um und uns unter vom von vor war was wenn werden wie wir wird zu zum zur "
    # French
    "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur leurs lui mais me même mes nous on ont ou où par pas plus pour que qui sa se ses si son sont sur te tu un une vos votre vous y "
    # Spanish
    "al algo como con cuando de del desde donde el ella ellos en entre era es esta este está fue ha hay la las le lo los más me mi muy no nos o para pero por porque que se si sin sobre su sus también te tiene un una uno y ya".split()
)

#: Elements that part the sections of a page.
SECTIONS = frozenset("article aside body details dialog div fieldset footer form header main nav section td".split())

#: Characters from which a block isn't short and from which it is long; link and stop-word densities.
LONG, LENGTHY = 70, 200
LINKS, STOPS = 0.33, 0.15
#: Up to this link density the neighbours of a long block rich in stop words decide.
RICH = 0.6
#: Blocks that a border between sections counts for in the distance of neighbours.
BORDER = 3

#: A tag ends at the first ``>`` outside a value in quotes, and only a quote after ``=`` begins such a value.
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|$))|<[!?][^>]*(?:>|$)|</[^a-zA-Z>][^>]*(?:>|$)|</>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$)|[^\s>]*+))*+)(?:>|$)", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
#: What a copyright notice begins with; prose about copyright goes on in words.
NOTICE = re.compile(r"©|\(c\)\s*\d{4}|copyright\s*(?:©|\(c\)|\d{4})", re.I)
_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in DROPPED}


@dataclass
class Block:
    """Text of a block, its characters within links, what holds it, and what pass one and two made of it."""

    text: str
    linked: int
    inside: bool
    outside: bool
    heading: bool
    section: int
    label: str = field(default="")
    decided: str = field(default="")


def blocks_of(page: str) -> list[Block]:
    """Cut a page into blocks; broken markup never fails."""
    out: list[Block] = []
    parts: list[str] = []
    linked = anchor = 0
    heading = False
    # Open holders: tag, 1 if it is outside the main text by its tag, 2 if by its name and 3 if it is a form, section before it.
    stack: list[tuple[str, int, int]] = []
    held: Counter = Counter()
    out_depth = in_depth = section = sections = opened = 0
    unclosed: set[str] = set()
    # Forms that are open, those that hold the article, and the forms around each block.
    forms: list[int] = []
    chosen: set[int] = set()
    around: list[tuple[int, ...]] = []

    def close() -> None:
        nonlocal linked, parts
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, min(linked, len(text)), in_depth > 0, out_depth > 0, heading, section))
                around.append(tuple(forms))
        parts, linked = [], 0

    def pop() -> str:
        nonlocal out_depth, in_depth, section
        tag, outside, section = stack.pop()
        held[tag] -= 1
        out_depth -= outside in (1, 2)
        in_depth -= tag in INSIDE
        if outside == 3:
            forms.pop()
        return tag

    at, size = 0, len(page)
    while at < size:
        hit = _TOKEN.search(page, at)
        text = page[at : hit.start() if hit else size]
        if text:
            parts.append(text)
            if anchor:
                linked += len(text.strip())
        if not hit:
            break
        at = hit.end()
        tag = (hit[2] or "").lower()
        if not tag:
            continue
        ends = bool(hit[1])
        if tag in DROPPED:
            if tag in ("title", "head"):
                close()
            if not ends and tag != "head" and tag not in unclosed and not hit[3].rstrip().endswith("/"):
                end = _ENDS[tag].search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style"):
                    at = size
                else:
                    unclosed.add(tag)
            continue
        if tag == "a":
            anchor = 0 if ends or not _HREF.search(hit[3]) else 1
            continue
        if tag in BLOCK:
            close()
            if tag[0] == "h" and tag[1:].isdigit():
                heading = not ends
            elif not heading or tag != "br":
                heading = False
        if not ends and (tag == "h1" or tag in INSIDE):
            chosen.update(forms)
        if (tag == "h1" and not ends) or tag == "main":
            # A page's title or main part shows that a holder was named after something else.
            for i, (name, outside, before) in enumerate(stack):
                if outside == 2:
                    stack[i] = (name, 0, before)
                    out_depth -= 1
        if tag in HOLDERS:
            if ends:
                if held[tag]:
                    while pop() != tag:
                        pass
                anchor = 0
            else:
                if tag == "li" and stack and stack[-1][0] == "li":
                    pop()
                names = " ".join(x for m in _NAMED.findall(hit[3]) for x in m if x)
                marked = tag not in ("html", "body", "article", "main") and bool((names and BOILERPLATE.search(names)) or (hit[3] and _HIDDEN.search(hit[3])))
                outside = 2 if marked else 3 if tag == "form" else 1 if tag in OUTSIDE or (tag == "header" and not in_depth) else 0
                stack.append((tag, outside, section))
                held[tag] += 1
                out_depth += outside in (1, 2)
                if outside == 3:
                    opened += 1
                    forms.append(opened)
                in_depth += tag in INSIDE
                if tag in SECTIONS:
                    sections += 1
                    section = sections
    close()
    _judge_forms(out, around, chosen)
    return out


def _judge_forms(blocks: list[Block], around: list[tuple[int, ...]], chosen: set[int]) -> None:
    """Blocks in a form are outside the main text, unless it holds a title, an article or most of what else may be the page's text."""
    held: Counter = Counter()
    for b, forms in zip(blocks, around, strict=True):
        if not b.outside and len(b.text) >= LENGTHY and 2 * b.linked <= len(b.text):
            held.update({f: len(b.text) for f in (0, *forms)})
    whole = {f for f, n in held.items() if f and 2 * n > held[0]} | chosen
    for b, forms in zip(blocks, around, strict=True):
        b.outside = b.outside or any(f not in whole for f in forms)


def densities(block: Block) -> tuple[float, float]:
    """Shares of stop words among the words, and of linked characters among all."""
    words = [w.strip(".,;:!?\"'()#*$%&").lower() for w in block.text.split()]
    return sum(w in STOPWORDS for w in words) / max(1, len(words)), block.linked / max(1, len(block.text))


def first_pass(blocks: list[Block]) -> None:
    """Label 'good' or 'bad' where a block decides itself, else 'near' (likely good) or 'short'."""
    for b in blocks:
        stops, links = densities(b)
        prose = len(b.text) >= LENGTHY and stops >= STOPS
        if links > (RICH if prose and not b.outside else LINKS):
            b.label, b.decided = "bad", "links"
        elif b.outside or (NOTICE.match(b.text) and not prose):
            b.label, b.decided = "bad", "holder"
        elif links > LINKS:
            b.label = "near"
        elif b.heading or len(b.text) < LONG:
            b.label = "short"
        elif len(b.text) >= LENGTHY and stops >= STOPS:
            b.label, b.decided = "good", "density"
        else:
            b.label = "near" if stops >= STOPS or len(b.text) >= LENGTHY else "short"


def _nearest(blocks: list[Block]) -> list[tuple[int, int]]:
    """(distance, index) of the last decided block at or before each block, by the label that pass one gave; -1 if none.

    The nearest one of the same section and the nearest one of any section compete, the latter at BORDER more.
    """
    out, last, by_section = [], -1, {}
    for i, b in enumerate(blocks):
        if b.decided:
            last = i
            by_section[b.section] = i
        own = by_section.get(b.section, -1)
        near = [(i - j + (BORDER if blocks[j].section != b.section else 0), j) for j in (own, last) if j >= 0]
        out.append(min(near) if near else (1 << 30, -1))
    return out


def second_pass(blocks: list[Block]) -> None:
    """Give ambiguous blocks the label of the nearest decided neighbours.

    A heading goes with what follows.  Where the neighbours on the two sides differ, the nearer one counts; at equal
    distance, or beside bad neighbours only, a block is good if it is near good or in an article.  If no block of a
    page has decided itself as good, all its ambiguous blocks are good: they are the only text that may be meant.
    """
    before = _nearest(blocks)
    after = [(d, len(blocks) - 1 - j if j >= 0 else -1) for d, j in reversed(_nearest(blocks[::-1]))]
    some = any(b.label == "good" for b in blocks)
    found = []
    for b, (left, i), (right, j) in zip(blocks, before, after, strict=True):
        if b.decided:
            found.append(b.label)
            continue
        likely = b.label == "near" or b.inside
        sides = [blocks[k].label for k in (i, j) if k >= 0]
        if not some:
            label = "good"
        elif not any(x == "good" for x in sides):
            label = "good" if likely else "bad"
        elif all(x == "good" for x in sides) or (b.heading and j >= 0 and blocks[j].label == "good" and right < left + BORDER):
            label = "good"
        elif left == right:
            label = "good" if likely else "bad"
        else:
            label = blocks[i if left < right else j].label
            label = "good" if label == "bad" and b.inside else label
        found.append(label)
    for b, label in zip(blocks, found, strict=True):
        if not b.decided:
            b.label, b.decided = label, "neighbours"


def classify(blocks: list[Block]) -> None:
    """Label every block 'good' or 'bad', and note what decided it."""
    first_pass(blocks)
    second_pass(blocks)


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by a blank; empty if there is none."""
    blocks = blocks_of(page or "")
    classify(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def extract(df: DataFrame, id_column: str = "page_id", source: str = "html", keep: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null and empty pages have the empty text, and so have pages without main text; repeated rows stay, an empty table
    gives no row, and other columns are ignored.
    """

    def run(rows: dict) -> dict:
        texts = [main_text(x) for x in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(df.select(F.col(id_column).cast("long").alias("page_id"), F.col(keep).cast("string").alias("url"), F.col(source).alias("html")), "page_id long, url string, text string, n_chars long", run, "html")
