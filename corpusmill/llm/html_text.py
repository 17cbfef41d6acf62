"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: each block is classified by stop-word density, length and link
density into good, bad or undecided (short, or nearly good). Markup that is never main text decides at once: menus, page headers
and footers, sidebars, notices, adverts, forms, scripts, styles, hidden parts and reader comments, told by tag, role, class
or id. Second pass: undecided blocks inherit the label of the nearest decided neighbour; the edges of an <article>, <main> or
the like count as good neighbours, and so do the edges of a page that has neither such an element nor a good block. In main
elements a long block without stop words (a table, a list of names) is undecided rather than bad.

Defined results: null or empty html gives an empty text; broken markup (unclosed or crossed tags, stray `<`) is read as far as
it goes and never fails; nothing is cut off; repeated rows give equal texts.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>"[^"]*"|'[^']*'|[^>"']+)*)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<|[^<]+""", re.S)
#: The same where quotes do not count, and where no `>` is left.
UNQUOTED = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)>|(?P<end2>(?P<tag2>(?P<attrs2>(?!))))|<|[^<]+""", re.S)
TAIL = re.compile(r"""<!--.*\Z|<!\[CDATA\[.*\Z|(?P<end>(?P<tag>(?P<attrs>(?P<end2>(?P<tag2>(?P<attrs2>(?!)))))))|<|[^<]+""", re.S)
#: Tags of a page whose quotes never close, after which quotes no longer hide a `>`, so that reading stays linear.
BROKEN = 64
ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr td th".split())
#: Content of these is no text; it ends only at their own end tag.
RAW = frozenset("script style noscript iframe textarea title xmp noembed noframes template svg math object canvas audio video select".split())
#: Of these, the ones that hold no tags: `<` is a character there, and only the own end tag counts.
PLAIN = {t: re.compile(rf"</{t}(?=[\t\n\f\r />])", re.I | re.A) for t in "style noscript iframe textarea title xmp noembed noframes".split()}
SCRIPT = re.compile(r"<!--(?!-*>)|-->|<(?P<end>/?)script(?=[\t\n\f\r />])", re.I | re.A)
DROP_TAGS = frozenset("nav aside form footer head button fieldset dialog menu".split())
MAIN_TAGS = frozenset(("article", "main"))
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOT_HINTED = frozenset("html body article main".split())
#: Words of class and id that mark boilerplate; those of the second group hold even around an <article>.
DROP_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login popup modal "
    "overlay toast alert paywall share sharing social related recommended recommendations trending toolbar pagination pager widget skip hidden".split()
)
COMMENT_HINTS = frozenset("comment comments commentlist disqus reply replies respond discussion reactions".split())
MAIN_HINTS = ("articlebody", "article-body", "article-content", "post-content", "entry-content", "post-body", "story-body", "main-content")
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

#: Function words of English, French, German, Spanish, Italian, Portuguese and Dutch; fixed values.
STOP_WORDS = frozenset(
    "the of and to in a is that it was for on are as with his they at be this from have or by had not but what all were we when your can said there "
    "an which their he she you de la le les et des en un une du que est pour qui dans par sur pas au avec ce il elle se ne plus son sont ou mais nous "
    "vous der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am "
    "el los las y del por con una su para al lo como más o pero sus ha me si sin sobre este ya entre cuando muy di che il per non sono della gli dos "
    "das não uma os na het een van op te dat".split()
)
#: Densities and lengths (code points) of the first pass.
MAX_LINKS, LOW_STOPS, HIGH_STOPS, SHORT, LONG = 0.33, 0.2, 0.3, 70, 160


class Block:
    __slots__ = ("parts", "linked", "main", "drop", "heading", "region")

    def __init__(self, main: bool, drop: bool, heading: bool, region: int) -> None:
        self.parts, self.linked, self.main, self.drop, self.heading, self.region = [], 0, main, drop, heading, region


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTR.finditer(raw):
        name = (m[1] or m[5]).lower()
        out.setdefault(name, m[2] or m[3] or m[4] or "")
    return out


def _hint(tag: str, raw: str, in_main: bool) -> tuple[str, bool]:
    """'' or 'drop' or 'comment', and whether the element is a main one."""
    attrs = _attributes(raw) if raw.strip() else {}
    style = attrs.get("style", "").replace(" ", "").lower()
    role = attrs.get("role", "").lower()
    named = CAMEL.sub(" ", f"{attrs.get('class', '')} {attrs.get('id', '')}")
    flat = named.lower()
    main = tag in MAIN_TAGS or role in ("main", "article") or attrs.get("itemprop", "").lower() == "articlebody" or any(h in flat for h in MAIN_HINTS)
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return "comment", False
    words: list[str] = []
    for name in flat.split():
        parts = [p for p in SPLIT.split(name) if p]
        if parts and parts[0] not in ("has", "no", "with", "without", "is"):
            words += parts
    words_set = set(words)
    if words_set & COMMENT_HINTS and tag not in ("html", "body", "main"):
        return "comment", False
    if tag in NOT_HINTED:
        return "", main
    if tag == "aside" or tag == "form" or tag == "dialog":
        return "comment", False
    if tag in DROP_TAGS or role in DROP_ROLES:
        return "drop", False
    if (tag == "header" or words_set & {"header", "hero"} and {"site", "page", "top", "global", "main"} & words_set or words == ["header"]) and not in_main:
        return "drop", False
    if words_set & DROP_HINTS and not main:
        return "drop", False
    return "", main


def _plain_end(page: str, tag: str, at: int) -> int:
    """Where the end tag of a plain element begins whose content begins at `at`; -1 without one. In a script, a comment may hold
    a whole inner script; if then no end is left, the first end tag counts."""
    if tag != "script":
        m = PLAIN[tag].search(page, at)
        return m.start() if m else -1
    first, comment, inner = -1, False, False
    for m in SCRIPT.finditer(page, at):
        if m[0] == "<!--":
            comment = True
        elif m[0] == "-->":
            comment = inner = False
        elif not m["end"]:
            inner = comment
        elif inner:
            inner, first = False, m.start() if first < 0 else first
        else:
            return m.start()
    return first


def _tokens(page: str, at: int, broken: list[int]) -> Iterator[re.Match]:
    """Tags, comments and pieces of text from `at` on; broken counts tags whose quotes never close."""
    last, end = page.rfind(">"), len(page)
    while at < end:
        m = (TAIL if at > last else TOKEN if broken[0] < BROKEN else UNQUOTED).match(page, at)
        if m["tag2"]:
            broken[0] += 1
        at = m.end()
        yield m


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, str, bool]] = []  # tag, hint, main
    opened: dict[str, int] = {}
    drops = comments = mains = region = links = 0
    new = True
    raw_end = None
    broken, endless = [0], set()  # endless: raw elements that no end tag closes from here on
    tokens = _tokens(page, 0, broken)
    while (m := next(tokens, None)) is not None:
        tag = m["tag"] or m["tag2"]
        ends = bool(m["end"] or m["end2"])
        if tag and not ends and ((plain := tag.lower()) == "script" or plain in PLAIN) and not (m["attrs"] or m["attrs2"] or "").rstrip().endswith("/"):
            new = new or not raw_end
            at = -1 if plain in endless else _plain_end(page, plain, m.end())
            if at >= 0 and (after := page.find(">", at)) >= 0:
                tokens = _tokens(page, after + 1, broken)
                continue
            endless.add(plain)
            if not raw_end:
                break
            continue
        if raw_end:
            if tag and ends and tag.lower() == raw_end:
                raw_end, new = None, new
            continue
        if tag is None:
            text = m[0]
            if text.startswith("<!") or text.startswith("<?"):
                if text.startswith("<![CDATA["):
                    text = text[9:-3]
                else:
                    continue
            if new or not out:
                heading = any(t[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for t in stack[-4:])
                out.append(Block(mains > 0, drops + comments > 0, heading, region))
                new = False
            block = out[-1]
            block.parts.append(text)
            if links:
                block.linked += len(text.strip())
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag in ("br", "td", "th", "wbr", "img"):
                if tag != "wbr" and out and not new:
                    out[-1].parts.append(" ")
                continue
        else:
            new = True
        if ends:
            if opened.get(tag):
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    if tag in INLINE and stack[depth][0] not in INLINE:
                        break  # an inline end tag does not close blocks
                    depth -= 1
                else:
                    while len(stack) > depth:
                        name, hint, main = stack.pop()
                        opened[name] -= 1
                        drops -= hint == "drop"
                        comments -= hint == "comment"
                        mains -= main
                        region += main
                        links -= name == "a"
            continue
        if tag in RAW:
            if not (m["attrs"] or m["attrs2"] or "").rstrip().endswith("/"):
                raw_end = tag
            continue
        if tag in VOID:
            continue
        raw = m["attrs"] or m["attrs2"] or ""
        if tag == "a" and opened.get("a"):
            links, stack, opened["a"] = 0, [t for t in stack if t[0] != "a"], 0
        hint, main = _hint(tag, raw, mains > 0) if tag not in INLINE or raw else ("", False)
        if main and drops and not comments:  # a menu or advert that was never closed ends where the main element begins
            kept = [t for t in stack if t[1] != "drop"]
            for name, was, _ in stack:
                if was == "drop":
                    opened[name] -= 1
            stack, drops = kept, 0
        if tag in ("p", "li", "option", "dt", "dd", "tr") and stack and stack[-1][0] == tag and not stack[-1][1]:
            name, _, was = stack.pop()
            opened[name] -= 1
            mains -= was
        stack.append((tag, hint, main))
        opened[tag] = opened.get(tag, 0) + 1
        drops += hint == "drop"
        comments += hint == "comment"
        mains += main
        region += main
        links += tag == "a"
    return out


def first_pass(text: str, block: Block, in_main: bool) -> int:
    """1 good, -1 bad, 0 undecided."""
    if block.drop:
        return -1
    n = len(text)
    links = block.linked / n
    if links > MAX_LINKS and not (block.heading and in_main):
        return -1
    if n < SHORT:
        return 0
    words = WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stops >= HIGH_STOPS:
        return 1 if n > LONG or in_main else 0
    if stops >= LOW_STOPS or in_main:
        return 0
    return -1


def extract(page: str | None) -> str:
    """The main text, its blocks joined by newlines."""
    if not page:
        return ""
    found = []
    for b in blocks(page):
        text = " ".join(entities.unescape("".join(b.parts)).split())
        if text:
            found.append((text, b))
    labels = [first_pass(t, b, b.main) for t, b in found]
    has_main = any(b.main and not b.drop for _, b in found)
    edge = -1 if has_main or any(label > 0 for label in labels) else 1
    n = len(found)
    before, after = [0] * n, [0] * n  # label of the nearest decided neighbour and its distance, edges of main elements included

    def walk(order: range) -> list[tuple[int, int]]:
        out, label, distance, region = [(0, 0)] * n, edge, 0, None
        for k in order:
            text, b = found[k]
            if b.region != region:
                if region is not None or b.main:
                    if b.main:
                        label, distance = 1, 0
                    elif label != -1 or has_main:
                        label, distance = edge, 0
                region = b.region
            out[k] = (label, distance)
            if labels[k]:
                # menus and adverts inside a main element do not speak for the blocks beside them
                if not (b.drop and (b.main or edge > 0)):
                    label, distance = labels[k], 0
            else:
                distance += len(text)
        return out

    before, after = walk(range(n)), walk(range(n - 1, -1, -1))
    lines = []
    for k, (text, b) in enumerate(found):
        label = labels[k]
        if not label:
            (x, dx), (y, dy) = before[k], after[k]
            label = x if x == y or (dx < dy and not b.heading) else y if dy < dx or b.heading else max(x, y)
        if label > 0:
            lines.append(text)
    return "\n".join(lines)


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with the added column _text; a column of that name is replaced."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([extract(x) for x in column], dtype=object)

    return without(pages, "_text").withColumn("_text", run(F.col(html)))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))
