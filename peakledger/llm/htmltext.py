"""Main text of web pages as the maximum-scoring run of page tokens.

A word scores one; a tag costs what labelled pages say: little if it stands inside articles, much if it stands outside. One linear scan
finds the contiguous run of tokens with the largest sum. Elements inside that run that are never text (scripts, forms, adverts,
comments) are left out, and the rest is written block by block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from ..functions.shipping import by_value
from .common import arrow_pass

#: Labelled pages learned from, and tag features kept.
SAMPLE = 2_000
FEATURES = 2_000
#: Cost of a tag that always stands inside, and of one that never does, in words.
INSIDE_COST = 0.02
OUTSIDE_COST = 40.0
#: The most that a tag inside a line may cost; two of them must not outweigh the word between.
INLINE_COST = 0.4

NAME = re.compile(r"(/?)([A-Za-z][A-Za-z0-9:-]*)")
QUOTE_OR_END = re.compile(r"[>\"']")
MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PIECES = re.compile(r"[a-z]+")
RAW = frozenset("script style noscript template title textarea svg math iframe object select".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
INLINE = frozenset("a abbr b bdi bdo br cite code del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and name pieces that mark what is not the article, whatever the labelled pages hold.
ASIDE = frozenset("nav footer aside form button dialog menu".split())
ASIDE_NAMES = frozenset("""ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer
    masthead menu nav navbar navigation newsletter notice popup promo promotion related reply replies respond share sharing sidebar
    signup social sponsor sponsored subscribe toolbar widget""".split())
CONTENT = ("article", "main")


def _tag_end(page: str, at: int) -> int:
    """Where the tag's > stands, past quoted values; a tag whose quotes swallow the rest of the page ends at its first >."""
    pos = at
    while found := QUOTE_OR_END.search(page, pos):
        if found[0] == ">":
            return found.start()
        pos = page.find(found[0], found.end()) + 1
        if not pos:
            break
    return page.find(">", at)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): open and close tags with attributes, texts; comments, declarations and raw elements are passed over.

    The page is read once: what follows its last > holds no tag.
    """
    at, last = 0, page.rfind(">")
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            start = len(page)
        if page.startswith("<!--", start):
            if start > at:
                yield "text", "", page[at:start]
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        if start > last:
            yield "text", "", page[at:]
            return
        if start > at:
            yield "text", "", page[at:start]
        found = NAME.match(page, start + 1)
        if page[start + 1] in "!?":
            at = page.find(">", start) + 1
        elif not found:
            yield "text", "", "<"
            at = start + 1
        else:
            end, name = _tag_end(page, found.end()), found[2].lower()
            rest, at = page[found.end():end], end + 1
            if found[1]:
                yield "close", name, ""
            elif name in RAW and not rest.rstrip().endswith("/"):
                close = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
                at = close.end() if close else len(page)
            else:
                yield "open", name, rest


def names_of(rest: str) -> set[str]:
    return {p for m in MARKED.finditer(rest) for p in PIECES.findall((m[1] or m[2] or m[3] or "").lower())} if rest else set()


def feature(kind: str, name: str, rest: str) -> str:
    aside = names_of(rest) & ASIDE_NAMES if rest else ()
    return f"{'/' if kind == 'close' else ''}{name}{'.' + min(aside) if aside else ''}"


def without_asides(found: list[tuple[str, str, str]]) -> list[tuple[str, str, str] | None]:
    """None in place of what stands in a closed element that is no article text; an unclosed one loses only its tag.

    An element that holds the page's article or main element stays, whatever it is called; where the page has none, so does one that
    holds half of the page's words or more.
    """
    out: list = list(found)
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    words, contents = [0], [0]
    for k, (kind, name, rest) in enumerate(found):
        words.append(words[-1] + (len(rest.split()) if kind == "text" else 0))
        contents.append(contents[-1] + (kind == "open" and name in CONTENT))
        if kind == "open" and name not in VOID:
            opened.setdefault(name, []).append(k)
        elif kind == "close" and opened.get(name):
            ends[opened[name].pop()] = k

    def holds_the_text(k: int) -> bool:
        if contents[-1]:
            return contents[ends[k]] > contents[k + 1]
        return 2 * (words[ends[k]] - words[k]) >= words[-1] > 0

    k, within = 0, 0
    while k < len(found):
        kind, name, rest = found[k]
        within += (kind == "open" and name in CONTENT) - (kind == "close" and name in CONTENT and within > 0)
        aside = kind == "open" and (name in ASIDE or name == "header" and not within or name not in (*CONTENT, "body", "html") and names_of(rest) & ASIDE_NAMES)
        if aside and k in ends and not holds_the_text(k):
            for j in range(k + 1, ends[k]):
                out[j] = None
            k = ends[k]
        else:
            k += 1
    return out


def count_tags(page: str) -> Counter:
    """(feature, inside the labelled content or not) of a page that holds exactly one content element; empty for others."""
    found = list(tokens(page))
    opens = [k for k, (kind, name, _) in enumerate(found) if kind == "open" and name in CONTENT]
    closes = [k for k, (kind, name, _) in enumerate(found) if kind == "close" and name in CONTENT]
    if len(opens) != 1 or len(closes) != 1 or closes[0] < opens[0]:
        return Counter()
    return Counter((feature(*t), opens[0] < k < closes[0]) for k, t in enumerate(found) if t[0] != "text" and t[1] not in CONTENT)


def learn(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Cost by tag feature, from at most about `sample` labelled pages (an article or main element marks the content): those whose
    text has the smallest hash. At most FEATURES sums reach the driver; no labelled page gives no cost."""
    labelled = pages.select(F.xxhash64(html_column).alias("h"), F.col(html_column).cast("string").alias("page")).where(F.col("page").rlike("(?i)<(article|main)[\\s>]"))
    last = labelled.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h").alias("h")).first()["h"]
    if last is None:
        return {}

    def count(x: dict[str, list]) -> dict[str, list]:
        rows = [(f, int(inside), n) for page in x["page"] for (f, inside), n in count_tags(page).items()]
        return {"feature": [r[0] for r in rows], "inside": [r[1] * r[2] for r in rows], "n": [r[2] for r in rows]}

    counted = arrow_pass(labelled.where(F.col("h") <= last).dropDuplicates(["h"]).select("page"), "feature string, inside long, n long", count)
    sums = counted.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("n").alias("n")).orderBy(F.desc("n"), "feature").limit(FEATURES).collect()
    return {r["feature"]: cost((r["n"] - r["inside"] + 0.01) / (r["n"] + 0.02)) for r in sums}


def cost(outside: float) -> float:
    return INSIDE_COST + (OUTSIDE_COST - INSIDE_COST) * outside ** 2


def _unseen(kind: str, name: str, rest: str) -> float:
    """For a feature no labelled page holds."""
    if name in CONTENT:
        return INSIDE_COST
    if name in ASIDE or name in ("header", "li", "ul", "input", "label", "head") or names_of(rest) & ASIDE_NAMES:
        return cost(0.9 if name not in ("li", "ul") else 0.15)
    return cost(0.05)


def best_run(scores: list[float]) -> tuple[int, int]:
    """(begin, end) of the contiguous run with the largest sum, by one scan; (0, 0) where no sum is above zero."""
    best, total, begin, span = 0.0, 0.0, 0, (0, 0)
    for k, score in enumerate(scores):
        total += score
        if total <= 0:
            total, begin = 0.0, k + 1
        elif total > best:
            best, span = total, (begin, k + 1)
    return span


def score(token: tuple[str, str, str] | None, costs: dict[str, float]) -> float:
    """A text's words, or less the tag's cost; what was taken out counts nothing."""
    if token is None:
        return 0.0
    kind, name, rest = token
    if kind == "text":
        return float(len(rest.split()))
    f = feature(kind, name, rest)
    price = costs[f] if f in costs and name not in CONTENT else _unseen(kind, name, rest)
    return -min(price, INLINE_COST) if name in INLINE else -price


def main_text(page: str | None, costs: dict[str, float]) -> str:
    """Blocks of the best run, one a line; empty for null or empty pages and pages without words."""
    if not page:
        return ""
    shown = without_asides(list(tokens(page)))
    span = best_run([score(t, costs) for t in shown])
    blocks: list[list[str]] = [[]]
    for token in shown[slice(*span)]:
        if token is None:
            continue
        kind, name, rest = token
        if kind == "text":
            blocks[-1].append(rest)
        elif name in BLOCKS:
            blocks.append([])
        elif name == "br":
            blocks[-1].append(" ")
    written = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(b for b in written if b)


def extract(pages: DataFrame, costs: dict[str, float], page_id: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text) per row; text is empty where there is none. Repeated rows give equal rows."""
    kinds = f"page_id {pages.schema[page_id].dataType.simpleString()}, url {pages.schema[url].dataType.simpleString()}, text string"
    wide = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html_column).cast("string").alias("page"))
    return arrow_pass(wide, kinds, lambda x: {"page_id": x["page_id"], "url": x["url"], "text": [main_text(p, costs) for p in x["page"]]})


by_value(__name__)
