"""HTML main text by the maximum-scoring subsequence of a page's tokens.

Words score positive, tags negative; weights come from labelled pages (those that mark their article): a tag's by how much more often it
stands outside the article than inside, and a container (tag with class, id or role) counts as aside when its words stand outside. Words
and tags of such containers, of menus, notices and the like score nothing and are not output, so the scan passes over them. One linear
scan finds the contiguous region of the best sum; the blocks of text inside it, without asides, are the main text.

Article and main elements are evidence, not a switch: tags inside cost a twentieth, and where they hold most of a page's words, the
words outside score nothing as well (links apart: menus and teasers are links). Elements that mark teasers beside a longer story so decide nothing.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import small_batches

SAMPLE = 2_000  # labelled pages for the tag weights, the first by hash of the id and url
# Fixed values of HTML: elements without shown text, elements that break a block, and containers that are not the article.
HIDDEN = "script style noscript template head title iframe object svg math canvas audio video".split()
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre search section select summary table caption tbody td tfoot th thead tr ul".split()
)
ASIDE = set("nav footer aside form button select menu dialog fieldset input textarea label".split())
NAMED = re.compile(
    r"^(ads?|adverts?|advertisement|adbox|banner|sponsor(ed)?|promo(tion)?|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|comments?|replies|"
    r"disqus|sidebar|side|widgets?|menu|navbar|nav|navigation|breadcrumbs?|footer|masthead|share|sharing|social|related|recommended|newsletter|"
    r"subscribe|signup|login|search|skip|toolbar|pagination|pager|tags)$"
)
ROLES = set("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog".split())
RAW = set("script style title iframe".split())  # without an end tag they hold the rest of the page
_STOP = re.compile(r"""[>"']""")
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN}
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _apart(name: str, attrs: str, in_article: bool) -> bool:
    """Is this element a container outside the main text?"""
    if name in ASIDE or (name == "header" and not in_article):
        return True
    for key, *values in _ATTR.findall(attrs):
        for value in "".join(values).lower().split():
            if key.lower() == "role" and value in ROLES:
                return True
            if key.lower() != "role" and any(NAMED.match(part) for part in (value, *re.split(r"[-_]+", value))):
                return True
    return False


class Scanner:
    """Tags and texts of a page by positions that only move forward, so broken markup of any length takes linear time."""

    def __init__(self, page: str):
        self.page, self.last_end = page, page.rfind(">")
        self.last_quote = {q: page.rfind(q) for q in "\"'"}
        self.quoted = True  # until a tag whose quotes swallow the rest of the page
        self.unclosed: set[str] = set()

    def tag_end(self, at: int) -> int:
        """Where the tag that opens at ``at`` ends; quoted values may hold ``>``. -1: nowhere."""
        if at >= self.last_end:
            return -1
        pos = at + 1
        while self.quoted:
            stop = _STOP.search(self.page, pos)
            if stop is None:
                self.quoted = False
                break
            pos, mark = stop.end(), stop[0]
            if mark == ">":
                return pos - 1
            if self.page[pos - 2] == "=" or self.page[pos - 2].isspace():  # else part of a name
                if self.last_quote[mark] < pos:
                    self.quoted = False
                    break
                pos = self.page.find(mark, pos) + 1
        return self.page.find(">", at)

    def pieces(self):
        """(start of the name or -1 for text, from, to): the tag's inside, or the text."""
        page, at = self.page, 0
        while at < len(page):
            lt = page.find("<", at)
            if lt < 0:
                yield None, page[at:]
                return
            if lt > at:
                yield None, page[at:lt]
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = len(page) if end < 0 else end + 3
                continue
            name = _NAME.match(page, lt + 1)
            end = self.tag_end(lt) if name else page.find(">", lt) if page[lt + 1 : lt + 2] in ("!", "?") and lt < self.last_end else -1
            if end < 0:  # not markup
                yield None, "<"
                at = lt + 1
                continue
            at = end + 1
            if not name:
                continue
            low, inside = name[1].lower(), page[name.end() : end]
            if page[lt + 1] != "/" and low in _CLOSE and low not in self.unclosed:
                close = _CLOSE[low].search(page, at)
                if close:
                    at = close.end()
                    continue
                self.unclosed.add(low)
                if low in RAW:
                    return
            yield ("/" if page[lt + 1] == "/" else "") + low, inside


def _kinds(name: str, attrs: str) -> set[str]:
    """The names by which a container is learned: its tag with each class, id and role."""
    return {f"{name} {key.lower()}={value}" for key, *values in _ATTR.findall(attrs) for value in "".join(values).lower().split()}


VOID = set("input br img hr meta link area base col embed source track wbr param".split())


def tokens(page: str, aside: set[str] = frozenset()):
    """(kind, value, apart, in_article) of a page: kinds are text, tag and end. ``aside`` has learned containers."""
    closing: list[tuple[str, int]] = []  # the open container and how deep its name is nested
    article = 0
    for name, inside in Scanner(page).pieces():
        if name is None:
            yield "text", inside, bool(closing), article > 0
        elif name[0] == "/":
            name, apart = name[1:], bool(closing)
            if name in ("article", "main"):
                article = max(0, article - 1)
            if closing and closing[-1][0] == name:
                depth = closing[-1][1] - 1
                closing[-1:] = [(name, depth)] if depth else []
            yield "end", name, apart, article > 0
        else:
            void = inside.endswith("/") or name in VOID
            if name in ("article", "main") and not closing:
                yield "tag", name, False, article > 0
                article += 1
                continue
            if not void:
                if closing and closing[-1][0] == name:
                    closing[-1] = (name, closing[-1][1] + 1)
                elif not closing and name not in ("body", "html") and (_apart(name, inside, article > 0) or (aside and not aside.isdisjoint(_kinds(name, inside)))):
                    closing.append((name, 1))
            yield "tag", name, bool(closing), article > 0


def _articles_hold_it(read: list, size: list[int]) -> bool:
    """Do article elements hold most of the words that are not links?"""
    held = [0, 0]
    link = False  # links do not nest: the latest tag tells
    for (kind, value, _, inside), n in zip(read, size):
        if kind != "text" and value == "a":
            link = kind == "tag"
        elif n and not link:
            held[inside] += n
    return held[True] > held[False]


def main_text(page: str, weights: dict[str, float], aside: set[str] = frozenset()) -> str:
    """The main text of one page. Without any positive region it is empty."""
    if not page:
        return ""
    read = list(tokens(page, aside))
    size = [len(value.split()) if kind == "text" and not apart else 0 for kind, value, apart, _ in read]
    marked = _articles_hold_it(read, size)
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, ((kind, value, apart, inside), n) in enumerate(zip(read, size)):
        if apart or (marked and not inside):
            continue
        score = float(n) if kind == "text" else -weights.get(value, 1.0) * (0.05 if inside else 1.0)
        if marked:  # inside an article nothing costs more than its words give, so the article stays whole
            score = max(score, -0.01)
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_at = total, (start, i + 1)
    blocks, now = [], []
    for kind, value, apart, inside in read[best_at[0] : best_at[1]]:
        if kind != "text":
            if value in BLOCKS:
                blocks.append("".join(now))
                now = []
            elif value == "br":
                now.append(" ")
        elif not apart and (inside or not marked):
            now.append(html.unescape(value))
    blocks.append("".join(now))
    return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def containers(page: str):
    """(kind of container, words inside the article, words outside) of a page; containers that hold the article are left out."""
    open_: list[list] = []  # name, kinds, words, holds an article
    article = 0
    for name, inside in Scanner(page).pieces():
        if name is None:
            n = len(inside.split())
            for one in open_:
                one[2] += n
        elif name[0] == "/":
            name = name[1:]
            article = max(0, article - (name in ("article", "main")))
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if at is not None:
                for _, kinds, words, holds in open_[at:]:
                    if not holds:
                        yield from ((k, words if article else 0, 0 if article else words) for k in kinds)
                del open_[at:]
        elif name in ("article", "main"):
            article += 1
            for one in open_:
                one[3] = True
        elif not (inside.endswith("/") or name in VOID) and len(open_) < DEEPEST:
            open_.append([name, _kinds(name, inside), 0, False])


DEEPEST = 64  # open containers that are learned from at a time
LEAST, SHARE = 20, 0.95  # a container is aside with so many words in the labelled pages, and that share of them outside
_MARKED = "(?i)<(article|main)[ >]"


def learned(pages: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], set[str]]:
    """A positive weight per tag name: the log of how much more often it stands outside marked articles than inside, at least 0.1; and
    the containers whose words stand outside."""
    marked = pages.where(F.col("html").rlike(_MARKED)).withColumn("h", F.xxhash64("page_id", "url")).withColumn("x", F.xxhash64("html"))
    # Chosen by keys alone, so that the pages themselves stay where they are until they are few; repeated rows count once.
    first = marked.select("h", "page_id", "x").distinct().orderBy("h", "page_id", "x").limit(sample).select("h", "x")
    marked = marked.join(F.broadcast(first), ["h", "x"], "left_semi").dropDuplicates(["h", "x"])

    def count(frames):
        for frame in frames:
            seen: Counter = Counter()
            for page in frame["html"]:
                for kind, value, _, inside in tokens(page):
                    if kind != "text":
                        seen[False, value, inside] += 1
                for kind, within, outside in containers(page):
                    seen[True, kind, True] += within
                    seen[True, kind, False] += outside
            if seen:
                yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["container", "name", "inside", "n"])

    rows = marked.select("html").mapInPandas(count, "container boolean, name string, inside boolean, n long").groupBy("container", "name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("n_in"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("n_out"))
    rows = rows.where(f"not container or (n_out >= {LEAST} and n_out >= {SHARE} * (n_in + n_out))").collect()  # names of at most ``sample`` pages
    weights = {r.name: min(4.0, max(0.1, math.log((r.n_out + 1) / (r.n_in + 1)) + 1)) for r in rows if not r.container}
    return weights, {r.name for r in rows if r.container}


def extract(df: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty html give an empty text; a page without marked article is judged by its scores alone. A tag that never ends is text;
    an unended comment, script, style, title or frame holds the rest of the page. Repeated rows and null ids
    each keep their row. Very long pages are read whole. An empty table gives no rows. Extra input columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    pages = df.select(df["page_id"].cast("long").alias("page_id"), df["url"].cast("string").alias("url"), F.coalesce(df["html"].cast("string"), F.lit("")).alias("html"))
    weights, aside = learned(pages, sample)

    def run(frames):
        for frame in frames:
            text = [main_text(p, weights, aside) for p in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": text, "n_chars": [len(t) for t in text]})

    return pages.mapInPandas(run, "page_id long, url string, text string, n_chars long")
