"""Main text: the region against all regions, articles as evidence, broken markup in linear time."""

import html as entities
import random
import re
import time

import pytest

from weirflow.llm import html

STORY = "<p>" + "Story words that go on for a while. " * 12 + "</p>"
TEXT = " ".join("Story words that go on for a while.".split() * 12)
MENU = "<div>" + "<a href=x>menu</a> " * 40 + "</div>"


def brute(page, weights, aside=frozenset()):
    """The blocks of the best of all regions, by trying each."""
    read = list(html.tokens(page, aside))
    sizes = [len(v.split()) if k == "text" and not a else 0 for k, v, a, _ in read]
    marked = html._articles_hold_it(read, sizes)
    scores = []
    for kind, value, apart, inside in read:
        if apart or (marked and not inside):
            scores.append(0.0)
        else:
            one = float(len(value.split())) if kind == "text" else -weights.get(value, 1.0) * (0.05 if inside else 1)
            scores.append(max(one, -0.01) if marked else one)
    best = max((round(sum(scores[i:j]), 6) for i in range(len(read)) for j in range(i + 1, len(read) + 1)), default=0)
    return best, scores, marked


def test_the_region_is_the_best_of_all():
    rng = random.Random(2)
    for _ in range(150):
        page = "".join(rng.choice(["<p>", "</p>", "<a href=x>", "</a>", "<li>", "word ", "two words ", "<nav>", "</nav>", "<article>", "</article>", "<div class=ad>", "</div>", "a b c d e "]) for _ in range(rng.randrange(1, 22)))
        weights = {t: rng.choice((0.1, 1.0, 2.5)) for t in ("p", "a", "li", "div", "article")}
        best, scores, _ = brute(page, weights)
        # The scan again, on the same scores.
        total = top = 0.0
        for s in scores:
            total = max(total, 0.0) + s
            top = max(top, total)
        assert top == pytest.approx(max(best, 0.0))
        found = html.main_text(page, weights)
        assert (found == "") == (best <= 0)


def test_articles_are_evidence():
    two = f"<body>{MENU}<article>{STORY}</article>{MENU * 3}<article><p>Short second part.</p></article></body>"
    assert html.main_text(two, {}) == TEXT + "\n\nShort second part."
    teasers = f"<body><h1>Head</h1>{STORY}{STORY}<nav><article><a href=x>Teaser one</a></article></nav><div><article><a>Teaser two</a></article></div></body>"
    assert TEXT + "\n\n" + TEXT in html.main_text(teasers, {"a": 3.0, "div": 2.0, "article": 2.0})
    stripped = re.sub("</?article>", "", f"<body><nav>{MENU}</nav><article><h1>Title of it</h1>{STORY}</article><footer>foot</footer></body>")
    assert html.main_text(stripped, {}) == "Title of it\n\n" + TEXT


def test_containers_are_learned(spark):
    page = lambda i: f"<body><div class=wrap><section class=teasertext>{'Read our other things today. ' * 3}</section><article>{STORY}<div class=box>inside words</div></article></div></body>"
    rows = [(i, "u", page(i)) for i in range(5)] + [(9, "u", f"<body><section class=teasertext>{'Read our other things today. ' * 3}</section>{STORY}<div class=box>inside words</div></body>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    _, aside = html.learned(df)
    assert aside == {"section class=teasertext"}
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract(df).collect()}
    assert set(got.values()) == {(TEXT + "\n\ninside words", len(TEXT) + 14)}


def test_whole_table_against_its_articles(spark, sf_dir):
    """Pages of the table hold one article: its blocks by plain string work, without what the contract leaves out."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html.extract(pages).collect():
        body = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|form|aside|nav|noscript)\b.*?</\1>", " ", body)
        body = re.sub(r'(?s)<(div|section)[^>]*class="?(ad|comments?|notice|share|related)[^>]*>.*?</\1>', " ", body)
        words = entities.unescape(re.sub(r"<[^>]+>", " ", body)).split()
        assert "".join(r.text.split()) == "".join(words)
    assert pages.count() == html.extract(pages.unionByName(pages)).count() / 2  # repeated rows keep their row


@pytest.mark.parametrize("broken", ["<script ", '<p class="x" ', "<a ", "<!-- ", "<svg>", "<div class='", '</p "', '<p ="> ', "<script>", "<", "<p id   ", "<title>", "</script"])
def test_broken_markup_takes_linear_time(broken):
    page = f"<p>{'start words ' * 5}</p>" + broken * (1_000_000 // len(broken))
    start = time.time()
    text = html.main_text(page, {})
    list(html.containers(page))
    assert time.time() - start < 20 and text.startswith("start words")


def test_scanner_reads_tags_and_hidden_elements():
    read = lambda page: "".join(("" if n is None else f"[{n}]") + ("" if n else v) for n, v in html.Scanner(page).pieces())
    assert read('a<b title="x>y">c</b>d') == "a[b]c[/b]d"
    assert read("1 < 2 <3 <p>x") == "1 < 2 <3 [p]x"
    assert read("<!DOCTYPE html><script>if (a<b) '</p>'</SCRIPT >x<style>p{}</style>y<!-- <p> -->z") == "xyz"
    assert read("<p>x<script>rest") == "[p]x" and read("<svg>x") == "[svg]x" and read("x<p") == "x<p"
    assert read("<p class='it' d='x>y'>z<a href=it's>w</a>") == "[p]z[a]w[/a]"
