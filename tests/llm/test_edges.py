"""Nulls, empty texts and tables, ties, repeated rows and clashing columns for every operator of the subpackage."""

import pytest
from pyspark.sql import functions as F

from weirflow.llm import chat, ctw, decontaminate, html, jaccard, licenses, mixing, pii, quality, substrings

LONG = "lorem ipsum dolor sit amet consectetur " * 800
CLASHING = ("n_words", "size", "component_id", "row", "kept", "terms", "key", "block", "source_size", "mix_shard", "target")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * len(CLASHING)) for i, t, s in rows], SCHEMA)


ROWS = [
    (1, None, "a"), (2, "", "a"), (None, "no id here at all " * 20, None), (3, "one two", "b"), (3, "one two", "b"), (3, "other text of the same id", "b"),
    (4, LONG, "a"), (5, LONG, "a"), (6, LONG + " end", "b"), (7, "mail me at jo.x@ab.example.com or +1 (415) 555-0100 now", "c"), (8, "\n \t\n", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def labels(spark, rows=((4, 1), (7, 1), (7, 0), (5, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int")


def bench(spark, rows=((1, "Dolor sit amet consectetur LOREM ipsum dolor sit amet consectetur"), (2, None), (3, ""), (None, "one two"), (4, "one two"), (4, "one two"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_every_operator_keeps_each_row(spark, docs, nothing):
    runs = {
        "score": ctw.score, "leaks": lambda d: decontaminate.find_leaks(d, bench(spark)), "near": jaccard.near_duplicates, "pii": pii.report,
        "mix": mixing.mix_report, "quality": lambda d: quality.judge(d, labels(spark)), "repeats": substrings.find_repeats,
    }
    for name, run in runs.items():
        assert sorted(str(r.doc_id) for r in run(docs).collect()) == sorted(str(i) for i, *_ in ROWS), name
        assert run(nothing).count() == 0, name


def test_filters_keep_columns(spark, docs, nothing):
    runs = {"good": lambda d: quality.keep_good(d, labels(spark)), "one": jaccard.keep_one, "clean": lambda d: decontaminate.drop_contaminated(d, bench(spark)), "hidden": pii.sanitise}
    for name, run in runs.items():
        assert run(docs).columns == docs.columns, name
        assert run(nothing).count() == 0, name
    assert mixing.mix(nothing).count() == 0
    assert "mix_shard" in mixing.mix(docs).columns


def test_jaccard(spark, docs):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got[(4, 6)] == got[(5, 6)] == 4 and got[(1, 0)] == 1 and got[(2, 0)] == 2 and got[(8, 0)] == 8
    assert got[(3, 1)] == 3 and [v for (i, _), v in got.items() if i is None] == [None]
    assert {r.doc_id for r in jaccard.keep_one(docs).collect()} >= {None, 1, 2, 3, 4, 7, 8}


def test_jaccard_one_group_with_different_texts(spark):
    """Variants of one base: members far from each other are joined through the base, and no link is lost."""
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base), "a")]
    for k in range(1, 60):
        words = list(base)
        words[(7 * k) % 120], words[(31 * k + 5) % 120] = f"x{k}", f"y{k}"
        rows.append((k, " ".join(words), "a"))
    rows += [(100 + k, " ".join([f"z{k}_{i}" for i in range(40)] + base[:60]), "a") for k in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t, _ in rows}
    label = {i: i for i in sets}
    for _ in range(60):
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if 4 * n >= 3 * (len(sets[a]) + len(sets[b]) - n):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[i]] == label[i] for i in label):
            break
    assert got == label


def test_decontaminate_in_blocks(spark, docs):
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    whole = decontaminate.find_leaks(docs, bench(spark)).select(cols).collect()
    parts = decontaminate.find_leaks(docs, bench(spark), block_bytes=8).select(cols).collect()
    assert sorted(map(str, whole)) == sorted(map(str, parts))
    by = {(r.doc_id, r.n_words): r for r in whole}
    assert by[(3, 2)].n_hit == 2 and by[(3, 2)].n_items == 1 and by[(4, 4800)].contaminated and not by[(1, 0)].contaminated
    assert decontaminate.find_leaks(docs, bench(spark, [])).where("contaminated").count() == 0


def test_pii_spans_and_replacement(spark, docs):
    row = pii.report(docs).where("doc_id = 7").first()
    text = ROWS[9][1]
    at, to = text.index("jo.x"), text.index(" or +1")
    assert (row.n_email, row.n_phone) == (1, 1) and row.spans.startswith(f"email:{at}:{to},phone:")
    assert pii.sanitise(docs).where("doc_id = 7").first().text == "mail me at [EMAIL] or [PHONE] now"
    assert pii.sanitise(docs).where("doc_id = 1").first().text is None


def test_pii_disclosing_terms(spark):
    """A word that stands beside one address in several contexts, and nowhere else, gives it away."""
    rows = [(k, f"note {w} from zorblax chief {w} boss@corp.example.com the {w} end", "s") for k, w in enumerate(("oak", "elm", "fir", "yew", "ash"))]
    rows += [(100 + k, f"plain text {k} about the weather and note", "s") for k in range(200)]
    got = pii.report(frame(spark, rows)).where("n_term > 0").collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 2, 3, 4]
    assert "zorblax" not in pii.sanitise(frame(spark, rows)).where("doc_id = 2").first().text


def test_pii_terms_of_rare_values_by_brute_force(spark):
    """A value of one document has terms too, also far from it, and they go wherever they stand in the document."""
    import math
    import re

    far = "filler text " * 30
    rows = [(0, f"Quixotry opens. {far} ask rare@corp.example.com now {far} the quixotry ends", "s"), (1, f"vantor {far} twice@corp.example.com {far} Vantor", "s"), (2, f"{far} twice@corp.example.com vantor", "s")]
    rows += [(100 + k, f"plain text {k} ask now the filler twice ends opens corp example com rare", "s") for k in range(2000)]
    words = {i: set(re.findall("[a-z]{2,}", t.lower())) for i, t, _ in rows}
    held = {i: set(re.findall(r"[\w.]+@[\w.]+", t)) for i, t, _ in rows}
    n, expected = len(rows), {}
    for i in held:
        for e in held[i]:
            n_e = sum(e in v for v in held.values())
            for t in words[i]:
                n_t, n_et = sum(t in v for v in words.values()), sum(t in words[j] and e in held[j] for j in held)
                if math.log(n * n_et / (n_e * (n_t + 1))) / math.log(n / n_e) >= 0.9:
                    expected.setdefault(i, set()).add(t)
    assert expected == {0: {"quixotry"}, 1: {"vantor"}, 2: {"vantor"}}
    df = frame(spark, rows)
    assert {r.doc_id: r.n_term for r in pii.report(df).where("n_term > 0").collect()} == {0: 2, 1: 2, 2: 1}
    clean = {r.doc_id: r.text for r in pii.sanitise(df).where("doc_id < 3").collect()}
    assert all(t not in clean[i].lower() for i, ts in expected.items() for t in ts)


def test_mix_is_whole_and_repeatable(spark, docs):
    one = sorted(map(str, mixing.mix(docs).collect()))
    assert one == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    told = mixing.mix_report(docs).groupBy().sum("taken").first()[0]
    words = {(r.doc_id, r.text): len((r.text or "").split()) for r in docs.collect()}
    assert sum(words[(r.doc_id, r.text)] for r in mixing.mix(docs).collect()) == told


def test_mix_report_shows_what_the_tree_deals(spark, monkeypatch):
    """The report counts dealt copies: it equals the mix, and a unit that the tree loses is missing from both."""
    df = frame(spark, [(k, f"text {k} " * (k % 7 + 1), "abc"[k % 3]) for k in range(300)])
    options = {"block_words": 40, "shard_words": 60}
    size = {r.doc_id: len(r.text.split()) for r in df.collect()}

    def both():
        told = {r.doc_id: r.taken for r in mixing.mix_report(df, **options).collect()}
        rows = [r.doc_id for r in mixing.mix(df, **options).collect()]
        assert told == {i: n * rows.count(i) for i, n in size.items()}
        return sum(told.values())

    whole, runs = both(), mixing.shard_runs
    monkeypatch.setattr(mixing, "shard_runs", lambda *a: runs(*a).where("shard > 0"))
    assert both() < whole


def test_mix_targets():
    assert mixing.targets([("a", 100), ("b", 100), ("c", 100)]) == pytest.approx([200, 166.6666667, 83.3333333])
    assert mixing.targets([("a", 0), ("b", 10)]) == pytest.approx([0, 15])


def test_shard_quotas_are_exact(spark):
    runs = mixing.shard_runs(spark, [1000, 10, 0, 333], 37, 5).collect()
    for src, quota in enumerate([1000, 10, 0, 333]):
        spans = sorted((r["first"], r["first"] + r["count"]) for r in runs if r.src == src)
        assert sum(b - a for a, b in spans) == quota and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    sizes = [sum(r["count"] for r in runs if r.shard == s) for s in range(37)]
    assert max(sizes) - min(sizes) <= 6


def test_quality_without_trusted(spark, docs):
    assert all(r.llr == 0 for r in quality.judge(docs, labels(spark, [])).collect())


def test_chat_edges(spark):
    rows = [(1, 1, "user", None), (1, 0, None, "x\\<|im_end|>"), (1, 2, "user", "</s>"), (1, 2, "user", "</s>"), (None, None, "assistant", "a<|im_next|>b\\"), (2, 5, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_chats(df).select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [("", "x\\<|im_end|>"), ("user", ""), ("user", "</s>"), ("user", "</s>")]
    assert [(t.role, t.text) for t in out[None].turns] == [("assistant", "a<|im_next|>b\\")]
    got = {r.conv_id: r for r in chat.digest(chat.format_chats(df)).collect()}
    assert got[2].loss_chars == 0 and got[None].loss_chars == 14
    assert out[1].formatted.count("<|im_start|>") == 2
    assert chat.digest(chat.format_chats(df.limit(0))).count() == 0


def test_repeats_by_brute_force(spark):
    import random

    r = random.Random(3)
    shared = "".join(r.choice("abcdé ") for _ in range(420))
    rows = [(k, "".join(r.choice("abcd ") for _ in range(r.randrange(50, 500))) + (shared if k % 3 == 0 else "") + "q" * (250 if k == 7 else 0) + str(k), "s") for k in range(40)]
    rows += [(90, "spam " * 100, "s"), (91, "x" * 199, "s"), (92, "x" * 199, "s"), (93, "y" * 200, "s"), (94, "y" * 200, "s")]
    got = {x.doc_id: (x.n_removed, x.n_spans) for x in substrings.find_repeats(frame(spark, rows)).collect()}
    from collections import Counter

    data = {i: t.encode() for i, t, _ in rows}
    seen = Counter(b[k : k + 200] for b in data.values() for k in range(len(b) - 199))
    for i, b in data.items():
        mark = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                mark[k : k + 200] = b"\1" * 200
        assert got[i] == (sum(mark), len([1 for a, z in zip(b"\0" + bytes(mark), mark) if z > a])), i


def whole_tree(codes, counts, depth, bit):
    """The trees of one decision over all n-grams, as one range."""
    import numpy as np

    order = np.argsort(turned := ctw.turned(codes))
    return ctw.Tree(turned[order], counts[order], depth, bit, 0, (1 << 64) - 1, ctw.Estimator())


def test_score_is_a_distribution(spark):
    """Probabilities of all continuations of a context add up to one, and training counts matter."""
    import numpy as np

    codes = np.array([(c << 8) | x for c in (0xFFFF, 0xFF61) for x in range(256)], np.uint64)
    counts = np.where((codes & np.uint64(255)) == 97, 5, 0)
    p = np.prod([whole_tree(codes, counts, 2, bit).predict() for bit in range(8)], axis=0)
    p = dict(zip(np.sort(ctw.turned(codes)).tolist(), p.tolist()))
    of = lambda c: [p[x] for x in ctw.turned(np.array([(c << 8) | x for x in range(256)], np.uint64)).tolist()]
    assert sum(of(0xFFFF)) == pytest.approx(1) and sum(of(0xFF61)) == pytest.approx(1) and of(0xFFFF)[97] > 0.5


def test_deep_contexts_beat_the_word_base(spark, sf_dir):
    """Contexts longer than four bytes count: held-out documents score above the word base."""
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    whole, base = ctw.score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert whole > base


def test_subtree_sums_equal_direct_counts():
    """Counts of every depth are those counted from the n-grams, at the full 64 bits."""
    from collections import Counter

    import numpy as np

    text = b"the cat sat on the mat, the cat ate the rat" * 3
    codes, counts = np.unique(ctw.ngrams([text, bytes([0xC3, 0xA9, 0xF4]) * 5], 7)[0], return_counts=True)
    trees = [whole_tree(codes, counts, 7, bit) for bit in range(8)]
    for d in range(8):
        ones, zeros = Counter(), Counter()
        for code, n in zip(codes.tolist(), counts.tolist()):
            context, x = (code >> 8).to_bytes(7, "big"), code & 255
            last = int.from_bytes(context[::-1][:d], "big")  # the last byte highest
            for k in range(8):
                key = (last << 8) | (1 << k) | (x >> (8 - k))
                (ones if (x >> (7 - k)) & 1 else zeros)[key] += n
        got = {k: v for t in trees for k, v in zip(t.keys[d].tolist(), zip(t.zeros[d].tolist(), t.ones[d].tolist()))}
        assert got == {k: (zeros[k], ones[k]) for k in ones.keys() | zeros.keys()}


def plain_tree_scores(rows, depth):
    """Context-tree weighting with dictionaries: log10 probability of each text and its end."""
    import math
    from collections import defaultdict

    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def steps(text):
        data = bytes([255]) * depth + text + bytes([255])
        for i in range(depth, len(data)):
            for k in range(8):
                path = [(data[i - d : i], (1 << k) | (data[i] >> (8 - k))) for d in range(depth + 1)]
                yield path, (data[i] >> (7 - k)) & 1

    for i, text in rows:
        for path, bit in steps(text):
            for d, node in enumerate(path):
                counts[node][bit] += not ctw.is_held_out(i)
                if d < depth:
                    children[node].add(path[d + 1])

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted, own = {}, {}

    def weigh(node):
        if node not in weighted:
            mine = kt(*counts[node])
            below = sum(map(weigh, children[node]))
            top = max(mine, below)
            both = top + math.log(math.exp(mine - top) + math.exp(below - top))
            own[node] = math.exp(mine - both)
            weighted[node] = both - math.log(2) if children[node] else mine
        return weighted[node]

    for root in [n for n in list(counts) if not n[0]]:
        weigh(root)
    out = {}
    for i, text in rows:
        total = 0.0
        for path, bit in steps(text):
            p = None
            for node in reversed(path):
                e = (counts[node][bit] + 0.5) / (sum(counts[node]) + 1)
                p = e if p is None else own[node] * e + (1 - own[node]) * p
            total += math.log10(p)
        out[i] = total
    return out


@pytest.mark.parametrize("size", [1 << 20, 300, 20])
@pytest.mark.parametrize("depth", [7, 3])
def test_scores_equal_a_plain_tree_wherever_it_is_cut(spark, depth, size):
    """One range, some, and cuts inside contexts of up to six bytes give the same; so do blocks of a few texts."""
    texts = ["", "aaaa aaaa aaaa aaab", "the cat sat on the mat", "The cat sat\n on the rat", "x", "été à l'été", "zzz" * 40, "the cat sat on the mat"]
    rows = [(i, texts[i % len(texts)] + ("" if i % 3 else " the end")) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_tree_scores([(i, t.encode()) for i, t in rows], depth)
    got = {r.doc_id: r.score for r in ctw.score(docs, depth=depth, block_bytes=150, range_size=size).collect()}
    assert got == {i: pytest.approx(v, rel=1e-6) for i, v in want.items()}


def test_scores_do_not_depend_on_slices(spark, monkeypatch):
    """N-grams of a block are listed slice by slice, and each range merges those of all slices."""
    texts = ["", "the cat sat on the mat", "The cat sat\n on the rat", "été à l'été", "zzz" * 20]
    rows = [(i, texts[i % 5] + " the end" * (i % 4 == 0)) for i in range(40)]
    monkeypatch.setattr(ctw, "SLICE_BYTES", 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = plain_tree_scores([(i, t.encode()) for i, t in rows], 5)
    got = {r.doc_id: r.score for r in ctw.score(docs, depth=5, range_size=100).collect()}
    assert got == {i: pytest.approx(v, rel=1e-6) for i, v in want.items()}


def test_a_heavy_context_is_cut(spark):
    """N-grams of one context byte are spread over ranges: none holds much more than its share."""
    import random

    from weirflow.llm.common import documents, written

    draw = random.Random(5)
    docs = spark.createDataFrame([(i, "".join(draw.choice("abcdfghi") + "e" for _ in range(400))) for i in range(40)], "doc_id long, text string")
    blocks = written(documents(docs).mapInArrow(ctw._blocks(7, 4000, 1), ctw._BLOCK), "blocks")
    cuts = ctw.range_cuts(blocks, 1, 1000, 7)
    asked = blocks.mapInArrow(ctw._ask(cuts), ctw._ASKED)
    summed = asked.groupBy("r").applyInArrow(ctw._sum_range(cuts, 7), ctw._SUMMED).collect()
    sizes = [len(ctw._unpack(bytes(r.codes), "uint64", True)) for r in summed]
    assert len(cuts) > 3 and max(sizes) <= 1500


def test_html_edges(spark):
    rows = [
        (1, "u", None), (2, "u", ""), (None, None, "<p>a &amp; b<br>c</p>\n<p> d\t e </p>"),
        (4, "u", "<nav><a>menu</a></nav><article><h1>T</h1><p>one <b>two</b></p><aside>no</aside><div class='comments'><p>no</p></div><p>three</p></article><footer>f</footer>"),
        (5, "u", "<body><div id=cookie-notice>ok?</div><form>q</form><p>" + "word " * 50 + "</p><script>var a='<p>x</p>'</script><p>tail words of the text</p></body>"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int")
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert got[1] == got[2] == "" and got[None] == "a & b c\n\nd e"
    assert got[4] == "T\n\none two\n\nthree" and got[5].endswith("tail words of the text") and "ok" not in got[5]
    assert html.extract(df.limit(0)).count() == 0


def test_licenses(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "print(1)"), ("a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
        ("a/b/d/e.py", "# Licensed under CC BY-NC 4.0.\ncode"), ("z/x.py", None), (None, ""), ("a/y.py", "Licensed to nobody in particular here"),
    ]
    got = {r.path: (r.license, r.via) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/b/c/x.py"] == ("Apache-2.0", "inherited") and got["a/y.py"] == ("MIT", "inherited") and got["a/b/d/e.py"] == ("CC-BY-NC-4.0", "own")
    assert got["z/x.py"] == (None, "none") and got[""] == (None, "none")
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_licenses_renamed(spark):
    """Renaming files gives the rows that the final paths themselves give; an empty renaming changes nothing."""
    text = "All rights\n---\nreserved."
    rows = [("a/1", text, "a/LICENSE"), ("a/2", "plain words", None), ("a/b/3", None, None), ("a/b/3", "", None), ("c/4", "Licensed under the MIT License\nrest", "c/5")]
    files = spark.createDataFrame([r[:2] for r in rows], "path string, text string")
    renamed = spark.createDataFrame([(r[0], r[2]) for r in rows if r[2]], "file string, path string")
    direct = spark.createDataFrame([(r[2] or r[0], r[1]) for r in rows], "path string, text string")
    got = sorted(map(tuple, licenses.scan(files, renamed=renamed).collect()))
    assert got == sorted(map(tuple, licenses.scan(direct).collect())) and len(got) == 4
    assert {r[0]: (r[1], r[3]) for r in got} == {"a/LICENSE": ("Proprietary", "own"), "a/2": ("Proprietary", "inherited"), "a/b/3": ("Proprietary", "inherited"), "c/5": ("MIT", "own")}
    assert sorted(map(tuple, licenses.scan(files, renamed=renamed.limit(0)).collect())) == sorted(map(tuple, licenses.scan(files).collect()))


def test_executors_need_no_package(tmp_path):
    """Started from another folder, Python workers cannot import the package: everything travels by value."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from weirflow.llm import alignment, ctw, decontaminate, merkle, minhash
from weirflow.session import build_session
spark = build_session("away", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
docs = spark.createDataFrame([(i, "some words of a text " * 5, "en", "s", 3) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
items = spark.createDataFrame([(None, "words of a text"), (1, "no such words")], "item_id long, text string")
assert ctw.score(docs).count() == 20
assert [tuple(r) for r in decontaminate.find_leaks(docs, items).select("n_hit", "n_items", "contaminated").distinct().collect()] == [(20, 0, True)]
assert alignment.report(docs).count() == merkle.audit(docs).count() == minhash.near_duplicates(docs).count() == 20
print("done")
"""
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().endswith("done"), run.stderr[-3000:]
