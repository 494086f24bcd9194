"""Contract columns of the queries without SQL, and the stages of the pipeline, against plain Python over a whole small table."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weirflow.llm import ctw, pii, quality, substrings
from weirflow.llm.common import written

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "one two one two one two\none two\n\none two\n"), (-4, "# a $ b\tc | <d> & é*"), (-5, "Mail a.b@c-d.example.org, b@c, +1 (415) 555-0100 or 4111 1111 1111 1111 at 1.2.3.4 and 999.1.1.1 +49")], "doc_id long, text string")
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return table.unionByName(extra).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.collect()]


def test_base_columns_of_the_language_model(docs, rows):
    tokens = {i: [*words(lowered(t)), None] for i, t in rows}
    trained = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(trained.values()), len(trained)
    for r in ctw.score(docs).collect():
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0, len(ws), sum(trained[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((trained[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) and r.score < 0


def luhn(digits):
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    return {kind: [(m.start(), m.end()) for m in re.finditer(p, text or "") if ok(m[0])] for kind, (p, ok) in KINDS.items()}


def test_base_spans_of_personal_data(docs, rows):
    texts = dict(rows)
    for r in pii.report(docs).collect():
        spans = base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in KINDS], r.doc_id
        joined = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def measures(text):
    ws, lines = words(text), (text or "").split("\n")
    grams = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    repeated = {i + k for i in range(len(ws) - 2) if grams[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated)


def test_measures_of_the_quality_rules(spark, docs, rows, sf_dir):
    texts = dict(rows)
    for r in quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect():
        m = measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m, r.doc_id
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r.base_failed and r.kept)


def test_kept_bytes_of_repeated_substrings(docs, rows):
    data = {i: (t or "").encode() for i, t in rows}
    starts = Counter(d[i : i + 200] for d in data.values() for i in range(len(d) - 199))
    for r in substrings.find_repeats(docs).collect():
        d = data[r.doc_id]
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if starts[d[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()), r.doc_id


def shingles(text):
    ws = words(lowered(text))
    return {tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))} if ws else set()


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made, now = [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, sf_dir), "stage")
        assert now.columns == docs.columns
        made.append({r.doc_id: r for r in now.collect()})
    good, unique, clean, hidden = made
    verdict = {r.doc_id: r.kept for r in quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert set(good) == {i for i, kept in verdict.items() if kept}
    # One of each group: the smallest id that nothing smaller leads to.
    sets = {i: shingles(r.text) for i, r in good.items()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert set(unique) == {i for i in sets if top(i) == i}
    bench = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = defaultdict(set)
    for ws in bench:
        n = min(10, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows[n].add(tuple(ws[i : i + n]))
    leaks = lambda ws: any(tuple(ws[i : i + n]) in known for n, known in windows.items() for i in range(len(ws) - n + 1))
    assert set(clean) == {i for i, r in unique.items() if not leaks(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(r.text)))}
    assert set(hidden) == set(clean)
    for i, r in hidden.items():
        before = clean[i].text or ""
        for spans in base_spans(before).values():
            assert all(before[a:b] not in r.text for a, b in spans)
        assert r.n_chars == len(r.text)
    mixed = [r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]
    size = {i: len(words(r.text)) for i, r in hidden.items()}
    total, taken = Counter(), Counter()
    for i, r in hidden.items():
        total[r.source] += size[i]
    for r in mixed:
        assert r["text"] == hidden[r["doc_id"]].text
        taken[r["doc_id"]] += size[r["doc_id"]]
    assert all(taken[i] <= 2 * size[i] for i in taken)
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, rest, free = {}, 1.5 * sum(total.values()), set(names)
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * total[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * total[s]
            rest -= target[s]
        free -= over
    for s in names:
        got = sum(taken[i] for i, r in hidden.items() if r.source == s)
        assert abs(got - target[s]) <= 0.1 * target[s] + max(size[i] for i, r in hidden.items() if r.source == s)


def test_pipeline_edges(spark, tmp_path, sf_dir):
    """Nulls, repeated rows and columns named like the stages' own pass through all stages; an empty table gives no rows."""
    good = " ".join(f"plain{i} words" for i in range(60))
    rows = [(1, None), (2, ""), (None, good + " without an id"), (None, good + " without an id"), (3, good), (3, good)]
    df = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, frame in (("some", df), ("none", df.limit(0))):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert set(docs_columns := frame.columns) <= set(out.columns), docs_columns
        found = out.collect()
        assert len({(r.doc_id, r.text) for r in found}) <= 2 and (name == "some" or not found)
    kept = corpus_pipeline.drop_near_duplicates(spark, df.withColumns({c: F.lit("x") for c in ("component_id", "_key", "label", "rep")}), sf_dir)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3"]
