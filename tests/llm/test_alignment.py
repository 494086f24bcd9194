"""Alignment against token-by-token loops over the reference tokenizer files."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import alignment

SCHEMA = "doc_id long, text string, block long, doc int, pair long, n_best long"


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(os.path.join(alignment.TOKENIZERS, alignment.BYTE_FILE))
    slow.encode_special_tokens = True
    return slow, sentencepiece.SentencePieceProcessor(model_file=os.path.join(alignment.TOKENIZERS, alignment.PIECE_FILE))


def sides(coders, text):
    slow, pieces = coders
    if not text:
        return [], []
    letters = alignment.byte_letters()
    a = [(i, bytes(letters[c] for c in slow.id_to_token(i))) for i in slow.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in pieces.encode(text)]
    raw = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def spans(side):
    at = 0
    for i, data in side:
        yield i, at, at + len(data)
        at += len(data)


def brute(coders, rows):
    docs, total = [], Counter()
    for doc_id, text in rows:
        a, b = (list(spans(s)) for s in sides(coders, text))
        links = []
        low = 0
        for i, s, e in a:
            while low < len(b) and b[low][2] <= s:
                low += 1
            at = low
            while at < len(b) and b[at][1] < e:
                links.append((i, b[at][0]))
                at += 1
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if s >= start and e <= end) for side in (a, b)) if len(common) < 2000 else None)
            start = end
        docs.append((doc_id, a, b, groups, links))
        total.update(links)
    most = Counter()
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, a, b, groups, links in docs:
        text = ";".join(groups) if None not in groups else None
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links), text and hashlib.sha256(text.encode()).hexdigest() if text != "" else ""))
    return sorted(out, key=str)


ROWS = [
    (1, None), (2, ""), (None, "no id, twice"), (None, "no id, twice"), (3, "One two three."), (3, "One two three."), (4, "<|endoftext|> and </s> <s> <unk> are text"), (5, "  spaces\t\ttabs\n\n\nlines  "),
    (6, "naïve café – 日本語 \U0001f600\U0001f468‍\U0001f469 ́ \x00\x01"), (7, " leading"), (8, "a" * 3000), (9, "▁ mark"), (10, "the the the the " * 50), (11, "don't we'll I'VE 12345 3.14"),
    (12, "\r\n\x0b\x0c\xa0　"), (13, "zxqj wvut " * 20),
]


def found(df, **options):
    return sorted((tuple(r) for r in alignment.report(df, **options).collect()), key=str)


def test_edges(spark, coders):
    df = spark.createDataFrame([(i, t, 1, 1, 1, 1) for i, t in ROWS], SCHEMA)
    assert found(df) == brute(coders, ROWS)
    assert found(df.limit(0)) == []
    assert found(df.where("doc_id < 3")) == brute(coders, ROWS[:2])


def test_whole_table_in_small_blocks(spark, coders, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(coders, rows)
    for options in ({}, {"block_bytes": 20_000}):
        for got, expected in zip(found(docs.repartition(3), **options), want, strict=True):
            assert got[:7] == expected[:7] and expected[7] in (None, got[7])


def test_very_long_texts(spark, coders):
    rows = [(1, "word " * 300_000), (2, " " * 1_000_000), (3, "x" * 20_000)]
    got = {r.doc_id: r for r in alignment.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    slow, pieces = coders
    for i, t in rows:
        assert got[i].n_a == len(slow.encode(" " + t, add_special_tokens=False).ids) and got[i].n_b == len(pieces.encode(t))


def test_groups_and_pair_counts(spark):
    df = spark.createDataFrame([(1, "hello hello"), (2, "hello")], "doc_id long, text string")
    made = alignment.align(df, texts=True)
    groups = {r.doc_id: r.groups for r in made.documents.collect()}
    assert groups[1] == ";".join([groups[2]] * 2)
    assert made.pairs().agg(F.max("n_links"), F.max("n_docs")).first()[:] == (3, 2)


def test_planes():
    rng = np.random.default_rng(1)
    for size in (1, 5, 900, 60_000):
        docs = np.sort(rng.choice(65_536, size, replace=False))
        times = rng.integers(1, 40, size)
        planes = alignment.posting(docs, times)
        assert sum(alignment.popcount(p) << j for j, p in enumerate(planes) if p) == times.sum()
        assert (alignment.merge_or([p for p in planes if p]) == docs).all()
