"""Bottom-k near-duplicates and their linking against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import jaccard, linking, minhash

SCHEMA = "doc_id long, text string, component_id string, n_shingles string, kept string, sig string, rep string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 5) for i, t in rows], SCHEMA)


def shingles(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def brute(rows, width, need):
    """(doc_id, n, component) of rows with distinct ids or none."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    label = {i: i for i, _ in sets if i is not None}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and a < b and x and y and 100 * len(x & y) >= need * len(x | y):
                p, q = sorted((root(a), root(b)))
                label[q] = p
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed=5, groups=12):
    """Families of near copies at all distances, with a passage that everyone shares."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(12)]
    rows, i = [], 0
    for g in range(groups):
        base = [word() for _ in range(rng.choice((6, 40, 150, 400)))] + passage
        for _ in range(rng.choice((1, 3, 25))):
            text = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 25) + 1)):
                text[rng.randrange(len(text))] = word()
            rows.append((i * 7, " ".join(text)))
            i += 1
    rng.shuffle(rows)
    return rows


EDGES = [(1, None), (2, ""), (3, " \n\t"), (None, "no id at all here"), (None, "no id at all here"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, "long " * 100_000), (8, "long " * 200_000), (9, "é À b c d"), (10, "É À b c d")]


@pytest.mark.parametrize("run,width,need", [(minhash.near_duplicates, 4, 80), (jaccard.near_duplicates, 5, 75)])
def test_against_brute_force(spark, run, width, need):
    for rows in (EDGES, corpus(), corpus(6)):
        assert found(run(frame(spark, rows))) == brute(rows, width, need)
    assert run(frame(spark, [])).count() == 0


def test_small_ranges_and_blocks(spark, monkeypatch):
    rows = corpus(7, 8)
    monkeypatch.setattr(linking, "BLOCK", 4)
    monkeypatch.setattr(linking, "BLOCK_VALUES", 300)
    assert found(minhash.near_duplicates(frame(spark, rows), range_values=500)) == brute(rows, 4, 80)
    assert found(jaccard.near_duplicates(frame(spark, rows), range_bytes=2_000)) == brute(rows, 5, 75)


def test_kept(spark):
    rows = minhash.near_duplicates(frame(spark, [(5, "a b c d e f"), (3, "a b c d e f"), (4, "other"), (6, ""), (None, "x"), (4, "other")])).collect()
    assert sorted((str(r.doc_id), r.kept) for r in rows) == [("3", True), ("4", True), ("4", True), ("5", False), ("6", True), ("None", True)]


def test_union_estimate_of_many_equals_that_of_pairs():
    rng = np.random.default_rng(3)
    pool = np.sort(rng.integers(0, 1 << 62, 600, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (1, 3, 90, 128, 130, 400, 590, 595, 600)]
    may = minhash.plausible_among(sets)
    for x in range(len(sets)):
        others = np.array([y for y in range(len(sets)) if y != x])
        assert may(x, others).tolist() == [minhash.plausible(sets[x], sets[y]) for y in others]


def test_a_task_emits_fewer_links_than_labels():
    rng = np.random.default_rng(4)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.sort(np.concatenate((base, rng.integers(1000, 1 << 40, 3, dtype=np.uint64)))) for _ in range(60)]
    links = linking.unite(np.arange(60), np.arange(60), np.ones(60, bool), sets, 3, 4)
    assert len(links) == 59


def test_components_of_a_chain_take_few_rounds(spark, monkeypatch):
    rounds = []
    kept = linking.written
    monkeypatch.setattr(linking, "written", lambda df, label: rounds.append(label) or kept(df, label))
    chain = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    label = linking.components(chain)
    assert label.select("label").distinct().collect() == [(0,)] and label.count() == 1001
    assert rounds.count("to") <= 20


def test_keep_one_of_repeated_rows_and_rows_without_id(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(7, text), (7, text), (None, text + " more"), (None, "alone here " * 3), (None, "alone here " * 3), (9, "short one"), (9, "another text of this id"), (1, ""), (1, ""), (None, None), (None, None)]
    kept = jaccard.keep_one(frame(spark, rows))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted([("7", text), ("None", "alone here " * 3), ("9", "short one"), ("9", "another text of this id"), ("1", ""), ("None", "")])
